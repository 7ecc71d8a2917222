"""Near-duplicate documents: DartMinHash signatures, banded joining, exact check of weighted Jaccard similarity."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearium.llm.common import ROW, connected_components, in_blocks, numbered, sent, slices, stars, text_key
from arrearium.session import scratch_scope, stored

_WORDS = 5
_U = np.uint64
_GOLDEN = _U(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def regions(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(doc index, region), sorted by both: a shingle that occurs n times is an element of weight n, held as n unit regions.

    Words are what stands between white space, lower-cased. A text of one to four words is one shingle.
    """
    words: list[str] = []
    counts = np.zeros(len(texts), dtype=np.int64)
    for i, t in enumerate(texts):
        own = t.lower().split() if t else []
        if 0 < len(own) < _WORDS:
            own += [""] * (_WORDS - len(own))
        words += own
        counts[i] = len(own)
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    hashed = pd.util.hash_array(np.array(words, dtype=object))
    n = len(words) - _WORDS + 1
    shingle = np.zeros(n, dtype=_U)
    for k in range(_WORDS):
        shingle = shingle * _U(0x100000001B3) + hashed[k:k + n]
    doc = np.repeat(np.arange(len(texts)), counts)
    inside = doc[:n] == doc[_WORDS - 1:]
    doc, shingle = doc[:n][inside], _mix(shingle[inside])
    order = np.lexsort((shingle, doc))
    doc, shingle = doc[order], shingle[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (shingle[1:] != shingle[:-1])
    at = np.arange(len(doc))
    copy = at - np.maximum.accumulate(np.where(new, at, 0))
    return doc, _mix(shingle + copy.astype(_U) * _GOLDEN)


def _poisson(mean: float) -> np.ndarray:
    """Cumulative probabilities of 0, 1, 2, ... darts."""
    k = np.arange(int(mean + 12 * math.sqrt(mean) + 24))
    logs = k * math.log(mean) - mean - np.array([math.lgamma(x + 1) for x in k])
    return np.cumsum(np.exp(logs))


def signatures(doc: np.ndarray, region: np.ndarray, docs: int, coordinates: int) -> np.ndarray:
    """Identity of the earliest dart by document and coordinate; row of zeros for a document without regions.

    Darts fall on each unit region as a Poisson process in rank, the same for every document that holds the region.
    Ranks are cut into bands that double; a document looks at as many bands as it takes to fill its coordinates, so few
    darts are thrown at a region of a long document and many at one of a short one. Two documents agree in a coordinate
    with a probability of their weighted Jaccard similarity.
    """
    weight = np.bincount(doc, minlength=docs)
    best = np.zeros((docs, coordinates), dtype=_U)
    filled = np.zeros((docs, coordinates), dtype=bool)
    active = weight > 0
    low, band = 0.0, 0
    high = 2.0**-7
    enough = coordinates * (math.log(coordinates) + 1) / np.maximum(weight, 1)
    while active.any():
        use = active[doc]
        r, d = region[use], doc[use]
        chance = _poisson(high - low)
        salt = _mix(np.array([band + 1], dtype=_U) * _GOLDEN)[0]
        base = _mix(r ^ salt)
        n = np.searchsorted(chance, (base >> _U(11)).astype(np.float64) / 2.0**53)
        hit = n > 0
        n, base, d = n[hit], base[hit], d[hit]
        which = np.repeat(np.arange(len(n)), n)
        order = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        dart = _mix(base[which] + (order + 1).astype(_U) * _GOLDEN)
        place = d[which] * coordinates + (dart % _U(coordinates)).astype(np.int64)
        still = ~filled.ravel()[place]
        dart, place = dart[still], place[still]
        # The latest first, so that the earliest is what stays.
        late = np.argsort(dart >> _U(11), kind="stable")[::-1]
        best.ravel()[place[late]] = dart[late]
        filled.ravel()[place] = True
        active &= (high < enough) | ~filled.all(axis=1)
        low, high, band = high, high * 2, band + 1
    return best


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sorted arrays of regions."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


def _sketches(texts: DataFrame, bands: int, band_rows: int) -> DataFrame:
    coordinates = bands * band_rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            doc, region = regions(b.column("text").to_pylist())
            s = signatures(doc, region, b.num_rows, coordinates)
            weight = np.bincount(doc, minlength=b.num_rows)
            keys = np.zeros((b.num_rows, bands), dtype=_U)
            for k in range(bands):
                h = np.full(b.num_rows, k + 1, dtype=_U)
                for j in range(band_rows):
                    h = _mix(h * _GOLDEN + s[:, k * band_rows + j])
                keys[:, k] = h
            some = np.flatnonzero(weight)
            short = (s[some] >> _U(40)).astype("<u2")
            yield pa.RecordBatch.from_arrays(
                [b.column(ROW).take(pa.array(some)), pa.array(weight[some], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1) * bands, pa.int32()), pa.array(keys[some].view(np.int64).ravel())),
                 pa.array([x.tobytes() for x in short], pa.binary()), pa.array([x.tobytes() for x in (keys[some] >> _U(32)).astype("<u4")], pa.binary())],
                [ROW, "weight", "keys", "short", "codes"])

    return texts.select(ROW, "text").mapInArrow(run, f"{ROW} long, weight long, keys array<long>, short binary, codes binary")


def _checked(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose texts reach the similarity."""
    rows = stored(pairs.distinct(), "pairs")
    asked = rows.select(F.col("a").alias(ROW)).unionByName(rows.select(F.col("b").alias(ROW))).distinct()
    some = texts.join(asked, ROW, "left_semi").select(ROW, "text")
    some = stored(some, "paired-texts")
    both = rows.join(some.select(F.col(ROW).alias("b"), F.col("text").alias("tb")), "b").join(
        some.select(F.col(ROW).alias("a"), F.col("text").alias("ta")), "a").select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices([batch], "ta", 1_000_000):
                a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
                text = dict(zip(a, part.column("ta").to_pylist())) | dict(zip(b, part.column("tb").to_pylist()))
                ids = list(text)
                doc, region = regions([text[i] for i in ids])
                ends = np.searchsorted(doc, np.arange(len(ids) + 1))
                own = {i: region[ends[k]:ends[k + 1]] for k, i in enumerate(ids)}
                ok = np.array([similarity(own[x], own[y]) >= least for x, y in zip(a, b)], dtype=bool)
                keep = pa.array(np.flatnonzero(ok))
                yield pa.RecordBatch.from_arrays([part.column("a").take(keep), part.column("b").take(keep)], ["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def _regions_of(texts: DataFrame) -> DataFrame:
    """Sorted regions of each text as 4-byte numbers: two of a thousand agree by chance once in a thousand texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 500_000):
            doc, region = regions(b.column("text").to_pylist())
            ends = np.searchsorted(doc, np.arange(b.num_rows + 1))
            small = (region >> _U(32)).astype("<u4")
            parts = [small[ends[k]:ends[k + 1]].tobytes() for k in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column(ROW), pa.array(parts, pa.binary())], [ROW, "regions"])

    return texts.select(ROW, "text").mapInArrow(run, f"{ROW} long, regions binary")


def _across(members: DataFrame, facts: DataFrame, block: int, bands: int, band_rows: int, least: float) -> DataFrame:
    """Links between members of one bucket but of different components.

    Runs over pairs of blocks, so a task holds at most two blocks of members. A pair counts in the first bucket that it
    shares; the signatures rule out most (allowance: six standard deviations of the estimate), and what they leave is
    checked by the whole sets of regions, in the task. Members that a link has joined are not compared again. What leaves
    the task are stars that join linked members, not pairs.
    """
    n = bands * band_rows
    floor_ = least - 6 * math.sqrt(least * (1 - least) / n)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        side, band = pdf["_side"].to_numpy(), int(pdf["band"].iloc[0])
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        rows, comp, weight = pdf[ROW].to_numpy(), pdf["component"].to_numpy(), pdf["weight"].to_numpy()
        if len(np.unique(comp)) < 2:
            return _NO_LINKS
        short = np.frombuffer(b"".join(pdf["short"]), dtype="<u2").reshape(len(pdf), n)
        codes = np.frombuffer(b"".join(pdf["codes"]), dtype="<u4").reshape(len(pdf), bands)
        own = [np.frombuffer(r, dtype="<u4") for r in pdf["regions"]]
        _, ids = np.unique(np.concatenate(own), return_inverse=True)
        ends = np.cumsum([0] + [len(r) for r in own])
        mark = np.zeros(ids.max() + 1, dtype=np.int32)
        comp = comp.copy()
        found: tuple[list, list] = ([], [])
        for a in left:
            may = right[(comp[right] != comp[a]) & (rows[right] != rows[a])]
            if (side == 2).all():
                may = may[may > a]
            w = weight[may]
            may = may[(np.minimum(w, weight[a]) >= least * np.maximum(w, weight[a])) & ~(codes[may, :band] == codes[a, :band]).any(axis=1)]
            may = may[(short[may] == short[a]).mean(axis=1) >= floor_]
            if not len(may):
                continue
            mark[ids[ends[a]:ends[a + 1]]] = 1
            both = np.array([mark[ids[ends[x]:ends[x + 1]]].sum() for x in may])
            mark[ids[ends[a]:ends[a + 1]]] = 0
            may = may[both >= least * (weight[may] + weight[a] - both)]
            found[0].extend([a] * len(may))
            found[1].extend(may)
            comp[np.isin(comp, comp[may])] = comp[a]
        if not found[0]:
            return _NO_LINKS
        a, b = (np.array(x, dtype=np.int64) for x in found)
        root = stars(a, b, len(pdf))
        some = np.flatnonzero(root != np.arange(len(pdf)))
        return pd.DataFrame({"a": rows[root[some]], "b": rows[some]})

    full = in_blocks(members, "key", block).join(facts, ROW)
    return full.groupBy("key", "_i", "_j").applyInPandas(run, "a long, b long").distinct()


_NO_LINKS = pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})


def _components(texts: DataFrame, least: float, bands: int, band_rows: int, block: int) -> DataFrame:
    """node, component over texts that are all different: signatures, leaders, then blocks. Leaves one table behind."""
    sketch = stored(_sketches(texts, bands, band_rows), "sketches")
    keyed = sketch.select(ROW, "weight", F.posexplode("keys").alias("band", "key"))
    # One leader for each bucket, the same in all of a group's buckets, so a member meets few different ones.
    leaders = keyed.groupBy("key").agg(F.min(F.struct(ROW, "weight")).alias("l"), F.count("*").alias("m")).where("m > 1")
    led = stored(keyed.join(leaders.select("key", "l"), "key").select("key", "band", ROW, "weight", "l"), "buckets")
    near = (F.least("weight", "l.weight") >= least * F.greatest("weight", "l.weight")) & (F.col(ROW) != F.col(f"l.{ROW}"))
    links = _checked(led.where(near).select(F.col(f"l.{ROW}").alias("a"), F.col(ROW).alias("b")), texts, least)
    links = stored(links, "links")

    def labelled(members: DataFrame, links: DataFrame) -> DataFrame:
        """Members of buckets that are not joined yet. Two rounds join nearly all; a part too many costs a check, no link."""
        c = connected_components(links, rounds=2)
        at = members.select("key", "band", ROW, "weight").join(c, members[ROW] == c["node"], "left").drop("node").withColumn(
            "component", F.coalesce("component", ROW))
        open_ = at.groupBy("key").agg((F.min("component") != F.max("component")).alias("_open")).where("_open").select("key")
        return at.join(open_, "key", "left_semi")

    # Second leaders, drawn anew in each bucket: they join most of what the first left apart, at one check a member.
    left = stored(labelled(led, links), "apart")
    second = left.groupBy("key").agg(F.min(F.struct(F.xxhash64(ROW, "key").alias("h"), ROW, "component", "weight")).alias("l"))
    asked = left.join(second, "key").where((F.col("component") != F.col("l.component")) & (
        F.least("weight", "l.weight") >= least * F.greatest("weight", "l.weight")))
    more = _checked(asked.select(F.least(F.col(ROW), F.col(f"l.{ROW}")).alias("a"), F.greatest(F.col(ROW), F.col(f"l.{ROW}")).alias("b")), texts, least)
    links = stored(links.unionByName(more), "links")
    left = stored(labelled(left, links), "apart")
    some = left.select(ROW).distinct()
    whole = stored(_regions_of(texts.join(some, ROW, "left_semi")), "regions")
    facts = left.select(ROW, "component", "weight").distinct().join(sketch.select(ROW, "short", "codes"), ROW).join(whole, ROW)
    rest = stored(_across(left.select("key", "band", ROW), facts, block, bands, band_rows, least), "links")
    return stored(connected_components(links.unionByName(rest)), "components", keep=True)


def near_duplicates(docs: DataFrame, least: float = 0.8, bands: int = 32, band_rows: int = 6, block: int = 1_024,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of docs: the id column, class_id, kept, n_copies, and the row number.

    Two texts are linked when equal, or when the weighted Jaccard similarity of their five-word shingles (weight: how
    often a shingle occurs) is at least `least`; classes are what links join. class_id is the least id of the class and
    kept marks one row of each class: of those with that id, the first. n_copies: rows with this very text.

    Steps: equal texts collapse to one; signatures are cut into bands; in each bucket all members are checked against
    one leader, then what is left apart against a second; members still in different components are compared in blocks,
    so every pair that shares a bucket and may be similar has been checked by its whole texts or is joined already. A pair at the
    threshold is missed with probability (1 - least^band_rows)^bands, 6e-5 as set.

    Null texts are never linked. Empty texts are equal to each other; texts of one to four words are one shingle.
    Repeated rows are copies; a null id sorts last. An empty table gives an empty result. Other columns are not read.
    """
    return _classes(docs, least, bands, band_rows, block, id_col, text_col).drop("_k1", "_k2")


def _classes(docs: DataFrame, least: float, bands: int, band_rows: int, block: int, id_col: str, text_col: str) -> DataFrame:
    """near_duplicates, with the key of each text. Leaves no table behind that holds texts."""
    with scratch_scope(docs.sparkSession):
        rows = numbered(docs, {"id": F.col(f"`{id_col}`"), "text": F.col(f"`{text_col}`")}, "texts")
        hashed = stored(rows.select(ROW, "id", *text_key(F.col("text"))), "text-keys", keep=True)
        known = hashed.where("_k1 is not null")
        first = known.groupBy("_k1", "_k2").agg(F.min(F.struct(F.col("id").isNull().alias("no"), "id", ROW)).alias("f"), F.count("*").alias("n_copies"))
        copies = stored(first.select("_k1", "_k2", F.col(f"f.{ROW}").alias("rep"), F.col("f.id").alias("rep_id"), "n_copies"), "copies", keep=True)
        texts = rows.join(copies.select(F.col("rep").alias(ROW)), ROW, "left_semi")
        components = _components(texts, least, bands, band_rows, block)

    # Least id of each component over its representatives, each already the least of its copies.
    ids = copies.select(F.col("rep").alias(ROW), "rep_id")
    classed = ids.join(components, ids[ROW] == components["node"], "left").select(
        ids[ROW].alias("rep"), F.coalesce("component", ids[ROW]).alias("component"), "rep_id")
    top = classed.groupBy("component").agg(F.min(F.struct(F.col("rep_id").isNull().alias("no"), "rep_id", "rep")).alias("t"))
    classed = classed.join(top, "component").select("rep", F.col("t.rep_id").alias("class_id"), F.col("t.rep").alias("class_row"))
    of_copy = copies.join(classed, "rep").select("_k1", "_k2", "n_copies", "class_id", "class_row")
    out = known.join(of_copy, ["_k1", "_k2"]).select(
        F.col("id").alias(id_col), "class_id", (F.col(ROW) == F.col("class_row")).alias("kept"), "n_copies", ROW, "_k1", "_k2")
    alone = hashed.where("_k1 is null").select(F.col("id").alias(id_col), F.col("id").alias("class_id"), F.lit(True).alias("kept"),
                                               F.lit(1).cast("long").alias("n_copies"), ROW, "_k1", "_k2")
    return out.unionByName(alone)


def keep_one(docs: DataFrame, least: float = 0.8, bands: int = 32, band_rows: int = 6, block: int = 1_024,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that near_duplicates does not keep; columns as they came.

    Rows are told by id and text, so docs is read again and never copied. Of rows that repeat both, any one stays.
    """
    with scratch_scope(docs.sparkSession):
        found = _classes(docs, least, bands, band_rows, block, id_col, text_col).where("_k1 is not null")
        told = found.groupBy("_k1", "_k2", F.col(f"`{id_col}`").alias("_id")).agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
        odd = stored(told.where("not kept or n > 1").select("_k1", "_k2", "_id", "kept"), "not-kept", keep=True)
    odd = odd.select(*[F.col(c).alias(f"{c}_odd") for c in odd.columns])
    rows = docs.select(*text_key(F.col(f"`{text_col}`")), F.col(f"`{id_col}`").alias("_id"), *[F.col(f"`{c}`").alias(f"c_{c}") for c in docs.columns])
    same = (F.col("_k1") == F.col("_k1_odd")) & (F.col("_k2") == F.col("_k2_odd")) & F.col("_id").eqNullSafe(F.col("_id_odd"))
    out = [F.col(f"`c_{c}`").alias(c) for c in docs.columns]
    alone = rows.join(sent(odd), same, "left_anti").select(*out)
    repeated = rows.join(sent(odd.where("kept_odd")), same, "left_semi").groupBy("_k1", "_k2", "_id").agg(F.first(F.struct(*out)).alias("one"))
    return alone.unionByName(repeated.select("one.*"))
