"""Hard negatives: score bounds from the mean and deviation of vector segments, refined step by step, then exact scores."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrearium.llm.common import ROW, numbered
from arrearium.llm.topk import finite, fitting, products, scaled
from arrearium.session import scratch_scope, stored

#: Segments of a vector at each step.
SEGMENTS = (1, 4, 16)
_LAST_ID = np.iinfo(np.int64).max


def summaries(x: np.ndarray, segments: tuple[int, ...] = SEGMENTS) -> np.ndarray:
    """Means of all segments at all steps, then their deviations, each times the root of its segment's length.

    The product of two vectors over a segment of length L is L times the product of the means, give or take L times the product
    of the deviations. More segments than components: the rest are empty and add nothing.
    """
    dims, means, deviations = x.shape[1], [], []
    for number in segments:
        ends = np.linspace(0, dims, number + 1).astype(int)
        for lo, hi in zip(ends[:-1], ends[1:]):
            part = x[:, lo:hi]
            mean = part.mean(axis=1) if hi > lo else np.zeros(len(x))
            means.append(mean * np.sqrt(hi - lo))
            deviations.append(np.sqrt(np.square(part - mean[:, None]).sum(axis=1)))
    return np.stack(means + deviations, axis=1)


def bounds(a: np.ndarray, b: np.ndarray, step: int, segments: tuple[int, ...] = SEGMENTS) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the products of all pairs from their summaries at one step, with an allowance for rounding."""
    first, width = sum(segments[:step]), segments[step]
    mean, dev = slice(first, first + width), slice(sum(segments) + first, sum(segments) + first + width)
    middle, reach = a[:, mean] @ b[:, mean].T, a[:, dev] @ b[:, dev].T
    size = np.sqrt(np.square(a[:, [0, sum(segments)]]).sum(axis=1))[:, None] * np.sqrt(np.square(b[:, [0, sum(segments)]]).sum(axis=1))[None]
    reach += 1e-9 * size + 1e-6
    return middle - reach, middle + reach


class Rows:
    """Rows of one tile as arrays."""

    def __init__(self, pdf: pd.DataFrame, dims: int) -> None:
        self.row, self.id, self.no_id = (pdf[c].to_numpy() for c in (ROW, "id", "no_id"))
        self.label = pdf["label"].to_numpy()
        self.x = np.frombuffer(b"".join(pdf["point"]), np.float64).reshape(len(pdf), dims)
        self.summary = np.frombuffer(b"".join(pdf["summary"]), np.float64).reshape(len(pdf), 2 * sum(SEGMENTS))

    def order(self, at: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Highest score first, ties to the smaller id, no id last, then the earlier row."""
        return np.lexsort((self.row[at], self.id[at], self.no_id[at], -score))


def _kth(lower: np.ndarray, may: np.ndarray, k: int) -> np.ndarray:
    """A score that k of each row's candidates reach for certain, else minus infinity."""
    if lower.shape[1] < k:
        return np.full(len(lower), -np.inf)
    return -np.partition(-np.where(may, lower, -np.inf), k - 1, axis=1)[:, k - 1]


def nearest(a: Rows, b: Rows, own: np.ndarray, other: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor, rows, scores): the k best among rows `other` of b for each of the anchors `own` of a, but itself."""
    may = a.row[own][:, None] != b.row[other][None]
    for step in range(len(SEGMENTS)):
        lower, upper = bounds(a.summary[own], b.summary[other], step)
        may &= upper >= _kth(lower, may, k)[:, None]
        left = may.any(axis=0)
        other, may = other[left], may[:, left]
    scores = products(a.x[own], b.x[other])
    for i, anchor in enumerate(own):
        at = np.flatnonzero(may[i])
        best = at[b.order(other[at], scores[i, at])[:k]]
        yield anchor, other[best], fitting(scores[i, best])


def within(a: Rows, b: Rows, own: np.ndarray, other: np.ndarray, high: np.ndarray, low: np.ndarray, k: int
           ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(anchor, window, rows, scores): the k best whose score lies in [low, high], for each window (column) of each anchor; low > high: none."""
    windows = [(high[own, j].astype(np.float64), low[own, j].astype(np.float64), low[own, j] <= high[own, j]) for j in range(high.shape[1])]
    for step in range(len(SEGMENTS)):
        lower, upper = bounds(a.summary[own], b.summary[other], step)
        may = np.zeros(lower.shape, dtype=bool)
        for top, bottom, some in windows:
            inside = (upper >= bottom[:, None]) & (lower <= top[:, None]) & some[:, None]
            certain = inside & (lower >= bottom[:, None]) & (upper <= top[:, None])
            may |= inside & (upper >= _kth(lower, certain, k)[:, None])
        other = other[may.any(axis=0)]
    scores = products(a.x[own], b.x[other])
    for i, anchor in enumerate(own):
        for j in range(high.shape[1]):
            at = np.flatnonzero((scores[i] >= low[anchor, j]) & (scores[i] <= high[anchor, j]))
            best = at[b.order(other[at], scores[i, at])[:k]]
            yield anchor, j, other[best], fitting(scores[i, best])


def _summarised(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [ROW, "id", "no_id", "label", "anchor"]
        for whole in batches:
            lengths = pc.list_value_length(whole.column("v")).to_numpy(zero_copy_only=False)
            for dims in np.unique(lengths):
                part = whole.take(pa.array(np.flatnonzero(lengths == dims)))
                x = part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, dims)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in names], pa.array(np.full(len(x), dims, np.int32)), pa.array([r.tobytes() for r in x], pa.binary()),
                     pa.array([r.tobytes() for r in summaries(x)], pa.binary())], [*names, "dims", "point", "summary"])

    return rows.mapInArrow(run, f"{ROW} long, id long, no_id boolean, label long, anchor boolean, dims int, point binary, summary binary")


def _tiled(anchors: DataFrame, rows: DataFrame, tiles: tuple[int, int], run, schema: str) -> DataFrame:
    """run(anchors, rows) for every tile of anchors with every tile of rows. Tiles are dealt by hash, whatever the labels."""
    def place(name: str, n: int) -> Column:
        return F.pmod(F.xxhash64(ROW), F.lit(n)).cast("int").alias(name)

    def every(name: str, n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)

    a = anchors.select("*", place("i", tiles[0])).select("*", every("j", tiles[1]))
    kept = [ROW, "id", "no_id", "label", "point", "summary"]  # under new names, as both sides come from one table
    b = rows.select(F.col("dims").alias("_dims"), place("_j", tiles[1]), *[F.col(c).alias(f"b_{c}") for c in kept]).select("*", every("_i", tiles[0]))

    def met(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        columns = [c.split()[0] for c in schema.split(", ")]
        found = list(run(int(key[0]), a, b.rename(columns={f"b_{c}": c for c in kept}))) if len(a) and len(b) else []
        return pd.concat(found) if found else pd.DataFrame({c: [] for c in columns})

    return a.groupBy("dims", "i", "j").cogroup(b.groupBy("_dims", "_i", "_j")).applyInPandas(met, schema)


_FOUND = "anchor_row long, row long, id long, no_id boolean, score long"


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 5, scale: float = 256.0,
                   tile: int = 4_096, anchor_tile: int = 512, id_col: str = "vec_id", embedding_col: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, and the row numbers of all three.

    Components become floor(scale * x), a score is the integer inner product with the anchor; the higher score comes first, ties
    go to the smaller id, a null id last, then to the earlier row. An anchor's positives are its first `positives` other rows
    of its label. For each, the negatives are the first `negatives` rows of other labels that score at least four fifths of it
    and at most as much; a positive below zero has none.

    Of each vector the means and deviations of 1, 4 and 16 segments are stored. Anchors meet all rows in tiles dealt by hash, so
    a label of a third of all rows is spread as any other. In a tile, bounds from whole vectors rule out most pairs, those
    from finer segments more; what is left is scored exactly. Only the first few of each anchor and tile leave it.

    Rows whose label or vector is null, or that hold null or non-finite components, take no part; zero vectors do. Vectors of
    different lengths do not meet. Repeated rows are rows of their own. Null is_anchor: no anchor. A scaled component of 2^53
    or more and a returned score beyond 64 bits are errors. An empty table gives no rows; other columns are not read but by is_anchor and label.
    """
    with scratch_scope(vectors.sparkSession):
        rows = numbered(vectors.where(finite(embedding_col) & label.isNotNull()), {
            "id": F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_LAST_ID)), "no_id": F.col(f"`{id_col}`").isNull(), "label": label.cast("long"),
            "anchor": F.coalesce(is_anchor, F.lit(False)), "v": scaled(embedding_col, scale)}, "vectors")
        rows = stored(_summarised(rows), "summaries")
        anchors = rows.where("anchor").drop("anchor")
        tiles = tuple(max(1, -(-df.count() // most)) for df, most in ((anchors, anchor_tile), (rows, tile)))

        def same(dims: int, a: pd.DataFrame, b: pd.DataFrame) -> Iterator[pd.DataFrame]:
            a, b = Rows(a, dims), Rows(b, dims)
            for name in np.intersect1d(a.label, b.label):
                for i, at, score in nearest(a, b, np.flatnonzero(a.label == name), np.flatnonzero(b.label == name), positives):
                    yield pd.DataFrame({"anchor_row": a.row[i], "row": b.row[at], "id": b.id[at], "no_id": b.no_id[at], "score": score})

        found = _tiled(anchors, rows, tiles, same, _FOUND)
        first = Window.partitionBy("anchor_row").orderBy(F.desc("score"), "no_id", "id", "row")
        best = stored(found.withColumn("at", F.row_number().over(first)).where(F.col("at") <= positives), "positives")
        scores = best.groupBy("anchor_row").agg(F.array_sort(F.collect_list(F.struct("at", "score"))).alias("s")).select(  # a few for each anchor
            F.col("anchor_row").alias(ROW), F.transform("s", lambda s: s["score"]).alias("high"))

        def others(dims: int, a: pd.DataFrame, b: pd.DataFrame) -> Iterator[pd.DataFrame]:
            high, low = np.full((len(a), positives), -1, np.int64), np.zeros((len(a), positives), np.int64)
            for i, s in enumerate(a["high"]):
                s = np.asarray(s, dtype=np.int64)
                high[i, :len(s)], low[i, :len(s)] = s, s - s // 5  # the least n with 5 n >= 4 s
            a, b = Rows(a, dims), Rows(b, dims)
            for name in np.unique(a.label):
                for i, j, at, score in within(a, b, np.flatnonzero(a.label == name), np.flatnonzero(b.label != name), high, low, negatives):
                    yield pd.DataFrame({"anchor_row": a.row[i], "at": j + 1, "row": b.row[at], "id": b.id[at], "no_id": b.no_id[at], "score": score})

        found = _tiled(anchors.join(scores, ROW), rows, tiles, others, _FOUND.replace("row long, row", "row long, at int, row"))
        first = Window.partitionBy("anchor_row", "at").orderBy(F.desc("score"), "no_id", "id", "row")
        found = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)

        def shown(name: str, no: str) -> Column:
            return F.when(~F.col(no), F.col(name))

        found = found.select("anchor_row", "at", "rank", shown("id", "no_id").alias("negative_id"), F.col("score").alias("negative_score"),
                             F.col("row").alias("negative_row"))
        best = best.select("anchor_row", "at", shown("id", "no_id").alias("positive_id"), F.col("score").alias("positive_score"),
                           F.col("row").alias("positive_row"))
        ids = anchors.select(F.col(ROW).alias("anchor_row"), shown("id", "no_id").alias("anchor_id"))
        out = found.join(best, ["anchor_row", "at"]).join(ids, "anchor_row")
        return stored(out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", "anchor_row", "positive_row",
                                 "negative_row"), "negatives", keep=True)
