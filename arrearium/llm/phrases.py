"""Phrase collocations: an FM-index over word ids in each shard, phrases grown by interval extension, counts summed across shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrearium.llm.common import sent, slices
from arrearium.session import scratch_scope, stored

_BREAK = b"\n"
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0a\x0b\x0c\x0d\t", b"abcdefghijklmnopqrstuvwxyz" + _BREAK * 10 + b" ")


class _Ids(dict):
    """Ids of words in the order they are met; 0 is the break between pieces."""

    def __init__(self) -> None:
        super().__init__({_BREAK: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = new = len(self)
        return new


def word_ids(texts: list[bytes], ids: dict[bytes, int]) -> np.ndarray:
    """Ids of all words, a break wherever a piece or a text ends."""
    found = _BREAK.join(texts).translate(_FOLD).replace(_BREAK, b" \n ").split(b" ")
    return np.fromiter(map(ids.__getitem__, filter(None, found)), np.int32)


def transform(text: np.ndarray, depth: int) -> np.ndarray:
    """Burrows-Wheeler transform by the first `depth` symbols of each suffix: enough for phrases of so many words.

    Ranks of 1, 2, 4, ... symbols are refined by doubling, whatever the text repeats. text begins and ends with a break.
    """
    rank, span = text.astype(np.int64), 1
    while span < depth:
        follow = np.zeros_like(rank)
        follow[:-span] = rank[span:]
        rank = np.unique(rank * (rank.max() + 1) + follow, return_inverse=True)[1]
        span *= 2
    return text[np.argsort(rank, kind="stable") - 1]


def packed(ids: np.ndarray) -> bytes:
    """Compressed bytes by place value: the high ones are mostly zero."""
    return pa.compress(np.ascontiguousarray(ids.astype("<i4").view(np.uint8).reshape(-1, 4).T), codec="zstd", asbytes=True)


def unpacked(data: bytes | pa.Buffer, length: int) -> np.ndarray:
    planes = pa.decompress(data, decompressed_size=4 * length, codec="zstd")
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<i4").ravel()


class Index:
    """One direction of a shard's FM-index. A phrase is an interval of rows, `size` rows from `low`."""

    def __init__(self, bwt: np.ndarray) -> None:
        self.bwt, self.n, self.words = bwt.astype(np.int64), len(bwt), int(bwt.max(initial=0))
        # Rows of each symbol, symbol by symbol: a rank is a place in here.
        self.rows = np.sort(self.bwt * self.n + np.arange(self.n))
        self.first = np.concatenate([[0], np.cumsum(np.bincount(bwt))])

    def word(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.first[w], self.first[w + 1] - self.first[w]

    def step(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Where row goes as the symbol is put before the phrase."""
        return np.searchsorted(self.rows, symbol * self.n + row)

    def find(self, words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of phrases whose words are added one by one."""
        low, size = self.word(words[0])
        high = low + size
        for w in words[1:]:
            low, high = self.step(w, low), self.step(w, high)
        return low, high - low

    def extensions(self, low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(interval, symbol, occurrences, occurrences of lesser symbols there) of everything that stands before each interval's phrase."""
        at = np.repeat(np.arange(len(low)), size)
        rows = np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size) + low[at]
        radix = self.words + 1
        key, count = np.unique(at * radix + self.bwt[rows], return_counts=True)
        of, symbol = key // radix, key % radix
        upto = np.cumsum(count) - count
        return of, symbol, count, upto - (np.cumsum(size) - size)[of]


#: A word's number is the shard that met it first, times this, and its place there; a shard has fewer words.
_PLACES = 1 << 24


def _shards(docs: DataFrame, depth: int, shard_tokens: int) -> DataFrame:
    """Rows (shard, lang, words, counts, length, left, right): texts of one language met in one task, cut at about shard_tokens words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, done = TaskContext.get().partitionId() << 16, 0
        held: dict[str, tuple[_Ids, list[np.ndarray]]] = {}

        def shard(lang: str) -> pa.RecordBatch:
            nonlocal done
            ids, parts = held.pop(lang)
            text = np.concatenate([[0], *parts]).astype(np.int32)
            count = np.bincount(text, minlength=len(ids))
            order = np.concatenate([[0], 1 + np.argsort(-count[1:], kind="stable")])
            new = np.empty_like(order)
            new[order] = np.arange(len(order))
            text = new[text]
            if len(order) >= _PLACES or done >> 16:
                raise ValueError("too many words in a shard, or shards in a task")
            words = pa.array(list(ids), pa.binary()).take(pa.array(order[1:])).cast(pa.string())
            ends = pa.array([0, len(words)], pa.int32())
            done += 1
            return pa.RecordBatch.from_arrays([
                pa.array([base + done - 1]), pa.array([lang]), pa.ListArray.from_arrays(ends, words),
                pa.ListArray.from_arrays(ends, pa.array(count[order[1:]], pa.int64())), pa.array([len(text)], pa.int64()),
                pa.array([packed(transform(text, depth))], pa.binary()), pa.array([packed(transform(text[::-1], depth))], pa.binary())],
                ["shard", "lang", "words", "counts", "length", "left", "right"])

        for batch in batches:
            for part in slices([batch], "text"):
                langs, texts = np.array(part.column("lang").to_pylist(), dtype=object), part.column("text").cast(pa.binary())
                for lang in sorted(set(langs)):
                    ids, parts = held.setdefault(lang, (_Ids(), []))
                    parts.append(word_ids(texts.take(pa.array(np.flatnonzero(langs == lang))).to_pylist() + [b""], ids))
                    parts.append(np.zeros(1, np.int32))
                    if sum(map(len, parts)) >= shard_tokens:
                        yield shard(lang)
        for lang in sorted(held):
            yield shard(lang)

    return docs.mapInArrow(run, "shard long, lang string, words array<string>, counts array<long>, length long, left binary, right binary")


def _numbers(column: pa.Array, row: int, field: str) -> np.ndarray:
    return column[row].values.field(field).to_numpy(zero_copy_only=False)


def _known(batch: pa.RecordBatch, row: int) -> np.ndarray:
    """Number of each word of the shard in the order of its places, 0 for the break and for words that are not frequent."""
    place = _numbers(batch.column("known"), row, "place")
    numbers = np.zeros(place.max() + 1, np.int64)
    numbers[place] = _numbers(batch.column("known"), row, "id")
    return numbers


def _index(batch: pa.RecordBatch, row: int, side: str) -> Index:
    return Index(unpacked(batch.column(side)[row].as_buffer(), batch.column("length")[row].as_py()))


def _pieces(columns: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    rows = len(next(iter(columns.values())))
    for at in range(0, rows, 100_000):
        yield pa.RecordBatch.from_pydict({c: pa.array(v[at:at + 100_000]) for c, v in columns.items()})


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two words, both frequent: each frequent word is extended to the left."""
    for batch in batches:
        for row in range(batch.num_rows):
            index, numbers = _index(batch, row, "left"), _known(batch, row)
            w = np.flatnonzero(numbers)
            of, before, count, _ = index.extensions(*index.word(w))
            both = before < len(numbers)
            both[both] = numbers[before[both]] > 0
            of, before, count = of[both], before[both], count[both]
            yield from _pieces({"shard": np.full(len(count), batch.column("shard")[row].as_py()), "w1": numbers[before], "w2": numbers[w[of]], "n": count})


def _longer(most_words: int):
    """Three words and more, in which any two neighbours are a frequent pair: intervals in both directions, extended in turn.

    Pairs go out too, with their count in all shards, from the one shard that owns them.
    """
    def rows(ids: list[np.ndarray], count: np.ndarray) -> Iterator[pa.RecordBatch]:
        none = np.zeros(len(count), np.int64)
        yield from _pieces({**{f"w{k + 1}": ids[k] if k < len(ids) else none for k in range(most_words)}, "n": count})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                a, b, f = (_numbers(batch.column("pairs"), row, c) for c in ("w1", "w2", "f"))
                own = np.flatnonzero(f)
                yield from rows([a[own], b[own]], f[own])
                if most_words == 2:
                    continue
                # Put before a phrase in the text: left. Put after it, that is before the reversed phrase in the reversed text: right.
                left, right, numbers = _index(batch, row, "left"), _index(batch, row, "right"), _known(batch, row)
                places = np.argsort(numbers, kind="stable")
                ids = [places[np.searchsorted(numbers[places], x)] for x in (a, b)]
                radix = left.words + 1
                pairs = np.sort(ids[0] * radix + ids[1])
                low, size = left.find([ids[1], ids[0]])
                rlow, _ = right.find(ids)
                for n in range(3, most_words + 1):
                    onward = n % 2 == 1
                    index, mine, other = (right, rlow, low) if onward else (left, low, rlow)
                    of, symbol, count, lesser = index.extensions(mine, size)
                    ends = ids[-1][of] * radix + symbol if onward else symbol * radix + ids[0][of]
                    keep = np.isin(ends, pairs)
                    of, symbol, size, lesser = of[keep], symbol[keep], count[keep], lesser[keep]
                    # The interval in the other direction is cut by the same symbol: what is lesser lies before it.
                    mine, other = index.step(symbol, mine[of]), other[of] + lesser
                    low, rlow = (other, mine) if onward else (mine, other)
                    ids = [x[of] for x in ids]
                    ids = [*ids, symbol] if onward else [symbol, *ids]
                    if not len(symbol):
                        break
                    yield from rows([numbers[x] for x in ids], size)

    return run


def phrase_counts(docs: DataFrame, most_words: int = 4, least: int = 30, shard_tokens: int = 1_000_000, text_col: str = "text",
                  lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) of all phrases of 1 to most_words words that occur at least `least` times in a language, and
    (lang, n), all words of each language. Both are stored tables; run inside a scratch scope to have the rest removed.

    Each shard is indexed in both directions; only what every part of a phrase has in all shards together lets a shard look
    at longer ones: frequent words, then frequent pairs, come back to the shards that hold them. Words travel as numbers.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang")
    shards = stored(_shards(docs.select(text, lang), most_words, shard_tokens), "shards")
    met = shards.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w")).select(
        "shard", "lang", F.col("w.words").alias("word"), (F.col("at") + 1).alias("place"), F.col("w.counts").alias("n"))
    totals = stored(met.groupBy("lang").agg(F.sum("n").alias("n")), "totals", keep=True)
    # A shard has a word, and a pair, once: these groups are as long as there are shards.
    same, own = Window.partitionBy("word", "lang"), F.col("shard") * _PLACES + F.col("place")
    words = stored(met.withColumns({"f": F.sum("n").over(same), "id": F.min(own).over(same)}).where(F.col("f") >= least).select(
        "shard", "place", "id", F.when(F.col("id") == own, F.struct("lang", "word", "f")).alias("first")), "words")
    vocabulary = words.where("first is not null").select("id", "first.*")
    single = vocabulary.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("size"), "f")
    if most_words == 1:
        return stored(single, "phrases", keep=True), totals

    def given(side: str | list[str], **back: DataFrame) -> DataFrame:
        out = shards.select("shard", "length", *side)
        for name, rows in back.items():  # no more than the shard's own words and pairs
            out = out.join(rows.groupBy("shard").agg(F.collect_list(F.struct(*[c for c in rows.columns if c != "shard"])).alias(name)), "shard")
        return out

    known = words.select("shard", "place", "id")
    pairs = given(["left"], known=known).mapInArrow(_pairs, "shard long, w1 long, w2 long, n long")
    same = Window.partitionBy("w1", "w2")
    pairs = pairs.withColumns({"f": F.sum("n").over(same), "first": F.min("shard").over(same)}).where(F.col("f") >= least).select(
        "shard", "w1", "w2", F.when(F.col("shard") == F.col("first"), F.col("f")).otherwise(0).alias("f"))
    ids = [f"w{k + 1}" for k in range(most_words)]
    grown = given(["left", "right"], known=known, pairs=pairs).mapInArrow(_longer(most_words), ", ".join(f"{c} long" for c in ids) + ", n long")
    grams = stored(grown.groupBy(*ids).agg(F.sum("n").alias("f")).where(F.col("f") >= least), "grams")
    spelt = grams.select("*", F.posexplode(F.filter(F.array(*ids), lambda w: w > 0)).alias("at", "id")).join(vocabulary.select("id", "lang", "word"), "id")
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda w: w["word"])
    spelt = spelt.groupBy(*ids, "f").agg(F.first("lang").alias("lang"), in_order.alias("words"))
    many = spelt.select("lang", F.array_join("words", " ").alias("phrase"), F.size("words").alias("size"), "f")
    return stored(single.unionByName(many), "phrases", keep=True), totals


def _part(first: Column, last: Column | None = None) -> Column:
    """Words number first to last of the phrase, from 1."""
    w = F.split("phrase", " ")
    return F.array_join(F.slice(w, first, (F.size(w) if last is None else last) - first + 1), " ")


def collocations(docs: DataFrame, top: int = 2_000, most_words: int = 4, least: int = 30, covered_pct: int = 80, shard_tokens: int = 1_000_000,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The first `top` collocations of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), split into pieces at `.,;:!?` and line ends, and these into words at spaces and tabs. A
    candidate is a phrase of 2 to most_words words that occurs a >= least times within pieces. Cut after its first k words it
    has l = f(first part), r = f(rest), score = floor(2000000 a / (l + r)); the cut of least score counts, the smallest k on
    ties. Dropped is what lies inside a longer candidate that occurs in covered_pct per cent of a. Order: score and a
    descending, phrase ascending by bytes. Arithmetic is exact (38 digits).

    Null texts are empty, empty ones hold no phrase, a null language is 'und'. Very long texts are read whole; a shard ends
    with the text that fills it. Repeated rows count each time. An empty table gives no rows; other columns are not read.
    """
    with scratch_scope(docs.sparkSession):
        counts, totals = phrase_counts(docs, most_words, least, shard_tokens, text_col, lang_col)
        big = "decimal(20,0)"
        many = counts.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"))
        f = counts.select("lang", "phrase", "f")
        cuts = many.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
        cuts = cuts.withColumns({"lp": _part(F.lit(1), F.col("k")), "rp": _part(F.col("k") + 1)})
        cuts = cuts.join(f.select("lang", F.col("phrase").alias("lp"), F.col("f").alias("l")), ["lang", "lp"]).join(
            f.select("lang", F.col("phrase").alias("rp"), F.col("f").alias("r")), ["lang", "rp"])
        score = F.expr(f"(cast(2000000 as {big}) * cast(a as {big})) div (cast(l as {big}) + cast(r as {big}))")
        scored = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
        spots = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda m: F.transform(
            F.sequence(F.lit(1), F.col("size") - m + 1), lambda i: F.struct(i.alias("i"), m.alias("m")))))).alias("s")
        inside = many.where("size > 2").select("lang", "phrase", "a", "size", spots)
        inside = inside.select("lang", _part(F.col("s.i"), F.col("s.i") + F.col("s.m") - 1).alias("phrase"), "a")
        inside = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longest"))
        kept = scored.join(inside, ["lang", "phrase"], "left").where(
            F.col("longest").isNull() | (F.col("longest").cast(big) * 100 < F.col("a").cast(big) * covered_pct))
        kept = stored(kept.select("lang", "phrase", "a", "c.l", "c.r", "c.score", F.expr("c.score div 1000").alias("band")), "kept")
        # Only the bands of scores that the first `top` reach into are put in order.
        above = Window.partitionBy("lang").orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)  # a thousand bands at most
        bands = kept.groupBy("lang", "band").agg(F.count("*").alias("here")).withColumn("above", F.coalesce(F.sum("here").over(above), F.lit(0)))
        reached = sent(stored(bands.where(F.col("above") < top).select("lang", "band"), "bands"))
        first = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
        ranked = kept.join(reached, ["lang", "band"]).withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
        return stored(ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"),
                      "collocations", keep=True)
