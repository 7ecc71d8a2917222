"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearium.llm.common import slices
from arrearium.session import stored

STATS = [
    "log_chars", "log_words", "word_length", "upper_share", "letter_share", "digit_share", "blank_share", "stop_share", "bar_share",
    "symbol_share", "other_share", "line_length", "distinct_words", "repeated_next", "longest_word", "ends_in_stop"]

# Classes of bytes; bytes over 127 are letters of other scripts here.
_CLASS = np.full(256, 8, dtype=np.uint8)
for _b in range(128):
    _c = chr(_b)
    _CLASS[_b] = (0 if _c.isupper() else 1 if _c.islower() else 2 if _c.isdigit() else 3 if _c == "\n" else 4 if _c.isspace()
                  else 5 if _c in ".,;:'-" else 6 if _c == "|" else 7)
_CLASSES = 9


def statistics(texts: list[str | None]) -> np.ndarray:
    """One row of STATS for each text, null being empty; every number is finite."""
    raw = [(t or "").encode("utf-8", "replace") for t in texts]
    sizes = np.array([len(r) for r in raw])
    kinds = _CLASS[np.frombuffer(b"".join(raw), dtype=np.uint8)]
    at = np.repeat(np.arange(len(texts)), sizes) * _CLASSES + kinds
    n = np.bincount(at, minlength=len(texts) * _CLASSES).reshape(len(texts), _CLASSES).astype(np.float64)
    out = np.zeros((len(texts), len(STATS)))
    total = np.maximum(sizes, 1)
    letters = n[:, 0] + n[:, 1] + n[:, 8]
    for i, t in enumerate(texts):
        words = (t or "").split()
        w = len(words)
        if w:
            out[i, 1] = np.log1p(w)
            out[i, 2] = sum(map(len, words)) / w
            out[i, 12] = len(set(words)) / w
            out[i, 13] = sum(map(eq, words, words[1:])) / w
            out[i, 14] = np.log1p(max(map(len, words)))
            out[i, 15] = t.rstrip()[-1] in ".!?"
    out[:, 0] = np.log1p(sizes)
    out[:, 3] = n[:, 0] / np.maximum(letters, 1)
    for k, c in ((5, n[:, 2]), (4, letters), (6, n[:, 3] + n[:, 4]), (7, n[:, 5]), (8, n[:, 6]), (9, n[:, 7]), (10, n[:, 8])):
        out[:, k] = c / total
    out[:, 11] = np.log1p(sizes / (n[:, 3] + 1))
    return out


@dataclass
class Model:
    """Standardised statistics -> cosines at random frequencies -> ridge score -> isotonic steps."""

    mean: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray | None = None
    knots: np.ndarray | None = None
    levels: np.ndarray | None = None

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        d = self.frequencies.shape[1]
        return np.hstack([np.cos(z @ self.frequencies + self.phases) * np.sqrt(2.0 / d), np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(stats), self.levels[0])
        return np.clip(np.interp(self.raw(stats), self.knots, self.levels), 0.0, 1.0)


def pool_adjacent(y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Least-squares non-decreasing fit."""
    level, weight, size = [], [], []
    for v, c in zip(y, w):
        level.append(v), weight.append(c), size.append(1)
        while len(level) > 1 and level[-2] >= level[-1]:
            c = weight[-2] + weight[-1]
            level[-2:] = [(level[-2] * weight[-2] + level[-1] * weight[-1]) / c]
            weight[-2:], size[-2:] = [c], [size[-2] + size[-1]]
    return np.repeat(level, size)


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and s (array of STATS) of every document, from its whole text, written once."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            s = statistics(b.column("text").to_pylist())
            offsets = pa.array(np.arange(len(s) + 1) * len(STATS), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.ListArray.from_arrays(offsets, pa.array(s.ravel()))], ["id", "s"])

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return stored(rows.mapInArrow(run, f"id {id_type}, s array<double>"), "statistics")


def train(labelled: DataFrame, features: int = 192, gamma: float = 0.04, penalty: float = 1e-3, bins: int = 2_048, seed: int = 5) -> Model:
    """labelled: id, s, y (0.0 or 1.0). Three quarters by id hash set the ridge, the last quarter calibrates it.

    Every task adds up its part of the normal equations and returns the upper triangle once; Spark sums the parts, and
    one system of `features` unknowns is solved on the driver, whatever the number of rows. Calibration counts rows and
    positives in `bins` equal steps of the raw score and fits a non-decreasing line to them, with half a row of the
    other class added at either end, so no score is exactly 0 or 1. With labels of one class only, its share is the score of all; without labels 0.5.
    """
    rows = labelled.select("id", "s", F.col("y").cast("double").alias("y"), (F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("calibrate")), F.lit(4)) == 3).alias("c"))
    moments = rows.agg(F.count("*").alias("n"), F.sum("y").alias("y"), F.array(*[F.avg(F.col("s")[k]) for k in range(len(STATS))]).alias("m"),
                       F.array(*[F.stddev_pop(F.col("s")[k]) for k in range(len(STATS))]).alias("d")).first()
    rng = np.random.default_rng(seed)
    frequencies = rng.standard_normal((len(STATS), features)) * np.sqrt(2 * gamma)
    n = moments["n"]
    mean, scale = (np.array(moments["m"]), np.array(moments["d"])) if n else (np.zeros(len(STATS)), np.ones(len(STATS)))
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0), frequencies, rng.uniform(0, 2 * np.pi, features))
    if not n or moments["y"] in (0, n):
        model.levels = np.array([(moments["y"] or 0) + 0.5]) / (n + 1)
        return model
    sent, d = labelled.sparkSession.sparkContext.broadcast(model), features + 1

    def stats_of(b: pa.RecordBatch) -> np.ndarray:
        return b.column("s").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, len(STATS))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((d, d + 1))
        for b in batches:
            x = sent.value.features(stats_of(b))
            gram += x.T @ np.hstack([x, b.column("y").to_numpy(zero_copy_only=False)[:, None]])
        i, j = np.triu_indices(d, m=d + 1)
        if gram.any():
            yield pa.RecordBatch.from_arrays([pa.array(i * (d + 1) + j, pa.int32()), pa.array(gram[i, j])], ["k", "v"])

    fit = rows.where("not c").select("s", "y")
    sums = fit.mapInArrow(add_up, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).toPandas()  # d * (d + 3) / 2 numbers
    gram = np.zeros((d, d + 1))
    gram.ravel()[sums["k"].to_numpy(dtype=np.int64)] = sums["v"].to_numpy()
    a = np.triu(gram[:, :d]) + np.triu(gram[:, :d], 1).T
    model.weights = np.linalg.solve(a + penalty * max(a[-1, -1], 1.0) / d * np.eye(d), gram[:, d])
    fitted = labelled.sparkSession.sparkContext.broadcast(model)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.clip(((fitted.value.raw(stats_of(b)) + 0.5) / 2 * bins).astype(int), 0, bins - 1)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), b.column("y")], ["b", "y"])

    held = rows.where("c").select("s", "y")
    counts = held.mapInArrow(binned, "b int, y double").groupBy("b").agg(F.count("*").alias("n"), F.sum("y").alias("y")).toPandas().sort_values("b")
    b, w, y = (counts[k].to_numpy(dtype=np.float64) for k in ("b", "n", "y"))
    b, w, y = np.concatenate([[-1], b, [bins]]), np.concatenate([[0.5], w, [0.5]]), np.concatenate([[0.5], y, [0.0]])
    model.knots, model.levels = (b + 0.5) / bins * 2 - 0.5, pool_adjacent(y / w, w)
    return model


def score_quality(docs: DataFrame, labels: DataFrame, learn_from, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality") -> DataFrame:
    """id, score (0 to 1, higher: label 1 likelier) and predicted (1 where score >= threshold) of every document.

    learn_from: condition on the id column; only labels of rows that meet it are learned from. A null label teaches
    nothing; any label but 1 counts as 0; a repeated label counts as often as it occurs. Null text is empty text;
    repeated rows are scored each; an empty table gives an empty result; columns other than id and text are not read.
    """
    stats = document_statistics(docs, id_col, text_col)
    marks = labels.where(learn_from(F.col(f"`{id_col}`")) & F.col(f"`{label_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").alias("id"), (F.col(f"`{label_col}`") == 1).cast("double").alias("y"))
    model = train(stored(stats.join(marks, "id"), "labelled"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("s").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, len(STATS))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(sent.value.score(x))], ["id", "score"])

    scored = stats.mapInArrow(run, f"id {stats.schema['id'].dataType.simpleString()}, score double")
    return scored.select(F.col("id").alias(id_col), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
