"""Language identification with error-correcting output codes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from arrearium.llm.common import slices
from arrearium.session import stored

UNKNOWN = "und"
_BITS = 16  # n-grams are hashed to 2^16 buckets


def code_book(languages: int, seed: int = 1) -> np.ndarray:
    """A codeword of +1 and -1 for each language.

    Up to six languages: all splits of the languages in two, which puts the codewords as far apart as can be. More: random
    balanced columns, ten times as many as bits needed to tell the languages apart.
    """
    if languages <= 6:
        columns = [[1 if k >> i & 1 else -1 for i in range(languages)] for k in range(1, 2 ** max(languages - 1, 0))]
        return np.array(columns or [[1] * languages], dtype=np.float64).T.reshape(languages, max(1, len(columns)))
    rng = np.random.default_rng(seed)
    n = int(10 * np.ceil(np.log2(languages)))
    half = np.array([1] * (languages // 2) + [-1] * (languages - languages // 2), dtype=np.float64)
    return np.stack([rng.permutation(half) for _ in range(n)], axis=1)


def gram_buckets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each n-gram, where each text begins): bytes of the lower-cased text, in runs of two, three and four.

    Digits and ASCII punctuation count as blanks, so that mark-up and numbers say nothing. A run that reaches past its text's
    end goes on with blanks, whatever text comes next.
    """
    raw = [("  " + t.lower() + "  ").encode("utf-8", "replace") if t else b"    " for t in texts]
    joined = _BLANKED[np.frombuffer(b"".join([*raw, b"   "]), dtype=np.uint8)].astype(np.uint32)
    starts = np.cumsum([0] + [len(r) for r in raw])[:-1]
    two = joined[:-3] << np.uint32(8) | joined[1:-2]
    three = two << np.uint32(8) | joined[2:-1]
    four = three << np.uint32(8) | joined[3:]
    # Each text begins with two blanks, so only four bytes from a text's last one on could reach another's first letter.
    four[starts[1:] - 1] = 0x20202020
    shift = np.uint32(32 - _BITS)
    grams = [(x * np.uint32(0x9E3779B1) + np.uint32(k * 0x85EBCA6B & 0xFFFFFFFF)) * np.uint32(0xC2B2AE35) >> shift
             for k, x in enumerate((two, three, four))]
    return np.stack(grams, axis=1), starts


_BLANKED = np.arange(256, dtype=np.uint8)
_BLANKED[[b for b in range(128) if not chr(b).isalpha()]] = 32


def has_letters(text: str | None) -> bool:
    return bool(text) and (any(map(str.isalpha, text[:64])) or any(map(str.isalpha, text)))


@dataclass
class Model:
    """weights: bucket x bit, the log-odds of each binary classifier; bit_weight: how sure each is, as measured on what
    it learned from."""

    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    bit_weight: np.ndarray
    scale: float = 40.0

    def decide(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        """(language, score, ambiguous). Score: the share of the nearest codeword among all, 0 for UNKNOWN."""
        out: tuple[list, list, list] = ([], [], [])
        if not texts:
            return out
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts), [False] * len(texts)
        grams, starts = gram_buckets(texts)
        margins = self.weights[grams[:, 0]] + self.weights[grams[:, 1]] + self.weights[grams[:, 2]]
        sums = np.add.reduceat(margins, np.minimum(starts, len(margins) - 1), axis=0)
        lengths = np.diff(np.append(starts, len(grams)))
        margin = sums / lengths[:, None]
        # Logistic loss of each bit's margin against each codeword, weighted by the bit.
        loss = np.logaddexp(0.0, -margin[:, None, :] * self.codes[None]) @ self.bit_weight
        near = np.exp(-(loss - loss.min(axis=1, keepdims=True)) * self.scale / self.codes.shape[1])
        share = near / near.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        top = share[np.arange(len(texts)), best]
        ok = [has_letters(t) for t in texts]
        return ([self.languages[b] if o else UNKNOWN for b, o in zip(best, ok)], [float(s) if o else 0.0 for s, o in zip(top, ok)],
                [bool(o and len(self.languages) > 1 and s < AMBIGUOUS) for s, o in zip(top, ok)])


#: A decision whose nearest codeword has less than this share is flagged.
AMBIGUOUS = 0.6


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", smoothing: float = 0.5, most_languages: int = 1_000) -> Model:
    """Count n-grams by language over all labelled texts, then set every bit's classifier from the counts.

    Each task adds up dense counts by language and returns them once; the sums are languages x 2^16 numbers.
    Rows without text or language teach nothing; repeated rows count each time. More than most_languages different labels
    are an error, found before any count leaves the executors.
    """
    width = 1 << _BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for b in slices(batches, "text"):
            texts, langs = b.column("text").to_pylist(), b.column("lang").to_pylist()
            grams, starts = gram_buckets(texts)
            ends = np.append(starts[1:], len(grams))
            of = {lang: k for k, lang in enumerate(dict.fromkeys(langs))}
            codes = np.array([of[x] for x in langs])
            at = np.repeat(codes, np.maximum(ends - starts, 0))[:len(grams)]
            for lang, k in of.items():
                own = grams[at == k]
                counts.setdefault(lang, np.zeros(width, dtype=np.int64))
                counts[lang] += np.bincount(own.ravel(), minlength=width)
        for lang, c in counts.items():
            some = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some, pa.int32()), pa.array(c[some])], ["lang", "bucket", "n"])

    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null")
    counted = rows.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counted = stored(counted, "grams-by-language")
    names = counted.select("lang").distinct().limit(most_languages + 1).collect()
    if len(names) > most_languages:
        raise ValueError(f"more than {most_languages} languages; raise most_languages if that is meant")
    table = counted.toPandas()  # bounded: languages x buckets
    languages = sorted(r["lang"] for r in names)
    counts = np.zeros((len(languages), width))
    for k, lang in enumerate(languages):
        own = table[table["lang"] == lang]
        counts[k, own["bucket"].to_numpy()] = own["n"].to_numpy()
    codes = code_book(len(languages))
    if not languages:
        return Model([], codes, np.zeros((width, 1)), np.ones(1))
    share = (counts + smoothing) / (counts + smoothing).sum(axis=1, keepdims=True)
    weights = np.zeros((width, codes.shape[1]), dtype=np.float32)
    for bit in range(codes.shape[1]):
        one, two = share[codes[:, bit] > 0], share[codes[:, bit] < 0]
        if len(one) and len(two):
            weights[:, bit] = np.log(one.mean(axis=0)) - np.log(two.mean(axis=0))
    # How well each bit tells its languages apart: the least expected margin on the right side.
    expected = share @ weights * codes
    sure = np.maximum(expected.min(axis=0), 1e-3)
    return Model(languages, codes, weights, sure / sure.mean())


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> Column:
    """Column of structs (lang, score, ambiguous) from the whole text alone.

    Null texts and texts without letters are 'und' with score 0. Empty tables, repeated rows and clashing names are no
    matter: it is a function of one column.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2^16 x bits floats

    @pandas_udf("struct<lang: string, score: double, ambiguous: boolean>")
    def decide(texts):
        import pandas as pd

        parts, size, begin = [], 0, 0
        values = texts.tolist()
        for i, t in enumerate(values + [None]):
            if i == len(values) or size > 1_000_000:
                parts.append(sent.value.decide(values[begin:i]))
                begin, size = i, 0
            size += len(t or "")
        lang, score, doubt = (sum((list(p[k]) for p in parts), []) for k in range(3))
        return pd.DataFrame({"lang": lang, "score": score, "ambiguous": doubt})

    return decide(F.col(f"`{text_col}`"))


def lettered(text_col: str = "text") -> Column:
    """Whether a text has letters, as identify sees it; it needs no model. Null texts have none."""

    @pandas_udf("boolean")
    def some(texts: pd.Series) -> pd.Series:
        return texts.map(has_letters).astype(bool)

    return some(F.col(f"`{text_col}`"))
