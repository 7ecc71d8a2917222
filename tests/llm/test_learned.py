"""Learned operators next to plain versions written from their definitions, and the pipeline next to plain loops."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from arrearium.llm import language, quality, url_filter
from arrearium.llm.common import table

MASK = 0xFFFFFFFF


# --- language ------------------------------------------------------------------------------------

def plain_grams(text):
    """Hash buckets of all byte n-grams of 2, 3 and 4, as the definition has them."""
    data = [32 if b < 128 and not chr(b).isalpha() else b for b in ("  " + text.lower() + "  ").encode()]
    found, size = [], len(data)
    data += [32] * 3
    for n, k in ((2, 0), (3, 1), (4, 2)):
        for i in range(size):
            x = 0
            for b in data[i:i + n]:
                x = (x << 8 | b) & MASK
            found.append(((x * 0x9E3779B1 + (k * 0x85EBCA6B & MASK)) * 0xC2B2AE35 & MASK) >> 16)
    return found


def test_language_against_plain_codes(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.substring("text", 1, 400).alias("text"), "lang").limit(60)
    rows = docs.collect()
    model = language.train(spark.createDataFrame([tuple(r) for r in rows], "doc_id long, text string, lang string"))
    counts = defaultdict(Counter)
    for r in rows:
        if r.text is not None and r.lang is not None:
            counts[r.lang].update(plain_grams(r.text))
    names = sorted(counts)
    assert model.languages == names
    width = 1 << 16
    total = {lang: sum(counts[lang].values()) + 0.5 * width for lang in names}

    def share(lang, g):
        return (counts[lang][g] + 0.5) / total[lang]

    splits = [[1 if k >> i & 1 else -1 for i in range(len(names))] for k in range(1, 2 ** (len(names) - 1))]

    def weight(g, split):
        one = [share(lang, g) for lang, s in zip(names, split) if s > 0]
        two = [share(lang, g) for lang, s in zip(names, split) if s < 0]
        return math.log(sum(one) / len(one)) - math.log(sum(two) / len(two))

    texts = [r.text for r in rows if r.text][:12] + ["the of and to in", "x", "7 8 9"]
    got = dict(zip(texts, zip(*model.decide(texts))))
    for t in texts:
        if not any(map(str.isalpha, t)):
            assert got[t] == ("und", 0.0, False)
            continue
        grams = plain_grams(t)
        margins = [sum(weight(g, s) for g in grams) / (len(grams) / 3) for s in splits]
        losses = [sum(b * math.log1p(math.exp(-m * s[i])) for m, s, b in zip(margins, splits, model.bit_weight)) for i in range(len(names))]
        near = [math.exp(-(x - min(losses)) * 40.0 / len(splits)) for x in losses]
        assert got[t][0] == names[int(np.argmin(losses))]
        assert got[t][1] == pytest.approx(max(near) / sum(near), rel=1e-3)
        assert got[t][2] == (got[t][1] < 0.6)
    # A decision rests on its own text alone.
    assert all(model.decide([t]) == ([got[t][0]], pytest.approx([got[t][1]]), [got[t][2]]) for t in texts)


# --- quality -------------------------------------------------------------------------------------

def plain_statistics(text):
    t = text or ""
    raw, words = t.encode(), t.split()
    size = len(raw)
    upper, lower = sum(65 <= b <= 90 for b in raw), sum(97 <= b <= 122 for b in raw)
    digit, line, other = sum(48 <= b <= 57 for b in raw), raw.count(10), sum(b > 127 for b in raw)
    blank = sum(b < 128 and chr(b).isspace() for b in raw)
    stop = sum(chr(b) in ".,;:'-" for b in raw if b < 128)
    bar, letters = raw.count(124), upper + lower + other
    symbol = size - letters - digit - blank - stop - bar
    out = [math.log1p(size), 0, 0, upper / max(letters, 1), letters / max(size, 1), digit / max(size, 1), blank / max(size, 1), stop / max(size, 1),
           bar / max(size, 1), symbol / max(size, 1), other / max(size, 1), math.log1p(size / (line + 1)), 0, 0, 0, 0]
    if words:
        out[1], out[2] = math.log1p(len(words)), sum(map(len, words)) / len(words)
        out[12], out[13] = len(set(words)) / len(words), sum(a == b for a, b in zip(words, words[1:])) / len(words)
        out[14], out[15] = math.log1p(max(map(len, words))), float(t.rstrip()[-1] in ".!?")
    return out


def test_quality_statistics_against_plain_counts():
    texts = [None, "", "  ", "One two, two.", "ÄÖ z|z\n\tEnd!", "A-b 12 3x @#$ | \r\n q", "x" * 5_000 + " y"]
    np.testing.assert_allclose(quality.statistics(texts), [plain_statistics(t) for t in texts], rtol=1e-12)


def test_quality_against_plain_least_squares(spark):
    rng = np.random.default_rng(4)
    s = rng.normal(size=(900, len(quality.STATS)))
    y = (s[:, 0] + 0.5 * s[:, 3] ** 2 + rng.normal(size=900) * 0.3 > 0.4).astype(float)
    rows = [(i, [float(x) for x in v], float(t)) for i, (v, t) in enumerate(zip(s, y))]
    df = spark.createDataFrame(rows, "id long, s array<double>, y double").repartition(7)
    model = quality.train(df)
    calibrate = {r["id"] for r in df.where(F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("calibrate")), F.lit(4)) == 3).collect()}
    z = np.clip((s - s.mean(axis=0)) / s.std(axis=0), -8, 8)
    x = np.hstack([np.cos(z @ model.frequencies + model.phases) * np.sqrt(2 / 192), np.ones((900, 1))])
    fit = np.array([i not in calibrate for i in range(900)])
    # Ridge by least squares on stacked rows, no normal equations.
    root = np.sqrt(1e-3 * fit.sum() / 193)
    want = np.linalg.lstsq(np.vstack([x[fit], root * np.eye(193)]), np.concatenate([y[fit], np.zeros(193)]), rcond=None)[0]
    np.testing.assert_allclose(x @ model.weights, x @ want, atol=1e-6)
    # Calibration: non-decreasing, and a better fit to the held rows' bins than any other monotone step of a random search.
    assert (np.diff(model.levels) >= -1e-12).all()
    at = np.clip(((x[~fit] @ want + 0.5) / 2 * 2_048).astype(int), 0, 2_047)
    bins = sorted(set(at))
    n = np.array([0.5] + [(at == b).sum() for b in bins] + [0.5])
    t = np.array([1.0] + [y[~fit][at == b].mean() for b in bins] + [0.0])
    assert len(model.levels) == len(n)
    best = (n * (t - model.levels) ** 2).sum()
    for _ in range(200):
        other = np.sort(np.clip(model.levels + rng.normal(size=len(n)) * rng.choice([1e-3, 1e-2, 0.1]), 0, 1))
        assert (n * (t - other) ** 2).sum() >= best - 1e-9


# --- urls ----------------------------------------------------------------------------------------

def test_url_model_is_at_the_optimum(spark):
    """The gradient of the penalised loss, from plainly listed n-grams, is zero at the fitted weights."""
    from pyspark.ml.feature import HashingTF

    places = [(f"shop{k % 7}.com", f"/buy/{k}") for k in range(40)] + [(f"news{k % 5}.org", f"/read/{k}") for k in range(40)]
    rows = [(h, p, float(h.startswith("shop"))) for h, p in places]
    model = url_filter.train(spark.createDataFrame(rows, "host string, path string, label double"), buckets=1 << 12)
    tf = HashingTF(numFeatures=1 << 12, binary=True)

    def grams(text, tag):
        marked = "^" + text + "$"
        return {tag + marked[i:i + n] for n in (2, 3, 4) for i in range(len(marked) - n + 1)}

    x = np.zeros((len(rows), 1 << 12))
    for i, (h, p, _) in enumerate(rows):
        x[i, [tf.indexOf(g) for g in grams(h, "h") | grams(p, "p")]] = 1.0
    y, w = np.array([r[2] for r in rows]), model.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ w + model.intercept)))
    assert np.abs(x.T @ (p - y) / len(y) + 1e-3 * w).max() < 2e-3 and abs((p - y).mean()) < 2e-3
    assert ((p >= 0.5) == (y == 1)).all()


# --- pipeline ------------------------------------------------------------------------------------

def plain_words(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]


def shingles(text):
    w = text.lower().split()
    if not w:
        return Counter()
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if len(w) >= 5 else Counter([tuple(w)])


def similarity(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_pipeline_against_plain_loops(spark, tmp_path):
    import corpus_pipeline
    from tokenizers import Tokenizer

    from arrearium.llm.queries import tokenizer_path

    rng = np.random.default_rng(12)
    vocabulary = ["".join(rng.choice(list("abcdefghijklm"), rng.integers(2, 8))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choice(vocabulary, n))

    texts = {k: prose(int(rng.integers(20, 120))) for k in range(60)}
    texts |= {60: None, 61: "", 62: "12 34 -- 56", 63: texts[5], 64: texts[5] + " tail", 65: texts[6].upper(), 66: "one two"}
    base = prose(100).split()
    for k in range(67, 75):  # a group of near copies
        texts[k] = " ".join(base[:k - 60] + ["odd"] + base[k - 60:])
    item = prose(14)
    texts[75], texts[76] = prose(20) + " " + item + " " + prose(20), prose(10) + ", " + " ".join(item.split()[:9]) + " " + prose(10)
    texts[77] = prose(15) + " password = Abcdef123456789 " + prose(15)
    texts[78] = prose(15) + " 0123456789abcdef0123 " + prose(5)
    texts[79] = prose(1_500)
    rows = [(k, t, "xx" if k % 2 else "yy", f"src{k % 3}", len(t or "")) for k, t in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    kept = {k: t for k, t in texts.items() if t and any(map(str.isalpha, t))}
    sets = {k: shingles(t) for k, t in kept.items()}
    root = {k: k for k in kept}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in kept:
        for b in kept:
            if a < b and (kept[a] == kept[b] or similarity(sets[a], sets[b]) >= 0.8):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    kept = {k: t for k, t in kept.items() if find(k) == k}
    windows = {tuple(plain_words(item)[i:i + 10]) for i in range(len(plain_words(item)) - 9)}
    kept = {k: t for k, t in kept.items() if not any(tuple(plain_words(t)[i:i + 10]) in windows for i in range(len(plain_words(t)) - 9))}
    assert 76 in kept and 75 not in kept and 63 not in kept and 79 in kept and len([k for k in range(67, 75) if k in kept]) == 1
    kept[77] = re.sub(r"password = Abcdef123456789", "[SECRET]", kept[77])
    kept[78] = kept[78].replace("0123456789abcdef0123", "[SECRET]")

    stages, docs = {}, table(spark, str(tmp_path), "documents")
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/stage{n}")
        docs = stages[name] = spark.read.parquet(f"{tmp_path}/stage{n}")
    redacted = {r["doc_id"]: r for r in stages["secrets"].collect()}
    assert {k: r["text"] for k, r in redacted.items()} == kept
    assert all(r["n_chars"] == len(r["text"]) for r in redacted.values())
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = Counter(k for k in kept for _ in range(len(tokenizer.encode(kept[k], add_special_tokens=False).ids) + 1))
    got = Counter()
    for p in stages["pack"].collect():
        got[p["doc_id"]] += p["length"]
    assert got == want
