"""Phrase mining, top-k search and hard negatives next to plain versions: nulls, empty inputs, ties, repeats, clashing names."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from arrearium.llm import negatives, phrases, topk

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_collocations(rows, most, least, top, covered=80):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(FOLD)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for m in range(1, most + 1):
                f[lang].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = {p[i:i + m] for p, a in found.items() for m in range(2, len(p)) for i in range(len(p) - m + 1) if 100 * a >= covered * found[p[i:i + m]]}
        scored = []
        for p in found.keys() - inside:
            score, k = min((2_000_000 * found[p] // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -found[p], " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(scored)[:top])]
    return sorted(out)


TEXTS = [("a b c d. A B c D", "x"), ("b c\ta b c; d a\x0bb", "x"), (None, "x"), ("", None), ("É é É é É", None), ("a a a a a a a", "x"), ("a a a a a a a", "x"),
         ("  ..;; \r\n", "y"), ("lone", "z"), ("ü x y ü x y ü x y", "z"), (" ".join(["p q r"] * 3_000), None), (" ".join("w%d" % (i % 7) for i in range(500)), "x")]


@pytest.mark.parametrize("most,least,top,tokens", [(4, 2, 2_000, 1_000_000), (4, 3, 5, 10), (2, 2, 100, 50), (1, 2, 100, 50), (6, 2, 300, 200)])
def test_collocations(spark, most, least, top, tokens):
    df = spark.createDataFrame([(t, l, 1, 2, 3) for t, l in TEXTS], "text string, lang string, phrase int, n int, shard int").repartition(3)
    got = phrases.collocations(df, top=top, most_words=most, least=least, shard_tokens=tokens).collect()
    assert sorted(tuple(r) for r in got) == plain_collocations(TEXTS, most, least, top)


def test_collocations_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = phrases.collocations(docs, least=8, shard_tokens=5_000).collect()
    assert sorted(tuple(r) for r in got) == plain_collocations([(r.text, r.lang) for r in docs.collect()], 4, 8, 2_000)


def test_collocations_of_nothing(spark):
    none = spark.createDataFrame([], "text string, lang string")
    assert phrases.collocations(none).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert phrases.collocations(none).count() == 0


def test_index_counts_and_extends():
    rng = np.random.default_rng(3)
    text = np.concatenate([[0], rng.integers(0, 5, 400), [0]]).astype(np.int32)
    left = phrases.Index(phrases.unpacked(phrases.packed(phrases.transform(text, 4)), len(text)))
    grams = Counter(tuple(text[i:i + 3]) for i in range(len(text) - 2))
    for core in [(1, 2), (4, 4), (3, 1)]:
        low, size = left.find([np.array([core[1]]), np.array([core[0]])])
        of, symbol, count, lesser = left.extensions(low, size)
        assert {int(s): int(n) for s, n in zip(symbol, count) if s} == {g[0]: n for g, n in grams.items() if g[1:] == core and g[0]}
        assert lesser.tolist() == [0, *np.cumsum(count)[:-1].tolist()]


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 1.0, 2) for r in rows], "vec_id long, embedding array<double>, label int, score double, rank int")


def some_vectors(n, dims=9, seed=1, labels=4):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(6, dims))
    x = middle[rng.integers(0, 6, n)] + rng.normal(size=(n, dims)) * 0.2
    rows = [(i, [float(c) for c in v], int(rng.integers(0, labels))) for i, v in enumerate(x)]
    rows += [(i, [0.25] * dims, 0) for i in range(n, n + 40)]  # ties
    rows += [(50, rows[50][1], rows[50][2]), (50, rows[50][1], rows[50][2])]  # repeats
    rows += [(n + 50, None, 1), (n + 51, [1.0] * (dims - 1) + [None], 1), (n + 52, [1.0] * (dims - 1) + [math.nan], 1),
             (n + 100, [math.inf] * dims, 1), (n + 53, [0.0] * dims, 2), (n + 54, [1.0, 2.0], 2), (0, [2.0, 1.0], None), (None, [3.0] * dims, 3),
             (n + 200, [], 1), (100, [0.5] * dims, None), (n + 55, [1e9] * dims, 1)]
    return rows


def scaled(rows):
    return [(i, [math.floor(256 * c) for c in v], label) for i, v, label in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def order(row, score):
    return (-score, row[0] is None, row[0] or 0)


@pytest.mark.parametrize("block,group,pivots", [(4_096, 256, 64), (37, 5, 3), (200, 1, 1)])
def test_top_k(spark, block, group, pivots):
    rows = some_vectors(300)
    got = topk.top_k(vectors(spark, rows), F.col("vec_id") % 10 == 0, k=5, block=block, group=group, pivots=pivots).drop("_row_").collect()
    kept, want = scaled(rows), []
    for a, q in enumerate(kept):
        if q[0] is not None and q[0] % 10 == 0:
            found = sorted(order(c, dot(q[1], c[1])) + (c[0],) for b, c in enumerate(kept) if b != a and len(c[1]) == len(q[1]))[:5]
            want += [(q[0], k + 1, f[3], -f[0]) for k, f in enumerate(found)]
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))


def test_top_k_edges(spark):
    none = vectors(spark, some_vectors(60)).limit(0)
    assert topk.top_k(none, F.col("vec_id") >= 0).count() == 0
    few = vectors(spark, [(1, [1.0], 1), (2, [1.0], 1), (3, None, None)])
    assert sorted(tuple(r)[:4] for r in topk.top_k(few, F.lit(True)).collect()) == [(1, 1, 2, 65536), (2, 1, 1, 65536)]
    assert topk.top_k(few, F.lit(None).cast("boolean")).count() == 0
    huge = vectors(spark, [(1, [2.0**40], 1), (2, [2.0**40], 1)])
    with pytest.raises(Exception, match="does not fit in a long"):
        topk.top_k(huge, F.lit(True)).count()
    big = vectors(spark, [(1, [2.0**36 + 1, 2.0], 1), (2, [2.0**10 + 2.0**-8, 3.0], 1)])  # beyond 53 bits, within 63
    want = (2**44 + 256) * (2**18 + 1) + 512 * 768
    assert {r["score"] for r in topk.top_k(big, F.lit(True)).collect()} == {want}


def test_cover_tree_holds_its_law():
    x = np.random.default_rng(5).normal(size=(700, 6)).round(1)
    tree = topk.CoverTree.build(x, np.arange(700), np.arange(700), np.zeros(700, bool), leaf=4)
    assert sorted(tree.rows) == list(range(700))
    for n in range(len(tree.radius)):
        far = np.sqrt(np.square(tree.points[tree.start[n]:tree.end[n]] - tree.centers[n]).sum(axis=1))
        assert np.isclose(far.max(), tree.radius[n])
        kids = np.arange(tree.child[n], tree.child[n] + tree.children[n])
        if len(kids):
            assert tree.radius[kids].max() <= tree.radius[n] / 1.3 + 1e-9
            apart = np.sqrt(np.square(tree.centers[kids][:, None] - tree.centers[kids][None]).sum(axis=2)) + np.eye(len(kids)) * 9e9
            assert apart.min() > tree.radius[n] / 1.3 - 1e-9


def test_search_prunes():
    """Far clusters are never scored."""
    rng = np.random.default_rng(2)
    x = np.concatenate([c * 10 + rng.normal(size=(500, 4)) * 0.1 for c in np.eye(4)])
    tree = topk.CoverTree.build(x, np.arange(2_000), np.arange(2_000), np.zeros(2_000, bool))
    q = topk.CoverTree.build(x[:20], np.arange(20), np.arange(20), np.zeros(20, bool))
    scored = []
    exact, topk.products = topk.products, lambda a, b: scored.append(len(a) * len(b)) or exact(a, b)
    try:
        topk.search(q, tree, topk.Best(q, 5, np.full(20, -np.inf)), batch=64)
    finally:
        topk.products = exact
    assert sum(scored) < 20 * 1_000


def plain_negatives(rows, anchor, k=5):
    kept, out = [r for r in scaled(rows) if r[2] is not None], []
    for a, q in enumerate(kept):
        if q[0] is None or not anchor(q[0]):
            continue
        others = [(c, dot(q[1], c[1])) for b, c in enumerate(kept) if b != a and len(c[1]) == len(q[1])]
        for p, ps in sorted(((c, s) for c, s in others if c[2] == q[2]), key=lambda x: order(*x))[:k]:
            found = sorted(((c, s) for c, s in others if c[2] != q[2] and 80 * ps <= 100 * s <= 100 * ps), key=lambda x: order(*x))[:k]
            out += [(q[0], p[0], i + 1, c[0], ps, s) for i, (c, s) in enumerate(found)]
    return sorted(map(str, out))


@pytest.mark.parametrize("tile,anchor_tile", [(4_096, 512), (50, 7)])
def test_hard_negatives(spark, tile, anchor_tile):
    rows = some_vectors(300, labels=3)
    got = negatives.hard_negatives(vectors(spark, rows), F.col("vec_id") % 10 == 0, F.col("label"), tile=tile, anchor_tile=anchor_tile)
    assert sorted(str(tuple(r)[:6]) for r in got.collect()) == plain_negatives(rows, lambda i: i % 10 == 0)


def test_hard_negative_edges(spark):
    none = vectors(spark, some_vectors(60)).limit(0)
    assert negatives.hard_negatives(none, F.lit(True), F.col("label")).count() == 0
    # A negative at four fifths exactly, one just below, one above the positive, and a positive below zero.
    rows = [(1, [1.0, 0.0], 1), (2, [10 / 256, 0.0], 1), (3, [8 / 256, 0.0], 2), (4, [7.99 / 256, 0.0], 2), (5, [11 / 256, 0.0], 2), (6, [-1.0, 0.0], 1)]
    got = negatives.hard_negatives(vectors(spark, rows), F.col("vec_id") == 1, F.col("label")).collect()
    assert [tuple(r)[:6] for r in got] == [(1, 2, 1, 3, 2560, 2048)]


def test_bounds_hold_at_every_step():
    rng = np.random.default_rng(8)
    for dims in (1, 3, 16, 64):
        a, b = (np.floor(rng.normal(size=(40, dims)) * 300) for _ in range(2))
        true = a @ b.T
        wide = []
        for step in range(len(negatives.SEGMENTS)):
            lower, upper = negatives.bounds(negatives.summaries(a), negatives.summaries(b), step)
            assert (lower <= true).all() and (upper >= true).all()
            wide.append((upper - lower).mean())
        assert wide == sorted(wide, reverse=True)
