"""Exact top-k inner products: cover trees over queries and data, searched together in pairs of blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrearium.llm.common import ROW, numbered
from arrearium.session import scratch_scope, stored

_EXACT = 2.0**53
_LAST_ID = np.iinfo(np.int64).max


def finite(embedding: str) -> Column:
    """Not null, no null or non-finite component."""
    e = F.col(f"`{embedding}`")
    return F.coalesce(e.isNotNull() & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def scaled(embedding: str, scale: float) -> Column:
    """floor(scale * x) of each component, a whole number held as double; an error from 2^53 on."""
    return F.transform(F.col(f"`{embedding}`").cast("array<double>"), lambda x: F.when(F.abs(x * scale) < _EXACT, F.floor(x * scale).cast(
        "double")).otherwise(F.raise_error(F.lit("a scaled component of 2^53 or more"))))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows of whole numbers, exact; what does not fit in a long is held at the limit, for fitting() to find."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if a.shape[1] * np.abs(a).max() * np.abs(b).max() < _EXACT:
        return (a @ b.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    return np.clip(whole(a) @ whole(b).T, -_LAST_ID, _LAST_ID).astype(np.int64)


def fitting(scores: np.ndarray) -> np.ndarray:
    """The scores that are returned; an error if one does not fit in a long."""
    if (np.abs(scores) == _LAST_ID).any():
        raise OverflowError("a score does not fit in a long")
    return scores


class CoverTree:
    """Nodes of a cover tree in breadth-first order, points in the order of its leaves.

    A node covers its points within `radius` of `center`; its children's centers are a net: further apart than the node's
    radius / base, and every point of the node is within that of its child's. Nodes of few points are leaves.
    """

    FIELDS = {"points": np.float64, "rows": np.int64, "ids": np.int64, "no_id": np.uint8, "centers": np.float64, "radius": np.float64,
              "start": np.int32, "end": np.int32, "child": np.int32, "children": np.int32}

    def __init__(self, dims: int, **arrays: np.ndarray) -> None:
        self.dims = dims
        for name in self.FIELDS:
            setattr(self, name, arrays[name])

    @classmethod
    def build(cls, points: np.ndarray, rows: np.ndarray, ids: np.ndarray, no_id: np.ndarray, leaf: int = 24, base: float = 1.3) -> CoverTree:
        middle = np.argmin(np.square(points - points.mean(axis=0)).sum(axis=1))
        queue = [(np.arange(len(points)), middle)]
        members: list[np.ndarray] = []
        center, radius, child, children = [], [], [], []
        while len(members) < len(queue):
            own, c = queue[len(members)]
            d = np.sqrt(np.square(points[own] - points[c]).sum(axis=1))
            members.append(own)
            center.append(c)
            radius.append(d.max())
            child.append(len(queue))
            if len(own) > leaf and radius[-1] > 0:
                within, owner, net = radius[-1] / base, np.zeros(len(own), np.int32), [c]
                while d.max() > within:  # the farthest next, until all are covered
                    net.append(own[np.argmax(d)])
                    new = np.sqrt(np.square(points[own] - points[net[-1]]).sum(axis=1))
                    nearer = new < d
                    owner[nearer], d = len(net) - 1, np.minimum(d, new)
                order = np.argsort(owner, kind="stable")
                cuts = np.searchsorted(owner[order], np.arange(1, len(net)))
                queue += list(zip(np.split(own[order], cuts), net))
            children.append(len(queue) - child[-1])
        # Points by leaf, leaves in depth-first order, so that every node's points are neighbours.
        start, end, order, at = np.zeros(len(queue), np.int32), np.zeros(len(queue), np.int32), [], 0
        stack = [(0, False)]
        while stack:
            n, left = stack.pop()
            if left:
                end[n] = at
                continue
            start[n] = at
            stack.append((n, True))
            if children[n]:
                stack += [(k, False) for k in range(child[n], child[n] + children[n])]
            else:
                order.append(members[n])
                at += len(members[n])
        o = np.concatenate(order)
        return cls(points.shape[1], points=points[o], rows=rows[o], ids=ids[o], no_id=no_id[o].astype(np.uint8), centers=points[np.array(center)],
                   radius=np.array(radius), start=start, end=end, child=np.array(child, np.int32), children=np.array(children, np.int32))

    def stored(self) -> dict:
        return {name: np.ascontiguousarray(getattr(self, name), kind).tobytes() for name, kind in self.FIELDS.items()}

    @classmethod
    def read(cls, row) -> CoverTree:
        a = {name: np.frombuffer(getattr(row, name), kind) for name, kind in cls.FIELDS.items()}
        dims, nodes = int(row.dims), len(a["radius"])
        return cls(dims, **a | {"points": a["points"].reshape(len(a["rows"]), dims), "centers": a["centers"].reshape(nodes, dims)})


_TREE = ", ".join(f"{name} binary" for name in CoverTree.FIELDS)


def at_most(q: np.ndarray, q_radius: np.ndarray, r: np.ndarray, r_radius: np.ndarray) -> np.ndarray:
    """Upper bounds of all inner products between two balls, by pairs of balls; never below the true ones."""
    lengths = np.sqrt(np.square(q).sum(axis=1))[:, None], np.sqrt(np.square(r).sum(axis=1))[None]
    far = q_radius[:, None], r_radius[None]
    size = (lengths[0] + far[0]) * (lengths[1] + far[1])
    return q @ r.T + lengths[0] * far[1] + lengths[1] * far[0] + far[0] * far[1] + 1e-9 * size + 1e-6


class Best:
    """The k best of each query so far, ties to the smaller id; `worst` is the kth score, or minus infinity."""

    def __init__(self, queries: CoverTree, k: int, floor: np.ndarray) -> None:
        self.q, self.k, self.floor = queries, k, floor
        self.held = [np.zeros((0, 4), np.int64)] * len(queries.rows)
        self.worst = floor.copy()

    def offer(self, i: int, score: np.ndarray, tree: CoverTree, at: np.ndarray) -> None:
        keep = (score >= self.worst[i]) & (tree.rows[at] != self.q.rows[i])
        if not keep.any():
            return
        at = at[keep]
        both = np.concatenate([self.held[i], np.stack([score[keep], tree.ids[at], tree.no_id[at], tree.rows[at]], axis=1)])
        self.held[i] = both[np.lexsort((both[:, 3], both[:, 1], both[:, 2], -both[:, 0]))[:self.k]]
        fitting(self.held[i][:, 0])
        if len(self.held[i]) == self.k:
            self.worst[i] = max(self.floor[i], self.held[i][-1, 0])


def search(q: CoverTree, r: CoverTree, best: Best, batch: int = 512) -> None:
    """Both trees at once. A pair of nodes goes when its bound is below the worst kth score of all queries below its query node."""
    stack = [(0, np.array([0]))]
    while stack:
        n, front = stack.pop()
        own = slice(q.start[n], q.end[n])
        leaf = q.children[n] == 0

        def bound(front: np.ndarray) -> np.ndarray:
            return at_most(q.centers[n:n + 1], q.radius[n:n + 1], r.centers[front], r.radius[front])[0]

        while True:
            upper = bound(front)
            keep = upper >= best.worst[own].min()
            front, upper = front[keep], upper[keep]
            # The wider side is opened first; below a query leaf, all data nodes.
            opened = (r.children[front] > 0) & (leaf | (r.radius[front] > q.radius[n]))
            if not opened.any():
                break
            deeper = [np.arange(r.child[x], r.child[x] + r.children[x]) for x in front[opened]]
            front = np.concatenate([front[~opened], *deeper])
        if not len(front):
            continue
        if not leaf:
            stack += [(x, front) for x in range(q.child[n], q.child[n] + q.children[n])]
            continue
        order = np.argsort(-upper, kind="stable")
        front, upper = front[order], upper[order]
        sizes = np.cumsum(r.end[front] - r.start[front])
        done = 0
        while done < len(front) and upper[done] >= best.worst[own].min():
            upto = max(done + 1, int(np.searchsorted(sizes, (sizes[done - 1] if done else 0) + batch)))
            at = np.concatenate([np.arange(r.start[x], r.end[x]) for x in front[done:upto]])
            scores = products(q.points[own], r.points[at])
            for i in range(len(scores)):
                best.offer(own.start + i, scores[i], r, at)
            done = upto


def spread(points: np.ndarray, number: int) -> np.ndarray:
    """Farthest-first points: the top of a cover tree over a sample."""
    chosen = [0]
    d = np.square(points - points[0]).sum(axis=1)
    while len(chosen) < number and d.max() > 0:
        chosen.append(int(np.argmax(d)))
        d = np.minimum(d, np.square(points - points[chosen[-1]]).sum(axis=1))
    return points[chosen]


def _placed(rows: DataFrame, pivots: int, sample: int) -> DataFrame:
    """rows (row, id, query, v) with dims and cell: the nearest pivot among points of a sample of at most `sample` rows."""
    some = rows.select("v").orderBy(F.xxhash64(ROW)).limit(sample).collect()
    by_dims: dict[int, list] = {}
    for x in some:
        by_dims.setdefault(len(x.v), []).append(x.v)
    tops = {d: spread(np.array(v, dtype=np.float64).reshape(len(v), d), pivots) for d, v in by_dims.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            lengths = pc.list_value_length(whole.column("v")).to_numpy(zero_copy_only=False)
            for dims in np.unique(lengths):
                part = whole.take(pa.array(np.flatnonzero(lengths == dims)))
                x = part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, dims)
                top = tops.get(int(dims), np.zeros((1, dims)))
                cell = np.argmin(np.square(top).sum(axis=1)[None] - 2 * (x @ top.T), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(ROW), part.column("id"), part.column("query"), pa.array(np.full(len(x), dims, np.int32)), pa.array(cell.astype(np.int32)),
                     pa.array([r.tobytes() for r in x], pa.binary())], [ROW, "id", "query", "dims", "cell", "point"])

    return stored(rows.mapInArrow(run, f"{ROW} long, id long, query boolean, dims int, cell int, point binary"), "placed")


def _trees(placed: DataFrame, block: int, name: str) -> DataFrame:
    """One tree for each part of a cell: (tree, dims, cell, part, ...); a cell of m rows is cut by hash into m / block parts."""
    sizes = placed.groupBy("dims", "cell").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    dealt = placed.join(sizes, ["dims", "cell"]).withColumn("part", F.pmod(F.xxhash64(ROW), F.col("parts")).cast("int")).drop("parts", "query")

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        dims = int(key[0])
        pdf = pdf.sort_values(ROW)
        points = np.frombuffer(b"".join(pdf["point"]), np.float64).reshape(len(pdf), dims)
        tree = CoverTree.build(points, *[pdf[c].to_numpy() for c in (ROW, "id", "no_id")])
        return pd.DataFrame([{"dims": dims, "cell": key[1], "part": key[2], **tree.stored()}])

    dealt = dealt.withColumns({"no_id": F.col("id").isNull(), "id": F.coalesce("id", F.lit(_LAST_ID))})
    built = dealt.groupBy("dims", "cell", "part").applyInPandas(
        build, f"dims int, cell int, part int, {_TREE}")
    return stored(built.withColumn("tree", F.xxhash64("dims", "cell", "part")), name)


_FOUND = f"tree long, {ROW} long, query_id long, no_query_id boolean, score long, vec_id long, no_id boolean, row long"


def _searched(pairs: DataFrame, queries: DataFrame, data: DataFrame, floors: DataFrame | None, k: int, chunks: int) -> DataFrame:
    """The k best of each query in each data tree of pairs (q, d). A task holds one data tree and a chunk of query trees."""
    spots = pairs.withColumn("chunk", F.pmod(F.xxhash64("q"), F.lit(chunks)).cast("int"))
    asked = queries.withColumnRenamed("tree", "q")
    asked = asked.join(floors, "q", "left") if floors is not None else asked.withColumn("floors", F.lit(None).cast("map<long,long>"))
    left = spots.join(asked, "q")
    right = spots.select("d", "chunk").distinct().join(data.withColumnRenamed("tree", "d"), "d")
    right = right.select(F.col("d").alias("_d"), F.col("chunk").alias("_chunk"), "dims", *CoverTree.FIELDS)

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        for tree in map(CoverTree.read, b.itertuples()):
            for row in a.itertuples():
                q = CoverTree.read(row)
                known = dict(row.floors) if row.floors is not None else {}
                best = Best(q, k, np.array([known.get(int(x), -np.inf) for x in q.rows], dtype=np.float64))
                search(q, tree, best)
                size = [len(h) for h in best.held]
                held, of = np.concatenate(best.held), np.repeat(np.arange(len(size)), size)
                out.append(pd.DataFrame({"tree": row.q, ROW: q.rows[of], "query_id": q.ids[of], "no_query_id": q.no_id[of] > 0, "score": held[:, 0],
                                         "vec_id": held[:, 1], "no_id": held[:, 2] > 0, "row": held[:, 3]}))
        return pd.concat(out) if out else pd.DataFrame({c.split()[0]: [] for c in _FOUND.split(", ")})

    return left.groupBy("d", "chunk").cogroup(right.groupBy("_d", "_chunk")).applyInPandas(run, _FOUND)


def _pairs(queries: DataFrame, data: DataFrame, floors: DataFrame, lot: int) -> DataFrame:
    """Pairs of trees (q, d) whose bound reaches the query tree's worst kth score; summaries meet in lots of about `lot` by `lot`."""
    def lots(n: int) -> int:
        return max(1, -(-n // lot))

    ql, dl = lots(queries.count()), lots(data.count())

    def summary(trees: DataFrame) -> DataFrame:
        return trees.select("tree", "dims", "cell", "part", F.substring("centers", F.lit(1), F.col("dims") * 8).alias("center"),
                            F.substring("radius", F.lit(1), F.lit(8)).alias("radius"))

    worst = floors.select(F.col("q").alias("tree"), "worst")
    q = summary(queries).join(worst, "tree", "left").withColumn("i", F.pmod(F.xxhash64("tree"), F.lit(ql)).cast("int"))
    q = q.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(dl - 1))))
    d = summary(data).withColumn("j", F.pmod(F.xxhash64("tree"), F.lit(dl)).cast("int"))
    d = d.select(F.explode(F.sequence(F.lit(0), F.lit(ql - 1))).alias("_i"), F.col("j").alias("_j"), F.col("dims").alias("_dims"), "tree", "cell", "part",
                 "center", "radius")

    def run(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        def balls(x: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
            return (np.frombuffer(b"".join(x["center"]), np.float64).reshape(len(x), int(key[0])), np.frombuffer(b"".join(x["radius"]), np.float64))

        may = at_most(*balls(a), *balls(b)) >= a["worst"].fillna(-np.inf).to_numpy(np.float64)[:, None]
        own = (a["cell"].to_numpy()[:, None] == b["cell"].to_numpy()[None]) & (b["part"].to_numpy() == 0)[None]
        i, j = np.nonzero(may & ~own)
        return pd.DataFrame({"q": a["tree"].to_numpy()[i], "d": b["tree"].to_numpy()[j]})

    return q.groupBy("dims", "i", "j").cogroup(d.groupBy("_dims", "_i", "_j")).applyInPandas(run, "q long, d long")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, pivots: int = 64, sample: int = 4_096, block: int = 1_024,
          group: int = 256, id_col: str = "vec_id", embedding_col: str = "embedding") -> DataFrame:
    """The k rows of highest integer inner product with each query: query_id, rank, vec_id, score, and the query's row number.

    Components become floor(scale * x). is_query marks the queries by the columns of vectors (null: none); candidates of a
    query are all rows but itself. Ties go to the smaller id, a null id last, then to the earlier row.

    Queries and rows are dealt to the cells of pivots (from a sample of at most `sample` rows, which steers the speed only);
    every part of a cell is one cover tree. Each query tree meets one data tree of its own cell first. Its worst kth score
    then rules out whole data trees by their roots, and within the trees pairs of nodes, by covering radii. Bounds carry
    an allowance for rounding; scores are exact.

    Vectors that are null or hold null or non-finite components take no part; zero and empty ones do. Vectors of different
    lengths do not meet. Repeated rows are rows of their own, as queries too. A scaled component of 2^53 or
    more and a returned score beyond 64 bits are errors. Fewer than
    k candidates: all. An empty table gives no rows; other columns are not read but by is_query.
    """
    with scratch_scope(vectors.sparkSession):
        rows = numbered(vectors.where(finite(embedding_col)), {
            "id": F.col(f"`{id_col}`").cast("long"), "query": F.coalesce(is_query, F.lit(False)), "v": scaled(embedding_col, scale)}, "vectors")
        placed = _placed(rows, pivots, sample)
        data, queries = _trees(placed, block, "data-trees"), _trees(placed.where("query"), group, "query-trees")
        chunks = max(1, queries.count() // 16)
        near = queries.select(F.col("tree").alias("q"), "dims", "cell").join(
            data.where("part = 0").select(F.col("tree").alias("d"), "dims", "cell"), ["dims", "cell"]).select("q", "d")
        first = stored(_searched(near, queries, data, None, k, chunks), "first")
        kth = first.groupBy("tree", ROW).agg(F.when(F.count("*") == k, F.min("score")).alias("kth"))
        held = kth.where("kth is not null").groupBy("tree").agg(  # at most as many as a query tree has points
            F.map_from_entries(F.collect_list(F.struct(ROW, "kth"))).alias("floors"), F.min("kth").alias("least"), F.count("*").alias("full"))
        sizes = queries.select("tree", F.expr("octet_length(rows) div 8").alias("queries"))
        floors = stored(held.join(sizes, "tree").select(F.col("tree").alias("q"), "floors", F.when(
            F.col("full") == F.col("queries"), F.col("least")).cast("double").alias("worst")), "floors")
        pairs = stored(_pairs(queries, data, floors, 1_024), "pairs")
        rest = _searched(pairs, queries, data, floors.select("q", "floors"), k, chunks)
        found = first.unionByName(rest)
        order = Window.partitionBy(ROW).orderBy(F.desc("score"), "no_id", "vec_id", "row")
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        return stored(ranked.select(F.when(~F.col("no_query_id"), F.col("query_id")).alias("query_id"), "rank",
                                    F.when(~F.col("no_id"), F.col("vec_id")).alias("vec_id"), "score", ROW), "top", keep=True)
