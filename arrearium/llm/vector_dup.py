"""Near-duplicate vectors: Euclidean p-stable hashing in several tables, then exact cosine checks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrearium.llm.common import ROW, connected_components, in_blocks, numbered, stars
from arrearium.session import stored


def projections(dims: int, tables: int, hashes: int, width: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, dims])
    return rng.standard_normal((dims, tables * hashes)), rng.uniform(0, width, tables * hashes)


def bucket_keys(unit: np.ndarray, labels: np.ndarray, tables: int, hashes: int, width: float, seed: int) -> np.ndarray:
    """Key of each unit vector's bucket in each table; label and table are part of the key."""
    a, b = projections(unit.shape[1], tables, hashes, width, seed)
    cells = np.floor((unit @ a + b) / width).astype(np.int64).astype(np.uint64).reshape(len(unit), tables, hashes)
    key = labels.astype(np.int64).astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(1, tables + 1, dtype=np.uint64)[None]
    for j in range(hashes):
        key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + cells[:, :, j] * np.uint64(0x94D049BB133111EB)
    return (key ^ (key >> np.uint64(32))).view(np.int64)


def usable(embedding: str) -> Column:
    """Not null, no null or non-finite component, not all zeros."""
    e = F.col(f"`{embedding}`")
    fine = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(e.isNotNull() & fine & F.exists(e, lambda x: x != 0), F.lit(False))


def near_vectors(vectors: DataFrame, least: float = 0.98, tables: int = 18, hashes: int = 8, width: float = 1.6, seed: int = 7,
                 block: int = 1_024, id_col: str = "vec_id", embedding_col: str = "embedding", label_col: str | None = "label") -> DataFrame:
    """A row for each row of vectors: id, n_links (other rows linked directly), component_id, kept.

    Rows are linked if their labels are equal and not null (label_col=None: all are compared) and the cosine of their
    vectors, in double precision, is at least `least`. Unit vectors at that cosine lie within sqrt(2 - 2 least) of each
    other; as set, such a pair shares no bucket in any table with probability below 1e-4.

    Buckets of any size are worked in pairs of blocks of about `block` vectors, so no task holds a large group and no
    pair leaves it: what leaves is a count for each vector and a spanning forest of each block pair's links. A pair that
    shares several buckets counts in the first table only: the keys of earlier tables are compared along with the cosine.
    Vectors that are null, zero, or hold null or non-finite components link with nothing; vectors of different lengths
    do not link. Repeated rows are rows of their own and link. component_id is the least id reachable, kept is
    id = component_id. Empty tables give empty results; other columns are not read.
    """
    label = F.lit(0).cast("long") if label_col is None else F.xxhash64(F.col(f"`{label_col}`").cast("string"))
    labelled = F.lit(True) if label_col is None else F.col(f"`{label_col}`").isNotNull()
    rows = numbered(vectors, {"id": F.col(f"`{id_col}`"), "label": label, "use": usable(embedding_col) & labelled,
                              "v": F.col(f"`{embedding_col}`").cast("array<double>")}, "vectors")

    def hash_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in (whole.slice(i, 4096) for i in range(0, whole.num_rows, 4096)):
                lengths = pc.list_value_length(b.column("v")).to_numpy(zero_copy_only=False)
                for dims in np.unique(lengths):
                    own = np.flatnonzero(lengths == dims)
                    part = b.take(pa.array(own))
                    x = part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(len(own), dims)
                    big = np.abs(x).max(axis=1, keepdims=True)
                    x = x / big
                    x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
                    labels = part.column("label").to_numpy(zero_copy_only=False) * 1_000_003 + dims
                    keys = bucket_keys(x, labels, tables, hashes, width, seed)
                    offsets = pa.array(np.arange(len(own) + 1) * tables, pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [part.column(ROW), pa.array(labels), pa.array([r.tobytes() for r in x], pa.binary()), pa.array([k.tobytes() for k in keys], pa.binary()),
                         pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))], [ROW, "label", "unit", "codes", "keys"])

    hashed = stored(rows.where("use").select(ROW, "label", "v").mapInArrow(
        hash_all, f"{ROW} long, label long, unit binary, codes binary, keys array<long>"), "hashed")
    members = hashed.select(ROW, F.posexplode("keys").alias("table", "key"))
    dealt = in_blocks(members, "key", block)
    full = dealt.join(hashed.select(ROW, "label", "unit", "codes"), ROW)

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["label"].nunique() > 1 or pdf["table"].nunique() > 1:  # keys that are equal by chance
            return pd.concat([compare_equal(p) for _, p in pdf.groupby(["label", "table"])])
        return compare_equal(pdf)

    def compare_equal(pdf: pd.DataFrame) -> pd.DataFrame:
        side, at = pdf["_side"].to_numpy(), int(pdf["table"].iloc[0])
        ids = pdf[ROW].to_numpy()
        x = np.frombuffer(b"".join(pdf["unit"]), dtype=np.float64).reshape(len(pdf), -1)
        codes = np.frombuffer(b"".join(pdf["codes"]), dtype=np.int64).reshape(len(pdf), tables)
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        cos = x[left] @ x[right].T
        i, j = np.nonzero(cos >= least)
        a, b = left[i], right[j]
        once = a < b if (side == 2).all() else ids[a] != ids[b]
        a, b = a[once], b[once]
        new = np.ones(len(a), dtype=bool)
        for t in range(at):
            new &= codes[a, t] != codes[b, t]
        a, b = a[new], b[new]
        if not len(a):
            return _NONE
        n = np.bincount(a, minlength=len(pdf)) + np.bincount(b, minlength=len(pdf))
        # Every vector takes the least member of its block pair's component: links enough to join them, not all pairs.
        root = stars(a, b, len(pdf))
        some = np.flatnonzero(n)
        return pd.DataFrame({"a": ids[some], "b": ids[root[some]], "n": n[some]})

    links = stored(full.groupBy("key", "_i", "_j").applyInPandas(compare, "a long, b long, n long"), "links")
    counts = links.groupBy(F.col("a").alias(ROW)).agg(F.sum("n").alias("n_links"))
    comps = connected_components(links.select("a", "b"))
    ids = rows.select(ROW, "id")
    joined = comps.join(ids, comps["node"] == ids[ROW]).select("node", "component", "id")
    least_id = joined.groupBy("component").agg(F.min("id").alias("component_id"))
    of = joined.join(least_id, "component").select(F.col("node").alias(ROW), "component_id")
    out = ids.join(counts, ROW, "left").join(of, ROW, "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))


_NONE = pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64), "n": np.zeros(0, np.int64)})
