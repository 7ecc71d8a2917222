"""What several operators here share: numbered rows, blocks of large groups, components, batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrearium.session import stored

ROW = "_row_"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(df: DataFrame, columns: dict[str, Column], name: str) -> DataFrame:
    """Write the given columns with a row number to the shared folder and read them from there.

    The number is fixed by being written, so rows that are equal in all columns stay apart, and a lost executor
    cannot change which row a number means.
    """
    return stored(df.select(F.monotonically_increasing_id().alias(ROW), *[c.alias(n) for n, c in columns.items()]), name)


def sent(side: DataFrame, most_rows: int = 500_000, most_bytes: int = 32 << 20) -> DataFrame:
    """Hint a broadcast for a stored side only after counting its rows and bytes (as JSON text, near what rows take in memory)."""
    some = side.limit(most_rows + 1).agg(F.count("*").alias("n"), F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("bytes")).first()
    return F.broadcast(side) if some["n"] <= most_rows and (some["bytes"] or 0) <= most_bytes else side


def text_key(text: Column) -> list[Column]:
    """_k1, _k2: 128 bits of hash that stand for a text; null for null."""
    return [F.when(text.isNotNull(), h).alias(k) for k, h in (("_k1", F.xxhash64(text)), ("_k2", F.xxhash64(F.concat(F.lit("#"), text))))]


def held_out(doc_id: str | Column) -> Column:
    """The quarter of all ids that no model may learn from; a null id is not held out."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def in_blocks(members: DataFrame, key: str, block: int) -> DataFrame:
    """Deal each group's members to pairs of blocks, so that all pairs of a group meet but no task holds the group.

    Adds _i, _j (the pair of blocks, _i <= _j) and _side (0: the member is of block _i, 1: of block _j, 2: both, as
    _i = _j). Groups of one are left out. A group of m members is cut by hash into about m / block blocks.
    """
    sizes = members.groupBy(key).agg(F.count("*").alias("_m")).where("_m > 1").withColumn(
        "_blocks", F.ceil(F.col("_m") / block).cast("int"))
    at = members.join(sizes.select(key, "_blocks"), key).withColumn(
        "_own", F.when(F.col("_blocks") == 1, 0).otherwise(F.pmod(F.xxhash64(ROW), F.col("_blocks")).cast("int")))
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other")
    dealt = at.select(*at.columns, other)
    return dealt.select(
        *members.columns, F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"),
        F.when(F.col("_own") == F.col("_other"), 2).when(F.col("_own") < F.col("_other"), 0).otherwise(1).alias("_side"))


def connected_components(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """node, component (the least node it is joined to) for every node of edges (a, b), a stored table that may repeat edges.

    Alternates the large-star and small-star steps until the edges are stars: no node has two edges up, or one up and one
    down. Each round is written to the shared folder; what reaches the driver is one count of nodes. With `rounds` it
    stops after so many: nodes of one component are joined then too, but a component may still be in several parts.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")

    def is_stars(e: DataFrame) -> bool:
        ends = F.explode(F.array(F.struct(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                                 F.struct(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("p")
        nodes = e.select(ends).select("p.*").groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        return nodes.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).agg(F.count("*")).first()[0] == 0

    done = 0
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select("u", "v", "m")
        small = small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(
            F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")))).alias("p")).select("p.*").where("u <> v").distinct()
        e = stored(small, "links")
        done += 1
        if done == rounds or is_stars(e):
            break
    up = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return up.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).groupBy("node").agg(
        F.min("component").alias("component"))


def stars(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Least member of each one's component, among n members linked pairwise by a and b."""
    root = np.arange(n)
    while True:
        was = root.copy()
        least = np.minimum(root[a], root[b])
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        root = root[root]
        if (root == was).all():
            return root


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the column's bytes stay near most_bytes each; one row is never cut."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = total = 0
        for i, n in enumerate(lengths):
            if total and total + n > most_bytes:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < len(lengths):
            yield batch.slice(start)
