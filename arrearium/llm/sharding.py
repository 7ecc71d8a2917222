"""Histogram sort: splitters by counted bytes, then one exchange into shards of near-equal size."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arrearium.llm.common import ROW, numbered
from arrearium.session import stored

# A key is the text's hash, the id's hash and the row number as fixed-length hexadecimal digits: equal texts lie side by
# side, and no two rows share a key.
_KEY_DIGITS = 16 + 8 + 16
_FAR = (10**60, "")


def _below(key: Column, probes: Sequence[str]) -> Column:
    """Number of sorted probes that are <= key, by halving steps."""
    if not probes:
        return F.lit(0)
    size = 1 << len(probes).bit_length()
    array = F.array(*[F.lit(p) for p in probes])
    steps = F.array(*[F.lit(size >> k) for k in range(1, size.bit_length())])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= len(probes)) & (F.try_element_at(array, at + step) <= key), at + step).otherwise(at))


def splitters(keyed: DataFrame, weight: str, targets: Sequence[int], slack: int, probes_each: int = 24) -> list[str]:
    """Keys whose exact weight below is within slack of each target, or as near as whole rows allow.

    Each round sums the weight between all candidate boundaries in one aggregate of one row per
    bucket; the bucket that holds a target, narrowed to the least and greatest key really in it, is where the next
    round's candidates lie. It ends when every splitter is within its slack or its bucket is a single row.
    """
    last = 16**_KEY_DIGITS
    # For each target: keys lo <= splitter < hi, and the exact weights below lo and below hi.
    open_ = {i: (0, last) for i in range(len(targets))}
    best: dict[int, tuple[int, str]] = {}
    while open_:
        wanted: set[int] = set()
        for lo, hi in set(open_.values()):
            n = min(probes_each, hi - lo)
            wanted.update(lo + (hi - lo) * k // n for k in range(1, n + 1))
            wanted.add(lo)
        probes = sorted(f"{p:0{_KEY_DIGITS}x}" for p in wanted if 0 <= p < last)
        counted = keyed.groupBy(_below(F.col("key"), probes).alias("b")).agg(
            F.sum(weight).alias("s"), F.min("key").alias("first"), F.max("key").alias("last")).collect()  # a row for each bucket
        by = {r["b"]: r for r in counted}
        below, at = [0], 0
        for b in range(len(probes) + 1):
            at += int(by[b]["s"]) if b in by else 0
            below.append(at)  # below[b + 1]: bytes of buckets 0..b, that is below probes[b]
        edges = below[1:]
        for i in list(open_):
            t = targets[i]
            b = bisect_right(edges[:-1], t)  # bucket in which the target falls; probes[b - 1] has at most t bytes below
            for j in (b - 1, b):
                if 0 <= j < len(probes):
                    best[i] = min(best.get(i, _FAR), (abs(edges[j] - t), probes[j]))
            if best.get(i, _FAR)[0] <= slack:
                del open_[i]
            elif b not in by or by[b]["first"] == by[b]["last"]:
                if b in by:  # one row: the boundary is before or after it
                    for p, at in ((by[b]["first"], edges[b] - int(by[b]["s"])), (f"{int(by[b]['last'], 16) + 1:0{_KEY_DIGITS}x}", edges[b])):
                        best[i] = min(best.get(i, _FAR), (abs(at - t), p))
                del open_[i]
            else:
                open_[i] = (int(by[b]["first"], 16), int(by[b]["last"], 16) + 1)
    return [best[i][1] for i in range(len(targets))]


def shard(docs: DataFrame, shards: int = 8, tolerance: float = 0.001, id_col: str = "doc_id", text_col: str = "text",
          payload: Sequence[str] | None = None, rows_per_range: int = 20_000, most_ranges: int = 4_096) -> DataFrame:
    """Rows with size, text_crc32, law ('bytes'), shard, slot and grown_shard (null): shards of near-equal bytes.

    Size is the UTF-8 bytes of the text plus 1. Shard sizes differ from the mean by at most tolerance or half the largest
    document. Shards are cut further into ranges of about rows_per_range rows; a range is what one task sorts, so a
    shard may be any size. slot counts the shard's rows from 0 in key order: equal texts are side by side, in one shard
    unless a boundary must cut them (a group of a third of all bytes). Rows equal in every column stay separate rows.
    Null text: size 1, checksum 0. No rows, no rows. payload: further columns that travel (default: all);
    columns of docs with the names of results are replaced, all others come back as they were.
    """
    added = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    carried = [c for c in (docs.columns if payload is None else [id_col, *payload]) if c not in added and c != ROW]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    ids = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    rows = numbered(docs, {**{f"c_{c}": F.col(f"`{c}`") for c in dict.fromkeys(carried)}, "_id": F.crc32(ids), "size": F.octet_length(text).cast("long") + 1,
                           "text_crc32": F.crc32(text), "_hash": F.xxhash64(text)}, "sized")
    key = F.concat(F.lower(F.lpad(F.hex("_hash"), 16, "0")),
                   F.lower(F.lpad(F.hex("_id"), 8, "0")),
                   F.lower(F.lpad(F.hex(ROW), 16, "0")))
    total = rows.agg(F.sum("size").alias("s"), F.count("*").alias("n")).first()
    n, bytes_ = total["n"], total["s"] or 0
    parts = shards * max(1, min(most_ranges // shards, max(8, -(-n // (rows_per_range * shards)))))
    by_bytes, by_work = [], []
    if n:
        keyed = stored(rows.select(key.alias("key"), "size", (F.col("size") * n + bytes_).cast("decimal(38,0)").alias("work")), "keys")
        slack = int(tolerance * bytes_ / shards / 2)
        by_bytes = splitters(keyed, "size", [bytes_ * i // shards for i in range(1, shards)], slack)
        # Ranges share out bytes and rows alike, so many tiny rows do not meet in one range.
        by_work = splitters(keyed, "work", [2 * bytes_ * n * i // parts for i in range(1, parts)], 2 * bytes_ * n // (8 * parts))
    cuts = sorted(by_bytes + by_work)
    at = rows.withColumn("_key", key).withColumns({"_range": _below(F.col("_key"), cuts), "shard": _below(F.col("_key"), sorted(by_bytes))})
    # A row for each range: at most most_ranges and shards of them.
    before = W.partitionBy("shard").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    counts = at.groupBy("_range", "shard").agg(F.count("*").alias("_n")).select(
        F.col("_range").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    ranked = at.withColumn("_in", F.row_number().over(W.partitionBy("_range").orderBy("_key")) - 1)
    out = ranked.join(F.broadcast(counts), F.col("_range") == F.col("_of"))
    return out.select(*[F.col(f"`c_{c}`").alias(c) for c in dict.fromkeys(carried)], "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                      (F.col("_first") + F.col("_in")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(sharded: DataFrame, path: str) -> DataFrame:
    """Write a folder for each shard, ordered by slot within files, and read it back."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return sharded.sparkSession.read.parquet(path)
