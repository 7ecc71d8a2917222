"""Look-back windows per key that stay cheap when one key holds a large part of all rows.

A key's timeline is cut into chunks of fixed length; each chunk is a group of its own, and what a
chunk needs from the time before it is carried over explicitly. Costs grow with rows, not with
rows times window width. Keys with a chunk of more than `gather` rows are told apart first; their moments
are cut into leaves by number of rows, however short the time they span, and scanned with what lies before each leaf.

All three functions equal the plain window: NULL keys are a group of their own, and events without a time have each
other, and nothing else, in their window.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrearium.operators.stats import GATHER, bounded_side, leaves, sortable
from arrearium.session import stored

DAY = 86_400_000_000


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _apart(events: DataFrame, key: str, ts: str, chunk: int, gather: int, plain: Callable[[DataFrame], DataFrame],
           scan: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """plain for the keys whose chunks are all of at most `gather` rows, scan for the others."""
    at = events.withColumns({"_k": F.struct(F.col(key).alias("k")), "_c": F.floor(_micros(ts) / chunk)})
    crowded = at.groupBy("_k", "_c").agg(F.count("*").alias("n")).where(F.col("n") > gather)
    hot = stored(crowded.select("_k").distinct(), "hot-keys")
    if hot.isEmpty():
        return plain(events)
    side = bounded_side(hot)
    keyed = at.drop("_c")
    return plain(keyed.join(side, "_k", "left_anti").drop("_k")).unionByName(scan(keyed.join(side, "_k", "left_semi")))


def _upto() -> Column:
    return W.partitionBy("_k", "_leaf").orderBy("_at").rowsBetween(W.unboundedPreceding, W.currentRow)


def _given(events: DataFrame, moments: DataFrame, ts: str, out: str) -> DataFrame:
    """Bring the value of a key's moment to its events; a moment of very many events is split by the join."""
    side = moments.select(F.col("_k").alias("_k2"), F.col("_t").alias("_t2"), out)
    at = events.withColumn("_t", _micros(ts))
    same = (F.col("_k") == F.col("_k2")) & F.col("_t").eqNullSafe(F.col("_t2"))
    return at.join(side, same, "left").select(*[F.col(f"`{c}`") for c in events.columns if c != "_k"], out)


def rolling_count(events: DataFrame, key: str, ts: str, days: int, out: str, chunk_days: int = 28, gather: int = GATHER) -> DataFrame:
    """Number of events of the key in [ts - days, ts], equal times included.

    Each event enters at its time and leaves just after `days`; a running sum of these steps is the
    count. An event whose stay reaches into the next chunk is carried there as a step only.
    """
    width, chunk = days * DAY, max(chunk_days, days) * DAY

    def plain(rows: DataFrame) -> DataFrame:
        at = rows.withColumn("_t", _micros(ts)).withColumn("_c", F.floor(F.col("_t") / chunk))
        own = F.col("_c")
        leave = F.col("_t") + F.lit(width + 1)
        reaches = F.floor(leave / chunk) > own
        row = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
        nothing = F.lit(None).cast(rows.select(row.alias("r")).schema["r"].dataType)

        def step(c: Column, t: Column, delta: int, r: Column) -> Column:
            return F.struct(c.alias("c"), t.alias("t"), F.lit(delta).alias("d"), r.alias("r"))

        # In the own chunk: enter (with the row), leave. In the next one: present from the start, leave. Without a time: enter only.
        steps = F.concat(
            F.array(step(own, F.col("_t"), 1, row)),
            F.when(F.col("_t").isNull(), F.array().cast(rows.select(F.array(step(F.lit(0).cast("long"), F.lit(0).cast("long"), 1, row)).alias("r")).schema["r"].dataType))
            .when(reaches, F.array(step(own + 1, F.col("_t"), 1, nothing), step(own + 1, leave, -1, nothing)))
            .otherwise(F.array(step(own, leave, -1, nothing))))
        flat = at.select(F.col(key).alias("_k"), F.explode(steps).alias("s")).select("_k", "s.*")
        run = F.sum("d").over(W.partitionBy("_k", "c").orderBy("t").rangeBetween(W.unboundedPreceding, W.currentRow))
        return flat.withColumn(out, run).where(F.col("r").isNotNull()).select("r.*", out)

    def scan(rows: DataFrame) -> DataFrame:
        moments = stored(rows.groupBy("_k", _micros(ts).alias("_t")).agg(F.count("*").alias("n")), "moments")
        known = moments.where("_t is not null")
        # What a moment's window leaves out is the count just before it: one more moment, without events.
        steps = known.select("_k", F.col("_t").alias("_at"), "n", F.lit(1).alias("real"), F.lit(0).alias("before")).unionByName(
            known.select("_k", (F.col("_t") - F.lit(width + 1)).alias("_at"), F.lit(0).cast("long").alias("n"), F.lit(0).alias("real"), F.lit(1).alias("before")))
        steps = steps.groupBy("_k", "_at").agg(*[F.sum(c).alias(c) for c in ("n", "real", "before")])
        placed = leaves(steps, ["_k"], {"n": (F.sum("n"), "sum")}, gather=gather)
        upto = placed.withColumn("upto", F.coalesce("o_n", F.lit(0)) + F.sum("n").over(_upto()))
        ends = upto.where("real = 1").select("_k", F.col("_at").alias("_t"), "upto").unionByName(
            upto.where("before = 1").select("_k", (F.col("_at") + F.lit(width + 1)).alias("_t"), (-F.col("upto")).alias("upto")))
        counts = ends.groupBy("_k", "_t").agg(F.sum("upto").alias(out)).unionByName(
            moments.where("_t is null").select("_k", "_t", F.col("n").alias(out)))
        return _given(rows, counts, ts, out)

    return _apart(events, key, ts, chunk, gather, plain, scan)


def rolling_max(events: DataFrame, key: str, ts: str, value: str, days: int, out: str, gather: int = GATHER) -> DataFrame:
    """Largest value of the key in [ts - days, ts], equal times included.

    With chunks as long as the window, that window is a head of the row's own chunk plus a tail of
    the one before: the larger of a running maximum and a backward running maximum. The row itself travels to
    the chunk before and back, so rows need no id.
    """
    chunk = days * DAY

    def plain(rows: DataFrame) -> DataFrame:
        at = rows.withColumns({"_k": F.col(key), "_t": _micros(ts)}).withColumn("_c", F.floor(F.col("_t") / chunk))
        forward = W.partitionBy("_k", "_c").orderBy("_t").rangeBetween(W.unboundedPreceding, W.currentRow)
        headed = at.withColumn("_head", F.max(value).over(forward))
        row = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
        nothing = F.lit(None).cast(rows.select(row.alias("r")).schema["r"].dataType)
        none = F.lit(None).cast(dict(rows.dtypes)[value])

        def step(c: Column, when: Column, v: Column, head: Column, r: Column) -> Column:
            return F.struct(c.alias("c"), when.alias("t"), v.alias("v"), head.alias("head"), r.alias("r"))

        steps = F.array(step(F.col("_c"), F.col("_t"), F.col(value), none, nothing),
                        step(F.col("_c") - 1, F.col("_t") - chunk, none, F.col("_head"), row))
        flat = headed.select("_k", F.explode(steps).alias("s")).select("_k", "s.*")
        back = W.partitionBy("_k", "c").orderBy("t").rangeBetween(W.currentRow, W.unboundedFollowing)
        tail = flat.withColumn("_tail", F.max("v").over(back)).where(F.col("r").isNotNull())
        return tail.select("r.*", F.greatest("head", "_tail").alias(out))

    def scan(rows: DataFrame) -> DataFrame:
        moments = stored(rows.groupBy("_k", _micros(ts).alias("_t")).agg(F.max(value).alias("v")), "moments")
        known = moments.where("_t is not null").select("_k", F.floor(F.col("_t") / chunk).alias("_c"), F.col("_t").alias("_at"), "v")
        within = W.partitionBy("_k", "_c", "_leaf").rowsBetween(W.unboundedPreceding, W.currentRow)
        head = leaves(known, ["_k", "_c"], {"v": (F.max("v"), "max")}, gather=gather).select("_k", F.col("_at").alias("_t"), F.greatest(
            "o_v", F.max("v").over(within.orderBy("_at"))).alias("v"))
        asked = known.select("_k", (F.col("_c") - 1).alias("_c"), (F.col("_at") - chunk).alias("_at"), F.lit(None).cast(dict(known.dtypes)["v"]).alias("v"),
                             F.lit(1).alias("asked"))
        steps = known.withColumn("asked", F.lit(0)).unionByName(asked).groupBy("_k", "_c", "_at").agg(F.max("v").alias("v"), F.max("asked").alias("asked"))
        tail = leaves(steps, ["_k", "_c"], {"v": (F.max("v"), "max")}, descending=True, gather=gather).select(
            "_k", (F.col("_at") + chunk).alias("_t"), "asked", F.greatest("o_v", F.max("v").over(within.orderBy(F.desc("_at")))).alias("v"))
        best = head.unionByName(tail.where("asked = 1").drop("asked")).groupBy("_k", "_t").agg(F.max("v").alias(out)).unionByName(
            moments.where("_t is null").select("_k", "_t", F.col("v").alias(out)))
        return _given(rows, best, ts, out)

    return _apart(events, key, ts, chunk, gather, plain, scan)


def previous_value(events: DataFrame, key: str, ts: str, value: str, id_col: str, out: str,
                   chunk_days: int = 28, gather: int = GATHER) -> DataFrame:
    """Value of the key's event before this one (by time, then id); NULL for the first. NULL times come first.

    Within a chunk this is lag. The first event of a chunk takes the last value of the key's
    previous non-empty chunk, found on one summary row per key and chunk. In the scan a moment of very many events is cut
    by their ids, where these are numbers.
    """
    chunk = chunk_days * DAY

    def plain(rows: DataFrame) -> DataFrame:
        at = rows.withColumns({"_k": F.col(key), "_c": F.floor(_micros(ts) / chunk)})
        order = F.struct(F.col(ts), F.col(id_col))
        ends = at.groupBy("_k", "_c").agg(F.max_by(F.struct(F.col(value).alias("v")), order).alias("last"))
        carried = ends.select(F.col("_k").alias("_k2"), F.col("_c").alias("_c2"),
                              F.lag("last").over(W.partitionBy("_k").orderBy("_c")).alias("_carry"))
        within = W.partitionBy("_k", "_c").orderBy(ts, id_col)
        boxed = F.lag(F.struct(F.col(value).alias("v"))).over(within)
        same = F.col("_k").eqNullSafe(F.col("_k2")) & F.col("_c").eqNullSafe(F.col("_c2"))
        return (at.withColumn("_lag", boxed).join(carried, same, "left")
                .withColumn(out, F.coalesce("_lag", "_carry")["v"])
                .select(*rows.columns, out))

    def scan(rows: DataFrame) -> DataFrame:
        earliest = F.lit(-(1 << 62)).cast("long")
        at = rows.withColumn("_at", F.coalesce(_micros(ts), earliest))
        last = F.max(F.struct(F.col("_at").alias("t"), F.col(id_col).alias("i"), F.col(value).alias("v")))
        cut = leaves(at, ["_k"], {"last": (last, "max")}, gather=gather).withColumn("_part", F.lit(0).cast("long"))
        kind = rows.schema[id_col].dataType
        if isinstance(kind, T.NumericType):
            single = cut.where("_single").drop("_part").withColumnsRenamed({"_leaf": "_moment", "o_last": "o_all"}).drop("_single")
            single = single.withColumn("_at", F.coalesce(sortable(F.col(id_col).cast("double")), earliest))
            single = leaves(single, ["_k", "_moment"], {"last": (last, "max")}, gather=gather)
            single = single.withColumns({"o_last": F.coalesce("o_last", "o_all"), "_part": F.col("_leaf"), "_leaf": F.col("_moment")})
            cut = cut.where("not _single").unionByName(single.drop("o_all", "_moment"))
        boxed = F.lag(F.struct(F.col(value).alias("v"))).over(W.partitionBy("_k", "_leaf", "_part").orderBy(ts, id_col))
        return cut.withColumn("_lag", boxed).withColumn(out, F.coalesce(F.col("_lag.v"), F.when(F.col("_lag").isNull(), F.col("o_last.v")))).select(
            *[f"`{c}`" for c in rows.columns if c != "_k"], out)

    return _apart(events, key, ts, chunk, gather, plain, scan)
