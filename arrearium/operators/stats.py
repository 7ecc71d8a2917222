"""Exact order statistics and running totals that never gather a whole group in one task.

Shared by cleaning, reports and evaluation. The common idea: a first pass counts in a bounded number of bins
and so finds where to look; the next reads only the rows that matter.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arrearium.session import shared_dir, stored

# A side this long is a few MB: safe to send to every executor.
BROADCAST_ROWS = 100_000

# A node of at most so many different values is put in order by one task; a larger one is cut into bins first.
GATHER = 32_768

# A node is cut into 2^BITS bins, or up to twice as many.
BITS = 10


def stored_and_small(side: DataFrame, max_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """Compute a small-looking table once into the shared checkpoint folder and count it."""
    shared_dir(side.sparkSession)
    held = side.checkpoint()
    return held, held.count() <= max_rows


def bounded_side(side: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting.

    Beyond max_rows there is no hint: the join shuffles, and adaptive execution splits hot keys.
    """
    held, small = stored_and_small(side, max_rows)
    return F.broadcast(held) if small else held


def counted_side(side: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """bounded_side for what a narrow plan over a stored table gives: counted in place, not computed into another one."""
    return F.broadcast(side) if side.limit(max_rows + 1).count() <= max_rows else side


def one_row(stats: DataFrame) -> Column:
    """Use a one-row aggregate as a struct-valued scalar subquery: no join, no driver round trip."""
    return stats.select(F.struct(*[F.col(f"`{c}`") for c in stats.columns])).scalar()


def attach(df: DataFrame, now: bool = False, **stats: DataFrame) -> DataFrame:
    """Add each one-row aggregate as one struct column of that name, to be dropped after use.

    Used through the column, however often, a subquery stays one subquery. With now=True the row is
    fetched (one row, whatever the table's size) and becomes a literal: for chains of steps whose
    statistics build on each other, so that plans do not nest.
    """
    def value(s: DataFrame) -> Column:
        if not now:
            return one_row(s)
        row = s.first()
        return F.struct(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in s.schema])

    return df.withColumns({name: value(s) for name, s in stats.items()})


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    method: str = "exact",
    accuracy: int = 10_000,
) -> DataFrame:
    """Linear-interpolated quantiles of several columns at once, NULLs and NULL groups skipped.

    Returns one row per (by..., column): n and q, an array in the order of probs. Groups are
    hinted for broadcast where their number was checked.

    method='approx' is one pass of mergeable sketches. 'exact' counts the values in bins of their sortable
    image and looks again only into the bins that hold a wanted rank, until these hold GATHER rows or a single
    value: no sketch, and however large a group or frequent a value is, no task orders more than GATHER values.
    """
    by = list(by)
    keys = by + ["column"]
    long = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    long = long.unpivot(by, list(columns), "column", "value").where(
        F.col("value").isNotNull() & ~F.isnan("value"))
    for k in by:
        long = long.where(F.col(k).isNotNull())

    if method == "approx":
        sketch = F.percentile_approx("value", F.array(*[F.lit(float(p)) for p in probs]), accuracy)
        out = long.groupBy(*keys).agg(F.count("*").alias("n"), sketch.alias("q"))
        return bounded_side(out) if by else F.broadcast(out)
    if method != "exact":
        raise ValueError(f"unknown method {method!r}")

    totals, ranked = multi_select(long.select(*keys, sortable(F.col("value")).alias("_at")), keys, probs)
    small = not by or totals.count() <= BROADCAST_ROWS
    at = F.map_from_entries(F.collect_list(F.struct("rank", "value")))  # two ranks for each probability at most
    picks = []
    for p in probs:
        pos = F.lit(float(p)) * (F.col("n") - 1)
        lo, hi = F.element_at("at", F.floor(pos)), F.element_at("at", F.ceil(pos))
        picks.append(F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (pos - F.floor(pos))))
    out = totals.join(ranked.groupBy(*keys).agg(at.alias("at")), keys).select(*keys, "n", F.array(*picks).alias("q"))
    return F.broadcast(out) if small else out


def sortable(value: Column) -> Column:
    """The 64-bit pattern of a double as a whole number of the same order; both zeros are 0, NaN comes last.

    Each row is looked at once: as reflect counts as not deterministic, the expression is not copied into the filters and columns
    that use it, which with logarithms and powers in it took more than reading the rows.
    """
    size = F.coalesce(F.abs(value), F.lit(0.0))  # reflect takes no NULL
    pattern = F.call_function("reflect", F.lit("java.lang.Double"), F.lit("doubleToLongBits"), size).cast("long")
    return F.when(value.isNotNull(), F.when(value < 0, -1).otherwise(1) * pattern)


def from_sortable(at: Column) -> Column:
    pattern = F.abs(at)
    exponent, rest = F.shiftright(pattern, 52), pattern.bitwiseAND((1 << 52) - 1).cast("double")
    value = (F.when(exponent == 0x7FF, F.when(rest == 0, F.lit(float("inf"))).otherwise(F.lit(float("nan")))).when(exponent == 0, rest * 2.0**-1074)
             .otherwise((rest * 2.0**-52 + 1) * F.pow(F.lit(2.0), exponent - 1023)))
    return F.when(at < 0, -value).otherwise(value)


def _top(rows: DataFrame) -> DataFrame:
    """All rows in one node, a bin for each sixteenth of an octave."""
    return rows.withColumns({"_node": F.lit(0).cast("long"), "_bin": F.shiftright("_at", 48)})


def _bins(rows: DataFrame, keys: Sequence[str], *sums: Column) -> DataFrame:
    return rows.groupBy(*keys, "_node", "_bin").agg(F.count("*").alias("n"), F.min("_at").alias("lo"), F.max("_at").alias("hi"), *sums)


def _deeper(rows: DataFrame, bins: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of the given bins. Each bin becomes a node, named by its least value, cut anew between its least and greatest."""
    span = F.col("hi").cast("double") - F.col("lo").cast("double")
    shift = F.greatest(F.lit(0), F.ceil(F.log2(span + 1)) - BITS).cast("int")
    side = bins.select(*keys, "_node", "_bin", F.col("lo").alias("_lo"), shift.alias("_shift")).distinct()
    return rows.join(counted_side(side), [*keys, "_node", "_bin"]).withColumns(
        {"_node": F.col("_lo"), "_bin": F.expr(  # halves first, as the whole span may pass 63 bits
            "CASE WHEN _shift = 0 THEN _at - _lo ELSE shiftright(shiftright(_at, 1) - shiftright(_lo, 1), _shift - 1) END")}).drop("_lo", "_shift")


def multi_select(rows: DataFrame, keys: Sequence[str], probs: Sequence[float], gather: int = GATHER) -> tuple[DataFrame, DataFrame]:
    """(keys, n), and (keys, rank, value) of every rank from 0 that lies next to one of the probabilities.

    rows are (keys, _at), _at sortable. Each round reads what is left, counts it in bins for all keys and ranks at once, and
    keeps the bins that hold a rank. A bin's range is a thousandth of its node's, so six rounds are the most.
    """
    todo, groups, want, found = _top(rows), list(keys), None, []
    while True:
        bins = stored(_bins(todo, groups), "bins")
        if want is None:
            totals = bins.groupBy(*groups).agg(F.sum("n").alias("n"))
            pos = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]
            ranks = F.array_distinct(F.array(*[f(p).cast("long") for p in pos for f in (F.floor, F.ceil)]))
            want = totals.select(*groups, F.explode(ranks).alias("rank"), F.lit(0).cast("long").alias("_node")).withColumn("left", F.col("rank"))
        before = F.sum("n").over(W.partitionBy(*groups, "_node").orderBy("_bin")) - F.col("n")  # as many rows as bins
        placed = want.join(bins.withColumn("before", before), [*groups, "_node"]).where(
            (F.col("before") <= F.col("left")) & (F.col("left") < F.col("before") + F.col("n")))
        placed = stored(placed.withColumn("left", F.col("left") - F.col("before")), "ranks")
        found.append(placed.where("lo = hi").select(*groups, "rank", from_sortable(F.col("lo")).alias("value")))
        bins = placed.where("lo < hi")
        want = bins.select(*groups, "rank", F.col("lo").alias("_node"), "left")
        todo = _deeper(todo, bins, groups)
        if bins.where(F.col("n") > gather).isEmpty():
            break
        todo = stored(todo, "left")
    counts = todo.groupBy(*groups, "_node", "_at").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy(*groups, "_node").orderBy("_at")) - F.col("n")  # at most `gather` rows
    last = counts.withColumn("before", before).join(want, [*groups, "_node"]).where(
        (F.col("before") <= F.col("left")) & (F.col("left") < F.col("before") + F.col("n")))
    ranked = last.select(*groups, "rank", from_sortable(F.col("_at")).alias("value"))
    for f in found:
        ranked = ranked.unionByName(f)
    return totals, ranked


def wide_quantiles(q: DataFrame, columns: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One-row form of global quantiles: <column>__<name> for every column and probability."""
    return q.agg(*[
        F.max(F.when(F.col("column") == c, F.col("q")[i])).alias(f"{c}__{name}")
        for c in columns for i, name in enumerate(names)])


def leaves(rows: DataFrame, keys: Sequence[str], before: Mapping[str, tuple[Column, str]], descending: bool = False,
           gather: int = GATHER) -> DataFrame:
    """Cut the rows (keys, _at, ...) of each key into leaves, pieces of the order of _at, and say what lies before each.

    Adds _leaf, _single (all its rows have one _at) and, for each entry of before, o_<name>: the aggregate over all rows of the
    keys that come before the leaf, NULL if there are none. An entry is an aggregate of rows and how two of them
    combine, 'sum' or 'max'. A key of at most `gather` rows is one leaf. A larger one is cut in bins between its least and
    greatest _at, and these again, so a leaf has more rows only if they share one _at. What lies before a bin is what
    lies before its node and its neighbours in the node, so no window is longer than a node has bins.
    """
    def combine(one: Column, other: Column, how: str) -> Column:
        return F.greatest(one, other) if how == "max" else F.when(one.isNull() | other.isNull(), F.coalesce(one, other)).otherwise(one + other)

    at = [*keys, "_node", "_bin"]
    zero = F.lit(0).cast("long")
    todo = rows.withColumns({"_node": zero, "_bin": zero})
    crowded = stored(_bins(todo, keys).where(F.col("n") > gather), "large")
    large = crowded.where("lo < hi")
    kinds = rows.groupBy(*keys).agg(*[agg.alias(name) for name, (agg, _) in before.items()]).schema
    nothing = {f"o_{name}": F.lit(None).cast(kinds[name].dataType) for name in before}
    whole = {"_leaf": zero, "_single": F.lit(False), **nothing}
    if crowded.isEmpty():
        return todo.withColumns(whole).drop("_node", "_bin")
    kept = todo.withColumns(whole).drop("_single").join(counted_side(crowded.select(*at, (F.col("lo") == F.col("hi")).alias("_single"))), at, "left")
    done = [kept.where("_single is null or _single").withColumn("_single", F.coalesce("_single", F.lit(False)))]
    held = large.select(*keys, F.col("lo").alias("_node")).withColumns(nothing)
    first = F.col("_bin").desc() if descending else F.col("_bin").asc()
    w = W.partitionBy(*keys, "_node").orderBy(first).rowsBetween(W.unboundedPreceding, -1)
    while not large.isEmpty():
        todo = stored(_deeper(todo, large, keys), "left")
        bins = _bins(todo, keys, *[agg.alias(f"t_{name}") for name, (agg, _) in before.items()]).join(held, [*keys, "_node"])
        bins = stored(bins.withColumns({f"o_{name}": combine(F.col(f"o_{name}"), (F.max if how == "max" else F.sum)(f"t_{name}").over(w), how)
                                        for name, (_, how) in before.items()}), "bins")
        open_ = (F.col("n") > gather) & (F.col("lo") < F.col("hi"))
        small = bins.where(~open_).select(*at, F.col("lo").alias("_leaf"), (F.col("lo") == F.col("hi")).alias("_single"), *nothing)
        done.append(todo.join(counted_side(small), at))
        large = bins.where(open_)
        held = large.select(*keys, F.col("lo").alias("_node"), *nothing)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("_node", "_bin")


def running_totals(counts: DataFrame, order: str, sums: Sequence[str], descending: bool = True, gather: int = GATHER) -> DataFrame:
    """Add upto_<s>, the exact sum of s over all rows from the first in order to this one, and
    total_<s>, its sum over all rows.

    counts must hold one row per distinct value of order, a number. The rows are cut into leaves of at most `gather` rows, as
    many as they need; the sums before a leaf come with it, and only within a leaf are rows ordered.
    """
    kept = stored(counts.withColumn("_at", sortable(F.col(order).cast("double"))), "counts")
    placed = leaves(kept, [], {s: (F.sum(s), "sum") for s in sums}, descending, gather)
    totals = kept.agg(*[F.sum(s).alias(f"total_{s}") for s in sums])
    within = W.partitionBy("_leaf").orderBy(F.col("_at").desc() if descending else F.col("_at").asc()).rowsBetween(
        W.unboundedPreceding, W.currentRow)
    return attach(placed, _s=totals).select(*counts.columns, *[F.col(f"_s.total_{s}").alias(f"total_{s}") for s in sums], *[
        (F.coalesce(F.col(f"o_{s}"), F.lit(0)) + F.sum(s).over(within)).alias(f"upto_{s}") for s in sums])


def hash_ranks(df: DataFrame, key: str, cuts: Callable[[Column], list[Column]], by: Sequence[str] = (), seed: str = "") -> DataFrame:
    """df with _piece: how many of the cuts lie at or below the row's rank in its group, in md5(key) order, exactly.

    cuts turns a group's size into ranks, each the number of rows before the cut. Counts per four-digit hash prefix tell in which
    prefix each cut lies; ranking the rows of those prefixes (1/65536 of a group each) gives the last row before each
    cut. All rows are then decided by comparison, so the table itself is neither shuffled nor sorted. Keys should be unique;
    a NULL group is a group.
    """
    group = F.struct(*[F.col(c) for c in by]) if by else F.lit(0)
    hashed = df.select(*df.columns, group.alias("_g"), F.md5(F.concat(F.col(key).cast("string"), F.lit(seed))).alias("_h"))
    hashed = hashed.withColumn("_prefix", F.substring("_h", 1, 4))
    per_prefix = hashed.groupBy("_g", "_prefix").agg(F.count("*").alias("cnt"))
    window = W.partitionBy("_g")  # at most 65536 rows per group
    upto = F.sum("cnt").over(window.orderBy("_prefix").rowsBetween(W.unboundedPreceding, W.currentRow))
    ranks = F.array(*[c.cast("long") for c in cuts(F.col("n"))])
    placed = per_prefix.withColumns({"upto": upto, "n": F.sum("cnt").over(window)}).select("*", F.posexplode(ranks).alias("_cut", "rank"))
    placed = placed.where((F.col("rank") > F.col("upto") - F.col("cnt")) & (F.col("rank") <= F.col("upto"))).select(
        "_g", "_prefix", "_cut", (F.col("rank") - (F.col("upto") - F.col("cnt"))).alias("_left"))
    spots = placed.groupBy("_g", "_prefix").agg(F.collect_list(F.struct("_cut", "_left")).alias("_cuts"))
    near = hashed.select("_g", "_prefix", "_h", F.col(key).alias("_k")).join(bounded_side(spots), ["_g", "_prefix"])
    near = near.withColumn("_rank", F.row_number().over(W.partitionBy("_g", "_prefix").orderBy("_h", "_k")))
    last = near.select("_g", "_h", "_k", "_rank", F.explode("_cuts").alias("c")).where("_rank = c._left")
    lasts = last.groupBy("_g").agg(F.collect_list(F.struct("_h", "_k")).alias("_lasts"))  # one for each cut that has rows before it
    empty = per_prefix.groupBy("_g").agg(F.sum("cnt").alias("n")).select("_g", F.size(F.filter(ranks, lambda r: r <= 0)).alias("_none"))
    marked = hashed.join(bounded_side(empty.join(lasts, "_g", "left")), "_g")
    here = F.struct("_h", F.col(key).alias("_k"))
    passed = F.size(F.filter(F.coalesce("_lasts", F.array().cast(lasts.schema["_lasts"].dataType)), lambda x: x < here))
    return marked.withColumn("_piece", passed + F.col("_none")).drop("_g", "_h", "_prefix", "_lasts", "_none")


def hash_folds(df: DataFrame, key: str, folds: int, by: Sequence[str] = (), seed: str = "") -> DataFrame:
    """Add fold, 0 to folds - 1: each group cut in hash order of the key, sizes differing by one row at most; fold k ends
    before rank floor(n (k + 1) / folds)."""
    cut = hash_ranks(df, key, lambda n: [F.floor(n * k / folds) for k in range(1, folds)], by, seed)
    return cut.withColumnRenamed("_piece", "fold")


def first_share_by_hash(df: DataFrame, key: str, share: float, by: Sequence[str] = (),
                        out: str = "is_test", seed: str = "") -> DataFrame:
    """Mark the floor(share * n) rows of each group that come first in md5(key) order, exactly.

    Counts per four-digit hash prefix tell in which prefix the share is reached; ranking the rows of
    that one prefix (1/65536 of a group) gives the last row to mark. All rows are then decided by
    comparison with it, so the table itself is neither shuffled nor sorted.
    """
    by = list(by)
    hashed = df.withColumns({"_h": F.md5(F.concat(F.col(key).cast("string"), F.lit(seed)))})
    per_prefix = hashed.groupBy(*by, F.substring("_h", 1, 4).alias("_prefix")).agg(F.count("*").alias("cnt"))
    group = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))  # at most 65536 rows per group
    upto = F.sum("cnt").over(group.orderBy("_prefix").rowsBetween(W.unboundedPreceding, W.currentRow))
    want = F.floor(F.lit(float(share)) * F.sum("cnt").over(group) + F.lit(1e-9))
    cut = (per_prefix.withColumns({"upto": upto, "want": want})
           .where((F.col("upto") >= F.col("want")) & (F.col("upto") - F.col("cnt") < F.col("want")))
           .select(*by, F.col("_prefix").alias("_cut"),
                   (F.col("want") - (F.col("upto") - F.col("cnt"))).alias("_left")))

    def give(rows: DataFrame, side: DataFrame, how: str) -> DataFrame:
        return rows.join(bounded_side(side), by, how) if by else attach(rows, _s=side).select(*rows.columns, "_s.*")

    near = give(hashed.select(*by, "_h", key), cut, "inner").where(F.substring("_h", 1, 4) == F.col("_cut"))
    rank = F.row_number().over(group.orderBy("_h", key))
    last = near.withColumn("_rank", rank).where(F.col("_rank") == F.col("_left")).select(
        *by, F.struct("_h", F.col(key).alias("_k")).alias("_last"))
    marked = give(hashed, last, "left")
    first = F.struct("_h", F.col(key).alias("_k")) <= F.col("_last")
    return marked.select(*df.columns, F.coalesce(first, F.lit(False)).cast("int").alias(out))
