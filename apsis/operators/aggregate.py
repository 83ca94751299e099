"""Grouped statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import all_of
from ..sources.scratch import written


def nested_median(df: DataFrame, outer: list[str], inner: list[str], value: str, distinct: str) -> DataFrame:
    """Per outer key the median of the inner groups' exact medians, and the sum of their distinct counts.

    The distinct count is a count over one row per group and value, so it combines before the shuffle.
    """
    keys = [*outer, *inner]
    medians = df.groupBy(*keys).agg(F.median(value).alias("_median"))
    counts = df.select(*keys, distinct).distinct().groupBy(*keys).agg(F.count(distinct).alias("_n"))
    same = [medians[k].eqNullSafe(counts[k]) for k in keys]
    groups = medians.join(counts, same).select(*[medians[k] for k in keys], "_median", "_n")
    return groups.groupBy(*outer).agg(F.median("_median").alias("median"), F.sum("_n").alias("n"))


#: Rows of a group up to which its median is taken in one task.
LARGE_GROUP = 1_000_000
#: Quantiles that one pass over large groups estimates, and the rank error of the estimate in steps between them.
STEPS, SLACK = 1000, 2


def large_median(df: DataFrame, by: list[str], value: str, large: int = LARGE_GROUP, passes: int = 12) -> DataFrame:
    """``by, median, n``: exact medians also of groups that don't fit a task; nulls and NaN don't count.

    Of a large group a pass estimates quantiles with mergeable sketches, keeps the two that enclose the middle and
    counts exactly what lies below, at and between them: the rows between become a few hundredths at most. When there are
    no more than ``large``, they and the two ends are counted by value and the middle is read off.
    """
    rows = df.select(*by, F.col(value).cast("double").alias("_v")).where("_v is not null and not isnan(_v)")
    sizes = written(rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n")))
    same = lambda a, b: all_of([a[k].eqNullSafe(b[k]) for k in by])
    many = sizes.where(F.col("n") > large)
    small = rows.join(many, same(rows, many), "left_anti").groupBy(*by).agg(F.median("_v").alias("median"), F.count(F.lit(1)).alias("n"))
    if many.isEmpty():
        return small

    points = [i / STEPS for i in range(STEPS + 1)]
    state = many.select(*by, "n", F.lit(0).cast("long").alias("_below"), F.col("n").alias("_inside"), F.lit(float("-inf")).alias("_lo"), F.lit(float("inf")).alias("_hi"))
    for _ in range(passes):
        within = _within(rows, state, by).where("_v between _lo and _hi")
        quantiles = within.groupBy(*by).agg(F.percentile_approx("_v", points, 10 * STEPS).alias("_q"))
        step = lambda rank: rank.cast("double") / F.col("_inside") * STEPS
        low, high = F.floor(step(F.floor((F.col("n") - 1) / 2) - F.col("_below"))) - SLACK, F.ceil(step(F.floor(F.col("n") / 2) + 1 - F.col("_below"))) + SLACK
        bounds = state.join(quantiles.select(*[F.col(k).alias(f"_{i}") for i, k in enumerate(by)], "_q"), all_of([F.col(k).eqNullSafe(F.col(f"_{i}")) for i, k in enumerate(by)]))
        lo = F.when(low > 0, F.get("_q", low.cast("int"))).otherwise(F.col("_lo"))
        hi = F.when(high < STEPS, F.get("_q", high.cast("int"))).otherwise(F.col("_hi"))
        narrowed = bounds.select(*by, "n", lo.alias("_lo"), hi.alias("_hi"))
        counts = [F.count_if(test).alias(name) for name, test in (("_below", F.col("_v") < F.col("_lo")), ("_inside", F.expr("_v between _lo and _hi")), ("_between", F.expr("_v > _lo and _v < _hi")))]
        state = written(_within(rows, narrowed, by).groupBy(*by, "n", "_lo", "_hi").agg(*counts))
        if state.where(F.col("_between") > large).isEmpty():
            break
    else:
        raise RuntimeError(f"medians not enclosed after {passes} passes")
    values = _within(rows, state, by).where("_v between _lo and _hi").groupBy(*by, "n", "_below", "_v").agg(F.count(F.lit(1)).alias("_c"))
    up_to = F.col("_below") + F.sum("_c").over(Window.partitionBy(*by).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = values.withColumn("_upto", up_to)
    holds = [(F.col("_upto") > r) & (F.col("_upto") - F.col("_c") <= r) for r in (F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2))]
    middle = [F.max(F.when(h, F.col("_v"))) for h in holds]
    return small.unionByName(ranked.groupBy(*by, "n").agg(((middle[0] + middle[1]) / 2).alias("median")).select(*by, "median", "n"))


def _within(rows: DataFrame, state: DataFrame, by: list[str]) -> DataFrame:
    """Rows of the groups of state, which are few: one for every LARGE_GROUP rows at most."""
    named = state.withColumnsRenamed({k: f"_{i}" for i, k in enumerate(by)})
    joined = rows.join(named, all_of([F.col(k).eqNullSafe(F.col(f"_{i}")) for i, k in enumerate(by)]))
    return joined.drop(*[f"_{i}" for i in range(len(by))])


def dominant(df: DataFrame, by: list[str], value: str, order: list[str], out: str) -> DataFrame:
    """The commonest value of each key; of equally common ones the one seen first."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(*order)).alias("_first"))
    return counts.groupBy(*by).agg(F.min_by(value, F.struct(-F.col("_n"), F.col("_first"))).alias(out))


def hour_histogram(df: DataFrame, ts: str, limit: int) -> DataFrame:
    """Rows per hour with their share of a limit."""
    return df.groupBy(F.date_trunc("hour", ts).cast("timestamp_ntz").alias("hour")).agg(F.count(F.lit(1)).alias("requests")).withColumn("usage", F.col("requests") / limit)


def peak(df: DataFrame, by: list[str], value: str, at: str, out: str) -> DataFrame:
    """Where each key's value is largest; the earliest of several."""
    return df.groupBy(*by).agg(F.min_by(at, F.struct(-F.col(value), F.col(at))).alias(out), F.max(value).alias(f"{out}_{value}"))


def largest_gap(df: DataFrame, by: list[str], ts: str, unit: str = "DAY") -> DataFrame:
    """Largest whole gap between neighbouring times of each key; null for a single time."""
    before = F.lag(ts).over(Window.partitionBy(*by).orderBy(ts))
    return df.withColumn("_gap", F.timestamp_diff(unit, before, F.col(ts))).groupBy(*by).agg(F.max("_gap").alias("largest_gap"))


def integrity(df: DataFrame, key: str, ts: str) -> DataFrame:
    """One row about a table: distinct keys, first and last time, rows."""
    return df.agg(F.count_distinct(key).alias("objects"), F.max(ts).alias("max_ts"), F.min(ts).alias("min_ts"), F.count(F.lit(1)).alias("n_rows"))


def lasting(df: DataFrame, by: list[str], ts: str, days: int) -> DataFrame:
    """Keys whose times span at least so many whole days."""
    spans = df.groupBy(*by).agg(F.min(ts).alias("_a"), F.max(ts).alias("_b"))
    return spans.where(F.timestamp_diff("DAY", F.col("_a"), F.col("_b")) >= days).select(*by)


def keys_with_rows(df: DataFrame, by: list[str], at_least: int) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") >= at_least)
