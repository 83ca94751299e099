"""Windows over the ordered rows of each key. ``order`` must end in a unique column; ``by`` splits the work."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import micros, whole

Names = list[str]


def ordered(by: Names, order: Names):
    return Window.partitionBy(*by).orderBy(*order)


def lagged(df: DataFrame, value: str, by: Names, order: Names, lags: list[int], name: str = "{}_lag_{}") -> DataFrame:
    """The value of earlier rows."""
    w = ordered(by, order)
    return df.withColumns({name.format(value, k): F.lag(value, k).over(w) for k in lags})


def lag_diff(df: DataFrame, value: str, by: Names, order: Names, out: str, unit: str | None = None, fill=None, absolute: bool = False) -> DataFrame:
    """Difference to the row before, of times in whole units; ``fill`` for the first row."""
    before = F.lag(value).over(ordered(by, order))
    diff = whole(unit, before, F.col(value)) if unit else F.col(value) - before
    diff = F.abs(diff) if absolute else diff
    return df.withColumn(out, diff if fill is None else F.coalesce(diff, F.lit(fill)))


def rate_per_day(df: DataFrame, value: str, ts: str, by: Names, order: Names, out: str, whole_days: bool = False) -> DataFrame:
    """Change per day since the row before; null where no time passed."""
    w = ordered(by, order)
    before = F.lag(ts).over(w)
    days = whole("DAY", before, ts).cast("double") if whole_days else whole("SECOND", before, ts) / F.lit(86400.0)
    return df.withColumn(out, F.try_divide(F.col(value) - F.lag(value).over(w), days))


def rolling(df: DataFrame, ts: str, by: Names, seconds: int, aggregates: dict, closed: bool = False) -> DataFrame:
    """Aggregates over the rows of the last seconds, (t - seconds, t], peers included; ``closed`` takes the far end in."""
    span = seconds * 1_000_000
    w = Window.partitionBy(*by).orderBy(micros(ts)).rangeBetween(-span if closed else 1 - span, 0)
    return df.withColumns({out: a.over(w) for out, a in aggregates.items()})


def forward_fill(df: DataFrame, columns: Names, by: Names, order: Names) -> DataFrame:
    """The last value that was not null so far."""
    w = ordered(by, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def keep_one(df: DataFrame, keys: Names, order: list) -> DataFrame:
    """The first row of each key in the given order (names or sort expressions)."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rank = 1").drop("_rank")


def last_rows(df: DataFrame, by: Names, order: list, n: int) -> DataFrame:
    """The first n rows of each key in the given order."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_rank") <= n).drop("_rank")


def key_maximum(df: DataFrame, value: str, by: Names, out: str) -> DataFrame:
    """The key's largest value on each of its rows."""
    return df.withColumn(out, F.max(value).over(Window.partitionBy(*by)))
