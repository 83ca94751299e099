"""As-of joins and time grids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordered import place, scan


def _united(left: DataFrame, right: DataFrame, left_ts: str, right_ts: str, by: list[str], payload: list[str], tie: str | None) -> tuple[DataFrame, list[str]]:
    """Rows of both sides, ``_side`` 1 with the left ``_row`` and 0 with what a right row hands on, and their order.

    Of right rows at one time the last by ``tie`` counts, in the order of tie's own type; without one the last by payload.
    Right rows without a time are left out.
    """
    carried, tied = F.struct(*payload), F.struct(*([tie] if tie else payload))
    kinds = right.select(carried.alias("c"), tied.alias("t")).schema
    row_kind = left.select(F.struct("*").alias("x")).schema["x"].dataType
    rights = right.where(F.col(right_ts).isNotNull()).select(
        *by, F.col(right_ts).alias("_ts"), F.lit(0).alias("_side"), tied.alias("_tie"), carried.alias("_carried"), F.lit(None).cast(row_kind).alias("_row")
    )
    lefts = left.select(
        *by, F.col(left_ts).alias("_ts"), F.lit(1).alias("_side"), F.lit(None).cast(kinds["t"].dataType).alias("_tie"), F.lit(None).cast(kinds["c"].dataType).alias("_carried"), F.struct("*").alias("_row")
    )
    return lefts.unionByName(rights), ["_ts", "_side", "_tie"]


def asof_backward(left: DataFrame, right: DataFrame, left_ts: str, right_ts: str, by: list[str], payload: list[str], tie: str | None = None) -> DataFrame:
    """left with the payload of the last right row of its key at or before its time (nulls without one).

    Both sides are united and the last right row is carried forward within each key: one shuffle by key and one sort,
    no join. Ties are as in :func:`asof_any`, which is also for keys too large for a task. Payload names must not clash with left's columns.
    """
    if not by:
        raise ValueError("an as-of join without keys needs asof_any, or asof_daily")
    both, order = _united(left, right, left_ts, right_ts, by, payload, tie)
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = both.withColumn("_found", F.last("_carried", ignorenulls=True).over(w)).where("_side = 1")
    return joined.select("_row.*", *[F.col(f"_found.{p}").alias(p) for p in payload])


def asof_any(
    left: DataFrame, right: DataFrame, left_ts: str, right_ts: str, payload: list[str], by: list[str] | None = None, tie: str | None = None, chunks: int | None = None
) -> DataFrame:
    """left with the payload of the last right row at or before its time, at any times, with keys of any size or without keys.

    Both sides are dealt by ranges of (key, time) and each chunk hands its last right row on to the next, so no key meets in one task.
    Of right rows at one time the last by ``tie`` counts, without a tie the last by payload. A left row without a time finds nothing.
    """
    by = by or []
    both, order = _united(left, right, left_ts, right_ts, by, payload, tie)
    found = scan(place(both, by, order, chunks), by, order, fills={"_found": F.col("_carried")}).where("_side = 1")
    return found.select("_row.*", *[F.col(f"_found.{p}").alias(p) for p in payload])


#: Days up to which a daily calendar is broadcast: about 700 years.
CALENDAR_DAYS = 250_000


def daily_calendar(right: DataFrame, right_date: str, payload: list[str], until, order: list | None = None) -> DataFrame:
    """The last right row of each day, carried over the days without one, up to the date ``until``.

    One row per day: its size is that of the calendar, whatever the tables', so its single window task stays small.
    """
    day = F.to_date(right_date).alias("_day")
    last = right.where(F.col(right_date).isNotNull()).groupBy(day).agg(F.max_by(F.struct(*payload), F.struct(*(order or payload))).alias("_carried"))
    days = last.agg(F.min("_day").alias("a")).select(F.explode(F.sequence(F.col("a"), F.greatest(F.col("a"), F.lit(until).cast("date")))).alias("_day"))
    w = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return days.join(last, "_day", "left").select("_day", F.last("_carried", ignorenulls=True).over(w).alias("_found"))


def asof_daily(left: DataFrame, right: DataFrame, left_ts: str, right_date: str, payload: list[str], order: list | None = None) -> DataFrame:
    """As-of join without keys where right times are days: an equi-join of left's day with a calendar without gaps.

    The calendar reaches from the first right day to the last, and later left days take its last row; one look at the right
    side settles its length. It is broadcast when it has CALENDAR_DAYS rows at most; a longer one is joined by shuffle. Right times
    within a day are an error, as a left row earlier that day would see them: asof_any takes any times.
    """
    day = F.to_date(right_date)
    first, last, within = right.agg(F.min(day), F.max(day), F.max(F.col(right_date).cast("timestamp_ntz") != day.cast("timestamp_ntz"))).first()
    if within:
        raise ValueError(f"{right_date} has times within a day; use asof_any")
    calendar = daily_calendar(right, right_date, payload, last, order)
    if first is None or (last - first).days <= CALENDAR_DAYS:
        calendar = F.broadcast(calendar)
    joined = left.join(calendar, F.least(F.to_date(left_ts), F.lit(last)) == F.col("_day"), "left")
    known = F.when(F.col(left_ts).isNotNull(), F.col("_found"))
    return joined.select(*left.columns, *[known[p].alias(p) for p in payload])


def time_grid(df: DataFrame, by: list[str], ts: str, hours: int, out: str = "grid_ts") -> DataFrame:
    """Regular times of each key from its first time, rounded down to whole steps of the epoch, to its last, inclusive."""
    step = hours * 3600
    ends = df.groupBy(*by).agg(F.min(F.unix_seconds(F.col(ts).cast("timestamp"))).alias("_a"), F.max(F.unix_seconds(F.col(ts).cast("timestamp"))).alias("_b"))
    times = F.explode(F.sequence(F.col("_a") - F.pmod(F.col("_a"), F.lit(step)), F.col("_b"), F.lit(step).cast("long")))
    return ends.select(*by, times.alias("_s")).select(*by, F.timestamp_seconds("_s").cast("timestamp_ntz").alias(out))
