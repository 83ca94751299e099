"""Splitting a key's history where it breaks, and keeping the segments that last."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import whole
from .ordered import CHUNK, place, scan
from .windows import Names, keep_one, ordered


@dataclass(frozen=True)
class Break:
    """A rule by which a history breaks: its columns, and a test that is given the row before as ``before(name)``."""

    columns: tuple[str, ...]
    test: Callable[[Callable[[str], Column]], Column]

    def holds(self, before: Callable[[str], Column]) -> Column:
        return F.coalesce(self.test(before), F.lit(False))


def gap_over(ts: str, hours: int) -> Break:
    """More than so many whole hours since the row before."""
    return Break((ts,), lambda before: whole("HOUR", before(ts), ts) > hours)


def rise_over(value: str, by_more_than: float) -> Break:
    """The value rose since the row before; a fall never breaks."""
    return Break((value,), lambda before: F.col(value) - before(value) > by_more_than)


def _named(by: Names, n: Column) -> Column:
    return F.concat(*[F.col(b).cast("string") for b in by], F.lit("_Seg"), n.cast("string"))


def split_at_breaks(df: DataFrame, by: Names, order: Names, rules: list[Break], out: str = "segment_id") -> DataFrame:
    """``<key>_Seg<n>``: n goes up where any rule holds and starts with 1. A key's rows meet in one task, see split_long."""
    w = ordered(by, order)
    broken: Column = F.row_number().over(w) == 1
    for rule in rules:
        broken = broken | rule.holds(lambda c: F.lag(c).over(w))
    flagged = df.withColumn("_break", broken.cast("int"))
    n = F.sum("_break").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return flagged.withColumn(out, _named(by, n)).drop("_break")


def split_long(df: DataFrame, by: Names, order: Names, rules: list[Break], out: str = "segment_id", chunks: int | None = None) -> DataFrame:
    """The same segments where a key may hold a large share of the rows: its history is cut into chunks that hand on
    their last row and their number of breaks."""
    before = list(dict.fromkeys([*order, *[c for r in rules for c in r.columns]]))
    rows = scan(place(df, by, order, chunks), by, order, before=before)
    broken = F.col("_before").isNull()
    for rule in rules:
        broken = broken | rule.holds(lambda c: F.col("_before")[c])
    numbered = scan(rows.withColumn("_break", broken.cast("int")).drop("_before"), by, order, sums={"_n": F.col("_break")})
    return numbered.withColumn(out, _named(by, F.col("_n"))).drop("_break", "_n", CHUNK)


def segment_spans(df: DataFrame, by: Names, segment: str, ts: str, end: str | None = None) -> DataFrame:
    """First and last time and rows of each segment, and the first of an end known by key."""
    more = [F.first(end, ignorenulls=True).alias("known_end")] if end else []
    return df.groupBy(*by, segment).agg(F.min(ts).alias("seg_start"), F.max(ts).alias("seg_end"), F.count(F.lit(1)).alias("n_rows"), *more)


def last_segments(spans: DataFrame, by: Names, segment: str) -> DataFrame:
    return keep_one(spans, by, [F.desc("seg_end"), F.desc(segment)])


def gate_segments(
    df: DataFrame, by: Names, segment: str, ts: str, min_days: int | None, max_latency_hours: int | None = None,
    end: str | None = None, last_only: bool = False,
) -> DataFrame:
    """Rows of segments of at least so many whole days that stop no longer than so many hours before their key's end.

    A key without a known end has no latency. last_only keeps a key's last good segment.
    """
    spans = segment_spans(df, by, segment, ts, end)
    if min_days is not None:
        spans = spans.where(whole("DAY", "seg_start", "seg_end") >= min_days)
    if max_latency_hours is not None and end:
        spans = spans.where(F.coalesce(whole("HOUR", "seg_end", "known_end"), F.lit(0)) <= max_latency_hours)
    if last_only:
        spans = last_segments(spans, by, segment)
    return df.join(spans.select(*by, segment), [*by, segment], "left_semi")
