"""Structured Streaming: segments and gap sessions, deltas without repeats, windowed means, and an idempotent sink."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.scalar import micros
from ..sources.tables import append_new

HOUR = 3_600_000_000


@dataclass(frozen=True)
class Breaks:
    """A segment ends where more than so many whole hours have passed, or the value rose by more than so much."""

    gap_hours: int
    rise: float | None = None


class _Segmenter(StatefulProcessor):
    """Rows of a key wait until the watermark has passed them, so that they are taken in order; then each is given its segment.

    State: the rows that wait, by time; the last row that was taken; the number of segments so far. A timer at the earliest
    waiting time wakes the key up when the watermark gets there.
    """

    def __init__(self, breaks: Breaks):
        self.breaks = breaks

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "us long, tie long", "value double")
        self.last = handle.getValueState("last", "us long, value double, n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        for pdf in rows:
            for us, tie, value in pdf.iloc[:, -3:].itertuples(index=False):  # by place: names may not come through
                if us // 1000 > passed:  # a row behind the watermark would have come too late for its segment
                    self.waiting.updateValue((int(us), int(tie)), (None if pd.isna(value) else float(value),))
        self._wake()
        yield self._taken(key, [])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        ready = sorted(k for k in self.waiting.keys() if k[0] // 1000 <= passed)
        last = self.last.get() if self.last.exists() else None
        out = []
        for us, tie in ready:
            (value,) = self.waiting.getValue((us, tie))
            before, n = (last[:2], last[2]) if last else (None, 0)
            n += before is None or self._broken(before, (us, value))
            last = us, value, n
            out.append((us, tie, n))
            self.waiting.removeKey((us, tie))
        if last:
            self.last.update(last)
        self._wake()
        yield self._taken(key, out)

    def close(self) -> None:
        pass

    def _broken(self, before: tuple, now: tuple) -> bool:
        rose = self.breaks.rise is not None and before[1] is not None and now[1] is not None and now[1] - before[1] > self.breaks.rise
        return (now[0] - before[0]) // HOUR > self.breaks.gap_hours or rose

    def _wake(self) -> None:
        first = min((k[0] for k in self.waiting.keys()), default=None)
        if first is not None:
            self.handle.registerTimer(first // 1000)

    def _taken(self, key, rows: list[tuple]) -> pd.DataFrame:
        keys = {f"_k{i}": pd.Series([k] * len(rows), dtype=object) for i, k in enumerate(key)}
        return pd.DataFrame(keys | {c: pd.Series([r[i] for r in rows], dtype="int64") for i, c in enumerate(("_us", "_tie", "_n"))})


def break_segments(stream: DataFrame, by: list[str], ts: str, tie: str, breaks: Breaks, value: str | None = None, late: str = "72 hours") -> DataFrame:
    """``by, ts, tie, segment_id`` of a stream's rows: the segments of operators.segments.split_at_breaks, row by row.

    A row is given its segment once the watermark (``late`` behind the newest row) has passed it, so rows may come in any order until then
    and later ones are left out. tie, a whole number, tells rows of one time apart; a repeated (key, time, tie) counts
    once. Rows without a time are left out. Needs the RocksDB state store; a key's state is its rows within ``late``.
    """
    timed = stream.where(F.col(ts).isNotNull()).withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    rows = timed.select("_ts", *[F.col(b).alias(f"_k{i}") for i, b in enumerate(by)], micros(ts).alias("_us"), F.col(tie).cast("long").alias("_tie"), (F.col(value) if value else F.lit(None)).cast("double").alias("_value"))
    keys = [rows.schema[f"_k{i}"] for i in range(len(by))]
    schema = T.StructType([*keys, T.StructField("_us", T.LongType()), T.StructField("_tie", T.LongType()), T.StructField("_n", T.LongType())])
    grouped = rows.groupBy(*[k.name for k in keys])
    taken = grouped.transformWithStateInPandas(_Segmenter(breaks), outputStructType=schema, outputMode="Append", timeMode="EventTime")
    name = F.concat(*[F.col(k.name).cast("string") for k in keys], F.lit("_Seg"), F.col("_n").cast("string"))
    when = F.timestamp_micros("_us").cast(stream.schema[ts].dataType)
    return taken.select(*[F.col(k.name).alias(b) for k, b in zip(keys, by)], when.alias(ts), F.col("_tie").alias(tie), name.alias("segment_id"))


def gap_sessions(stream: DataFrame, by: list[str], ts: str, gap: str = "24 hours", late: str = "72 hours") -> DataFrame:
    """Sessions that a gap ends, with their first and last time and rows; closed once the watermark passes them.

    Unlike the batch segments a session breaks at exact gaps only, not at orbit raises.
    """
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    spans = timed.groupBy(*by, F.session_window(ts, gap).alias("w")).agg(F.min(ts).alias("seg_start"), F.max(ts).alias("seg_end"), F.count(F.lit(1)).alias("n_rows"))
    return spans.select(*by, "seg_start", "seg_end", "n_rows")


def deltas_once(stream: DataFrame, keys: list[str], ts: str, overlap: str = "72 hours") -> DataFrame:
    """Rows of overlapping deltas, each key once within the overlap."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, overlap).dropDuplicatesWithinWatermark(keys)


def windowed_mean(stream: DataFrame, by: list[str], ts: str, value: str, width: str = "1 day", late: str = "1 day") -> DataFrame:
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    return timed.groupBy(*by, F.window(ts, width).alias("w")).agg(F.avg(value).alias("mean"), F.count(F.lit(1)).alias("n_rows")).select(*by, F.col("w.start").alias("start"), "mean", "n_rows")


def append_stream(stream: DataFrame, target: str, keys: list[str], checkpoint: str, within: str | None = None) -> StreamingQuery:
    """Run what is available and insert rows whose keys the target lacks; a repeated batch adds nothing.

    With ``within``, a key that mostly grows such as the time, a batch reads only the target's files and row groups of its range.
    """

    def add(batch: DataFrame, _: int) -> None:
        batch.persist()  # its range and its rows are both asked for
        append_new(batch, target, keys, within)
        batch.unpersist()

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
