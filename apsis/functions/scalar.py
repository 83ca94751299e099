"""Casts, differences of times and arithmetic that give null instead of an error."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import SENTINELS


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(c: str | Column, sentinels: tuple[str, ...] = SENTINELS) -> Column:
    """A text as double; blanks, sentinels and what is no number are null."""
    text = F.trim(col(c).cast("string"))
    return F.when(~text.isin("", *sentinels), text.try_cast("double"))


def timestamp(c: str | Column, pattern: str | None = None) -> Column:
    """A text as timestamp without zone; what is none is null."""
    return F.try_to_timestamp(col(c), *([F.lit(pattern)] if pattern else [])).cast("timestamp_ntz")


def micros(c: str | Column) -> Column:
    """Microseconds since 1970 of a timestamp, UTC."""
    return F.unix_micros(col(c).cast("timestamp"))


def whole(unit: str, start: str | Column, end: str | Column) -> Column:
    """Whole units from start to end, towards zero."""
    return F.timestamp_diff(unit, col(start), col(end))


def clip_above(c: str | Column, limit: float) -> Column:
    """c but at most limit; null stays null (least() would give the limit)."""
    return F.when(col(c) > limit, F.lit(limit)).otherwise(col(c))


def clip_below(c: str | Column, limit: float) -> Column:
    return F.when(col(c) < limit, F.lit(limit)).otherwise(col(c))


def rounded(c: str | Column, places: int) -> Column:
    """A double at some decimal places as SQL engines round it: scaled, halves away from zero, scaled back.

    F.round goes by the shortest decimal text instead: 2.0178125 lies below that half, as does the scaled number, but not its text.
    """
    c, scale = col(c), 10.0**places
    scaled = F.abs(c) * scale
    down = F.floor(scaled)
    near = F.when(scaled < 2.0**52, down + F.when(scaled - down >= 0.5, 1.0).otherwise(0.0)).otherwise(scaled)  # doubles beyond are whole
    return F.when(scaled < float("inf"), F.signum(c) * near / scale).otherwise(c)


def flag(condition: Column) -> Column:
    """A condition as 1, 0 or null."""
    return condition.cast("int")


def band(c: str | Column, bands, lowest: str) -> Column:
    """Name of the first band whose least value c reaches; bands from high to low; null without c."""
    out = F.when(col(c).isNull(), F.lit(None).cast("string"))
    for least, name in bands:
        out = out.when(col(c) >= least, F.lit(name))
    return out.otherwise(F.lit(lowest))


def up_to(c: str | Column, classes, beyond: str) -> Column:
    """Name of the first class whose highest value c doesn't exceed; classes from low to high; null without c."""
    out = F.when(col(c).isNull(), F.lit(None).cast("string"))
    for most, name in classes:
        out = out.when(col(c) <= most, F.lit(name))
    return out.otherwise(F.lit(beyond))


def json_value(c: str | Column, path: str, kind: str) -> Column:
    """A value in a JSON text, softly cast; null where text, path or cast fails."""
    return F.get_json_object(col(c), path).try_cast(kind)


def json_row(*columns: str | Column) -> Column:
    """Columns as a JSON object in their order, nulls included."""
    return F.to_json(F.struct(*[col(c) for c in columns]), {"ignoreNullFields": "false"})


def all_of(conditions) -> Column:
    return reduce(and_, conditions, F.lit(True))


def year_of(c: str | Column) -> Column:
    """Year in front of a date given as text; null if there is none."""
    return F.substring(col(c), 1, 4).try_cast("int")
