"""Text feeds of space weather: landed as lines or as one text, parsed into typed rows; bad lines are left out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import all_of, timestamp


@dataclass(frozen=True)
class Feed:
    """How a feed's lines become rows: separator, number of tokens, lines to pass over, fields from the tokens."""

    fields: dict[str, Callable[[Column], Column]]
    separator: str = r"\s+"
    tokens: int = 1
    exact: bool = False
    header: int = 0
    comments: tuple[str, ...] = ()
    keep: Callable[[], Column] = field(default=lambda: F.lit(True))


def _double(i: int):
    return lambda p: F.get(p, i).try_cast("double")


def _int(i: int):
    return lambda p: F.get(p, i).try_cast("int")


def _text(i: int):
    return lambda p: F.get(p, i)


def _date(p: Column) -> Column:
    y, m, d = (F.get(p, i).try_cast("int") for i in range(3))
    return F.try_make_timestamp(y, m, d, F.lit(0), F.lit(0), F.lit(0)).cast("timestamp_ntz")


SOLAR_FLUX = Feed(
    {"date": lambda p: timestamp(F.get(p, 0), "yyyyMMdd"), "observed_flux": _double(4), "adjusted_flux": _double(5), "series_d_flux": _double(6)},
    tokens=7, header=2, keep=lambda: F.col("observed_flux") > 0,
)
KP_INDICES = Feed(
    {
        "year": _int(0), "month": _int(1), "day": _int(2), "start_time": _text(3), "mid_time": _text(4), "days_elapsed": _double(5),
        "modified_days": _double(6), "kp_value": _double(7), "ap_value": _double(8), "data_type": _text(9), "date": _date,
    },
    tokens=10, exact=True, comments=("#", ":"),
)
SUNSPOTS = Feed(
    {"date": _date, "sunspot_number": _double(4), "std_dev": _double(5), "nb_observations": _double(6), "definitive": _text(7)},
    separator=";", tokens=8, comments=("#",), keep=lambda: F.col("sunspot_number") >= 0,
)
FEEDS = {"solar_flux": SOLAR_FLUX, "kp_indices": KP_INDICES, "sunspot": SUNSPOTS}


def lines_of(df: DataFrame, content: str = "raw_content", by: list[str] | None = None) -> DataFrame:
    """``ordinal, value``: lines of landed texts, numbered within each; ``by`` columns are kept."""
    return df.select(*(by or []), F.posexplode(F.split(content, "\n")).alias("ordinal", "value"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of landed text files, each file's numbered in order."""
    whole = spark.read.text(path, wholetext=True)
    return lines_of(whole.withColumn("file", F.col("_metadata.file_path")), "value", ["file"])


def parse(lines: DataFrame, feed: Feed, value: str = "value", ordinal: str = "ordinal") -> DataFrame:
    """Typed rows of a feed's lines, with their ordinal; a line of which any field fails to parse is left out.

    Header lines are the first that are not blank; they are counted over one feed file, which one task reads.
    """
    text = F.trim(F.regexp_replace(value, "[\r\t]", " "))
    rows = lines.where(text != "")
    for mark in feed.comments:
        rows = rows.where(~text.startswith(mark))
    if feed.header:
        first = rows.orderBy(ordinal).limit(feed.header).agg(F.max(ordinal)).first()[0]
        rows = rows.where(F.col(ordinal) > F.lit(-1 if first is None else first))
    p = F.transform(F.split(text, feed.separator), lambda x: F.trim(x))
    count = F.size(p) == feed.tokens if feed.exact else F.size(p) >= feed.tokens
    parsed = rows.where(count).select(ordinal, *[make(p).alias(name) for name, make in feed.fields.items()])
    return parsed.where(all_of([F.col(c).isNotNull() for c in feed.fields])).where(feed.keep())
