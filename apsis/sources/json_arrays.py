"""Large JSON arrays read in many tasks: a file is cut at its closing braces, and what each brace closes is settled afterwards.

Whether a brace is inside a string, and how deep it lies, depends on all that comes before it in the file. Both are
running sums over the pieces between braces, so they are taken in chunks (operators.ordered), and no task reads a whole file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ordered import CHUNK, place, scan
from .scratch import written

FILE, ORDER = ["_file"], ["_block", "_row"]


def _count(text: Column, sign: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))).cast("long")


def json_records(spark: SparkSession, path: str, chunks: int | None = None) -> DataFrame:
    """``_file, _n, record``: the text of each object of the arrays under path, and its number in its file from 0.

    Files must not be compressed, as those can't be cut. Elements that are no objects are passed over. A file of objects one after the
    other, with or without commas and brackets, is read alike; an object that its file leaves open is dropped.
    """
    lines = spark.read.option("lineSep", "}").text(path)
    pieces = lines.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"), "value")
    # No escape sequence reaches over a brace, so a piece can do without them; what is in quotes goes, from either state at its start.
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    outside, inside = (F.regexp_replace(t, r'"[^"]*("|\z)', "") for t in (bare, F.concat(F.lit('"'), bare)))
    pieces = pieces.select("*", _count(bare, '"').alias("_quotes"), _count(outside, "{").alias("_open0"), _count(inside, "{").alias("_open1"))
    quoted = scan(place(pieces, FILE, ORDER, chunks), FILE, ORDER, sums={"_quoted": F.col("_quotes")})
    starts, ends = ((F.col("_quoted") - F.col("_quotes")) % 2 == 1), (F.col("_quoted") % 2 == 1)
    closes = F.when(ends, 0).otherwise(1)
    stepped = written(quoted.select(*FILE, *ORDER, "value", CHUNK, closes.alias("_closes"), (F.when(starts, F.col("_open1")).otherwise(F.col("_open0")) - closes).alias("_step")))
    depth = scan(stepped, FILE, ORDER, sums={"_depth": F.col("_step")})
    # The piece behind a file's last brace seems to close one that was never opened: its depth is below zero and it ends nothing.
    ended = written(depth.withColumn("_end", ((F.col("_depth") == 0) & (F.col("_closes") == 1)).cast("long")).drop("_step", "_depth", "_closes"))
    numbered = scan(ended, FILE, ORDER, sums={"_ends": F.col("_end")}).withColumn("_n", F.col("_ends") - F.col("_end"))
    parts = numbered.groupBy(*FILE, "_n").agg(F.max("_end").alias("_whole"), F.array_sort(F.collect_list(F.struct(*ORDER, "value"))).alias("_parts"))  # the braces of one object
    text = F.concat(F.array_join(F.transform("_parts", lambda p: p["value"]), "}"), F.lit("}"))
    return parts.where("_whole = 1").select("_file", "_n", F.regexp_replace(text, r"^[^{]*", "").alias("record"))


def read_json_arrays(spark: SparkSession, path: str, schema: T.StructType | str, chunks: int | None = None) -> DataFrame:
    """The objects of the arrays under path as rows, as ``multiLine`` reads them, but many tasks to a file; fields that don't fit are null."""
    return json_records(spark, path, chunks).select(F.from_json("record", schema).alias("r")).select("r.*")
