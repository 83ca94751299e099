"""Exact deduplication by a tree merge of sorted digest runs, in DataFrame functions alone.

Every partition of the input makes one run: its distinct digests in order, each with its count and smallest identifier.
Runs then meet in binomial rounds: a round merges the FAN_IN runs whose numbers differ in the last digit alone, and drops
that digit, until one run is left. A run isn't a task: it is dealt by digest, so the last one is as wide as the first. Copies combine before
each exchange, so a text that a third of the rows share costs one row per run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, discard, join_hot, without, written

#: Runs that one merge takes; a power of two, so that a round is as many binomial rounds in one.
FAN_IN = 16
KEY = ["digest", "n_bytes", "check"]


def normalised(text):
    """Column of a text with each stretch of white space made one blank; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_CLASS, " ")


def digests(df: DataFrame, key: str, text: str) -> DataFrame:
    """``id, at, run`` and the digest of each row: SHA-256, and for its verification the length and another hash.

    ``at`` numbers the rows, which tells repeated ids apart.
    """
    rows = df.select(F.col(f"`{key}`").alias("id"), normalised(F.col(f"`{text}`")).alias("text"), F.monotonically_increasing_id().alias("at"), F.spark_partition_id().alias("run"))
    return rows.select("id", "at", "run", F.sha2("text", 256).alias("digest"), F.octet_length("text").alias("n_bytes"), F.xxhash64("text").alias("check"))


def merged(rows: DataFrame, run) -> DataFrame:
    """Runs of a new numbering: by digest the smallest of the smallest identifiers and the sum of the counts, in order.

    Only rows whose digest, length and second hash all agree are one text. Minima of structs are taken by sorted aggregation on
    both sides of the exchange, so runs are merged as they are: in order.
    """
    return rows.groupBy(run.alias("run"), *KEY).agg(F.min("least").alias("least"), F.sum("n").alias("n"))


def groups(rows: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """One row per text of :func:`digests`' rows: ``digest, n_bytes, check, least, n``."""
    least = F.struct(F.col("id").isNull().alias("null"), "id", "at")
    runs = written(merged(rows.select("run", *KEY, least.alias("least"), F.lit(1).cast("long").alias("n")), F.col("run")))
    last = runs.agg(F.max("run")).first()[0] or 0
    while last > 0:
        following = written(merged(runs, F.floor(F.col("run") / fan_in).cast("int")))
        discard(runs)
        runs, last = following, last // fan_in
    return runs.drop("run")


def mark(df: DataFrame, key: str = "doc_id", text: str = "text", fan_in: int = FAN_IN) -> DataFrame:
    """Per row ``key, keep_id, group_size, kept, text_sha256``: of equal texts the row with the smallest key stays.

    Texts are equal if they are after white space is normalised; a null text counts as empty. A null key is larger than
    any other; of rows with the same key and text one stays, and all count. Other columns of df have no part, whatever
    they are called; an empty table gives an empty table.
    """
    rows = written(digests(df, key, text))
    found = groups(rows, fan_in).withColumnRenamed("n", "_n").withColumn("group_size", F.col("_n"))
    n = rows.count()
    done = join_hot(rows, found, KEY, n)
    return done.select(F.col("id").alias(key), F.col("least.id").alias("keep_id"), "group_size", (F.col("least.at") == F.col("at")).alias("kept"), F.col("digest").alias("text_sha256"))


def unique(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of df that stay, with all their columns (see :func:`mark`)."""
    stay = mark(df.select(F.col(f"`{key}`"), F.col(f"`{text}`")), key, text).where("kept").select(F.col(key).alias("_id"), F.col("text_sha256").alias("_sha"))
    rows = without(df, "_own").withColumn("_own", F.sha2(normalised(F.col(f"`{text}`")), 256))
    same = F.col(f"`{key}`").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_sha"))
    return rows.join(stay, same, "left_semi").dropDuplicates([key, "_own"]).drop("_own")
