"""From raw documents to token ids: five stages, each written as Parquet and read again by the next.

The stages use the operators with the parameters below and work on all rows that their predecessor kept. Near-duplicates
are taken at five-word shingles and a Jaccard similarity of 0.8: candidates share the least hashes of a band and differ in
at most 72 of the 256 bits of four independent fingerprints, and are accepted by their shingles alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apsis.llm import bpe, decontamination, quality, simhash, substring_dedup
from apsis.llm.common import discard, table, written
from apsis.llm.queries import vocabulary_path

FINGERPRINTS = ("fp0", "fp1", "fp2", "fp3")
SHINGLE, RADIUS, MOST_BITS, SIMILAR = 5, 26, 72, 0.8


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior of being good is at least one half."""
    measured = quality.measure(docs)
    model = quality.fit(measured, table(spark, sf_dir, "labels"))
    return quality.score(measured, model).where("keep").select(docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest id (null last), then of the smallest hash of its columns.

    So the same documents stay however the files are split and read; of rows that are equal throughout any one stays.
    """
    rows = docs.withColumn("_row", F.monotonically_increasing_id())
    grouped = simhash.near_duplicates(rows.select("_row", "text"), "_row", shingle=SHINGLE, radius=RADIUS, fps=FINGERPRINTS, most=MOST_BITS, least=SIMILAR)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64(*docs.columns), "_row")
    first = grouped.join(rows.select("_row", order.alias("_order")), "_row").groupBy("component_id").agg(F.min("_order").alias("_order")).select(F.col("_order._row").alias("_row"))
    return rows.join(first, "_row", "left_semi").select(docs.columns)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less their repeated passages; n_chars follows the text. A document may be left empty, but stays."""
    done = substring_dedup.remove_repeats(docs)
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    rows = docs.withColumn("_row", F.monotonically_increasing_id())
    found = decontamination.contaminated(rows.select("_row", "text"), table(spark, sf_dir, "benchmark"), "_row")
    return rows.join(found.select("_row").distinct(), "_row", "left_anti").select(docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, their number, and the text decoded from them."""
    done = bpe.encode(docs, bpe.Vocabulary(spark, vocabulary_path()), decoded="decoded")
    return done.select("doc_id", "lang", "source", "n_chars", "n_tokens", "ids", "decoded")


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", without_near_duplicates),
    ("substrings", without_repeats),
    ("decontamination", decontaminated),
    ("bpe", encoded),
]

#: The stages need models, hashing and merging that SQL cannot express; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
        if before is not None:
            discard(before)  # the stage has been written, so nothing reads what it was made of again
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
