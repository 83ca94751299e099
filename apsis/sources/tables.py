"""Parquet and JSON tables: manifests, snapshots and deltas, roles from paths."""

from __future__ import annotations

import uuid
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns of a raw record; they arrive as text or number and are landed as text, but for the id.
RAW_COLUMNS = (
    "EPOCH", "OBJECT_NAME", "OBJECT_TYPE", "RCS_SIZE", "COUNTRY_CODE", "CREATION_DATE", "LAUNCH_DATE", "DECAY_DATE", "MEAN_MOTION",
    "ECCENTRICITY", "INCLINATION", "RA_OF_ASC_NODE", "ARG_OF_PERICENTER", "MEAN_ANOMALY", "BSTAR", "MEAN_MOTION_DOT", "MEAN_MOTION_DDOT",
    "SEMIMAJOR_AXIS", "PERIOD", "APOAPSIS", "PERIAPSIS", "REV_AT_EPOCH", "TLE_LINE0", "TLE_LINE1", "TLE_LINE2",
)
RAW = T.StructType([T.StructField("NORAD_CAT_ID", T.LongType()), *[T.StructField(c, T.StringType()) for c in RAW_COLUMNS]])


def read_manifest(spark: SparkSession, paths: list[str], schema: T.StructType | None = None) -> DataFrame:
    """The files of a manifest as one table; an empty manifest needs a schema."""
    if not paths:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(*paths)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Landed JSON arrays, one a file; compressed files by their suffix."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


#: Ids that are written into a plan as literals; more come as a table.
LITERAL_IDS = 200


def history(df: DataFrame, ids: list[int] | DataFrame, id_col: str, ts: str, since=None) -> DataFrame:
    """Rows of some ids, later than a time if given. The time, and a few ids, are pushed into the scan.

    Many ids, or a table whose first column holds them, are a semi-join: Spark broadcasts them if they are small, else
    prunes by partition or with a Bloom filter where it can. A null id has no rows.
    """
    if since is not None:
        df = df.where(F.col(ts) > F.lit(since))
    if not isinstance(ids, DataFrame):
        if len(ids) <= LITERAL_IDS:
            return df.where(F.col(id_col).isin(ids))
        pdf = pd.DataFrame({"_id": pd.Series(list(ids), dtype="Int64")})
        ids = df.sparkSession.createDataFrame(pdf, "_id long")
    return df.join(ids.select(F.col(ids.columns[0]).alias("_id")), F.col(id_col) == F.col("_id"), "left_semi")


def with_role(df: DataFrame, path=None) -> DataFrame:
    """``role`` from the file's path, active or decayed; a file under neither raises when it is read."""
    path = F.col("_metadata.file_path") if path is None else path
    role = F.when(path.contains("/active/"), "active").when(path.contains("/decayed/"), "decayed")
    return df.withColumn("role", role.otherwise(F.raise_error(F.concat(F.lit("no role in "), path)).cast("string")))


def deltas(paths: list[str]) -> list[str]:
    return [p for p in paths if "/updates/delta_" in p]


def snapshots(paths: list[str]) -> list[str]:
    return [p for p in paths if p.rstrip("/").endswith("_latest.parquet")]


def write_version(df: DataFrame, root: str, version: str, partition_by: tuple[str, ...] = (), incremental: bool = False) -> str:
    """A run's rows as a version of its own, or appended to the updates; nothing written is changed later."""
    path = f"{root}/updates/version={version}" if incremental else f"{root}/version={version}"
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    return path


def _at(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _at(spark, path)
    return fs.exists(at)


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a file or a folder with what is in it; False if there is none."""
    fs, at = _at(spark, path)
    return fs.delete(at, True)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Rows as JSON objects, one a line, nulls left out."""
    df.write.mode(mode).json(path)


# The forms of the names below.
def batch_name(param_hash: str, number: int) -> str:
    """Name of a numbered batch of a request."""
    return f"data_{param_hash[:16]}_batch_{number:03d}.parquet"


def delta_name(at: datetime) -> str:
    """Name of a delta: its time, and four hex digits that keep deltas of one second apart."""
    return f"delta_{at:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:4]}.parquet"


def write_landed(df: DataFrame, root: str, name: str, max_records: int = 10_000) -> str:
    """Raw rows under a batch's or a delta's name (deltas under updates/), in files of so many rows at most."""
    path = f"{root}/updates/{name}" if name.startswith("delta_") else f"{root}/{name}"
    df.write.mode("errorifexists").option("maxRecordsPerFile", max_records).parquet(path)
    return path


def write_catalogue(chosen: DataFrame, id_col: str, root: str, category: str, seed: int | None = None) -> str:
    """The objects of a category, one JSON line each: ``category, seed, id`` and ``metadata`` (all their columns).

    It replaces the category's last one. Ids are kept as text; without a seed the field is left out.
    """
    path = f"{root}/category={category}"
    seeded = F.lit(seed).cast("long").alias("seed")
    write_json(chosen.select(F.lit(category).alias("category"), seeded, F.col(id_col).cast("string").alias("id"), F.struct("*").alias("metadata")), path)
    return path


def read_catalogue(spark: SparkSession, root: str, category: str) -> DataFrame | None:
    """Ids of a category's objects; None if it was never written."""
    path = f"{root}/category={category}"
    return spark.read.schema("id string").json(path) if exists(spark, path) else None


def newest(spark: SparkSession, pattern: str) -> str:
    """The path that was modified last among those that match a pattern; of equally new ones the last by name."""
    fs, at = _at(spark, pattern)
    found = [(s.getModificationTime(), s.getPath().getName(), s.getPath().toString()) for s in fs.globStatus(at) or []]
    if not found:
        raise FileNotFoundError(f"nothing matches {pattern}")
    return max(found)[2]


def read_latest(spark: SparkSession, root: str, by_time: bool = False) -> DataFrame:
    """The newest version under root, by name or by the time it was modified; only its folder is read."""
    if by_time:
        return spark.read.parquet(newest(spark, f"{root}/version=*"))
    fs, at = _at(spark, root)
    names = sorted(s.getPath().getName() for s in fs.listStatus(at) if s.getPath().getName().startswith("version="))
    if not names:
        raise FileNotFoundError(f"no version under {root}")
    return spark.read.parquet(f"{root}/{names[-1]}")


def append_new(new: DataFrame, target: str, keys: list[str], within: str | None = None) -> None:
    """Insert rows whose keys the target lacks; the target is created on first use.

    ``within`` names a key, such as a time, by whose least and largest new value the target's scan is pruned.
    """
    from ..operators.incremental import not_stored
    from ..operators.windows import keep_one

    spark = new.sparkSession
    once = keep_one(new, keys, [c for c in new.columns if c not in keys] or keys)
    if within is not None and within not in keys:
        raise ValueError(f"{within} is no key")
    if exists(spark, target):
        stored = spark.read.parquet(target)
        if within is not None:
            least, most = new.agg(F.min(within), F.max(within)).first()
            stored = stored.where(F.col(within).isNull() | F.col(within).between(F.lit(least), F.lit(most)))
        once = not_stored(once, stored, keys)
    once.write.mode("append").parquet(target)
