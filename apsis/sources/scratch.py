"""Tables that live as long as a job: written to the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _own_dir() -> str:
    path = tempfile.mkdtemp(prefix="apsis-scratch-")
    atexit.register(shutil.rmtree, path, True)
    return path


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where that is unset, on one machine alone (``local[...]``), one of our own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return named or _own_dir()


def written(df: DataFrame) -> DataFrame:
    """df as Parquet in the shared folder, read again: computed once, and safe from lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/apsis/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
