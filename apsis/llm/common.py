"""What the operators of this subpackage share: reading tables, cutting lineage, word splitting."""

from __future__ import annotations

import atexit
import ctypes
import functools
import shutil
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words: blank and the controls 0x09 to 0x0D.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@functools.cache
def _own_dir() -> str:
    path = tempfile.mkdtemp(prefix="apsis-checkpoint-")
    atexit.register(shutil.rmtree, path, True)
    return path


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; on a local master, where that may be unset (tests), one of our own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return named or _own_dir()


def written(df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: lineage is cut and lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/apsis/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete what :func:`written` wrote, once nothing will read it again."""
    sc = df.sparkSession.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(df.written_path)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def give_back(result=None):
    """The result, after what this Python worker has freed went back to the system.

    Spark keeps workers for the tasks of later stages, where what Arrow and the C library hold in reserve counts beside theirs.
    """
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc's
        trim(0)
    return result


#: Rows of a key beyond which its side is broadcast; a larger table has at most MOST_HOT such keys.
HOT_ROWS, MOST_HOT = 100_000, 1000


def join_hot(rows: DataFrame, side: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Inner join of n rows with one row a key, of whose column ``_n`` (about how many of the rows have it) the hot keys are known.

    Rows of hot keys stay where they are and the few sides come to them; the others are joined by shuffle. Keys are not null.
    """
    least = max(HOT_ROWS, n // MOST_HOT)
    if n <= least:  # no key can have so many
        return rows.join(side.drop("_n"), keys)
    hot = F.broadcast(side.where(F.col("_n") > least).drop("_n"))
    rest = side.where(F.col("_n") <= least).drop("_n")
    return rows.join(hot, keys).unionByName(rows.join(hot.select(*keys), keys, "left_anti").join(rest, keys))


def without(df: DataFrame, *names: str) -> DataFrame:
    """df less the columns that an operator is about to add; a clashing input column is replaced by the result's."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def words(text):
    """Column of the words of a text (null: none)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), lambda w: w != "")


def text_bytes(df: DataFrame, text: str = "text") -> tuple[int, int]:
    """Rows and UTF-8 bytes of a text column, for sizing partitions."""
    n, size = df.agg(F.count(F.lit(1)), F.sum(F.octet_length(text))).first()
    return n, size or 0
