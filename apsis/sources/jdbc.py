"""Tables of a database over JDBC: reads in parts, maxima and counts taken by the database, inserts that ignore known keys.

A database is a catalogue of the session (``connect``), so filters, columns, aggregates and limits are pushed into its SQL.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CATALOGUE = "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog"


def connect(spark: SparkSession, name: str, url: str, driver: str, **options: str) -> None:
    """Make a database known to the session as the catalogue ``name``; its tables are ``name.schema.table``."""
    settings = {"url": url, "driver": driver, "pushDownAggregate": "true", "pushDownLimit": "true", **options}
    spark.conf.set(f"spark.sql.catalog.{name}", CATALOGUE)
    for k, v in settings.items():
        spark.conf.set(f"spark.sql.catalog.{name}.{k}", v)


def summary(spark: SparkSession, table: str, ts: str, keys: list[str], by: list[str] | None = None) -> DataFrame:
    """``rows``, ``last`` (the latest time) and ``n_<key>`` (distinct values) of a stored table, in groups if asked; the database counts."""
    counts = [F.count(F.lit(1)).alias("rows"), F.max(ts).alias("last"), *[F.count_distinct(k).alias(f"n_{k}") for k in keys]]
    return spark.table(table).groupBy(*(by or [])).agg(*counts)


def read_parts(spark: SparkSession, url: str, driver: str, table: str, column: str, parts: int, where: str | None = None) -> DataFrame:
    """A table read by so many connections, each a range of a whole number column or time; where is SQL of the database.

    The ranges are of equal width between the column's least and largest value, which the database finds; rows without a
    value come with the first.
    """
    source = f"(select * from {table} where {where}) t" if where else f"{table} t"
    options = {"url": url, "driver": driver}
    least, most = spark.read.format("jdbc").options(**options, query=f"select min({column}) a, max({column}) b from {source}").load().first()
    reader = spark.read.format("jdbc").options(**options, dbtable=source)
    if least is not None and parts > 1:
        reader = reader.options(partitionColumn=column, lowerBound=str(least), upperBound=str(most), numPartitions=str(parts))
    return reader.load()


def insert_new(rows: DataFrame, url: str, driver: str, table: str, keys: list[str], batch: int = 10_000) -> int:
    """Insert rows whose keys the table lacks, each key once, and return how many; run again it inserts nothing.

    Executors write a table aside, whatever fails and is repeated; then one statement of the database moves what is new, so the
    table has all of it or none. Of rows with one key one stays; null keys are never known, so rows with one are left out.
    """
    spark = rows.sparkSession
    aside = f"aside_{uuid.uuid4().hex[:12]}"
    once = rows.dropna(subset=keys).dropDuplicates(keys)
    jvm = spark.sparkContext._jvm
    jvm.java.lang.Class.forName(driver)
    connection = jvm.java.sql.DriverManager.getConnection(url)
    connection.setAutoCommit(False)
    statement = connection.createStatement()
    statement.executeUpdate(f"create table {aside} as select * from {table} with no data")
    connection.commit()
    try:
        once.write.format("jdbc").options(url=url, driver=driver, dbtable=aside, batchsize=str(batch)).mode("append").save()
        # The columns are quoted as Spark quotes those of the table aside; a key may be there twice if a task was run again.
        names = [f'"{c}"' for c in rows.columns]
        key = " and ".join(f't."{k}" = s."{k}"' for k in keys)
        known = f"select 1 from {table} t where {key}"
        chosen = ", ".join(n if c in keys else f"max({n})" for c, n in zip(rows.columns, names))
        group = ", ".join(f'"{k}"' for k in keys)
        inserted = statement.executeUpdate(f"insert into {table} ({', '.join(names)}) select {chosen} from {aside} s where not exists ({known}) group by {group}")
        connection.commit()
        return inserted
    except Exception:
        connection.rollback()
        raise
    finally:
        statement.executeUpdate(f"drop table {aside}")
        connection.commit()
        connection.close()
