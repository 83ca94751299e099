"""Stored tables over JDBC, tried on the database that comes with Spark."""

from datetime import datetime, timedelta

import pytest

from apsis.sources import jdbc

DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def stored(spark):
    url = "jdbc:derby:memory:apsis;create=true"
    df = spark.createDataFrame([(i, f"sat{i % 7}", START + timedelta(hours=i)) for i in range(500)], "id long, name string, epoch timestamp_ntz")
    df.write.format("jdbc").options(url=url, driver=DRIVER, dbtable="orbits", createTableColumnTypes="name VARCHAR(40)").mode("overwrite").save()
    jdbc.connect(spark, "derby", url, DRIVER)
    return url


def test_the_database_takes_maxima_and_counts(spark, stored):
    found = jdbc.summary(spark, "derby.APP.ORBITS", "epoch", ["name"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregates" in plan and "MAX" in plan and "COUNT(DISTINCT" in plan
    assert tuple(found.first()) == (500, START + timedelta(hours=499), 7)
    by_name = {r.name: (r.rows, r.last) for r in jdbc.summary(spark, "derby.APP.ORBITS", "epoch", [], ["name"]).collect()}
    assert by_name["sat0"] == (72, START + timedelta(hours=497)) and len(by_name) == 7


def test_reads_in_parts(spark, stored):
    df = jdbc.read_parts(spark, stored, DRIVER, "orbits", '"id"', 5, "\"name\" <> 'sat3'")
    late = df.where("id >= 400").select("id")
    assert df.rdd.getNumPartitions() == 5 and sorted(r.id for r in late.collect()) == [i for i in range(400, 500) if i % 7 != 3]
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(id,400)" in plan and "epoch" not in plan.split("Relation")[-1]
    assert jdbc.read_parts(spark, stored, DRIVER, "orbits", '"id"', 5, '"id" < 0').count() == 0


def test_inserts_ignore_known_keys(spark, stored):
    new = spark.createDataFrame([(i, f"new{i}", START) for i in [498, 499, 500, 501, 501, 502]] + [(None, "no key", START)], "id long, name string, epoch timestamp_ntz")
    assert jdbc.insert_new(new, stored, DRIVER, "orbits", ["id"], batch=2) == 3
    assert jdbc.insert_new(new, stored, DRIVER, "orbits", ["id"]) == 0
    rows = spark.read.format("jdbc").options(url=stored, driver=DRIVER, dbtable="orbits").load()
    assert rows.count() == 503 and {r.name for r in rows.where("id >= 498").collect()} == {"sat1", "sat2", "new500", "new501", "new502"}
    tables = spark.read.format("jdbc").options(url=stored, driver=DRIVER, query="select tablename from sys.systables where tabletype = 'T'").load()
    assert [r[0] for r in tables.collect()] == ["ORBITS"]  # nothing is left aside
