"""Medians of groups beyond a task, counts taken while rows are written, newest files, many ids."""

import os
import random
import statistics
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from apsis.operators import aggregate, validate
from apsis.sources import tables


def test_large_median(spark):
    """Skewed values, ties in the middle, negative and infinite ones, even and odd groups, a null group, nulls and NaN."""
    rng = random.Random(7)
    groups = {
        "skewed": [10 ** rng.uniform(-30, 30) * rng.choice([-1, 1]) for _ in range(3001)],
        "tied": [5.0] * 2000 + [rng.random() * 10 for _ in range(1000)],
        "edge": [1.0] * 1500 + [2.0] * 1500,
        "infinite": [float("inf")] * 1200 + [float("-inf")] * 600 + [float(i) for i in range(1201)],
        None: [rng.gauss(0, 1) for _ in range(2500)],
        "small": [3.0, 1.0, 2.0, 9.0],
        "one": [4.5],
    }
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("tied", None), ("tied", float("nan")), ("nothing", None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v double")
    for large in (40, 10_000):
        got = {r.k: (r.median, r.n) for r in aggregate.large_median(df, ["k"], "v", large).collect()}
        assert got == {k: (statistics.median(vs), len(vs)) for k, vs in groups.items()}
    assert aggregate.large_median(df.limit(0), ["k"], "v").collect() == []


def test_counts_while_writing(spark, tmp_path):
    rows = [(1, "2024-01-05"), (2, "2024-01-15"), (-1, "2024-01-20"), (None, "2024-01-20"), (4, "no time"), (5, "2024-02-01")]
    df = spark.createDataFrame(rows, "v long, t string")
    rules = [validate.Rule("v", "long", required=True, ge=0)]
    good, seen = validate.observed(df, rules, "t", datetime(2024, 1, 10))
    good.write.parquet(str(tmp_path / "good"))
    assert seen.get == {"input": 6, "valid": 2, "filtered": 1, "invalid": 3}
    assert sorted(r.v for r in spark.read.parquet(str(tmp_path / "good")).collect()) == [2, 5]
    again, counts = validate.counted(df, rules, "t", datetime(2024, 1, 10))
    assert counts.first().asDict() == seen.get and again.columns == df.columns
    spark.range(3).write.parquet(str(tmp_path / "three"))
    plan = validate.counted(spark.read.parquet(str(tmp_path / "three")), [validate.Rule("id", ge=1)])[1]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan


def test_newest_by_time_and_not_by_name(spark, tmp_path):
    for i, v in enumerate(("b", "c", "a")):
        path = tables.write_version(spark.range(i + 1), str(tmp_path), v)
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    assert tables.newest(spark, f"{tmp_path}/version=*").endswith("version=a")
    assert tables.read_latest(spark, str(tmp_path), by_time=True).count() == 3 and tables.read_latest(spark, str(tmp_path)).count() == 2
    with pytest.raises(FileNotFoundError):
        tables.newest(spark, f"{tmp_path}/none*")


def test_history_of_many_ids(spark):
    df = spark.range(0, 3_000_000, 1000).select("id", F.timestamp_seconds("id").cast("timestamp_ntz").alias("t"))
    want = 1000
    many = list(range(1_000_000))
    found = tables.history(df, many, "id", "t")
    assert len(found._jdf.queryExecution().optimizedPlan().toString()) < 20_000  # no literal per id
    assert found.count() == want
    assert tables.history(df, spark.range(1_000_000), "id", "t", datetime(1970, 1, 1, 0, 0, 5000 // 1000)).count() == want - 1
    assert tables.history(df, [0, 1000, 7], "id", "t").count() == 2
