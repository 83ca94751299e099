"""A table that takes upserts: what readers and other writers see, and what a failed job leaves."""

import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from apsis.sources.store import Store

SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()), T.StructField("v", T.LongType()), T.StructField("n", T.LongType())])
RULES = {"v": "coalesce", "n": "add"}


def rows(spark, *rs):
    return spark.createDataFrame(list(rs), SCHEMA)


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_versions_and_untouched_parts(spark, tmp_path):
    store = Store(spark, str(tmp_path / "t"), SCHEMA, ["a", "b"], parts=8)
    assert content(store.read()) == []
    assert store.upsert(rows(spark, (1, "x", 5, 1), (2, "y", 6, 1), (None, "z", 7, 1)), RULES) == 1
    before = store.read()
    _, first = store._manifest()
    assert store.upsert(rows(spark, (2, "y", None, 4), (None, "z", 9, 1)), RULES) == 2
    assert content(store.read()) == content(rows(spark, (1, "x", 5, 1), (2, "y", 6, 5), (None, "z", 9, 2)))
    assert content(before) == content(store.read(1)) == content(rows(spark, (1, "x", 5, 1), (2, "y", 6, 1), (None, "z", 7, 1)))
    _, second = store._manifest()
    assert {p for p in second if first.get(p) != second[p]} == {str(r[0]) for r in rows(spark, (2, "y", 0, 0), (None, "z", 0, 0)).select(F.pmod(F.xxhash64("a", "b"), F.lit(8))).distinct().collect()}
    with pytest.raises(ValueError):
        Store(spark, str(tmp_path / "t"), SCHEMA, ["a"], parts=8).read()


def test_failed_job_leaves_the_table(spark, tmp_path):
    store = Store(spark, str(tmp_path / "t"), SCHEMA, ["a", "b"], parts=4)
    store.upsert(rows(spark, (1, "x", 5, 1)), RULES)
    merged = store._merged
    store._merged = lambda *a: merged(*a) and 1 / 0  # the rows are written, the job is lost before it publishes
    with pytest.raises(ZeroDivisionError):
        store.upsert(rows(spark, (1, "x", 6, 1)), RULES)
    store._merged = merged
    assert content(store.read()) == [(1, "x", 5, 1)] and store.versions() == [1]
    assert store.vacuum(hours=0) == 1
    assert store.upsert(rows(spark, (1, "x", 6, 1)), RULES) == 2 and content(store.read()) == [(1, "x", 6, 2)]


def test_a_number_is_taken_once(spark, tmp_path):
    store = Store(spark, str(tmp_path / "t"), SCHEMA, ["a", "b"])
    assert store._publish(1, {}) and not store._publish(1, {}) and store._publish(2, {})


def test_two_writers(spark, tmp_path):
    """Writers of the same key and of others at once: no addition is lost."""
    path, errors = str(tmp_path / "t"), []

    def write(i):
        try:
            store = Store(spark, path, SCHEMA, ["a", "b"], parts=4)
            for _ in range(3):
                store.upsert(rows(spark, (0, "shared", i, 1), (i, "own", i, 1)), RULES)
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=write, args=(i,)) for i in (1, 2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    got = {(r.a, r.b): r.n for r in Store(spark, path, SCHEMA, ["a", "b"], parts=4).read().collect()}
    assert got == {(0, "shared"): 6, (1, "own"): 3, (2, "own"): 3}
