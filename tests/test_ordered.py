"""Windows over long series, in many chunks, against the same in plain Python; as-of joins at any times."""

import random
import time
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from apsis.operators import asof, incremental, ordered, segments

START = datetime(2024, 1, 1)


def series(n, seed=1):
    """(id, key, time, value): half of the rows have one key; equal times, long gaps, null times, keys and values."""
    rng = random.Random(seed)
    t, rows = START, []
    for i in range(n):
        t += timedelta(seconds=rng.choice([0, 1, 60, 600, 5000, 90_000]))
        key = "hot" if rng.random() < 0.5 else rng.choice(["a", "b", "c", None])
        rows.append((i, key, t if rng.random() < 0.97 else None, rng.choice([None, 1, 5, 9, 40])))
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, key string, t timestamp_ntz, v long")


def in_order(rows):
    return sorted(rows, key=lambda r: (r[2] is not None, r[2] or START, r[0]))


@pytest.mark.parametrize("chunks", [1, 7, 60])
def test_sums_and_fills(spark, chunks):
    rows = series(800)
    df = frame(spark, rows)
    got = {r.id: (r.total, r.n) for r in ordered.running_sums(df, {"total": F.col("v"), "n": F.lit(1)}, ["key"], ["t", "id"], chunks).collect()}
    filled = {r.id: r.v for r in ordered.fill_series(df, ["v"], ["t", "id"], chunks=chunks).collect()}
    by_key = {r.id: r.v for r in ordered.fill_series(df, ["v"], ["t", "id"], ["key"], chunks).collect()}
    totals, last, lasts, want, want_filled, want_by_key = {}, None, {}, {}, {}, {}
    for i, k, _, v in in_order(rows):
        total, n = totals.get(k, (None, 0))
        totals[k] = want[i] = ((total or 0) + v if v is not None else total, n + 1)
        last = v if v is not None else last
        lasts[k] = v if v is not None else lasts.get(k)
        want_filled[i], want_by_key[i] = last, lasts[k]
    assert got == want and filled == want_filled and by_key == want_by_key


@pytest.mark.parametrize("chunks", [1, 40])
def test_split_long_is_split_at_breaks(spark, chunks):
    df = frame(spark, series(800, 2)).where("key is not null")
    rules = [segments.gap_over("t", 2), segments.rise_over("v", 20)]
    want = {r.id: r.segment_id for r in segments.split_at_breaks(df, ["key"], ["t", "id"], rules).collect()}
    got = {r.id: r.segment_id for r in segments.split_long(df, ["key"], ["t", "id"], rules, chunks=chunks).collect()}
    assert got == want and len(set(got.values())) > 50


@pytest.mark.parametrize("chunks,seconds,closed", [(1, 3600, False), (50, 3600, False), (50, 3600, True), (20, 10_000_000, False)])
def test_rolling_series(spark, chunks, seconds, closed):
    """Windows within a chunk, over several, and over all of them; a row a second earlier counts or not."""
    rows = series(500, 3) + [(9000, "a", START + timedelta(days=1), 7), (9001, "a", START + timedelta(days=1, seconds=seconds), 8)]
    got = {r.id: (r.n, r.s) for r in ordered.rolling_series(frame(spark, rows), "t", seconds, {"n": F.count(F.lit(1)), "s": F.sum("v")}, closed, chunks).collect()}
    span, want = timedelta(seconds=seconds), {}
    for i, _, t, _ in rows:
        own = [v for _, _, u, v in rows if (u is None if t is None else u is not None and u <= t and (t - u < span or closed and t - u == span))]
        want[i] = len(own), sum(v for v in own if v is not None) if any(v is not None for v in own) else None
    assert got == want


@pytest.mark.parametrize("chunks,seconds,closed", [(1, 3600, False), (50, 3600, False), (50, 3600, True), (20, 10_000_000, False), (9, 1, True)])
def test_rolling_series_by_parts(spark, chunks, seconds, closed):
    """Aggregates joined from parts are those over all rows of a window, at the edges of blocks and before 1970 too."""
    edges = [datetime(1970, 1, 1) + timedelta(seconds=k * seconds, microseconds=e) for k in (-2, -1, 0, 1) for e in (-1, 0, 1)]
    rows = series(400, 5) + [(7000 + i, "a", t, i) for i, t in enumerate(edges)]
    df = frame(spark, rows).withColumn("d", F.col("v").cast("decimal(9,2)"))
    pairs = {"n": (F.count, F.col("v")), "s": (F.sum, F.col("v")), "d": (F.sum, F.col("d")), "lo": (F.min, F.col("v")), "hi": (F.max, F.col("v"))}
    done = ordered.rolling_series(df.withColumnRenamed("d", "e"), "t", seconds, pairs | {"d": (F.sum, F.col("e")), "all": F.count(F.lit(1))}, closed, chunks)
    assert done.schema["d"].dataType == df.agg(F.sum("d").alias("d")).schema["d"].dataType
    got = {r.id: (r["all"], r.n, r.s, r.d, r.lo, r.hi) for r in done.collect()}
    span, want = timedelta(seconds=seconds), {}
    for i, _, t, _ in rows:
        own = [v for _, _, u, v in rows if (u is None if t is None else u is not None and u <= t and (t - u < span or closed and t - u == span))]
        known = [v for v in own if v is not None]
        want[i] = (len(own), len(known), *((sum(known), sum(known), min(known), max(known)) if known else [None] * 4))
    assert got == want


def test_rolling_series_costs_no_more_for_longer_windows(spark):
    """Windows of 100 and of 300,000 rows: row by row, the second is hundreds of times as much work."""
    df = spark.range(300_000).select("id", F.timestamp_seconds("id").cast("timestamp_ntz").alias("t"))
    took = []
    for seconds in (100, 300_000):
        began = time.monotonic()
        done = ordered.rolling_series(df, "t", seconds, {"n": (F.count, F.lit(1)), "hi": (F.max, -F.col("id"))})
        wrong = done.where(f"n <> least(id + 1, {seconds}) or hi <> -greatest(id - {seconds - 1}, 0)").count()
        took.append(time.monotonic() - began)
        assert wrong == 0 and done.count() == 300_000
    assert took[1] < 5 * took[0] + 10


def test_chunks_of_a_hot_key_are_even(spark):
    """One key with half of the rows: no chunk holds more than a few times its share."""
    df = spark.range(40_000).select("id", F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 997)).alias("key"), F.timestamp_seconds(F.col("id") * 37 % 40_009).cast("timestamp_ntz").alias("t"))
    sizes = [r["count"] for r in ordered.place(df, ["key"], ["t", "id"], 20).groupBy("_chunk").count().collect()]
    assert len(sizes) == 20 and max(sizes) < 2.5 * 40_000 / 20


def latest(lefts, rights):
    """(id, payload) of lefts (id, key, t) by rights (key, t, tie)."""
    out = []
    for i, k, t in lefts:
        own = [(u, x) for k2, u, x in rights if k2 == k and t is not None and u is not None and u <= t]
        out.append((i, max(own)[1] if own else None))
    return sorted(out)


@pytest.mark.parametrize("kind,tie", [("string", str), ("decimal(9,2)", lambda x: Decimal(x) / 4), ("timestamp_ntz", lambda x: START + timedelta(x)), ("long", int)])
def test_asof_ties_of_any_type(spark, kind, tie):
    """Ties are ordered as their type is, text as text; keyed by window, keyed by chunks and without keys."""
    rng = random.Random(4)
    lefts = [(i, rng.choice(["a", "b", None]), START + timedelta(minutes=rng.randrange(300)) if i else None) for i in range(120)]
    rights = [(rng.choice(["a", "b", None]), START + timedelta(minutes=rng.randrange(0, 300, 10)) if i else None, tie(x)) for i, x in enumerate(rng.sample(range(1000), 120))]
    left = spark.createDataFrame(lefts, "id long, key string, t timestamp_ntz")
    right = spark.createDataFrame(rights, f"key string, rt timestamp_ntz, x {kind}")

    def rows(df):
        return sorted((r.id, r.x) for r in df.collect())

    want = latest(lefts, rights)
    assert rows(asof.asof_backward(left, right, "t", "rt", ["key"], ["x"], tie="x")) == want
    assert rows(asof.asof_backward(left, right, "t", "rt", ["key"], ["x"])) == want
    assert rows(asof.asof_any(left, right, "t", "rt", ["x"], ["key"], "x", 9)) == want
    assert rows(asof.asof_any(left, right.drop("key"), "t", "rt", ["x"], chunks=9)) == latest([(i, 0, t) for i, _, t in lefts], [(0, t, x) for _, t, x in rights])


def test_asof_daily_refuses_times_within_a_day(spark):
    left = spark.createDataFrame([(1, START + timedelta(hours=6)), (2, START + timedelta(days=40)), (3, None), (4, START - timedelta(days=1))], "id long, t timestamp_ntz")
    evening = spark.createDataFrame([(START + timedelta(hours=18), "evening")], "rt timestamp_ntz, x string")
    with pytest.raises(ValueError):
        asof.asof_daily(left, evening, "t", "rt", ["x"])
    assert [r.x for r in asof.asof_any(left, evening, "t", "rt", ["x"]).orderBy("id").collect()] == [None, "evening", None, None]
    days = spark.createDataFrame([(START, "first"), (START + timedelta(days=3), "last")], "rt timestamp_ntz, x string")
    assert [r.x for r in asof.asof_daily(left, days, "t", "rt", ["x"]).orderBy("id").collect()] == ["first", "last", None, None]


def test_no_rows(spark):
    df = frame(spark, [])
    assert ordered.running_sums(df, {"n": F.lit(1)}, ["key"], ["t", "id"]).collect() == []
    assert ordered.rolling_series(df, "t", 60, {"n": F.count(F.lit(1))}).collect() == []
    assert asof.asof_any(df, df.select("t", F.col("v").alias("x")).withColumnRenamed("t", "rt"), "t", "rt", ["x"]).collect() == []


def test_upsert_needs_a_rule_for_every_column(spark):
    old = spark.createDataFrame([(1, 2, 3)], "k long, v long, w long")
    with pytest.raises(ValueError, match="w"):
        incremental.merge_upsert(old, old, ["k"], {"v": "replace"})
    with pytest.raises(ValueError, match="w"):
        incremental.merge_upsert(old, old.drop("w"), ["k"], {"v": "replace", "w": "replace"})
