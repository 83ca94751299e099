"""Streams over files: the same rows as in batch, and a sink that takes nothing twice."""

import random
import time
from datetime import datetime, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from apsis.operators import segments
from apsis.streaming import streams


def landed(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    path = str(tmp_path / "events")
    events.repartition(3).write.parquet(path)
    return events, spark.readStream.schema(events.schema).parquet(path)


def run(stream, tmp_path, name):
    query = stream.writeStream.format("parquet").option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / f"{name}-check")).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(str(tmp_path / name))


def test_append_stream_is_idempotent(spark, sf, tmp_path):
    events, stream = landed(spark, sf, tmp_path)
    once = streams.deltas_once(stream, ["event_id"], "ts", "60 days")
    target = str(tmp_path / "target")
    for check in ("c1", "c2"):
        streams.append_stream(once, target, ["event_id"], str(tmp_path / check)).awaitTermination()
    assert spark.read.parquet(target).count() == events.count()
    streams.append_stream(stream, target, ["event_id", "ts"], str(tmp_path / "c3"), within="ts").awaitTermination()
    assert spark.read.parquet(target).count() == events.count()


def test_sessions_and_means(spark, sf, tmp_path):
    events, stream = landed(spark, sf, tmp_path)
    got = run(streams.gap_sessions(stream, ["user_id"], "ts"), tmp_path, "sessions")
    means = run(streams.windowed_mean(stream, ["user_id"], "ts", "value"), tmp_path, "means")
    # What the streams have closed are the batch's own sessions and means.
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    far = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lag("ts").over(w).cast("timestamp")) >= 86_400_000_000
    cut = events.withColumn("s", F.sum(F.coalesce(far, F.lit(False)).cast("int")).over(w))
    spans = cut.groupBy("user_id", "s").agg(F.min("ts").cast("timestamp").alias("seg_start"), F.max("ts").cast("timestamp").alias("seg_end"), F.count(F.lit(1)).alias("n_rows")).drop("s")
    assert got.count() > 0 and got.exceptAll(spans.select(got.columns)).count() == 0
    by_day = events.groupBy("user_id", F.date_trunc("day", F.col("ts").cast("timestamp")).alias("start")).agg(F.avg("value").alias("m"), F.count(F.lit(1)).alias("n"))
    both = means.join(by_day, ["user_id", "start"])
    assert 0 < means.count() == both.where("n = n_rows and abs(m - mean) < 1e-9").count()


def test_break_segments_are_those_of_the_batch(spark, tmp_path):
    """Rows come in five files out of order, some twice; gaps and rises; a file far ahead lets the watermark pass them all."""
    rng = random.Random(9)
    start, rows = datetime(2024, 1, 1), []
    for i in range(240):
        start += timedelta(minutes=rng.choice([1, 30, 200]))
        rows.append((rng.choice(["a", "b"]), start, i, rng.choice([None, 1.0, 2.0, 30.0])))
    schema = "k string, t timestamp_ntz, id long, v double"
    batch = spark.createDataFrame(rows, schema)
    rules = [segments.gap_over("t", 2), segments.rise_over("v", 20.0)]
    want = {r.id: r.segment_id for r in segments.split_at_breaks(batch, ["k"], ["t", "id"], rules).collect()}

    source = tmp_path / "source"
    parts = [rows[i : i + 60] for i in range(0, 240, 60)] + [rows[100:110], [(k, datetime(2030, 1, 1), 999, 0.0) for k in "ab"]]
    for before, after in zip(parts[:3], parts[1:4]):
        after += [before.pop(rng.randrange(40)) for _ in range(5)]  # late, but not too late
    for part in parts:
        spark.createDataFrame(rng.sample(part, len(part)), schema).coalesce(1).write.mode("append").parquet(str(source))
        time.sleep(1.1)  # files are taken in order of time
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source))
        got = run(streams.break_segments(stream, ["k"], "t", "id", streams.Breaks(2, 20.0), "v", "200 hours"), tmp_path, "segments").collect()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    got = {r.id: r.segment_id for r in got if r.id != 999}
    assert got == want
