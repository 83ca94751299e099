"""Registered queries on the driver's tables: each applies an operator of the library, with equivalent SQL beside it.

events plays the time series (user as object, ts as epoch, value as element), the first six components of embeddings play
the state vector, customer the catalogue.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import RISK_BANDS
from .functions import orbit
from .functions.scalar import clip_above, json_row, json_value, number, rounded, whole
from .operators import aggregate, asof, incremental, ordered, sampling, segments, validate, windows
from .plans import control, environment, history, training
from .sources import feeds, store, tables
from .sources.json_arrays import read_json_arrays
from .sources.scratch import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark, sf_dir):
    return _t(spark, sf_dir, "events")


# Windows


@query("select event_id, round(avg(value) over (partition by user_id order by ts range between to_microseconds(86399999999) preceding and current row), 6) as mean_24h from events")
def rolling_mean(spark, sf_dir):
    df = windows.rolling(_events(spark, sf_dir), "ts", ["user_id"], 86_400, {"m": F.avg("value")})
    return df.select("event_id", rounded("m", 6).alias("mean_24h"))


@query("""with a as (select *, case when lag(ts) over w is null then 1 when floor((epoch_us(ts) - epoch_us(lag(ts) over w)) / 3600000000.0) > 24 then 1 else 0 end as n
  from events window w as (partition by user_id order by ts, event_id))
select event_id, user_id || '_Seg' || cast(sum(n) over (partition by user_id order by ts, event_id rows unbounded preceding) as bigint) as segment_id from a""")
def gap_segments(spark, sf_dir):
    return segments.split_at_breaks(_events(spark, sf_dir), ["user_id"], ["ts", "event_id"], [segments.gap_over("ts", 24)]).select("event_id", "segment_id")


@query("""with a as (select *, case when lag(ts) over w is null then 1 when floor((epoch_us(ts) - epoch_us(lag(ts) over w)) / 3600000000.0) > 12 then 1
  when value - lag(value) over w > 60 then 1 else 0 end as n from events window w as (partition by user_id order by ts, event_id))
select event_id, user_id || '_Seg' || cast(sum(n) over (partition by user_id order by ts, event_id rows unbounded preceding) as bigint) as segment_id from a""")
def break_segments(spark, sf_dir):
    rules = [segments.gap_over("ts", 12), segments.rise_over("value", 60.0)]
    return segments.split_at_breaks(_events(spark, sf_dir), ["user_id"], ["ts", "event_id"], rules).select("event_id", "segment_id")


_FLAGSHIP = """with a as (select *, case when lag(ts) over w is null then 1 when floor((epoch_us(ts) - epoch_us(lag(ts) over w)) / 3600000000.0) > 24 then 1 else 0 end as n
  from events window w as (partition by user_id order by ts, event_id)),
b as (select user_id, ts, user_id || '_Seg' || cast(sum(n) over (partition by user_id order by ts, event_id rows unbounded preceding) as bigint) as segment_id from a),
s as (select user_id, segment_id, min(ts) as seg_start, max(ts) as seg_end, count(*) as n_rows from b group by 1, 2)
select *, cast((epoch_us(seg_end) - epoch_us(seg_start)) // 86400000000 as bigint) as days from s where (epoch_us(seg_end) - epoch_us(seg_start)) // 86400000000 >= 1"""


@query(_FLAGSHIP)
def segment_report(spark, sf_dir):
    split = segments.split_at_breaks(_events(spark, sf_dir).select("user_id", "ts", "event_id"), ["user_id"], ["ts", "event_id"], [segments.gap_over("ts", 24)])
    spans = segments.segment_spans(split, ["user_id"], "segment_id", "ts")
    return spans.withColumn("days", whole("DAY", "seg_start", "seg_end")).where("days >= 1")


@query("""with a as (select *, case when lag(ts) over w is null then 1 when floor((epoch_us(ts) - epoch_us(lag(ts) over w)) / 3600000000.0) > 12 then 1 else 0 end as n
  from events window w as (partition by user_id order by ts, event_id)),
b as (select user_id, ts, event_id, user_id || '_Seg' || cast(sum(n) over (partition by user_id order by ts, event_id rows unbounded preceding) as bigint) as segment_id from a),
s as (select user_id, segment_id, max(ts) as seg_end from b group by 1, 2),
l as (select user_id, segment_id from s qualify row_number() over (partition by user_id order by seg_end desc, segment_id desc) = 1)
select event_id, segment_id from b semi join l using (user_id, segment_id)""")
def last_segment(spark, sf_dir):
    split = segments.split_at_breaks(_events(spark, sf_dir), ["user_id"], ["ts", "event_id"], [segments.gap_over("ts", 12)])
    return segments.gate_segments(split, ["user_id"], "segment_id", "ts", None, last_only=True).select("event_id", "segment_id")


@query("""with a as (select *, case when lag(ts) over w is null then 1 when floor((epoch_us(ts) - epoch_us(lag(ts) over w)) / 3600000000.0) > 12 then 1 else 0 end as n
  from events window w as (partition by user_id order by ts, event_id)),
b as (select user_id, ts, event_id, max(ts) over (partition by user_id) as last_ts, user_id || '_Seg' || cast(sum(n) over (partition by user_id order by ts, event_id rows unbounded preceding) as bigint) as segment_id from a),
s as (select user_id, segment_id from b group by 1, 2 having (epoch_us(max(ts)) - epoch_us(min(ts))) // 86400000000 >= 1 and (epoch_us(min(last_ts)) - epoch_us(max(ts))) // 3600000000 <= 240)
select event_id, segment_id from b semi join s using (user_id, segment_id)""")
def segment_gate(spark, sf_dir):
    ev = windows.key_maximum(_events(spark, sf_dir), "ts", ["user_id"], "last_ts")
    split = segments.split_at_breaks(ev, ["user_id"], ["ts", "event_id"], [segments.gap_over("ts", 12)])
    return segments.gate_segments(split, ["user_id"], "segment_id", "ts", 1, 240, "last_ts").select("event_id", "segment_id")


@query("""select event_id, last_value(case when event_type = 'purchase' then value end ignore nulls) over (order by ts, event_id rows unbounded preceding) as filled from events""")
def fill_series(spark, sf_dir):
    df = _events(spark, sf_dir).select("event_id", "ts", F.when(F.col("event_type") == "purchase", F.col("value")).alias("filled"))
    return ordered.fill_series(df, ["filled"], ["ts", "event_id"]).select("event_id", "filled")


@query("""select event_id, max(value) over w as peak_6h, sum(cast(floor(value) as bigint)) over w as total_6h, count(*) over w as n_6h from events
window w as (order by ts range between to_microseconds(21599999999) preceding and current row)""")
def rolling_series(spark, sf_dir):
    results = {"peak_6h": (F.max, F.col("value")), "total_6h": (F.sum, F.floor("value").cast("long")), "n_6h": (F.count, F.lit(1))}
    return ordered.rolling_series(_events(spark, sf_dir).select("event_id", "ts", "value"), "ts", 21_600, results).select("event_id", *results)


@query("""select event_id, sum(cast(floor(value) as bigint)) over w as total, count(*) over w as n from events window w as (partition by event_type order by ts, event_id rows unbounded preceding)""")
def running_sums(spark, sf_dir):
    """event_type has a handful of values: each holds a large share of the rows."""
    df = _events(spark, sf_dir).select("event_id", "event_type", "ts", "value")
    return ordered.running_sums(df, {"total": F.floor("value").cast("long"), "n": F.lit(1).cast("long")}, ["event_type"], ["ts", "event_id"]).select("event_id", "total", "n")


@query("""with a as (select *, case when lag(ts) over w is null then 1 when floor((epoch_us(ts) - epoch_us(lag(ts) over w)) / 3600000000.0) > 1 then 1
  when value - lag(value) over w > 90 then 1 else 0 end as n from events window w as (partition by event_type order by ts, event_id))
select event_id, event_type || '_Seg' || cast(sum(n) over (partition by event_type order by ts, event_id rows unbounded preceding) as bigint) as segment_id from a""")
def long_segments(spark, sf_dir):
    rules = [segments.gap_over("ts", 1), segments.rise_over("value", 90.0)]
    return segments.split_long(_events(spark, sf_dir).select("event_id", "event_type", "ts", "value"), ["event_type"], ["ts", "event_id"], rules).select("event_id", "segment_id")


@query("select event_id, last_value(case when value > 50 then value end ignore nulls) over (partition by user_id order by ts, event_id rows unbounded preceding) as filled from events")
def forward_fill(spark, sf_dir):
    df = _events(spark, sf_dir).withColumn("filled", F.when(F.col("value") > 50, F.col("value")))
    return windows.forward_fill(df, ["filled"], ["user_id"], ["ts", "event_id"]).select("event_id", "filled")


@query("select event_id from events qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1")
def keep_last(spark, sf_dir):
    return windows.keep_one(_events(spark, sf_dir), ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).select("event_id")


@query("select event_id, count(*) over (partition by user_id order by ts range between interval 1 day preceding and current row) as in_day from events")
def trailing_count(spark, sf_dir):
    return windows.rolling(_events(spark, sf_dir), "ts", ["user_id"], 86_400, {"in_day": F.count(F.lit(1))}, closed=True).select("event_id", "in_day")


@query("select user_id, event_type, arg_max(event_id, (ts, event_id)) as event_id from events group by 1, 2")
def latest_per_key(spark, sf_dir):
    return incremental.latest(_events(spark, sf_dir), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id")


@query("select event_id from events where user_id in (select user_id from events group by 1 having (epoch_us(max(ts)) - epoch_us(min(ts))) // 86400000000 >= 28)")
def duration_gate(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return ev.join(aggregate.lasting(ev, ["user_id"], "ts", 28), "user_id", "left_semi").select("event_id")


@query("""select event_id, lag(least(value, 150.0), 1) over w as value_lag_1, lag(least(value, 150.0), 2) over w as value_lag_2, lag(least(value, 150.0), 3) over w as value_lag_3
from events window w as (partition by user_id order by ts, event_id)""")
def lags_and_clip(spark, sf_dir):
    df = _events(spark, sf_dir).withColumn("value", clip_above("value", 150.0))
    return windows.lagged(df, "value", ["user_id"], ["ts", "event_id"], [1, 2, 3]).select("event_id", "value_lag_1", "value_lag_2", "value_lag_3")


@query("""select event_id, coalesce(cast((epoch_us(ts) - epoch_us(lag(ts) over w)) // 3600000000 as bigint), 0) as hours, round(abs(value - lag(value) over w), 6) as jump
from events window w as (partition by user_id order by ts, event_id)""")
def lag_differences(spark, sf_dir):
    df = windows.lag_diff(_events(spark, sf_dir), "ts", ["user_id"], ["ts", "event_id"], "hours", unit="HOUR", fill=0)
    return windows.lag_diff(df, "value", ["user_id"], ["ts", "event_id"], "jump", absolute=True).select("event_id", "hours", rounded("jump", 6).alias("jump"))


@query("""select event_id, round((value - lag(value) over w) / nullif(cast((epoch_us(ts) - epoch_us(lag(ts) over w)) // 1000000 as double) / 86400, 0), 4) as rate
from events window w as (partition by user_id order by ts, event_id)""")
def rate_of_change(spark, sf_dir):
    return windows.rate_per_day(_events(spark, sf_dir), "value", "ts", ["user_id"], ["ts", "event_id"], "rate").select("event_id", rounded("rate", 4).alias("rate"))


@query("select o_orderkey, max(o_orderdate) over (partition by o_custkey) as last_date from orders")
def key_maximum(spark, sf_dir):
    return windows.key_maximum(_t(spark, sf_dir, "orders"), "o_orderdate", ["o_custkey"], "last_date").select("o_orderkey", "last_date")


@query("""select event_id from events where user_id in (select user_id from events group by 1 having count(*) >= 60)
qualify row_number() over (partition by user_id order by ts desc, event_id desc) <= 30""")
def last_rows_of_large_keys(spark, sf_dir):
    ev = _events(spark, sf_dir)
    enough = aggregate.keys_with_rows(ev, ["user_id"], 60).select("user_id")
    return windows.last_rows(ev.join(enough, "user_id", "left_semi"), ["user_id"], [F.desc("ts"), F.desc("event_id")], 30).select("event_id")


# As-of joins and grids


@query("""select l.event_id, r.event_id as click_id, r.value as click_value from (select * from events where event_type = 'purchase') l
asof left join (select * from events where event_type = 'click') r on l.user_id = r.user_id and l.ts >= r.ts""")
def asof_keyed(spark, sf_dir):
    ev = _events(spark, sf_dir)
    clicks = ev.where("event_type = 'click'").select("user_id", F.col("ts").alias("click_ts"), F.col("event_id").alias("click_id"), F.col("value").alias("click_value"))
    return asof.asof_backward(ev.where("event_type = 'purchase'"), clicks, "ts", "click_ts", ["user_id"], ["click_id", "click_value"]).select("event_id", "click_id", "click_value")


@query("""with c as (select ts as click_ts, max(event_id) as click_id from events where event_type = 'click' group by 1)
select event_id, click_id from (select * from events where event_type = 'purchase') e asof left join c on e.ts >= c.click_ts""")
def asof_intraday(spark, sf_dir):
    """The last click of anyone at or before each purchase, to the microsecond."""
    ev = _events(spark, sf_dir).select("event_id", "event_type", "ts")
    clicks = ev.where("event_type = 'click'").select(F.col("ts").alias("click_ts"), F.col("event_id").alias("click_id"))
    return asof.asof_any(ev.where("event_type = 'purchase'"), clicks, "ts", "click_ts", ["click_id"], tie="click_id").select("event_id", "click_id")


@query("""with o as (select event_type, ts as seen_ts, max(event_type || '/' || event_id) as seen from events where value > 80 group by 1, 2)
select event_id, seen from events e asof left join o on e.event_type = o.event_type and e.ts >= o.seen_ts""")
def asof_large_keys(spark, sf_dir):
    """By event_type, whose values each hold a large share of the rows; ties are texts and the last in their order counts."""
    ev = _events(spark, sf_dir).select("event_id", "event_type", "ts", "value")
    seen = ev.where("value > 80").select("event_type", F.col("ts").alias("seen_ts"), F.concat_ws("/", "event_type", "event_id").alias("seen"))
    return asof.asof_any(ev, seen, "ts", "seen_ts", ["seen"], ["event_type"], tie="seen").select("event_id", "seen")


@query("""with env as (select date_trunc('day', ts)::timestamp as d, max(event_id) as v from events where event_type = 'purchase' and day(ts) % 3 = 0 group by 1)
select e.event_id, r.v from events e asof left join env r on e.ts >= r.d""")
def asof_daily(spark, sf_dir):
    ev = _events(spark, sf_dir)
    env = ev.where("event_type = 'purchase' and day(ts) % 3 = 0").groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("d")).agg(F.max("event_id").alias("v"))
    return asof.asof_daily(ev, env, "ts", "d", ["v"]).select("event_id", "v")


@query("select user_id, unnest(generate_series(time_bucket(interval '4 hours', min(ts), timestamp '1970-01-01'), max(ts), interval '4 hours')) as grid_ts from events group by 1")
def time_grid(spark, sf_dir):
    return asof.time_grid(_events(spark, sf_dir), ["user_id"], "ts", 4)


@query("""with g as (select user_id, unnest(generate_series(time_bucket(interval '4 hours', min(ts), timestamp '1970-01-01'), max(ts), interval '4 hours')) as ts from events group by 1),
b as (select user_id, ts, 0 as is_synthetic from events union all select user_id, ts, 1 from g)
select user_id, ts, min(is_synthetic) as is_synthetic from b group by 1, 2""")
def prefer_measured(spark, sf_dir):
    ev = _events(spark, sf_dir)
    both = ev.select("user_id", "ts", F.lit(0).alias("is_synthetic")).unionByName(asof.time_grid(ev, ["user_id"], "ts", 4, "ts").withColumn("is_synthetic", F.lit(1)))
    return windows.keep_one(both, ["user_id", "ts"], ["is_synthetic"])


# Aggregates


@query("""select d, round(median(m), 6) as median, cast(sum(n) as bigint) as n from (
  select date_trunc('day', ts)::timestamp as d, floor(value / 100) * 100 as b, median(value) as m, count(distinct user_id) as n from events group by 1, 2) group by 1""")
def median_of_medians(spark, sf_dir):
    df = _events(spark, sf_dir).select(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("d"), orbit.altitude_bin("value").alias("b"), "value", "user_id")
    return aggregate.nested_median(df, ["d"], ["b"], "value", "user_id").select("d", rounded("median", 6).alias("median"), "n")


@query("""with c as (select user_id, event_type, count(*) as n, min((ts, event_id)) as f from events group by 1, 2)
select user_id, event_type as reason from c qualify row_number() over (partition by user_id order by n desc, f) = 1""")
def dominant_reason(spark, sf_dir):
    return aggregate.dominant(_events(spark, sf_dir), ["user_id"], "event_type", ["ts", "event_id"], "reason")


@query("""select date_trunc('hour', ts)::timestamp as hour, count(*) as requests, round(count(*) / 30.0, 6) as usage, case when count(*) > 30 then 'BLOCKED' when count(*) > 24 then 'SLOW' else 'OK' end as state
from events group by 1""")
def hour_histogram(spark, sf_dir):
    df = aggregate.hour_histogram(_events(spark, sf_dir), "ts", 30)
    state = F.when(F.col("requests") > 30, "BLOCKED").when(F.col("requests") > 24, "SLOW").otherwise("OK")
    return df.select("hour", "requests", rounded("usage", 6).alias("usage"), state.alias("state"))


@query("""with h as (select user_id, hour(ts) as hour, count(*) as n from events group by 1, 2)
select user_id, hour as peak, n as peak_n from h qualify row_number() over (partition by user_id order by n desc, hour) = 1""")
def peak_hour(spark, sf_dir):
    counts = _events(spark, sf_dir).groupBy("user_id", F.hour("ts").cast("long").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    return aggregate.peak(counts, ["user_id"], "n", "hour", "peak")


@query("""select o_custkey, max(g) as largest_gap from (select o_custkey, date_diff('day', lag(o_orderdate) over (partition by o_custkey order by o_orderdate, o_orderkey), o_orderdate) as g from orders) group by 1""")
def largest_gap(spark, sf_dir):
    return aggregate.largest_gap(_t(spark, sf_dir, "orders"), ["o_custkey"], "o_orderdate")


@query("select user_id, count(*) as n_rows from events group by 1 having count(*) >= 60")
def min_records(spark, sf_dir):
    return aggregate.keys_with_rows(_events(spark, sf_dir), ["user_id"], 60)


@query("select count(distinct user_id) as objects, max(ts) as max_ts, min(ts) as min_ts, count(*) as n_rows from events")
def integrity_check(spark, sf_dir):
    return aggregate.integrity(_events(spark, sf_dir), "user_id", "ts")


# Increments


@query("""select user_id, count(*) as n from events e left join (select user_id, max(ts) as m from events where ts < '2024-01-15' group by 1) x using (user_id) where m is null or ts > m group by 1""")
def high_water_increment(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return incremental.after_high_water(ev, ev.where("ts < timestamp_ntz '2024-01-15'"), ["user_id"], "ts").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


_NULL_USERS = "case when user_id % 10 = 0 then null else user_id end as u"


@query("""with k as (select case when user_id % 10 = 0 then null else user_id end as u, date_trunc('day', ts)::timestamp as d, event_id, event_type from events)
select u, d, min(event_id) as event_id from k a where event_type <> 'purchase' and not exists (select 1 from k b where b.event_type = 'purchase' and a.u is not distinct from b.u and a.d = b.d) group by 1, 2""")
def insert_ignore(spark, sf_dir):
    ev = _events(spark, sf_dir).select(F.expr(_NULL_USERS), F.date_trunc("day", "ts").cast("timestamp_ntz").alias("d"), "event_id", "event_type")
    rows = lambda kind: ev.where(kind).drop("event_type")
    return incremental.not_stored(rows("event_type <> 'purchase'"), rows("event_type = 'purchase'"), ["u", "d"])


_MERGED = """with k as (select *, case when user_id % 10 = 0 then null else user_id end as u, nullif(event_type, 'purchase') as kind from events),
o as (select u, kind, max(value) as peak, bool_or(value > 150) as flagged, count(*) as n, min(event_id) as first from k where day(ts) <= 10 group by 1, 2),
n as (select u, kind, max(case when value > 100 then value end) as peak, bool_or(value > 190) as flagged, count(*) as n, min(event_id) as first from k where day(ts) > 10 group by 1, 2),
m as (select u, kind, any_value(peak) filter (is_new) as new_peak, any_value(peak) filter (not is_new) as old_peak, bool_or(flagged) as flagged, sum(n) as n,
  any_value(first) filter (is_new) as new_first, any_value(first) filter (not is_new) as old_first from (select *, false as is_new from o union all select *, true from n) group by 1, 2)
select u, kind, coalesce(new_peak, old_peak) as peak, flagged, cast(n as bigint) as n, coalesce(new_first, old_first) as first from m"""
_MERGE_RULES = {"peak": "coalesce", "flagged": "or", "n": "add", "first": "replace"}


def _old_and_new(spark, sf_dir):
    ev = _events(spark, sf_dir).select("*", F.expr(_NULL_USERS), F.expr("nullif(event_type, 'purchase')").alias("kind"))
    n, first = F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first")
    old = ev.where("day(ts) <= 10").groupBy("u", "kind").agg(F.max("value").alias("peak"), F.bool_or(F.col("value") > 150).alias("flagged"), n, first)
    new = ev.where("day(ts) > 10").groupBy("u", "kind").agg(F.max(F.when(F.col("value") > 100, F.col("value"))).alias("peak"), F.bool_or(F.col("value") > 190).alias("flagged"), n, first)
    return old, new


@query(_MERGED)
def merge_upsert(spark, sf_dir):
    return incremental.merge_upsert(*_old_and_new(spark, sf_dir), ["u", "kind"], _MERGE_RULES)


@query(_MERGED)
def committed_upsert(spark, sf_dir):
    """The same through a stored table: one version for the old rows, one for the new."""
    old, new = _old_and_new(spark, sf_dir)
    stored = store.Store(spark, f"{shared_dir(spark)}/apsis/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}", old.schema, ["u", "kind"], 16)
    for rows in (old, new):
        stored.upsert(rows, _MERGE_RULES)
    return stored.read()


@query("""select c_custkey, c_name, c_acctbal, '{"}' || c_mktsegment || '\\' as odd, c_nationkey as nation from customer""")
def json_arrays(spark, sf_dir):
    """Customers landed as JSON with braces and quotes in strings and an object within, and read again by the braces."""
    df = _t(spark, sf_dir, "customer")
    path = f"{shared_dir(spark)}/apsis/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    odd = F.concat(F.lit('{"}'), "c_mktsegment", F.lit("\\")).alias("odd")
    df.select("c_custkey", "c_name", "c_acctbal", odd, F.struct(F.col("c_nationkey").alias("key")).alias("nation")).write.option("lineSep", ",\n").json(path)
    rows = read_json_arrays(spark, path, "c_custkey long, c_name string, c_acctbal double, odd string, nation struct<key: long>")
    return rows.withColumn("nation", F.col("nation.key"))


@query("select event_type, median(value) as median, count(value) as n from events group by 1")
def large_median(spark, sf_dir):
    """Each event_type holds a large share of the rows; groups over 1,000 rows are taken as large."""
    return aggregate.large_median(_events(spark, sf_dir), ["event_type"], "value", 1000)


@query("select l_orderkey, l_linenumber, l_quantity from lineitem where l_orderkey in (select o_orderkey from orders where o_orderpriority = '1-URGENT') and l_shipdate > timestamp '1995-06-01'")
def history_of_many_ids(spark, sf_dir):
    """The ids are a table: a fifth of all orders."""
    ids = _t(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select("o_orderkey")
    since = datetime(1995, 6, 1)
    return tables.history(_t(spark, sf_dir, "lineitem"), ids, "l_orderkey", "l_shipdate", since).select("l_orderkey", "l_linenumber", "l_quantity")


@query("select o_custkey, o_orderstatus, o_orderkey from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1")
def latest_state(spark, sf_dir):
    return incremental.latest(_t(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderstatus", "o_orderkey")


# Expressions


@query("""select event_id, round(cos(2 * 3.141592653589793 * fmod(hour(ts) + minute(ts) / 60.0 + value / 15.0, 24.0) / 24), 6) as cos_lst from events""")
def solar_time(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", rounded(orbit.hour_cosine(orbit.solar_time("ts", "value")), 6).alias("cos_lst"))


@query("""with v as (select vec_id, embedding[1]::double as x, embedding[2]::double as y, embedding[3]::double as z, embedding[4]::double as u, embedding[5]::double as v, embedding[6]::double as w from embeddings),
s as (select vec_id, sqrt(u * u + v * v + w * w) as speed, sqrt(x * x + y * y + z * z) as radius, x * u + y * v + z * w as dot from v),
r as (select *, dot / nullif(radius, 0) as radial from s), t as (select *, sqrt(greatest(speed * speed - radial * radial, 0)) as tangential from r)
select vec_id, round(speed, 6) as speed, round(radius, 6) as radius, round(radial, 6) as radial, round(tangential, 6) as tangential, round(atan2(radial, tangential), 6) as angle from t""")
def motion_features(spark, sf_dir):
    names = ["x", "y", "z", "u", "v", "w"]
    df = _t(spark, sf_dir, "embeddings").select("vec_id", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)])
    made = orbit.motion(("x", "y", "z"), ("u", "v", "w"))
    short = {"speed": "speed_km_s", "radius": "radius_km", "radial": "radial_velocity_km_s", "tangential": "tangential_velocity_km_s", "angle": "flight_path_angle_rad"}
    return df.select("vec_id", *[rounded(made[v], 6).alias(k) for k, v in short.items()])


@query("""with c as (select c_custkey, case when c_custkey % 7 = 0 then '  ' when c_custkey % 5 = 0 then '999.9999' when c_custkey % 11 = 0 then 'abc' else ' ' || cast(c_acctbal as varchar) end as raw from customer)
select c_custkey, case when trim(raw) in ('', '999.9999', '9999.9999', '-999.9999') then null else try_cast(trim(raw) as double) end as value from c""")
def numeric_clean(spark, sf_dir):
    k = F.col("c_custkey")
    raw = F.when(k % 7 == 0, "  ").when(k % 5 == 0, "999.9999").when(k % 11 == 0, "abc").otherwise(F.concat(F.lit(" "), F.col("c_acctbal").cast("string")))
    return _t(spark, sf_dir, "customer").select("c_custkey", number(raw).alias("value"))


@query("select p_partkey from part where case when p_partkey % 10 = 0 then null else p_name end not like '%a%'")
def regex_filter(spark, sf_dir):
    name = F.when(F.col("p_partkey") % 10 != 0, F.col("p_name"))
    return validate.without_matches(_t(spark, sf_dir, "part").select("p_partkey", name.alias("name")), "name", "a").select("p_partkey")


@query("""with r(l_returnflag, max_discount, max_tax) as (values ('A', 0.05, 0.04), ('N', 0.08, 0.08), ('R', 0.02, 0.06))
select l_orderkey, l_linenumber from lineitem join r using (l_returnflag) where l_discount <= max_discount and abs(l_tax) <= max_tax""")
def role_thresholds(spark, sf_dir):
    limits = spark.createDataFrame([("A", 0.05, 0.04), ("N", 0.08, 0.08), ("R", 0.02, 0.06)], "l_returnflag string, max_discount double, max_tax double")
    return validate.role_thresholds(_t(spark, sf_dir, "lineitem"), "l_returnflag", limits, {"l_discount": ("max_discount", False), "l_tax": ("max_tax", True)}).select("l_orderkey", "l_linenumber")


@query("""select l_orderkey, l_linenumber, round(sin(radians(dayofyear(l_shipdate))), 6) + 0.0 as s, round(cos(radians(dayofyear(l_shipdate))), 6) + 0.0 as c, cast(dayofyear(l_shipdate) as int) as day_of_year from lineitem""")
def cyclic_encode(spark, sf_dir):
    sine, cosine = orbit.degrees_cycle(F.dayofyear("l_shipdate"))
    return _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (rounded(sine, 6) + 0.0).alias("s"), (rounded(cosine, 6) + 0.0).alias("c"), F.dayofyear("l_shipdate").alias("day_of_year"))


@query("""select l_orderkey, l_linenumber, d as days, case when d >= 0 then round(ln(d + 1), 6) end as log_days from (
  select l_orderkey, l_linenumber, cast(trunc((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 86400000000.0) as bigint) as d from lineitem join orders on l_orderkey = o_orderkey)""")
def whole_day_diff(spark, sf_dir):
    df = _t(spark, sf_dir, "lineitem").join(_t(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return df.select("l_orderkey", "l_linenumber", orbit.remaining_days("o_orderdate", "l_shipdate").alias("days")).withColumn("log_days", rounded(orbit.log_remaining("days"), 6))


@query("select s_suppkey, case when b <> 0 then round(log10(abs(b)), 6) end as log_size from (select s_suppkey, case when s_suppkey % 9 = 0 then 0 else s_acctbal end as b from supplier)")
def log_features(spark, sf_dir):
    return _t(spark, sf_dir, "supplier").select("s_suppkey", rounded(orbit.log_size(F.when(F.col("s_suppkey") % 9 == 0, 0.0).otherwise(F.col("s_acctbal"))), 6).alias("log_size"))


@query("""with a as (select event_id, value, avg(value) over (partition by user_id order by ts range between to_microseconds(604799999999) preceding and current row) as m from events),
b as (select event_id, case when m > 0 then value / m end as x, value as k from a)
select event_id, round(x, 6) as ratio, cast(x > 1.2 as int) as active, cast(x > 1.5 as int) as very_active, cast(k <= 20 as int) as quiet, cast(k >= 50 as int) as storm, cast(k >= 70 as int) as severe, cast(x > 1.2 or k >= 50 as int) as high from b""")
def ratio_flags(spark, sf_dir):
    df = windows.rolling(_events(spark, sf_dir), "ts", ["user_id"], 7 * 86_400, {"flux_81d_avg": F.avg("value")})
    df = environment.activity(df.withColumns({"date": F.col("ts"), "observed_flux": F.col("value"), "kp_value": F.col("value") / 10}))
    names = {"active": "solar_active", "very_active": "solar_very_active", "quiet": "geomag_quiet", "storm": "geomag_storm", "severe": "geomag_severe_storm", "high": "high_activity_period"}
    return df.select("event_id", rounded("flux_enhancement", 6).alias("ratio"), *[F.col(c).alias(n) for n, c in names.items()])


@query("""select event_id, case when value > 0 then round(power(398600.4418 / power(value * 2 * 3.141592653589793 / 86400.0, 2), 1.0 / 3.0), 4) end as axis from events""")
def kepler_axis(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", rounded(orbit.semimajor_axis("value"), 4).alias("axis"))


@query("""select p_partkey, round(case when h < 400 then (400 - h) / 100 else 0 end, 6) as risk, floor(h / 100) * 100 as bin, case when s is null then null when s >= 0.8 then 'CRITICAL' when s >= 0.6 then 'HIGH' when s >= 0.4 then 'MEDIUM' else 'LOW' end as band
from (select p_partkey, p_retailprice - 900 as h, case when p_partkey % 13 <> 0 then p_size / 50.0 end as s from part)""")
def altitude_risk(spark, sf_dir):
    df = _t(spark, sf_dir, "part").select("p_partkey", (F.col("p_retailprice") - 900).alias("h"), F.when(F.col("p_partkey") % 13 != 0, F.col("p_size") / 50.0).alias("s"))
    assert RISK_BANDS[0][0] == 0.8
    return df.select("p_partkey", rounded(orbit.low_altitude_risk("h"), 6).alias("risk"), orbit.altitude_bin("h").alias("bin"), orbit.risk_band("s").alias("band"))


@query("select event_id, cast(json_extract_string(props, '$.k') as int) as k from events")
def json_field(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", json_value("props", "$.k", "int").alias("k"))


@query("""select event_id, json_object('user_id', user_id, 'kind', nullif(event_type, 'click'), 'k', cast(json_extract_string(props, '$.k') as int)) as line,
  md5(json_object('user_id', user_id, 'event_id', event_id)) as id from events""")
def json_rows(spark, sf_dir):
    ev = sampling.with_row_id(_events(spark, sf_dir), ["user_id", "event_id"])
    kind, k = F.expr("nullif(event_type, 'click')").alias("kind"), json_value("props", "$.k", "int").alias("k")
    return ev.select("event_id", json_row("user_id", kind, k).alias("line"), "id")


@query("""with o as (select p_partkey, p_retailprice * 20 - 18000 as h, p_partkey % 110 as i, p_size / 60.0 as e, case when p_partkey % 3 = 0 then 720 when p_partkey % 7 <> 0 then 100 end as p from part)
select p_partkey, case when h <= 160 then 'VLEO' when h <= 300 then 'LOW_LEO' when h <= 500 then 'STANDARD_LEO' when h <= 800 then 'HIGH_LEO' when h <= 2000 then 'VERY_HIGH_LEO' when h <= 35786 then 'MEO' else 'GEO' end as by_altitude,
  case when i <= 20 then 'EQUATORIAL' when i <= 70 then 'INCLINED' when i <= 85 then 'HIGH_INCLINED' when i <= 95 then 'POLAR' else 'RETROGRADE' end as by_inclination,
  case when e <= 0.01 then 'CIRCULAR' when e <= 0.1 then 'NEAR_CIRCULAR' when e <= 0.5 then 'ELLIPTICAL' else 'HIGHLY_ELLIPTICAL' end as by_eccentricity,
  case when h between 600 and 800 and i between 96 and 98 and p between 95 and 105 then 'SUN_SYNCHRONOUS' when i between 61.4 and 65.4 and e > 0.5 and p between 700 and 740 then 'MOLNIYA'
    when h between 19000 and 21000 and i between 50 and 65 then 'NAVIGATION' end as special from o""")
def orbit_classes(spark, sf_dir):
    key = F.col("p_partkey")
    period = F.when(key % 3 == 0, 720).when(key % 7 != 0, 100)
    df = _t(spark, sf_dir, "part").select(key, (F.col("p_retailprice") * 20 - 18000).alias("h"), (key % 110).alias("i"), (F.col("p_size") / 60.0).alias("e"), period.alias("p"))
    classes = {"by_altitude": orbit.altitude_class("h"), "by_inclination": orbit.inclination_class("i"), "by_eccentricity": orbit.eccentricity_class("e"), "special": orbit.special_orbit("h", "i", "e", "p")}
    return df.select("p_partkey", *[c.alias(n) for n, c in classes.items()])


# Validation, catalogue, control


_RULES = [
    validate.Rule("l_orderkey", "long", required=True, gt=0), validate.Rule("l_discount", "double", le=0.07), validate.Rule("l_tax", "double", ge=0.01, lt=0.08),
    validate.Rule("l_returnflag", values=("A", "N")),
]


def _holed(spark, sf_dir):
    df = _t(spark, sf_dir, "lineitem")
    hole = F.col("l_orderkey") % 5 == 0
    return df.withColumn("l_tax", F.when(~hole, F.col("l_tax")))


@query("select l_orderkey, l_linenumber from lineitem where l_orderkey > 0 and l_discount <= 0.07 and (case when l_orderkey % 5 <> 0 then l_tax end) >= 0.01 and (case when l_orderkey % 5 <> 0 then l_tax end) < 0.08 and l_returnflag in ('A', 'N')")
def validate_strict(spark, sf_dir):
    return validate.validate(_holed(spark, sf_dir), _RULES)[0].select("l_orderkey", "l_linenumber")


@query("select l_orderkey, l_linenumber from lineitem where l_orderkey > 0 and l_discount <= 0.07 and (l_orderkey % 5 = 0 or (l_tax >= 0.01 and l_tax < 0.08)) and l_returnflag in ('A', 'N')")
def validate_lenient(spark, sf_dir):
    return validate.validate(_holed(spark, sf_dir), _RULES, nulls="pass")[0].select("l_orderkey", "l_linenumber")


@query("select count(*) as input, count(*) filter (l_discount <= 0.07 and l_returnflag in ('A', 'N')) as valid, count(*) filter (not (l_discount <= 0.07 and l_returnflag in ('A', 'N'))) as invalid from lineitem")
def validation_counts(spark, sf_dir):
    rules = [validate.Rule("l_discount", le=0.07), validate.Rule("l_returnflag", values=("A", "N"))]
    return validate.counted(_t(spark, sf_dir, "lineitem"), rules)[1].select("input", "valid", "invalid")


@query("select c_custkey, c_mktsegment from customer qualify row_number() over (partition by c_mktsegment order by md5('47|' || c_custkey)) <= 3")
def stratified_sample(spark, sf_dir):
    return sampling.stratified(_t(spark, sf_dir, "customer"), "c_mktsegment", "c_custkey", 3).select("c_custkey", "c_mktsegment")


@query("""select c_custkey, c_mktsegment from customer qualify row_number() over (partition by c_mktsegment order by case when c_acctbal > 9500 then 0 else 1 end, md5('47|' || c_custkey)) <= 4""")
def anchored_sample(spark, sf_dir):
    df = _t(spark, sf_dir, "customer")
    return sampling.stratified(df, "c_mktsegment", "c_custkey", 4, first=df.where("c_acctbal > 9500")).select("c_custkey", "c_mktsegment")


_RANGES = {"early": (1992, 1993), "middle": (1994, 1996), "late": (1997, 1998)}


@query("""select o_orderkey, case when year(o_orderdate) between 1992 and 1993 then 'early' when year(o_orderdate) between 1994 and 1996 then 'middle' when year(o_orderdate) between 1997 and 1998 then 'late' end as regime
from orders where date_diff('day', o_orderdate::date, date '1998-06-30') >= 60""")
def catalogue_regimes(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").withColumn("end", F.lit("1998-06-30"))
    return history.long_enough(orders, "o_orderdate", "end", 60).select("o_orderkey", control.regime(F.year("o_orderdate"), _RANGES).alias("regime"))


@query("""with p as (select c_mktsegment, sha256(string_agg(c_custkey::varchar, ',' order by c_custkey::varchar)) as h from customer group by c_mktsegment, substring(md5(c_custkey::varchar), 1, 2))
select c_mktsegment, sha256(string_agg(h, ',' order by h)) as signature from p group by 1""")
def manifest_hash(spark, sf_dir):
    return sampling.manifest_hash(_t(spark, sf_dir, "customer"), ["c_mktsegment"], "c_custkey", digits=2)


@query("""with n as (select o_custkey, max(o_orderdate) as d from orders group by 1), a as (select c_custkey, (epoch_us(timestamp '1998-08-02') - epoch_us(d)) // 1000000 / 86400.0 as age from customer left join n on c_custkey = o_custkey)
select c_custkey, round(age, 4) as age_days, case when c_custkey % 13 = 0 then 'FORCED' when age < 60 then 'REUSE' when age < 200 then 'INCREMENTAL' else 'RUN' end as decision,
  case when c_custkey % 13 = 0 then 'FORCE_REFRESH' when age is null then 'INITIAL_RUN' when age < 60 then 'CACHE_HIT' else 'DATA_STALE' end as reason from a""")
def freshness_decisions(spark, sf_dir):
    from .config import Freshness

    runs = _t(spark, sf_dir, "orders").select(F.lit("orders").alias("phase"), F.col("o_custkey").cast("string").alias("param_hash"), F.col("o_orderdate").alias("created_at"), F.col("o_orderkey").alias("id"), F.lit("").alias("manifest_files"))
    asked = _t(spark, sf_dir, "customer").select("c_custkey", F.lit("orders").alias("phase"), F.col("c_custkey").cast("string").alias("param_hash"))
    done = control.decisions(runs, asked, "1998-08-02 00:00:00", Freshness(60, 200), F.col("c_custkey") % 13 == 0)
    return done.select("c_custkey", rounded("age_days", 4).alias("age_days"), "decision", "reason")


@query("""with h as (select user_id, date_trunc('hour', ts)::timestamp as hour, count(*) as n from events group by 1, 2), d as (select *, sum(n) over (partition by user_id, hour::date) as m from h),
s as (select user_id, hour, case when m / 8.0 > 0.9 or n / 3.0 > 0.8 then 'critical' when m / 8.0 > 0.75 or n / 3.0 > 0.6 then 'warning' when m / 8.0 > 0.5 or n / 3.0 > 0.4 then 'caution' else 'good' end as status from d)
select user_id, hour, status, case status when 'critical' then 2.0 when 'warning' then 1.5 else 1.0 end::double as delay from s""")
def usage_ladder(spark, sf_dir):
    hours = _events(spark, sf_dir).groupBy("user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    days = hours.withColumn("m", F.sum("n").over(windows.Window.partitionBy("user_id", F.to_date("hour"))))
    status = control.usage_status(F.col("m") / 8.0, F.col("n") / 3.0)
    return days.select("user_id", "hour", status.alias("status"), control.delay_factor(status).alias("delay"))


@query("""select p_partkey, case when p_size % 7 = 0 then null when p_size % 5 = 0 then null when 60.0 + p_size < 75 then 'low' when 60.0 + p_size < 90 then 'mid' else 'high' end as band from part""")
def period_bands(spark, sf_dir):
    period = F.expr("case when p_size % 7 = 0 then 'n/a' when p_size % 5 = 0 then '0' else cast(60.0 + p_size as string) end")
    return _t(spark, sf_dir, "part").select("p_partkey", orbit.period_band(period, 75, 90).alias("band"))


@query("""with k as (select case when event_id % 17 = 0 then null when ts <= timestamp '2024-01-12' then 'filtered' when value > 190 then 'x' else 'valid' end as s, value, event_id % 17 = 0 as bad, ts from events),
c as (select case when bad or value > 190 then 'invalid' when ts <= timestamp '2024-01-12' then 'filtered' else 'valid' end as s from k)
select count(*) as input, count(*) filter (s = 'valid') as valid, count(*) filter (s = 'filtered') as filtered, count(*) filter (s = 'invalid') as invalid from c""")
def telemetry_counts(spark, sf_dir):
    ev = _events(spark, sf_dir).select("value", F.expr("case when event_id % 17 = 0 then 'no time' else cast(ts as string) || '+00:00' end").alias("epoch"))
    return validate.counted(ev, [validate.Rule("value", "double", required=True, le=190.0)], "epoch", "2024-01-12 00:00:00")[1]


@query("""with c as (select event_id, count(*) over (partition by user_id order by ts range between interval 2 day preceding and current row) as b,
  count(*) over (partition by user_id order by ts range between interval 1 hour preceding and current row) as h, count(*) over (partition by user_id order by ts range between interval 1 day preceding and current row) as d from events)
select event_id, b as in_burst, h as in_hour, d as in_day, case when d > 8 or h > 3 then 'BLOCKED' when b > 6 or d > 0.8 * 8 or h > 0.8 * 3 then 'SLOW' else 'OK' end as state from c""")
def quota_states(spark, sf_dir):
    from .config import Quota

    quota = Quota(per_day=8, per_hour=3, burst=6, burst_minutes=2880)
    return control.quota_states(_events(spark, sf_dir), "ts", ["user_id"], quota).select("event_id", "in_burst", "in_hour", "in_day", "state")


# Phases on the driver's tables


@query("""with f as (select *, event_id % 4 + 1.0 as bstar from events where event_id % 6 <> 1 and event_id % 9 <> 2),
j as (select event_id, ts, user_id, value, bstar, abs(value / 5000 - lag(value / 5000) over (partition by user_id order by ts)) as jump from f),
k as (select date_trunc('day', ts)::timestamp as date, floor((500 + value - 6378.0) / 100.0) * 100.0 as bin, user_id, abs(value / bstar / ((500 + value) * (500 + value))) as drag from j where jump < 0.01),
g as (select date, bin, median(drag) as m, count(distinct user_id) as n from k group by 1, 2), d as (select date, median(m) as x, sum(n) as n from g group by 1)
select date, round(x * 1e6, 4) as density, cast(n as bigint) as objects, round(1e6 * avg(x) over (order by date range between to_microseconds(259199999999) preceding and current row), 4) as mean_3d from d""")
def density_index(spark, sf_dir):
    ev = _events(spark, sf_dir)
    play = ev.select(
        F.col("user_id").alias("norad_cat_id"), F.col("ts").alias("epoch_dt"), (F.col("value") / 5000).alias("mean_motion"), F.expr("case when event_id % 6 = 1 then 0.5D else 0.01D end").alias("eccentricity"),
        F.expr("case when event_id % 9 = 2 then 0.0D else cast(event_id % 4 + 1 as double) end").alias("bstar"), F.col("value").alias("mean_motion_dot"), (F.col("value") + 500).alias("semimajor_axis"),
    )
    d = environment.density_index(play)
    return d.select("date", rounded(F.col("thermometer_density_index") * 1e6, 4).alias("density"), F.col("thermometer_sat_count").alias("objects"), rounded(F.col("thermometer_density_3d_avg") * 1e6, 4).alias("mean_3d"))


@query("""with v as (select date_trunc('day', o_orderdate)::timestamp as date, round(avg(o_totalprice), 2) as observed_flux, count(*)::double as x from orders group by 1),
w as (select date, observed_flux, last_value(case when day(date) % 5 = 1 then x end ignore nulls) over (order by date rows unbounded preceding) as thermometer_density_index from v),
e as (select user_id, event_id, ts, value from events)
select event_id, round(value - 6378.0, 6) as altitude, round(case when value - 6378.0 < 400 then (400 - (value - 6378.0)) / 100 else 0 end, 6) as low_altitude_risk,
  round((value - lag(value) over (partition by user_id order by ts)) / nullif(((epoch_us(ts) - epoch_us(lag(ts) over (partition by user_id order by ts))) // 1000000) / 86400.0, 0), 3) as altitude_change_rate, observed_flux, thermometer_density_index
from e asof left join w on e.ts >= w.date""")
def integrate(spark, sf_dir):
    ev = _events(spark, sf_dir)
    orbits = ev.select(F.col("user_id").alias("norad_cat_id"), F.col("ts").alias("epoch_dt"), F.col("value").alias("semimajor_axis"), F.col("event_id").alias("mean_motion"))
    weather = _t(spark, sf_dir, "orders").groupBy(F.date_trunc("day", "o_orderdate").cast("timestamp_ntz").alias("date")).agg(rounded(F.avg("o_totalprice"), 2).alias("observed_flux"), F.count(F.lit(1)).cast("double").alias("x"))
    density = weather.where("day(date) % 5 = 1").select("date", F.col("x").alias("thermometer_density_index"))
    done = training.integrate(orbits, weather.drop("x"), density)
    return done.select(F.col("mean_motion").alias("event_id"), rounded("altitude", 6).alias("altitude"), rounded("low_altitude_risk", 6).alias("low_altitude_risk"), rounded("altitude_change_rate", 3).alias("altitude_change_rate"), "observed_flux", "thermometer_density_index")


@query("""with d as (select date_trunc('day', ts)::timestamp as day, max(value) as peak from events where day(ts) % 4 = 1 group by 1),
c as (select unnest(generate_series(date_trunc('day', min(ts))::timestamp, date_trunc('day', max(ts))::timestamp, interval 1 day)) as day from events)
select day, last_value(peak ignore nulls) over (order by day rows unbounded preceding) as peak from c left join d using (day)""")
def calendar_fill(spark, sf_dir):
    ev = _events(spark, sf_dir)
    peaks = ev.where("day(ts) % 4 = 1").groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("date")).agg(F.max("value").alias("peak"))
    ends = ev.agg(F.min(F.to_date("ts")).alias("a"), F.max(F.to_date("ts")).alias("b"))
    days = ends.select(F.explode(F.sequence("a", "b")).alias("day")).select(F.col("day").cast("timestamp_ntz").alias("day"))
    return asof.asof_daily(days, peaks, "day", "date", ["peak"])


@query("""with l as (select o_orderkey as ordinal, strftime(o_orderdate, '%Y;%m;%d') as d, o_totalprice as p, o_custkey as k from orders)
select cast(ordinal as bigint) as ordinal, cast(strptime(d, '%Y;%m;%d') as timestamp) as date, cast(p as double) as sunspot_number, cast(k as double) as nb_observations from l where k % 3 <> 0""")
def parse_sunspots(spark, sf_dir):
    """Orders written as lines of the sunspot feed, a third of them broken, and parsed back."""
    token = F.when(F.col("o_custkey") % 3 == 0, "x").otherwise(F.col("o_totalprice").cast("string"))
    line = F.concat_ws(" ; ", F.date_format("o_orderdate", "yyyy"), F.date_format("o_orderdate", "MM"), F.date_format("o_orderdate", "dd"), F.lit("0.5"), token, F.lit("1.0"), F.col("o_custkey").cast("string"), F.lit("1"))
    lines = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ordinal"), line.alias("value"))
    return feeds.parse(lines, feeds.SUNSPOTS).select("ordinal", "date", "sunspot_number", "nb_observations")


@query()
def propagate(spark, sf_dir):
    """Element sets made of events (a plausible low orbit each), regularised on a 4-hour grid and propagated."""
    from .config import DECAYED

    ev = _events(spark, sf_dir)
    doy = F.dayofyear("ts") + (F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")) / 86400.0
    fixed = lambda c, p, w: F.lpad(F.format_string(f"%.{p}f", c.cast("double")), w, " ")
    line1 = F.concat(F.lit("1 00001U 24001A   "), F.date_format("ts", "yy"), F.lpad(F.format_string("%.8f", doy), 12, "0"), F.lit("  .00000000  00000-0  10000-4 0    10"))
    line2 = F.concat(
        F.lit("2 00001 "), fixed(F.col("value") % 90, 4, 8), F.lit(" "), fixed(F.col("user_id") * 7 % 360, 4, 8), F.lit(" 0010000 "),
        fixed(F.col("value") * 3 % 360, 4, 8), F.lit(" "), fixed(F.col("event_id") * 11 % 360, 4, 8), F.lit(" "), fixed(15.0 + F.col("user_id") % 10 / 20.0, 8, 11), F.lit("    10"),
    )
    raw = ev.select(
        F.col("user_id").alias("norad_cat_id"), F.col("ts").alias("epoch_dt"), F.col("event_id").alias("_ordinal"), F.lit(None).cast("timestamp_ntz").alias("decay_date"),
        F.concat(F.col("user_id").cast("string"), F.lit("_Seg1")).alias("segment_id"), line1.alias("tle_line1"), line2.alias("tle_line2"), (15.0 + F.col("user_id") % 10 / 20.0).alias("mean_motion"),
    )
    done = history.regularise(raw, DECAYED)
    return done.select("norad_cat_id", "epoch", "is_synthetic", "sgp4_error", "pos_x", "pos_y", "pos_z", "vel_x", "vel_y", "vel_z")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_report(spark, sf_dir)
