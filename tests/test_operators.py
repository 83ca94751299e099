"""Operators on hand-made rows: edge cases that the registered queries don't reach."""

from datetime import datetime as dt

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from apsis.config import ACTIVE, DECAYED, Freshness
from apsis.functions import orbit, scalar, sgp4
from apsis.operators import asof, incremental, sampling, segments, validate, windows
from apsis.plans import control, environment, history, training
from apsis.sources import feeds, tables


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_rounded_is_round_of_sql(spark):
    """Halves, what lies just below them, signs, large numbers and none: as DuckDB rounds."""
    some = [2.0178125, 0.3240625, 0.0140625, 0.17656249999999998, 0.1765625, 1.5e-6, 4.9999999999999994e-7, 5e-7, 64.57 / 32, 1.0, 0.0, 123456789.1234565, 7e10 / 3, 1e300, 1e307, float("inf")]
    some = [v for x in some for v in (x, -x)] + [float("nan"), None]
    df = spark.createDataFrame(list(enumerate(some)), "i int, x double")
    for places in (2, 4, 6):
        got = [repr(r.r) for r in df.select("i", scalar.rounded("x", places).alias("r")).orderBy("i").collect()]
        assert got == [repr(duckdb.execute("select round(?::double, ?::int)", [x, places]).fetchone()[0]) for x in some]


def test_role_thresholds_leave_rows_where_they_are(spark):
    """One role has nearly all rows: they stay in their partitions, whatever Spark takes the sizes for."""
    df = spark.range(0, 8000, 1, 8).select("id", F.when(F.col("id") % 1000 == 7, "b").when(F.col("id") != 5, "a").alias("role"), (-(F.col("id") % 10)).cast("double").alias("x"))
    limits = spark.createDataFrame([("a", -2.0, 6.0), ("c", 0.0, 9.0)], "role string, most double, widest double")
    done = validate.role_thresholds(df, "role", limits, {"x": ("most", False)})
    assert done.columns == ["id", "role", "x"] and done.select(F.spark_partition_id()).distinct().count() == 8
    assert sorted(r.id for r in done.collect()) == [i for i in range(8000) if i % 1000 != 7 and i != 5 and i % 10 >= 2]
    wide = validate.role_thresholds(df, "role", limits, {"x": ("widest", True)})
    assert wide.count() == sum(i % 1000 != 7 and i != 5 and i % 10 <= 6 for i in range(8000))


def test_numbers_and_times(spark):
    values = [" 1.5 ", "999.9999", " 999.9999", "", "  ", "abc", None, "-3"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert [r.x for r in df.select(scalar.number("v").alias("x")).collect()] == [1.5, None, None, None, None, None, None, -3.0]
    stamps = spark.createDataFrame([("2024-01-02T03:04:05.123456",), ("2024-01-02",), ("no date",), (None,)], "v string")
    assert [r.x for r in stamps.select(scalar.timestamp("v").alias("x")).collect()] == [dt(2024, 1, 2, 3, 4, 5, 123456), dt(2024, 1, 2), None, None]


def test_null_safe_expressions(spark):
    null = F.lit(None).cast("double")
    assert one(spark, scalar.clip_above(null, 1.0)) is None and one(spark, scalar.clip_below(F.lit(-2.0), 0.0)) == 0.0
    assert one(spark, orbit.semimajor_axis(F.lit(0.0))) is None and abs(one(spark, orbit.semimajor_axis(F.lit(15.5))) - 6794.9) < 1
    assert one(spark, orbit.log_size(F.lit(0.0))) is None and one(spark, orbit.log_size(F.lit(-0.01))) == -2.0
    assert one(spark, orbit.low_altitude_risk(null)) == 0.0 and one(spark, orbit.drag_proxy(F.lit(1.0), F.lit(0.0), F.lit(1.0))) is None
    assert one(spark, orbit.risk_band(F.lit(0.6))) == "HIGH" and one(spark, orbit.risk_band(null)) is None
    still = orbit.motion(*[tuple(F.lit(0.0) for _ in range(3))] * 2)
    assert one(spark, still["radial_velocity_km_s"]) is None and one(spark, still["speed_km_s"]) == 0.0


def history_rows(times, key=1, start=7000.0, axis=None):
    return [(key, dt.fromisoformat(t), i, (axis or {}).get(i, start)) for i, t in enumerate(times)]


@pytest.mark.parametrize(
    "times, axis, expected",
    [
        (["2024-01-01", "2024-01-06T00:59"], {}, 1),  # 120 whole hours are not more than 120
        (["2024-01-01", "2024-01-06T01:00"], {}, 2),
        (["2024-01-01", "2024-01-02"], {1: 7000.2}, 2),  # a raise
        (["2024-01-01", "2024-01-02"], {1: 6995.0}, 1),  # a drop
    ],
)
def test_breaks(spark, times, axis, expected):
    df = spark.createDataFrame(history_rows(times, axis=axis), "norad_cat_id long, epoch_dt timestamp_ntz, _ordinal long, semimajor_axis double")
    rules = [segments.gap_over("epoch_dt", DECAYED.gap_hours), segments.rise_over("semimajor_axis", DECAYED.raise_km)]
    out = segments.split_at_breaks(df, ["norad_cat_id"], ["epoch_dt", "_ordinal"], rules)
    assert {r.segment_id for r in out.collect()} == {f"1_Seg{i + 1}" for i in range(expected)}


def test_gate(spark):
    rows = [(1, "a", dt(2024, 1, 1), dt(2024, 3, 1)), (1, "a", dt(2024, 1, 30, 23), dt(2024, 3, 1)), (2, "b", dt(2024, 1, 1), dt(2024, 2, 5)), (2, "b", dt(2024, 2, 4), dt(2024, 2, 5))]
    rows += [(3, "c", dt(2024, 1, 1), None), (3, "c", dt(2024, 3, 1), None), (4, "d", dt(2024, 1, 1), dt(2024, 2, 8, 1)), (4, "d", dt(2024, 2, 6), dt(2024, 2, 8, 1))]
    df = spark.createDataFrame(rows, "k long, s string, t timestamp_ntz, decay timestamp_ntz")
    kept = segments.gate_segments(df, ["k"], "s", "t", 30, 48, "decay", True)
    assert {r.s for r in kept.collect()} == {"b", "c"}  # 29 days 23 hours; fine; no decay; 49 hours before decay


def test_asof_ties_and_misses(spark):
    left = spark.createDataFrame([(1, dt(2024, 1, 1)), (1, dt(2024, 1, 3)), (2, dt(2024, 1, 1)), (None, dt(2024, 1, 1))], "k long, t timestamp_ntz")
    right = spark.createDataFrame([(1, dt(2024, 1, 1), 1), (1, dt(2024, 1, 1), 2), (1, dt(2024, 1, 4), 3)], "k long, rt timestamp_ntz, v long")
    got = asof.asof_backward(left, right, "t", "rt", ["k"], ["v"], tie="v")
    assert sorted((r.k or 0, r.t.day, r.v or 0) for r in got.collect()) == [(0, 1, 0), (1, 1, 2), (1, 3, 2), (2, 1, 0)]
    with pytest.raises(ValueError):
        asof.asof_backward(left, right, "t", "rt", [], ["v"])
    assert asof.asof_daily(left, right.limit(0), "t", "rt", ["v"]).where("v is null").count() == 4


def test_validators(spark):
    rules = [validate.Rule("a", "long", required=True, gt=0), validate.Rule("b", "double", le=1.0)]
    df = spark.createDataFrame([("1", "0.5"), ("2", None), (None, "0.5"), ("-1", "0"), ("x", "0")], "a string, b string").withColumn("extra", F.lit(1))
    strict, rejected = validate.validate(df, rules, only_declared=True)
    assert [r.a for r in strict.collect()] == [1] and strict.columns == ["a", "b"] and rejected.count() == 4
    lenient, _ = validate.validate(df, rules, nulls="pass")
    assert sorted(r.a for r in lenient.collect()) == [1, 2] and "extra" in lenient.columns
    with pytest.raises(ValueError):
        validate.validate(df.drop("a"), rules)


def test_upsert_rules(spark):
    old = spark.createDataFrame([(1, 5, True, 1), (2, 6, False, 1)], "k long, v long, f boolean, n long")
    new = spark.createDataFrame([(2, None, True, 2), (3, 7, None, 3)], "k long, v long, f boolean, n long")
    got = incremental.merge_upsert(old, new, ["k"], {"v": "coalesce", "f": "or", "n": "replace"})
    assert sorted(tuple(r) for r in got.collect()) == [(1, 5, True, 1), (2, 6, True, 2), (3, 7, False, 3)]


def test_keys_may_be_null(spark):
    old = spark.createDataFrame([(None, "y", 5), (1, "x", 1)], "a long, b string, v long")
    new = spark.createDataFrame([(None, "y", 9), (None, "z", 3), (None, "z", 4)], "a long, b string, v long")
    got = incremental.merge_upsert(old, new.limit(2), ["a", "b"], {"v": "replace"})
    assert {tuple(r) for r in got.collect()} == {(None, "y", 9), (None, "z", 3), (1, "x", 1)}
    assert [tuple(r) for r in incremental.not_stored(new, old, ["a", "b"]).collect()] == [(None, "z", 3)]


def test_density_filters_before_it_compares(spark):
    rows = [(1, dt(2024, 1, d), n, e, 1e-3, 1e-4, 7000.0) for d, n, e in ((1, 15.0, 0.001), (2, 15.5, 0.5), (3, 15.001, 0.001))]
    df = spark.createDataFrame(rows, "norad_cat_id long, epoch_dt timestamp_ntz, mean_motion double, eccentricity double, bstar double, mean_motion_dot double, semimajor_axis double")
    assert [r.date.day for r in environment.density_index(df).collect()] == [3]


def test_gaps_of_the_environment_are_filled(spark):
    weather = spark.createDataFrame([(dt(2024, 1, d), float(d) if d != 2 else None) for d in range(1, 5)], "date timestamp_ntz, observed_flux double")
    density = spark.createDataFrame([(dt(2024, 1, 2), 7.0)], "date timestamp_ntz, thermometer_density_index double")
    got = environment.with_density(weather, density).orderBy("date").collect()
    assert [(r.observed_flux, r.thermometer_density_index) for r in got] == [(1.0, None), (1.0, 7.0), (3.0, 7.0), (4.0, 7.0)]


def test_decisions_and_routes(spark):
    assert control.route("FORCED", {"RUN": 1, "REUSE": 2}) == 1 and control.route("REUSE", {"RUN": 1, "REUSE": 2}) == 2
    with pytest.raises(ValueError):
        control.route("INCREMENTAL", {"RUN": 1})
    null = F.lit(None).cast("double")
    assert [one(spark, control.checkpoint_decision(*a)) for a in ((null,), (F.lit(3.0),), (F.lit(3.0), F.lit(False)))] == ["RUN", "REUSE", "FORCED"]
    assert one(spark, control.reason(F.lit(3.0), F.lit("REUSE"), "CHECKPOINT_EXISTS")) == "CHECKPOINT_EXISTS"
    assert one(spark, control.usage_status(F.lit(0.2), F.lit(0.5))) == "caution" and one(spark, control.delay_factor(F.lit("warning"))) == 1.5


def test_feeds(spark):
    flux = ["", "header one", "header two", "20240101 170000 02460311.208 002285.1 0141.2 0136.6 0122.9", "20240230 1 1 1 1 1 1", "20240102 1 1 1 -999.0 1 1", "short line", "20240103 1 1 1 x 1 1"]
    kp = ["# comment", ":also", "2024 01 01 00.0 01.50 33603.00000 33603.06250 2.667 12 1", "2024 02 30 00.0 01.50 1 1 2 12 1", "2024 01 01 00.0 01.50 1 1 2 12", "2024 01 02 00.0 01.50 1 1 -1 0 1"]
    spots = ["2024;01;01;2024.001; 123; 14.2; 31;1", "2024;01;02;2024.001; -1; 14.2; 31;1", "# x", "2024;01;03"]
    parse = lambda lines, feed: feeds.parse(feeds.lines_of(spark.createDataFrame([("\n".join(lines),)], "raw_content string")), feed).collect()
    (r,) = parse(flux, feeds.SOLAR_FLUX)
    assert (r.date, r.observed_flux, r.series_d_flux) == (dt(2024, 1, 1), 141.2, 122.9)
    assert [(r.date.day, r.kp_value) for r in parse(kp, feeds.KP_INDICES)] == [(1, 2.667), (2, -1.0)]
    assert [r.sunspot_number for r in parse(spots, feeds.SUNSPOTS)] == [123.0]


LINE1 = "1 88888U          80275.98708465  .00073094  13844-3  66816-4 0    8"
LINE2 = "2 88888  72.8435 115.9689 0086731  52.6988 110.5714 16.05824518   105"


def test_sgp4_published_vectors():
    el = sgp4.parse_elements(pd.Series([LINE1] * 3), pd.Series([LINE2] * 3))
    error, state = sgp4.propagate(el, np.array([0.0, 360.0, 1440.0]), "wgs72")
    want = [[2328.96975, -5995.22051, 1719.97297], [2456.10706, -6071.93854, 1222.89728], [2742.55133, -6079.67145, -326.38096]]
    assert (error == 0).all() and np.abs(state[:, :3] - want).max() < 0.02


def test_sgp4_errors(spark):
    deep = LINE2[:52] + " 2.00562768" + LINE2[63:]
    rows = [(LINE1, LINE2, dt(1980, 10, 2)), (None, LINE2, dt(1980, 10, 2)), ("junk", "junk", dt(1980, 10, 2)), (LINE1, deep, dt(1980, 10, 2)), (LINE1, LINE2, None)]
    df = spark.createDataFrame(rows, "a string, b string, t timestamp_ntz")
    out = [r.s for r in df.select(sgp4.state_vector("a", "b", "t").alias("s")).collect()]
    assert [s.sgp4_error for s in out] == [0, 1, 1, 2, 1] and out[0].pos_x is not None and all(s.pos_x is None for s in out[1:])


def raw_records(spark):
    base = dict.fromkeys(tables.RAW.names)
    good = base | dict(NORAD_CAT_ID=5, OBJECT_NAME="SAT", MEAN_MOTION="15.5", ECCENTRICITY="0.001", INCLINATION="51.6", RA_OF_ASC_NODE="10", ARG_OF_PERICENTER="20", MEAN_ANOMALY="30", BSTAR="0.0001", DECAY_DATE="2024-03-01")
    rows = [good | {"EPOCH": f"2024-01-{d:02d}T00:00:00", "TLE_LINE1": LINE1, "TLE_LINE2": LINE2} for d in range(1, 32)] + [good | {"EPOCH": f"2024-02-{d:02d}T00:00:00"} for d in range(1, 30)]
    odd = [{"INCLINATION": " 999.9999"}, {"OBJECT_NAME": "TBA - TO BE ASSIGNED"}, {"OBJECT_NAME": None}, {"ECCENTRICITY": "0.25"}, {"BSTAR": "-0.001"}, {"EPOCH": "not-a-date"}]
    rows += [good | {"EPOCH": f"2024-01-{i + 1:02d}T06:00:00"} | o for i, o in enumerate(odd)]
    rows += [good | {"EPOCH": "2024-01-20T06:00:00", "BSTAR": b} for b in ("", "abc", "0.002")]
    return spark.createDataFrame([tuple(r[c] for c in tables.RAW.names) + (i,) for i, r in enumerate(rows)], T.StructType([*tables.RAW.fields, T.StructField("_ordinal", T.LongType())]))


def test_history_from_raw_to_features(spark):
    cleaned = history.clean(raw_records(spark), DECAYED)
    assert cleaned.count() == 61 and cleaned.where("epoch = '2024-01-20T06:00:00'").first().bstar == 0.002
    assert history.clean(raw_records(spark), ACTIVE).count() == 63
    rows = history.features(history.regularise(history.segment(cleaned, DECAYED), DECAYED))
    assert rows.where("is_synthetic = 0").count() == 61 and rows.groupBy("epoch_dt").count().where("count > 1").count() == 0
    assert rows.where("is_synthetic = 1 and hour(epoch_dt) % 4 <> 0").count() == 0
    r = rows.where("epoch = '2024-01-31T04:00:00'").first()
    assert (r.is_synthetic, r.propagation_minutes, r.is_far_from_tle, r.rul_days) == (1, 240.0, False, 29.0)


def feed_frames(spark):
    days = [dt(2024, 1, d) for d in range(1, 11)]
    kp = [(i * 8 + s, d, f"{3 * s:04.1f}", float(s), float(2 * s)) for i, d in enumerate(days) for s in range(8)]
    flux = [(i, d, 100.0 + 150.0 * (i == 5), 1.0, 1.0) for i, d in enumerate(days) if i % 2]
    spots = [(i, d, float(i), 1.0, 1.0, "1") for i, d in enumerate(days) if i > 2]
    return (
        spark.createDataFrame(kp, "ordinal long, date timestamp_ntz, start_time string, kp_value double, ap_value double"),
        spark.createDataFrame(flux, "ordinal long, date timestamp_ntz, observed_flux double, adjusted_flux double, series_d_flux double"),
        spark.createDataFrame(spots, "ordinal long, date timestamp_ntz, sunspot_number double, std_dev double, nb_observations double, definitive string"),
    )


def test_environment_and_training(spark, tmp_path):
    env = environment.timeline(*feed_frames(spark))
    assert env.count() == 80 and env.where("date = '2024-01-01' and observed_flux is null").count() == 8
    late = env.where("date = '2024-01-06' and start_time = '21.0'").first()
    assert (late.observed_flux, late.solar_active, late.geomag_storm, late.ap_lag_3h, late.sunspot_number) == (250.0, 1, 1, 12.0, 5.0)
    orbits = history.features(history.regularise(history.segment(history.clean(raw_records(spark), DECAYED), DECAYED), DECAYED))
    play = orbits.withColumn("mean_motion_dot", F.lit(0.001))
    density = environment.density_index(play.where("is_synthetic = 0"))
    table = training.integrate(play, env, density)
    assert table.columns == [c for c in training.COLUMNS if c in table.columns] and len(table.columns) == 33
    target = str(tmp_path / "training")
    tables.append_new(table, target, ["norad_cat_id", "epoch"])
    n = spark.read.parquet(target).count()
    tables.append_new(table, target, ["norad_cat_id", "epoch"])
    assert spark.read.parquet(target).count() == n == table.count()
    assert training.integrate(play, env, density, spark.read.parquet(target)).count() == 0
    assert training.training_frame(table, 200, 365).count() == min(365, n) and training.training_frame(table, n + 1).count() == 0
    assert training.risk_of(table.withColumn("score", F.lit(0.9)), "5", "score").first().risk == "CRITICAL"


def test_snapshots_roles_and_json(spark, tmp_path):
    df = spark.range(3)
    root = str(tmp_path / "snap")
    for v in ("20240101", "20240201"):
        tables.write_version(df.withColumn("v", F.lit(v)), root, v)
    tables.write_version(df, root, "20240301", incremental=True)
    assert tables.read_latest(spark, root).first().v == "20240201"
    role = str(tmp_path / "active" / "x")
    df.write.parquet(role)
    assert tables.with_role(spark.read.parquet(role)).first().role == "active"
    with pytest.raises(Exception, match="no role"):
        tables.with_role(spark.read.parquet(f"{root}/version=20240101")).collect()
    (tmp_path / "a.json").write_text('[{"k": 1}, {"k": 2}]')
    assert tables.read_json_array(spark, str(tmp_path / "a.json")).count() == 2
    (tmp_path / "feed.txt").write_text("a\nb\n")
    assert [r.value for r in feeds.read_lines(spark, str(tmp_path / "feed.txt")).collect()] == ["a", "b", ""]
    assert tables.read_manifest(spark, [], df.schema).count() == 0
    assert tables.deltas(["x/updates/delta_1.parquet", "y"]) == ["x/updates/delta_1.parquet"] and tables.snapshots(["a/orbital_history_latest.parquet"])
    assert tables.history(df.withColumn("t", F.lit(dt(2024, 1, 2))), [1, 2], "id", "t", dt(2024, 1, 1)).count() == 2


def test_landing_and_catalogue(spark, tmp_path):
    df = spark.range(25).withColumn("name", F.when(F.col("id") > 0, F.concat(F.lit("n"), "id"))).coalesce(1)
    root = str(tmp_path / "raw")
    batch, delta = tables.batch_name("0123456789abcdef0123", 7), tables.delta_name(dt(2024, 1, 2, 3, 4, 5))
    assert batch == "data_0123456789abcdef_batch_007.parquet" and delta.startswith("delta_20240102_030405_") and len(delta) == 34
    paths = [tables.write_landed(df, root, batch, max_records=10), tables.write_landed(df, root, delta)]
    assert tables.deltas(paths) == paths[1:] and tables.read_manifest(spark, paths).count() == 50
    assert len(list((tmp_path / "raw" / batch).glob("part-*"))) == 3
    with pytest.raises(Exception, match="exists"):
        tables.write_landed(df, root, batch)
    assert tables.delete(spark, paths[0]) and not tables.exists(spark, paths[0]) and not tables.delete(spark, paths[0])
    assert tables.read_catalogue(spark, root, "active") is None
    for seed, n in ((None, 25), (47, 3)):
        path = tables.write_catalogue(df.where(F.col("id") < n), "id", root, "active", seed)
        assert sorted(r.id for r in tables.read_catalogue(spark, root, "active").collect()) == sorted(str(i) for i in range(n))
    stored = spark.read.json(path).orderBy("id").collect()
    assert stored[1].metadata.name == "n1" and stored[0].metadata.name is None and stored[0].seed == 47
    tables.write_catalogue(df.where("id < 0"), "id", root, "decayed")
    assert tables.read_catalogue(spark, root, "decayed").count() == 0


def test_append_within_a_range(spark, tmp_path):
    target = str(tmp_path / "t")
    df = spark.createDataFrame([(1, dt(2024, 1, 1)), (1, dt(2024, 1, 5)), (2, None)], "k long, t timestamp_ntz")
    tables.append_new(df, target, ["k", "t"], within="t")
    tables.append_new(df.union(spark.createDataFrame([(3, dt(2024, 1, 3)), (2, dt(2024, 1, 9))], df.schema)), target, ["k", "t"], within="t")
    tables.append_new(df.where("t is null"), target, ["k", "t"], within="t")
    tables.append_new(df.where("k > 9"), target, ["k", "t"], within="t")
    assert spark.read.parquet(target).count() == 5
    with pytest.raises(ValueError):
        tables.append_new(df, target, ["k"], within="t")


def test_hashes_and_ids(spark):
    at = dt(2024, 1, 2, 3)
    assert sampling.request_hash({"a": 1, "t": at}) == sampling.request_hash({"t": "2024-01-02T03:00:00", "a": "1", "b": None})
    assert sampling.filter_hash({"a": [2, 1]}) != sampling.filter_hash({"a": [1, 2]}) and len(sampling.filter_hash({}, "md5")) == 32
    assert sampling.data_signature({"b": 2, "a": 1}) == sampling.data_signature({"a": 1, "b": 2}) and len(sampling.data_signature({})) == 16
    with pytest.raises(ValueError):
        sampling.filter_hash({}, "crc")
    df = spark.createDataFrame([(1, None), (None, 1), (None, None), (1, None)], "a long, b long")
    ids = [r.id for r in sampling.with_row_id(df, ["a", "b"]).collect()]
    assert len(set(ids)) == 3 and ids[0] == ids[3] and all(ids)


def test_orbit_classes_at_their_bounds(spark):
    df = spark.createDataFrame([(160.0,), (160.1,), (35786.0,), (35786.1,), (None,)], "h double")
    assert [r.c for r in df.select(orbit.altitude_class("h").alias("c")).collect()] == ["VLEO", "LOW_LEO", "MEO", "GEO", None]
    rows = spark.createDataFrame([(700.0, 97.0, 0.001, 100.0), (1500.0, 63.4, 0.7, 718.0), (20200.0, 55.0, 0.01, 718.0), (700.0, 97.0, 0.001, 110.0), (700.0, None, 0.001, 100.0)], "h double, i double, e double, p double")
    assert [r.s for r in rows.select(orbit.special_orbit("h", "i", "e", "p").alias("s")).collect()] == ["SUN_SYNCHRONOUS", "MOLNIYA", "NAVIGATION", None, None]


def test_control(spark):
    assert sampling.request_hash({"a": [2, 1], "b": None}) == sampling.request_hash({"a": [1, 2]}) != sampling.request_hash({"a": [1]})
    runs = spark.createDataFrame([(1, "p", "h", "s", dt(2024, 1, 1)), (2, "p", "h", "t", dt(2024, 1, 2))], "id long, phase string, param_hash string, source_id string, created_at timestamp_ntz")
    assert control.last_run(runs, "p", "h").first().id == 2 and control.last_run(runs, "p", "h", "s").first().id == 1 and control.last_run(runs, "q", "h").count() == 0
    with pytest.raises(ValueError):
        Freshness(30, 7)
    assert [control.phase_status(*a) for a in ((1, 0), (1, 1), (0, 1), (0, 0, True))] == ["COMPLETED", "PARTIAL", "FAILED", "SKIPPED"]
    years = spark.createDataFrame([(i, 1990 + i % 10) for i in range(50)], "k long, y int")
    chosen = control.choose(years, F.col("y"), {"old": (1990, 1993), "new": (1994, 1997)}, "k", 5, anchors=years.where("k = 49 or k = 40"))
    rows = chosen.collect()
    assert len(rows) == 10 and 40 in {r.k for r in rows} and 49 not in {r.k for r in rows}


def test_windows_ties(spark):
    df = spark.createDataFrame([(1, dt(2024, 1, 1), 1.0, i) for i in range(3)], "k long, t timestamp_ntz, v double, i long")
    assert {r.n for r in windows.rolling(df, "t", ["k"], 60, {"n": F.count(F.lit(1))}).collect()} == {3}
    assert [r.r for r in windows.rate_per_day(df, "v", "t", ["k"], ["t", "i"], "r").orderBy("i").collect()] == [None, None, None]
    assert windows.keep_one(df, ["k"], [F.desc("i")]).first().i == 2 and windows.last_rows(df, ["k"], [F.desc("i")], 2).count() == 2
