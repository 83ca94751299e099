"""Element-set histories: cleaning, segments, the time grid, propagation and features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CRITICAL, NUMERIC, Role
from ..functions import orbit
from ..functions.scalar import timestamp
from ..functions.sgp4 import state_vector
from ..operators.asof import asof_backward, time_grid
from ..operators.segments import gap_over, gate_segments, rise_over, split_at_breaks
from ..operators.validate import clean_numbers, lower_names, without_matches
from ..operators.windows import keep_one, key_maximum, lag_diff, rate_per_day

#: Elements that are copied as reference elements of propagated rows.
ELEMENTS = (*CRITICAL, "bstar", "mean_motion_dot", "mean_motion_ddot", "semimajor_axis")
STATE = ("pos_x", "pos_y", "pos_z", "vel_x", "vel_y", "vel_z")
KEY, TIME = "norad_cat_id", "epoch_dt"


def clean(raw: DataFrame, role: Role) -> DataFrame:
    """Typed, filtered and deduplicated records; of equal (id, epoch) the last by ``_ordinal`` stays.

    Names to be assigned and nameless records, records without a critical element or a readable epoch, and those beyond
    the role's limits are dropped. A missing B* counts as zero.
    """
    df = lower_names(raw)
    for c in ("decay_date", "object_name"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    if "_ordinal" not in df.columns:
        df = df.withColumn("_ordinal", F.monotonically_increasing_id())
    df = clean_numbers(df, NUMERIC, {"bstar": 0.0, "mean_motion_dot": 0.0, "mean_motion_ddot": 0.0})
    df = df.withColumn(KEY, F.col(KEY).try_cast("long")).withColumn(TIME, timestamp("epoch")).withColumn("decay_date", timestamp("decay_date"))
    df = without_matches(df, "object_name", "TBA").dropna(subset=[*CRITICAL, KEY, TIME])
    df = df.where((F.col("eccentricity") <= role.max_eccentricity) & (F.abs("bstar") <= role.bstar_limit))
    if not role.negative_bstar:
        df = df.where("bstar >= 0")
    axis = orbit.semimajor_axis("mean_motion")
    df = df.withColumn("semimajor_axis", F.coalesce("semimajor_axis", axis) if "semimajor_axis" in df.columns else axis)
    return key_maximum(keep_one(df, [KEY, "epoch"], [F.desc("_ordinal")]), "decay_date", [KEY], "decay_date")


def segment(df: DataFrame, role: Role) -> DataFrame:
    """Histories split at long gaps and orbit raises; for decayed objects the last long segment near the decay."""
    split = split_at_breaks(df, [KEY], [TIME, "_ordinal"], [gap_over(TIME, role.gap_hours), rise_over("semimajor_axis", role.raise_km)])
    if role.min_days is None:
        return split
    return gate_segments(split, [KEY], "segment_id", TIME, role.min_days, role.max_latency_hours, "decay_date", role.last_segment_only)


def regularise(df: DataFrame, role: Role) -> DataFrame:
    """Measured rows with their state, and propagated rows on the role's grid; a measured row wins over a propagated one.

    A grid time takes the last element set at or before it; times before the first have none and give no row.
    """
    keys = [KEY, "segment_id"]
    lines = [c for c in ("tle_line1", "tle_line2") if c in df.columns]
    present = [c for c in ELEMENTS if c in df.columns]
    grid = time_grid(df, keys, TIME, role.grid_hours, TIME)
    source = df.select(*keys, F.col(TIME).alias("source_epoch"), "_ordinal", "decay_date", *lines, *[F.col(c).alias(f"ref_{c}") for c in present])
    payload = [c for c in source.columns if c not in (*keys, "_ordinal")]
    synthetic = asof_backward(grid, source, TIME, "source_epoch", keys, payload, tie="_ordinal").where("source_epoch is not null")
    synthetic = synthetic.withColumns({"is_synthetic": F.lit(1), "source": F.lit("propagated"), **{c: F.col(f"ref_{c}") for c in present}})
    measured = df.select(*keys, TIME, "decay_date", *lines, *present, F.col(TIME).alias("source_epoch")).withColumns({"is_synthetic": F.lit(0), "source": F.lit("measured")})
    both = measured.unionByName(synthetic, allowMissingColumns=True)
    rows = keep_one(both, [*keys, TIME], ["is_synthetic"])
    rows = rows.withColumn("propagation_minutes", orbit.minutes_between("source_epoch", TIME))
    if len(lines) == 2:
        rows = rows.withColumn("state", state_vector(*lines, TIME)).select("*", "state.*").drop("state")
    return rows.withColumn("epoch", F.date_format(TIME, "yyyy-MM-dd'T'HH:mm:ss"))


def features(df: DataFrame, fractional_days: bool = False) -> DataFrame:
    """Physics, cycles, solar time, time to decay and motion; columns whose inputs are missing are left out."""
    df = df.withColumns({"log_bstar": orbit.log_size("bstar"), "perigee_alt_km": orbit.perigee_altitude("semimajor_axis", "eccentricity")})
    df = rate_per_day(df, "mean_motion", TIME, ["segment_id"], [TIME], "calc_mean_motion_dot", whole_days=not fractional_days)
    for c, short in (("ra_of_asc_node", "raan"), ("arg_of_pericenter", "arg_per"), ("mean_anomaly", "mean_anomaly")):
        sine, cosine = orbit.degrees_cycle(c)
        df = df.withColumns({f"sin_{short}": sine, f"cos_{short}": cosine})
    df = df.withColumn("local_solar_time", orbit.solar_time(TIME, "ra_of_asc_node")).withColumn("cos_lst", orbit.hour_cosine("local_solar_time"))
    df = df.withColumn("rul_days", orbit.remaining_days(TIME, "decay_date").cast("double")).withColumn("log_rul", orbit.log_remaining("rul_days"))
    if set(STATE) <= set(df.columns):
        df = df.withColumns({k: v for k, v in orbit.motion(STATE[:3], STATE[3:]).items() if k != "radius_km"})
    minutes = F.abs("propagation_minutes")
    return df.withColumns({"abs_propagation_minutes": minutes, "is_far_from_tle": orbit.far_from_elements(minutes)})


def largest_jump(df: DataFrame) -> DataFrame:
    """Absolute change of mean motion to the record before; null for a key's first."""
    return lag_diff(df, "mean_motion", [KEY], [TIME, "_ordinal"], "mean_motion_jump", absolute=True)


def long_enough(df: DataFrame, launch: str, decay: str, days: int, today=None) -> DataFrame:
    """Objects in orbit for at least so many days, until today if they have not decayed."""
    end = F.coalesce(F.to_date(decay), F.current_date() if today is None else F.lit(today).cast("date"))
    return df.where(F.date_diff(end, F.to_date(launch)) >= days)
