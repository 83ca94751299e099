"""The training table: orbits joined with their environment, added to what is stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import orbit
from ..operators.aggregate import keys_with_rows
from ..operators.asof import asof_daily
from ..operators.incremental import after_high_water
from ..operators.windows import last_rows, rate_per_day
from .environment import with_density

# Columns of the training table, in order.
COLUMNS = (
    "epoch", "date", "norad_cat_id", "mean_motion", "eccentricity", "inclination", "ra_of_asc_node", "arg_of_pericenter", "mean_anomaly",
    "bstar", "mean_motion_dot", "semimajor_axis", "altitude", "observed_flux", "flux_81d_avg", "flux_7d_avg", "kp_mean", "ap_mean",
    "altitude_change_rate", "ap_lag_3h", "ap_lag_6h", "ap_24h_mean", "kp_24h_mean", "sunspot_number", "flux_enhancement", "solar_active",
    "geomag_storm", "high_activity_period", "thermometer_density_index", "thermometer_sat_count", "thermometer_density_3d_avg",
    "low_altitude_risk", "days_until_decay",
)


def integrate(orbits: DataFrame, weather: DataFrame, density: DataFrame | None = None, stored: DataFrame | None = None) -> DataFrame:
    """Orbit rows with the day's environment and derived columns, those later than what is stored of their object."""
    if density is not None:
        weather = with_density(weather, density)
    fresh = orbits if stored is None else after_high_water(orbits, stored.select(F.col("norad_cat_id").cast("long").alias("norad_cat_id"), F.col("epoch").alias("epoch_dt")), ["norad_cat_id"], "epoch_dt")
    payload = [c for c in weather.columns if c not in ("date", "ordinal") and c not in fresh.columns]
    order = ["date", *[c for c in ("start_time", "ordinal") if c in weather.columns]]
    df = asof_daily(fresh, weather, "epoch_dt", "date", payload, order)
    df = df.withColumn("altitude", orbit.altitude("semimajor_axis"))
    ties = [c for c in ("_ordinal", "altitude", "mean_motion", "mean_anomaly") if c in df.columns]
    df = rate_per_day(df, "altitude", "epoch_dt", ["norad_cat_id"], ["epoch_dt", *ties], "altitude_change_rate")
    renamed = {"kp_mean": "kp_value", "ap_mean": "ap_value", "days_until_decay": "rul_days"}
    df = df.withColumns({new: F.col(old) for new, old in renamed.items() if old in df.columns})
    df = df.withColumns({
        "low_altitude_risk": orbit.low_altitude_risk("altitude"),
        "date": F.date_trunc("day", "epoch_dt").cast("timestamp_ntz"),
        "epoch": F.col("epoch_dt"),
        "norad_cat_id": F.col("norad_cat_id").cast("string"),
    })
    return df.select([c for c in COLUMNS if c in df.columns])


def training_frame(table: DataFrame, at_least: int = 200, last: int = 365) -> DataFrame:
    """The last rows of each object that has enough of them."""
    enough = keys_with_rows(table, ["norad_cat_id"], at_least).select("norad_cat_id")
    return last_rows(table.join(enough, "norad_cat_id", "left_semi"), ["norad_cat_id"], [F.desc("epoch")], last)


def risk_of(table: DataFrame, norad_cat_id: str, score: str, last: int = 1) -> DataFrame:
    """Latest rows of one object with the band of a score."""
    own = last_rows(table.where(F.col("norad_cat_id") == norad_cat_id), ["norad_cat_id"], [F.desc("epoch")], last)
    return own.withColumn("risk", orbit.risk_band(score))
