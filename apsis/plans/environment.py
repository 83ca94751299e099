"""Space weather: one timeline of geomagnetic, flux and sunspot features, and the density index of active objects."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import orbit
from ..functions.scalar import clip_above, flag
from ..operators.aggregate import nested_median
from ..operators.asof import asof_daily
from ..operators.windows import forward_fill, lag_diff, lagged, rolling

DAY = 86_400
FLUX_CEILING = 400.0


def _one_series(df: DataFrame) -> DataFrame:
    """A feed is one series: some rows a day since 1932 at most, so its windows fit one task at any size of the orbit data."""
    return df.withColumn("_series", F.lit(1))


def flux_features(flux: DataFrame) -> DataFrame:
    df = _one_series(flux.withColumn("observed_flux", clip_above("observed_flux", FLUX_CEILING)))
    means = {"flux_81d_avg": 81, "flux_7d_avg": 7}
    for name, days in means.items():
        df = rolling(df, "date", ["_series"], days * DAY, {name: F.avg("observed_flux")})
    return lagged(df, "observed_flux", ["_series"], ["date", "ordinal"], [1, 2, 3], "flux_lag_{1}d").drop("_series")


def kp_features(kp: DataFrame) -> DataFrame:
    df = _one_series(kp)
    df = rolling(df, "date", ["_series"], DAY, {"ap_24h_mean": F.avg("ap_value"), "kp_24h_mean": F.avg("kp_value")})
    w = Window.partitionBy("_series").orderBy("date", "start_time", "ordinal")
    return df.withColumns({"ap_lag_3h": F.lag("ap_value", 1).over(w), "ap_lag_6h": F.lag("ap_value", 2).over(w)}).drop("_series")


def sunspot_features(spots: DataFrame) -> DataFrame:
    df = _one_series(spots)
    for name, days in {"sunspot_30d_avg": 30, "sunspot_81d_avg": 81}.items():
        df = rolling(df, "date", ["_series"], days * DAY, {name: F.avg("sunspot_number")})
    return df.drop("_series")


def activity(df: DataFrame) -> DataFrame:
    """Ratio to the 81-day mean and the flags of solar and geomagnetic activity (1, 0 or null)."""
    df = df.withColumn("flux_enhancement", F.when(F.col("flux_81d_avg") > 0, F.col("observed_flux") / F.col("flux_81d_avg")))
    x, k = F.col("flux_enhancement"), F.col("kp_value")
    return df.withColumns({
        "day_of_year": F.dayofyear("date"),
        "solar_active": flag(x > 1.2),
        "solar_very_active": flag(x > 1.5),
        "geomag_quiet": flag(k <= 2),
        "geomag_storm": flag(k >= 5),
        "geomag_severe_storm": flag(k >= 7),
        "high_activity_period": flag((x > 1.2) | (k >= 5)),
    })


def timeline(kp: DataFrame, flux: DataFrame, spots: DataFrame) -> DataFrame:
    """The feeds on the geomagnetic rows' times, each with the latest day at or before it, gaps filled forward."""
    f = flux_features(flux).select("date", "ordinal", "observed_flux", "adjusted_flux", "series_d_flux", "flux_81d_avg", "flux_7d_avg", "flux_lag_1d", "flux_lag_2d", "flux_lag_3d")
    s = sunspot_features(spots).select("date", "ordinal", "sunspot_number", "std_dev", "nb_observations", "definitive", "sunspot_30d_avg", "sunspot_81d_avg")
    joined = kp_features(kp)
    for part in (f, s):
        joined = asof_daily(joined, part, "date", "date", [c for c in part.columns if c not in ("date", "ordinal")], ["date", "ordinal"])
    filled = forward_fill(_one_series(joined), [c for c in joined.columns if c not in ("date", "ordinal", "start_time", "mid_time")], ["_series"], ["date", "start_time", "ordinal"])
    return activity(filled.drop("_series"))


def density_index(active: DataFrame, by: str = "norad_cat_id", ts: str = "epoch_dt", width: float = 100.0, days: int = 3) -> DataFrame:
    """Daily density index from active objects: the median over altitude bins of the bins' median drag proxy.

    Near-circular orbits with drag take part, less those that manoeuvred since the record before among them. The rolling
    mean runs over one row a day; days without a value take the one before. Records of one time are in order of their values.
    """
    df = active.where("eccentricity < 0.05 and abs(bstar) > 1e-6 and mean_motion_dot is not null and semimajor_axis is not null")
    order = [ts, *[c for c in ("_ordinal",) if c in df.columns], "mean_motion", "mean_motion_dot", "bstar", "semimajor_axis"]
    df = lag_diff(df, "mean_motion", [by], order, "_jump", absolute=True).where("_jump < 0.01")
    height = orbit.altitude("semimajor_axis")
    df = df.select(
        F.date_trunc("day", ts).cast("timestamp_ntz").alias("date"), orbit.altitude_bin(height, width).alias("bin"), F.col(by).alias("object"), orbit.drag_proxy("mean_motion_dot", "bstar", "semimajor_axis").alias("drag")
    ).where("drag is not null")
    daily = nested_median(df, ["date"], ["bin"], "drag", "object").withColumnsRenamed({"median": "thermometer_density_index", "n": "thermometer_sat_count"})
    mean = rolling(_one_series(daily), "date", ["_series"], days * DAY, {f"thermometer_density_{days}d_avg": F.avg("thermometer_density_index")})
    return forward_fill(mean, [c for c in mean.columns if c not in ("date", "_series")], ["_series"], ["date"]).drop("_series")


def with_density(weather: DataFrame, density: DataFrame) -> DataFrame:
    """The environment with the day's density; every gap takes the value before it, in order of time."""
    joined = _one_series(weather.join(density, "date", "left"))
    order = ["date", *[c for c in ("start_time", "ordinal") if c in weather.columns]]
    return forward_fill(joined, [c for c in joined.columns if c not in (*order, "_series")], ["_series"], order).drop("_series")
