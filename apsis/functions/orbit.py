"""Orbital mechanics and features of one record."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import EARTH_MU, EARTH_RADIUS, FAR_FROM_ELEMENTS_MINUTES, RISK_BANDS
from .scalar import band, clip_below, col, up_to, whole


def semimajor_axis(mean_motion: str | Column) -> Column:
    """Kilometres, from revolutions a day; null unless positive."""
    n = col(mean_motion) * (2 * math.pi / 86400.0)
    return F.when(col(mean_motion) > 0, F.pow(F.lit(EARTH_MU) / (n * n), F.lit(1.0 / 3.0)))


def altitude(axis: str | Column) -> Column:
    return col(axis) - EARTH_RADIUS


def perigee_altitude(axis: str | Column, eccentricity: str | Column) -> Column:
    return col(axis) * (1 - col(eccentricity)) - EARTH_RADIUS


def altitude_bin(height: str | Column, width: float = 100.0) -> Column:
    return F.floor(col(height) / width) * width


def log_size(c: str | Column) -> Column:
    """log10 of the absolute value; null of zero."""
    return F.when(col(c) != 0, F.log10(F.abs(col(c))))


def degrees_cycle(c: str | Column) -> tuple[Column, Column]:
    """Sine and cosine of an angle in degrees."""
    return F.sin(F.radians(col(c))), F.cos(F.radians(col(c)))


def solar_time(ts: str | Column, right_ascension: str | Column) -> Column:
    """Local solar time in hours, 0 to 24, from time of day and an angle in degrees."""
    return F.pmod(F.hour(col(ts)) + F.minute(col(ts)) / 60.0 + col(right_ascension) / 15.0, F.lit(24.0))


def hour_cosine(hours: str | Column) -> Column:
    return F.cos(2 * math.pi * col(hours) / 24)


def norm(*parts: str | Column) -> Column:
    total = F.lit(0.0)
    for p in parts:
        total = total + col(p) * col(p)
    return F.sqrt(total)


def motion(position: tuple[str, str, str], velocity: tuple[str, str, str]) -> dict[str, Column]:
    """Speed, radius, altitude, radial and tangential velocity and flight path angle of a state vector."""
    speed, radius = norm(*velocity), norm(*position)
    dot = sum((col(p) * col(v) for p, v in zip(position, velocity)), F.lit(0.0))
    radial = F.try_divide(dot, radius)
    tangential = F.sqrt(clip_below(speed * speed - radial * radial, 0.0))
    return {
        "speed_km_s": speed,
        "radius_km": radius,
        "altitude_km": radius - EARTH_RADIUS,
        "radial_velocity_km_s": radial,
        "tangential_velocity_km_s": tangential,
        "flight_path_angle_rad": F.atan2(radial, tangential),
    }


def remaining_days(ts: str | Column, decay: str | Column) -> Column:
    """Whole days until decay, negative after it."""
    return whole("DAY", ts, decay)


def log_remaining(days: str | Column) -> Column:
    return F.when(col(days) >= 0, F.log1p(col(days).cast("double")))


def minutes_between(start: str | Column, end: str | Column) -> Column:
    return whole("MILLISECOND", start, end) / F.lit(60000.0)


def far_from_elements(minutes: str | Column) -> Column:
    return F.abs(col(minutes)) > FAR_FROM_ELEMENTS_MINUTES


def low_altitude_risk(height: str | Column) -> Column:
    """Share of 100 km below 400 km; 0 above and for null."""
    return F.when(col(height) < 400, (400 - col(height)) / 100).otherwise(0.0)


def drag_proxy(mean_motion_dot: str | Column, bstar: str | Column, axis: str | Column) -> Column:
    """|n' / B*| per square kilometre of the axis; null where B* or the axis is zero."""
    return F.abs(F.try_divide(F.try_divide(col(mean_motion_dot), col(bstar)), col(axis) * col(axis)))


def risk_band(score: str | Column) -> Column:
    return band(score, RISK_BANDS, "LOW")


def period_band(period: str | Column, low: float = 95.0, mid: float = 100.0) -> Column:
    """Calibration band by period in minutes, low, mid or high; null where there is none or it is no number."""
    p = col(period).cast("string").try_cast("double")
    return F.when(p.isNull() | (p == 0), F.lit(None).cast("string")).when(p < low, "low").when(p < mid, "mid").otherwise("high")


# The highest altitude [km], inclination [deg] and eccentricity of each class, and the special orbits' ranges.
ALTITUDES = ((160, "VLEO"), (300, "LOW_LEO"), (500, "STANDARD_LEO"), (800, "HIGH_LEO"), (2000, "VERY_HIGH_LEO"), (35786, "MEO"))
INCLINATIONS = ((20, "EQUATORIAL"), (70, "INCLINED"), (85, "HIGH_INCLINED"), (95, "POLAR"))
ECCENTRICITIES = ((0.01, "CIRCULAR"), (0.1, "NEAR_CIRCULAR"), (0.5, "ELLIPTICAL"))
SUN_SYNCHRONOUS = {"inclination": (96, 98), "altitude": (600, 800), "period": (95, 105)}
MOLNIYA = {"inclination": (63.4 - 2, 63.4 + 2), "eccentricity": 0.5, "period": (700, 740)}
NAVIGATION = {"altitude": (19000, 21000), "inclination": (50, 65)}


def altitude_class(height: str | Column) -> Column:
    """Class by altitude, GEO beyond the last; like the two below, a class holds its highest value, and null has none."""
    return up_to(height, ALTITUDES, "GEO")


def inclination_class(degrees: str | Column) -> Column:
    return up_to(degrees, INCLINATIONS, "RETROGRADE")


def eccentricity_class(eccentricity: str | Column) -> Column:
    return up_to(eccentricity, ECCENTRICITIES, "HIGHLY_ELLIPTICAL")


def special_orbit(height: str | Column, inclination: str | Column, eccentricity: str | Column, period: str | Column) -> Column:
    """SUN_SYNCHRONOUS, MOLNIYA (over the least eccentricity) or NAVIGATION, the first that fits; null for none."""
    h, i, e, p = col(height), col(inclination), col(eccentricity), col(period)
    sun = h.between(*SUN_SYNCHRONOUS["altitude"]) & i.between(*SUN_SYNCHRONOUS["inclination"]) & p.between(*SUN_SYNCHRONOUS["period"])
    molniya = i.between(*MOLNIYA["inclination"]) & (e > MOLNIYA["eccentricity"]) & p.between(*MOLNIYA["period"])
    navigation = h.between(*NAVIGATION["altitude"]) & i.between(*NAVIGATION["inclination"])
    return F.when(sun, "SUN_SYNCHRONOUS").when(molniya, "MOLNIYA").when(navigation, "NAVIGATION")


def orbit_class(height: str | Column) -> Column:
    """Regime by altitude in kilometres."""
    return band(height, ((35_000, "HIGH"), (2_000, "MEDIUM")), "LOW")
