"""Constants of the domain and the settings of each role, active or decayed."""

from __future__ import annotations

from dataclasses import dataclass

# Gravitational parameter [km^3/s^2] and equatorial radius [km] of the Earth, and missing-value sentinels.
EARTH_MU = 398600.4418
EARTH_RADIUS = 6378.0
SENTINELS = ("999.9999", "9999.9999", "-999.9999")
# Columns that a record cannot do without, and all numeric ones.
CRITICAL = ("mean_motion", "eccentricity", "inclination", "ra_of_asc_node", "arg_of_pericenter", "mean_anomaly")
NUMERIC = (*CRITICAL, "bstar", "mean_motion_dot", "mean_motion_ddot", "semimajor_axis", "period", "apoapsis", "periapsis", "rev_at_epoch")
# Minutes beyond which a state is far from its elements, least scores of the risk bands, limits of the roles and of requests.
FAR_FROM_ELEMENTS_MINUTES = 720
RISK_BANDS = ((0.8, "CRITICAL"), (0.6, "HIGH"), (0.4, "MEDIUM"))


@dataclass(frozen=True)
class Role:
    """How strictly the histories of one role are cleaned and split."""

    name: str
    max_eccentricity: float
    bstar_limit: float
    negative_bstar: bool
    gap_hours: int
    raise_km: float
    grid_hours: int
    min_days: int | None
    max_latency_hours: int | None
    last_segment_only: bool


ACTIVE = Role("active", 1.0, 0.005, True, 24, 0.001, 1, None, None, False)
DECAYED = Role("decayed", 0.2, 0.01, False, 120, 0.1, 4, 30, 48, True)
ROLES = {r.name: r for r in (ACTIVE, DECAYED)}


@dataclass(frozen=True)
class Freshness:
    """Ages in days: reuse below ``reuse``, an increment below ``increment``, a full run beyond."""

    reuse: float = 7
    increment: float = 30

    def __post_init__(self):
        if not 0 <= self.reuse < self.increment:
            raise ValueError("reuse must be less than increment")


@dataclass(frozen=True)
class Quota:
    per_day: int = 200
    per_hour: int = 30
    burst: int = 15
    burst_minutes: int = 5
