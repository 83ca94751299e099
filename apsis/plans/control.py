"""What decides whether a run happens: history, freshness, quota, catalogue choice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Freshness, Quota
from ..operators.incremental import latest
from ..operators.sampling import stratified
from ..operators.windows import rolling


def last_run(history: DataFrame, phase: str, param_hash: str, source_id: str | None = None) -> DataFrame:
    """The newest recorded run of a request; any source if none is named."""
    found = history.where((F.col("phase") == phase) & (F.col("param_hash") == param_hash))
    if source_id is not None:
        found = found.where(F.col("source_id") == source_id)
    return latest(found, ["phase", "param_hash"], ["created_at", "id"])


def decision(age_days: Column, policy: Freshness = Freshness()) -> Column:
    """REUSE, INCREMENTAL or RUN by the age of the last run; RUN without one."""
    return F.when(age_days < policy.reuse, "REUSE").when(age_days < policy.increment, "INCREMENTAL").otherwise("RUN")


def reason(age_days: Column, mode: Column, cache: str = "CACHE_HIT") -> Column:
    """Why a decision was made: the first run, a hit (of the cache or a checkpoint), stale data, or force."""
    return F.when(mode == "FORCED", "FORCE_REFRESH").when(age_days.isNull(), "INITIAL_RUN").when(mode == "REUSE", cache).otherwise("DATA_STALE")


def checkpoint_decision(age_days: Column, readable: Column | None = None) -> Column:
    """REUSE wherever the request has run, RUN where it has not, FORCED where its history cannot be read."""
    mode = F.when(age_days.isNull(), "RUN").otherwise("REUSE")
    return mode if readable is None else F.when(~readable, "FORCED").otherwise(mode)


def route(mode: str, routes: dict):
    """The plan that a decision leads to; FORCED is a full run unless it has a plan of its own."""
    found = routes.get(mode, routes.get("RUN") if mode == "FORCED" else None)
    if found is None:
        raise ValueError(f"no plan for {mode}")
    return found


def decisions(history: DataFrame, requests: DataFrame, now, policy: Freshness = Freshness(), forced: Column | None = None) -> DataFrame:
    """requests (phase, param_hash) with the age of their newest run, what to do and why; a condition may force a run."""
    newest = latest(history, ["phase", "param_hash"], ["created_at", "id"]).select("phase", "param_hash", "created_at", "manifest_files")
    joined = requests.join(newest, ["phase", "param_hash"], "left")
    age = F.timestamp_diff("SECOND", F.col("created_at"), F.lit(now).cast("timestamp_ntz")) / F.lit(86400.0)
    mode = decision(F.col("age_days"), policy)
    if forced is not None:
        mode = F.when(forced, "FORCED").otherwise(mode)
    return joined.withColumn("age_days", age).withColumn("decision", mode).withColumn("reason", reason(F.col("age_days"), F.col("decision")))


def quota_states(requests: DataFrame, ts: str, by: list[str], quota: Quota = Quota()) -> DataFrame:
    """Each request with those of the last burst span, hour and day, and the state they leave: OK, SLOW or BLOCKED."""
    spans = {"in_burst": quota.burst_minutes * 60, "in_hour": 3600, "in_day": 86_400}
    for name, seconds in spans.items():
        requests = rolling(requests, ts, by, seconds, {name: F.count(F.lit(1))}, closed=True)
    over = (F.col("in_day") > quota.per_day) | (F.col("in_hour") > quota.per_hour)
    near = (F.col("in_burst") > quota.burst) | (F.col("in_day") > 0.8 * quota.per_day) | (F.col("in_hour") > 0.8 * quota.per_hour)
    return requests.withColumn("state", F.when(over, "BLOCKED").when(near, "SLOW").otherwise("OK"))


# The ladder's names with the shares of the day's and the hour's requests that each begins beyond, and the
# factor by which it stretches the delay between requests.
LADDER = (("critical", 0.9, 0.8, 2.0), ("warning", 0.75, 0.6, 1.5), ("caution", 0.5, 0.4, 1.0))


def usage_status(day_share: Column, hour_share: Column) -> Column:
    """good, caution, warning or critical by the shares of the daily and hourly limits that are used."""
    out = F.lit("good")
    for name, day, hour, _ in reversed(LADDER):
        out = F.when((day_share > day) | (hour_share > hour), name).otherwise(out)
    return out


def delay_factor(status: Column) -> Column:
    out = F.lit(1.0)
    for name, _, _, factor in LADDER:
        out = F.when(status == name, factor).otherwise(out)
    return out


def regime(year: Column, ranges: dict[str, tuple[int, int]]) -> Column:
    """Name of the range of years; null outside all."""
    out = F.lit(None).cast("string")
    for name, (a, b) in reversed(ranges.items()):
        out = F.when(year.between(a, b), F.lit(name)).otherwise(out)
    return out


def choose(catalogue: DataFrame, year: Column, ranges: dict[str, tuple[int, int]], key: str, n: int, seed: int = 47, anchors: DataFrame | None = None) -> DataFrame:
    """n objects of each regime, anchors first, in an order that only seed and key decide."""
    named = catalogue.withColumn("regime", regime(year, ranges)).where("regime is not null")
    return stratified(named, "regime", key, n, seed, anchors)


def phase_status(done: int, failed: int, skipped: bool = False) -> str:
    if skipped:
        return "SKIPPED"
    if failed and done:
        return "PARTIAL"
    return "FAILED" if failed else "COMPLETED"
