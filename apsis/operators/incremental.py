"""Adding to what is stored: high-water marks, inserts that ignore known keys, upserts, latest states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import all_of
from .windows import keep_one


def after_high_water(new: DataFrame, stored: DataFrame, by: list[str], ts: str) -> DataFrame:
    """Rows later than their key's latest stored time; all of a key that is not stored."""
    marks = stored.groupBy(*by).agg(F.max(ts).alias("_mark"))
    return new.join(marks, by, "left").where(F.col("_mark").isNull() | (F.col(ts) > F.col("_mark"))).select(new.columns)


def not_stored(new: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are not stored yet, each key once: the first in order of the other columns. A null key is like any other."""
    known = stored.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    fresh = new.join(known, all_of([F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]), "left_anti")
    return keep_one(fresh, keys, [c for c in new.columns if c not in keys] or keys)


def merge_upsert(old: DataFrame, new: DataFrame, keys: list[str], rules: dict[str, str]) -> DataFrame:
    """Old and new rows by key; per column "replace", "coalesce" (new unless null), "or", or "add". A null key is like any other.

    Every other column needs a rule, and both sides have the same columns; keys are unique within each side.
    """
    if set(old.columns) != set(new.columns) or set(old.columns) != {*keys, *rules}:
        odd = set(old.columns) ^ set(new.columns) | set(old.columns) ^ {*keys, *rules}
        raise ValueError(f"columns without a rule or on one side alone: {', '.join(sorted(odd))}")
    o, n = old.withColumn("_here", F.lit(True)).alias("o"), new.withColumn("_here", F.lit(True)).alias("n")
    joined = o.join(n, all_of([F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]), "full")
    here = F.col("n._here").isNotNull()

    def merged(c: str, rule: str) -> Column:
        a, b = F.col(f"o.{c}"), F.col(f"n.{c}")
        if rule == "replace":
            return F.when(here, b).otherwise(a)
        if rule == "coalesce":
            return F.coalesce(b, a)
        if rule == "or":
            return F.coalesce(a, F.lit(False)) | F.coalesce(b, F.lit(False))
        if rule == "add":
            return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
        raise ValueError(f"unknown rule {rule}")

    return joined.select(*[F.when(here, F.col(f"n.{k}")).otherwise(F.col(f"o.{k}")).alias(k) for k in keys], *[merged(c, r).alias(c) for c, r in rules.items()])


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The latest row of each key."""
    return keep_one(df, keys, [F.desc(c) for c in order])
