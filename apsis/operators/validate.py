"""Cleaning and checking of columns against declared rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.scalar import all_of, number


@dataclass(frozen=True)
class Rule:
    """What a column must satisfy: presence, a range, or a set of values."""

    column: str
    kind: str | None = None
    required: bool = False
    ge: float | None = None
    gt: float | None = None
    le: float | None = None
    lt: float | None = None
    values: tuple | None = None

    def holds(self) -> Column | None:
        c = F.col(self.column)
        tests = [test(bound) for test, bound in ((c.__ge__, self.ge), (c.__gt__, self.gt), (c.__le__, self.le), (c.__lt__, self.lt)) if bound is not None]
        if self.values is not None:
            tests.append(c.isin(*self.values))
        return all_of(tests) if tests else None


def without_matches(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose text does not match; a null text goes too."""
    return df.where(~F.col(column).rlike(pattern))


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def clean_numbers(df: DataFrame, columns, fill: dict | None = None) -> DataFrame:
    """Texts to doubles, blanks and sentinels to null (see functions.scalar.number); then fills. Absent columns are passed over."""
    done = df.withColumns({c: number(c) for c in columns if c in df.columns})
    return done.fillna({k: v for k, v in (fill or {}).items() if k in df.columns})


def states(df: DataFrame, rules: list[Rule], ts: str | None = None, cutoff=None) -> DataFrame:
    """df, typed, with ``_state``: invalid (breaks a rule, or has no readable time where there is a cutoff), filtered (good but not
    later than the cutoff) or valid. Times that come as text may carry a zone."""
    typed, good = _judged(df, rules, "fail")
    state = F.when(~good, "invalid")
    if cutoff is not None:
        at = F.col(ts) if typed.schema[ts].dataType.typeName() == "timestamp_ntz" else F.to_timestamp_ntz(F.try_to_timestamp(F.col(ts).cast("string")).cast("string"))
        state = state.when(at.isNull(), "invalid").when(at <= F.lit(cutoff).cast("timestamp_ntz"), "filtered")
    return typed.withColumn("_state", state.otherwise("valid"))


def _counts() -> list[Column]:
    return [F.count(F.lit(1)).alias("input"), *[F.count_if(F.col("_state") == s).alias(s) for s in ("valid", "filtered", "invalid")]]


def counted(df: DataFrame, rules: list[Rule], ts: str | None = None, cutoff=None) -> tuple[DataFrame, DataFrame]:
    """Good rows later than a cutoff, and one row of counts: ``input, valid, filtered, invalid`` (see states); each is one scan."""
    marked = states(df, rules, ts, cutoff)
    return marked.where("_state = 'valid'").drop("_state"), marked.agg(*_counts())


def observed(df: DataFrame, rules: list[Rule], ts: str | None = None, cutoff=None, name: str | None = None) -> tuple[DataFrame, Observation]:
    """The same good rows, and the same counts taken while the good rows are written: one scan for both.

    The counts (``observation.get``) are there once one action has run over all good rows, and are that action's.
    """
    observation = Observation(name) if name else Observation()
    marked = states(df, rules, ts, cutoff).observe(observation, *_counts())
    return marked.where("_state = 'valid'").drop("_state"), observation


def validate(df: DataFrame, rules: list[Rule], nulls: str = "fail", only_declared: bool = False) -> tuple[DataFrame, DataFrame]:
    """Good and rejected rows. ``nulls``: "fail" (a rule must be true) or "pass" (a null passes all but required).

    A required column that is missing raises; other missing columns have no rules. Declared kinds are cast softly.
    """
    typed, good = _judged(df, rules, nulls)
    columns = [r.column for r in rules if r.column in df.columns] if only_declared else typed.columns
    return typed.where(good).select(columns), typed.where(~good)


def _judged(df: DataFrame, rules: list[Rule], nulls: str) -> tuple[DataFrame, Column]:
    if missing := [r.column for r in rules if r.required and r.column not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    if nulls not in ("fail", "pass"):
        raise ValueError("nulls is fail or pass")
    here = [r for r in rules if r.column in df.columns]
    typed = df.withColumns({r.column: F.col(r.column).try_cast(r.kind) for r in here if r.kind})
    tests = [F.col(r.column).isNotNull() for r in here if r.required]
    for r in here:
        if (test := r.holds()) is not None:
            tests.append(F.coalesce(test, F.lit(False)) if nulls == "fail" else F.col(r.column).isNull() | test)
    return typed, all_of(tests)


def role_thresholds(df: DataFrame, role: str, limits: DataFrame, tests: dict[str, tuple[str, bool]]) -> DataFrame:
    """Rows within their role's limits: tests maps a column to (limit column, absolute). limits has one row per role.

    The limits are broadcast: Spark takes a table made of local rows for a huge one, and by shuffle a role is one task's.
    """
    joined = df.join(F.broadcast(limits), role)
    conditions = [(F.abs(F.col(c)) if absolute else F.col(c)) <= F.col(limit) for c, (limit, absolute) in tests.items()]
    return joined.where(all_of(conditions)).select(df.columns)
