"""Deterministic samples and content hashes."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def stratified(df: DataFrame, strata: str, key: str, n: int, seed: int = 47, first: DataFrame | None = None) -> DataFrame:
    """n rows of each stratum in order of md5(seed|key); keys listed in ``first`` (column ``key``) come before others."""
    lot = F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")).cast("binary"))
    order = [lot, key]
    if first is not None:
        df = df.join(first.select(key).distinct().withColumn("_first", F.lit(0)), key, "left")
        order = [F.coalesce("_first", F.lit(1)), *order]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(strata).orderBy(*order)))
    return ranked.where(F.col("_rank") <= n).drop("_rank", "_first")


def manifest_hash(df: DataFrame, by: list[str], value: str, out: str = "signature", digits: int = 0) -> DataFrame:
    """SHA-256 of each key's sorted values: a fingerprint of a data set's files.

    For keys of many values, parts by that many hex digits of the values' MD5 are hashed first, then their sorted hashes.
    """
    joined = lambda c: F.sha2(F.concat_ws(",", F.array_sort(F.collect_list(c.cast("string")))), 256)
    if not digits:
        return df.groupBy(*by).agg(joined(F.col(value)).alias(out))
    part = F.substring(F.md5(F.col(value).cast("string").cast("binary")), 1, digits)
    return df.groupBy(*by, part.alias("_part")).agg(joined(F.col(value)).alias("_hash")).groupBy(*by).agg(joined(F.col("_hash")).alias(out))


def _digest(values: dict, algorithm: str) -> str:
    return hashlib.new(algorithm, json.dumps(values, sort_keys=True).encode()).hexdigest()


def _text(v) -> str:
    return v.isoformat() if hasattr(v, "isoformat") else str(v)


def request_hash(parameters: dict) -> str:
    """SHA-256 of a request: nulls dropped, values as text (times in ISO form), lists in order of their text, keys sorted."""
    listed = (list, tuple, set)
    return _digest({k: sorted(map(str, v)) if isinstance(v, listed) else _text(v) for k, v in parameters.items() if v is not None}, "sha256")


def filter_hash(filters: dict, algorithm: str = "sha256") -> str:
    """SHA-256 or MD5 of filters: as a request's, but a list's order counts."""
    if algorithm not in ("sha256", "md5"):
        raise ValueError(f"unknown algorithm {algorithm}")
    return _digest({k: _text(v) for k, v in filters.items() if v is not None}, algorithm)


def data_signature(sizes: dict[str, int]) -> str:
    """Sixteen hex digits of the MD5 of the sources' row counts."""
    return _digest(sizes, "md5")[:16]


def with_row_id(df: DataFrame, keys: list[str], out: str = "id") -> DataFrame:
    """df with an id made of the keys: a recomputed task gives the same one, unlike a random or counted id.

    It is the MD5 of the keys' values as a JSON object; null keys are like any other.
    """
    return df.withColumn(out, F.md5(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).cast("binary")))
