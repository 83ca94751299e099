"""Sharding by weighted rendezvous hashing: each shard bids for a record's key and the best bid takes it.

A bid depends on the key and the shard's own name alone, so adding a shard moves records only into it, removing one only
out of it, and a shard's share follows its weight.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import without

#: Parts into which each shard is cut by key for numbering its slots; the table of part sizes has shards x PARTS rows at most.
PARTS = 256


def equal_shards(n: int) -> dict[int, float]:
    return dict.fromkeys(range(n), 1.0)


def owner(key, shards: dict[int, float]):
    """Column with the shard that owns a key (null keys are keys like any other); shards: name to weight over 0."""
    if not shards or min(shards.values()) <= 0:
        raise ValueError("shards need weights over 0")
    text = F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("null"))
    bids = []
    for name, weight in shards.items():
        # An exponential variate at rate weight: the smallest of them falls to each shard by its share of the weights.
        unit = (F.shiftrightunsigned(F.xxhash64(text, F.lit(f"shard {name}")), 11).cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
        bids.append(F.struct((-F.ln(unit) / F.lit(float(weight))).alias("bid"), F.lit(name).alias("shard")))
    return F.array_min(F.array(*bids))["shard"]


def shard(df: DataFrame, key: str, shards: dict[int, float], grown: dict[int, float] | None = None) -> DataFrame:
    """df with ``shard``, a gapless ``slot`` from 0 within it, and ``grown_shard`` under another set of shards (else null).

    Slots follow the row's part, then its columns. Equal and null keys share a shard, with slots of their own. Input
    columns named like a result are replaced; an empty table gives an empty table. A shard is numbered part by part, so
    its rows need not meet in one task.
    """
    kept = without(df, "shard", "slot", "grown_shard")
    order = [F.col(f"`{f.name}`") for f in kept.schema if f.dataType.typeName() not in ("map", "variant")]
    placed = (
        kept.withColumn("shard", owner(F.col(f"`{key}`"), shards))
        .withColumn("grown_shard", owner(F.col(f"`{key}`"), grown) if grown else F.lit(None).cast("int"))
        .withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(PARTS)).cast("int"))
    )
    sizes = placed.groupBy("shard", "_part").count()
    before = F.sum("count").over(Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("shard", "_part", F.coalesce(before, F.lit(0)).alias("_offset"))
    within = F.row_number().over(Window.partitionBy("shard", "_part").orderBy(*order))
    numbered = placed.withColumn("_within", within).join(F.broadcast(offsets), ["shard", "_part"])
    return numbered.select(*[F.col(f"`{c}`") for c in kept.columns], "shard", (F.col("_offset") + F.col("_within") - 1).cast("long").alias("slot"), "grown_shard")
