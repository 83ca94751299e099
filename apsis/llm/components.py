"""Connected components of a table of links, by rounds of joins; no links come to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .common import discard, join_hot, written

MOST_ROUNDS = 60


def _round_of_joins(both: DataFrame, n: int) -> DataFrame:
    """``u, v, m``: larger neighbours by the smallest neighbour v, and the least such m of each u, for n links both ways."""
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("_n"))
    large = join_hot(both, least, ["u"], n).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    low = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("_n"))
    return join_hot(large, low, ["u"], n)


def _round_of_windows(both: DataFrame) -> DataFrame:
    """The same for links of which no node has more than a task can hold; rows may repeat."""
    own = Window.partitionBy("u")
    large = both.withColumn("m", F.least(F.min("v").over(own), "u")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return large.withColumn("m", F.min("v").over(own))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node of links, root being the smallest node of its component.

    Each round joins every larger neighbour, then every smaller one, to the smallest neighbour of its node, until only
    stars around the smallest nodes are left; the number of rounds grows with the logarithm of a component's diameter.
    Minima are taken by partial aggregation and come to a hub's links where they are; where no node can be a hub, by windows,
    which take three shuffles a round instead of six: each costs the driver a stage, and its tasks' reports, however few the
    links are. Rounds are written to the shared folder.
    """
    pair = F.least(a, b).alias("v"), F.greatest(a, b).alias("u")
    stars = written(links.select(*pair).where("u <> v").distinct())
    seen, n = None, stars.count()
    for _ in range(MOST_ROUNDS):
        both = stars.select("u", "v").union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        joined = _round_of_windows(both) if 2 * n <= common.HOT_ROWS else _round_of_joins(both, 2 * n)
        joined = joined.select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        then = written(joined.select("e.u", "e.v").where("u <> v").distinct())
        state = then.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(stars)
        stars, n = then, state[0]
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components not settled after {MOST_ROUNDS} rounds")
    roots = stars.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
