"""URL filters: a list of host and path rules, and association rules mined from labelled urls for all others.

Labelled urls become baskets of tokens (host labels, path segments, query keys). FP-growth, as joins of conditional bases,
mines the token combinations that enough bad ones hold. Those whose odds of being bad exceed the table's by enough, and which
are better than every part of themselves, become rules. A rule is indexed by its rarest token, so a common token never
gathers rules, and a url meets only the rules whose rarest token it holds.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import without, written

#: Labelled urls that a combination needs at any size of the table, and by how much its odds of being bad exceed those of
#: all labelled urls.
SUPPORT, ODDS = 25, 2.0
#: Tokens of a mined combination at most.
MOST_TOKENS = 4
#: Rules up to which their index is broadcast (tens of bytes each).
BROADCAST_RULES = 50_000
#: Parts over which the rows of one url are spread.
SALTS = 32

#: (action, host, path): a rule fits its host and all subdomains where the path starts with the rule's.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url):
    """After the first :// up to /, ? or #, with A-Z in lower case; empty without one."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url):
    """After the host up to ? or #; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def listed(host, path, rules=RULES):
    """Struct of the longest fitting rule of a short list (null if none), ``rule`` and ``action``."""
    fits = []
    for action, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        own = (host == h) | host.endswith(f".{h}")
        fits.append(F.when(own & path.startswith(p), F.struct(F.lit(h + p).alias("rule"), F.lit(action).alias("action"))))
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,action:string>")


def tokens(url):
    """Distinct tokens of a url; numbers within path segments are one and the same."""
    host, path = host_of(url), path_of(url)
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\?([^#]*)", 1)
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("h:"), x))
    segments = F.transform(F.split(path, "/"), lambda x: F.concat(F.lit("p:"), F.regexp_replace(x, r"\d+", "0")))
    keys = F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("q:"), F.split(x, "=")[0]))
    return F.array_sort(F.array_distinct(F.filter(F.concat(labels, segments, keys), lambda x: F.length(x) > 2)))


def _combinations(tokens_):
    """All combinations of up to MOST_TOKENS of a sorted array's tokens."""
    one = F.transform(tokens_, lambda x: F.array(x))
    out, last = one, one
    for _ in range(MOST_TOKENS - 1):
        last = F.flatten(F.transform(last, lambda c: F.transform(F.filter(tokens_, lambda x: x > F.element_at(c, -1)), lambda x: F.concat(c, F.array(x)))))
        out = F.concat(out, last)
    return out


def mine(labelled: DataFrame, support: int = SUPPORT, odds: float = ODDS) -> DataFrame:
    """``tokens, key, confidence, support``: rules from ``url, bad`` (boolean; rows without label or tokens play no part).

    A rule needs ``support`` labelled urls and a share of bad ones (its confidence) whose odds are at least ``odds`` times
    those of all, however many rows there are. Combinations have MOST_TOKENS tokens at most. No bad rows give no rules, and
    neither do only bad ones, as nothing then tells more than the table.
    """
    spark = labelled.sparkSession
    rows = written(labelled.where("bad is not null").select(tokens(F.col("url")).alias("tokens"), "bad").where("size(tokens) > 0"))
    n, bad = rows.agg(F.count(F.lit(1)), F.count_if("bad")).first()
    if not bad or bad == n:
        return spark.createDataFrame([], "tokens array<string>, key string, confidence double, support long")
    share = bad * odds / (bad * odds + n - bad)
    # A rule of least support and confidence holds so many bad urls, and each of its tokens too.
    least = math.ceil(round(support * share, 9))
    single = written(rows.select(F.explode("tokens").alias("token"), "bad").groupBy("token").agg(F.count(F.lit(1)).alias("freq"), F.count_if("bad").alias("bad")).where(F.col("bad") >= least))
    found = grow(rows, single, least)
    rules = found.where(F.col("freq") >= support).select("tokens", (F.col("bad") / F.col("freq")).alias("confidence"), F.col("freq").alias("support"))
    rules = written(rules.where(F.col("confidence") >= share))
    # A rule that is no better than one of its parts says nothing new.
    parts = rules.select("tokens", "confidence", F.explode(_combinations(F.col("tokens"))).alias("part")).where(F.size("part") < F.size("tokens"))
    better = rules.select(F.col("tokens").alias("part"), F.col("confidence").alias("part_confidence"))
    idle = parts.join(better, "part").where("part_confidence >= confidence").select("tokens").distinct()
    kept = rules.join(idle, "tokens", "left_anti")
    rarest = kept.select("*", F.explode("tokens").alias("token")).join(single.select("token", F.col("freq").alias("key_freq")), "token")
    rarest = rarest.groupBy("tokens", "confidence", "support").agg(F.min_by("token", F.struct("key_freq", "token")).alias("key"))
    return rarest.select("tokens", "key", "confidence", "support")


def grow(rows: DataFrame, single: DataFrame, least: int) -> DataFrame:
    """``tokens, freq, bad`` of the combinations that at least so many bad rows hold and that say more than their parts.

    FP-growth to MOST_TOKENS tokens: each combination has a conditional base, the baskets that hold it with the tokens that
    may still follow, and grows by one token of it at a time. A combination that as many rows hold as one of its parts tells the same
    rows apart, and so does all that could grow from it: it is dropped. Thus a long url that is repeated as it stands
    gives single tokens and ends there, and other baskets of t tokens give t ** MOST_TOKENS combinations at worst. Spark's own
    FPGrowth lists all 2 ** t and has no bound on length.
    """
    frequent = rows.withColumn("_row", F.monotonically_increasing_id()).select("_row", "bad", F.explode("tokens").alias("token"))
    side = single.select("token").hint("shuffle_hash")
    baskets = frequent.join(side, "token").groupBy("_row", "bad").agg(F.array_sort(F.collect_list("token")).alias("items"))
    baskets = written(baskets.groupBy("items").agg(F.count(F.lit(1)).alias("freq"), F.count_if("bad").alias("bad")))  # equal baskets grow once
    last = single.select(F.array("token").alias("tokens"), "freq", "bad")
    base = baskets.select("items", "freq", "bad", F.posexplode("items").alias("at", "token")).select("items", "freq", "bad", F.array("token").alias("tokens"), (F.col("at") + 1).alias("at"))
    found = last
    for size in range(2, MOST_TOKENS + 1):
        longer = base.where(F.col("at") < F.size("items")).select("items", "freq", "bad", "tokens", F.explode(F.sequence(F.col("at") + 1, F.size("items"))).alias("at"))
        longer = longer.withColumn("tokens", F.concat("tokens", F.array(F.element_at("items", F.col("at")))))
        counts = longer.groupBy("tokens").agg(F.sum("freq").alias("freq"), F.sum("bad").alias("bad")).where(F.col("bad") >= least)
        parts = counts.select("tokens", "freq", "bad", F.explode(F.transform(F.sequence(F.lit(1), F.lit(size)), lambda i: F.filter("tokens", lambda x: x != F.element_at("tokens", i)))).alias("part"))
        known = last.select(F.col("tokens").alias("part"), F.col("freq").alias("part_freq"))
        telling = parts.join(known, "part").where("part_freq > freq").groupBy("tokens", "freq", "bad").agg(F.count(F.lit(1)).alias("parts"))
        last = written(telling.where(F.col("parts") == size).drop("parts"))
        found = found.unionByName(last)
        if size < MOST_TOKENS:
            base = written(longer.join(last.select("tokens"), "tokens", "left_semi"))
    return written(found)


def judge(df: DataFrame, mined: DataFrame, url: str = "url", rules=RULES) -> DataFrame:
    """df with ``host, path, rule, verdict, confidence``: the longest listed rule decides, else a mined rule blocks, else allow.

    A url that is null or has no :// has empty host and path, fits no listed rule and, without tokens, no mined one:
    allowed. Repeated rows stay; input columns named like a result are replaced; an empty table gives an empty table.
    """
    kept = without(df, "host", "path", "rule", "verdict", "confidence")
    u = F.col(f"`{url}`")
    mined = written(mined)
    index = mined.select("key", F.col("tokens").alias("_rule"), F.col("confidence").alias("_confidence"))
    if mined.count() <= BROADCAST_RULES:
        index = F.broadcast(index)
    # Distinct urls meet the rules once, however often they occur; the rows of one url are spread over SALTS parts.
    urls = kept.select(u.alias("_url")).where("_url is not null").distinct().withColumn("_tokens", tokens(F.col("_url")))
    hits = urls.withColumn("key", F.explode("_tokens")).join(index, "key").where(F.size(F.array_except("_rule", "_tokens")) == 0)
    found = hits.groupBy("_url").agg(F.max("_confidence").alias("confidence")).withColumn("_salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    plain = [F.col(f"`{f.name}`") for f in kept.schema if isinstance(f.dataType, T.AtomicType)]
    salted = kept.withColumn("_part", F.pmod(F.xxhash64(*plain), F.lit(SALTS)).cast("int"))
    joined = salted.join(found, (u == F.col("_url")) & (F.col("_part") == F.col("_salt")), "left").drop("_url", "_part", "_salt")
    judged = joined.withColumn("host", host_of(u)).withColumn("path", path_of(u))
    judged = judged.withColumn("_listed", listed(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce("_listed.action", F.when(F.col("confidence").isNotNull(), "block").otherwise("allow"))
    return judged.select(*[F.col(f"`{c}`") for c in kept.columns], "host", "path", F.col("_listed.rule").alias("rule"), verdict.alias("verdict"), "confidence")
