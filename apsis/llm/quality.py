"""Quality by hierarchical empirical Bayes: a document's own evidence on top of what its path and host are like.

Evidence is a naive Bayes sum over binned measures of the text, learned from labelled rows by one grouped count. Sites
are judged over all rows: a labelled row counts with its label, any other with what its evidence says. A path's share of
good rows is shrunk towards its host's, a host's towards the global one, with strengths estimated from the spread between
sites beyond chance; so sparse sites follow their parents. The document's posterior starts from its path's share.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import without, words, written

BINS = 20
#: Added to every count of a bin.
SMOOTHING = 1.0
#: Bounds of the shrinkage strengths, in rows.
WEAKEST, STRONGEST = 1.0, 1e6
#: Rows of the table of sites up to which it is broadcast; beyond, it is joined by shuffle.
BROADCAST_SITES = 50_000
SIGNS = "#*%&$!|{}<>~^=_@+"


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """df with the bin (0 to BINS - 1) of each measure of its text, in columns ``_<measure>``; null counts as empty."""
    base = df.withColumn("_text", F.coalesce(F.col(f"`{text}`"), F.lit(""))).withColumn("_words", words(F.col("_text")))
    t, ws, lines = F.col("_text"), F.col("_words"), F.split("_text", "\n")
    n, chars = F.greatest(F.size(ws), F.lit(1)), F.length(t)
    counted = lambda signs: chars - F.length(F.translate(t, signs, ""))
    upper = F.length(F.regexp_replace(t, r"\P{Lu}+", ""))
    again = F.size(F.filter(F.zip_with(ws, F.slice(ws, 2, n), lambda a, b: a == b), lambda same: same))
    ratios = {
        "signs": (10 * counted(SIGNS) + n - 1, n),  # any sign counts
        "again": (BINS * again, n),
        "stops": (BINS * counted(".,"), n),
        "upper": (BINS * upper, F.greatest(chars, F.lit(1))),
        "distinct": (BINS * F.size(F.array_distinct(ws)), n),
        "lines": (BINS * F.size(F.array_distinct(lines)), F.greatest(F.size(lines), F.lit(1))),
        "length": (chars, n),
    }
    bins = {f"_{k}": F.least(F.floor(a / b), F.lit(BINS - 1)).cast("int") for k, (a, b) in ratios.items()}
    return base.withColumns(bins).drop("_text", "_words")


MEASURES = ("signs", "again", "stops", "upper", "distinct", "lines", "length")


def _logit(p):
    return F.ln(p / (1 - p))


def _inverse(x):
    return 1 / (1 + F.exp(-x))


@dataclass
class Model:
    """Log ratios by measure and bin (a fixed number), the global share, and the table of sites."""

    ratios: dict[str, list[float]]
    share: float
    host_strength: float
    path_strength: float
    sites: DataFrame

    def evidence(self):
        total = F.lit(0.0)
        for m in MEASURES:
            total = total + F.element_at(F.array(*[F.lit(r) for r in self.ratios[m]]), F.col(f"_{m}") + 1)
        return total


def _ratios(binned: DataFrame) -> tuple[dict[str, list[float]], float]:
    """Log ratios good to bad of each bin, and the share of good rows, from rows with a label."""
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.col(f"_{m}").alias("bin")) for m in MEASURES]))
    counts = binned.where("label is not null").select(pairs.alias("x"), "label").groupBy("x.m", "x.bin").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("good"))
    table = {(r.m, r.bin): (r.good, r.n - r.good) for r in counts.collect()}  # measures x bins rows
    good, bad = (sum(v[i] for (m, _), v in table.items() if m == MEASURES[0]) for i in (0, 1))
    out = {}
    for m in MEASURES:
        out[m] = []
        for b in range(BINS):
            g, w = table.get((m, b), (0, 0))
            out[m].append(math.log((g + SMOOTHING) / (good + SMOOTHING * BINS)) - math.log((w + SMOOTHING) / (bad + SMOOTHING * BINS)))
    return out, (good + 1) / (good + bad + 2)


def _strength(groups: DataFrame, parent: str) -> float:
    """Rows that the parent's share is worth: by moments, from the spread of groups around it beyond chance."""
    r = groups.agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("groups"),
        F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - F.col(parent), 2)).alias("spread"),
        F.sum(F.col("n") * F.col(parent) * (1 - F.col(parent))).alias("chance"),
    ).first()
    if not r.n:
        return WEAKEST
    within = r.chance / r.n
    between = r.spread / r.n - within * r.groups / r.n
    return min(STRONGEST, max(WEAKEST, within / max(between, 1e-9) - 1))


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", host: str = "source", path: str = "lang", label: str = "quality") -> Model:
    """Learn from all labelled rows and judge sites over all rows of a measured table (see measure).

    Several labels of an id count as their least; labels other than 0 and 1 as none. Null hosts and paths are sites like
    any other. Without labels every ratio is zero and the share one half.
    """
    given = labels.select(F.col(id_col).alias("_id"), F.col(label).alias("label")).where("label in (0, 1)").groupBy("_id").agg(F.min("label").alias("label"))
    rows = df.select(F.col(id_col).alias("_id"), F.col(host).alias("host"), F.col(path).alias("path"), *[f"_{m}" for m in MEASURES])
    binned = written(rows.join(given, "_id", "left"))
    ratios, share = _ratios(binned)
    model = Model(ratios, share, WEAKEST, WEAKEST, None)
    belief = F.coalesce(F.col("label").cast("double"), _inverse(_logit(F.lit(share)) + model.evidence()))
    paths = written(binned.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum(belief).alias("good")))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    all_n, all_good = hosts.agg(F.sum("n"), F.sum("good")).first()
    model.share = (all_good + 1) / (all_n + 2) if all_n else share
    model.host_strength = _strength(hosts.withColumn("parent", F.lit(model.share)), "parent")
    shrunk = hosts.select(F.col("host").alias("_host"), ((F.col("good") + model.host_strength * model.share) / (F.col("n") + model.host_strength)).alias("host_share"))
    joined = paths.join(shrunk, F.col("host").eqNullSafe(F.col("_host"))).drop("_host")
    model.path_strength = _strength(joined, "host_share")
    path_share = (F.col("good") + model.path_strength * F.col("host_share")) / (F.col("n") + model.path_strength)
    model.sites = joined.select("host", "path", "host_share", path_share.alias("path_share"))
    return model


def score(df: DataFrame, model: Model, host: str = "source", path: str = "lang") -> DataFrame:
    """A measured table with ``host_share, path_share, evidence, p_good`` and ``keep`` (p_good at least one half), less its bins.

    Sites that were not seen take the global share. A null text is empty. Input columns named like a result are replaced;
    repeated rows stay; an empty table gives an empty table.
    """
    kept = without(df, "host_share", "path_share", "evidence", "p_good", "keep")
    sites = written(model.sites.withColumnRenamed("host", "_host").withColumnRenamed("path", "_path"))
    if sites.count() <= BROADCAST_SITES:
        sites = F.broadcast(sites)
    on = F.col(f"`{host}`").eqNullSafe(F.col("_host")) & F.col(f"`{path}`").eqNullSafe(F.col("_path"))
    joined = kept.join(sites, on, "left").withColumn("evidence", model.evidence())
    share = lambda c: F.coalesce(c, F.lit(model.share)).alias(c)
    names = [c for c in kept.columns if c not in {f"_{m}" for m in MEASURES}]
    out = joined.select(*[F.col(f"`{c}`") for c in names], share("host_share"), share("path_share"), "evidence")
    bounded = F.least(F.greatest("path_share", F.lit(1e-6)), F.lit(1 - 1e-6))
    return out.withColumn("p_good", _inverse(_logit(bounded) + F.col("evidence"))).withColumn("keep", F.col("p_good") >= 0.5)
