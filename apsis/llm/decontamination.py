"""Benchmark decontamination by templates: numbers, their units and names become typed slots, windows of templates are
hash-joined, and the slots of matching windows must map benchmark values to document values one to one.

So a passage is found verbatim and with other numbers or names, but not where the slots are filled at random. Copies of
one item in a document are told apart by where their windows lie, so each may have a mapping of its own. Only
DataFrame functions are used. Windows of documents are made inside the scan's stage; the benchmark's windows are broadcast
if their measured size allows and joined by shuffle otherwise, so nothing else of the corpus moves than what matched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

WINDOW = 5
#: Share of an item's windows that a document must hold.
COVERAGE = 0.5
#: Windows that a document must hold at least, or all where an item has fewer: short questions share their frames.
LEAST_WINDOWS = 4
#: Words of a window that must not be slots.
LITERALS = 2
#: Parts of half an item's words to which places are told apart.
GRAINS = 16
#: Windows made from one run of a text's words.
RUN = 512
#: Benchmark windows up to which they are broadcast (about 100 bytes each).
BROADCAST_WINDOWS = 200_000

#: Kind of a window that is a template.
TEMPLATE = 0
#: Place of an occurrence that is the whole document, for a copy whose parts lie farther apart than an item's places allow.
ANYWHERE = -(2**62)

# Marks of slots, from the private-use area: a name, a number, a unit.
NAME, NUMBER, UNIT = "\ue001", "\ue002", "\ue003"
MARKS = NAME + NUMBER + UNIT
_NUMBER = r"\d+(?:[.,]\d+)*"
# Units recognised right after a number.
UNITS = (
    "km m cm mm mi mile miles ft feet foot inch inches yd yards kg g mg t lb lbs oz pounds l ml litre litres liters gallons "
    "s sec seconds min minutes h hr hours day days week weeks month months year years percent usd eur dollars euros cents "
    "mph kph degrees c f k w kw v hz khz mhz ghz b kb mb gb tb"
).split()


def _holds_mark(t):
    return t.contains(NAME) | t.contains(NUMBER) | t.contains(UNIT)


def marked(text):
    """Text in lower case without punctuation, each slot led by its mark; its value stays."""
    t = F.coalesce(text, F.lit(""))
    t = F.when(_holds_mark(t), F.translate(t, MARKS, "   ")).otherwise(t)
    # Each pattern tests its first character before it looks back, which is what the scan over long texts costs.
    t = F.lower(F.regexp_replace(t, r"\p{Lu}(?<=[\p{L}\p{N},)] \p{Lu})\p{Ll}+", f"{NAME}$0"))
    t = F.regexp_replace(t, rf"\d(?<![\p{{L}}\p{{N}}{NAME}]\d)\d*(?:[.,]\d+)*", f"{NUMBER}$0")
    t = F.regexp_replace(t, rf"({NUMBER}{_NUMBER}) ?({'|'.join(UNITS)})(?![\p{{L}}\p{{N}}])", rf"$1 {UNIT}$2")
    return F.trim(F.regexp_replace(t, r"[\p{P}\p{S}]+", ""), F.lit(" \t\n\x0b\f\r"))


def windows(df: DataFrame, key: str, text: str, kinds: list[int], names: bool = True) -> DataFrame:
    """``key, kind, h`` of each window of the kinds asked for, and what :func:`slotted` needs.

    Kind TEMPLATE is WINDOW words hashed by their template, kind k is k words hashed as they stand, in lower case. Without
    ``names`` these are words like any other. Texts are cut into runs
    of RUN windows first; the windows of a run are made one by one in generated code, which is kept small.
    """
    split = lambda t: F.split(t, r"\s+")
    base = df.select(key, (marked(F.col(f"`{text}`")) if names else F.replace(marked(F.col(f"`{text}`")), F.lit(NAME), F.lit(""))).alias("_marked"))
    base = base.select(
        key,
        F.when(_holds_mark(F.col("_marked")), split(F.col("_marked"))).alias("_values"),
        split(F.regexp_replace("_marked", rf"([{MARKS}])\S*", "$1")).alias("_words"),
    )
    run = lambda i: F.struct(i.alias("i"), F.slice("_words", i + 1, RUN + WINDOW - 1).alias("words"), F.slice("_values", i + 1, RUN + WINDOW - 1).alias("values"))
    runs = base.select(key, F.explode(F.transform(F.sequence(F.lit(0), F.size("_words") - 1, F.lit(RUN)), run)).alias("r")).select(key, "r.*")
    out = None
    for kind in kinds:
        size = kind or WINDOW
        # Texts without words are one empty word.
        made = runs.where(F.col("words")[0] != "").select(key, "i", "words", "values", F.explode(F.sequence(F.lit(1), F.least(F.size("words"), F.lit(RUN)))).alias("j"))
        made = made.where(F.col("j") <= F.size("words") - (size - 1))
        at = lambda c, k: F.get(c, F.col("j") + (k - 1))
        if kind == TEMPLATE:
            h = F.xxhash64(*[at("words", k) for k in range(size)])
        else:
            h = F.xxhash64(F.lit(size), *[F.translate(F.coalesce(at("values", k), at("words", k)), MARKS, "") for k in range(size)])
        part = made.select(key, "i", "j", "values", F.lit(kind).alias("kind"), h.alias("h"))
        out = part if out is None else out.union(part)
    return out


def slotted(windows: DataFrame) -> DataFrame:
    """Windows with their place ``at`` and, of templates, the values of their slots (null if there are none)."""
    own = F.filter(F.slice("values", F.col("j"), WINDOW), lambda w: w.substr(1, 1).isin(*MARKS))
    done = windows.withColumn("at", F.col("i") + F.col("j")).withColumn("slots", F.when((F.col("kind") == TEMPLATE) & F.col("values").isNotNull(), own))
    return done.withColumn("slots", F.when(F.size("slots") > 0, F.col("slots"))).drop("i", "j", "values")


def item_windows(items: DataFrame) -> DataFrame:
    """``item, item_at, kind, h, item_slots, span``: windows by which items (``item, text``) are looked for.

    Templates of at least LITERALS literal words; without any, windows of words as they stand, the longest of up to WINDOW.
    Where a template holds names, its window is also looked for with the names as words: so it is written without capitals.
    """
    rows = items.distinct().withColumn("key", F.struct("item", F.xxhash64("text").alias("row")))
    found = slotted(windows(rows, "key", "text", [TEMPLATE, *range(1, WINDOW + 1)])).where(F.coalesce(F.size("slots"), F.lit(0)) <= WINDOW - LITERALS)
    per = Window.partitionBy("key")
    rank = F.when(F.col("kind") == TEMPLATE, WINDOW + 1).otherwise(F.col("kind"))
    kept = found.withColumn("_rank", rank).withColumn("_best", F.max("_rank").over(per)).where("_rank = _best")
    size = F.when(F.col("kind") == TEMPLATE, WINDOW).otherwise(F.col("kind"))
    kept = kept.withColumn("span", F.max("at").over(per) + size - 1)
    named = kept.where(F.exists("slots", lambda w: w.startswith(NAME))).select("key", "at", "span")
    spelt = slotted(windows(rows, "key", "text", [TEMPLATE], names=False)).join(named, ["key", "at"])
    kept = kept.select("key", "at", "kind", "h", "slots", "span").unionByName(spelt.select("key", "at", "kind", "h", "slots", "span"))
    return kept.select("key.item", F.col("at").alias("item_at"), "kind", "h", F.col("slots").alias("item_slots"), "span").distinct()


def places(shift, span):
    """Places that a window of an item (of ``span`` words) counts for, by how far its place in the document is shifted.

    Two grids of half an item's words lie half a step apart, so shifts that differ by up to a quarter of the item share a
    cell, and whole or half copies one after the other never do; the document as a whole is one place more.
    """
    step = F.greatest(F.floor(span / 2), F.lit(1))
    half = F.floor(step / 2)
    return 2 * F.floor(shift / step), 2 * F.floor((shift + half) / step) + 1, F.lit(ANYWHERE).cast("long")


def contaminated(
    df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    coverage: float = COVERAGE,
) -> DataFrame:
    """``id_col, item, coverage``: documents that hold at least that share of an item's windows with consistent slots.

    LEAST_WINDOWS of them are needed in any case, or all that the item has: one window of a short question is a common phrase.
    Slots are consistent within one occurrence of the item, and the occurrence of the largest coverage counts. Windows of
    which fewer than LITERALS words are literal play no part unless an item has no others; then these are looked for word by
    word. An item of fewer words than WINDOW is looked for as a whole, word by word. Items and texts without words, null
    and empty ones hold nothing. Repeated rows of an id count once; a null id or item is like any other. Other columns play
    no part; an empty table on either side gives no rows.
    """
    # Ids and items are wrapped, so that null equals null.
    asked = benchmark.select(F.struct(F.col(f"`{item}`").alias("x")).alias("item"), F.col(f"`{item_text}`").alias("text"))
    items = written(item_windows(asked))
    small = items.count() <= BROADCAST_WINDOWS
    light = F.broadcast if small else lambda d: d
    totals = items.groupBy("item").agg(F.count_distinct("item_at").alias("windows"))
    needed = F.greatest(F.ceil(F.col("windows") * coverage - 1e-9), F.least(F.col("windows"), F.lit(LEAST_WINDOWS)))
    kinds = sorted(r.kind for r in items.select("kind").distinct().collect()) or [TEMPLATE]  # WINDOW + 1 at most
    docs = windows(df.select(F.struct(F.col(f"`{id_col}`").alias("x")).alias("id"), F.col(f"`{text}`").alias("_text")), "id", "_text", kinds)
    # The scan keeps windows that any item has, once each; items come to them below.
    met = written(slotted(docs.join(light(items.select("h").distinct()), "h", "left_semi")).select("id", "at", "h", "slots"))
    # A document may miss so many of an item's windows: it is a candidate if of the least frequent ones, one more than those, it holds one.
    common = items.groupBy("h").agg(F.count_distinct("item").alias("f"))
    rarity = items.join(light(common), "h").groupBy("item", "item_at").agg(F.min("f").alias("f")).join(light(totals), "item")
    place = F.row_number().over(Window.partitionBy("item").orderBy("f", "item_at"))
    telling = rarity.withColumn("n", place).where(F.col("n") <= F.col("windows") - needed + 1).select("item", "item_at")
    telling = written(items.join(telling, ["item", "item_at"]).select("item", "h").distinct())
    candidates = written(met.select("id", "h").distinct().join(light(telling), "h").select("id", "item").distinct())
    # Equal hits are counted before they meet the item's places, which are told apart no finer than occurrences need: a window
    # that a long text and a long item repeat makes no square of hits.
    grain = F.greatest(F.floor(F.col("span") / (2 * GRAINS)), F.lit(1))
    held_at = candidates.join(light(items.select("item", "h", "span").distinct()), "item").join(met, ["id", "h"])
    held_at = held_at.groupBy("id", "item", "h", "span", "slots", (F.floor(F.col("at") / grain) * grain).alias("at")).agg(F.count(F.lit(1)).alias("n"))
    hits = held_at.join(light(items), ["item", "h", "span"])
    first, second, anywhere = places(F.col("at") - F.floor(F.col("item_at") / grain) * grain, F.col("span"))
    hits = hits.groupBy("id", "item", first.alias("first"), second.alias("second"), "item_at", "slots", "item_slots").agg(F.sum("n").alias("n"))
    hits = written(hits.select("id", "item", F.explode(F.array("first", "second", anywhere)).alias("place"), "item_at", "slots", "item_slots", "n"))
    # Each benchmark value's commonest document value within an occurrence, and the other way round: what both agree on is the mapping.
    one = ["id", "item", "place"]
    pairs = hits.where("slots is not null").select(*one, F.explode(F.arrays_zip(F.col("item_slots").alias("b"), F.col("slots").alias("d"))).alias("p"), "n")
    counts = pairs.groupBy(*one, F.col("p.b").alias("b"), F.col("p.d").alias("d")).agg(F.sum("n").alias("count"))
    best = lambda by, other: counts.groupBy(*one, by).agg(F.max_by(other, F.struct("count", other)).alias(other))
    mapping = best("b", "d").join(best("d", "b"), [*one, "b", "d"]).groupBy(*one).agg(F.collect_set(F.struct("b", "d")).alias("mapping"))
    plain = hits.where("slots is null").select(*one, "item_at")
    agreed = (
        hits.where("slots is not null")
        .join(mapping, one)
        .where(F.forall(F.arrays_zip(F.col("item_slots").alias("b"), F.col("slots").alias("d")), lambda p: F.array_contains("mapping", p)))
        .select(*one, "item_at")
    )
    held = plain.union(agreed).distinct().groupBy(*one).agg(F.count(F.lit(1)).alias("held")).groupBy("id", "item").agg(F.max("held").alias("held"))
    share = held.join(light(totals), "item").withColumn("coverage", F.col("held") / F.col("windows"))
    return share.where(F.col("held") >= needed).select(F.col("id.x").alias(id_col), F.col("item.x").alias(item), "coverage")
