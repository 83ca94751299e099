"""Toxicity by a weighted lexicon: Aho-Corasick over folded text, exception phrases, and normalisation by length.

Folding undoes case, homoglyphs, digit substitutions and invisible characters. The lexicon is learned from labelled rows:
whole words and word beginnings whose documents are toxic more often than chance, weighed by log odds. Phrases of two
words that hold an entry and yet are no commoner in toxic rows excuse it, next to a fixed list. A document's strongest word and its weights per length are turned into a score by a logistic regression on the same rows.
"""

from __future__ import annotations

import itertools
import math
import unicodedata
from dataclasses import dataclass

import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import without, written

#: Labelled rows that the lexicon and the regression are fitted on, at most; taken in order of a hash of their id.
TRAIN_ROWS = 40_000
#: Entries kept, toxic documents that an entry needs, and its least log odds.
ENTRIES, SUPPORT, LEAST_WEIGHT = 4000, 8, 2.5
#: Learned exception phrases kept, and the largest log odds of one; it needs SUPPORT clean rows.
PHRASES, MOST_WEIGHT = 4000, 0.0
#: Letters of a word beginning.
STEMS = (4, 5, 6, 7)
#: Length to which weights are normalised.
PER_WORDS = 100

# Look-alikes of Latin letters, digits and signs that stand for letters, and characters without width.
HOMOGLYPHS = "аa вb еe кk мm нh оo рp сc тt уy хx іi ѕs јj ԁd ɡg ӏl αa βb εe ηn ιi κk νv οo ρp τt υu χx ωw ıi ſs"
LEET = "0o 1i 3e 4a 5s 7t @a $s"
WIDTHLESS = "­​‌‍⁠﻿"
#: Phrases in which an entry means no harm, whatever the rows say.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "class clown", "pond scum", "not stupid", "not an idiot")


def _folding() -> dict[int, str]:
    out = {c: " " for c in range(128) if not chr(c).isalnum()}
    # Punctuation, signs and separators beyond ASCII; planes above the second hold none.
    out |= {c: " " for c in range(128, 0x20000) if unicodedata.category(chr(c))[0] in "PSZ"}
    out |= {c: None for c in range(128, 0x20000) if unicodedata.category(chr(c)) == "Mn"}
    out |= {ord(c): None for c in WIDTHLESS}
    out |= {ord(a): b for a, b in (p for part in (HOMOGLYPHS, LEET) for p in part.split())}
    return out


_FOLD = _folding()


def fold(text: str | None) -> str:
    """Folded text, a blank before and after; punctuation, signs and separators part words, accents and other marks go."""
    text = text or ""
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text)  # first, as styled capitals are letters without a lower case
    return f" {text.lower().translate(_FOLD)} "


def _entries_of(text: str | None) -> set[str]:
    out = set()
    for w in set(fold(text).split()):
        out.add(f" {w} ")
        out.update(f" {w[:n]}" for n in STEMS if len(w) > n)
    return out


@dataclass
class Lexicon:
    """Weights of entries: ' word ' for a whole word, ' stem' for a word's beginning; phrases that excuse entries in them."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS

    def automaton(self):
        import ahocorasick

        a = ahocorasick.Automaton()
        for e, w in self.weights.items():
            a.add_word(e, (len(e), w))
        for e in {f" {' '.join(fold(e).split())} " for e in self.exceptions}:
            a.add_word(e, (len(e), None))
        if len(a):
            a.make_automaton()
        return a

    def measures(self, automaton, text: str | None) -> tuple[float, float, int]:
        """The strongest word, the sum of the words' weights per length, and the number of words hit."""
        folded = fold(text)
        hits: dict[int, float] = {}
        excused: list[tuple[int, int]] = []
        if len(automaton):
            for end, (length, weight) in automaton.iter(folded):
                start = end - length + 1
                if weight is None:
                    excused.append((start, end))
                else:
                    hits[start] = max(weight, hits.get(start, 0.0))
        if excused:
            # Both in order of place: one sweep, however many there are.
            excused.sort()
            kept, at, until = {}, 0, -1
            for s in sorted(hits):
                while at < len(excused) and excused[at][0] <= s:
                    until = max(until, excused[at][1])
                    at += 1
                if s >= until:
                    kept[s] = hits[s]
            hits = kept
        if not hits:
            return 0.0, 0.0, 0
        total = sum(sorted(hits.values()))
        return max(hits.values()), total * PER_WORDS / max(PER_WORDS, len(folded.split())), len(hits)


def _weights(df: DataFrame, entries_of, text: str, label: str) -> DataFrame:
    """``entry, clean, toxic, weight``: rows of either label that hold each of a text's entries, and its log odds."""

    def count(batches):
        of = entries_of()
        for pdf in batches:
            seen: dict[str, list[int]] = {}
            for t, y in zip(pdf["_text"], pdf["_label"]):
                for e in of(t):
                    seen.setdefault(e, [0, 0])[y] += 1
            yield pd.DataFrame([(e, a, b) for e, (a, b) in seen.items()], columns=["entry", "clean", "toxic"])

    rows = df.select(F.col(text).alias("_text"), F.col(label).cast("int").alias("_label")).where("_label in (0, 1)")
    clean, toxic = rows.agg(F.sum(1 - F.col("_label")), F.sum("_label")).first()
    clean, toxic = clean or 0, toxic or 0
    counts = rows.mapInPandas(count, "entry string, clean long, toxic long").groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    weight = F.ln((F.col("toxic") + 0.5) / F.lit(toxic + 1.0)) - F.ln((F.col("clean") + 0.5) / F.lit(clean + 1.0))
    return counts.withColumn("weight", weight)


def learn_lexicon(df: DataFrame, text: str = "text", label: str = "label") -> Lexicon:
    """Entries over-represented in rows of label 1, and phrases around them that are not.

    At most ENTRIES entries and PHRASES phrases come to the driver.
    """
    best = _weights(df, lambda: _entries_of, text, label).where((F.col("toxic") >= SUPPORT) & (F.col("weight") >= LEAST_WEIGHT))
    # The most telling ones by weight and support; the driver holds ENTRIES rows at most.
    top = best.orderBy(F.desc(F.col("weight") * F.sqrt("toxic")), "entry").limit(ENTRIES).collect()
    weights = {r.entry: float(r.weight) for r in top}
    if not weights:
        return Lexicon({})

    def phrases():
        automaton = Lexicon(weights, ()).automaton()

        known: dict[str, bool] = {}

        def of(t):
            ws = fold(t).split()
            for w in set(ws).difference(known):
                known[w] = next(automaton.iter(f" {w} "), None) is not None
            return {f"{a} {b}" for a, b in itertools.pairwise(ws) if known[a] or known[b]}

        return of

    mild = _weights(df, phrases, text, label).where((F.col("clean") >= SUPPORT) & (F.col("weight") <= MOST_WEIGHT))
    learned = [r.entry for r in mild.orderBy(F.desc("clean"), "entry").limit(PHRASES).collect()]
    return Lexicon(weights, (*EXCEPTIONS, *learned))


@dataclass
class Model:
    lexicon: Lexicon
    coefficients: list[float]
    intercept: float


_MEASURES = [("_most", T.DoubleType()), ("_sum", T.DoubleType()), ("_hits", T.LongType())]


def measure(df: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """df less its text, with the lexicon's measures."""
    kept = df.drop(text)
    schema = T.StructType([*kept.schema.fields, *[T.StructField(n, t) for n, t in _MEASURES]])

    def run(batches):
        automaton = lexicon.automaton()
        for pdf in batches:
            made = [lexicon.measures(automaton, t) for t in pdf[text]]
            out = pdf.drop(columns=text)
            for i, (name, _) in enumerate(_MEASURES):
                out[name] = [m[i] for m in made]
            yield out

    return df.select(*kept.columns, text).mapInPandas(run, schema)


def _features():
    return F.array(F.col("_most"), F.log1p("_sum"), F.log1p(F.col("_hits").cast("double")))


def fit(df: DataFrame, text: str = "text", label: str = "label") -> Model:
    """Lexicon and regression from labelled rows (label 0 or 1; others are left out). Give at most TRAIN_ROWS.

    With rows of one class only, or none, the lexicon is empty and the score is that class's share (0.5 of none).
    """
    df = written(df.select(text, F.col(label).cast("int").alias(label)).where(f"{label} in (0, 1)"))
    n, toxic = df.agg(F.count(F.lit(1)), F.sum(label)).first()
    if not n or not toxic or toxic == n:
        p = (toxic / n if n else 0.5) * 0.998 + 0.001
        return Model(Lexicon({}), [0.0, 0.0, 0.0], math.log(p / (1 - p)))
    lexicon = learn_lexicon(df, text, label)
    rows = written(measure(df, lexicon, text).select(F.col(label).cast("double").alias("label"), array_to_vector(_features()).alias("features")))
    fitted = LogisticRegression(maxIter=50, regParam=1e-3).fit(rows)
    return Model(lexicon, [float(c) for c in fitted.coefficients], float(fitted.intercept))


def score(df: DataFrame, model: Model, text: str = "text", score: str = "score", predicted: str = "predicted") -> DataFrame:
    """df less its text, with a score from 0 to 1 and whether it reaches 0.5.

    Null and empty texts have no hits and get the lowest score; repeated rows stay; input columns named like a result are
    replaced; an empty table gives an empty table.
    """
    measured = measure(without(df, score, predicted), model.lexicon, text)
    x = _features()
    raw = F.lit(model.intercept)
    for i, c in enumerate(model.coefficients):
        raw = raw + x[i] * F.lit(c)
    names = [c for c in measured.columns if c not in dict(_MEASURES)]
    done = measured.select(*[F.col(f"`{c}`") for c in names], (1 / (1 + F.exp(-raw))).alias(score))
    return done.withColumn(predicted, (F.col(score) >= 0.5).cast("int"))


def training_rows(documents: DataFrame, labels: DataFrame, label: str, id_col: str = "doc_id", text: str = "text", most: int = TRAIN_ROWS) -> DataFrame:
    """``text, label`` of at most ``most`` labelled documents outside the held-out fold, in order of a hash of the id."""
    given = labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("label")).where(f"label in (0, 1) and not {held_out_sql('_id')}")
    chosen = given.groupBy("_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("_id"), "_id").limit(most)
    # Bounded: `most` rows of two numbers.
    return documents.join(F.broadcast(chosen), F.col(id_col) == F.col("_id")).select(F.col(text).alias("text"), "label")


def held_out_sql(id_col: str) -> str:
    return f"(coalesce(crc32(cast(cast({id_col} as string) as binary)), 0) % 5 = 0)"
