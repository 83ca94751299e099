"""Spelling variants: the words within one edit of each word, without a pair ever being made.

A word with one code point masked names the group of all words that differ from it there alone: its position, prefix and
suffix. A group has as many members as there are letters at most; its size and its first two members tell every member's neighbours
and the best of them. A word with one code point left out meets the vocabulary itself. Masked, shortened and whole words
are told apart by fingerprints of 127 bits, which follow from one another in constant time, so a word of any length costs
its length and no more.
"""

from __future__ import annotations

from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written

#: Code points that a word has at least, and its occurrences.
LEAST_LETTERS, LEAST_TIMES = 5, 3
#: A form has so many times the occurrences of its variant at least.
TIMES_FORM = 2
#: One of so many occurrences loses a code point.
LOSSES = 97
#: Fingerprints are polynomials in BASE over a prime field; MASK is no letter.
PRIME, BASE, MASK = (1 << 127) - 1, 0x5BD1E995_27D4EB2F_165667B1_9E3779B9 % ((1 << 127) - 1), 1
UNBASE = pow(BASE, -1, PRIME)
MASKED, SHORT, WHOLE = 0, 1, 2
#: Keys that one batch to Spark holds.
BATCH_KEYS = 200_000
#: Forms grow at least twofold, so a chain has fewer links than 2 ** MOST_ROUNDS.
MOST_ROUNDS = 8


def occurrences(df: DataFrame, key: str, text: str):
    """``word``, once for each occurrence of a run of letters that is long enough, after the losses.

    Runs shorter than a word can't become one and are passed over.
    """
    lowered = F.translate(F.col(f"`{text}`"), ascii_uppercase, ascii_lowercase)
    found = F.regexp_extract_all(lowered, F.lit(rf"[a-zÀ-ÿ]{{{LEAST_LETTERS},}}"), F.lit(0))
    runs = df.select(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("key"), F.explode(found).alias("run"))
    h = runs.select("run", F.crc32(F.encode(F.concat("key", F.lit(":"), "run"), "UTF-8")).alias("h"))
    at = F.pmod("h", F.char_length("run").cast("long")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    return h.select(F.when(F.col("h") % LOSSES == 0, less).otherwise(F.col("run")).alias("word")).where(F.char_length("word") >= LEAST_LETTERS)


def vocabulary(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n, rank``: the words that are frequent enough; a smaller rank has more occurrences or comes earlier."""
    counts = occurrences(df, key, text).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_TIMES)
    return written(counts.orderBy(F.desc("n"), "word").withColumn("rank", F.monotonically_increasing_id()))


def fingerprints(word: str) -> Iterator[tuple[int, bytes]]:
    """``kind, fingerprint`` of the word, of it with each code point masked, and of it with each left out, each text once.

    The fingerprint of c0 c1 c2 ... is c0 + c1 B + c2 B^2 + ... in the field.
    """
    codes = list(map(ord, word))
    whole, power = 0, 1
    for c in codes:
        whole = (whole + c * power) % PRIME
        power = power * BASE % PRIME
    yield WHOLE, whole.to_bytes(16, "big")
    before, power = 0, 1  # of the code points before the one at hand
    for i, c in enumerate(codes):
        own = c * power
        yield MASKED, ((whole + MASK * power - own) % PRIME).to_bytes(16, "big")
        if i + 1 == len(codes) or codes[i + 1] != c:  # of equal neighbours any one left out gives the same text
            yield SHORT, ((before + (whole - before - own) * UNBASE) % PRIME).to_bytes(16, "big")
        before = (before + own) % PRIME
        power = power * BASE % PRIME


def _keys(batches):
    ranks, kinds, keys = [], [], []
    for pdf in batches:
        for rank, word in zip(pdf["rank"], pdf["word"]):
            for kind, key in fingerprints(word):
                ranks.append(rank)
                kinds.append(kind)
                keys.append(key)
                if len(keys) == BATCH_KEYS:
                    yield pd.DataFrame({"rank": ranks, "kind": kinds, "key": keys})
                    ranks, kinds, keys = [], [], []
    yield pd.DataFrame({"rank": ranks, "kind": kinds, "key": keys})


def neighbours(words: DataFrame) -> DataFrame:
    """``rank, n_near, best`` of the words that have a near one: how many, and the smallest rank of them."""
    keys = written(words.select("rank", "word").mapInPandas(_keys, "rank long, kind int, key binary"), ("kind",))
    masked = keys.where(F.col("kind") == MASKED).groupBy("key").agg(F.array_sort(F.collect_list("rank")).alias("ranks"))  # as many as letters
    groups = masked.where(F.size("ranks") > 1).select(F.size("ranks").cast("long").alias("n"), F.col("ranks")[0].alias("first"), F.col("ranks")[1].alias("second"), F.explode("ranks").alias("rank"))
    replaced = groups.select("rank", (F.col("n") - 1).alias("n_near"), F.when(F.col("rank") == F.col("first"), F.col("second")).otherwise(F.col("first")).alias("best"))
    whole = keys.where(F.col("kind") == WHOLE).select("key", F.col("rank").alias("shorter"))
    met = keys.where(F.col("kind") == SHORT).select("key", "rank").join(whole, "key")
    ends = F.explode(F.array(F.struct("rank", F.col("shorter").alias("best")), F.struct(F.col("shorter").alias("rank"), F.col("rank").alias("best"))))
    added = met.select(ends.alias("e")).select("e.rank", F.lit(1).cast("long").alias("n_near"), "e.best")
    return replaced.unionByName(added).groupBy("rank").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """``rank, root``: where the chain of ``rank, to`` that starts at each rank ends, its reach doubled round by round."""
    state = written(links.select("rank", F.col("to").alias("root")))
    for _ in range(MOST_ROUNDS):
        further = state.select(F.col("rank").alias("root"), F.col("root").alias("further"))
        then = written(state.join(further, "root", "left").select("rank", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        discard(state)
        state = then.drop("moved")
        state.written_path = then.written_path
        if then.where("moved").isEmpty():
            return state
    raise RuntimeError("chains of forms don't end")


def variants(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the texts.

    Words are runs of Latin letters (A-Z lower-cased) of LEAST_LETTERS code points that occur LEAST_TIMES times in all,
    where one of LOSSES occurrences, by the checksum of key and run, has lost a code point. A word's form is the commonest word
    one edit away (ties: first in code-point order) if it is TIMES_FORM times as common, its root the end of the chain of forms.
    A null text holds nothing, a null key counts as empty; repeated rows count again; other columns have no part; no words
    give an empty table.
    """
    words = vocabulary(df, key, text)
    near = neighbours(words)
    best = words.select(F.col("rank").alias("best"), F.col("word").alias("best_word"), F.col("n").alias("best_n"))
    known = words.join(near, "rank", "left").join(best, "best", "left")
    is_form = F.col("best_n") >= TIMES_FORM * F.col("n")
    done = written(
        known.select(
            "rank", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best")).alias("to"),
            F.when(is_form, F.col("best_word")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"),
        )
    )
    ends = roots(done.where("to is not null").select("rank", "to"))
    named = ends.join(words.select(F.col("rank").alias("root"), F.col("word").alias("root_word")), "root").select("rank", "root_word")
    return done.join(named, "rank", "left").select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
