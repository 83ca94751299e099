"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

from apsis.llm import queries, spelling

SCHEMA = "doc_id long, text string, word string, rank string, key string, n string"


def near(a, b):
    """Whether one inserted, deleted or replaced code point makes one word of the other."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    forms, out = {}, {}
    for w, n in words.items():
        others = [v for v in words if near(w, v)]
        best = min(others, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 2 * n else None
        out[w] = [forms[w], n, len(others), words[best] if forms[w] else None]
    for w in words:
        root = w
        while forms[root]:
            root = forms[root]
        out[w].append(root)
    return out


def found(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: [r.form, r.n, r.n_near, r.form_n, r.root] for r in rows}


def frame(spark, rows):
    return spark.createDataFrame([(i, t, *["clash"] * 4) for i, t in rows], SCHEMA)


def test_variants_against_brute_force(spark):
    """Few letters, so that words have many neighbours; accents, signs within the range, capitals, equal neighbours and ties."""
    rng = random.Random(5)
    words = ["".join(rng.choice("ABabé÷") for _ in range(rng.choice([4, 5, 5, 6, 7]))) for _ in range(900)]
    words += ["Schön", "Schon", "SCHÖN", "schöön", "Œuvres", "ångström", "naïveté"] * 5
    rows = [(i, rng.choice([" ", ", ", "1", "_", "Œ"]).join(rng.choice(words) for _ in range(60))) for i in range(150)]
    rows += [(None, None), (1, None), (2, ""), (None, "Schön schön schön"), (7, "abcde"), (7, "abcde")]
    want = brute(rows)
    assert max(r[2] for r in want.values()) > 8 and any(r[0] and r[4] != r[0] for r in want.values())
    assert found(spelling.variants(frame(spark, rows))) == want


def test_long_chain_of_forms(spark):
    """Each word has twice the occurrences of the one before: the root is twelve forms away."""
    chain = ["a" * i + "b" * (12 - i) for i in range(13)]
    rows = [(100 + i, f"{w} ") for i, w in enumerate(chain)]
    df = frame(spark, [(i, t * 3 * 2**k) for k, (i, t) in enumerate(rows)])
    got = found(spelling.variants(df))
    assert got == brute([(r.doc_id, r.text) for r in df.collect()])
    assert got["b" * 12][4] == "a" * 12


def test_very_long_words(spark):
    """A word costs its length: 200,000 letters are 400,000 keys."""
    word = "abcdefghij" * 20_000
    rows = [(i, word) for i in range(12)] + [(i, word[:777] + word[778:]) for i in range(20, 24)] + [(i, word[:99] + "z" + word[100:]) for i in range(30, 34)]
    got = {(len(w), r[1]): r for w, r in found(spelling.variants(frame(spark, rows))).items() if r[1] > 2}
    assert sorted(got) == [(199_999, 4), (200_000, 4), (200_000, 12)]
    assert got[200_000, 12][2] == 2 and got[199_999, 4][0] == word and got[200_000, 4][0] == word


def test_no_words(spark):
    assert found(spelling.variants(frame(spark, []))) == {}
    assert found(spelling.variants(frame(spark, [(1, None), (2, "abcd abcd abcd"), (3, "many words but once")]))) == {}


def test_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = found(queries.op13_spelling_variants(spark, sf))
    words = {w for w in got if w < "d"}
    want = brute(docs)
    assert got.keys() == want.keys() and {w: got[w] for w in words} == {w: want[w] for w in words}
