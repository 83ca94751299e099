"""The dealt operators against brute force, their libraries, or held-out labels, and on awkward rows."""

import gc
import hashlib
import itertools
import re
import time
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from apsis.llm import ann, bpe, common, components, decontamination, quality, queries, sharding, simhash, substring_dedup, token_counts, toxicity, url_filter
from apsis.llm.common import give_back

LONG = "lorem ipsum dolor " * 20_000
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_tokens long, ids string, fp string, component_id string, shard string, slot string, keep string, score string, n_words string, label string, count string"
CLASH = ("clash",) * 10


def rows_of(texts):
    return [(i, t, "en", "src0", len(t or ""), 7, *CLASH[:9]) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls in every column, empty and very long texts, repeated rows, ties, and columns named like results."""
    rows = rows_of(["", None, "one", LONG, " \t\n", "a b c d e f", "a b c d e f", "Ünï çødé <|endoftext|> 12,5 km", "\x1c\x85 x\xa0y"])
    rows += [rows[2], rows[2], (None,) * 15, (None, "one", None, None, None, None, *[None] * 9)]
    rows = [(*r, "extra") for r in rows]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def vocabulary(spark):
    return bpe.Vocabulary(spark, queries.vocabulary_path())


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.vocabulary_path())


@pytest.fixture(scope="module")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# 5, 10: against the tokenizers library


def test_bpe_equals_library(spark, sf, library):
    got = {r.doc_id: r for r in queries.op5_bpe(spark, sf).collect()}
    for i, text in texts_of(spark.read.parquet(f"{sf}/documents.parquet")):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_awkward(awkward, empty, vocabulary, library):
    done = bpe.encode(awkward, vocabulary, decoded="decoded")
    rows = done.collect()
    assert len(rows) == awkward.count() and done.columns.count("n_tokens") == 1
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert r.decoded == library.decode(ids, skip_special_tokens=False)
    assert bpe.decode(done.drop("decoded"), vocabulary).where("decoded is null").count() == 0
    assert bpe.encode(empty, vocabulary).count() == 0


def test_bpe_random_words(library):
    model = bpe.Model(open(queries.vocabulary_path(), encoding="utf-8").read())
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("aeinorstlhé'1"), rng.integers(1, 90))) for _ in range(3000)] + ["a" * 5000, "ab" * 3000]
    for text, packed in zip(words, model.encode(words)):
        assert np.frombuffer(packed, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    failing = sum(model.propose("".join(model.chars[b] for b in w.encode()) + bpe.END) != model.merge("".join(model.chars[b] for b in w.encode()) + bpe.END) for w in ["theand", "thblean", "strength", "unhappiness"])
    assert failing  # the exact path is taken


def test_bpe_every_character(library):
    """Each code point up to U+FFFF, alone, doubled and inside a word: ids, count and decoded text of the library."""
    model = bpe.Model(open(queries.vocabulary_path(), encoding="utf-8").read())
    chars = [chr(c) for c in range(9, 0x10000) if not 0xD800 <= c < 0xE000]
    texts = [t for c in chars for t in (c, c + c, f"a{c}b", f"{c}ala MÜ{c}LLİM")]
    for text, want, packed in zip(texts, library.encode_batch(texts, add_special_tokens=False), model.encode(texts)):
        assert np.frombuffer(packed, "<u4").tolist() == want.ids, repr(text)
    some = texts[:: 97] + ["MÜƏLLİM Əhməd Ɓala"]
    assert [model.decode(p) for p in model.encode(some)] == [library.decode(library.encode(t, add_special_tokens=False).ids, skip_special_tokens=False) for t in some]
    counts = token_counts._piece_counts(model, sorted({w for t in texts for w in model.pre_tokens(t)}))
    assert all(sum(counts[w] for w in model.pre_tokens(t)) == len(p) // 4 for t, p in zip(texts, model.encode(texts)))


def test_bpe_batches_are_cut(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(bpe, "PART_BYTES", 10)
    batch = pa.RecordBatch.from_pydict({"i": list(range(6)), "t": ["a" * 4, None, "b" * 6, "c" * 50, "", "d"]})
    assert [p.column("i").to_pylist() for p in bpe.map_parts([batch, batch.slice(0, 0)], "t")] == [[0, 1, 2], [3], [4, 5]]


def test_token_counts(spark, sf, awkward, empty, vocabulary, library):
    got = {r.doc_id: r for r in queries.op10_token_counts(spark, sf).collect()}
    for i, text in texts_of(spark.read.parquet(f"{sf}/documents.parquet")):
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((text or "").encode()), n > 2048)
    done = token_counts.count_tokens(awkward.withColumn("copy", F.col("text")), vocabulary)
    assert done.count() == awkward.count()
    for r in done.collect():
        assert r.n_tokens == len(library.encode(r["copy"] or "", add_special_tokens=False).ids)
    assert token_counts.count_tokens(empty, vocabulary).count() == 0


# 9: against counting every window


def repeats(texts, window):
    split = [(t or "").encode().split() for t in texts]
    count = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


def test_substring_dedup(spark, sf):
    got = {r.doc_id: r for r in queries.op9_substring_dedup(spark, sf).collect()}
    docs = texts_of(spark.read.parquet(f"{sf}/documents.parquet"))
    for (i, _), (n, gone, text) in zip(docs, repeats([t for _, t in docs], 35)):
        assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (n, gone, hashlib.sha256(text.encode()).hexdigest())


@pytest.mark.parametrize("window, batch, shard", [(5, 200, 20), (1, 50, 1_000_000), (7, 10_000_000, 5)])
def test_substring_dedup_splits(spark, awkward, empty, window, batch, shard):
    rng = np.random.default_rng(window)
    texts = [" ".join(rng.choice(list("abc"), rng.integers(0, 40))) for _ in range(60)]
    df = spark.createDataFrame(rows_of(texts), ", ".join(SCHEMA.split(", ")[:-1]))
    got = {r.doc_id: (r.n_words, r.n_removed, r.text) for r in substring_dedup.remove_repeats(df, window=window, batch_bytes=batch, shard_windows=shard).collect()}
    assert got == dict(enumerate(repeats(texts, window)))
    done = substring_dedup.remove_repeats(awkward, window=window).collect()
    assert sorted((r.n_words, r.n_removed, r.text) for r in done) == sorted(repeats([r.text for r in awkward.collect()], window))
    assert substring_dedup.remove_repeats(empty).count() == 0


# 7: against all pairs


def simhash_of(text, shingle=4):
    ws = (text or "").encode().lower().split()
    if not ws:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(ws[i : i + shingle]), 42) for i in range(max(1, len(ws) - shingle + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(keys, close):
    root = list(range(len(keys)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(keys)):
        for j in range(i):
            if close(keys[i], keys[j]) and find(i) != find(j):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(keys))]


def test_simhash_query(spark, sf):
    docs = sorted(texts_of(spark.read.parquet(f"{sf}/documents.parquet")))
    fps = [simhash_of(t) for _, t in docs]
    found = classes(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op7_simhash(spark, sf).collect()}
    assert got == {i: (f"{f:016x}", docs[c][0]) for (i, _), f, c in zip(docs, fps, found)}


@pytest.mark.parametrize("radius, bucket, chunk", [(4, 16, 30), (4, 2048, 8192), (2, 4, 10), (8, 8, 64)])
def test_simhash_links_lose_nothing(spark, monkeypatch, radius, bucket, chunk):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    rng = np.random.default_rng(radius)
    fps = {int(x) for x in rng.integers(-(2**62), 2**62, 150)}
    for x in list(fps)[:40]:
        for _ in range(4):
            y = x
            for b in rng.integers(0, 63, rng.integers(1, radius + 2)):
                y ^= 1 << int(b)
            fps.add(y)
    fps = sorted(fps)
    df = spark.createDataFrame([(f, f) for f in fps], "node long, fp long")
    got = {r.node: r.root for r in components.components(simhash.links(df, radius)).collect()}
    want = classes(fps, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= radius)
    assert {f: got.get(f, f) for f in fps} == {f: fps[c] for f, c in zip(fps, want)}


def test_simhash_awkward(awkward, empty):
    done = simhash.near_duplicates(awkward)
    rows = done.collect()
    assert len(rows) == awkward.count() and len(set(done.columns)) == len(done.columns)
    assert {r.fp for r in rows if r.doc_id in (0, 1, 4)} == {0} and {r.component_id for r in rows if r.doc_id in (0, 1, 4)} == {0}
    assert {r.component_id for r in rows if r.doc_id in (5, 6)} == {5} and {r.component_id for r in rows if r.doc_id == 2} == {2}
    assert simhash.near_duplicates(empty).count() == 0


def test_simhash_several_fingerprints(spark):
    rng = np.random.default_rng(0)
    base = [" ".join(rng.choice([f"w{i}" for i in range(400)], 200)) for _ in range(30)]
    near = [t.replace(t.split()[50], "changed", 1) for t in base]
    df = spark.createDataFrame(rows_of(base + near), ", ".join(SCHEMA.split(", ")[:-1]))
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(df, shingle=5, radius=8, fps=("a", "b", "c", "d"), most=40).collect()}
    assert got == {i: i % 30 for i in range(60)}


def test_components_of_long_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(100)] + [(1000, i) for i in range(1001, 1200)] + [(5000, 4999)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(101), 0), **dict.fromkeys(range(1000, 1200), 1000), 5000: 4999, 4999: 4999}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_rounds_take_few_shuffles(spark, monkeypatch):
    """The driver pays for each stage of a round however few the links are; rounds for hubs give the same roots."""
    pairs = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)], "a long, b long")
    plans, kept = [], components.written
    monkeypatch.setattr(components, "written", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or kept(df))
    few = {r.node: r.root for r in components.components(pairs).collect()}
    assert max(p.count("Exchange hashpartitioning") for p in plans) <= 3
    monkeypatch.setattr(common, "HOT_ROWS", 20)
    assert {r.node: r.root for r in components.components(pairs).collect()} == few
    assert few == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100)}


# 6


def test_sharding_query(spark, sf):
    texts = dict(texts_of(spark.read.parquet(f"{sf}/documents.parquet")))
    rows = queries.op6_sharding(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    slots = {}
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 16, zlib.crc32(data), "key")
        assert 0 <= r.shard < 40 and r.grown_shard in (r.shard, 40)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding_weights_and_moves(spark, awkward, empty):
    df = spark.range(20_000).withColumnRenamed("id", "key")
    rows = sharding.shard(df, "key", {0: 1.0, 1: 2.0, 2: 1.0}, grown={0: 1.0, 1: 2.0}).collect()
    share = Counter(r.shard for r in rows)
    assert abs(share[1] / 20_000 - 0.5) < 0.02 and abs(share[0] / 20_000 - 0.25) < 0.02
    assert all(r.grown_shard == r.shard for r in rows if r.shard != 2)
    done = sharding.shard(awkward, "doc_id", sharding.equal_shards(3))
    assert done.count() == awkward.count() and len({r.shard for r in done.where("doc_id = 2").collect()}) == 1
    assert len({(r.shard, r.slot) for r in done.collect()}) == awkward.count()
    assert sharding.shard(empty, "doc_id", sharding.equal_shards(3)).count() == 0


# 4


def test_decontamination_query(spark, sf):
    plain = lambda t: " ".join(re.sub(r"[^\w\s]", "", (t or "").lower()).split())
    items = [(r.item_id, plain(r.text)) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = {(i, k) for i, t in texts_of(spark.read.parquet(f"{sf}/documents.parquet")) for k, x in items if f" {x} " in f" {plain(t)} "}
    got = {(r.doc_id, r.item_id) for r in queries.op4_decontamination(spark, sf).collect()}
    assert want and got == want


def test_decontamination_slots(spark):
    item = "If Alice walks 12 km in 3 hours and then meets Bob, how far does Alice walk in 5 hours at the same pace without any rest?"
    docs = {
        1: f"before that {item} after that",
        2: "If Carol walks 40 miles in 8 hours and then meets Dan, how far does Carol walk in 9 hours at the same pace without any rest?",
        3: "If Carol walks 40 miles in 8 hours and then meets Dan, how far does Erik walk in 9 hours at the same pace",
        4: "nothing of the kind is said here at all, only 12 km in 3 hours",
        5: None,
        6: "",
        7: LONG,
    }
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, None), (3, "too short"), (4, "")], "item_id long, text string")
    got = {r.doc_id: r.coverage for r in decontamination.contaminated(df, bench).collect()}
    assert set(got) - {3} == {1, 2} and got[1] > 0.9 and got[2] > 0.9 and got.get(3, 0) < got[2]
    assert decontamination.contaminated(df.limit(0), bench).count() == 0
    assert decontamination.contaminated(df, bench.limit(0)).count() == 0


def test_decontamination_several_copies(spark):
    """Copies of one item with other values each, alone, one after the other and in a long page, the verbatim one among them."""
    problem = "So {} has {} red pens, then {} has {} blue pens, so {} gives {} pens and takes {} more, then {} sells {} pens to {} for {} euros."
    rng = np.random.default_rng(3)
    names = "Alice Bob Carol Dan Erik Fay Gus Hal".split()

    def copy():
        a, b = rng.choice(names, 2, replace=False)
        n = [int(x) for x in rng.choice(np.arange(10, 1000), 6, replace=False)]
        return problem.format(a, n[0], b, n[1], a, n[2], n[3], b, n[4], a, n[5])

    item = problem.format("Zoe", 2, "Yan", 3, "Zoe", 4, 5, "Yan", 6, "Zoe", 7)
    filler = " and so on it went for many more of the plain words" * 30
    docs, want = {}, set()
    for n in (1, 2, 5, 18):
        for k, (glue, more) in enumerate([(" ", []), (filler + " ", []), (" ", [item]), (filler + " ", [item])]):
            docs[10 * n + k] = glue.join([*(copy() for j in range(n)), *more])
            want.add(10 * n + k)
    halves = copy().split()
    docs[901] = " ".join([*halves[:14], *"now a long remark of quite other things goes in between the two parts".split() * 4, *halves[14:]])  # one copy, torn apart
    docs[902] = " ".join(re.sub(r"[a-z]\w+", lambda m: m[0][::-1], copy()) for j in range(5))
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id for r in decontamination.contaminated(df, bench).collect()}
    assert got - {901} == want, sorted(want ^ got)


def marked_by_hand(text):
    """(template word, word as it stands) of a text."""
    t = re.sub(f"[{decontamination.MARKS}]", " ", text or "")
    t = regex.sub(r"(?<=[\p{L}\p{N},)] )\p{Lu}\p{Ll}+", lambda m: "\ue001" + m[0], t).lower()
    t = regex.sub(r"(?<![\p{L}\p{N}\ue001])\d+(?:[.,]\d+)*", lambda m: "\ue002" + m[0], t)
    t = regex.sub(rf"(\ue002\d+(?:[.,]\d+)*) ?({'|'.join(decontamination.UNITS)})(?![\p{{L}}\p{{N}}])", "\\1 \ue003\\2", t)
    ws = regex.sub(r"[\p{P}\p{S}]+", "", t).split()
    return [(re.sub(r"([\ue001-\ue003])\S*", r"\1", w), w) for w in ws]


def contaminated_by_hand(docs, items):
    """Every document against every item, window by window."""
    out = {}

    def agreed(hits):
        pairs = Counter(p for _, own, theirs in hits for p in zip(own, theirs))
        def best(k): 
            top = {}
            for p, n in pairs.items():
                top[p[k]] = max(top.get(p[k], (0, "")), (n, p[1 - k]))
            return {k_: v for k_, (_, v) in top.items()}
        to, back = best(0), best(1)
        return len({i for i, own, theirs in hits if all(to[b] == d and back[d] == b for b, d in zip(own, theirs))})

    def grams(ws, size, exact):
        rows = [ws[i : i + size] for i in range(len(ws) - size + 1)]
        bare = lambda v: v.lstrip(decontamination.MARKS)
        return [(tuple(bare(v) for _, v in r) if exact else tuple(w for w, _ in r), tuple(v for w, v in r if not exact and w in decontamination.MARKS)) for r in rows]

    for (d, dt), (k, kt) in itertools.product(docs, items):
        a, b = marked_by_hand(dt), marked_by_hand(kt)
        size, exact = 5, False
        own = [(i, g) for i, g in enumerate(grams(b, 5, False)) if len(g[1]) <= 3]
        many = len(own)
        spelt = [(v[1:], v[1:]) if w == decontamination.NAME else (w, v) for w, v in b]  # names as words, beside the template that has them
        own += [(i, g) for i, g in enumerate(grams(spelt, 5, False)) if any(j == i and g != h for j, h in own)]
        if not own:
            size, exact = min(5, len(b)), True
            own = list(enumerate(grams(b, size, True))) if b else []
            many = len(own)
        if not own:
            continue
        span = max(i for i, _ in own) + size
        hits = [(i, x, y, j - i) for j, (g, y) in enumerate(grams(a, size, exact)) for i, (h, x) in own if g == h]
        step = max(1, span // 2)
        cells = {}
        for i, x, y, shift in hits:
            for cell in ("any", ("a", shift // step), ("b", (shift + step // 2) // step)):
                cells.setdefault(cell, []).append((i, x, y))
        held = max([agreed(h) for h in cells.values()], default=0)
        if held >= max(many / 2, min(many, 4)):
            out[d, k] = round(held / many, 9)
    return out


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_decontamination_by_hand(spark, monkeypatch, broadcast):
    """Templates, slots, dense and short items, shared windows and null ids, by broadcast and by shuffle."""
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", broadcast)
    monkeypatch.setattr(decontamination, "RUN", 7)
    rng = np.random.default_rng(8)
    names, words = ["Alice", "Bob", "Carol"], "so has then pens red takes more gives sells the of and".split()
    def text(n):
        return " ".join(rng.choice([rng.choice(words), rng.choice(names), str(rng.integers(1, 9)), f"{rng.integers(1, 9)} km"], p=[0.7, 0.1, 0.1, 0.1]) for _ in range(n))
    start = "answer this question in one word please "
    items = [(i, (start if i % 2 else "") + text(int(rng.integers(4, 25)))) for i in range(24)]
    items += [(None, "so red pens and then the pens more of it"), (100, "Alice 3 km, Bob 4 km, Carol 5 km, Dan 6 km, Erik 7 km"), (101, "7 red pens"), (102, "pens"), (103, ""), (104, None), (105, "12 13 14")]
    german = "ein Zug fährt 12 km in 3 Stunden nach Bonn und dann weiter nach Ulm"
    items += [(106, german)]
    docs = [(i, " ".join([text(int(rng.integers(0, 30))), items[i % 24][1], text(5), str(items[(i * 7) % 24][1])[: int(rng.integers(0, 80))]])) for i in range(60)]
    docs += [(None, items[3][1]), (200, items[25][1]), (201, "Alice 13 km, Bob 14 km, Carol 15 km, Dan 16 km, Erik 17 km"), (202, "we saw 7 red pens there"), (203, None), (204, ""), (205, "10 12 13 14 15"), (206, start * 3)]
    docs += [(207, "ein Zug fährt 40 km in 8 Stunden nach Köln und dann weiter nach Trier")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("coverage", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): round(r.coverage, 9) for r in decontamination.contaminated(df, bench.union(bench.limit(3))).collect()}
    want = contaminated_by_hand(docs, items)
    assert got == want
    expected = {(None, 3), (200, 100), (202, 101), (205, 105), (207, 106)}
    assert expected <= set(got), expected - set(got)
    assert (201, 100) not in got


def test_decontamination_of_short_questions_and_other_case(spark):
    """Documents that share a question's frame are clean; a copy in other case counts as much as the copy itself."""
    capital = "What is the capital of France"
    pens = "Now Alice has 3 apples and gives 2 apples to Bob before Carol takes them all away again"
    docs = {
        1: "Madrid is the capital of Spain and Lisbon is the capital of Portugal.",
        2: "Nobody knows what is the capital of this small island.",
        3: "and then they asked what is the capital of France and left",
        4: "They asked: What is the capital of Spain",
        5: pens.lower(),
        6: pens.upper(),
        7: pens,
        8: "Now Dora has 7 apples and gives 5 apples to Erik before Fay takes them all away again",
        9: "Now Dora has 7 apples and gives 5 pears to Erik but nobody takes anything at all",
    }
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    bench = spark.createDataFrame([(1, capital), (2, pens)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.coverage for r in decontamination.contaminated(df, bench).collect()}
    assert got == {(i, 1): 1.0 for i in (3, 4)} | {(i, 2): 1.0 for i in (5, 6, 7, 8)}


def test_decontamination_frames_of_clean_documents(spark):
    """Questions of one frame over many subjects: documents that put a subject into a sentence of their own are clean."""
    subjects = [f"{a}{b}" for a in "Bel Cor Dan Eri Fal".split() for b in "mar ton via sk".split()]
    frames = ["Who wrote the novel called {}", "When did the war of {} end", "How many people live in {} today", "Which river flows through the city of {}"]
    items = [(i, f.format(s)) for i, (f, s) in enumerate(itertools.product(frames, subjects))]
    clean = [x.format(s) for s in subjects for x in ("Few people live in {} today because of the rain.", "The river flows through the city of {} and on.", "She wrote the novel called {} twice.", "When the war of {} was over they did end it.")]
    df = spark.createDataFrame(list(enumerate(clean)), "doc_id long, text string")
    assert decontamination.contaminated(df, spark.createDataFrame(items, "item_id long, text string")).count() == 0


def test_decontamination_null_ids_and_items(spark):
    text = "the quick brown fox jumps over the lazy dog again"
    df = spark.createDataFrame([(1, text), (None, text)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, text), (None, text)], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontamination.contaminated(df, bench).collect()} == {(a, b) for a in (1, None) for b in (1, None)}


def test_decontamination_awkward(awkward):
    bench = awkward.select(F.col("doc_id").alias("item_id"), "text")
    got = decontamination.contaminated(awkward, bench).select("doc_id", "item_id").distinct().collect()
    assert {(5, 6), (6, 5), (3, 3)} <= {(r.doc_id, r.item_id) for r in got}


# 1, 8: held-out labels


def test_quality_separates(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    docs = quality.measure(docs)
    model = quality.fit(docs, labels.where("doc_id % 3 <> 0"))
    rows = quality.score(docs, model).join(labels, "doc_id").where("doc_id % 3 = 0").collect()
    assert np.mean([r.keep == (r.quality == 1) for r in rows]) > 0.95


def test_quality_shrinks_sparse_sites(spark):
    good, bad = "some words that read like text, as usual.", "## $$ %% !! ## $$"
    rows = [(i, good if i % 4 else bad, "big", "a") for i in range(400)] + [(1000, bad, "tiny", "a"), (1001, good, None, None)] + [(2000 + i, bad, "spam", "a") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(r[0], int(r[1] == good)) for r in rows], "doc_id long, quality int")
    sites = {r.host: r for r in quality.fit(quality.measure(df), labels).sites.collect()}
    assert sites["spam"].path_share < sites["tiny"].path_share < sites["big"].path_share
    assert len(sites) == 4 and 0 < sites["tiny"].path_share and sites[None].path_share < 1


def test_quality_awkward(spark, awkward, empty):
    labels = spark.createDataFrame([(2, 1), (2, 0), (5, None), (None, 1), (6, 7)], "doc_id long, quality int")
    awkward, empty = quality.measure(awkward), quality.measure(empty)
    model = quality.fit(awkward, labels)
    done = quality.score(awkward, model)
    assert done.count() == awkward.count() and done.where("p_good is null").count() == 0
    assert quality.score(awkward, quality.fit(awkward, labels.limit(0))).count() == awkward.count()
    assert quality.score(empty, quality.fit(empty, labels)).count() == 0


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    rows = queries.op8_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and 0 <= r.score <= 1 for r in rows)
    toxic = [r for r in rows if r.toxic == 1]
    assert np.mean([r.predicted for r in toxic]) > 0.85 and np.mean([r.predicted for r in rows if r.toxic == 0]) < 0.02


def test_toxicity_folding_and_exceptions():
    lexicon = toxicity.Lexicon({" idiot ": 5.0, " trash ": 4.0, " lowei": 3.0})
    a = lexicon.automaton()
    hit = lambda t: lexicon.measures(a, t)[0]
    assert hit("an IDIOT!") == hit("an 1d10t") == hit("an іdіоt") == hit("an id­iot") == 5.0
    assert hit("idiotic") == hit("") == hit(None) == 0.0
    assert hit("in the trash can") == 0.0 and hit("you trash") == 4.0 and hit("loweient") == 3.0
    assert lexicon.measures(a, "trash " + "word " * 400)[1] < lexicon.measures(a, "trash")[1]


def test_toxicity_typographic_signs():
    lexicon = toxicity.Lexicon({" idiot ": 5.0, " lowei": 3.0})
    a = lexicon.automaton()
    hit = lambda t: lexicon.measures(a, t)[0]
    assert [hit(t) for t in ("an “idiot”", "«idiot»", "idiot—you", "so–idiot…", "an\u3000idiot。", "¿idiot?", "‘1d10t’", "id\u00adiot’s")] == [5.0] * 8
    assert hit("“loweient”") == 3.0 and hit("“idiotic”") == 0.0


def measured_by_hand(lexicon, text):
    """The measures by looking for every entry and phrase at every place."""
    folded = toxicity.fold(text)
    places = lambda e: [i for i in range(len(folded)) if folded.startswith(e, i)]
    excused = [(i, i + len(e) - 1) for p in lexicon.exceptions for e in [f" {' '.join(toxicity.fold(p).split())} "] for i in places(e)]
    hits = {}
    for e, w in lexicon.weights.items():
        for i in places(e):
            if not any(a <= i < b for a, b in excused):
                hits[i] = max(w, hits.get(i, 0.0))
    if not hits:
        return 0.0, 0.0, 0
    return max(hits.values()), sum(sorted(hits.values())) * 100 / max(100, len(folded.split())), len(hits)


def test_toxicity_matcher_by_hand():
    rng = np.random.default_rng(2)
    words = ["ab", "abab", "ababab", "ba", "bab", "trash", "can", "b4b", "aЬ", "аb"]
    lexicon = toxicity.Lexicon({" ab ": 1.0, " abab": 2.5, " bab ": 3.0, " b": 0.5, " trash ": 4.0, " can ": 1.5}, ("trash can", "bab ab", "ab abab ab", "can"))
    a = lexicon.automaton()
    for _ in range(400):
        text = rng.choice([" ", "—", "! "]).join(rng.choice(words, rng.integers(0, 150)))
        assert lexicon.measures(a, text) == measured_by_hand(lexicon, text)


def test_toxicity_long_excused_text():
    lexicon = toxicity.Lexicon({" trash ": 4.0, " can ": 2.0})
    a, began = lexicon.automaton(), time.process_time()
    assert lexicon.measures(a, "trash can " * 100_000) == (0.0, 0.0, 0)
    assert time.process_time() - began < 1.5


def test_toxicity_learns_exceptions(spark):
    rows = [(f"you moron {i}", 1) for i in range(60)] + [(f"the moron fish swims {i}", 0) for i in range(10)] + [(f"a fine day {i}", 0) for i in range(400)]
    lexicon = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, label int"))
    assert " moron " in lexicon.weights and {"moron fish", "the moron"} <= set(lexicon.exceptions) and "you moron" not in lexicon.exceptions
    a = lexicon.automaton()
    assert lexicon.measures(a, "such a moron")[2] == 1 and lexicon.measures(a, "one moron fish")[2] == 0


def test_toxicity_awkward(spark, awkward, empty):
    rows = spark.createDataFrame([("you idiot", 1), ("fine day", 0), (None, 0), ("", 1), ("x", None)] * 10, "text string, label int")
    model = toxicity.fit(rows)
    done = toxicity.score(awkward, model)
    assert done.count() == awkward.count() and done.where("score is null or predicted is null").count() == 0
    assert toxicity.score(empty, model).count() == 0
    assert toxicity.score(awkward, toxicity.fit(rows.limit(0))).where("score = 0.5").count() == awkward.count()


# 2


def exact_nearest(vectors, ids, queries_, k):
    out = {}
    for q in queries_:
        scores = (vectors * vectors[q]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[q]][:k]
        out[ids[q]] = [(ids[j], scores[j]) for j in order]
    return out


def test_ann_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    x, ids = np.array([r.embedding for r in rows], float), np.array([r.vec_id for r in rows])
    want = exact_nearest(x, ids, np.flatnonzero(ids % 20 == 0), 20)
    got = {}
    for r in queries.op2_ann(spark, sf).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got.keys() == want.keys() and all(len(g) == 20 for g in got.values())
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9


def vectors(kind, n=24_000, d=32):
    rng = np.random.default_rng(11)
    if kind == "uniform":
        x = rng.standard_normal((n, d))
        return x / np.linalg.norm(x, axis=1, keepdims=True)
    centres = rng.standard_normal((150, d))
    x = centres[rng.integers(0, 150, n)] + 0.15 * rng.standard_normal((n, d))
    if kind == "third":
        x[: n // 3] = centres[0] + 0.02 * rng.standard_normal((n // 3, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return x * np.exp(0.5 * rng.standard_normal((n, 1))) if kind == "lengths" else x


@pytest.mark.parametrize("kind, most", [("uniform", 1.0), ("clustered", 0.5), ("lengths", 1.0), ("third", 0.8)])
def test_ann_recall_by_kind(spark, kind, most):
    """Recall against brute force beyond the size of one part, and products per pair no more than brute force's."""
    x = vectors(kind)
    df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(x)), "embedding": list(x)}))
    is_query = F.col("vec_id") % 100 == 0
    rows = ann.usable(df.withColumn("query", is_query), "vec_id", "embedding")
    _, plan = ann.fit(rows, x.shape[1], 20)
    want = exact_nearest(x, np.arange(len(x)), range(0, len(x), 100), 20)
    got = {}
    for r in ann.nearest(df, is_query).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    recall = [len(got[q].keys() & {i for i, _ in want[q]}) / 20 for q in want]
    print(kind, plan.curves, plan.blocks, plan.reach, plan.products(), np.mean(recall), min(recall))
    assert np.mean(recall) >= 0.9 and plan.products() <= most and all(len(g) == 20 for g in got.values())


def test_ann_parts_and_lengths(spark, monkeypatch):
    """Hot blocks cut on both sides, equal vectors, and vectors of several lengths: all as by brute force."""
    monkeypatch.setattr(ann, "PART_ROWS", 40)
    monkeypatch.setattr(ann, "PART_QUERIES", 7)
    rng = np.random.default_rng(1)
    x = [1e6 * rng.standard_normal(5) for _ in range(300)]
    x[:100] = [x[0]] * 100
    y = [rng.standard_normal(3) for _ in range(10)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate([*x, *y])], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 5 == 0, k=7).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = {}
    for vs, first in ((x, 0), (y, 300)):
        ids = np.arange(first, first + len(vs))
        want |= exact_nearest(np.array(vs), ids, [j for j in range(len(vs)) if ids[j] % 5 == 0], 7)
    assert got == want


def test_ann_awkward(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(i, [float(i % 5), 1.0, -1.0]) for i in range(30)] + [(100, None), (101, [0.0, 0.0, 0.0]), (102, [1.0, nan, 0.0]), (103, [1.0, None, 0.0]), (104, [inf, 0.0, 0.0]), (None, [1.0, 1.0, 1.0]), (7, [2.0, 1.0, -1.0]), (105, []), (120, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit("clash")).withColumn("query", F.lit("clash"))
    got = ann.nearest(df, F.col("vec_id") % 20 == 0, k=5).orderBy("rank").collect()
    assert [r.vec_id for r in got if r.query_id == 20] == [0, 1, 2, 3, 4] and [r.score for r in got if r.query_id == 20] == [2.0] * 5
    assert {r.query_id for r in got} == {0, 20}
    few = ann.nearest(df.where("vec_id < 4"), F.col("vec_id") == 0, k=20)
    assert [(r.rank, r.vec_id) for r in few.orderBy("rank").collect()] == [(1, 1), (2, 2), (3, 3)]
    assert ann.nearest(df.limit(0), F.lit(True)).count() == 0


def test_hilbert_curve_is_continuous():
    for d, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * d, indexing="ij"), -1).reshape(-1, d)
        keys = ann.hilbert_keys(grid, bits)
        assert sorted(keys) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


# 3


def judged_by_hand(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), a, h + p) for a, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_urls(spark, sf):
    extra = [None, "", "no scheme", "http://", "HTTP://EXAMPLE.NET", "x://A.example.net/en/q?x://y", "a://b.Example.com/de/", "a://notnet/", "a://sub.net/", "http://é.ORG/fr/#x://"]
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").union(spark.createDataFrame([(1000 + i, u) for i, u in enumerate(extra)] * 2, "page_id long, url string"))
    mined = url_filter.mine(spark.createDataFrame([], "url string, bad boolean"))
    rows = url_filter.judge(pages.withColumn("host", F.lit("clash")), mined).collect()
    assert len(rows) == pages.count()
    for r in rows:
        host, path, action, rule = judged_by_hand(r.url)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, action or "allow")
    assert len(queries.op3_urls(spark, sf).collect()) == spark.read.parquet(f"{sf}/pages.parquet").count()


def rules_by_hand(rows, support, odds):
    """All token combinations of labelled urls, counted one by one."""
    baskets = [(sorted(t), bad) for t, bad in rows if t and bad is not None]
    n, bad = len(baskets), sum(b for _, b in baskets)
    share = bad * odds / (bad * odds + n - bad)
    freq, wrong = Counter(), Counter()
    for t, b in baskets:
        for k in range(1, url_filter.MOST_TOKENS + 1):
            for c in itertools.combinations(t, k):
                freq[c] += 1
                wrong[c] += b
    rules = {c: (wrong[c] / f, f) for c, f in freq.items() if f >= support and wrong[c] / f >= share}
    return {c: r for c, r in rules.items() if not any(set(d) < set(c) and rules[d][0] >= r[0] for d in rules)}, freq


@pytest.mark.parametrize("broadcast", [50_000, 0])
@pytest.mark.parametrize("times", [1, 20])
def test_urls_mined_by_hand(spark, monkeypatch, broadcast, times):
    """Rules and verdicts as by counting every combination, whatever the size of the table, by broadcast and by shuffle."""
    monkeypatch.setattr(url_filter, "BROADCAST_RULES", broadcast)
    rng = np.random.default_rng(4)
    hosts, parts, keys = [f"h{i}.example.com" for i in range(12)], ["buy", "en", "de", "win", "7"], ["id", "ref", "page"]
    urls = [f"http://{rng.choice(hosts)}/{rng.choice(parts)}/{rng.choice(parts)}?{rng.choice(keys)}={i}" for i in range(500)]
    labels = [bool(rng.random() < (0.9 if "win" in u and "h1." in u else 0.5 if "h3." in u else 0.05)) for u in urls]
    rare = [(f"http://casino.example.org/{i}", True) for i in range(26)]
    rows = [*zip(urls, labels), *rare, *[(f"http://fine.example.org/{i}", False) for i in range(500 * (times - 1))], (None, True), ("", False), ("http://h1.example.com/win", None)]
    df = spark.createDataFrame(rows, "url string, bad boolean")
    tokens = [(r.t, r.bad) for r in df.select(url_filter.tokens(F.col("url")).alias("t"), "bad").collect()]
    want, freq = rules_by_hand(tokens, url_filter.SUPPORT, url_filter.ODDS)
    mined = url_filter.mine(df)
    got = {tuple(r.tokens): r for r in mined.collect()}
    assert {c: (round(r.confidence, 9), r.support) for c, r in got.items()} == {c: (round(x, 9), f) for c, (x, f) in want.items()}
    assert any("h:casino" in c for c in got) and len(got) > 2  # a small bad host is found in small and large tables
    assert all(freq[(r.key,)] == min(freq[(x,)] for x in c) for c, r in got.items())
    pages = df.withColumn("confidence", F.lit("clash")).withColumn("verdict", F.lit("clash"))
    judged = url_filter.judge(pages, mined, rules=()).collect()
    assert len(judged) == len(rows)
    by_url = {}
    for r, (t, _) in zip(df.collect(), tokens):
        by_url[r.url] = max([x for c, (x, _) in want.items() if set(c) <= set(t)], default=None)
    for r in judged:
        x = by_url[r.url]
        assert r.verdict == ("allow" if x is None else "block") and (x is None or abs(r.confidence - x) < 1e-9)


def test_urls_of_one_kind_teach_nothing(spark):
    for bad in (True, False):
        assert url_filter.mine(spark.createDataFrame([(f"http://a.example.com/{i}", bad) for i in range(60)], "url string, bad boolean")).count() == 0


def test_urls_mined(spark):
    bad = [(f"http://cheap-pills.example.com/buy/{i}", True) for i in range(60)]
    good = [(f"http://www.example.com/buy/{i}", i % 10 == 0) for i in range(300)] + [(f"http://cheap-pills.example.com/about/{i}", True) for i in range(30)] + [(None, True), ("x", None)]
    mined = url_filter.mine(spark.createDataFrame(bad + good, "url string, bad boolean"))
    rules = {tuple(r.tokens): r for r in mined.collect()}
    assert ("h:cheap-pills",) in rules and rules[("h:cheap-pills",)].confidence == 1.0 and rules[("h:cheap-pills",)].support == 90
    df = spark.createDataFrame([(1, "http://cheap-pills.example.com/x"), (2, "http://www.example.com/buy/1"), (3, None)], "page_id long, url string")
    assert {r.page_id: r.verdict for r in url_filter.judge(df, mined).collect()} == {1: "block", 2: "allow", 3: "allow"}
    assert url_filter.judge(df.limit(0), mined).count() == 0


def test_urls_of_forty_tokens(spark):
    """A long url that is repeated as it stands gives no combinations; varied ones are counted exactly, and in seconds."""
    keys = [f"k{i:02}" for i in range(46)]
    long_url = "http://ads.example.org/track?" + "&".join(f"{k}=1" for k in keys[:40])
    rng = np.random.default_rng(4)
    varied = [("http://x.example.org/?" + "&".join(f"{k}=1" for k in rng.permutation(keys[:14])[:9]), bool(i % 3)) for i in range(90)]
    rows = [(long_url, True)] * 60 + varied + [(f"http://good.example.org/{k}", False) for k in keys] * 8
    df = spark.createDataFrame(rows, "url string, bad boolean")
    began = time.time()
    mined = {tuple(r.tokens): (round(r.confidence, 9), r.support) for r in url_filter.mine(df).collect()}
    assert time.time() - began < 150
    tokens = [(r.t, r.bad) for r in df.select(url_filter.tokens(F.col("url")).alias("t"), "bad").collect()]
    counts = Counter()
    for t, bad in tokens:
        if len(t) < 20:
            counts.update((c, bad) for k in range(1, 5) for c in itertools.combinations(sorted(t), k))
    held = {c: (counts[c, True], counts[c, True] + counts[c, False]) for c, _ in counts}
    for c, (confidence, support) in mined.items():
        of_long = 60 * set(c).issubset(tokens[0][0])
        bad, freq = held.get(c, (0, 0))
        assert (confidence, support) == (round((bad + of_long) / (freq + of_long), 9), freq + of_long)
    alone = {c for c in mined if set(c) <= {"h:ads", *(f"q:{k}" for k in keys[14:40])}}
    assert alone == {("h:ads",), *((f"q:{k}",) for k in keys[14:40])}


def test_toxicity_folds_styles_and_accents():
    """Styled capitals, accents as one character or two, and look-alikes all reach the entry."""
    lexicon = toxicity.Lexicon({" idiot ": 5.0})
    automaton = lexicon.automaton()
    for text in ("you 𝐈𝐃𝐈𝐎𝐓", "you 𝐢𝐝𝐢𝐨𝐭", "you ídiot", "you ídiot", "you ＩＤＩＯＴ", "you İDIOT", "you 1d1øt".replace("ø", "0"), "you Ⓘⓓⓘⓞⓣ"):
        assert lexicon.measures(automaton, text)[0] == 5.0, text
    assert lexicon.measures(automaton, "you idiøt")[0] == 0.0


def test_bpe_forgets_long_words(vocabulary, library):
    """Words of many letters, as base64 or minified pages hold, are encoded as ever and leave nothing in memory."""
    rng = np.random.default_rng(2)
    texts = [" ".join("".join(rng.choice(list("abcdefgh0123"), 3000)) for _ in range(20)) for _ in range(3)] + ["a plain text", "x" * 1_000_000]
    model = bpe.Model(vocabulary.spec.value)
    packed = list(model.encode(texts))
    for text, ids in zip(texts[:4], packed):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert max(map(len, model.memory)) <= bpe.MEMORY_LETTERS and "plain" in model.memory
    assert list(model.encode(texts[:2])) == packed[:2]


def test_bpe_models_leave_workers(spark, vocabulary):
    """Python workers are used again by other stages; there they hold neither a vocabulary nor its words any more."""

    def holding(batches):
        gc.collect()
        held = sum(type(x) is bpe.Model for x in gc.get_objects())
        for pdf in batches:
            yield pd.DataFrame({"held": [held] * len(pdf)})

    texts = spark.range(0, 400, 1, 8).selectExpr("concat('some words of ', id) text")
    assert bpe.encode(texts, vocabulary).where("n_tokens < 4").count() == 0
    assert spark.range(0, 400, 1, 8).mapInPandas(holding, "held long").where("held > 0").count() == 0


def test_bpe_driver_makes_no_model(spark, monkeypatch):
    """A model is some 50 MB, and the driver has no use for it."""
    monkeypatch.setattr(bpe, "Model", None)  # here; workers have their own
    texts = spark.range(0, 40, 1, 4).selectExpr("concat('some words of ', id) text")
    assert bpe.encode(texts, bpe.Vocabulary(spark, queries.vocabulary_path())).where("n_tokens < 4").count() == 0


def test_memory_is_given_back():
    """Freed blocks below one that is still held go back to the system too."""

    def own():
        with open("/proc/self/smaps_rollup") as f:
            return next(int(x.split()[1]) for x in f if x.startswith("Pss_Anon")) // 1024

    give_back()
    before = own()
    blocks = [np.ones(60_000, np.uint8) for _ in range(2_000)]
    last = blocks.pop()
    assert own() > before + 90
    del blocks
    assert give_back("a result") == "a result" and own() < before + 30 and len(last)


def test_ann_windows_in_small_tables(spark):
    """Windows follow from the data at any size: a small table of tight clusters isn't looked through as a whole."""
    rng = np.random.default_rng(12)
    centres = rng.standard_normal((60, 16))
    x = centres[rng.integers(0, 60, 6000)] + 0.05 * rng.standard_normal((6000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(x)), "embedding": list(x)}))
    is_query = F.col("vec_id") % 20 == 0
    _, plan = ann.fit(ann.usable(df.withColumn("query", is_query), "vec_id", "embedding"), 16, 20)
    want = exact_nearest(x, np.arange(len(x)), range(0, len(x), 20), 20)
    got = {}
    for r in ann.nearest(df, is_query).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    recall = np.mean([len(got[q] & {i for i, _ in want[q]}) / 20 for q in want])
    print(plan.curves, plan.blocks, plan.reach, plan.products(), recall)
    assert plan.products() < ann.WHOLE and recall >= 0.9 and all(len(g) == 20 for g in got.values())


def test_sharding_bids_by_hand(spark, sf):
    """Every bid recomputed: the key's hash seeds the shard's, and the least exponential variate at the shard's weight wins."""

    def owner(key, shards):
        h = xxhash.xxh64_intdigest(("null" if key is None else f"k{key}").encode(), seed=42)
        bids = []
        for name, weight in shards.items():
            unit = ((xxhash.xxh64_intdigest(f"shard {name}".encode(), seed=h) >> 11) + 0.5) / (1 << 53)
            bids.append((-np.log(unit) / weight, name))
        return min(bids)[1]

    even, grown = sharding.equal_shards(queries.SHARDS), sharding.equal_shards(queries.SHARDS + 1)
    for r in queries.op6_sharding(spark, sf).collect():
        assert (r.shard, r.grown_shard) == (owner(r.doc_id, even), owner(r.doc_id, grown))
    weights = {0: 1.0, 1: 5.0, 2: 0.25}
    df = spark.createDataFrame([(i,) for i in [*range(500), None]], "doc_id long")
    assert all(r.shard == owner(r.doc_id, weights) for r in sharding.shard(df, "doc_id", weights).collect())


def test_substring_dedup_of_a_text_over_ten_megabytes(spark):
    """A text of 1.6 million words is one batch: the passage that it shares with a short one goes, nothing else does."""
    passage = " ".join(f"shared{i}" for i in range(40))
    long = " ".join(f"w{i}x" for i in range(1_600_000))
    texts = [f"{long} {passage} end", f"start {passage}", "plain words " * 10]
    assert len(texts[0]) > 10_000_000
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, len(r.text)) for r in substring_dedup.remove_repeats(df).collect()}
    assert got == {0: (1_600_041, 40, len(f"{long} end")), 1: (41, 40, 5), 2: (20, 0, len("plain words " * 10) - 1)}
