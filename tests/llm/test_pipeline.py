"""The pipeline's stages, each against a brute-force version over what its predecessor kept, and on awkward rows."""

import re

import duckdb
import numpy as np
import pytest
from test_llm_operators import classes, repeats  # the brute-force versions beside this file

import corpus_pipeline as pipeline
from apsis.llm import queries, simhash
from apsis.llm.common import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf):
    """The table before the first stage and after each."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for _, stage in pipeline.STAGES:
        out.append(written(stage(spark, out[-1], sf)))
    return out


def rows(df):
    return df.collect()


def test_names_and_columns(stages):
    assert [n for n, _ in pipeline.STAGES] == ["quality", "near_duplicates", "substrings", "decontamination", "bpe"]
    assert all(df.columns == COLUMNS for df in stages[:-1])


def test_quality_stage(stages, sf):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    keep = {i for (i,) in con.execute(f"select doc_id from ({queries.SQL['op1_quality']}) where keep").fetchall()}
    assert {r.doc_id for r in rows(stages[1])} == keep and len(keep) < stages[0].count()


def shingles(text):
    ws = text.lower().split()
    return {tuple(ws[i : i + pipeline.SHINGLE]) for i in range(max(1, len(ws) - pipeline.SHINGLE + 1))}


def jaccard(a, b):
    return len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))


def test_near_duplicate_stage_is_exact(stages):
    """The stage against the Jaccard similarity of all pairs, not against fingerprints."""
    docs = rows(stages[1])
    found = classes([shingles(r.text or "") for r in docs], lambda a, b: len(a & b) >= pipeline.SIMILAR * len(a | b))
    assert {r.doc_id for r in rows(stages[2])} == {docs[i].doc_id for i in set(found)}


@pytest.mark.parametrize("chunk", [1 << 20, 3000])
def test_near_duplicates_at_exact_similarity(spark, sf, monkeypatch, chunk):
    """Pairs made over 0.6 to 1.0, and a chain whose ends are apart: links at 0.8 and above, none below."""
    monkeypatch.setattr(simhash, "CHUNK_SHINGLES", chunk)
    rng = np.random.default_rng(5)
    new = lambda n: [f"w{x}" for x in rng.integers(0, 10**9, n)]
    pairs = []
    for k in range(800):
        a = new(int(rng.integers(64, 600)))
        share = 0.6 + 0.4 * k / 800
        b = list(a)
        b[int(len(a) * 2 * share / (1 + share)) :] = []
        b += new(len(a) - len(b))
        pairs.append((" ".join(a), " ".join(b)))
    base = new(400)
    chain = [" ".join(base[30 * i : 30 * i + 300]) for i in range(4)]  # neighbours at about 0.82
    loose = [" ".join([*"the same words again and again ".split() * 300, *new(n)]) for n in (40, 40)]  # repeats make them close in bits only
    texts = [t for p in pairs for t in p] + chain + loose + ["", "", "one two", "one two"]
    docs = spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in pipeline.without_near_duplicates(spark, written(docs.coalesce(1)), sf).collect()}
    values = [jaccard(a, b) for a, b in pairs]
    linked = [2 * i + 1 not in kept or 2 * i not in kept for i in range(len(pairs))]
    bands = {lo: [x for v, x in zip(values, linked) if lo <= v < lo + 0.05] for lo in (0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95)}
    print({lo: (sum(x), len(x)) for lo, x in bands.items()})
    assert not any(x for v, x in zip(values, linked) if v < 0.8)
    assert all(sum(x) >= 0.97 * len(x) for lo, x in bands.items() if lo >= 0.8)
    n = 2 * len(pairs)
    assert len({n, n + 1, n + 2, n + 3} & kept) == 1 and {n + 4, n + 5} <= kept
    assert len({n + 6, n + 7} & kept) == 1 and len({n + 8, n + 9} & kept) == 1


def test_near_duplicates_of_short_texts(spark, sf):
    """Texts of 9 to 40 words with one or two words changed at the ends: recall at 0.8 and above, no false link."""
    rng = np.random.default_rng(6)
    texts = []
    for _ in range(600):
        a = [f"w{x}" for x in rng.integers(0, 10**9, rng.integers(9, 41))]
        b = [*a[int(rng.integers(0, 2)) :], "end"] if rng.random() < 0.5 else a[: -int(rng.integers(1, 3))]
        texts += [" ".join(a), " ".join(b)]
    docs = spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in pipeline.without_near_duplicates(spark, written(docs.coalesce(1)), sf).collect()}
    pairs = [(jaccard(*texts[i : i + 2]), not {i, i + 1} <= kept) for i in range(0, len(texts), 2)]
    near = [x for v, x in pairs if v >= 0.8]
    assert len(near) > 100 and np.mean(near) >= 0.97 and not any(x for v, x in pairs if v < 0.8)


def test_near_duplicates_in_hot_buckets(spark, sf, monkeypatch):
    """A large group of near copies, cut into chunks, beside small ones: one of each stays."""
    monkeypatch.setattr(simhash, "CHUNK", 100)
    monkeypatch.setattr("apsis.llm.common.HOT_ROWS", 50)
    rng = np.random.default_rng(7)
    base = [f"w{x}" for x in rng.integers(0, 10**9, 300)]
    texts = [" ".join([*base[:k], f"x{k}", *base[k + 1 :]]) for k in range(300)]
    texts += [" ".join(base)] * 120
    texts += [" ".join(f"w{x}" for x in rng.integers(0, 10**9, 50)) for _ in range(200)]
    docs = spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in pipeline.without_near_duplicates(spark, written(docs.coalesce(1)), sf).collect()}
    assert kept == {0, *range(420, 620)}


def test_substring_stage(stages):
    docs = rows(stages[2])
    want = {r.doc_id: t for r, (_, gone, t) in zip(docs, repeats([r.text for r in docs], 35))}
    got = {r.doc_id: r for r in rows(stages[3])}
    assert {i: r.text for i, r in got.items()} == want and all(r.n_chars == len(r.text) for r in got.values())


def test_decontamination_stage(stages, spark, sf):
    plain = lambda t: " ".join(re.sub(r"[^\w\s]", "", (t or "").lower()).split())
    items = [plain(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = {r.doc_id for r in rows(stages[3]) if not any(f" {x} " in f" {plain(r.text)} " for x in items)}
    assert {r.doc_id for r in rows(stages[4])} == want


def test_encoding_stage(stages):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.vocabulary_path())
    texts = {r.doc_id: r.text for r in rows(stages[4])}
    done = rows(stages[5])
    assert len(done) == len(texts)
    for r in done:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == ids and r.decoded == library.decode(ids, skip_special_tokens=False)


def test_awkward_rows(spark, sf):
    long = "lorem ipsum dolor sit amet " * 4000
    given = [(1, "", "en", "src0", 0), (2, None, None, None, None), (None, "some fine words here, as usual.", "en", "src0", 1), (3, long, "en", "src1", 5), (3, long, "en", "src1", 5), (4, "some fine words here, as usual.", "de", None, 1)]
    docs = spark.createDataFrame(given, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in pipeline.STAGES:
        for start in (docs, docs.limit(0)):
            done = written(stage(spark, written(start), sf))
            assert done.count() <= start.count() and "doc_id" in done.columns
