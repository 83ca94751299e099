"""Exact deduplication against brute force."""

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from apsis.llm import exact_dedup, queries

LONG = "lorem ipsum dolor " * 20_000


def brute(rows):
    """doc_id -> (keep_id, group_size, sha) for rows of distinct ids."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    return {i: (min(ids), len(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for i in ids}


@pytest.mark.parametrize("parts,fan_in", [(1, 16), (13, 2), (40, 4)])
def test_exact_dedup_against_brute_force(spark, parts, fan_in):
    """A third of the rows share one text; white space differs between copies; runs meet in several rounds."""
    texts = ["hot  text" if i % 3 == 0 else f"text {i % 50}" + " \t"[i % 2] + "end" for i in range(600)]
    texts += ["", None, " ", "\n\t", LONG, LONG + "x", LONG.replace(" ", "\t"), " lead", "lead", "café", "café", "a b", "a b"]
    rows = [(1000 - i, t) for i, t in enumerate(texts)]
    found = exact_dedup.mark(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts), fan_in=fan_in).collect()
    want = brute(rows)
    assert len(found) == len(rows)
    assert {r.doc_id: (r.keep_id, r.group_size, r.text_sha256) for r in found} == want
    assert all(r.kept == (r.doc_id == want[r.doc_id][0]) for r in found)


def test_exact_dedup_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found = queries.op12_exact_dedup(spark, sf).collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.text_sha256) for r in found} == brute(docs)


def test_exact_dedup_of_awkward_rows(spark):
    """Null ids, repeated rows, ties, columns named like results or the operator's own, and no rows at all."""
    schema = "doc_id long, text string, id string, at string, run string, digest string, kept string, keep_id string, n string"
    rows = [(5, "a", "x"), (5, "a", "x"), (None, "a", "y"), (None, None, None), (None, "", None), (2, "b", "z"), (None, "b", "z"), (7, "c", None)]
    df = spark.createDataFrame([(i, t, c, c, c, c, c, c, c) for i, t, c in rows], schema)
    found = exact_dedup.mark(df).collect()
    assert sorted((str(r.doc_id), r.group_size, r.kept, str(r.keep_id)) for r in found) == sorted(
        [("5", 3, True, "5"), ("5", 3, False, "5"), ("None", 3, False, "5"), ("None", 2, True, "None"), ("None", 2, False, "None"), ("2", 2, True, "2"), ("None", 2, False, "2"), ("7", 1, True, "7")]
    )
    kept = exact_dedup.unique(df)
    assert kept.columns == df.columns
    assert sorted((str(r.doc_id), r.text or "") for r in kept.collect()) == [("2", "b"), ("5", "a"), ("7", "c"), ("None", "")]
    assert exact_dedup.mark(df.limit(0)).collect() == [] and exact_dedup.unique(df.limit(0)).collect() == []


def test_exact_dedup_runs_no_python(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a")], "doc_id long, text string").withColumn("text", F.upper("text"))
    plan = exact_dedup.mark(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
