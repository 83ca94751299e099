"""JSON arrays cut at braces, against the reader that takes a file whole."""

import json
import random

import pytest

from apsis.sources.json_arrays import json_records, read_json_arrays

SCHEMA = "id long, text string, inner struct<a: long, b: array<struct<c: string>>>"


def objects(n, seed):
    rng = random.Random(seed)
    texts = ["plain", "}", "{", '"}', "\\", "\\\\}", '\\"}{', "},{", "]}", "[{", "äß}€", "line\nbreak}", "", None, '"id": 7}, {"id": 8']
    for i in range(n):
        yield {"id": i, "text": rng.choice(texts), "inner": rng.choice([None, {}, {"a": i, "b": []}, {"a": None, "b": [{"c": rng.choice(texts)}, {"c": "x"}]}])}


@pytest.mark.parametrize("indent", [None, 1])
def test_same_rows_as_whole_files(spark, tmp_path, indent):
    """Three files of braces in strings, escapes and nested objects, in splits of 2 kB."""
    for i, n in enumerate((400, 0, 1)):
        (tmp_path / f"{i}.json").write_text(json.dumps(list(objects(n, i)), indent=indent, ensure_ascii=bool(i)))
    want = sorted(spark.read.option("multiLine", True).schema(SCHEMA).json(str(tmp_path)).collect(), key=str)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 10
        assert sorted(read_json_arrays(spark, str(tmp_path), SCHEMA, chunks=9).collect(), key=str) == want and len(want) == 401
        numbers = [r._n for r in json_records(spark, str(tmp_path / "0.json"), 5).collect()]
        assert sorted(numbers) == list(range(400))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_odd_files(spark, tmp_path):
    """No array around the objects, an object left open, elements that are none, and an empty file."""
    (tmp_path / "a.json").write_text('{"id": 1}\n{"id": 2},{"id": 3, "text": "}')
    (tmp_path / "b.json").write_text('[1, "x", {"id": 4}, null, {"id": "no number"}]')
    (tmp_path / "c.json").write_text("")
    assert sorted(str(r.id) for r in read_json_arrays(spark, str(tmp_path), SCHEMA).collect()) == ["1", "2", "4", "None"]
