from __future__ import annotations

import json
import random

import pytest

from matchday.sources.arrays import array_records
from matchday.sources.landing import NO_ARRAY, NOT_JSON


@pytest.fixture
def small_splits(spark):
    """Splits of 2000 bytes, so that small files are read by many tasks."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for key, value in held.items():
        spark.conf.set(key, value)


def awkward(rnd, depth=0):
    kind = rnd.random()
    if kind < 0.2:
        return rnd.choice([None, True, 7, 1.5])
    if kind < 0.6 or depth > 2:
        marks = ["{", "}", '"', "\\", ",", "[", "]", "é", "\n", " ", "},{", "x"]
        return "".join(rnd.choice(marks) for _ in range(rnd.randint(0, 8)))
    if kind < 0.8:
        return {rnd.choice(["a", "}", '"{']): awkward(rnd, depth + 1) for _ in range(rnd.randint(0, 3))}
    return [awkward(rnd, depth + 1) for _ in range(rnd.randint(0, 3))]


@pytest.mark.parametrize("indent,ascii_only", [(None, True), (2, False), (None, False)])
def test_records_equal_the_json_parser(spark, small_splits, tmp_path, indent, ascii_only):
    rnd = random.Random(3)
    found = {}
    for name, n in (("large", 500), ("small", 3), ("one", 1), ("none", 0)):
        found[name] = [{"id": i, "v": awkward(rnd), "{w": awkward(rnd)} for i in range(n)]
        (tmp_path / f"{name}.json").write_text(json.dumps(found[name], indent=indent, ensure_ascii=ascii_only) + "\n" * (n % 2))
    out = array_records(spark, str(tmp_path)).collect()
    assert all(r["reason"] is None for r in out)
    for name, records in found.items():
        own = sorted((r for r in out if r["source_path"].endswith(f"/{name}.json")), key=lambda r: r["pos"])
        assert [r["pos"] for r in own] == list(range(len(records)))
        assert [json.loads(r["raw_payload"]) for r in own] == records


def test_one_file_is_many_tasks(spark, small_splits, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": i, "text": "x" * 40} for i in range(1000)]))
    df = spark.read.option("lineSep", "}").text(str(tmp_path))
    assert df.rdd.getNumPartitions() > 20
    assert array_records(spark, str(tmp_path)).count() == 1000


@pytest.mark.parametrize("text,records,reasons", [
    ('[{"a":1},{"b":2', ['{"a":1}'], [NOT_JSON]), ('[{"a":1},{"b":2}', ['{"a":1}', '{"b":2}'], [NOT_JSON]),
    ('[{"a":1},{"b":2}\n', ['{"a":1}', '{"b":2}'], [NOT_JSON]), ('[{"a":1}]]', ['{"a":1}'], [NOT_JSON]),
    ('{"detail":"none"}', [], [NO_ARRAY, NOT_JSON]), ("<html>", [], [NOT_JSON]), ("[1, 2]", [], [NOT_JSON]),
    ('[null, {"a":1}]', [], [NO_ARRAY]), ('[{"a":1} {"b":2}]', ['{"a":1}'], [NO_ARRAY]), ('[{"a":"x', [], [NOT_JSON]),
    ("[]", [], []), (" [ ] ", [], []), ('[{"a":{}}]', ['{"a":{}}'], [])])
def test_what_is_no_array_of_objects(spark, tmp_path, text, records, reasons):
    (tmp_path / "a.json").write_text(text)
    out = sorted(array_records(spark, str(tmp_path)).collect(), key=lambda r: r["pos"])
    assert [r["raw_payload"] for r in out if r["reason"] is None] == records
    assert [r["reason"] for r in out if r["reason"] is not None] == reasons
