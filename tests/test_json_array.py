"""JSON array files by byte ranges against Python's parser."""

import json
import random

import pytest

from qaspark.plans import q_io
from qaspark.sources import io, json_array
from qaspark.sources.json_array import _pieces, read_json_array_ranges

SCHEMA = "id bigint, s string, o struct<a: string, b: array<struct<c: bigint>>>, l array<string>"


def _rows(rng, n):
    bits = ['}', '{', '"', "\\", "[", "]", ",", " ", "\n", "é", "x", '\\"', "}]", "\\\\"]
    text = lambda: "".join(rng.choice(bits) for _ in range(rng.randrange(0, 30)))
    return [{"id": i, "s": text(), "o": rng.choice([None, {"a": text(), "b": [{"c": 1}, {"c": i}]}]), "l": rng.choice([[], [text(), "}"]])} for i in range(n)]


@pytest.fixture
def small_ranges(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_array_files_equal_the_parser(spark, tmp_path, small_ranges):
    rng = random.Random(2)
    files = {"a": _rows(rng, 30), "b": _rows(rng, 25), "empty": [], "one": _rows(rng, 1)[0]}
    for k, (name, rows) in enumerate(files.items()):
        (tmp_path / f"{name}.json").write_text(json.dumps(rows, indent=[None, 2][k % 2], ensure_ascii=bool(k % 2)), encoding="utf-8")
    want = [r for rows in files.values() for r in (rows if isinstance(rows, list) else [rows])]
    path = str(tmp_path)
    assert _pieces(spark, path + "/a.json").rdd.getNumPartitions() > 4
    got = [json.loads(r.j) for r in read_json_array_ranges(spark, path, SCHEMA).selectExpr("to_json(struct(*), map('ignoreNullFields', 'false')) as j").collect()]
    key = lambda r: json.dumps(r, sort_keys=True)
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_other_elements_and_cut_files(spark, tmp_path, small_ranges):
    (tmp_path / "x.json").write_text('[1, null, {"id": 1, "s": "a"}, [2], {"id": 2, "s": "b"}, {"id": 3, "s": "c')
    rows = read_json_array_ranges(spark, str(tmp_path), "id bigint, s string").collect()
    assert sorted(tuple(r) for r in rows) == [(1, "a"), (2, "b")]


def test_rows_over_chunks(spark, tmp_path, monkeypatch):
    """Strings and nested objects that go on over chunks of one range and over ranges."""
    monkeypatch.setattr(json_array, "CHUNK_POWER", 1)
    rows = _rows(random.Random(3), 40)
    (tmp_path / "a.json").write_text(json.dumps(rows, ensure_ascii=False), encoding="utf-8")
    key = lambda r: json.dumps(r, sort_keys=True)
    for size in ("1000000", "700"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            pieces = _pieces(spark, str(tmp_path))
            assert pieces.groupBy("_file", "_start", "_chunk").count().agg({"count": "max"}).first()[0] <= 2
            got = read_json_array_ranges(spark, str(tmp_path), SCHEMA).selectExpr("to_json(struct(*), map('ignoreNullFields', 'false')) as j").collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert sorted(key(json.loads(r.j)) for r in got) == sorted(map(key, rows))


def test_no_file_grows_with_the_table(spark, tmp_path, monkeypatch):
    """A file is written by one task, so a larger table gets more files of the same size."""
    monkeypatch.setattr(io, "ARRAY_FILE_BYTES", 5000)
    sizes = {}
    for n in (40, 400):
        folder = tmp_path / str(n)
        rows = [(i, None if i == 3 else f's"{i}', "{" * (i % 7) + "text " * 10, i, "en") for i in range(n)]
        spark.createDataFrame(rows, "doc_id long, source string, text string, n_chars long, lang string").write.parquet(f"{folder}/documents.parquet")
        monkeypatch.setattr(q_io, "scratch_path", lambda _, name, folder=folder: f"{folder}/{name}")
        got = q_io.read_json_array_ranges(spark, str(folder)).collect()
        assert sorted(tuple(r) for r in got) == sorted((i, s, '"}, {[' + t + '\\" }]', k, "}", lang) for i, s, t, k, lang in rows)
        files = sorted((folder / "json-array").glob("part-*"))
        assert sum(len(json.loads(f.read_text())) for f in files) == n
        sizes[n] = [f.stat().st_size for f in files]
    assert max(sizes[40] + sizes[400]) < 1.5 * 5000 and len(sizes[400]) > 5 * len(sizes[40])
