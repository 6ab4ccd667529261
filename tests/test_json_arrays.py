import inspect
import json
import random

import pytest

from promptmill.plans.queries_sources import _write_json_arrays
from promptmill.sources import io, json_arrays


def some(seed, n):
    r = random.Random(seed)
    texts = ["", "a", "}", "{", '\\"', "\\\\", '"', "\\", "[1]", "]}", ", {", "é🙂", "line\nend", '\\"}', "x" * 50, '\\\\\\"']
    return [{"id": i, "text": "".join(r.choices(texts, k=r.randrange(6))), "nested": {"a": [r.randrange(9)] * r.randrange(3), "b": {"c}": r.choice(texts)}},
             "list": [{"k": r.choice(texts)} for _ in range(r.randrange(3))], "none": None} for i in range(n)]


@pytest.fixture(params=["64m", "400", "37", "7"])
def splits(spark, request):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield request.param
    for k, v in old.items():
        spark.conf.set(k, v)


def test_records_equal_the_parser(spark, tmp_path, splits):
    n = 3 if splits == "7" else 40
    forms = {"a": {}, "b": {"indent": 2}, "c": {"ensure_ascii": False, "separators": (",", ":")}}
    for name, form in forms.items():
        (tmp_path / f"{name}.json").write_text(" \n" * 3 + json.dumps(some(ord(name), n), **form) + "\n ", encoding="utf-8")
    (tmp_path / "empty.json").write_text(" [ ] ")
    got = json_arrays.record_texts(spark, str(tmp_path)).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.file, r.number)):
        by.setdefault(r.file.rsplit("/", 1)[1][0], []).append(json.loads(r.record))
    assert by == {name: some(ord(name), n) for name in forms}
    if splits == "37":
        assert json_arrays.pieces(spark, str(tmp_path)).rdd.getNumPartitions() > 20


def test_broken_arrays_are_errors(spark, tmp_path):
    for k, text in enumerate(['[{"a": 1}', '[{"a": 1}, 2]', '[{"a": 1}] x', '[{"a": 1} {"a": 2}]', '[1, 2]', '[{"a": "}]', '[{"a": 1}]]', '[{"a": 1}}]']):
        path = tmp_path / f"{k}.json"
        path.write_text(text)
        with pytest.raises(Exception, match="no array of objects"):
            json_arrays.record_texts(spark, str(path)).collect()


def test_mixed_folder_and_conversion(spark, tmp_path):
    rows = some(5, 30)
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text(json.dumps(rows[:10], indent=1))
    (tmp_path / "in/b.json").write_text("\n".join(map(json.dumps, rows[10:20])))
    (tmp_path / "in/c.json").write_text(json.dumps(rows[20], indent=3))
    (tmp_path / "in/d.json").write_text("")
    schema = "id long, text string"
    want = sorted((r["id"], r["text"]) for r in rows[:21])
    assert sorted(map(tuple, io.read_json(spark, str(tmp_path / "in"), schema).collect())) == want
    (tmp_path / "in/c.json").unlink()
    assert sorted((r.id, r.text) for r in io.read_json(spark, str(tmp_path / "in")).collect()) == want[:20]
    io.json_array_to_lines(spark, str(tmp_path / "in/a.json"), str(tmp_path / "lines"))
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "lines")).collect()]
    assert sorted(lines, key=lambda x: x["id"]) == rows[:10]


def test_arrays_are_written_a_few_rows_at_a_time(spark, tmp_path):
    rows = spark.range(1200).selectExpr("id as doc_id", "if(id % 3 = 0, null, concat('é} \\n ,', id)) as text")
    for parts, n in ((1, 0), (1, 1), (3, 2), (2, 1200)):
        part = rows.limit(n).repartition(parts)
        _write_json_arrays(part, str(tmp_path / f"{parts}-{n}"))
        found = [x for f in (tmp_path / f"{parts}-{n}").glob("part-*") if f.stat().st_size for x in json.loads(f.read_text(encoding="utf-8"))]
        assert sorted((x["doc_id"], x.get("text")) for x in found) == sorted(map(tuple, part.collect()))
        read = json_arrays.read_arrays(spark, str(tmp_path / f"{parts}-{n}"), "doc_id long, text string")
        assert sorted(map(tuple, read.collect())) == sorted(map(tuple, part.collect()))
    # texts stay Arrow data, no Python string for every record
    assert "to_pylist" not in inspect.getsource(_write_json_arrays) and "pd." not in inspect.getsource(_write_json_arrays)
