"""Files read by many tasks against readers that take a file in one."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tidemill.sources import readers, splitting

SCHEMA = "id BIGINT, name STRING, text STRING"


@pytest.fixture
def small_splits(spark):
    """Splits of a few hundred bytes, one per task."""
    settings = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "300"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def texts(r, n):
    signs = ['"', ",", "\n", "\r\n", "a", "ä", " ", '""', "x\ny", "z"]
    return ["".join(r.choice(signs) for _ in range(r.randrange(0, 30))) for _ in range(n)]


def written(rows, end="\n"):
    quoted = lambda v: '"' + v.replace('"', '""') + '"'
    return "".join(",".join(cells) + end for cells in [("id", '"na\nme"', "text"), *[(str(i), quoted(a), quoted(b)) for i, a, b in rows]])


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_csv_equals_the_whole_file_reader(spark, tmp_path, small_splits, end):
    r = random.Random(2)
    for name in ("a", "b"):
        rows = [(i, a, b) for i, (a, b) in enumerate(zip(texts(r, 200), texts(r, 200)))]
        rows[77] = (77, "long\n" * 600, 'end "quoted"\n\n')
        (tmp_path / f"{name}.csv").write_bytes(written(rows, end).encode())
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text("id,name,text")
    (tmp_path / "open.csv").write_text('id,name,text\n1,"plain","x"\n2,plain,no end')
    found = splitting.read_quoted_csv(spark, str(tmp_path), SCHEMA)
    whole = readers.read_csv(spark, str(tmp_path), SCHEMA, multiline=True)
    assert found.rdd.getNumPartitions() > 40
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, whole.collect())) and found.count() == 402
    if end == "\n":
        assert found.filter("name = repeat('long\n', 600)").count() == 2


def test_csv_plan_reads_what_is_asked(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text(written([(i, "x\ny", "z") for i in range(100)]))
    assert splitting.read_quoted_csv(spark, str(tmp_path), SCHEMA).agg(F.sum("id")).first()[0] == 4950


def records(r, n):
    return [{"id": i, "name": r.choice(['a"b', "x}y", "[{", "\\", '\\"', "ö}", "", "\n"]) * r.randrange(5),
             "images": [f"{{{j}}}" for j in range(r.randrange(4))], "more": {"deep": [{"a": {}}]}} for i in range(n)]


def test_json_arrays_equal_the_whole_file_reader(spark, tmp_path, small_splits):
    r = random.Random(4)
    good = {"one": json.dumps(records(r, 300)), "lines": "[\n" + ",\n".join(map(json.dumps, records(r, 150))) + "\n]\n",
            "indented": json.dumps(records(r, 50), indent=2), "none": " [ ]\n", "wide": json.dumps([{"id": 1, "name": "}" * 4000}, {"id": 2}])}
    schema = "id BIGINT, name STRING, images ARRAY<STRING>"
    for name, text in good.items():
        (tmp_path / f"{name}.json").write_text(text)
    found = splitting.read_json_array(spark, str(tmp_path), schema)
    expected = [x for text in good.values() for x in json.loads(text)]
    assert Counter((x.id, x.name, str(x.images)) for x in found.collect()) == Counter(
        (x["id"], x.get("name"), str(x.get("images"))) for x in expected)
    whole = spark.read.schema(schema).option("multiLine", True).json(str(tmp_path))
    assert Counter(map(str, found.collect())) == Counter(map(str, whole.filter("id IS NOT NULL").collect()))
    assert splitting.chunks(spark, str(tmp_path / "one.json"), "}").rdd.getNumPartitions() > 20


@pytest.mark.parametrize("text", [
    '[{"id": 6},', '[{"id": 6}', '[{"id": 6}, {"id":', '[{"id": 6}, {"id": 7', '{"id": 6}', '[{"id": 6}]]', '[{"id": 6}] x',
    '[{"id": 6} {"id": 7}]', '[{"id": 6},, {"id": 7}]', "[1, 2]", '[[{"id": 6}]]', "", "no", '[{"id": 6, "name": "a}]', '[{"id": 06}]', "[",
])
def test_broken_array_files_yield_nothing(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    (tmp_path / "good.json").write_text('[{"id": 1}, {"id": "word"}]')
    found = splitting.read_json_array(spark, str(tmp_path), "id BIGINT, name STRING").collect()
    assert [r.id for r in found] == [1]
