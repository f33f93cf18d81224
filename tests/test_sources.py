import json
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pairloom.config import Fields
from pairloom.operators.sampling import head_n
from pairloom.operators.validate import FieldMappingError
from pairloom.sources import sinks
from pairloom.sources.criteria import read_criteria
from pairloom.sources import arrays
from pairloom.sources.records import (
    POSITION, _head_of_arrays, is_json_array, read_json_array, read_jsonl, read_pairs, read_records, read_table, require_fields, spread_small,
)

SCHEMA = "a string, b string"
NBSP, LINE_SEPARATOR = chr(0xA0), chr(0x2028)
GOOD = [
    ('{"a":"1","b":"2"}', ("1", "2")),
    ('{"a":"x%sy"}' % LINE_SEPARATOR, (f"x{LINE_SEPARATOR}y", None)),
    ('{"a":1}', ("1", None)),
    ('{"b":"only b"}', (None, "only b")),
    ('{"a":"first","a":"last"}', ("last", None)),
    (NBSP + '\t{"a":"padded"} ', ("padded", None)),
    ('{"a":null}', (None, None)),
]
BAD = [
    "{bad", "5", "[1,2]", "null", '"text"', "{'a':\"1\"}", '{"a":"1"} trailing', '{"a":"1"},{"a":"2"}',
    '{"a":"1"}]x', '{"a":"1"', '{"a":"1"}{"a":"2"}',
]


def write(path, text):
    path.write_text(text, encoding="utf-8", newline="")
    return str(path)


def test_jsonl(spark, tmp_path):
    lines = ["", *[g[0] for g in GOOD], "   ", *BAD, NBSP]
    path = write(tmp_path / "r.jsonl", "\n".join(lines))
    good, bad = read_jsonl(spark, path, SCHEMA, with_position=True)
    assert [tuple(r)[:2] for r in good.orderBy("position").collect()] == [g[1] for g in GOOD]
    assert sorted(r.line for r in bad.collect()) == sorted(BAD)
    assert bad.first().file.endswith("r.jsonl")
    # A narrow read judges lines as a full one does.
    assert good.select("b").count() == len(GOOD)


def test_jsonl_parses_each_line_once(spark, tmp_path):
    good, _ = read_jsonl(spark, write(tmp_path / "r.jsonl", GOOD[0][0]), SCHEMA)
    assert good._jdf.queryExecution().executedPlan().toString().count("from_json") == 1


def test_jsonl_crlf_and_strict(spark, tmp_path):
    path = write(tmp_path / "r.jsonl", '{"a":"1"}\r\n\r\n{"a":"2"}\r\n')
    assert read_jsonl(spark, path, SCHEMA, strict=True)[0].count() == 2
    broken = write(tmp_path / "b.jsonl", '{"a":"1"}\n{oops\n')
    with pytest.raises(PySparkException, match="Malformed JSON line"):
        read_jsonl(spark, broken, SCHEMA, strict=True)[0].collect()


def test_position_is_input_order_over_splits(spark, tmp_path):
    path = write(tmp_path / "many.jsonl", "\n".join(json.dumps({"a": str(i), "b": "x" * 50}) for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        good, _ = read_jsonl(spark, path, SCHEMA, with_position=True)
        assert good.rdd.getNumPartitions() > 4
        assert [int(r.a) for r in good.orderBy("position").collect()] == list(range(3000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_json_array(spark, tmp_path):
    path = write(tmp_path / "r.json", '\n \n[\n {"a":"1",\n "b":"2"},\n {"a":"3"}\n]\n')
    assert is_json_array(spark, path)
    good, bad = read_records(spark, path, SCHEMA, with_position=True)
    assert [tuple(r)[:2] for r in good.orderBy("position").collect()] == [("1", "2"), ("3", None)]
    assert bad.count() == 0
    for text in ('[{"a":"1"},{"a":"2"', '[{"a":"1"},{"a":"2"}', '[{"a":"1"} {"a":"2"}]', '[{"a":"1"},]', '[{"a":"1"},7]', '[[{"a":"1"}]]', '[{"a":"1"}}]', '[{"a":[}]',
                 '[{"a":"1" "b":"2"}]', '[{"a":"1}]', '[,{"a":"1"}]', '  }[{"a":"1"}]'):
        broken = write(tmp_path / "b.json", text)
        with pytest.raises(Exception, match="MALFORMED_RECORD|not closed|Not an array|closing brace|not opened"):
            read_json_array(spark, broken, SCHEMA).collect()
    for text, n in (("[]", 0), (" [ \n] {[", 0), ('\ufeff[{"a":"1"}] and }{ more [{', 1), ("", 0), (" \n ", 0), ('[{}]', 1)):
        assert read_json_array(spark, write(tmp_path / "c.json", text), SCHEMA).count() == n


TRICKY = ["}", "{", '"', "\\", '\\"', "}{", "[", "],", '"}', "\\\\", "a", "é語", "\n", ", {", "}]"]


@pytest.mark.parametrize("split_bytes, indent", [("200", 1), ("1500", None), ("128m", 2)])
def test_arrays_split_anywhere(spark, tmp_path, split_bytes, indent):
    """Braces, brackets, quotes and escapes in texts, nested values, records longer than many splits."""
    rng = random.Random(split_bytes)
    files = {}
    for name in ("b.json", "a.json", "empty.json", "none.json"):
        n = {"a.json": 150, "b.json": 60}.get(name, 0)
        files[name] = [{"i": f"{name}{i}", "a": "".join(rng.choice(TRICKY) for _ in range(rng.choice([0, 1, 5, 60]))), "c": [{"d": rng.choice(TRICKY)}, [], {}]} for i in range(n)]
        write(tmp_path / name, "" if name == "empty.json" else json.dumps(files[name], indent=indent, ensure_ascii=rng.random() < 0.5) + "\n ] } trailing")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = read_json_array(spark, str(tmp_path), "i string, a string, c array<string>", with_position=True)
        got = [(r.i, r.a) for r in rows.orderBy(POSITION).collect()]
        assert got == [(r["i"], r["a"]) for name in sorted(files) for r in files[name]]
        assert len({(r.position.file, r.position.block) for r in rows.select(POSITION).collect()}) > (1 if split_bytes == "128m" else 10)
        head = head_n(rows, 100, POSITION)
        assert {r.i for r in head.collect()} == {i for i, _ in got[:100]}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_small_splits_of_arrays_share_tasks(spark, tmp_path):
    path = write(tmp_path / "a.json", json.dumps([{"a": "x" * 50}] * 1000))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        chunks = arrays._chunks(spark, path)
        assert chunks.select("file_block_start").distinct().count() > 200
        assert chunks.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
        assert read_json_array(spark, path, "a string").count() == 1000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_fields_are_checked_on_the_first_records_alone(spark, tmp_path):
    """An empty first file checks the next one; a record may be longer than what is read at first; nothing is read whole."""
    folder = tmp_path / "arrays"
    folder.mkdir()
    write(folder / "a.json", "")
    write(folder / "b.json", "[]")
    write(folder / "c.json", json.dumps([{"a": "}" * 5000, "b": None}, {"a": "1", "b": {"c": {}}}]))
    write(folder / "d.json", json.dumps([{"a": "1", "b": "2"}] * 3 + [{"x": "1"}] * 50_000) + "}" * 50_000)
    assert [json.loads(r).get("a", "")[:2] for r in _head_of_arrays(spark, str(folder), 5)] == ["}}", "1", "1", "1", "1"]
    require_fields(spark, str(folder), ["a", "b"])
    with pytest.raises(FieldMappingError) as e:
        require_fields(spark, str(folder), ["a", "z"])
    assert e.value.missing == ["z"] and e.value.found == ["a", "b"]
    assert len(_head_of_arrays(spark, write(tmp_path / "t.json", '[{"a":"1"},{"a":'), 5)) == 1


def test_form_is_sniffed(spark, tmp_path):
    lines = write(tmp_path / "r.jsonl", ' \n{"a":"["}\n')
    assert not is_json_array(spark, lines)
    assert not is_json_array(spark, write(tmp_path / "empty.jsonl", ""))
    assert read_records(spark, lines, SCHEMA)[0].count() == 1


def test_mixed_folder(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    write(folder / "a.json", '[{"a":"1"}]')
    write(folder / "b.json", '{"a":"1"}\n{"a":"2"}')
    with pytest.raises(ValueError, match="mixes"):
        read_records(spark, str(folder), SCHEMA)
    other = tmp_path / "other"
    other.mkdir()
    write(other / "a.json", '{"a":"1"}\n{"a":"2"}')
    write(other / "b.json", '[{"a":"1"}]')
    with pytest.raises(ValueError, match="mixes"):
        read_records(spark, str(other), SCHEMA)


def test_empty_files_say_nothing(spark, tmp_path):
    for name, text, n in (("arrays", '[{"a":"1"},{"a":"2"}]', 2), ("lines", '{"a":"1"}\n{"a":"2"}\n{"a":"3"}', 3)):
        folder = tmp_path / name
        folder.mkdir()
        write(folder / "a.json", "")
        write(folder / "b.json", text)
        assert read_records(spark, str(folder), SCHEMA)[0].count() == n


def test_pairs_by_parquet_path(spark, tmp_path):
    rows = spark.createDataFrame([("p", "c", "r")], "prompt string, chosen string, rejected string")
    rows.write.parquet(str(tmp_path / "plain"))
    rows.selectExpr("*", "'ok' outcome").write.partitionBy("outcome").parquet(str(tmp_path / "parts"))
    for name in ("plain", "parts"):
        assert [tuple(r)[:3] for r in read_pairs(spark, str(tmp_path / name)).collect()] == [("p", "c", "r")]


def test_no_local_working_folder(spark):
    from types import SimpleNamespace

    from pairloom.sources.paths import scratch_path

    unset = SimpleNamespace(conf=SimpleNamespace(get=lambda name, default=None: default))
    with pytest.raises(ValueError, match="executors share"):
        scratch_path(unset, "x")


@pytest.mark.parametrize("read", [
    lambda s, p: read_jsonl(s, p, SCHEMA), lambda s, p: read_json_array(s, p, SCHEMA),
    lambda s, p: read_records(s, p, SCHEMA), lambda s, p: read_pairs(s, p + ".jsonl"),
    lambda s, p: read_criteria(s, p), lambda s, p: read_table(s, p),
])
def test_missing_input(spark, tmp_path, read):
    with pytest.raises(FileNotFoundError):
        read(spark, str(tmp_path / "nowhere"))


@pytest.mark.parametrize("form", ["lines", "array"])
def test_required_fields(spark, tmp_path, form):
    def path(name, records):
        text = json.dumps(records) if form == "array" else "\n".join(map(json.dumps, records))
        return write(tmp_path / name, text)

    full, null, part = {"a": "1", "b": "2"}, {"a": None, "b": "2"}, {"a": "1"}
    require_fields(spark, path("1", [full, null]), ["a", "b"])
    require_fields(spark, path("2", [full] * 5 + [part]), ["a", "b"])  # only five are looked at
    require_fields(spark, path("3", [full, part]), ["a", "b"], in_each=False)
    with pytest.raises(FieldMappingError) as e:
        require_fields(spark, path("4", [full, part]), ["a", "b"])
    assert e.value.missing == ["b"] and e.value.found == ["a", "b"]
    with pytest.raises(FieldMappingError):
        require_fields(spark, path("5", [part]), ["a", "b"], in_each=False)


def test_required_fields_of_an_empty_file(spark, tmp_path):
    require_fields(spark, write(tmp_path / "e.jsonl", ""), ["a"])


def test_pair_file(spark, tmp_path):
    text = f"é{LINE_SEPARATOR}\n\"q\" 語"
    df = spark.createDataFrame([("x", text, "p", text)], "extra string, rejected string, prompt string, chosen string")
    out = str(tmp_path / "pairs.jsonl")
    sinks.write_pairs(df, out)
    sinks.write_pairs(df, out)  # overwrites
    raw = "".join(p.read_text("utf-8") for p in (tmp_path / "pairs.jsonl").glob("part-*"))
    assert list(json.loads(raw)) == ["prompt", "chosen", "rejected"] and "語" in raw and "é" in raw
    row = read_pairs(spark, out).first()
    assert (row.prompt, row.chosen, row.rejected) == ("p", text, text)


def test_empty_pair_file(spark, tmp_path):
    none = spark.createDataFrame([], "prompt string, chosen string, rejected string")
    sinks.write_pairs(none, str(tmp_path / "none.jsonl"))
    assert read_pairs(spark, str(tmp_path / "none.jsonl")).count() == 0


def test_mapped_pair_file(spark, tmp_path):
    path = write(tmp_path / "m.json", '[{"q":"1","good":"2","weak":"3","k":"9"}]')
    df = read_pairs(spark, path, fields=Fields("q", "good", "weak", "k"))
    assert df.select("q", "good", "weak", "k").first() == ("1", "2", "3", "9")


def test_named_table_and_split(spark, tmp_path):
    df = spark.range(10).withColumn("split", F.when(F.col("id") < 3, "eval").otherwise("train"))
    path = str(tmp_path / "t")
    sinks.write_training(df, path)
    assert read_table(spark, path, "eval").count() == 3 and read_table(spark, path).count() == 10
    plan = read_table(spark, path, "eval")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    spark.range(4).createOrReplaceTempView("unsplit")
    assert read_table(spark, "unsplit", "train").count() == 4
    with pytest.raises(ValueError):
        read_table(spark, "unsplit", "eval")
    with pytest.raises(FileNotFoundError):
        read_pairs(spark, "no_such_table")


def test_criteria(spark, tmp_path):
    document = {
        "version": 1, "created": "2026-01-01T00:00:00.000Z", "session": "s", "evaluator": "e",
        "criteria": [{"text": t, "type": k} for t, k in [("A?", "primary"), ("B?", "primary"), ("C?", "secondary"), ("D?", "anti")]],
        "sampleCount": 50,
    }
    rows = read_criteria(spark, write(tmp_path / "c.json", json.dumps(document, indent=2))).orderBy("pos").collect()
    assert [(r.pos, r.text, r.type) for r in rows] == [(0, "A?", "primary"), (1, "B?", "primary"), (2, "C?", "secondary"), (3, "D?", "anti")]
    assert {(r.session, r.evaluator, r.sample_count) for r in rows} == {("s", "e", 50)}


def test_only_small_inputs_are_spread(spark, sf_dir, monkeypatch):
    path = f"{sf_dir}/documents.parquet"
    df = spark.read.parquet(path)
    assert spread_small(spark, df, path, "doc_id") is not df
    monkeypatch.setattr("pairloom.sources.records.path_size", lambda *_: 10**12)
    assert spread_small(spark, df, path, "doc_id") is df
