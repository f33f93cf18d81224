"""The whole job, from a file to pairs, against a plain loop."""

import json

import pytest
from test_quality import brute_force

from pairloom.config import Fields, Generation, Selection
from pairloom.operators.generation import attempts_of
from pairloom.operators.sampling import shuffle
from pairloom.operators.validate import FieldMappingError
from pairloom.plans.curate import Curation, build_pairs, load_accounted, load_records, select_records
from pairloom.sources.records import read_pairs


def reply(prompt):
    """The weak response of the scripted generator, or None where it always fails."""
    n = int(prompt.split()[-1])
    return {0: None, 1: "", 2: "short", 3: f"word {prompt} and something of its own {n}", 4: f" answer to {prompt} in full "}[n % 5]


def make_generator_for(reply):
    def make_generator(timeout):
        def send(request):
            text = reply(json.loads(request)["messages"][-1]["content"])
            if text is None:
                raise TimeoutError
            return json.dumps({"choices": [{"message": {"content": text}}]})

        return send

    return make_generator


def inner_reply():
    # An inner copy, so that it travels to the workers by value.
    def weak(prompt):
        n = int(prompt.split()[-1])
        return {0: None, 1: "", 2: "short", 3: f"word {prompt} and something of its own {n}", 4: f" answer to {prompt} in full "}[n % 5]

    return weak


@pytest.fixture
def source(tmp_path):
    path = tmp_path / "sft.jsonl"
    records = [{"instruction": f" question {i} ", "output": f"answer to question {i} in full", "other": i} for i in range(100)]
    records += [{"instruction": " ", "output": "x"}, {"instruction": "y"}, records[3], records[4]]
    path.write_text("\n".join(json.dumps(r) for r in records) + "\n{broken\n")
    return str(path)


def want(n=100, extra=(3, 4)):
    rows = []
    for i in [*range(n), *extra]:
        prompt, chosen = f"question {i}", f"answer to question {i} in full"
        weak = reply(prompt)
        weak = None if weak is None else weak.strip()
        rows.append((prompt, chosen, weak, brute_force(chosen, weak)))
    return rows


CFG = Curation(generation=Generation(retry_delay=0.0, concurrency=2, waves=2))


def test_build_pairs(spark, source, tmp_path):
    out = str(tmp_path / "run")
    summary = build_pairs(spark, source, out, CFG, make_generator_for(inner_reply())).first()
    rows = want()
    counts = {o: sum(r[3] == o for r in rows) for o in ("ok", "failed")}
    assert summary.total == 102 and summary.failed == counts["failed"] and summary.written == counts["ok"] > 0
    assert summary.skipped == 102 - counts["ok"] - counts["failed"] and summary.band == "too_few"
    got = sorted(tuple(r) for r in read_pairs(spark, f"{out}/pairs.jsonl").select("prompt", "chosen", "rejected").collect())
    assert got == sorted(r[:3] for r in rows if r[3] == "ok")
    assert spark.read.json(f"{out}/skipped.jsonl").count() == summary.skipped
    # Resumed, it gives the same; an offline log of the same attempts too.
    again = build_pairs(spark, source, out, CFG, make_generator_for(None), resume=True).first()
    assert tuple(again) == tuple(summary)
    log = attempts_of(spark, f"{out}/generation", "id string, attempt int, content string, status string")
    offline = build_pairs(spark, source, str(tmp_path / "offline"), CFG, responses=log).first()
    assert tuple(offline) == tuple(summary)


def test_build_pairs_needs_one_kind_of_response(spark, source, tmp_path):
    with pytest.raises(ValueError):
        build_pairs(spark, source, str(tmp_path / "x"))


def test_selection(spark, source):
    records = load_records(spark, source, Fields())
    everything = select_records(records, Fields(), Selection())
    assert everything.count() == 102
    sample = {r.id for r in select_records(records, Fields(), Selection(max_samples=10)).collect()}
    assert len(sample) == 10 and sample == {r.id for r in select_records(records, Fields(), Selection(max_samples=10)).collect()}
    assert sample != {r.id for r in select_records(records, Fields(), Selection(max_samples=10, seed=1)).collect()}
    head = select_records(records, Fields(), Selection(max_samples=7, shuffle=False)).collect()
    assert sorted(r.prompt for r in head) == [f"question {i}" for i in range(7)]
    assert select_records(records, Fields(), Selection(max_samples=0)).count() == 0


def test_json_under_another_name(spark, source, tmp_path):
    other = tmp_path / "records.txt"
    other.write_text(open(source).read())
    assert load_records(spark, str(other), Fields(), json_source=True).count() == 104


def test_the_head_of_a_file_does_not_depend_on_how_it_is_split(spark, tmp_path):
    """Positions are laid down once: another way of reading the file, between cut and action, changes nothing."""
    source = tmp_path / "many.jsonl"
    source.write_text("".join(f'{{"instruction":"question {i}","output":"answer {i}"}}\n' for i in range(20_000)))
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    try:
        spark.conf.set(setting, "64k")
        head = select_records(load_records(spark, str(source), Fields()), Fields(), Selection(max_samples=12_345, shuffle=False))
        spark.conf.set(setting, "7m")
        assert {r.prompt for r in head.collect()} == {f"question {i}" for i in range(12_345)}
    finally:
        spark.conf.set(setting, before)


def test_nothing_is_lost_without_a_count(spark, tmp_path):
    source = tmp_path / "faulty.jsonl"
    good = [f'{{"instruction":"question {i}","output":"{"long answer " * 9}{i}"}}' for i in range(20)]
    source.write_text("\n".join([*good, "{bad", '{"instruction":" ","output":"x"}', '{"instruction":"y"}', "", '{"a":1} more']))
    log = spark.createDataFrame([("none", 0, "x")], "id string, attempt int, content string")
    row = build_pairs(spark, str(source), str(tmp_path / "out"), CFG, responses=log).first()
    assert (row.malformed, row.blank, row.total, row.failed) == (2, 2, 20, 20)
    assert {r.line for r in spark.read.json(str(tmp_path / "out/malformed")).collect()} == {"{bad", '{"a":1} more'}


def test_the_account_balances(spark, tmp_path):
    """One parse for all kinds of rows, and counts of the same job."""
    source = tmp_path / "faulty.jsonl"
    good = [f'{{"instruction":"question {i}","output":"{"long answer " * 9}{i}"}}' for i in range(20)]
    source.write_text("\n".join([*good, "{bad", '{"instruction":" ","output":"x"}', '{"instruction":"y"}', "", '{"a":1} more']))
    loaded, counts = load_accounted(spark, str(source), Fields(), str(tmp_path / "out"))
    assert counts == {"read": 24, "malformed": 2, "blank": 2, "valid": 20} and loaded.count() == 20
    assert "from_json" not in loaded._jdf.queryExecution().toString().lower()
    arrays = tmp_path / "a.json"
    arrays.write_text(f'[{",".join(good)}, {{"instruction":null,"output":"x"}}]')
    loaded, counts = load_accounted(spark, str(arrays), Fields(), str(tmp_path / "out2"))
    assert counts == {"read": 21, "malformed": 0, "blank": 1, "valid": 20} and loaded.count() == 20
    empty = tmp_path / "e.jsonl"
    empty.write_text("\n")
    assert load_accounted(spark, str(empty), Fields(), str(tmp_path / "out3"))[1] == {"read": 0, "malformed": 0, "blank": 0, "valid": 0}
    spark.createDataFrame([("q", "a"), (" ", "a")], "instruction string, output string").write.parquet(str(tmp_path / "t"))
    assert load_accounted(spark, str(tmp_path / "t"), Fields(), str(tmp_path / "out4"))[1] == {"read": 2, "malformed": 0, "blank": 1, "valid": 1}


def test_the_pair_file_is_in_the_seeded_order(spark, source, tmp_path):
    out = str(tmp_path / "run")
    build_pairs(spark, source, out, CFG, make_generator_for(inner_reply()))
    classified = spark.read.parquet(f"{out}/classified").where("outcome = 'ok'")
    want = [r.prompt for r in shuffle(classified, "id", Selection().seed).collect()]
    lines = [json.loads(x)["prompt"] for p in sorted((tmp_path / "run/pairs.jsonl").glob("part-*")) for x in p.read_text("utf-8").splitlines()]
    assert lines == want and len(want) > 10
    # The job's own table, and its pair file under a name that says nothing, are read by path.
    assert load_records(spark, f"{out}/classified", Fields("prompt", "chosen")).count() == 102
    (tmp_path / "run/pairs.jsonl").rename(tmp_path / "run/pairs")
    assert load_records(spark, f"{out}/pairs", Fields("prompt", "chosen")).count() == len(want)


def test_resume_refuses_another_source(spark, source, tmp_path):
    out, other = str(tmp_path / "run"), tmp_path / "other.jsonl"
    build_pairs(spark, source, out, CFG, make_generator_for(inner_reply()))
    other.write_text('{"instruction":"something else","output":"entirely"}\n')
    with pytest.raises(ValueError, match="other records"):
        build_pairs(spark, str(other), out, CFG, make_generator_for(None), resume=True)


def test_keyed_table(spark):
    df = spark.range(20).selectExpr("id k", "concat('p', id) instruction", "'c' output")
    df.createOrReplaceTempView("sft")
    fields = Fields(key="k")
    rows = select_records(load_records(spark, "sft", fields), fields, Selection(max_samples=4, shuffle=False)).collect()
    assert sorted((r.id, r.prompt) for r in rows) == [(i, f"p{i}") for i in range(4)]
    with pytest.raises(FieldMappingError):
        load_records(spark, "sft", Fields("instruction", "answer"))
    df.selectExpr("*", "if(k < 5, 'test', 'train') split").createOrReplaceTempView("sft_split")
    assert load_records(spark, "sft_split", fields).count() == 15
    assert load_records(spark, "sft_split", fields, "test").count() == 5
    with pytest.raises(ValueError):
        select_records(df, Fields(), Selection(max_samples=4, shuffle=False))
