import pytest
from pyspark.sql import functions as F

from pairloom.config import Quality
from pairloom.operators.generation import observe_counts
from pairloom.operators.quality import (
    accepted, classify, readiness, reason_text, run_summary, skip_breakdown, skipped,
)
from pairloom.operators.validate import (
    FieldMappingError, drop_blank, drop_blank_stats, require_columns, to_pairs,
)
from pairloom.config import Fields


def words(n, start=0):
    return " ".join(f"w{i}" for i in range(start, start + n))


def pairs(spark, rows):
    return spark.createDataFrame([(i, "p", *r) for i, r in enumerate(rows)], "id int, prompt string, chosen string, rejected string")


def outcomes(spark, rows, cfg=Quality(), **kw):
    return [r.outcome for r in classify(pairs(spark, rows), cfg, **kw).orderBy("id").collect()]


BOUNDARIES = [
    ("long " * 3, None, "failed"),
    ("long", "  " + chr(0x3000), "empty"),
    ("long", "", "empty"),
    ("abc", "x" * 19, "too_short"),
    ("abc", "  " + "x" * 19 + "  ", "too_short"),
    ("abc", "x" * 20, "ok"),
    ("y" * 200, "x" * 20, "ok"),        # ratio is exactly 0.1
    ("y" * 201, "x" * 20, "ratio"),
    ("", "x" * 20, "ok"),               # no chosen words: overlap is 0
    (words(20), words(17), "ok"),       # overlap is exactly 17/20 = 0.85
    (words(20), words(18), "similar"),
    (words(20), words(20).upper(), "similar"),
]


def test_boundaries(spark):
    assert outcomes(spark, [r[:2] for r in BOUNDARIES]) == [r[2] for r in BOUNDARIES]


def test_evidence_does_not_change_outcomes(spark):
    assert outcomes(spark, [r[:2] for r in BOUNDARIES], evidence=True) == [r[2] for r in BOUNDARIES]


def test_null_in_a_finished_file_is_empty(spark):
    assert outcomes(spark, [("a", None)], missing="empty") == ["empty"]


def test_rules_can_be_switched_off(spark):
    short, thin, same = ("abc", "xy"), ("y" * 400, "x" * 25), (words(20), words(20))
    rows = [short, thin, same]
    assert outcomes(spark, rows) == ["too_short", "ratio", "similar"]
    assert outcomes(spark, rows, Quality(min_rejected_length=None)) == ["ok", "ratio", "similar"]
    assert outcomes(spark, rows, Quality(min_length_ratio=0)) == ["too_short", "ok", "similar"]
    assert outcomes(spark, rows, Quality(skip_if_too_similar=False)) == ["too_short", "ratio", "ok"]


def test_first_rule_wins(spark):
    # Short, thin and equal at once.
    assert outcomes(spark, [("ab " * 100, "ab")]) == ["too_short"]


def test_threshold_is_needed():
    with pytest.raises(ValueError):
        Quality(similarity_threshold=None)
    Quality(skip_if_too_similar=False, similarity_threshold=None)


def brute_force(chosen, rejected):
    if rejected is None:
        return "failed"
    size = len(rejected.strip())
    if size == 0:
        return "empty"
    if size < 20:
        return "too_short"
    if len(rejected) / (len(chosen) or 1) < 0.1:
        return "ratio"
    a, b = (set(t.lower().split()) for t in (chosen, rejected))
    return "similar" if a and b and len(a & b) / len(a | b) > 0.85 else "ok"


def test_against_brute_force_on_documents(spark, sf_dir):
    from catalog.tables import weak_docs

    rows = classify(weak_docs(spark, sf_dir)).collect()
    assert {r.outcome for r in rows} == {"failed", "empty", "too_short", "ratio", "similar", "ok"}
    assert all(r.outcome == brute_force(r.chosen, r.rejected) for r in rows)


def test_counts(spark):
    judged = classify(pairs(spark, [r[:2] for r in BOUNDARIES]))
    observed, counters = observe_counts(judged)
    observed.write.format("noop").mode("overwrite").save()
    summary = run_summary(judged).first().asDict()
    assert summary == {"total": 12, "written": 4, "skipped": 7, "failed": 1} == counters.get
    assert accepted(judged).count() == 4 and skipped(judged).count() == 7
    assert {r.outcome: r.n for r in skip_breakdown(judged).collect()} == {
        "empty": 2, "too_short": 2, "ratio": 1, "similar": 2,
    }


def test_reasons(spark):
    rows = classify(pairs(spark, [r[:2] for r in BOUNDARIES])).select("id", reason_text().alias("r")).orderBy("id")
    reasons = [r.r for r in rows.collect()]
    assert reasons[:4] == ["", "empty response", "empty response", "too short (19 chars)"]
    assert reasons[7] == "length ratio too low (0.10)" and reasons[10] == "too similar to chosen (Jaccard=0.90)"


@pytest.mark.parametrize("written, band", [(0, "none"), (1, "too_few"), (49, "too_few"), (50, "ready")])
def test_readiness(spark, written, band):
    assert readiness(spark.range(1).select(F.lit(written).alias("written"))).first().band == band


def test_blank_records(spark):
    rows = [("p", "c"), ("", "c"), (None, "c"), ("p", " \t "), ("p", None), (" p ", "c")]
    df = spark.createDataFrame(rows, "prompt string, chosen string")
    assert drop_blank(df).count() == 2
    assert tuple(drop_blank_stats(df).first()) == (6, 2, 4)


def test_columns_and_projection(spark):
    df = spark.createDataFrame([("i", "o", 1)], "instruction string, output string, extra int")
    assert to_pairs(require_columns(df, ["instruction", "output"]), Fields()).columns == ["prompt", "chosen"]
    with pytest.raises(FieldMappingError) as e:
        require_columns(df, ["instruction", "answer"])
    assert e.value.missing == ["answer"] and e.value.found == df.columns


def test_filters_do_not_repeat_the_word_overlap(spark, tmp_path):
    path = str(tmp_path / "pairs")
    pairs(spark, [r[:2] for r in BOUNDARIES]).write.parquet(path)
    judged = classify(spark.read.parquet(path))
    for df in (judged, accepted(judged), skipped(judged), judged.where("jaccard > 0.5 and outcome = 'ok'")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("array_intersect") == 1 and plan.count("split(") == 2
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_counting_reads_only_what_it_needs(spark, tmp_path):
    path = str(tmp_path / "pairs")
    pairs(spark, [r[:2] for r in BOUNDARIES]).write.parquet(path)
    plan = run_summary(classify(spark.read.parquet(path)))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<chosen:string,rejected:string>" in plan
