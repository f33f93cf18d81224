import math

import pytest
from pyspark.sql import functions as F

from pairloom.config import Fields, Training
from pairloom.operators import preference as E
from pairloom.operators import templates as T
from pairloom.operators.training import length_budget, step_plan
from pairloom.plans.training import prepare, prepare_source
from pairloom.sources.sinks import write_pairs

FAMILIES = [
    ("<|im_start|>x", "qwen"), ("Qwen llama", "qwen"), ("[INST]", "generic"), ("[inst]", "llama"), ("LLaMA", "llama"),
    ("<<SYS>>", "generic"), ("<<sys>>", "llama"), (None, "generic"), ("", "generic"), ("<|IM_START|>", "generic"),
]


def test_family_detection(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(FAMILIES)], "i int, t string")
    got = [r.f for r in df.select("i", T.detect_family(F.col("t")).alias("f")).orderBy("i").collect()]
    assert got == [f for _, f in FAMILIES]


def prompts(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "prompt string")


@pytest.mark.parametrize("family", ["qwen", "llama", "generic", "auto", "something"])
def test_rendering_leaves_slots_in_prompts_alone(spark, family):
    df = T.format_prompt(prompts(spark, "say {prompt} and {system}"), family, "qwen {system}>{prompt}<", system="S")
    assert df.first().prompt == "qwen S>say {prompt} and {system}<"


def test_rendering_without_template(spark):
    for family in ("generic", "something", "auto"):
        for template in (None, "", F.lit(None).cast("string")):
            assert T.format_prompt(prompts(spark, "p"), family, template).first().prompt == "p"
    with pytest.raises(Exception, match="needs a chat template"):
        T.format_prompt(prompts(spark, "p"), "llama", None).collect()
    with pytest.raises(ValueError):
        T.render(F.lit("p"), "t", system="{prompt}")


@pytest.mark.parametrize("n, steps, warmup", [(0, 0, 1), (15, 0, 1), (16, 2, 1), (221, 26, 2), (1600, 200, 20)])
def test_step_plan(spark, n, steps, warmup):
    assert tuple(step_plan(spark.range(n)).first()) == (n, steps, warmup)


def test_step_plan_counts_training_rows_only(spark):
    df = spark.range(320).withColumn("split", F.when(F.col("id") < 160, "eval").otherwise("train"))
    assert tuple(step_plan(df).first()) == (160, 20, 2)


def test_length_budget(spark):
    df = spark.createDataFrame([("a b", "c d e", "f")], "prompt string, chosen string, rejected string")
    row = length_budget(df, 4).first()
    assert (row.prompt_tokens, row.chosen_tokens, row.rejected_tokens) == (2, 3, 1)
    assert (row.chosen_over, row.rejected_over) == (True, False)
    assert length_budget(df, 4, count_tokens=F.length).first().rejected_over is False


def pairs(spark, n):
    return spark.range(n).select(
        F.format_string("q%04d", "id").alias("q"), F.lit("good").alias("g"), F.lit("weak").alias("w"), F.col("id").alias("k"), F.lit(1).alias("extra")
    )


def test_prepare(spark):
    cfg = Training(fields=Fields("q", "g", "w", "k"), max_samples=60, family="qwen")
    rows = prepare(pairs(spark, 100), cfg, "<{system}|{prompt}>").collect()
    assert rows[0].__fields__ == ["id", "prompt", "chosen", "rejected", "split"]
    assert sorted(r.id for r in rows) == list(range(60))
    assert all(r.prompt == f"<You are a helpful assistant.|q{r.id:04d}>" for r in rows)
    assert sum(r.split == "eval" for r in rows) == 3


def test_prepare_from_file_keeps_file_order(spark, tmp_path):
    path = str(tmp_path / "pairs.jsonl")
    write_pairs(pairs(spark, 100).selectExpr("q prompt", "g chosen", "w rejected").coalesce(1), path)
    rows = prepare_source(spark, path, Training(max_samples=50, family="generic")).collect()
    assert sorted(r.prompt for r in rows) == [f"q{i:04d}" for i in range(50)]
    assert sum(r.split == "eval" for r in rows) == math.ceil(0.05 * 50)
    assert len({r.id for r in rows}) == 50


def test_prepare_needs_an_order_to_limit(spark):
    with pytest.raises(ValueError, match="key column"):
        prepare(pairs(spark, 5), Training(fields=Fields("q", "g", "w"), max_samples=2), "t")
    with pytest.raises(ValueError, match="Missing fields"):
        prepare(pairs(spark, 5), Training(), "t")


@pytest.mark.parametrize("bad", [dict(eval_split=1.0), dict(max_samples=-1), dict(loss_type="other")])
def test_bad_settings(bad):
    with pytest.raises(ValueError):
        Training(**bad)


def logps(spark, *rows):
    return spark.createDataFrame(rows, "pc double, pr double, rc double, rr double")


def test_losses_against_the_formulas(spark):
    rows = [(-1.0, -2.0, -1.5, -1.0), (-5.0, -1.0, -1.0, -4.0), (0.0, 0.0, 0.0, 0.0)]
    beta = 0.2
    for pc, pr, rc, rr in rows:
        delta = (pc - rc) - (pr - rr)
        want = {
            "sigmoid": -math.log(1 / (1 + math.exp(-beta * delta))),
            "ipo": (delta - 1 / (2 * beta)) ** 2,
            "hinge": max(0.0, 1 - beta * delta),
        }
        for kind, value in want.items():
            assert E.loss(logps(spark, (pc, pr, rc, rr)), kind, beta).first().loss == pytest.approx(value, abs=1e-12)
        r = E.rewards(logps(spark, (pc, pr, rc, rr)), beta).first()
        assert (r.chosen_reward, r.rejected_reward) == (pytest.approx(beta * (pc - rc)), pytest.approx(beta * (pr - rr)))
        assert r.margin == pytest.approx(beta * delta)
    with pytest.raises(ValueError):
        E.loss(logps(spark, rows[0]), "other")


def test_sigmoid_loss_does_not_overflow(spark):
    high, low = E.loss(logps(spark, (1e4, 0.0, 0.0, 0.0), (-1e4, 0.0, 0.0, 0.0)), "sigmoid", 1.0).collect()
    assert high.loss == 0.0 and low.loss == 1e4


def test_evaluation_summary(spark):
    df = logps(spark, (-1.0, -2.0, -1.5, -1.0), (-5.0, -1.0, -1.0, -4.0)).withColumn("split", F.lit("eval"))
    row = E.eval_summary(E.loss(E.rewards(df, 1.0), "hinge", 1.0)).first()
    assert (row.split, row.n, row.accuracy) == ("eval", 2, 0.5)
    assert row.mean_loss == pytest.approx((0.0 + 8.0) / 2)
    assert row.mean_margin == pytest.approx((1.5 - 7.0) / 2)
