"""Templates, the training table and preference evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import sql as S
from catalog.registry import query
from catalog.tables import logps, sft_conv, table, weak_docs
from pairloom.config import SELECTION_SEED, TRAINING_SEED, Fields, Training
from pairloom.functions.order import seeded_hash
from pairloom.operators import preference as E
from pairloom.operators import quality as Q
from pairloom.operators import templates as T
from pairloom.operators.sampling import split_by_hash, split_exact
from pairloom.operators.training import length_budget, step_plan
from pairloom.operators.validate import to_pairs
from pairloom.plans.training import prepare, prepare_source
from pairloom.sources.paths import scratch_path
from pairloom.sources.sinks import write_pairs

# Invented templates that carry the family markers.
_MARKERS = [
    "<|im_start|>{system}/{prompt}", "Qwen llama {system} {prompt}", "[INST] {prompt}", "[inst] {system} {prompt}",
    "LLaMA {prompt}", "<<SYS>>{system}", "<<sys>>{system} {prompt}", None, "",
]
_FAMILY = "CASE doc_id % 9 WHEN 0 THEN 'qwen' WHEN 1 THEN 'qwen' WHEN 3 THEN 'llama' WHEN 4 THEN 'llama' WHEN 6 THEN 'llama' ELSE 'generic' END"
_TEMPLATE_SQL = "CASE doc_id % 9 " + " ".join(
    f"WHEN {i} THEN '{t}'" for i, t in enumerate(_MARKERS) if t is not None
) + " END"
_SYSTEM = "You are a helpful assistant."
_LLAMA = "<<sys>>{system}<</sys>>[inst]{prompt}[/inst]"


def _templates(spark, sf_dir):
    kind = F.col("doc_id") % 9
    template = F.lit(None).cast("string")
    for i, text in enumerate(_MARKERS):
        if text is not None:
            template = F.when(kind == i, text).otherwise(template)
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("prompt"), template.alias("template")
    )


def _filled(template: str) -> str:
    return f"replace(replace({template}, '{{system}}', '{_SYSTEM}'), '{{prompt}}', text)"


@query("template_families", f"SELECT doc_id AS id, {_FAMILY} AS family FROM documents")
def template_families(spark, sf_dir):
    return _templates(spark, sf_dir).select("id", T.detect_family(F.col("template")).alias("family"))


@query("rendered_qwen", f"SELECT doc_id AS id, '<|im_start|>{_SYSTEM}|' || text || '|' AS prompt FROM documents")
def rendered_qwen(spark, sf_dir):
    prompts = _templates(spark, sf_dir).select("id", "prompt")
    return T.format_prompt(prompts, T.QWEN, "<|im_start|>{system}|{prompt}|")


@query("rendered_llama", f"SELECT doc_id AS id, '<<sys>>{_SYSTEM}<</sys>>[inst]' || text || '[/inst]' AS prompt FROM documents")
def rendered_llama(spark, sf_dir):
    return T.format_prompt(_templates(spark, sf_dir).select("id", "prompt"), T.LLAMA, _LLAMA)


@query("rendered_generic", "SELECT doc_id AS id, text AS prompt FROM documents")
def rendered_generic(spark, sf_dir):
    return T.format_prompt(_templates(spark, sf_dir).select("id", "prompt"), T.GENERIC, None)


@query(
    "family_dispatch",
    f"""SELECT doc_id AS id, CASE WHEN coalesce(template, '') = '' THEN text ELSE {_filled('template')} END AS prompt
      FROM (SELECT *, {_TEMPLATE_SQL} AS template FROM documents)""",
)
def family_dispatch(spark, sf_dir):
    rendered = T.format_prompt(_templates(spark, sf_dir), T.AUTO, F.col("template"))
    return rendered.select("id", "prompt")


@query(
    "training_table",
    S.with_(S.WEAK_DOCS)
    + f"""SELECT id, '<<sys>>{_SYSTEM}<</sys>>[inst]' || prompt || '[/inst]' AS prompt, chosen, rejected,
      CASE WHEN row_number() OVER (ORDER BY {S.seeded('id', TRAINING_SEED)}, id)
        <= ceil(0.05::DOUBLE * count(*) OVER ()) THEN 'eval' ELSE 'train' END AS split FROM weak_docs""",
)
def training_table(spark, sf_dir):
    cfg = Training(fields=Fields("prompt", "chosen", "rejected", key="id"))
    return prepare(weak_docs(spark, sf_dir), cfg, _LLAMA)


@query(
    "step_plan",
    S.with_(S.SFT_CONV)
    + """SELECT n AS n_train, n // 16 * 2 AS total_steps, greatest(1, CAST(floor(n // 16 * 2 * 0.1::DOUBLE) AS BIGINT)) AS warmup_steps
      FROM (SELECT count(*) - CAST(ceil(0.05::DOUBLE * count(*)) AS BIGINT) AS n FROM sft_conv)""",
)
def step_plan_(spark, sf_dir):
    pairs = split_exact(to_pairs(sft_conv(spark, sf_dir), Fields(), ("id",)), 0.05, TRAINING_SEED, "id")
    return step_plan(pairs)


_N = {c: f"CAST(len({S.words(c)}) AS INTEGER)" for c in ("prompt", "chosen", "rejected")}


@query(
    "length_budget",
    S.with_(S.WEAK_DOCS)
    + f"""SELECT *, prompt_tokens + chosen_tokens > 300 AS chosen_over, prompt_tokens + rejected_tokens > 300 AS rejected_over
      FROM (SELECT id, {_N['prompt']} AS prompt_tokens, {_N['chosen']} AS chosen_tokens,
            {_N['rejected']} AS rejected_tokens FROM weak_docs)""",
)
def length_budget_(spark, sf_dir):
    return length_budget(weak_docs(spark, sf_dir), 300).drop("source", "prompt", "chosen", "rejected")


_REWARDS = """rewarded AS (SELECT *, 0.125 * (pc - rc) AS chosen_reward, 0.125 * (pr - rr) AS rejected_reward,
  (pc - rc) - (pr - rr) AS delta FROM logps)"""
_SIGMOID = "ln(1 + exp(-abs(0.125 * delta))) + greatest(-0.125 * delta, 0)"


def _loss(value: str) -> str:
    return S.with_(S.LOGPS, _REWARDS) + f"SELECT id, {value} AS loss FROM rewarded"


@query(
    "implicit_rewards",
    S.with_(S.LOGPS, _REWARDS)
    + "SELECT id, chosen_reward, rejected_reward, chosen_reward - rejected_reward AS margin FROM rewarded",
)
def implicit_rewards(spark, sf_dir):
    return E.rewards(logps(spark, sf_dir)).select("id", "chosen_reward", "rejected_reward", "margin")


@query("sigmoid_loss", _loss(f"round({_SIGMOID}, 9)"))
def sigmoid_loss(spark, sf_dir):
    return E.loss(logps(spark, sf_dir), "sigmoid").select("id", F.round("loss", 9).alias("loss"))


@query("ipo_loss", _loss("(delta - 4) * (delta - 4)"))
def ipo_loss(spark, sf_dir):
    return E.loss(logps(spark, sf_dir), "ipo").select("id", "loss")


@query("hinge_loss", _loss("greatest(0, 1 - 0.125 * delta)"))
def hinge_loss(spark, sf_dir):
    return E.loss(logps(spark, sf_dir), "hinge").select("id", "loss")


@query(
    "evaluation_summary",
    S.with_(S.LOGPS, _REWARDS)
    + f"""SELECT split, count(*) AS n, round(avg({_SIGMOID}), 9) AS mean_loss,
      round(avg(chosen_reward), 9) AS mean_chosen_reward, round(avg(rejected_reward), 9) AS mean_rejected_reward,
      round(avg(chosen_reward - rejected_reward), 9) AS mean_margin,
      round(avg(CASE WHEN chosen_reward > rejected_reward THEN 1.0::DOUBLE ELSE 0 END), 9) AS accuracy
      FROM (SELECT *, CASE WHEN substr({S.seeded('id', TRAINING_SEED)}, 1, 8) < '40000000' THEN 'eval'
            ELSE 'train' END AS split FROM rewarded) GROUP BY split""",
)
def evaluation_summary(spark, sf_dir):
    scored = E.loss(E.rewards(split_by_hash(logps(spark, sf_dir), 0.25, TRAINING_SEED, "id")))
    summary = E.eval_summary(scored)
    means = [c for c in summary.columns if c not in ("split", "n")]
    return summary.select("split", "n", *[F.round(c, 9).alias(c) for c in means])


@query(
    "prepared_from_file",
    S.WEAK_JUDGED
    + f""", pairs AS (SELECT prompt, chosen, rejected FROM judged WHERE outcome = 'ok'
        ORDER BY {S.seeded("id", SELECTION_SEED)}, id LIMIT 120),
      keyed AS (SELECT md5(length(prompt) || ':' || prompt || length(chosen) || ':' || chosen || length(rejected) || ':' || rejected)
          || '-' || row_number() OVER (PARTITION BY prompt, chosen, rejected) AS id, prompt, chosen, rejected FROM pairs)
      SELECT id, '<<sys>>{_SYSTEM}<</sys>>[inst]' || prompt || '[/inst]' AS prompt, chosen, rejected,
        CASE WHEN row_number() OVER (ORDER BY {S.seeded("id", TRAINING_SEED)}, id) <= ceil(0.05::DOUBLE * count(*) OVER ())
          THEN 'eval' ELSE 'train' END AS split FROM keyed""",
)
def prepared_from_file(spark, sf_dir):
    """The training table of the first pairs of a pair file, which have no keys of their own."""
    path = scratch_path(spark, "pairs.jsonl")
    ok = Q.accepted(Q.classify(weak_docs(spark, sf_dir)))
    write_pairs(ok, path, [seeded_hash("id", SELECTION_SEED), F.col("id")])
    return prepare_source(spark, path, Training(max_samples=120, family=T.LLAMA), _LLAMA)
