"""Cleaning, the quality cascade and its counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import sql as S
from catalog.registry import query
from catalog.tables import responses, sft_conv, sft_docs, table, weak_docs
from pairloom.config import Fields, Quality
from pairloom.functions.text import strip
from pairloom.operators import quality as Q
from pairloom.operators.generation import attach, attach_by_prompt, observe_counts
from pairloom.operators.validate import drop_blank, drop_blank_stats, require_columns, to_pairs
from pairloom.plans.curate import Curation, build_pairs, judge
from pairloom.sources.paths import scratch_path
from pairloom.sources.sinks import write_counted

_HALF_BLANK = """half_blank AS (
  SELECT doc_id AS id, CASE doc_id % 4 WHEN 1 THEN '' WHEN 2 THEN chr(160) || chr(9) ELSE text END AS prompt,
         CASE doc_id % 5 WHEN 1 THEN NULL WHEN 2 THEN '  ' ELSE text END AS chosen FROM documents)"""
_KEPT = "doc_id % 4 NOT IN (1, 2) AND doc_id % 5 NOT IN (1, 2)"


def _half_blank(spark, sf_dir):
    def one_of(modulus, first, second):
        rest = F.col("doc_id") % modulus
        return F.when(rest == 1, F.lit(first)).when(rest == 2, F.lit(second)).otherwise(F.col("text"))

    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        one_of(4, "", chr(160) + "\t").alias("prompt"),
        one_of(5, None, "  ").alias("chosen"),
    )


def _records(spark, sf_dir):
    stripped = to_pairs(sft_docs(spark, sf_dir), Fields(), keep=("id",))
    return stripped.withColumns(
        {c: strip(c) for c in ("prompt", "chosen")}
    )


@query(
    "canonical_pairs",
    S.with_(S.SFT_CONV) + "SELECT id, instruction AS prompt, output AS chosen FROM sft_conv",
)
def canonical_pairs(spark, sf_dir):
    records = require_columns(sft_conv(spark, sf_dir), ["instruction", "output"])
    return to_pairs(records, Fields(), keep=("id",))


@query("blank_records_dropped", f"SELECT doc_id AS id, text AS prompt, text AS chosen FROM documents WHERE {_KEPT}")
def blank_records_dropped(spark, sf_dir):
    return drop_blank(_half_blank(spark, sf_dir))


@query(
    "blank_record_counts",
    f"""SELECT count(*) AS records, count(*) FILTER ({_KEPT}) AS kept,
      count(*) FILTER (NOT ({_KEPT})) AS dropped FROM documents""",
)
def blank_record_counts(spark, sf_dir):
    return drop_blank_stats(_half_blank(spark, sf_dir))


@query(
    "quality_cascade",
    S.WEAK_JUDGED + "SELECT id, outcome, n_chars, length_ratio, jaccard FROM judged",
)
def quality_cascade(spark, sf_dir):
    judged = Q.classify(weak_docs(spark, sf_dir), evidence=True)
    return judged.select("id", "outcome", "n_chars", "length_ratio", "jaccard")


@query(
    "cascade_without_length_rules",
    S.with_(S.WEAK_DOCS, S.cascade("weak_docs", None, None)) + "SELECT id, outcome FROM judged",
)
def cascade_without_length_rules(spark, sf_dir):
    cfg = Quality(min_rejected_length=None, min_length_ratio=0)
    return Q.classify(weak_docs(spark, sf_dir), cfg).select("id", "outcome")


@query(
    "cascade_without_similarity",
    S.with_(S.WEAK_DOCS, S.cascade("weak_docs", threshold=None)) + "SELECT id, outcome FROM judged",
)
def cascade_without_similarity(spark, sf_dir):
    return Q.classify(weak_docs(spark, sf_dir), Quality(skip_if_too_similar=False)).select("id", "outcome")


@query(
    "requalified_pairs",
    S.with_(S.WEAK_DOCS, S.cascade("weak_docs", 40, 0.3, 0.5, missing="empty"))
    + "SELECT id, outcome FROM judged",
)
def requalified_pairs(spark, sf_dir):
    stricter = Quality(min_rejected_length=40, min_length_ratio=0.3, similarity_threshold=0.5)
    return Q.classify(weak_docs(spark, sf_dir), stricter, missing="empty").select("id", "outcome")


@query("accepted_pairs", S.WEAK_JUDGED + "SELECT id, prompt, chosen, rejected FROM judged WHERE outcome = 'ok'")
def accepted_pairs(spark, sf_dir):
    judged = Q.classify(weak_docs(spark, sf_dir))
    return Q.accepted(judged).select("id", "prompt", "chosen", "rejected")


@query(
    "skipped_pairs",
    S.WEAK_JUDGED + "SELECT id, outcome, rejected FROM judged WHERE outcome NOT IN ('ok', 'failed')",
)
def skipped_pairs(spark, sf_dir):
    return Q.skipped(Q.classify(weak_docs(spark, sf_dir))).select("id", "outcome", "rejected")


@query(
    "attached_responses",
    S.with_(S.SFT_DOCS, S.RESPONSES, S.FIRST_SUCCESS, S.PAIRS_DOCS)
    + "SELECT id, prompt, chosen, rejected FROM pairs_docs",
)
def attached_responses(spark, sf_dir):
    records = _records(spark, sf_dir)
    return attach(records, responses(spark, sf_dir)).select("id", "prompt", "chosen", "rejected")


_COUNTS = """SELECT count(*) AS total, count(*) FILTER (outcome = 'ok') AS written,
  count(*) FILTER (outcome NOT IN ('ok', 'failed')) AS skipped,
  count(*) FILTER (outcome = 'failed') AS failed"""


@query("run_summary", S.PAIRS_JUDGED + _COUNTS + " FROM judged")
def run_summary(spark, sf_dir):
    return Q.run_summary(judge(_records(spark, sf_dir), responses(spark, sf_dir)))


@query(
    "skip_breakdown",
    S.PAIRS_JUDGED
    + "SELECT outcome, count(*) AS n FROM judged WHERE outcome NOT IN ('ok', 'failed') GROUP BY outcome",
)
def skip_breakdown(spark, sf_dir):
    return Q.skip_breakdown(judge(_records(spark, sf_dir), responses(spark, sf_dir)))


@query(
    "readiness_by_source",
    S.WEAK_JUDGED
    + """SELECT source, written, CASE WHEN written = 0 THEN 'none' WHEN written < 50 THEN 'too_few'
      ELSE 'ready' END AS band FROM (SELECT source, count(*) FILTER (outcome = 'ok') AS written
      FROM judged GROUP BY source)""",
)
def readiness_by_source(spark, sf_dir):
    judged = Q.classify(weak_docs(spark, sf_dir))
    written = F.count_if(F.col("outcome") == Q.OK).alias("written")
    return Q.readiness(judged.groupBy("source").agg(written))


@query("readiness_band", S.WEAK_JUDGED + f"""SELECT *, CASE WHEN written = 0 THEN 'none'
  WHEN written < 50 THEN 'too_few' ELSE 'ready' END AS band FROM ({_COUNTS} FROM judged)""")
def readiness_band(spark, sf_dir):
    return Q.readiness(Q.run_summary(Q.classify(weak_docs(spark, sf_dir))))


@query("observed_outcomes", S.WEAK_JUDGED + "SELECT id, outcome FROM judged")
def observed_outcomes(spark, sf_dir):
    """The classified rows, with the run counters taken along the way."""
    observed, _ = observe_counts(Q.classify(weak_docs(spark, sf_dir)))
    return observed.select("id", "outcome")


@query("observed_counts", S.WEAK_JUDGED + _COUNTS + " FROM judged")
def observed_counts(spark, sf_dir):
    """The run counters as the job that writes the classified rows counts them."""
    path = scratch_path(spark, "classified")
    counts = write_counted(Q.classify(weak_docs(spark, sf_dir)), Q.outcome_counts(), lambda df: df.write.parquet(path))
    return spark.createDataFrame([[counts[n] for n in ("total", "written", "skipped", "failed")]], "total bigint, written bigint, skipped bigint, failed bigint")


_VALID = f"doc_id % 9 > 2 AND trim(text, {S.SPACES}) <> ''"


@query(
    "curation_job",
    S.with_(S.SFT_DOCS.replace("FROM documents)", f"FROM documents WHERE {_VALID})"), S.RESPONSES, S.FIRST_SUCCESS, S.PAIRS_DOCS, S.cascade("pairs_docs"))
    + f"""SELECT *, CASE WHEN written = 0 THEN 'none' WHEN written < 50 THEN 'too_few' ELSE 'ready' END AS band
      FROM ({_COUNTS} FROM judged), (SELECT count(*) FILTER (doc_id % 9 = 0) AS malformed,
        count(*) FILTER (doc_id % 9 <> 0 AND NOT coalesce({_VALID}, false)) AS blank, count(*) AS read FROM documents)""",
)
def curation_job(spark, sf_dir):
    """The whole job, from JSON lines of which a ninth is broken and two ninths lack a side to the counted pair file."""
    source, kind = scratch_path(spark, "instructions.jsonl"), F.col("id") % 9
    output = F.when(kind == 1, "  ").otherwise(F.col("output"))
    instruction = F.when(kind != 2, F.col("instruction"))
    record = F.to_json(F.struct("id", instruction.alias("instruction"), output.alias("output")), {"ignoreNullFields": "false"})
    broken = F.concat(F.lit("{bad "), F.col("id").cast("string"))
    sft_docs(spark, sf_dir).select(F.when(kind == 0, broken).otherwise(record).alias("value")).write.text(source)
    log = responses(spark, sf_dir).withColumn("id", F.col("id").cast("string"))
    cfg = Curation(Fields(key="id"))
    return build_pairs(spark, source, scratch_path(spark, "job"), cfg, responses=log)


@query(
    "pairs_by_prompt",
    f"""SELECT doc_id AS id, trim(substr(text, 1, length(text) // 2), {S.SPACES}) AS rejected FROM documents""",
)
def pairs_by_prompt(spark, sf_dir):
    """Recorded responses that name their prompts, not the keys of records."""
    records = to_pairs(sft_docs(spark, sf_dir), Fields(), keep=("id",))
    half = F.expr("substr(output, 1, cast(length(output) div 2 as int))")
    log = sft_docs(spark, sf_dir).select(
        F.concat(F.lit(" "), "instruction", F.lit("\n")).alias("prompt"), F.explode(F.sequence(F.lit(0), F.lit(1))).alias("attempt"), half.alias("half")
    ).select("prompt", "attempt", F.when(F.col("attempt") == 1, F.col("half")).alias("content"))
    return attach_by_prompt(records, log).select("id", "rejected")
