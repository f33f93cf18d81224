"""Scans and sinks, over files written from the given tables into a fresh shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import sql as S
from catalog.registry import query
from catalog.tables import sft_conv, sft_docs, table, weak_docs
from pairloom.config import SELECTION_SEED, Fields
from pairloom.functions.order import seeded_hash
from pairloom.operators import quality as Q
from pairloom.operators.review import criteria_counts as count_criteria
from pairloom.operators.sampling import head_n, split_by_hash
from pairloom.operators.validate import drop_blank, to_pairs
from pairloom.sources import sinks
from pairloom.sources.criteria import read_criteria
from pairloom.sources.paths import scratch_path, written_once
from pairloom.sources.records import (
    POSITION,
    read_json_array,
    read_jsonl,
    read_pairs,
    read_records,
    read_table,
    require_fields,
)

_SCHEMA = "id bigint, instruction string, output string"


def _jsonl_with_faults(spark: SparkSession, sf_dir: str) -> str:
    """Documents as JSON lines of seven kinds: empty, blank, broken, with trailing text, padded, and
    two good ones."""
    path = scratch_path(spark, "records.jsonl")
    record = F.to_json(F.struct("id", "instruction", "output"))
    kind, number = F.col("id") % 7, F.col("id").cast("string")
    line = (
        F.when(kind == 0, "")
        .when(kind == 1, "   ")
        .when(kind == 2, F.concat(F.lit("{bad "), number))
        .when(kind == 3, F.concat(F.lit('{"id":'), number, F.lit("} trailing")))
        .when(kind == 4, F.concat(F.lit(chr(160) + "\t"), record, F.lit("  ")))
        .otherwise(record)
    )
    sft_docs(spark, sf_dir).select(line.alias("value")).write.text(path)
    return path


def _json_arrays(spark: SparkSession, sf_dir: str) -> str:
    """Documents as JSON array files of at most 2,000 records each."""
    path = scratch_path(spark, "records.json")
    chunks = sft_docs(spark, sf_dir).groupBy(F.expr("id div 2000").alias("chunk"))
    array = chunks.agg(F.to_json(F.collect_list(F.struct("id", "instruction", "output"))).alias("value"))
    array.select(F.concat(F.lit("\n  "), "value").alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return path


_ALL = "SELECT doc_id AS id, 'Retell: ' || text AS instruction, text AS output FROM documents"


@query("jsonl_scan", _ALL + " WHERE doc_id % 7 >= 4")
def jsonl_scan(spark, sf_dir):
    return read_jsonl(spark, _jsonl_with_faults(spark, sf_dir), _SCHEMA)[0]


@query(
    "jsonl_bad_lines",
    """SELECT CASE doc_id % 7 WHEN 2 THEN '{bad ' || doc_id ELSE '{"id":' || doc_id || '} trailing' END AS line
      FROM documents WHERE doc_id % 7 IN (2, 3)""",
)
def jsonl_bad_lines(spark, sf_dir):
    return read_jsonl(spark, _jsonl_with_faults(spark, sf_dir), _SCHEMA)[1].select("line")


@query("json_array_scan", _ALL)
def json_array_scan(spark, sf_dir):
    return read_json_array(spark, _json_arrays(spark, sf_dir), _SCHEMA)


@query("split_array_scan", _ALL)
def split_array_scan(spark, sf_dir):
    """The arrays again, read in splits of 64 kB, many to a file."""
    setting = "spark.sql.files.maxPartitionBytes"
    path, before = _json_arrays(spark, sf_dir), spark.conf.get(setting)
    spark.conf.set(setting, "64k")
    try:
        return written_once(read_json_array(spark, path, _SCHEMA), "split-arrays")
    finally:
        spark.conf.set(setting, before)


@query("checked_array_fields", S.with_(S.SFT_CONV) + "SELECT id, instruction AS prompt, output AS chosen FROM sft_conv")
def checked_array_fields(spark, sf_dir):
    path = scratch_path(spark, "conversations.json")
    chunks = sft_conv(spark, sf_dir).groupBy(F.pmod(F.xxhash64("id"), F.lit(16)).alias("chunk"))
    array = chunks.agg(F.to_json(F.collect_list(F.struct("id", "instruction", "output"))).alias("value"))
    array.select("value").write.option("maxRecordsPerFile", 1).text(path)
    require_fields(spark, path, ["instruction", "output"])
    records = read_records(spark, path, _SCHEMA.replace("bigint", "string"))[0]
    return drop_blank(to_pairs(records, Fields(), keep=("id",)))


@query(
    "ordered_pair_file",
    S.WEAK_JUDGED + f"""SELECT prompt, chosen, rejected FROM judged WHERE outcome = 'ok'
      ORDER BY {S.seeded("id", SELECTION_SEED)}, id LIMIT 150""",
)
def ordered_pair_file(spark, sf_dir):
    """Pairs written in the seeded order; the first of them by their places in the files are the seeded sample."""
    path = scratch_path(spark, "ordered.jsonl")
    ok = Q.accepted(Q.classify(weak_docs(spark, sf_dir)))
    sinks.write_pairs(ok, path, [seeded_hash("id", SELECTION_SEED), F.col("id")])
    return head_n(read_pairs(spark, path), 150, POSITION).select("prompt", "chosen", "rejected")


@query("json_table_by_path", "SELECT doc_id AS id, lang FROM documents")
def json_table_by_path(spark, sf_dir):
    """A folder of JSON lines without a telling name, read as a table."""
    path = scratch_path(spark, "unnamed")
    table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang").write.json(path)
    return read_table(spark, path, "train").select("id", "lang")


@query(
    "records_of_either_form",
    f"""SELECT 'array' AS form, * FROM ({_ALL})
      UNION ALL SELECT 'lines' AS form, * FROM ({_ALL} WHERE doc_id % 7 >= 4)""",
)
def records_of_either_form(spark, sf_dir):
    def read(form: str, path: str) -> DataFrame:
        return read_records(spark, path, _SCHEMA)[0].select(F.lit(form).alias("form"), "*")

    lines = read("lines", _jsonl_with_faults(spark, sf_dir))
    return lines.unionByName(read("array", _json_arrays(spark, sf_dir)))


@query("checked_record_fields", S.with_(S.SFT_CONV) + "SELECT id, instruction AS prompt, output AS chosen FROM sft_conv")
def checked_record_fields(spark, sf_dir):
    path = scratch_path(spark, "conversations.jsonl")
    sft_conv(spark, sf_dir).write.json(path)
    require_fields(spark, path, ["instruction", "output"])
    records = read_records(spark, path, _SCHEMA.replace("bigint", "string"))[0]
    return drop_blank(to_pairs(records, Fields(), keep=("id",)))


@query("named_split_scan", f"SELECT doc_id AS id, lang FROM documents WHERE substr({S.seeded('doc_id', 5)}, 1, 8) < '40000000'")
def named_split_scan(spark, sf_dir):
    path = scratch_path(spark, "named")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang")
    sinks.write_training(split_by_hash(docs, 0.25, 5, "id"), path)
    return read_table(spark, path, "eval").select("id", "lang")


@query("pair_file_round_trip", S.WEAK_JUDGED + "SELECT prompt, chosen, rejected FROM judged WHERE outcome = 'ok'")
def pair_file_round_trip(spark, sf_dir):
    path = scratch_path(spark, "pairs.jsonl")
    sinks.write_pairs(Q.accepted(Q.classify(weak_docs(spark, sf_dir))), path)
    return read_pairs(spark, path).select("prompt", "chosen", "rejected")


@query(
    "skip_log_round_trip",
    S.WEAK_JUDGED + f"SELECT id, outcome, {S.REASON} AS reason FROM judged WHERE outcome NOT IN ('ok', 'failed')",
)
def skip_log_round_trip(spark, sf_dir):
    path = scratch_path(spark, "skipped.jsonl")
    sinks.write_skipped(Q.skipped(Q.classify(weak_docs(spark, sf_dir))), path)
    return spark.read.schema("id bigint, outcome string, reason string").json(path)


@query(
    "training_table_round_trip",
    f"""SELECT doc_id AS id, text AS chosen,
      CASE WHEN substr({S.seeded('doc_id', 5)}, 1, 8) < '40000000' THEN 'eval' ELSE 'train' END AS split
      FROM documents""",
)
def training_table_round_trip(spark, sf_dir):
    path = scratch_path(spark, "training")
    docs = weak_docs(spark, sf_dir).select("id", "chosen")
    sinks.write_training(split_by_hash(docs, 0.25, 5, "id"), path)
    return read_table(spark, path).select("id", "chosen", "split")


def _sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review session per document, with two or three criteria, read back as criteria."""
    path = scratch_path(spark, "sessions.jsonl")
    third = F.when(
        F.col("doc_id") % 2 == 0,
        F.array(F.struct(F.concat(F.lit("Is it longer than "), F.col("n_chars").cast("string")).alias("text"), F.lit("anti").alias("type"))),
    ).otherwise(F.array().cast("array<struct<text: string, type: string>>"))
    asked = F.array(
        F.struct(F.concat(F.lit("Is it written in "), "lang").alias("text"), F.lit("primary").alias("type")),
        F.struct(F.concat(F.lit("Does it suit "), "source").alias("text"), F.lit("secondary").alias("type")),
    )
    table(spark, sf_dir, "documents").select(
        F.lit(1).alias("version"),
        F.lit("2026-01-01T00:00:00.000Z").alias("created"),
        F.concat(F.lit("session-"), F.col("doc_id").cast("string")).alias("session"),
        F.col("source").alias("evaluator"),
        F.concat(asked, third).alias("criteria"),
        (F.col("doc_id") % 60).alias("sampleCount"),
    ).write.json(path)
    return read_criteria(spark, path, multi_line=False)


_CRITERIA = """criteria AS (
  SELECT 'session-' || doc_id AS session, source AS evaluator, '2026-01-01T00:00:00.000Z' AS created,
         doc_id % 60 AS sample_count, CAST(pos AS INTEGER) AS pos,
         CASE pos WHEN 0 THEN 'Is it written in ' || lang WHEN 1 THEN 'Does it suit ' || source
              ELSE 'Is it longer than ' || n_chars END AS text,
         CASE pos WHEN 0 THEN 'primary' WHEN 1 THEN 'secondary' ELSE 'anti' END AS type
  FROM documents, range(3) AS r(pos) WHERE pos < 2 OR doc_id % 2 = 0)"""


@query("criteria_scan", S.with_(_CRITERIA) + "SELECT * FROM criteria")
def criteria_scan(spark, sf_dir):
    return _sessions(spark, sf_dir)


@query("criteria_counts", S.with_(_CRITERIA) + "SELECT type, count(*) AS n FROM criteria GROUP BY type")
def criteria_counts(spark, sf_dir):
    return count_criteria(_sessions(spark, sf_dir))
