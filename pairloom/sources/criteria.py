"""Review criteria: one session document per file, or one per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.sources.paths import require_path

CRITERIA_SCHEMA = (
    "version bigint, created string, session string, evaluator string, "
    "criteria array<struct<text: string, type: string>>, sampleCount bigint"
)


def read_criteria(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One row per criterion, with its place in the document."""
    documents = (
        spark.read.schema(CRITERIA_SCHEMA)
        .options(multiLine=multi_line, mode="FAILFAST")
        .json(require_path(spark, path))
    )
    return documents.select(
        "session",
        "evaluator",
        "created",
        F.col("sampleCount").alias("sample_count"),
        F.posexplode("criteria").alias("pos", "criterion"),
    ).select("session", "evaluator", "created", "sample_count", "pos", "criterion.text", "criterion.type")
