"""Input views over the given tables, in Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.sources.records import spread_small


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, spread over the cores where the file is too small to be read by all."""
    return spread_small(
        spark, table(spark, sf_dir, "documents"), f"{sf_dir}/documents.parquet", "doc_id"
    )


def _weak_text() -> Column:
    """One weak response per document, of six kinds by the document's number."""
    kind = F.col("doc_id") % 6
    return (
        F.when(kind == 1, "   ")
        .when(kind == 2, F.expr("substr(text, 1, 12)"))
        .when(kind == 3, F.expr("substr(text, 1, cast(length(text) div 20 as int))"))
        .when(kind == 4, F.concat("text", F.lit(" zzz")))
        .when(kind == 5, F.expr("substr(text, 1, cast(length(text) div 2 as int))"))
    )


def sft_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select(
        F.col("doc_id").alias("id"),
        F.concat(F.lit("Retell: "), "text").alias("instruction"),
        F.col("text").alias("output"),
    )


def weak_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished pairs: document head, document, weak response (null for a sixth of them)."""
    return documents(spark, sf_dir).select(
        F.col("doc_id").alias("id"),
        "source",
        F.concat(F.lit("Retell: "), "text").alias("prompt"),
        F.col("text").alias("chosen"),
        _weak_text().alias("rejected"),
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An attempt log of five attempts per document; two in five succeed too late."""
    attempts = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("attempt")
    )
    late = F.col("attempt") < F.col("doc_id") % 5
    return attempts.select(
        F.col("doc_id").alias("id"), "attempt", F.when(~late, _weak_text()).alias("content")
    )


def sft_conv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns and the assistant turn after them. Turns of a conversation are numbered without
    gaps, which is checked, so the next turn is found by an equality on conversation and turn, which
    spreads a very long conversation; a window over the conversation would not."""
    turns = table(spark, sf_dir, "conversations")
    spans = turns.groupBy("conv_id").agg(F.count("*").alias("n"), F.min("turn").alias("a"), F.max("turn").alias("b"))
    if not spans.where("n != b - a + 1").isEmpty():
        raise ValueError("Turns of a conversation must be numbered without gaps or repeats")
    user = turns.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("instruction"))
    reply = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output")
    )
    joined = user.join(reply, ["conv_id", "turn"])
    key = F.concat_ws("-", "conv_id", "turn").alias("id")
    return joined.select(key, "instruction", "output")


def logps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probabilities that are exact in binary, so sums do not depend on their order."""

    def eighths(factor: int, modulus: int, name: str) -> Column:
        return (-((F.col("doc_id") * factor) % modulus) / F.lit(8.0)).alias(name)

    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        eighths(7, 101, "pc"), eighths(11, 103, "pr"), eighths(5, 97, "rc"), eighths(3, 89, "rr"),
    )
