"""From raw documents to tokens: quality, frequent lines, near duplicates, benchmark leaks, byte-level BPE.

Each stage works on all that the one before has kept, and its result is written and read again. STAGES are
(name, function); a function takes (spark, docs, sf_dir) and returns the documents that stay, with the columns of
documents; the last one returns their tokens. Null and empty texts, null and repeated ids, repeated rows and empty tables are handled
as the stages and operators say; the tables have the columns of documents and no others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import bpe, quality
from pairloom.llm.decontaminate import find_leaks
from pairloom.llm.line_dedup import drop_frequent_lines
from pairloom.llm.ngram_join import similarity_components
from pairloom.llm.queries import bpe_ranks, table
from pairloom.llm.shared import one_of_repeated, shared_path, without, written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are rejected (a score under 0.3) go."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.with_quality(docs, model, score="_score").where("_score >= 0.3").drop("_score")


def rare_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in at least 10 documents go; n_chars follows the text. Documents stay, even if no line is left."""
    kept = drop_frequent_lines(docs, min_docs=10, min_chars=1)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def _named(docs: DataFrame) -> DataFrame:
    """docs with `_row`, 128 bits of the row's whole content: rows are told apart by it, as ids may be null or repeated."""
    content = [x for c in docs.columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return docs.withColumn("_row", F.concat_ws("-", F.xxhash64(*content).cast("string"), F.xxhash64(F.lit(1), *content).cast("string")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by near likeness the one with the smallest doc_id stays (null counts as greatest, ties go by content); of
    wholly repeated rows, one. Rows go by themselves, not by their ids, so a repeated id loses no other text."""
    named = _named(docs)
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "_row").alias("place")
    groups = written(similarity_components(named.select(place, "text"), key="place", size=5, similarity=(80, 100)), "groups")
    kept = without(named, groups.where("place != component_id").select("place._row"), "_row")
    repeated = groups.where("place = component_id").groupBy("place._row").count().where("count > 1").select("_row")
    return one_of_repeated(kept, repeated, "_row").select(docs.columns)


def no_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold an item of the benchmark go."""
    named = _named(docs)
    leaks = find_leaks(named.select("_row", "text"), table(spark, sf_dir, "benchmark"), key="_row")
    return without(named, leaks.select("_row"), "_row").select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document, and the digests of its ids and of the bytes decoded from them."""
    made = bpe.encode(docs, bpe_ranks(), digests=True, offsets=False)
    return made.select("doc_id", "lang", "source", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality", good_quality),
    ("line_dedup", rare_lines),
    ("near_duplicates", one_of_each),
    ("leaks", no_leaks),
    ("tokens", tokens),
]
#: A classifier, a latent space and tokens are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
