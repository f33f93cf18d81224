"""The operators as queries over the given tables, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import bpe, html_text, quality, token_counts
from pairloom.llm.alignment import aligned_tokens, with_pair_counts
from pairloom.llm.decontaminate import find_leaks
from pairloom.llm.exact_dedup import exact_duplicates
from pairloom.llm.licenses import find_licenses
from pairloom.llm.line_dedup import drop_frequent_lines
from pairloom.llm.lm import score_texts
from pairloom.llm.ngram_join import similarity_components
from pairloom.llm.periodic import periodic_runs
from pairloom.llm.pii import TYPES, replace_private_data
from pairloom.llm.shared import fold_of, whole

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def tokenizer_file(name: str) -> str:
    """A file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def bpe_ranks() -> str:
    return tokenizer_file("byte_bpe_multi_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op5_line_dedup",
    r"""
    WITH lines AS (
        SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
    ), keyed AS (
        SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
    ), frequent AS (
        SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10
    )
    SELECT doc_id, count(*) AS n_lines, count(f.k) AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (f.k IS NULL), '')) AS kept_sha256
    FROM keyed LEFT JOIN frequent f ON keyed.k = f.k GROUP BY doc_id
    """,
)
def line_dedup(spark, sf_dir):
    kept = drop_frequent_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10, min_chars=1)
    return kept.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.sha2("text", 256).alias("kept_sha256"))


@query(
    "op6_exact_dedup",
    r"""
    WITH forms AS (
        SELECT doc_id, length(coalesce(text, '')) AS n,
            sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents
    )
    SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
        row_number() OVER w = 1 AS kept, text_sha256
    FROM forms WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
    """,
)
def exact_dedup(spark, sf_dir):
    return exact_duplicates(table(spark, sf_dir, "documents"), digest_all=True)


@query("op2_byte_bpe")
def byte_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, bpe_ranks(), arrays=False, digests=True)


@query("op9_quality_nbsvm")
def quality_nbsvm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.with_quality(docs, model).select(
        "doc_id",
        (fold_of(F.col("doc_id"), 5) == 0).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= 0.3).cast("int").alias("predicted"),
    )


@query("op10_ngram_join")
def ngram_join(spark, sf_dir):
    return similarity_components(table(spark, sf_dir, "documents").select("doc_id", "text"), size=5, similarity=(80, 100))


@query("op1_html_text")
def html_main_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op3_private_data")
def private_data(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = replace_private_data(docs, key="a key of the caller")
    count = lambda t: F.coalesce(F.get(F.filter("_entities", lambda e: e["kind"] == t), F.lit(0))["count"], F.lit(0)).alias(f"n_{t}")
    return made.select("doc_id", "text", (F.size("_entities") > 0).alias("changed"), *[count(t) for t in TYPES])


@query("op8_latent_leaks")
def latent_leaks(spark, sf_dir):
    return find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


@query("op7_context_mixing")
def context_mixing(spark, sf_dir):
    return score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op4_license_scan")
def license_scan(spark, sf_dir):
    return find_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _with_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text; in one document of ten, chosen by its key, the words from some place on repeat those of the first period after it."""
    number = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    chosen = docs.where(number % 10 == 0).select(
        "doc_id",
        F.floor(number / 10).alias("g"),
        F.regexp_extract_all(whole(F.col("text")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)).alias("words"),
    )
    sized = chosen.select("*", F.size("words").alias("n")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).otherwise(0).cast("int"))
    rest = F.col("n") - F.col("a")
    sized = sized.withColumn("p", (1 + F.floor(rest / (3 + F.col("g") % 8))).cast("int"))
    head = F.slice("words", F.lit(1), F.col("a"))
    block = F.slice("words", F.col("a") + 1, F.col("p"))
    tail = F.slice(F.flatten(F.array_repeat(block, F.ceil(rest / F.col("p")).cast("int"))), F.lit(1), rest)
    made = sized.select("doc_id", F.array_join(F.concat(head, tail), " ").alias("text"))
    return made.unionByName(docs.where(number % 10 != 0).select("doc_id", "text"))


@query("op11_periodic_runs")
def periodic(spark, sf_dir):
    made = periodic_runs(_with_periods(table(spark, sf_dir, "documents").select("doc_id", "text")))
    by_length = F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r["period"]))
    best = made.select("*", F.array_max(by_length).alias("best"))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    length, period = F.col("best")["length"], F.col("best")["period"]
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best")["col2"]).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(length * 1000 / period).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op12_token_counts")
def prefix_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counts = token_counts.totals(token_counts.prefix_counts(docs, tokenizer_file("byte_bpe_50k.json")))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


@query("op13_token_alignment")
def token_alignment(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    aligned = aligned_tokens(docs, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return with_pair_counts(aligned.withColumn("groups_sha256", digest).drop("groups")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
