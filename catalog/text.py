"""Scalar text functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import sql as S
from catalog.registry import query
from catalog.tables import documents, table, weak_docs
from pairloom.functions import text as X
from pairloom.operators.quality import classify, reason_text

_EDGE = "chr(160) || chr(9) || chr(8195)"


@query(
    "unicode_strip",
    f"""SELECT conv_id, turn, trim({_EDGE} || text || chr(12288) || chr(28), {S.SPACES}) AS stripped,
      CAST(length(trim(text, {S.SPACES})) AS INTEGER) AS n FROM conversations""",
)
def unicode_strip(spark, sf_dir):
    padded = F.concat(F.lit(chr(160) + "\t" + chr(8195)), "text", F.lit(chr(12288) + chr(28)))
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", X.strip(padded).alias("stripped"), F.length(X.strip("text")).alias("n")
    )


@query(
    "token_sets",
    f"""SELECT doc_id, CAST(len(w) AS INTEGER) AS words, CAST(len(list_distinct(w)) AS INTEGER) AS distinct_words,
      md5(array_to_string(list_sort(list_distinct(w)), ' ')) AS digest
      FROM (SELECT doc_id, {S.words('text')} AS w FROM documents)""",
)
def token_sets(spark, sf_dir):
    words = documents(spark, sf_dir).select(
        "doc_id", X.word_count("text").alias("words"), X.token_set("text").alias("w")
    )
    digest = F.md5(F.array_join(F.array_sort("w"), " "))
    return words.select("doc_id", "words", F.size("w").alias("distinct_words"), digest.alias("digest"))


@query(
    "word_overlap",
    S.WEAK_JUDGED + "SELECT id, jaccard FROM judged",
)
def word_overlap(spark, sf_dir):
    words = weak_docs(spark, sf_dir).select(
        "id", X.tokens("chosen").alias("a"), X.tokens("rejected").alias("b")
    )
    return words.select("id", X.overlap("a", "b").alias("jaccard"))


@query(
    "length_measures",
    S.with_(S.WEAK_DOCS) + """SELECT id, CAST(length(chosen) AS INTEGER) AS chosen_chars,
      CAST(length(rejected) AS INTEGER) AS rejected_chars,
      length(rejected)::DOUBLE / greatest(length(chosen), 1) AS length_ratio FROM weak_docs""",
)
def length_measures(spark, sf_dir):
    return weak_docs(spark, sf_dir).select(
        "id",
        F.length("chosen").alias("chosen_chars"),
        F.length("rejected").alias("rejected_chars"),
        X.length_ratio("chosen", "rejected").alias("length_ratio"),
    )


@query(
    "reason_texts",
    S.WEAK_JUDGED + f"SELECT id, {S.REASON} AS reason FROM judged",
)
def reason_texts(spark, sf_dir):
    return classify(weak_docs(spark, sf_dir)).select("id", reason_text().alias("reason"))


@query(
    "marker_search",
    """SELECT doc_id, contains(lower(text), 'the') OR contains(text, '@') AS hit,
      contains(text, 'The') AS as_written FROM documents""",
)
def marker_search(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        X.mentions("text", lowered=("the",), raw=("@",)).alias("hit"),
        X.mentions("text", raw=("The",)).alias("as_written"),
    )


@query(
    "fallback_values",
    S.with_(S.WEAK_DOCS) + "SELECT id, coalesce(rejected, '') AS rejected FROM weak_docs",
)
def fallback_values(spark, sf_dir):
    return weak_docs(spark, sf_dir).select("id", X.or_default("rejected", "").alias("rejected"))
