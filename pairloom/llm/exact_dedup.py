"""Exact duplicates by progressive refinement: length, then a hash of the beginning, then a hash of the whole.

Texts are equal when they are identical without blanks. Rows are grouped by the length of that form;
only where a length occurs twice are they grouped by length and prefix hash; only where that pair occurs
twice is the whole content hashed and grouped. Every grouping combines before its shuffle, so a group
that holds a third of all rows arrives as one row per task. Which lengths and pairs survive is told
to the scan by a bit filter of fixed size, so no text is ever shuffled; a false hit only costs one more hash.
DataFrame functions throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.shared import membership, whole, with_membership, without_blanks, written


def exact_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", prefix: int = 64, digest_all: bool = False
) -> DataFrame:
    """One row per row of docs: key, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points stays, then the smallest key (null last), then the
    earliest row; so of wholly repeated rows just one has kept = true. Null text counts as empty; empty
    and blank texts are equal. text_sha256 is of the text without blanks, null for texts that are
    alone by length or prefix unless digest_all. An empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(key).alias("_key"), whole(F.col(text)).alias("_text"))
    form = without_blanks(F.col("_text"))
    by_length = F.xxhash64(F.length("_form"))
    by_prefix = F.xxhash64(F.length("_form"), F.substring("_form", 1, prefix))

    first = written(
        rows.select(form.alias("_form")).select(by_length.alias("length_hash"), by_prefix.alias("prefix_hash")), "op6-keys"
    )
    lengths = first.groupBy("length_hash").count().where("count > 1")
    same_length = with_membership(first, "length_hash", membership(lengths, "length_hash"), "_hit").where("_hit")
    prefixes = written(membership(same_length.groupBy("prefix_hash").count().where("count > 1"), "prefix_hash"), "op6-prefixes")

    scanned = rows.select("_key", F.length("_text").alias("_length"), form.alias("_form")).withColumn("_prefix", by_prefix)
    digest = F.sha2(F.col("_form"), 256)
    hashed = written(
        with_membership(scanned, "_prefix", prefixes, "_several").select(
            "_key",
            "_length",
            "_several",
            F.length("_form").alias("_form_length"),
            (digest if digest_all else F.when(F.col("_several"), digest)).alias("text_sha256"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "op6-hashed",
    )
    rank = F.struct((-F.col("_length")).alias("a"), F.col("_key").isNull().alias("b"), F.col("_key").alias("c"), F.col("_row").alias("d"))
    groups = (
        hashed.where("_several")
        .groupBy(F.col("_form_length").alias("_g_length"), F.col("text_sha256").alias("_g_sha"))
        .agg(F.count("*").alias("_size"), F.min(rank).alias("_first"))
        .where("_size > 1")
    )
    # A text that is alone has no group to look for, so it does not take part in the join.
    alone = hashed.where("not _several").select(
        F.col("_key").alias(key), F.col("_key").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    # The join's large side is split by adaptive execution where one group is hot: its other side has one row a group.
    several = (
        hashed.where("_several")
        .join(groups, (F.col("_form_length") == F.col("_g_length")) & (F.col("text_sha256") == F.col("_g_sha")), "left")
        .select(
            F.col("_key").alias(key),
            F.when(F.col("_size").isNull(), F.col("_key")).otherwise(F.col("_first.c")).alias("keep_id"),
            F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
            F.coalesce(F.col("_first.d") == F.col("_row"), F.lit(True)).alias("kept"),
            "text_sha256",
        )
    )
    return alone.unionByName(several)
