"""A unique key for records that come without one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def content_digest(columns: tuple[str, ...]) -> Column:
    """md5 over the columns, each led by its length so that no two contents run into one."""
    parts = [
        F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-"))
        for c in columns
    ]
    return F.md5(F.concat(*parts))


def with_content_key(
    df: DataFrame,
    columns: tuple[str, ...] = ("prompt", "chosen"),
    name: str = "id",
    chunk: int = 10_000,
) -> DataFrame:
    """``columns`` plus the key ``digest-ordinal``; ordinals run from 1 within equal content.

    Rows of equal content are interchangeable, so they are counted and then written out again
    rather than numbered in a window: the count combines before the shuffle, and however many
    copies one content has, no task ever holds them as a group. A count beyond ``chunk`` is cut
    into chunks that are spread over the cluster before they are written out. The keys depend on
    the content alone. Columns not listed are dropped.
    """
    copies = df.groupBy(*columns).agg(F.count("*").alias("copies"))
    keyed = copies.select(*columns, "copies", content_digest(columns).alias("digest"))

    def numbered(rows: DataFrame, first: Column, last: Column) -> DataFrame:
        rows = rows.select(*columns, "digest", F.explode(F.sequence(first, last)).alias("ordinal"))
        key = F.concat("digest", F.lit("-"), F.col("ordinal").cast("string"))
        return rows.select(key.alias(name), *columns)

    few = numbered(keyed.where(F.col("copies") <= chunk), F.lit(1).cast("bigint"), F.col("copies"))
    # A stated number of tasks: adaptive execution would merge the chunks, which are small until they
    # are written out.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    starts = F.sequence(F.lit(1).cast("bigint"), F.col("copies"), F.lit(chunk).cast("bigint"))
    chunks = (
        keyed.where(F.col("copies") > chunk)
        .select(*columns, "digest", "copies", F.explode(starts).alias("start"))
        .repartition(tasks, "digest", "start")
    )
    many = numbered(chunks, F.col("start"), F.least(F.col("start") + (chunk - 1), F.col("copies")))
    return few.unionByName(many)
