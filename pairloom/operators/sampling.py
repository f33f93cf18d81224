"""Seeded order, samples, head limits and train/eval splits.

Nothing here sorts or numbers a whole table to cut it. A cut at rank n is turned into the value
found at rank n, and the cut itself is then a filter against that literal: narrow, no shuffle, and
the same rows on every later action or recomputation, whatever n and the table's size. Rows come
back in no particular order; ask ``shuffle`` for one. Keys must be unique and not null
(``with_content_key`` makes one): a null key, or equal keys that would leave a cut open, are errors.
The cut is found when the function is called, so a source that grows before the action may give more.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.functions.order import seeded_hash
from pairloom.operators.ranks import images_at_ranks
from pairloom.sources.paths import written_once

# A search for a rank ends in one small sort; this bounds it.
SEARCH_ROWS = 100_000
# A row's place in its file: the block that was read as one split, and the row in it or in the file.
PLACE = ("file", "block", "row", "length")
# Hex digits per round of the search: 4,096 counts, few enough to combine well within each task.
_DIGITS = 3


def _check_n(n: int | None) -> None:
    if n is not None and n < 0:
        raise ValueError(f"A limit must not be negative, got {n}")


def _literal(value) -> Column:
    if isinstance(value, Row):
        return F.struct(*[F.lit(value[name]).alias(name) for name in value.__fields__])
    return F.lit(value)


def _not_unique() -> ValueError:
    return ValueError("The key is not unique: more than one row shares the key at the cut")


def _no_nulls(n: int) -> None:
    if n:
        raise ValueError(f"The key is null in {n} rows; they have no place in the order")


def _pick(values: DataFrame, rank: int) -> object | None:
    """The value at 1-based ``rank`` by a top-k of the values alone; None if there are fewer."""
    at = values.orderBy("k").offset(rank - 1).limit(2).collect()
    if len(at) == 2 and at[0]["k"] == at[1]["k"]:
        raise _not_unique()
    return at[0]["k"] if at else None


def hash_at_rank(hashes: DataFrame, rank_of_total) -> str | None:
    """The n-th smallest of a column ``k`` of md5 strings, where ``rank_of_total(total)`` gives n.
    None if that is all rows (or more); "" if it is none.

    Rows are counted per leading hex digits (at most 4,096 counts, combined before the shuffle); the
    count that passes n names the prefix to look into. md5 spreads unique keys evenly, so each round
    narrows 4,096-fold: two rounds serve some 10^12 rows.
    """
    prefix, rank = "", None
    while True:
        within = hashes.where(F.col("k").startswith(prefix)) if prefix else hashes
        lead = F.substring("k", 1, len(prefix) + _DIGITS).alias("lead")
        counts = within.groupBy(lead).agg(F.count("*").alias("n")).orderBy("lead").collect()
        if rank is None:
            _no_nulls(sum(c.n for c in counts if c.lead is None))
            total = sum(c.n for c in counts)
            rank = rank_of_total(total)
            if rank >= total:
                return None
            if rank <= 0:
                return ""
        for c in counts:
            if rank <= c.n:
                break
            rank -= c.n
        prefix = c.lead
        if c.n <= SEARCH_ROWS:
            return _pick(within.where(F.col("k").startswith(prefix)), rank)
        if len(prefix) >= 32:
            raise _not_unique()


def value_at_rank(df: DataFrame, order: Column, n: int, tasks: int | None = None) -> object | None:
    """The n-th smallest value of a unique ordering column; None if there are fewer rows.

    Only the ordering column is shuffled, by range; each range reports its count and bounds, and
    the range that holds rank n is searched again until it is small.
    """
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values, rank, first = df.select(order.alias("k")), n, True
    while True:
        ranges = (
            values.repartitionByRange(max(tasks, 2), "k")
            .groupBy(F.spark_partition_id().alias("part"))
            .agg(
                F.count("*").alias("n"),
                F.count_if(F.col("k").isNull()).alias("nulls"),
                F.min("k").alias("low"),
                F.max("k").alias("high"),
            )
            .orderBy("low")
            .collect()
        )
        if first:
            _no_nulls(sum(r.nulls for r in ranges))
            first = False
        for r in ranges:
            if rank <= r.n:
                break
            rank -= r.n
        else:
            return None
        values = values.where(F.col("k").between(_literal(r.low), _literal(r.high)))
        if r.n <= SEARCH_ROWS:
            return _pick(values, rank)
        if r.low == r.high:
            raise _not_unique()


def shuffle(df: DataFrame, key: str, seed: int) -> DataFrame:
    """The whole table in seeded order: fixed by seed and key, whatever the partitioning."""
    return df.orderBy(seeded_hash(key, seed), key)


def sample_n(df: DataFrame, n: int | None, seed: int, key: str) -> DataFrame:
    """The first n rows of the seeded order (None: all)."""
    _check_n(n)
    if n is None:
        return df
    if n == 0:
        return df.limit(0)
    order = seeded_hash(key, seed)
    cut = hash_at_rank(df.select(order.alias("k")), lambda total: n)
    return df if cut is None else df.where(order <= cut)


def _integer_at_rank(df: DataFrame, key: str, n: int) -> int | None:
    """The n-th smallest of a unique integer column by counting ranges: no key is shuffled. None if there are
    fewer rows."""
    sizes = df.agg(F.count("*").alias("rows"), F.count(key).alias("keys")).first()
    _no_nulls(sizes["rows"] - sizes["keys"])
    if n >= sizes["rows"]:
        return None
    images = df.select(F.lit(0).alias("column"), F.col(key).cast("bigint").alias("image"))
    at = images_at_ranks(images, lambda total: [n, n + 1])[0][1]
    if at[n] == at[n + 1]:
        raise _not_unique()
    return at[n]


def _in_file_order(df: DataFrame, n: int, position: str) -> DataFrame:
    """The first n rows by their places in files. Rows are counted per file and block, one count per task and block;
    running totals of the counts in order name the block that holds rank n, and only in that block is
    a row looked for. Neither keys nor texts are shuffled, sorted or written.

    The cut is a place, so the files must be read in the same splits again: should a block have
    moved by the time the rows are read, that is an error.
    """
    place = F.col(position)
    blocks = df.groupBy(place["file"].alias("file"), place["block"].alias("block"))
    counts = written_once(blocks.agg(F.count("*").alias("n"), F.max(place["length"]).alias("length")), "block-counts")
    rank = n
    for last in counts.orderBy("file", "block").toLocalIterator():  # a part at a time, up to the block
        if last["file"] is None:
            raise ValueError("Rows without a place in a file have no file order")
        if rank <= last["n"]:
            break
        rank -= last["n"]
    else:
        return df
    inside = (place["file"] == last["file"]) & (place["block"] == last["block"])
    row = _pick(df.where(inside).select(place["row"].alias("k")), rank)
    same_file = place["file"] == last["file"]
    moved = same_file & F.when(place["block"] == last["block"], place["length"] != last["length"]).otherwise(
        (place["block"] < last["block"]) & (place["block"] + place["length"] > last["block"])
    )
    kept = (place["file"] < last["file"]) | same_file & (
        (place["block"] < last["block"]) | (place["block"] == last["block"]) & (place["row"] <= row)
    )
    return df.where(F.when(moved, F.raise_error(F.lit("The file is read in other splits than when it was counted"))).otherwise(kept))


def head_n(df: DataFrame, n: int | None, key: str) -> DataFrame:
    """The first n rows in input order, where ``key`` gives that order (None: all): an integer, a place in a
    file as the readers give it, or any other unique value. The first two are found by counting alone; only
    a key of another type is shuffled, by ranges."""
    _check_n(n)
    if n is None:
        return df
    if n == 0:
        return df.limit(0)
    kind = df.schema[key].dataType
    if isinstance(kind, T.StructType) and kind.names == list(PLACE):
        return _in_file_order(df, n, key)
    cut = _integer_at_rank(df, key, n) if isinstance(kind, T.IntegralType) else value_at_rank(df, F.col(key), n)
    return df if cut is None else df.where(F.col(key) <= _literal(cut))


def split_exact(df: DataFrame, fraction: float | None, seed: int, key: str) -> DataFrame:
    """Add ``split``: the first ``ceil(fraction * n)`` rows of the seeded order are "eval", the rest
    "train". No fraction, or none above zero, makes everything "train"."""
    if not fraction or fraction <= 0:
        return df.withColumn("split", F.lit("train"))
    if fraction >= 1:
        raise ValueError(f"fraction must be below 1, got {fraction}")
    order = seeded_hash(key, seed)

    def eval_rows(total: int) -> int:
        n = math.ceil(fraction * total)
        if total and n >= total:
            raise ValueError(f"An eval share of {fraction} leaves no training rows out of {total}")
        return n

    cut = hash_at_rank(df.select(order.alias("k")), eval_rows)
    return df.withColumn("split", F.when(order <= F.lit(cut or ""), "eval").otherwise("train"))


def split_by_hash(df: DataFrame, fraction: float | None, seed: int, key: str) -> DataFrame:
    """Add ``split`` by comparing each row's hash with a fixed threshold. The share is approximate,
    but no row ever changes sides as the table grows, and nothing is counted beforehand."""
    if not fraction or fraction <= 0:
        return df.withColumn("split", F.lit("train"))
    if fraction >= 1:
        raise ValueError(f"fraction must be below 1, got {fraction}")
    threshold = format(int(fraction * 2**32), "08x")
    is_eval = F.substring(seeded_hash(key, seed), 1, 8) < threshold
    return df.withColumn("split", F.when(is_eval, "eval").otherwise("train"))


def split_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("n"))
