"""What the operators have in common: the shared folder, text expressions, bounded membership filters."""

from __future__ import annotations

import ctypes
import string
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pairloom.llm.words import steps_of

#: The characters of `[\x20\x09-\x0D]`.
BLANKS = " \t\n\x0b\x0c\r"
#: Bits of a membership filter: 2 MB in 512 pieces, whatever the input's size.
FILTER_BITS = 1 << 24
#: Texts that a task makes Python strings of at once; an Arrow batch has up to 10,000.
TEXTS = 500


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder named by spark.checkpoint.dir; where that is unset, in the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back: later jobs recompute nothing, nor does a lost executor."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole(text: Column) -> Column:
    """The text, empty for null."""
    return F.coalesce(text.cast("string"), F.lit(""))


def without_blanks(text: Column) -> Column:
    return F.translate(text, BLANKS, "")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, nothing else changed; the faster general function where the text is all ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def fold_of(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo folds; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % F.lit(folds)


def membership(hashes: DataFrame, column: str, bits: int = FILTER_BITS) -> DataFrame:
    """A filter of fixed size over 64-bit hashes: at most bits / 32768 rows (bucket, bitmap) of 4 KB each."""
    place = F.pmod(F.col(column), F.lit(bits)) + F.lit(1)
    return hashes.groupBy(F.bitmap_bucket_number(place).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bitmap")
    )


def with_membership(df: DataFrame, column: str, held: DataFrame, flag: str, bits: int = FILTER_BITS) -> DataFrame:
    """df with a flag that is true wherever the hash is in the filter, and sometimes where it is not.
    The filter has a proven size of bits / 8 bytes, so it is broadcast."""
    place = F.pmod(F.col(column), F.lit(bits)) + F.lit(1)
    bit = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("_bitmap", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return (
        df.withColumn("_bucket", F.bitmap_bucket_number(place))
        .join(F.broadcast(held), "_bucket", "left")
        .withColumn(flag, F.coalesce(F.shiftright(byte, 0).bitwiseAND(F.pow(F.lit(2), bit % 8).cast("int")) != 0, F.lit(False)))
        .drop("_bucket", "_bitmap")
    )


def _parted(df: DataFrame, named: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows of df whose key is surely not among named, and those whose key may be. A bit filter of fixed size lets
    most rows pass where they are."""
    held = membership(named.select(F.xxhash64(F.col(key)).alias("_h")), "_h")
    marked = with_membership(df.withColumn("_key_hash", F.xxhash64(F.col(key))), "_key_hash", held, "_named")
    return marked.where("not _named").select(df.columns), marked.where("_named").select(df.columns)


def without(df: DataFrame, dropped: DataFrame, key: str) -> DataFrame:
    """The rows of df whose key is not among dropped (one column of that name); null keys stay. Only rows
    that the filter names are joined, by merging at any size."""
    gone = written(dropped.where(F.col(key).isNotNull()).distinct(), "dropped")
    passed, named = _parted(df, gone, key)
    return passed.unionByName(named.join(gone.hint("merge"), key, "left_anti").select(df.columns))


def one_of_repeated(df: DataFrame, repeated: DataFrame, key: str) -> DataFrame:
    """df with one row for each key among repeated (one column of that name), and all rows with other keys. Only rows that the
    filter names are shuffled."""
    held = written(repeated, "repeated")
    passed, named = _parted(df, held, key)
    once = named.join(held.hint("merge"), key, "left_semi").dropDuplicates([key])
    return passed.unionByName(named.join(held.hint("merge"), key, "left_anti").select(df.columns)).unionByName(once.select(df.columns))


def _fields(added: str) -> list[T.StructField]:
    return T._parse_datatype_string(added).fields


def give_back() -> None:
    """Freed memory goes back to the system where the allocators can: Spark's Python workers live on, and what they keep counts
    beside all later tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # not glibc
        pass


def giving_back(run: Callable) -> Callable:
    """run, a function from batches to batches, with give_back at the end of each task."""

    def whole_task(batches):
        yield from run(batches)
        give_back()

    return whole_task


def parts_of(batches, rows: int | None = TEXTS, chars: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batches in parts, which share the batch's memory: of at most that many rows; with chars, those of steps over the texts of
    the last column; with neither, the batches as they are."""
    for batch in batches:
        if chars:
            sizes = pc.fill_null(pc.utf8_length(batch.column(batch.num_columns - 1)), 0).to_pylist()
            yield from (batch.slice(a, b - a) for a, b in steps_of(sizes, chars))
        else:
            yield from (batch.slice(x, rows) for x in range(0, batch.num_rows, rows)) if rows else [batch]


def texts_of(batches) -> Iterator[list]:
    """The last column of the batches, TEXTS values at a time."""
    return (part.column(part.num_columns - 1).to_pylist() for part in parts_of(batches))


def add_columns(
    df: DataFrame, text: Column, compute: Callable[[list], list], added: str, keep: list[str] | None = None, rows: int | None = None
) -> DataFrame:
    """df with the columns that compute(texts) gives for each batch of texts (at most `rows` of them), a list of values per column.
    All other columns, or only those of `keep`, pass as Arrow arrays: nulls and large numbers stay as they are."""
    keep = df.columns if keep is None else keep
    schema = T.StructType([df.schema[c] for c in keep] + _fields(added))
    kinds = list(to_arrow_schema(schema))[len(keep) :]

    def run(batches):
        for batch in parts_of(batches, rows):
            made = compute(batch.column(batch.num_columns - 1).to_pylist())
            columns = batch.columns[:-1] + [pa.array(v, k.type) for v, k in zip(made, kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.select(*[F.col(f"`{c}`") for c in keep], text.alias("_whole_text")).mapInArrow(giving_back(run), schema)


def add_rows(
    df: DataFrame, text: Column, compute: Callable[[list], tuple], added: str, keep: list[str] | None = None, rows: int | None = None, chars: int | None = None
) -> DataFrame:
    """For each batch of texts (at most `rows` of them, or a step of so many characters) compute(texts) gives (numbers of rows, columns):
    df's columns of those rows, or only those of `keep`, beside the new ones."""
    keep = df.columns if keep is None else keep
    schema = T.StructType([df.schema[c] for c in keep] + _fields(added))
    kinds = list(to_arrow_schema(schema))[len(keep) :]

    def run(batches):
        for batch in parts_of(batches, rows, chars):
            numbers, made = compute(batch.column(batch.num_columns - 1).to_pylist())
            at = pa.array(numbers, pa.int64())
            columns = [c.take(at) for c in batch.columns[:-1]] + [pa.array(v, k.type) for v, k in zip(made, kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.select(*[F.col(f"`{c}`") for c in keep], text.alias("_whole_text")).mapInArrow(giving_back(run), schema)
