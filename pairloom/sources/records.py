"""Record scans: JSON lines, JSON arrays, named tables, and the dispatch between them."""

from __future__ import annotations

import json
import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.config import PAIR_FIELDS, Fields
from pairloom.functions.text import strip
from pairloom.operators.validate import FieldMappingError
from pairloom.sources.arrays import array_records
from pairloom.sources.paths import first_bytes, is_directory, path_exists, path_size, require_path

POSITION = "position"
_END = "__line_end"
_STRICT_JSON = {"allowSingleQuotes": "false"}
_HEAD = 5


def record_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _as_struct(schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def _position(row: Column | None = None) -> Column:
    """Where a row stands in its input: file, split, row. Rows of one split are numbered in reading order, so sorting
    by this gives back the order of the file. The last field, the split's length, tells other splits apart."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        (F.monotonically_increasing_id() if row is None else row).alias("row"),
        F.col("_metadata.file_block_length").alias("length"),
    ).alias(POSITION)


def with_file_position(df: DataFrame) -> DataFrame:
    """A table read from parquet files with each row's place in them."""
    return df.select("*", _position(F.col("_metadata.row_index")))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.text(require_path(spark, path))
    return text.select(_position(), strip("value").alias("line")).where(F.col("line") != "")


def _parsed_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Every line that is not blank: (position, line, good, record).

    Each line is parsed as the first element of a two-element array whose second element is ours.
    A line is good only if both come back, which also catches text after the closing brace; the
    plain JSON reader stops at the brace and never sees it.
    """
    envelope = T.ArrayType(T.StructType([*schema.fields, T.StructField(_END, T.IntegerType())]))
    wrapped = F.concat(F.lit("["), F.col("line"), F.lit(f',{{"{_END}":1}}]'))
    # explode(array(x)) instead of a plain column: a filter on a column would be pushed below the
    # projection and every line parsed twice.
    parsed = _lines(spark, path).select(
        POSITION, "line", F.explode(F.array(F.from_json(wrapped, envelope, _STRICT_JSON))).alias("r")
    )
    record, end = F.get("r", F.lit(0)), F.get("r", F.lit(1))
    good = F.coalesce((F.array_size("r") == 2) & record.isNotNull() & (end[_END] == 1), F.lit(False))
    return parsed.select(POSITION, "line", good.alias("good"), record.alias("record"))


def read_jsonl(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    strict: bool = False,
    with_position: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """JSON lines as ``(good, bad)``: blank lines are passed over, a malformed line goes to ``bad``
    and the rest go on. With ``strict`` a malformed line ends the job instead."""
    schema = _as_struct(schema)
    parsed = _parsed_lines(spark, path, schema)
    columns = [F.col("record")[f.name].alias(f.name) for f in schema.fields]
    if with_position:
        columns.append(F.col(POSITION))
    if strict:
        where = F.concat(F.lit("Malformed JSON line in "), F.col(POSITION)["file"])
        kept = parsed.select(POSITION, F.when(F.col("good"), F.col("record")).otherwise(F.raise_error(where)).alias("record"))
    else:
        kept = parsed.where("good")
    bad = parsed.where("not good").select(F.col(POSITION)["file"].alias("file"), "line")
    return kept.select(*columns), bad


def read_accounted(spark: SparkSession, path: str, schema: T.StructType | str, blank: Column) -> DataFrame:
    """A JSON file or folder parsed once: every line or record that was read, with its fields, its ``position``,
    its ``kind`` (malformed, blank by the given condition on the fields, or valid) and, if malformed, its ``line``."""
    schema = _as_struct(schema)
    fields = [f.name for f in schema.fields]
    kind = F.when(blank, "blank").otherwise("valid")
    if is_json_array(spark, path):
        rows = read_json_array(spark, path, schema, with_position=True)
        return rows.select(*fields, POSITION, kind.alias("kind"), F.lit(None).cast("string").alias("line"))
    parsed = _parsed_lines(spark, path, schema)
    columns = [F.when(F.col("good"), F.col("record")[f]).alias(f) for f in fields]
    rows = parsed.select(*columns, POSITION, "good", F.when(~F.col("good"), F.col("line")).alias("line"))
    return rows.select(*fields, POSITION, F.when(~F.col("good"), "malformed").otherwise(kind).alias("kind"), "line")


def read_json_array(
    spark: SparkSession, path: str, schema: T.StructType | str, with_position: bool = False
) -> DataFrame:
    """A top-level ``[…]`` of objects per file. A parse error ends the job. A large file is read by many tasks:
    see ``array_records``."""
    schema = _as_struct(schema)
    record = F.from_json("text", schema, {"mode": "FAILFAST", **_STRICT_JSON})
    place = F.struct("file", "block", "row", "length").alias(POSITION)
    # explode(array(x)) instead of a plain column, so that the text is parsed once.
    rows = array_records(spark, path).select(place, F.explode(F.array(record)).alias("r"))
    return rows.select(*[F.col("r")[f.name].alias(f.name) for f in schema.fields], *([POSITION] if with_position else []))


def _array_files(spark: SparkSession, path: str) -> DataFrame:
    """Per file: does its first non-blank character open an array?"""
    first = F.min_by(F.substring("line", 1, 1), F.col(POSITION))
    return _lines(spark, path).groupBy(F.col(POSITION)["file"].alias("file")).agg((first == "[").alias("array"))


def is_json_array(spark: SparkSession, path: str) -> bool:
    """Does every file begin with an array? Files without text say nothing; a folder with arrays and
    JSON lines is rejected. One row per file is counted, two at most come to the driver."""
    require_path(spark, path)
    if is_directory(spark, path):
        forms = {r.array for r in _array_files(spark, path).select("array").distinct().collect()}
        if len(forms) > 1:
            raise ValueError(f"{path} mixes JSON arrays and JSON lines")
        return forms == {True}
    head = _lines(spark, path).select(F.substring("line", 1, 1).alias("c")).first()
    return head is not None and head.c == "["


def read_records(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    strict: bool = False,
    with_position: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """JSON lines or JSON array, whichever the file is; ``(good, bad)`` as in ``read_jsonl``."""
    if is_json_array(spark, path):
        no_bad = spark.createDataFrame([], "file string, line string")
        return read_json_array(spark, path, schema, with_position), no_bad
    return read_jsonl(spark, path, schema, strict, with_position)


def _head_of_arrays(spark: SparkSession, path: str, n: int) -> list[str]:
    """The first n records of the arrays in a file or folder, in order of file names, as text. Of each file only the beginning is read,
    up to the last record wanted, however large it is; what can't be read is left to the scan itself."""
    found, decoder = [], json.JSONDecoder()
    for file in sorted(spark.read.text(path).inputFiles()) if is_directory(spark, path) else [path]:
        wanted, rows, more = 16, [], True
        while more and len(found) < n:
            before, made = len(rows), []
            rows = [r.value for r in spark.read.option("lineSep", "}").text(file).limit(wanted).collect()]
            more, wanted = len(rows) == wanted and len(rows) > before, wanted * 4
            text = "}".join(rows) + "}"
            at = re.match(r"\s*\[?\s*", text.removeprefix("\ufeff")).end() + text.startswith("\ufeff")
            while len(found) + len(made) < n and text.startswith("{", at):
                try:
                    _, end = decoder.raw_decode(text, at)
                except ValueError:
                    break
                made.append(text[at:end])
                at = re.compile(r"\s*,?\s*").match(text, end).end()
            if len(found) + len(made) >= n or not more:
                found += made
        if len(found) >= n:
            break
    return found


def require_fields(spark: SparkSession, path: str, names: list[str], in_each: bool = True) -> None:
    """Check the mapped fields on the first five records of a JSON file or folder by their keys, so that a
    null value counts as present. ``in_each``: every one of the five must have them, else it is
    enough that one does. An empty input passes; only the beginnings of files are read."""
    if is_json_array(spark, path):
        present = [set(json.loads(r)) for r in _head_of_arrays(spark, path, _HEAD)]
    else:
        found = _lines(spark, path).select(F.json_object_keys("line").alias("keys"))
        present = [set(r["keys"]) for r in found.where(F.col("keys").isNotNull()).limit(_HEAD).collect()]
    if not present:
        return
    common = set.intersection(*present) if in_each else set.union(*present)
    missing = [n for n in names if n not in common]
    if missing:
        raise FieldMappingError(missing, sorted(set.union(*present)))


def is_parquet(spark: SparkSession, path: str) -> bool:
    """Do the data files at a path begin as parquet files do? Told from the first bytes of the first of them, not from names."""
    return first_bytes(spark, path, 4) == b"PAR1"


def read_table(spark: SparkSession, name_or_path: str, split: str | None = None) -> DataFrame:
    """A catalog table, or the parquet or JSON-lines files at a path, narrowed to one ``split`` if asked. A table
    without a split column counts as all "train". The filter prunes folders when split is a partition."""
    if path_exists(spark, name_or_path):
        df = spark.read.parquet(name_or_path) if is_parquet(spark, name_or_path) else spark.read.json(name_or_path, mode="FAILFAST")
    else:
        try:
            df = spark.table(name_or_path)
        except AnalysisException as e:
            raise FileNotFoundError(f"No table or path named {name_or_path}") from e
    if split is None:
        return df
    if "split" not in df.columns:
        if split != "train":
            raise ValueError(f"{name_or_path} has no split column, so no split {split!r}")
        return df
    return df.where(F.col("split") == split)


def read_pairs(
    spark: SparkSession, source: str, split: str = "train", fields: Fields = PAIR_FIELDS
) -> DataFrame:
    """A ``.json``/``.jsonl`` name or an existing path is a JSON pair file, read whole and strictly
    (with its row positions); a parquet path or anything else is a table, narrowed to ``split``."""
    if path_exists(spark, source) and is_parquet(spark, source):
        return read_table(spark, source, split)
    if source.endswith((".json", ".jsonl")) or path_exists(spark, source):
        require_fields(spark, source, fields.names, in_each=False)
        names = fields.names + ([fields.key] if fields.key else [])
        return read_records(spark, source, record_schema(names), strict=True, with_position=True)[0]
    return read_table(spark, source, split)


def spread_small(spark: SparkSession, df: DataFrame, path: str, key: str) -> DataFrame:
    """Spread a small input over all cores before heavy text work.

    A small parquet file is often one row group and so one task. The shuffle is worth it only while
    the input is smaller than one read split per core; a larger one already fills the cores, and is
    returned as it is.
    """
    cores = spark.sparkContext.defaultParallelism
    split_bytes = 64 * 1024 * 1024
    if path_size(spark, path) >= cores * split_bytes:
        return df
    return df.repartition(cores, key)
