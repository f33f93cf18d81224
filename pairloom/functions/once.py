"""Keep costly columns from being computed more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, *columns: str) -> DataFrame:
    """The same rows and columns, with a line that no filter crosses.

    Catalyst pushes a filter on a computed column below the projection, writing the column's
    expression out in the filter; with expressions built on one another that repeats the dear parts
    many times over. Filters are not pushed through explode of a one-element array, which is what
    this is; it stays within code generation and moves no data.
    """
    rest = [c for c in df.columns if c not in columns]
    held = df.select(*rest, F.explode(F.array(F.struct(*columns))).alias("_once"))
    unpacked = {c: F.col("_once")[c] for c in columns}
    return held.select(*[unpacked[c].alias(c) if c in unpacked else F.col(c) for c in df.columns])
