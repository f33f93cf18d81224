"""Column checks, canonical projection, blank-record removal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.config import Fields
from pairloom.functions.text import is_blank


class FieldMappingError(ValueError):
    """The mapped field names do not fit the data."""

    def __init__(self, missing: list[str], found: list[str]):
        super().__init__(f"Missing fields {missing}; the data has {found}. Change the field mapping.")
        self.missing, self.found = missing, found


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise FieldMappingError(missing, df.columns)
    return df


def to_pairs(df: DataFrame, fields: Fields, keep: tuple[str, ...] = ()) -> DataFrame:
    """Mapped columns under their canonical names; every other column goes, but for ``keep``."""
    renamed = [F.col(fields.prompt).alias("prompt"), F.col(fields.chosen).alias("chosen")]
    if fields.rejected is not None:
        renamed.append(F.col(fields.rejected).alias("rejected"))
    return df.select(*keep, *renamed)


def complete(prompt: str, chosen: str) -> Column:
    """Is there some text on both sides?"""
    return ~is_blank(prompt) & ~is_blank(chosen)


def drop_blank(df: DataFrame, prompt: str = "prompt", chosen: str = "chosen") -> DataFrame:
    """Keep records with some text on both sides; a missing field counts as blank."""
    return df.where(complete(prompt, chosen))


def drop_blank_stats(df: DataFrame, prompt: str = "prompt", chosen: str = "chosen") -> DataFrame:
    keep = complete(prompt, chosen)
    return df.agg(
        F.count("*").alias("records"), F.count_if(keep).alias("kept"), F.count_if(~keep).alias("dropped")
    )
