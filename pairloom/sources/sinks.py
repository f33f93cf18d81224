"""Sinks. All overwrite, as a rerun replaces the earlier result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation

from pairloom.operators.quality import reason_text


def write_counted(df: DataFrame, metrics: list[Column], write: Callable[[DataFrame], None]) -> dict[str, int]:
    """Write and count in the same job: the named metrics of the rows that were written. The write's last stage counts, so a task
    that is tried again counts once."""
    observation = Observation()
    write(df.observe(observation, *metrics))
    return dict(observation.get)


def write_pairs(df: DataFrame, path: str, order: list[Column] | None = None) -> None:
    """JSON lines with the fields prompt, chosen, rejected in this order; non-ASCII as is. With ``order`` the rows are
    in that order over the files by name and within them, so a reader's positions give it back without sorting."""
    pairs = (df.orderBy(*order) if order else df).select("prompt", "chosen", "rejected")
    pairs.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_skipped(df: DataFrame, path: str, key: str = "id") -> None:
    """The skip log: key, outcome and reason of every filtered row."""
    df.select(key, "outcome", reason_text().alias("reason")).write.mode("overwrite").json(path)


def write_training(df: DataFrame, path: str) -> None:
    """Parquet with one folder per split, so that reading one split skips the other."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)
