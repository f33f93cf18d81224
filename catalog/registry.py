"""Where queries and their SQL are collected."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from pairloom.sources.paths import WORK_FOLDER

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _with_folder(fn: Query, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries that write keep to the session's warehouse where no checkpoint folder is set."""
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.conf.get(WORK_FOLDER, None):
        spark.conf.set(WORK_FOLDER, spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work")
    return fn(spark, sf_dir)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = partial(_with_folder, fn)
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
