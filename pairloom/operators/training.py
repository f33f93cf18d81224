"""What training needs to know about its table: step plan and length budget."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.config import Training
from pairloom.functions.text import word_count


def step_plan(df: DataFrame, cfg: Training = Training()) -> DataFrame:
    """One row: training rows, optimiser steps and warm-up steps. A last partial batch does not
    count, and warm-up is at least one step. Rows marked "eval" are left out."""
    rows = df.where(F.col("split") == "train") if "split" in df.columns else df
    batch = cfg.batch_size * cfg.accumulation
    steps = F.floor(F.col("n_train") / F.lit(batch)) * F.lit(cfg.epochs)
    warmup = F.greatest(F.lit(1).cast("bigint"), F.floor(F.col("total_steps") * F.lit(cfg.warmup_ratio)))
    counted = rows.agg(F.count("*").alias("n_train"))
    return counted.withColumn("total_steps", steps.cast("bigint")).withColumn("warmup_steps", warmup)


def length_budget(
    df: DataFrame,
    max_length: int = Training.max_length,
    count_tokens: Callable[[Column], Column] = word_count,
) -> DataFrame:
    """Flag pairs whose prompt and completion together exceed ``max_length`` tokens. The default
    counter counts words, which only approximates a model's tokenizer; pass your own if it matters."""
    counted = df.select(
        "*",
        count_tokens(F.col("prompt")).alias("prompt_tokens"),
        count_tokens(F.col("chosen")).alias("chosen_tokens"),
        count_tokens(F.col("rejected")).alias("rejected_tokens"),
    )
    over = {
        f"{side}_over": F.col("prompt_tokens") + F.col(f"{side}_tokens") > max_length
        for side in ("chosen", "rejected")
    }
    return counted.withColumns(over)
