"""Implicit rewards and preference losses from a table of log-probabilities.

Columns in: ``pc`` and ``pr`` are the policy's log-probabilities of the chosen and the rejected
response, ``rc`` and ``rr`` the reference model's. Formulas: Rafailov et al. 2023 (reward, sigmoid
loss), Azar et al. 2023 (IPO), Zhao et al. 2023 (hinge).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.config import Training


def rewards(df: DataFrame, beta: float = Training.beta) -> DataFrame:
    b = F.lit(float(beta))
    chosen = b * (F.col("pc") - F.col("rc"))
    rejected = b * (F.col("pr") - F.col("rr"))
    return df.select(
        "*",
        chosen.alias("chosen_reward"),
        rejected.alias("rejected_reward"),
        (chosen - rejected).alias("margin"),
    )


def _delta() -> Column:
    return (F.col("pc") - F.col("rc")) - (F.col("pr") - F.col("rr"))


def loss(df: DataFrame, loss_type: str = Training.loss_type, beta: float = Training.beta) -> DataFrame:
    """Add ``loss``. The sigmoid form never overflows, however large the difference."""
    b, delta = F.lit(float(beta)), _delta()
    x = b * delta
    if loss_type == "sigmoid":
        value = F.log1p(F.exp(-F.abs(x))) + F.greatest(-x, F.lit(0.0))
    elif loss_type == "ipo":
        value = F.pow(delta - F.lit(1 / (2 * beta)), F.lit(2.0))
    elif loss_type == "hinge":
        value = F.greatest(F.lit(0.0), F.lit(1.0) - x)
    else:
        raise ValueError(f"unknown loss type {loss_type!r}")
    return df.withColumn("loss", value)


def eval_summary(df: DataFrame) -> DataFrame:
    """Per split: mean loss, rewards and margin, and the share of pairs ranked the right way."""
    right = F.when(F.col("chosen_reward") > F.col("rejected_reward"), 1.0).otherwise(0.0)
    return df.groupBy("split").agg(
        F.count("*").alias("n"),
        F.avg("loss").alias("mean_loss"),
        F.avg("chosen_reward").alias("mean_chosen_reward"),
        F.avg("rejected_reward").alias("mean_rejected_reward"),
        F.avg("margin").alias("mean_margin"),
        F.avg(right).alias("accuracy"),
    )
