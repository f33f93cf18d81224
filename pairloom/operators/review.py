"""Review of finished pairs: side-by-side view, statistics, histograms, rating sheets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.config import SELECTION_SEED
from pairloom.functions.once import computed_once
from pairloom.functions.text import length_ratio, overlap, tokens
from pairloom.operators.ranks import ordered_image, percentiles
from pairloom.operators.sampling import sample_n
from pairloom.sources.paths import written_once

MEASURES = ("chosen_chars", "rejected_chars", "length_ratio", "jaccard")


def _measured(pairs: DataFrame) -> DataFrame:
    worded = pairs.select(
        "*", tokens("chosen").alias("_chosen_words"), tokens("rejected").alias("_rejected_words")
    )
    return worded.select(
        *pairs.columns,
        F.length("chosen").alias("chosen_chars"),
        F.length("rejected").alias("rejected_chars"),
        length_ratio("chosen", "rejected").alias("length_ratio"),
        overlap("_chosen_words", "_rejected_words").alias("jaccard"),
    )


def review_view(pairs: DataFrame) -> DataFrame:
    """Every pair with both texts and the four measures a reviewer looks at."""
    return computed_once(_measured(pairs), *MEASURES)


def pair_stats(pairs: DataFrame, probabilities: tuple[float, float, float] = (0.1, 0.5, 0.9)) -> DataFrame:
    """Per measure: count, min, mean, max and the percentiles p10, p50, p90, all of the exact values; nulls
    do not count, and a measure without values has nulls.

    The measures are written once, without the texts. One aggregation gives the plain statistics, and the ranks of
    all percentiles are found together by counting ranges of values: no group receives a measure's values.
    The statistics are taken when the function is called.
    """
    x = [F.col(m).cast("double") for m in MEASURES]
    numbers = _measured(pairs).select(*[v.alias(m) for v, m in zip(x, MEASURES)])
    images = [F.when(F.col(m).isNotNull(), ordered_image(F.col(m))).alias(f"{m}_image") for m in MEASURES]
    measured = written_once(numbers.select("*", *images), "measures")
    plain = measured.agg(*[f(m).alias(f"{f.__name__}_{m}") for m in MEASURES for f in (F.count, F.min, F.avg, F.max)]).first()
    columns = [F.struct(F.lit(i).alias("column"), F.col(f"{m}_image").alias("image")) for i, m in enumerate(MEASURES)]
    listed = measured.select(F.explode(F.array(*columns)).alias("c")).select("c.column", "c.image")
    found = percentiles(listed.where("image is not null"), probabilities)
    rows = []
    for i, m in enumerate(MEASURES):
        quantiles = found[i][1] if i in found else [None] * len(probabilities)
        rows.append((m, plain[f"count_{m}"], plain[f"min_{m}"], plain[f"avg_{m}"], plain[f"max_{m}"], *quantiles))
    schema = "measure string, n bigint, min double, mean double, max double, p10 double, p50 double, p90 double"
    return pairs.sparkSession.createDataFrame(rows, schema)


def histogram(pairs: DataFrame, column: str | Column, n_bins: int) -> DataFrame:
    """Counts in ``n_bins`` equal bins over [0, 1]; the last bin also takes 1 and anything above."""
    if n_bins < 1:
        raise ValueError("n_bins must be at least 1")
    column = F.col(column) if isinstance(column, str) else column
    last = F.lit(n_bins - 1).cast("bigint")
    bin_ = F.least(F.floor(column * F.lit(float(n_bins))), last)
    return pairs.groupBy(bin_.alias("bin")).agg(F.count("*").alias("n"))


def _one_session(criteria: DataFrame) -> int | None:
    """The sample count of criteria that must be of exactly one session."""
    heads = criteria.select("session", "sample_count").distinct().limit(2).collect()
    if len(heads) != 1:
        raise ValueError("The criteria document holds no criteria" if not heads else "The criteria are of more than one session")
    return heads[0].sample_count


def calibration_sample(
    pairs: DataFrame, criteria: DataFrame, key: str = "id", seed: int = SELECTION_SEED
) -> DataFrame:
    """As many pairs as the criteria document asks for, by the seeded order."""
    n = _one_session(criteria)
    if n is None or n < 0:
        raise ValueError(f"The criteria document must give a sample count, got {n}")
    return sample_n(pairs, n, seed, key)


def review_sheet(sample: DataFrame, criteria: DataFrame) -> DataFrame:
    """Every sampled pair under every criterion, with a rating still to be given.

    The criteria of one session are gathered into an array and exploded on each pair, which is a
    narrow step on the pairs and needs no join. Criteria of several sessions are an error.
    """
    _one_session(criteria)
    listed = criteria.agg(F.sort_array(F.collect_list(F.struct("pos", "text", "type"))).alias("c")).scalar()
    rows = sample.select("*", F.explode(listed).alias("_criterion"))
    return rows.select(
        *sample.columns,
        F.col("_criterion.pos").alias("pos"),
        F.col("_criterion.text").alias("criterion"),
        F.col("_criterion.type").alias("type"),
        F.lit(None).cast("int").alias("rating"),
    )


def criteria_counts(criteria: DataFrame) -> DataFrame:
    return criteria.groupBy("type").agg(F.count("*").alias("n"))
