"""The ordered quality cascade over (chosen, rejected) and the counts of its outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.config import READY_AT, Quality
from pairloom.functions.once import computed_once
from pairloom.functions.text import length_ratio, overlap, strip, tokens, two_decimals

OK, FAILED = "ok", "failed"
EMPTY, TOO_SHORT, RATIO, SIMILAR = "empty", "too_short", "ratio", "similar"
EVIDENCE = ("n_chars", "length_ratio", "jaccard")


def classify(
    df: DataFrame,
    cfg: Quality = Quality(),
    missing: str = FAILED,
    evidence: bool = False,
) -> DataFrame:
    """Add ``outcome`` and its evidence ``n_chars``, ``length_ratio``, ``jaccard``.

    The rules run in order and the first that hits names the outcome. ``missing`` is the outcome of
    a null response: "failed" where generation gave none, "empty" for a finished pair file.
    Word overlap is the dear rule, so texts are split into words only on rows the earlier rules let
    through; ``jaccard`` is null on the others unless ``evidence`` asks for it on every row.

    A narrow projection, no shuffle. The steps are separate selects because each feeds the next
    more than once, and Catalyst keeps such projections apart instead of repeating the work.
    """
    rejected = F.col("rejected")
    measured = df.select(
        "*",
        F.length(strip(rejected)).alias("n_chars"),
        length_ratio("chosen", rejected).alias("length_ratio"),
    )

    # Null is tested first: null < n is null and would fall through to ok.
    cheap = F.when(rejected.isNull(), missing).when(F.col("n_chars") == 0, EMPTY)
    if cfg.min_rejected_length:
        cheap = cheap.when(F.col("n_chars") < cfg.min_rejected_length, TOO_SHORT)
    if cfg.min_length_ratio:
        cheap = cheap.when(F.col("length_ratio") < F.lit(float(cfg.min_length_ratio)), RATIO)
    sifted = measured.select("*", cheap.alias("_cheap"))

    if not (cfg.skip_if_too_similar or evidence):
        result = sifted.select("*", F.lit(None).cast("double").alias("jaccard"))
    else:
        needed = rejected.isNotNull() if evidence else F.col("_cheap").isNull()
        worded = sifted.select(
            "*",
            F.when(needed, tokens("chosen")).alias("_chosen_words"),
            F.when(needed, tokens(rejected)).alias("_rejected_words"),
        )
        similarity = F.when(
            F.col("_chosen_words").isNotNull(), overlap("_chosen_words", "_rejected_words")
        )
        result = worded.select("*", similarity.alias("jaccard"))

    outcome = F.col("_cheap")
    if cfg.skip_if_too_similar:
        too_similar = F.col("jaccard") > F.lit(float(cfg.similarity_threshold))
        outcome = F.coalesce(outcome, F.when(too_similar, SIMILAR))
    outcome = F.coalesce(outcome, F.lit(OK))
    judged = result.select(*df.columns, outcome.alias("outcome"), *EVIDENCE)
    return computed_once(judged, "outcome", *EVIDENCE)


def reason_text() -> Column:
    """The outcome in words, with the figure that decided it; empty for accepted pairs."""
    # The wording of the reasons.
    return (
        F.when(F.col("outcome") == EMPTY, "empty response")
        .when(F.col("outcome") == TOO_SHORT, F.concat(F.lit("too short ("), "n_chars", F.lit(" chars)")))
        .when(
            F.col("outcome") == RATIO,
            F.concat(F.lit("length ratio too low ("), two_decimals("length_ratio"), F.lit(")")),
        )
        .when(
            F.col("outcome") == SIMILAR,
            F.concat(F.lit("too similar to chosen (Jaccard="), two_decimals("jaccard"), F.lit(")")),
        )
        .otherwise("")
    )


def _is_skipped() -> Column:
    return ~F.col("outcome").isin(OK, FAILED)


def accepted(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("outcome") == OK)


def skipped(classified: DataFrame) -> DataFrame:
    """Rows a rule rejected. A row without any response failed; it was not skipped."""
    return classified.where(_is_skipped())


def outcome_counts() -> list[Column]:
    """The four run counters, for an aggregate or an observation."""
    return [
        F.count("*").alias("total"),
        F.count_if(F.col("outcome") == OK).alias("written"),
        F.count_if(_is_skipped()).alias("skipped"),
        F.count_if(F.col("outcome") == FAILED).alias("failed"),
    ]


def run_summary(classified: DataFrame) -> DataFrame:
    return classified.agg(*outcome_counts())


def skip_breakdown(classified: DataFrame) -> DataFrame:
    return skipped(classified).groupBy("outcome").agg(F.count("*").alias("n"))


def readiness(summary: DataFrame) -> DataFrame:
    """Is there enough for a calibration session? ``none``, ``too_few`` or ``ready``."""
    written = F.col("written")
    band = F.when(written == 0, "none").when(written < READY_AT, "too_few").otherwise("ready")
    return summary.withColumn("band", band)
