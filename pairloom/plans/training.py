"""From finished pairs to the rendered and split training table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from pairloom.config import Training
from pairloom.operators.keys import with_content_key
from pairloom.operators.sampling import head_n, split_exact
from pairloom.operators.templates import format_prompt
from pairloom.operators.validate import require_columns, to_pairs
from pairloom.sources.paths import written_once
from pairloom.sources.records import POSITION, read_pairs


def prepare(df: DataFrame, cfg: Training = Training(), template: Column | str | None = None) -> DataFrame:
    """Limit, check, render, project, split, in this order; returns ``id, prompt, chosen, rejected,
    split``.

    Without a key column the pairs are keyed by content, which costs a shuffle of the texts and a
    table in the shared folder; name a key in ``cfg.fields`` to save both.
    """
    fields = cfg.fields
    if cfg.max_samples is not None:
        order = POSITION if POSITION in df.columns else fields.key
        if order is None:
            raise ValueError("Taking the first rows of a table needs a key column that orders them")
        df = head_n(df, cfg.max_samples, order)
        if order == POSITION:
            df = written_once(df, "first-pairs")  # places hold only for one way of reading
    require_columns(df, fields.names)
    if fields.key and fields.key != "id":
        df = df.withColumn("id", df[fields.key])
    pairs = to_pairs(df, fields, ("id",) if fields.key else ())
    if not fields.key:
        pairs = with_content_key(pairs, ("prompt", "chosen", "rejected"))
    if cfg.eval_split and (cfg.max_samples is not None or not fields.key or POSITION in df.columns):
        # The split is searched for in several passes, which must not repeat the cut or the keying.
        pairs = written_once(pairs, "training-pairs")
    rendered = format_prompt(pairs, cfg.family, template, cfg.system)
    return split_exact(rendered, cfg.eval_split, cfg.seed, "id")


def prepare_source(
    spark: SparkSession, source: str, cfg: Training = Training(), template: Column | str | None = None
) -> DataFrame:
    return prepare(read_pairs(spark, source, cfg.split, cfg.fields), cfg, template)
