"""Review of finished pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import sql as S
from catalog.registry import query
from catalog.tables import table, weak_docs
from pairloom.operators import quality as Q
from pairloom.operators import review as R

# A criterion per source of the documents and one per language, made from the table; two types of our own.
_CRITERIA_SQL = """criteria(pos, criterion, type) AS (
  SELECT CAST(row_number() OVER (ORDER BY type, name) - 1 AS INTEGER), 'Fits ' || type || ' ' || name || '?', type
  FROM (SELECT DISTINCT 'source' AS type, source AS name FROM documents WHERE source IS NOT NULL
    UNION SELECT DISTINCT 'lang', lang FROM documents WHERE lang IS NOT NULL))"""
_MEASURED = S.with_(S.WEAK_DOCS, S.cascade("weak_docs"))
_VIEW = """SELECT id, CAST(length(chosen) AS INTEGER) AS chosen_chars,
  CAST(length(rejected) AS INTEGER) AS rejected_chars, length_ratio, jaccard FROM judged"""


def _criteria(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    named = [docs.select(F.lit(c).alias("type"), F.col(c).alias("name")).where("name is not null").distinct() for c in ("lang", "source")]
    held = named[0].unionByName(named[1]).agg(F.sort_array(F.collect_set(F.struct("type", "name"))).alias("held"))
    rows = held.select(F.posexplode("held").alias("pos", "c"))
    return rows.select(
        F.lit("documents").alias("session"),
        F.lit("reader").alias("evaluator"),
        F.lit("2026-01-01T00:00:00.000Z").alias("created"),
        F.lit(50).cast("bigint").alias("sample_count"),
        "pos",
        F.concat(F.lit("Fits "), "c.type", F.lit(" "), "c.name", F.lit("?")).alias("text"),
        "c.type",
    )


@query("side_by_side", _MEASURED + _VIEW.replace("SELECT id,", "SELECT id, chosen, rejected,"))
def side_by_side(spark, sf_dir):
    view = R.review_view(weak_docs(spark, sf_dir))
    return view.select("id", "chosen", "rejected", *R.MEASURES)


def _stats_sql(measure: str) -> str:
    quantiles = ", ".join(f"round(quantile_cont({measure}, {q}), 9) AS {name}" for q, name in ((0.1, "p10"), (0.5, "p50"), (0.9, "p90")))
    return f"""SELECT '{measure}' AS measure, count({measure}) AS n, min({measure})::DOUBLE AS min,
      round(avg({measure}), 9) AS mean, max({measure})::DOUBLE AS max, {quantiles} FROM view"""


def _last_bits_aside(stats):
    """Sums and interpolations may differ in their last bit from engine to engine; the values themselves do not."""
    return stats.select("measure", "n", "min", "max", *[F.round(c, 9).alias(c) for c in ("mean", "p10", "p50", "p90")])


@query(
    "pair_statistics",
    _MEASURED + f", view AS ({_VIEW})\n" + "\nUNION ALL ".join(_stats_sql(m) for m in R.MEASURES),
)
def pair_statistics(spark, sf_dir):
    return _last_bits_aside(R.pair_stats(weak_docs(spark, sf_dir)))


@query(
    "statistics_of_rated",
    _MEASURED
    + f""", view AS (SELECT v.* FROM ({_VIEW}) v JOIN labels ON doc_id = id WHERE quality = 1)\n"""
    + "\nUNION ALL ".join(_stats_sql(m) for m in R.MEASURES),
)
def statistics_of_rated(spark, sf_dir):
    good = table(spark, sf_dir, "labels").where("quality = 1").select(F.col("doc_id").alias("id"))
    return _last_bits_aside(R.pair_stats(weak_docs(spark, sf_dir).join(good, "id", "left_semi")))


def _histogram_sql(measure: str) -> str:
    return _MEASURED + f"""SELECT CAST(least(floor({measure} * 20), 19) AS BIGINT) AS bin, count(*) AS n
      FROM judged GROUP BY 1"""


@query("overlap_histogram", _histogram_sql("jaccard"))
def overlap_histogram(spark, sf_dir):
    return R.histogram(R.review_view(weak_docs(spark, sf_dir)), "jaccard", 20)


@query("ratio_histogram", _histogram_sql("length_ratio"))
def ratio_histogram(spark, sf_dir):
    return R.histogram(R.review_view(weak_docs(spark, sf_dir)), "length_ratio", 20)


_SAMPLE = f"""sample AS (SELECT id, chosen, rejected FROM judged WHERE outcome = 'ok'
  ORDER BY {S.seeded('id', 42)}, id LIMIT 50)"""


def _sample(spark, sf_dir):
    ok = Q.accepted(Q.classify(weak_docs(spark, sf_dir))).select("id", "chosen", "rejected")
    return R.calibration_sample(ok, _criteria(spark, sf_dir))


@query("calibration_sample", f"{_MEASURED}, {_SAMPLE} SELECT * FROM sample")
def calibration_sample(spark, sf_dir):
    return _sample(spark, sf_dir)


@query(
    "review_sheet",
    f"""{_MEASURED}, {_SAMPLE}, {_CRITERIA_SQL}
      SELECT id, pos, criterion, type, CAST(NULL AS INTEGER) AS rating FROM sample, criteria""",
)
def review_sheet(spark, sf_dir):
    return R.review_sheet(_sample(spark, sf_dir), _criteria(spark, sf_dir)).drop("chosen", "rejected")


@query("exported_pairs", S.with_(S.WEAK_DOCS, S.cascade("weak_docs", 40, 0.3, 0.5, missing="empty"))
       + "SELECT prompt, chosen, rejected FROM judged WHERE outcome = 'ok'")
def exported_pairs(spark, sf_dir):
    """Finished pairs judged again by stricter rules, exported and read back."""
    from pairloom.config import Quality
    from pairloom.sources.paths import scratch_path
    from pairloom.sources.records import read_pairs
    from pairloom.sources.sinks import write_pairs

    path = scratch_path(spark, "export.jsonl")
    stricter = Quality(min_rejected_length=40, min_length_ratio=0.3, similarity_threshold=0.5)
    write_pairs(Q.accepted(Q.classify(weak_docs(spark, sf_dir), stricter, missing="empty")), path)
    return read_pairs(spark, path).select("prompt", "chosen", "rejected")
