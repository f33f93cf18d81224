import numpy as np
import pytest
from pyspark.sql import functions as F

from catalog.review import _criteria
from catalog.tables import weak_docs
from pairloom.operators import ranks
from pairloom.operators import review as R
from pairloom.sources.paths import written_once


@pytest.fixture(scope="module")
def pairs(spark, sf_dir):
    return weak_docs(spark, sf_dir).where("rejected is not null").cache()


def test_statistics_against_numpy(pairs):
    view = R.review_view(pairs).toPandas()
    for row in R.pair_stats(pairs).collect():
        x = view[row.measure].astype(float)
        assert (row.n, row.min, row.max) == (len(x), x.min(), x.max())
        assert row["mean"] == pytest.approx(x.mean())
        assert [row.p10, row.p50, row.p90] == pytest.approx(list(np.quantile(x, [0.1, 0.5, 0.9])), rel=1e-14)


def test_statistics_of_one_value_in_most_rows(spark):
    """A value that holds most rows is one weighted row to the search for ranks."""
    df = spark.range(5000).select(
        F.lit("a b").alias("chosen"), F.when(F.col("id") % 10 == 0, F.repeat(F.lit("y "), (F.col("id") % 97).cast("int"))).otherwise("a b").alias("rejected")
    )
    stats = {r.measure: r for r in R.pair_stats(df).collect()}
    assert stats["jaccard"].p50 == 1.0 and stats["jaccard"].p10 < 1.0
    assert stats["chosen_chars"].p10 == stats["chosen_chars"].p90 == 3.0


def test_statistics_of_nothing(spark):
    none = spark.createDataFrame([(None, None), (None, "x")], "chosen string, rejected string")
    for df in (none, none.limit(0)):
        stats = {r.measure: r for r in R.pair_stats(df).collect()}
        assert set(stats) == set(R.MEASURES) and (stats["jaccard"].n, stats["jaccard"].p50, stats["jaccard"]["mean"]) == (0, None, None)


def test_values_at_ranks(spark):
    """Values of both signs and all sizes, both zeros, infinities, one value in a third of the rows."""
    rng = np.random.default_rng(3)
    spread = rng.standard_normal(4000) * 10.0 ** rng.integers(-300, 300, 4000)
    many = np.where(rng.random(3000) < 0.35, 0.1, rng.random(3000))
    columns = [spread, many, np.array([0.0, -0.0, np.inf, -np.inf, 5e-324, -5e-324, 1.0]), np.nextafter(1.0, 2.0) + np.arange(3000) * 2.0**-52, np.array([7.5])]
    rows = [(i, float(x)) for i, c in enumerate(columns) for x in c]
    table = spark.createDataFrame(rows, "column int, x double").repartition(7).select("column", ranks.ordered_image(F.col("x")).alias("image"))
    images = written_once(table, "images")
    at = {i: sorted({1, len(c), *rng.integers(1, len(c) + 1, 25).tolist()}) for i, c in enumerate(columns)}
    sizes = {len(c): i for i, c in enumerate(columns)}
    assert len(sizes) == 4  # two columns have the same length and are asked for the same ranks
    got = ranks.images_at_ranks(images, lambda n: at[sizes[n]])
    for i, c in enumerate(columns):
        held = np.sort(c)
        wanted = at[sizes[len(c)]]
        assert got[i][0] == len(c) and {r: ranks.value_of_image(v) for r, v in got[i][1].items()} == {r: held[r - 1] for r in wanted}
    for i, (n, quantiles) in ranks.percentiles(images.where("column in (1, 3, 4)"), (0.0, 0.1, 0.5, 0.9, 1.0)).items():
        assert n == len(columns[i]) and quantiles == pytest.approx(list(np.quantile(columns[i], [0, 0.1, 0.5, 0.9, 1])), rel=1e-14)
    assert ranks.percentiles(images.limit(0), (0.5,)) == {}


def test_histogram_covers_every_row(pairs):
    bins = {r.bin: r.n for r in R.histogram(R.review_view(pairs), "jaccard", 10).collect()}
    assert sum(bins.values()) == pairs.count() and set(bins) <= set(range(10))
    ones = pairs.sparkSession.range(5).select(F.lit(1.0).alias("x"))
    assert {r.bin: r.n for r in R.histogram(ones, "x", 10).collect()} == {9: 5}
    with pytest.raises(ValueError):
        R.histogram(pairs, "jaccard", 0)


def test_review_sheet(spark, sf_dir, pairs):
    criteria = _criteria(spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    n = {c: docs.select(c).distinct().count() for c in ("lang", "source")}
    sheet = R.review_sheet(R.calibration_sample(pairs, criteria), criteria)
    rows = sheet.collect()
    assert len(rows) == 50 * sum(n.values()) == len({(r.id, r.pos) for r in rows})
    assert {r.rating for r in rows} == {None} and {r.type for r in rows} == set(n)
    assert "Join" not in sheet._jdf.queryExecution().executedPlan().toString()
    assert {r.type: r.n for r in R.criteria_counts(criteria).collect()} == n


def test_sample_without_criteria(spark, sf_dir, pairs):
    with pytest.raises(ValueError):
        R.calibration_sample(pairs, _criteria(spark, sf_dir).limit(0))


def test_criteria_of_one_session_with_a_count(spark):
    names = "session string, sample_count bigint, pos int, text string, type string"
    pairs = spark.range(9).selectExpr("id", "'c' chosen", "'r' rejected")
    one = spark.createDataFrame([("s", 3, 0, "a", "primary"), ("s", 3, 1, "b", "anti")], names)
    assert R.calibration_sample(pairs, one).count() == 3 and R.review_sheet(pairs, one).count() == 18
    two = one.unionByName(spark.createDataFrame([("t", 3, 0, "a", "primary")], names))
    for bad in (one.where("false"), two):
        for f in (lambda: R.calibration_sample(pairs, bad), lambda: R.review_sheet(pairs, bad)):
            with pytest.raises(ValueError):
                f()
    for n in (None, -1):
        with pytest.raises(ValueError):
            R.calibration_sample(pairs, spark.createDataFrame([("s", n, 0, "a", "primary")], names))
