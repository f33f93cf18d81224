import hashlib
import json

import pytest
from pyspark.sql import functions as F

from pairloom.operators import sampling as L
from pairloom.operators.keys import with_content_key
from pairloom.sources.records import POSITION, read_jsonl, with_file_position


def draw(seed, key):
    return hashlib.md5(f"{seed}:{key}".encode()).hexdigest()


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(3000).select("id", (F.col("id") * 7 % 11).alias("v"))


@pytest.fixture
def small_limits(monkeypatch):
    """Drive the search in several rounds on small data."""
    monkeypatch.setattr(L, "SEARCH_ROWS", 3)


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_shuffle_order_is_the_hash_order(spark, table):
    want = sorted(range(3000), key=lambda i: (draw(42, i), i))
    assert [r.id for r in L.shuffle(table, "id", 42).collect()] == want
    assert [r.id for r in L.shuffle(table.repartition(7), "id", 42).collect()] == want
    assert [r.id for r in L.shuffle(table, "id", 43).collect()] != want


@pytest.mark.parametrize("n", [0, 1, 5, 6, 777, 2999, 3000, 5000])
def test_large_and_small_samples_agree(table, n, small_limits):
    want = sorted(sorted(range(3000), key=lambda i: draw(42, i))[:n])
    assert ids(L.sample_n(table, n, 42, "id")) == want


@pytest.mark.parametrize("n", [0, 5, 6, 1234, 2999, 3000, 5000])
def test_head(table, n, small_limits):
    assert ids(L.head_n(table.repartition(5), n, "id")) == list(range(min(n, 3000)))


@pytest.mark.parametrize("n", [1, 40, 1000, 1001, 2999])
def test_every_cut_is_a_filter(table, n):
    for df in (L.head_n(table, n, "id"), L.sample_n(table, n, 42, "id")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert df.count() == n and "TakeOrdered" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("n", [1, 900, 1500])
def test_null_keys_are_an_error(spark, n):
    df = spark.range(2000).select(F.when(F.col("id") >= 300, F.col("id")).alias("id"))
    for cut in (lambda: L.sample_n(df, n, 1, "id"), lambda: L.head_n(df, n, "id"), lambda: L.split_exact(df, 0.05, 1, "id")):
        with pytest.raises(ValueError, match="null in 300 rows"):
            cut()


def test_head_by_struct_and_string(spark, small_limits):
    df = spark.range(500).select("id", F.struct(F.lit("f").alias("file"), F.col("id").alias("row")).alias("position"), F.format_string("%05d", "id").alias("name"))
    assert ids(L.head_n(df, 321, "position")) == list(range(321))
    assert ids(L.head_n(df, 321, "name")) == list(range(321))


@pytest.mark.parametrize("split_bytes", ["3k", "20k", "128m"])
def test_head_in_file_order(spark, tmp_path, split_bytes):
    """The same first rows however the files are split, by counts per block alone."""
    texts = {f"{'abc'[f]}.jsonl": [f"line {f} {i} {'é' * (i % 50)}" for i in range(n)] for f, n in enumerate((700, 3, 900))}
    for name, lines in texts.items():
        (tmp_path / name).write_text("\n".join("" if i % 7 == 3 else json.dumps({"a": t}) for i, t in enumerate(lines)))
    want = [t for name in sorted(texts) for i, t in enumerate(texts[name]) if i % 7 != 3]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
        rows = read_jsonl(spark, str(tmp_path), "a string", with_position=True)[0]
        for n in (1, 2, 599, 600, 601, 603, 604, 1200, len(want) - 1, len(want), len(want) + 5):
            head = L.head_n(rows, n, POSITION)
            assert "Exchange" not in head._jdf.queryExecution().executedPlan().toString()
            assert sorted(r.a for r in head.collect()) == sorted(want[:n])
        if split_bytes == "20k":
            head = L.head_n(rows, 800, POSITION)
            spark.conf.set("spark.sql.files.maxPartitionBytes", "3k")
            with pytest.raises(Exception, match="other splits"):
                head.select("a").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_head_of_a_parquet_table_in_file_order(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5000).select((9999 - F.col("id")).alias("v")).repartitionByRange(3, F.desc("v")).sortWithinPartitions(F.desc("v")).write.parquet(path)
    table = with_file_position(spark.read.parquet(path))
    for n in (1, 1700, 4999):
        assert sorted(r.v for r in L.head_n(table, n, POSITION).collect()) == list(range(10_000 - n, 10_000))


def test_integer_heads_shuffle_no_keys(spark):
    keys = spark.range(100_000).select((F.col("id") * 1_000_003 % 2**40 - 2**39).alias("id"))
    held = sorted(r.id for r in keys.collect())
    for n in (1, 77_777, 99_999):
        assert ids(L.head_n(keys, n, "id")) == held[:n]


def test_cut_through_equal_keys_is_an_error(spark, small_limits):
    same = spark.range(100).select(F.lit(1).alias("id"))
    with pytest.raises(ValueError, match="not unique"):
        L.sample_n(same, 50, 1, "id")
    with pytest.raises(ValueError, match="not unique"):
        L.head_n(same, 50, "id")


def test_cut_between_equal_keys_among_others_is_an_error(spark):
    double = spark.range(100).select((F.col("id") / 2).cast("int").alias("id"))
    with pytest.raises(ValueError, match="not unique"):
        L.head_n(double, 51, "id")
    assert ids(L.head_n(double, 50, "id")) == sorted([*range(25)] * 2)
    with pytest.raises(ValueError, match="not unique"):
        L.sample_n(double, 51, 1, "id")


def test_none_and_negative(table):
    assert L.sample_n(table, None, 1, "id") is table and L.head_n(table, None, "id") is table
    for f in (lambda: L.sample_n(table, -1, 1, "id"), lambda: L.head_n(table, -1, "id")):
        with pytest.raises(ValueError):
            f()


@pytest.mark.parametrize("fraction, n", [(0.05, 3000), (0.1, 30), (0.333, 3000), (0.5, 7), (0.001, 10)])
def test_exact_split(table, fraction, n, small_limits):
    import math

    df = table.where(F.col("id") < n)
    split = L.split_exact(df, fraction, 9, "id")
    want = sorted(range(n), key=lambda i: draw(9, i))[: math.ceil(fraction * n)]
    assert ids(split.where("split = 'eval'")) == sorted(want)
    assert ids(split) == list(range(n))
    again = L.split_exact(df.repartition(3), fraction, 9, "id")
    assert ids(again.where("split = 'eval'")) == sorted(want)
    assert "Exchange" not in split._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("fraction", [0, None, -0.5])
def test_split_off(table, fraction):
    for split in (L.split_exact, L.split_by_hash):
        assert split(table, fraction, 1, "id").where("split != 'train'").count() == 0


def test_split_edges(spark, table):
    assert L.split_exact(table.limit(0), 0.05, 1, "id").count() == 0
    with pytest.raises(ValueError):
        L.split_exact(table.where("id = 0"), 0.05, 1, "id")  # nothing left to train on
    for split in (L.split_exact, L.split_by_hash):
        with pytest.raises(ValueError):
            split(table, 1.0, 1, "id")


def test_threshold_split_never_moves_a_row(table):
    first = L.split_by_hash(table.where("id < 1000"), 0.2, 1, "id").where("split = 'eval'")
    grown = L.split_by_hash(table, 0.2, 1, "id").where("split = 'eval' and id < 1000")
    assert ids(first) == ids(grown) and 120 < first.count() < 280


def test_content_keys_of_hot_content(spark):
    """Half of all rows are copies of one record, far more than one chunk holds."""
    df = spark.range(2000).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("p"), (F.col("id") % 50).cast("string"))).alias("prompt"),
        F.lit("c").alias("chosen"),
    )
    made = with_content_key(df, chunk=64)
    per_task = [r["count"] for r in made.where("prompt = 'hot'").groupBy(F.spark_partition_id()).count().collect()]
    assert max(per_task) <= 500  # the copies do not end up in one task
    keyed = made.collect()
    assert len(keyed) == 2000 == len({r.id for r in keyed})
    hot = sorted(int(r.id.split("-")[1]) for r in keyed if r.prompt == "hot")
    assert hot == list(range(1, 1001))
    assert {r.id for r in with_content_key(df.repartition(3)).collect()} == {r.id for r in keyed}


def test_content_keys_tell_contents_apart(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), ("a", None), (None, "a"), ("", "a"), ("1:a", "")], "prompt string, chosen string")
    assert len({r.id for r in with_content_key(df).collect()}) == 6
