"""The pipeline's stages, one by one, against what plain code makes of the same rows."""

import re
from collections import Counter

import pytest

pytest.importorskip("pairloom.llm")
import corpus_pipeline  # noqa: E402
from test_operators import brute_components  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, sf_dir, tmp_path):
    docs, seen = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(str(tmp_path / name))
        seen[name] = (docs, out := spark.read.parquet(str(tmp_path / name)))
        if name != "tokens":
            assert out.columns == COLUMNS and out.schema == docs.schema
        docs = out

    rows = lambda name, k: {r.doc_id: r for r in seen[name][k].collect()}
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    before, kept = rows("quality", 0), rows("quality", 1)
    assert all(kept[i] == before[i] for i in kept)
    assert sum(label.get(i) == 1 for i in before.keys() - kept.keys()) <= 1

    before, kept = rows("line_dedup", 0), rows("line_dedup", 1)
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\v\f\r"))
    found = Counter(k for r in before.values() for k in {key(x) for x in r.text.split("\n")})
    for i, r in before.items():
        text = "\n".join(x for x in r.text.split("\n") if not key(x) or found[key(x)] < 10)
        assert (kept[i].text, kept[i].n_chars) == (text, len(text))

    before, kept = rows("near_duplicates", 0), rows("near_duplicates", 1)
    assert set(kept) == {c for i, _, c in brute_components([(r.doc_id, r.text) for r in before.values()]) if c == i}

    before, kept = rows("leaks", 0), rows("leaks", 1)
    items = [" ".join(r.text.split()) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    whole = {i: " ".join(r.text.split()) for i, r in before.items()}
    assert not any(x in whole[i] for i in kept for x in items)
    # Nothing else goes: what went has most of an item's words in order.
    assert len(before) - len(kept) <= 1.1 * sum(any(x[: len(x) // 2] in t or x[len(x) // 2 :] in t for x in items) for t in whole.values())

    before, kept = rows("tokens", 0), rows("tokens", 1)
    assert before.keys() == kept.keys() and all(len(r.ids) == r.n_tokens for r in kept.values())


def test_odd_tables(spark, sf_dir):
    """Repeated rows, nulls and no rows at all go through every stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    some = docs.where("doc_id < 12")
    odd = some.unionByName(some.where("doc_id = 3")).unionByName(spark.createDataFrame([(None, None, None, None, None), (90, "", None, None, 0)], docs.schema))
    for _, stage in corpus_pipeline.STAGES[1:]:
        out = stage(spark, odd, sf_dir).collect()
        assert len(out) >= 10 and {r.doc_id for r in out} >= {None, 90}
        assert stage(spark, docs.where("false"), sf_dir).count() == 0
    near = corpus_pipeline.one_of_each(spark, odd, sf_dir).collect()
    assert sum(r.doc_id == 3 for r in near) <= 1


def test_rows_go_by_themselves(spark, sf_dir):
    """A repeated id loses no other text; of copies the smallest id stays, a null one only if there is no other; one of repeated rows."""
    texts = {c: " ".join(f"{c}{i}" for i in range(40)) for c in "abcdef"}
    ids = [(5, "a"), (5, "b"), (3, "b"), (None, "c"), (9, "c"), (None, "d"), (None, "d"), (7, "e"), (7, "e"), (None, None), (None, None), (4, None)]
    rows = [(i, texts.get(t), "en", "s", 1) for i, t in ids]
    docs = spark.createDataFrame(rows, spark.read.parquet(f"{sf_dir}/documents.parquet").schema)
    kept = Counter((r.doc_id, (r.text or "")[:1]) for r in corpus_pipeline.one_of_each(spark, docs, sf_dir).collect())
    assert kept == Counter([(5, "a"), (3, "b"), (9, "c"), (None, "d"), (7, "e"), (None, ""), (4, "")])
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first().text
    docs = spark.createDataFrame([(5, texts["a"], "en", "s", 1), (5, f"{texts['b']} {item} {texts['b']}", "en", "s", 1), (None, item, None, None, None)], docs.schema)
    assert [(r.doc_id, r.text) for r in corpus_pipeline.no_leaks(spark, docs, sf_dir).collect()] == [(5, texts["a"])]
