"""Order, samples and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import sql as S
from catalog.registry import query
from catalog.tables import sft_docs, table, weak_docs
from pairloom.config import SELECTION_SEED, TRAINING_SEED, Fields
from pairloom.functions.order import seeded_hash
from pairloom.operators import sampling as L
from pairloom.operators.keys import with_content_key
from pairloom.operators.validate import to_pairs
from pairloom.sources.paths import scratch_path
from pairloom.sources.records import POSITION, read_jsonl

_DRAW = S.seeded("doc_id", SELECTION_SEED)


def _docs(spark, sf_dir, *columns):
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), *columns)


@query("seeded_shuffle", f"SELECT doc_id AS id, lang, {_DRAW} AS draw FROM documents ORDER BY draw, doc_id")
def seeded_shuffle(spark, sf_dir):
    ordered = L.shuffle(_docs(spark, sf_dir, "lang"), "id", SELECTION_SEED)
    return ordered.select("*", seeded_hash("id", SELECTION_SEED).alias("draw"))


@query("seeded_sample", f"SELECT doc_id AS id, text FROM documents ORDER BY {_DRAW}, doc_id LIMIT 200")
def seeded_sample(spark, sf_dir):
    return L.sample_n(_docs(spark, sf_dir, "text"), 200, SELECTION_SEED, "id")


@query(
    "seeded_half",
    f"""SELECT doc_id AS id, lang FROM documents
      QUALIFY row_number() OVER (ORDER BY {_DRAW}, doc_id) <= ceil(0.5 * count(*) OVER ())""",
)
def seeded_half(spark, sf_dir):
    """Half of the table by the exact cut, however many rows that is."""
    half = L.split_exact(_docs(spark, sf_dir, "lang"), 0.5, SELECTION_SEED, "id")
    return half.where(F.col("split") == "eval").select("id", "lang")


@query("head_rows", "SELECT doc_id AS id, text FROM documents ORDER BY doc_id LIMIT 100")
def head_rows(spark, sf_dir):
    return L.head_n(_docs(spark, sf_dir, "text"), 100, "id")


@query("quick_test_rows", S.with_(S.WEAK_DOCS) + "SELECT id, rejected FROM weak_docs ORDER BY id LIMIT 75")
def quick_test_rows(spark, sf_dir):
    return L.head_n(weak_docs(spark, sf_dir).select("id", "rejected"), 75, "id")


@query(
    "large_sample",
    f"""SELECT doc_id AS id, text FROM documents
      QUALIFY row_number() OVER (ORDER BY {_DRAW}, doc_id) <= (SELECT 2 * count(*) // 3 FROM documents)""",
)
def large_sample(spark, sf_dir):
    """Two thirds of the table by the seeded order."""
    docs = _docs(spark, sf_dir, "text")
    return L.sample_n(docs, 2 * docs.count() // 3, SELECTION_SEED, "id")


@query("large_head", "SELECT doc_id AS id, text FROM documents ORDER BY doc_id LIMIT (SELECT 4 * count(*) // 5 FROM documents)")
def large_head(spark, sf_dir):
    docs = _docs(spark, sf_dir, "text")
    return L.head_n(docs, 4 * docs.count() // 5, "id")


@query(
    "head_in_file_order",
    """SELECT doc_id AS id, text FROM documents
      QUALIFY row_number() OVER (ORDER BY doc_id) <= (SELECT 3 * count(*) // 5 FROM documents)""",
)
def head_in_file_order(spark, sf_dir):
    """Three fifths of the documents, from JSON lines written in order of their key and cut by their places in the files."""
    path = scratch_path(spark, "ordered.jsonl")
    docs = _docs(spark, sf_dir, "text")
    docs.orderBy("id").write.json(path)
    lines = read_jsonl(spark, path, "id bigint, text string", strict=True, with_position=True)[0]
    return L.head_n(lines, 3 * docs.count() // 5, POSITION).select("id", "text")


def _exact(key: str, seed: int, fraction: float) -> str:
    return f"""CASE WHEN row_number() OVER (ORDER BY {S.seeded(key, seed)}, {key})
      <= ceil({fraction}::DOUBLE * count(*) OVER ()) THEN 'eval' ELSE 'train' END AS split"""


@query("exact_split", f"SELECT doc_id AS id, {_exact('doc_id', TRAINING_SEED, 0.05)} FROM documents")
def exact_split(spark, sf_dir):
    return L.split_exact(_docs(spark, sf_dir), 0.05, TRAINING_SEED, "id")


@query(
    "split_sizes",
    f"""SELECT split, count(*) AS n FROM (SELECT {_exact('doc_id', TRAINING_SEED, 0.05)} FROM documents)
      GROUP BY split""",
)
def split_sizes(spark, sf_dir):
    return L.split_sizes(L.split_exact(_docs(spark, sf_dir), 0.05, TRAINING_SEED, "id"))


@query("no_split", "SELECT doc_id AS id, 'train' AS split FROM documents")
def no_split(spark, sf_dir):
    return L.split_exact(_docs(spark, sf_dir), 0, TRAINING_SEED, "id")


@query(
    "threshold_split",
    f"""SELECT doc_id AS id, CASE WHEN substr({S.seeded('doc_id', TRAINING_SEED)}, 1, 8) < '0ccccccc'
      THEN 'eval' ELSE 'train' END AS split FROM documents""",
)
def threshold_split(spark, sf_dir):
    return L.split_by_hash(_docs(spark, sf_dir), 0.05, TRAINING_SEED, "id")


@query(
    "content_keys",
    S.with_(S.SFT_DOCS)
    + """SELECT md5(length(instruction) || ':' || instruction || length(output) || ':' || output)
        || '-' || row_number() OVER (PARTITION BY instruction, output ORDER BY id) AS id,
      instruction AS prompt, output AS chosen FROM sft_docs""",
)
def content_keys(spark, sf_dir):
    return with_content_key(to_pairs(sft_docs(spark, sf_dir), Fields()))
