"""Benchmark leaks by latent semantic retrieval, confirmed by subsequences and answers.

Words are hashed to FEATURES terms, weighted by their inverse document frequency over the whole corpus. The passages of the
benchmark form a sparse matrix; a randomised SVD finds its latent space: a random sketch, power steps and a Gram
matrix, each a sum over Spark's partitions of passages. Documents are cut to overlapping windows of words; a window
whose weight lies mostly outside the benchmark's terms is ruled out by a bound, the others are projected and compared by cosine
with the items, block by block of items. What exceeds the threshold is checked in the text itself: the longest
common subsequence of words with the item, and for looser likeness also the item's answer (its last sentence).
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm.shared import add_rows, giving_back, texts_of, whole, written
from pairloom.llm.words import SHORT_STEP, STEP_CHARS, hashes_of, mix, steps, words_of

FEATURES = 1 << 17
#: Words of a window and from one window to the next.
WINDOW, STRIDE = 32, 16
#: Latent dimensions at most, and how much of the passages' weight they should hold.
RANK, SHARE = 256, 0.95
#: Items whose passages are compared in one pass over the documents; a larger benchmark takes several.
ITEMS = 4000
#: Cosine of a candidate; share of an item's words in common order that confirms it, alone or together with its answer.
COSINE, SURE, LIKELY, ANSWER = 0.3, 0.65, 0.45, 0.8


def _terms(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(24)).astype(np.int64) & (FEATURES - 1)


def document_frequency(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """In how many rows each term occurs, and the number of rows. FEATURES numbers come to the driver."""

    def count(batches):
        held, rows = np.zeros(FEATURES + 1, np.int64), 0
        for texts in texts_of(batches):
            for a, b in steps(texts, SHORT_STEP):
                hashes, offsets, _, _, _ = words_of(texts[a:b])
                row = np.repeat(np.arange(b - a), np.diff(offsets))
                held[:FEATURES] += np.bincount(np.unique(row * FEATURES + _terms(hashes)) % FEATURES, minlength=FEATURES)
            rows += len(texts)
        held[FEATURES] = rows
        there = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(held[there])], names=["term", "n"])

    counted = docs.select(whole(F.col(text)).alias("_text")).mapInArrow(giving_back(count), "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    held = np.zeros(FEATURES + 1, np.int64)
    held[counted["term"]] = counted["n"]
    return held[:FEATURES], int(held[FEATURES])


def inverse_frequency(counts: np.ndarray, rows: int) -> np.ndarray:
    return np.log((rows + 1) / (counts + 1)).clip(0).astype(np.float32)


def _passages(hashes: np.ndarray) -> list[tuple[int, int]]:
    """Windows over one text: from its words' beginning, the last reaching its end."""
    n = len(hashes)
    if n <= WINDOW:
        return [(0, n)] if n else []
    return [(a, a + WINDOW) for a in range(0, n - WINDOW, STRIDE)] + [(n - WINDOW, n)]


def _rows(texts: list[str], idf: np.ndarray):
    """(text number, terms, weights of length 1) of every passage, longer items cut to windows of twice the size."""
    for a, b in steps(texts):
        hashes, offsets, _, _, _ = words_of(texts[a:b])
        for d in range(b - a):
            own = hashes[offsets[d] : offsets[d + 1]]
            for x in range(0, max(1, len(own) - WINDOW), 2 * WINDOW):
                terms, counts = np.unique(_terms(own[x : x + 2 * WINDOW]), return_counts=True)
                weights = np.sqrt(counts) * idf[terms]
                length = np.linalg.norm(weights)
                if length > 0:
                    yield a + d, terms, (weights / length).astype(np.float64)


def _sums(items: DataFrame, text: str, idf, basis) -> dict[int, np.ndarray]:
    """Sum over all passages a of a (a . basis), term by term; basis: (terms -> row, matrix) or the width of a random one."""
    held = items.sparkSession.sparkContext.broadcast((idf, basis))

    def run(batches):
        idf, basis = held.value
        total: dict[int, np.ndarray] = {}
        for pdf in batches:
            for _, terms, weights in _rows(pdf["_text"].to_list(), idf):
                seen = weights @ _basis_rows(basis, terms)
                for t, w in zip(terms.tolist(), weights.tolist()):
                    total[t] = total[t] + w * seen if t in total else w * seen
        yield pd.DataFrame({"term": np.array(list(total), np.int32), "v": [v.tobytes() for v in total.values()]})

    def add(pdf):
        order = pdf.groupby("term")["v"].agg(lambda vs: sum(np.frombuffer(v) for v in vs).tobytes())
        return pd.DataFrame({"term": order.index.astype(np.int32), "v": order.to_list()})

    one = items.select(whole(F.col(text)).alias("_text")).mapInPandas(giving_back(run), "term int, v binary")
    got = one.withColumn("_part", F.pmod("term", F.lit(256))).groupBy("_part").applyInPandas(lambda pdf: add(pdf), "term int, v binary").toPandas()
    return {int(t): np.frombuffer(v) for t, v in zip(got["term"], got["v"])}


def _basis_rows(basis, terms: np.ndarray) -> np.ndarray:
    if isinstance(basis, int):  # the random matrix, made anew from the numbers of its terms
        u = mix(terms.astype(np.uint64)[:, None] * np.uint64(4096) + np.arange(basis, dtype=np.uint64)[None, :] + np.uint64(1))
        v = mix(u ^ np.uint64(0xA5A5A5A5A5A5A5A5))
        a, b = (((x >> np.uint64(11)).astype(np.float64) + 1) / 2**53 for x in (u, v))
        return np.sqrt(-2 * np.log(a)) * np.cos(2 * np.pi * b)
    place, matrix = basis
    at = place[terms]
    return np.where((at >= 0)[:, None], matrix[np.maximum(at, 0)], 0.0)


def latent_space(items: DataFrame, text: str, idf: np.ndarray, rank: int = RANK, share: float = SHARE, powers: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """(row of each term or -1, matrix of the terms' rows): the leading right singular vectors of the passages.

    The sketch has as many columns as passages if they are fewer than the rank. Only sums over terms that
    occur in the benchmark come to the driver, at most FEATURES times rank numbers.
    """
    width = int(max(1, min(rank + 8, 2 * items.count() + 8)))
    basis = width
    for _ in range(powers + 1):
        sums = _sums(items, text, idf, basis)
        place = np.full(FEATURES, -1, np.int64)
        terms = np.array(sorted(sums), np.int64)
        if not len(terms):
            return place, np.zeros((0, 1))
        place[terms] = np.arange(len(terms))
        q, _ = np.linalg.qr(np.stack([sums[t] for t in terms]))
        basis = (place, q)
    held = items.sparkSession.sparkContext.broadcast((idf, basis))

    def gram(batches):
        idf, basis = held.value
        total, n = np.zeros((basis[1].shape[1],) * 2), 0
        for pdf in batches:
            seen = [weights @ _basis_rows(basis, terms) for _, terms, weights in _rows(pdf["_text"].to_list(), idf)]
            if seen:
                y = np.stack(seen)
                total, n = total + y.T @ y, n + len(y)
        yield pd.DataFrame({"g": [total.tobytes()], "n": [n]})

    parts = items.select(whole(F.col(text)).alias("_text")).mapInPandas(giving_back(gram), "g binary, n long").withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(16)))
    merge = lambda pdf: pd.DataFrame({"g": [sum(np.frombuffer(g) for g in pdf["g"]).tobytes()], "n": [int(pdf["n"].sum())]})
    rows = parts.groupBy("_part").applyInPandas(lambda pdf: merge(pdf), "g binary, n long").collect()
    total = sum(np.frombuffer(r["g"]) for r in rows).reshape(basis[1].shape[1], -1)
    values, vectors = np.linalg.eigh(total)
    values, vectors = values[::-1].clip(0), vectors[:, ::-1]
    needed = int(np.searchsorted(np.cumsum(values), share * sum(r["n"] for r in rows))) + 1
    return place, basis[1] @ vectors[:, : min(needed, rank, len(values))]


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence of two arrays of words, by bits of one whole number per word of b."""
    at: dict[int, int] = {}
    for i, w in enumerate(a.tolist()):
        at[w] = at.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b.tolist():
        hit = row & at.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _answer(text: str) -> str:
    """The item's last sentence; all of it if there is but one."""
    parts = [s for s in re.split(r"(?<=[.?!])\s+", text.strip()) if s]
    return parts[-1] if parts else ""


def _item_block(rows: list, idf, place, matrix) -> dict:
    """Latent vectors of the items' passages, and their words and answers."""
    texts = [r["_text"] for r in rows]
    owner, vectors = [], []
    for i, terms, weights in _rows(texts, idf):
        seen = weights @ _basis_rows((place, matrix), terms)
        length = np.linalg.norm(seen)
        if length > 0:
            owner.append(i)
            vectors.append(seen / length)
    words = [words_of([t])[0] for t in texts]
    return {
        "items": [r["_item"] for r in rows],
        "owner": np.array(owner, np.int64),
        "vectors": np.array(vectors, np.float32).reshape(len(owner), matrix.shape[1]),
        "words": words,
        "answers": [words_of([_answer(t)])[0] for t in texts],
    }


def _search(texts: list[str], block: dict, idf, place, matrix, cosine: float):
    """(text, item, cosine, share in common order, answer's share, first and last word) of the best place of each candidate pair."""
    for a, b in steps(texts):
        hashes, offsets = hashes_of(texts[a:b])
        terms = _terms(hashes)
        weight = idf[terms].astype(np.float64)
        known = place[terms] >= 0
        total = np.concatenate(([0.0], np.cumsum(weight**2)))
        inside = np.concatenate(([0.0], np.cumsum(np.where(known, weight**2, 0.0))))
        counts = np.diff(offsets)
        number = np.where(counts > WINDOW, -(-(counts - WINDOW) // STRIDE) + 1, (counts > 0).astype(np.int64))
        doc = np.repeat(np.arange(b - a), number)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
        first = offsets[doc] + np.minimum(nth * STRIDE, np.maximum(counts[doc] - WINDOW, 0))
        last = np.minimum(first + WINDOW, offsets[doc + 1])
        norm = np.sqrt(total[last] - total[first])
        bound = np.sqrt(np.maximum(inside[last] - inside[first], 0)) >= cosine * norm
        some = np.flatnonzero(bound & (norm > 0))
        found: dict[tuple[int, int], tuple[float, int]] = {}
        for x in range(0, len(some), 512):
            part = some[x : x + 512]
            at = first[part][:, None] + np.arange(WINDOW)[None, :]
            ok = at < last[part][:, None]
            at = np.minimum(at, len(terms) - 1)
            w = np.where(ok & known[at], weight[at], 0.0).astype(np.float32)
            r, c = np.nonzero(w)
            seen = np.zeros((len(part), matrix.shape[1]), np.float32)
            if len(r):
                add = matrix[place[terms[at[r, c]]]] * w[r, c][:, None]
                begin = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))
                seen[r[begin]] = np.add.reduceat(add, begin, axis=0)
            score = (seen @ block["vectors"].T) / norm[part][:, None]
            for i, j in zip(*np.nonzero(score >= cosine)):
                pair = (int(part[i]), int(block["owner"][j]))
                found[pair] = max(found.get(pair, (0.0,))[0], float(score[i, j])), 0
        best: dict[tuple[int, int], tuple] = {}
        for (window, item), (score, _) in found.items():
            d, words = int(doc[window]), block["words"][item]
            reach = max(len(words), WINDOW) - WINDOW // 2
            x, y = max(int(offsets[d]), int(first[window]) - reach), min(int(offsets[d + 1]), int(last[window]) + reach)
            share = common_subsequence(words, hashes[x:y]) / len(words)
            if share >= LIKELY and share > best.get((d, item), (0, -1.0))[1]:
                answer = block["answers"][item]
                best[d, item] = (score, share, common_subsequence(answer, hashes[x:y]) / max(1, len(answer)), x - int(offsets[d]), y - int(offsets[d]))
        for (d, item), row in best.items():
            yield a + d, item, *row


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    cosine: float = COSINE, sure: float = SURE, likely: float = LIKELY, answer: float = ANSWER, items: int = ITEMS,
) -> DataFrame:
    """One row per pair of a row of docs and a benchmark item found in it: key, item, cosine, common (share of the item's words
    in common order), answer_common, first_word and last_word of the place.

    A pair counts if its common share is at least `sure`, or at least `likely` with `answer` of the answer's words.
    Null and empty texts match nothing; items without words are never found; repeated rows and items give a row each.
    """
    spark: SparkSession = docs.sparkSession
    held = benchmark.select(F.col(item).alias("_item"), whole(F.col(item_text)).alias("_text"))
    held = written(held.where(F.trim("_text") != "").withColumn("_n", F.monotonically_increasing_id()), "op8-items")
    rows = docs.select(F.col(key).alias(key), F.col(text).alias("_source"))
    kind = dict(benchmark.dtypes)[item]
    added = "_n int, _block int, cosine double, common double, answer_common double, first_word int, last_word int"
    counts, number = document_frequency(docs, text)
    idf = inverse_frequency(counts, number)
    place, matrix = latent_space(held, "_text", idf)
    matrix = matrix.astype(np.float32)
    # Blocks of at most `items` items, by a hash; each comes to the driver by itself and is broadcast.
    blocks = max(1, -(-held.count() // items))
    out = None
    for b in range(blocks):
        own = held.where(F.pmod(F.xxhash64("_n"), F.lit(blocks)) == b).orderBy("_n").collect()
        if not own:
            continue
        block = _item_block(own, idf, place, matrix)
        names = spark.createDataFrame([(b, i, x) for i, x in enumerate(block.pop("items"))], f"_block int, _n int, `{item}` {kind}")
        shared = spark.sparkContext.broadcast((block, idf, place, matrix))

        def run(texts, b=b, shared=shared):
            block, idf, place, matrix = shared.value
            found = list(_search(texts, block, idf, place, matrix, cosine))
            found = [(f[0], f[1], b, *f[2:]) for f in found if f[3] >= sure or f[3] >= likely and f[4] >= answer]
            at, *columns = zip(*found) if found else ([],) * 8
            return at, columns

        one = add_rows(rows, whole(F.col("_source")), run, added, keep=[key], chars=STEP_CHARS).join(F.broadcast(names), ["_block", "_n"]).drop("_block", "_n")
        out = one if out is None else out.unionByName(one)
    if out is None:
        out = spark.createDataFrame([], f"`{key}` {dict(docs.dtypes)[key]}, {added}").withColumn(item, F.lit(None).cast(kind)).drop("_block", "_n")
    return out.select(key, item, "cosine", "common", "answer_common", "first_word", "last_word")
