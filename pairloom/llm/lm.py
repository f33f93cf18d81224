"""Language-model scores by logistic mixing of bit predictors over hashed contexts.

A text is read as its words, each followed by a blank and the last by a line feed, byte by byte, and each byte as
the bits of its Huffman code after the byte before. For every bit several predictors look up what followed the same context (the last 2, 3
or 5 bytes, and the place in the code) in the training texts; each context is hashed to a slot of its own table of counts.
Their log odds are mixed with weights that a gate selects (how many predictors know the context), the outcome is refined by
a table that maps mixed odds to observed ones, and weights and table learn online: after each block of a text
they take a step towards what the block was, and the text's next block is predicted with the result. Every text starts alike.

Counts are sums over all training texts: tasks count into arrays, which are added up piece by piece in two levels.
Tables have a fixed size, so they are broadcast.

The base score needs the count of every word. Frequent words (at most HEAD, by their share of all tokens) are broadcast; the others are
looked up by one exchange of packed (word hash, text) entries with the counts, by buckets that number with the data, and only sums return.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.shared import add_columns, fold_of, whole, written
from pairloom.llm.words import mix, steps, words_of

ORDERS = (2, 3, 5)
#: Slots of each predictor's table (a power of two), and of one piece of it.
SLOTS_LOG = 20
SLOTS, PIECE = 1 << SLOTS_LOG, 1 << 13
#: Bytes that are predicted with the same weights: of a text's first block, then ever twice as many up to a bound; rates of learning.
BLOCK, LONGEST, RATE, REFINE_RATE = 64, 1024, 0.02, 0.05
#: Words so frequent that their counts are broadcast, at most; entries of a bucket on average.
HEAD, BUCKET = 1 << 20, 200_000
_BINS = 33
#: Characters whose bits are worked on at once: their arrays stay in the processor's cache.
STEP = 1 << 18
_ODD = np.uint32(0x9E3779B1)


def _ways(counts: np.ndarray) -> list[list[tuple[int, int]]]:
    """The Huffman code of 256 bytes: the inner nodes on the way to each and the turns taken there. Rare ones count as 2^-20 of all."""
    heap = [(max(float(c), counts.sum() / 2**20, 1e-3), b, None) for b, c in enumerate(counts)]
    heapq.heapify(heap)
    number = 256
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        heapq.heappush(heap, (a[0] + b[0], number, (a, b)))
        number += 1
    ways: list[list] = [[]] * 256
    stack = [(heap[0], [])]
    while stack:
        (_, name, children), way = stack.pop()
        if children is None:
            ways[name] = way
        else:
            for bit, child in enumerate(children):
                stack.append((child, way + [(name - 256, bit)]))
    return ways


def huffman(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(length, nodes, bits) of the code of each byte: one code for 256 counts; for 65536 one after each byte, in the order of twos()."""
    ways = [way for after in counts.reshape(-1, 256) for way in _ways(after)]
    lengths = np.array([len(way) for way in ways], np.int32)
    nodes, bits = np.zeros((len(ways), lengths.max()), np.uint32), np.zeros((len(ways), lengths.max()), np.uint8)
    for b, way in enumerate(ways):
        nodes[b, : len(way)], bits[b, : len(way)] = zip(*way)
    return lengths, nodes * np.uint32(0x85EBCA6B), bits


def stream_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all texts, where each begins and one more, number of words of each)."""
    parts, n = [], []
    for t in texts:
        words = t.encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z alone, and the six blanks alone
        parts.append(b" ".join(words) + b"\n")
        n.append(len(words))
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate(([0], np.cumsum([len(p) for p in parts]))), np.array(n, np.int64)


def twos(stream: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """256 times the byte before plus the byte; a line feed comes before each text."""
    before = np.concatenate((stream[:0], [10], stream[:-1])).astype(np.int32)
    before[begins[:-1]] = 10
    return (before << 8) + stream


def slots(stream: np.ndarray, begins: np.ndarray, code, order: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slot of each predictor for each bit, the bits, how many bits each byte has), of the bytes as they come or in an order."""
    lengths, nodes, bits = code
    place = np.arange(len(stream), dtype=np.int32) - np.repeat(begins[:-1].astype(np.int32), np.diff(begins))
    pair = twos(stream, begins) & np.int32(len(lengths) - 1)  # of one code for all bytes, the byte alone
    pair = pair if order is None else pair[order]
    sizes = lengths[pair]
    nth = pair.astype(np.uint32) * np.uint32(nodes.shape[1]) - (np.cumsum(sizes) - sizes).astype(np.uint32)
    nth = np.repeat(nth, sizes)
    nth += np.arange(len(nth), dtype=np.uint32)
    node, bit = nodes.ravel().take(nth), bits.ravel().take(nth)
    out = np.empty((len(ORDERS), len(nth)), np.uint32)
    context = np.zeros(len(stream), np.uint32)
    for back in range(1, max(ORDERS) + 1):
        last = np.full(len(stream), 10, np.uint32)
        last[back:] = stream[:-back]
        last[place < back] = 10
        context = (context ^ last) * _ODD
        context ^= context >> np.uint32(15)
        if back in ORDERS:
            h = np.repeat(context if order is None else context[order], sizes)
            h += node
            h *= np.uint32(0xC2B2AE35)
            np.right_shift(h, np.uint32(32 - SLOTS_LOG), out=out[ORDERS.index(back)])
    return out, bit, sizes


def log_odds(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """What a slot says: log odds of its counts, drawn to nothing where there are few; nought for an unknown context."""
    n = zeros + ones
    return (np.log((ones + 0.2) / (zeros + 0.2)) * (n / (n + 0.3))).astype(np.float16)


def _blocks(length: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(first place, bytes that each text has there) of every block, for texts from the longest to the shortest."""
    out, x, block = [], 0, BLOCK
    while len(length) and x < length[0]:
        there = length[: np.searchsorted(-length, -x)]  # texts that have a byte x
        out.append((x, np.minimum(there - x, block)))
        x, block = x + block, min(2 * block, LONGEST)
    return out


def _score(texts: list[str], tables: np.ndarray, code):
    """(bits of information, bytes, words) of every text."""
    k, tables = len(ORDERS), tables.astype(np.float32, copy=False)
    for a, b in steps(texts, STEP):
        stream, begins, words = stream_of(texts[a:b])
        living = np.argsort(-np.diff(begins), kind="stable")
        blocks = _blocks(np.diff(begins)[living])
        # Bytes by block and text: all that is predicted at once lies together.
        first = np.concatenate([begins[living[: len(n)]] + x for x, n in blocks])
        n = np.concatenate([n for _, n in blocks])
        edges = np.concatenate(([0], np.cumsum(n)))
        slot, bit, sizes = slots(stream, begins, code, np.arange(len(stream)) + np.repeat(first - edges[:-1], n))
        says = np.empty(slot.shape, np.float32)
        for i in range(k):
            tables[i].take(slot[i], out=says[i], mode="clip")
        gates = (says != 0).sum(axis=0, dtype=np.int8)
        ends = np.concatenate(([0], np.cumsum(sizes)))[edges]  # in bits
        weights = np.tile(_START.T[:, None, :], (1, b - a, 1)).reshape(k, -1)  # predictor, text and gate
        refine = np.zeros((b - a) * _BINS, np.float32)
        cost = np.zeros(b - a)
        at = 0
        for _, n in blocks:
            m = len(n)
            edge = ends[at : at + m + 1]
            at += m
            s, flip = says[:, edge[0] : edge[-1]], 1 - 2 * bit[edge[0] : edge[-1]].astype(np.float32)  # -1 for a one
            of = np.repeat(np.arange(m), np.diff(edge))
            gate, start = gates[edge[0] : edge[-1]], edge[:-1] - edge[0]
            group = of * (k + 1) + gate
            odds = s[0] * weights[0].take(group)
            for i in range(1, k):
                odds += s[i] * weights[i].take(group)
            of *= _BINS
            of += np.clip(odds * np.float32(1.25) + np.float32(_BINS / 2), 0, _BINS - 1).astype(np.int64)
            odds += refine.take(of)
            e = np.exp(np.clip(odds, -16, 16) * flip)
            one = 1 + e
            cost[:m] += np.add.reduceat(np.log(one), start, dtype=np.float64)
            error = e / one * -flip  # what was, less what was expected
            count = np.sqrt(np.maximum(np.bincount(group, minlength=m * (k + 1)), 1))
            for g in range(1, k + 1):  # where no predictor knows the context, none learns
                step, known = RATE / count[g :: k + 1], error * (gate == g)
                for i in range(k):
                    weights[i, g : m * (k + 1) : k + 1] += (step * np.add.reduceat(known * s[i], start)).astype(np.float32)
            seen = np.sqrt(np.maximum(np.bincount(of, minlength=m * _BINS), 1))
            refine[: m * _BINS] += (REFINE_RATE * np.bincount(of, error, minlength=m * _BINS) / seen).astype(np.float32)
        bits = np.empty(b - a)
        bits[living] = cost / np.log(2)
        yield from zip(bits.tolist(), np.diff(begins).tolist(), words.tolist())


# Before anything is learnt, by how many predictors know their context: the longest contexts count most.
_START = np.array([[0.4, 0.4, 0.4], [0.9, 0.5, 0.4], [0.3, 0.65, 0.4], [0.15, 0.45, 0.5]], np.float32)


def _counted(held: np.ndarray, kind: int) -> pd.DataFrame:
    there, n = np.unique(held, return_counts=True)
    return pd.DataFrame({"kind": np.full(len(there), kind, np.int32), "item": there.astype(np.int64), "n": n.astype(np.int64)})


def token_counts(texts: DataFrame) -> DataFrame:
    """(kind, item, n): kind 0, how often a word (its hash) occurs; kind 1, a byte of the streams and the one before; kind 2, the number of texts."""

    def run(batches):
        for pdf in batches:
            texts = pdf["_text"].to_list()
            for a, b in steps(texts):
                stream, begins, _ = stream_of(texts[a:b])
                yield _counted(words_of(texts[a:b])[0].view(np.int64), 0)
                yield _counted(twos(stream, begins), 1)
                yield _counted(np.zeros(b - a, np.int64), 2)

    return texts.mapInPandas(run, "kind int, item long, n long").groupBy("kind", "item").agg(F.sum("n").alias("n"))


_SPARSE = np.dtype([("slot", "<u2"), ("zeros", "<u4"), ("ones", "<u4")])


def _added(parts) -> tuple[np.ndarray, np.ndarray]:
    zeros, ones = np.zeros(PIECE, np.int64), np.zeros(PIECE, np.int64)
    for raw in parts:
        x = np.frombuffer(raw, _SPARSE)
        zeros[x["slot"]] += x["zeros"]
        ones[x["slot"]] += x["ones"]
    return zeros, ones


def _sparse(zeros: np.ndarray, ones: np.ndarray) -> bytes:
    at = np.flatnonzero(zeros + ones)
    out = np.empty(len(at), _SPARSE)
    out["slot"], out["zeros"], out["ones"] = at, np.minimum(zeros[at].astype(np.int64), 2**32 - 1), np.minimum(ones[at].astype(np.int64), 2**32 - 1)
    return out.tobytes()


def context_tables(texts: DataFrame, code) -> np.ndarray:
    """The log odds of every slot of every predictor, from all training texts."""
    held = texts.sparkSession.sparkContext.broadcast(code)

    def count(batches):
        from pyspark import TaskContext

        code, total = held.value, np.zeros((len(ORDERS), 2 * SLOTS), np.int32)
        for pdf in batches:
            texts = pdf["_text"].to_list()
            for a, b in steps(texts, STEP):
                stream, begins, _ = stream_of(texts[a:b])
                slot, bit, _ = slots(stream, begins, code)
                slot <<= np.uint32(1)  # a slot's zeros and ones lie side by side
                slot += bit
                for i in range(len(ORDERS)):
                    np.add.at(total[i], slot[i], np.int32(1))
        rows = []
        for i in range(len(ORDERS)):
            for x in range(0, SLOTS, PIECE):
                rows.append((i * (SLOTS // PIECE) + x // PIECE, _sparse(total[i, 2 * x : 2 * (x + PIECE) : 2], total[i, 2 * x + 1 : 2 * (x + PIECE) : 2])))
        part = TaskContext.get().partitionId() // 64  # at most 64 tasks' pieces meet at first
        yield pd.DataFrame({"part": np.full(len(rows), part, np.int32), "piece": [r[0] for r in rows], "counts": [r[1] for r in rows]})

    def some(pdf):
        return pd.DataFrame({"piece": [pdf["piece"].iloc[0]], "counts": [_sparse(*_added(pdf["counts"]))]})

    def every(pdf):
        return pd.DataFrame({"piece": [pdf["piece"].iloc[0]], "odds": [log_odds(*_added(pdf["counts"])).tobytes()]})

    one = texts.mapInPandas(count, "part int, piece int, counts binary").groupBy("part", "piece").applyInPandas(some, "piece int, counts binary")
    rows = one.groupBy("piece").applyInPandas(every, "piece int, odds binary").collect()  # as many bytes as the tables have
    tables = np.zeros((len(ORDERS), SLOTS), np.float16)
    for r in rows:
        i, x = divmod(r["piece"] * PIECE, SLOTS)
        tables[i, x : x + PIECE] = np.frombuffer(r["odds"], np.float16)
    return tables


def starts_of(items: np.ndarray) -> np.ndarray:
    """Where in sorted 64-bit hashes each value of their leading bits begins, for about as many values as hashes."""
    bits = max(1, int(len(items)).bit_length())
    lead = (items.view(np.uint64) ^ np.uint64(1 << 63)) >> np.uint64(64 - bits)
    return np.searchsorted(lead, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)


def find(items: np.ndarray, starts: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, is it there) of hashes among sorted ones, at least one: few look-ups each, as hashes are spread evenly."""
    bits = (len(starts) - 1).bit_length() - 1
    lead = ((wanted.view(np.uint64) ^ np.uint64(1 << 63)) >> np.uint64(64 - bits)).astype(np.int64)
    at, end = starts[lead], starts[lead + 1]
    there = np.minimum(at, len(items) - 1)
    hit = (items[there] == wanted) & (at < end)
    open_ = np.flatnonzero(~hit & (at + 1 < end))
    while len(open_):
        there[open_] += 1
        hit[open_] = items[there[open_]] == wanted[open_]
        open_ = open_[~hit[open_] & (there[open_] + 1 < end[open_])]
    return there, hit


def _rare_sums(rows: DataFrame, counts: DataFrame, head: np.ndarray, tokens: int) -> DataFrame:
    """(_id, _rare sum of log10(count + 0.1), _rare_known) over the words that are not in the head."""
    spark = rows.sparkSession
    buckets = max(8, -(-tokens // BUCKET))
    held = spark.sparkContext.broadcast((head, starts_of(head)))

    def send(batches):
        head, starts = held.value
        for pdf in batches:
            texts, ids = pdf["_text"].to_list(), pdf["_id"].to_numpy()
            for a, b in steps(texts):
                hashes, offsets, _, _, _ = words_of(texts[a:b])
                own = np.repeat(np.arange(b - a), np.diff(offsets))
                plain = hashes.view(np.int64)
                rare = ~find(head, starts, plain)[1] if len(head) else np.ones(len(plain), bool)
                plain, own = plain[rare], own[rare]
                home = np.mod(plain, buckets)
                order = np.argsort(home, kind="stable")
                edges = np.searchsorted(home[order], np.arange(buckets + 1))
                plain, own = plain[order], own[order]
                out = []
                for k, (x, y) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
                    if y > x:
                        table, which = np.unique(own[x:y], return_inverse=True)
                        out.append((k, plain[x:y].tobytes(), ids[a:b][table].tobytes(), which.astype(np.uint32).tobytes()))
                yield pd.DataFrame(out, columns=["bucket", "words", "ids", "which"])

    def look_up(packed, counts):
        if not len(packed):
            return pd.DataFrame({"_id": np.zeros(0, np.int64), "_rare": np.zeros(0), "_rare_known": np.zeros(0, np.int64)})
        counts = counts.sort_values("item")
        items, n = counts["item"].to_numpy(), counts["n"].to_numpy()
        words, ids = [], []
        for w, t, k in zip(packed["words"], packed["ids"], packed["which"]):
            words.append(np.frombuffer(w, np.int64))
            ids.append(np.frombuffer(t, np.int64)[np.frombuffer(k, np.uint32)])
        words, ids = np.concatenate(words), np.concatenate(ids)
        c = np.zeros(len(words), np.int64)
        if len(items):
            at = np.minimum(np.searchsorted(items, words), len(items) - 1)
            c = np.where(items[at] == words, n[at], 0)
        own, which = np.unique(ids, return_inverse=True)
        return pd.DataFrame({"_id": own, "_rare": np.bincount(which, np.log10(c + 0.1)), "_rare_known": np.bincount(which, c > 0).astype(np.int64)})

    packed = rows.select("_id", "_text").mapInPandas(send, "bucket int, words binary, ids binary, which binary")
    there = counts.select(F.pmod("item", F.lit(buckets)).cast("int").alias("bucket"), "item", "n")
    sums = packed.groupBy("bucket").cogroup(there.groupBy("bucket")).applyInPandas(look_up, "_id long, _rare double, _rare_known long")
    # Rows repeated m times share an identity and have sent their words m times: the caller divides.
    return sums.groupBy("_id").agg(F.sum("_rare").alias("_rare"), F.sum("_rare_known").alias("_rare_known"))


def score_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 10) -> DataFrame:
    """One row per row of docs: key, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    The model and the base learn from the rows whose crc32 of the key modulo folds is not 0. score is log10 of the
    probability of the text's words and its end. Null, empty and blank texts have one token, the end. Repeated rows get the same
    scores. With no training rows (an empty table, or all held out) the tables say nothing and every base count is 0.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("_key"), whole(F.col(text)).alias("_text"))
    rows = rows.withColumn("_id", F.xxhash64(F.col("_key").cast("string"), "_text")).withColumn("_held", fold_of(F.col("_key"), folds) == 0)
    train = rows.where("not _held").select("_text")
    counts = written(token_counts(train), "op7-counts")
    total = {r["kind"]: r for r in counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    ends = int(counts.where("kind = 2").agg(F.sum("n")).first()[0] or 0)
    words = int(total[0]["n"]) if 0 in total else 0
    tokens, distinct = words + ends, (int(total[0]["v"]) if 0 in total else 0) + (ends > 0)
    seen = np.zeros(1 << 16)
    for r in counts.where("kind = 1").collect():  # at most 65536 rows
        seen[r["item"]] = r["n"]
    code = huffman(seen)
    # No more than HEAD words can each have more than that share of all tokens.
    frequent = counts.where((F.col("kind") == 0) & (F.col("n") * HEAD > words)).select("item", "n").orderBy("item").toPandas()
    tables = context_tables(train, code).astype(np.float32)
    items = frequent["item"].to_numpy(np.int64)
    held = spark.sparkContext.broadcast((items, frequent["n"].to_numpy(np.int64), starts_of(items), tables, code))

    def run(texts):
        items, n, starts, tables, code = held.value
        sums, known = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        for a, b in steps(texts):
            hashes, offsets, _, _, _ = words_of(texts[a:b])
            own, plain = np.repeat(np.arange(a, b), np.diff(offsets)), hashes.view(np.int64)
            if len(items):
                at, hit = find(items, starts, plain)
                sums += np.bincount(own[hit], np.log10(n[at[hit]] + 0.1), minlength=len(texts))
                known += np.bincount(own[hit], minlength=len(texts))
        return [*(zip(*_score(texts, tables, code)) if texts else ([],) * 3), sums, known]

    source = rows.select("_key", "_id", "_held", F.col("_text").alias("_source"))
    scored = add_columns(source, F.col("_source"), run, "_bits double, _bytes long, _words long, _sum double, _known long").drop("_source")
    scored = written(scored, "op7-scored")
    times = scored.groupBy("_id").agg(F.count("*").alias("_times"))
    rare = _rare_sums(rows, counts.where((F.col("kind") == 0) & (F.col("n") * HEAD <= words)), items, words + 1).join(times, "_id")
    log_total = float(np.log10(tokens + 0.1 * (distinct + 1)))
    n_tokens = F.col("_words") + F.lit(1)
    base = F.col("_sum") + F.coalesce(F.col("_rare") / F.col("_times"), F.lit(0.0)) + F.lit(float(np.log10(ends + 0.1))) - n_tokens * F.lit(log_total)
    return scored.join(rare, "_id", "left").select(
        F.col("_key").alias(key),
        F.col("_held").alias("held_out"),
        n_tokens.alias("n_tokens"),
        (F.col("_known") + F.coalesce((F.col("_rare_known") / F.col("_times")).cast("long"), F.lit(0)) + F.lit(int(ends > 0))).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (-F.col("_bits") * F.lit(float(np.log10(2)))).alias("score"),
        (F.col("_bits") / F.col("_bytes")).alias("bits_per_byte"),
    )
