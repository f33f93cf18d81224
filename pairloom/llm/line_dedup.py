"""Line deduplication with a sharded minimal perfect hash.

Lines are counted as pairs of 64-bit hashes, once per document, combined before the shuffle. The hashes
that reach the threshold are dealt to shards of some thousands; each shard builds a minimal perfect hash
(hash and displace) over its own, and two compact arrays in its order: fingerprints and counts. Documents
then probe these arrays; no line is joined with anything. The arrays are broadcast while they are below a stated size;
beyond it they are probed in several passes, each with as many shards as fit.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.shared import BLANKS, ascii_lower, whole, written

#: Lines per shard on average, and the bytes of arrays that one pass may broadcast.
SHARD_LINES = 4096
PASS_BYTES = 64 << 20
_LINE_BYTES = 13  # fingerprint 8, count 4, its share of the seeds 1
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def build_shard(hashes: np.ndarray, prints: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Seeds of the buckets, and fingerprints and counts in the order of the perfect hash.
    hashes are distinct. A bucket of one key stores its slot directly, as a negative seed."""
    n = len(hashes)
    buckets = -(-n // 4)
    h = hashes.astype(np.int64).view(np.uint64)
    home = (_mix(h) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(home, kind="stable")
    starts = np.searchsorted(home[order], np.arange(buckets + 1))
    seeds = np.zeros(buckets, np.int32)
    slot = np.full(n, -1, np.int64)
    taken = np.zeros(n, bool)
    for b in np.argsort(-np.diff(starts), kind="stable"):
        keys = order[starts[b] : starts[b + 1]]
        if len(keys) < 2:
            break
        d = 1
        while True:
            at = (_mix(h[keys] + np.uint64(d * int(_STEP) & 2**64 - 1)) % np.uint64(n)).astype(np.int64)
            if not taken[at].any() and len(np.unique(at)) == len(at):
                break
            d += 1
        seeds[b], slot[keys] = d, at
        taken[at] = True
    single = np.flatnonzero(np.diff(starts) == 1)
    free = np.flatnonzero(~taken)[: len(single)]
    slot[order[starts[single]]] = free
    seeds[single] = -(free + 1)
    out_prints, out_counts = np.empty(n, np.int64), np.empty(n, np.int32)
    out_prints[slot], out_counts[slot] = prints, np.minimum(counts, 2**31 - 1)
    return seeds, out_prints, out_counts


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.drop_duplicates("h1")  # two lines with one 64-bit hash: a chance of about n^2 / 2^65 in all
    seeds, prints, counts = build_shard(pdf["h1"].to_numpy(), pdf["h2"].to_numpy(), pdf["n"].to_numpy())
    return pd.DataFrame(
        {"shard": [pdf["shard"].iloc[0]], "lines": [len(pdf)], "seeds": [seeds.tobytes()], "prints": [prints.tobytes()], "counts": [counts.tobytes()]}
    )


class Arrays:
    """The arrays of some shards, concatenated, for probing many hashes at once."""

    def __init__(self, shards: int, rows: list):
        self.shards = shards
        sizes, seeds = np.zeros(shards, np.int64), [np.zeros(0, np.int32)]
        self.slot_at, self.seed_at = np.zeros(shards, np.int64), np.zeros(shards, np.int64)
        prints, counts, slots, buckets = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], 0, 0
        for r in rows:
            sizes[r["shard"]], self.slot_at[r["shard"]], self.seed_at[r["shard"]] = r["lines"], slots, buckets
            seeds.append(np.frombuffer(r["seeds"], np.int32))
            prints.append(np.frombuffer(r["prints"], np.int64))
            counts.append(np.frombuffer(r["counts"], np.int32))
            slots, buckets = slots + r["lines"], buckets + len(seeds[-1])
        self.sizes, self.seeds = sizes, np.concatenate(seeds)
        self.prints, self.counts = np.concatenate(prints), np.concatenate(counts)

    def count(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """In how many documents each line is found; 0 if it is not in these arrays."""
        out = np.zeros(len(h1), np.int64)
        if not len(self.prints):
            return out
        shard = np.mod(h2, self.shards)
        n = self.sizes[shard]
        here = np.flatnonzero(n > 0)
        shard, n, h = shard[here], n[here].astype(np.uint64), h1[here].view(np.uint64)
        bucket = (_mix(h) % ((n + np.uint64(3)) // np.uint64(4))).astype(np.int64)
        seed = self.seeds[self.seed_at[shard] + bucket].astype(np.int64)
        slot = (_mix(h + np.maximum(seed, 0).astype(np.uint64) * _STEP) % n).astype(np.int64)
        slot = self.slot_at[shard] + np.where(seed < 0, -seed - 1, slot)
        out[here] = np.where(self.prints[slot] == h2[here], self.counts[slot], 0)
        return out


def line_keys(text: Column) -> Column:
    """The key of every line: blanks stripped at both ends, A-Z in lower case."""
    return F.transform(F.split(ascii_lower(text), "\n", -1), lambda line: F.btrim(line, F.lit(BLANKS)))


def _hashes(keys: Column, seed: int | None) -> Column:
    return F.transform(keys, lambda k: F.xxhash64(k) if seed is None else F.xxhash64(F.lit(seed), k))


def line_index(docs: DataFrame, text: str = "text", min_docs: int = 10, min_chars: int = 1, shard_lines: int = SHARD_LINES) -> tuple[DataFrame, int, int]:
    """The shards (shard, lines, seeds, prints, counts) of all lines found in at least min_docs rows,
    the number of shards and the number of lines."""
    keys = F.filter(F.array_distinct(line_keys(whole(F.col(text)))), lambda k: F.char_length(k) >= min_chars)
    frequent = written(
        docs.select(F.explode(keys).alias("k"))
        .select(F.xxhash64("k").alias("h1"), F.xxhash64(F.lit(17), "k").alias("h2"))
        .groupBy("h1", "h2")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_docs),
        "op5-lines",
    )
    lines = frequent.count()
    shards = max(1, -(-lines // shard_lines))
    index = frequent.withColumn("shard", F.pmod("h2", F.lit(shards)).cast("int")).groupBy("shard").applyInPandas(
        _build, "shard int, lines long, seeds binary, prints binary, counts binary"
    )
    return written(index, "op5-index"), shards, lines


def _prober(spark, shards: int, rows: list, min_docs: int):
    held = spark.sparkContext.broadcast((shards, [r.asDict() for r in rows]))

    @F.pandas_udf("array<boolean>")
    def dropped(h1: pd.Series, h2: pd.Series) -> pd.Series:
        if not len(h1):
            return pd.Series([], dtype=object)
        arrays = _probing(held)
        sizes = h1.map(len).to_numpy()
        hits = arrays.count(np.concatenate(h1.to_list()).astype(np.int64), np.concatenate(h2.to_list()).astype(np.int64)) >= min_docs
        return pd.Series(np.split(hits, np.cumsum(sizes)[:-1]))

    return dropped


_LAST: dict = {}


def _probing(held) -> Arrays:
    """The arrays of a broadcast, made once per Python worker."""
    if _LAST.get("of") is not held.value:
        _LAST.clear()
        _LAST.update(of=held.value, arrays=Arrays(*held.value))
    return _LAST["arrays"]


def drop_frequent_lines(
    docs: DataFrame,
    text: str = "text",
    min_docs: int = 10,
    min_chars: int = 1,
    pass_bytes: int = PASS_BYTES,
    shard_lines: int = SHARD_LINES,
) -> DataFrame:
    """docs with the text reduced to its other lines, and _n_lines (before) and _n_dropped.

    A line goes, in every row, if its key has at least min_chars code points and is found in at least
    min_docs rows. Null or empty text is one empty line, whose key is empty, so it stays; repeated rows
    count one each. All columns of docs remain; an empty table gives none.
    """
    spark = docs.sparkSession
    index, shards, lines = line_index(docs, text, min_docs, min_chars, shard_lines)
    passes = max(1, -(-lines * _LINE_BYTES // pass_bytes))
    keys = line_keys(whole(F.col(text)))

    def mask(rows: list) -> Column:
        return _prober(spark, shards, rows, min_docs)(_hashes(keys, None), _hashes(keys, 17))

    if passes == 1:
        marked = docs.withColumn("_mask", mask(index.collect()))
    else:
        # Rows get a number in a written copy, so that the passes agree on it; masks meet again by that number.
        base = written(docs.withColumn("_n", F.monotonically_increasing_id()), "op5-rows")
        found = None
        for p in range(passes):
            rows = index.where(F.pmod("shard", F.lit(passes)) == p).collect()
            one = written(base.select("_n", mask(rows).alias("_m")), f"op5-pass{p}")
            found = one if found is None else found.unionByName(one)
        either = F.reduce(F.collect_list("_m"), F.array().cast("array<boolean>"), lambda a, m: F.when(F.size(a) == 0, m).otherwise(F.zip_with(a, m, lambda x, y: x | y)))
        marked = base.join(found.groupBy("_n").agg(either.alias("_mask")), "_n").drop("_n")
    kept = F.filter(F.split(whole(F.col(text)), "\n", -1), lambda line, i: ~F.get("_mask", i))
    return (
        marked.withColumn(text, F.array_join(kept, "\n"))
        .withColumn("_n_lines", F.size("_mask").cast("long"))
        .withColumn("_n_dropped", F.size(F.filter("_mask", lambda m: m)).cast("long"))
        .drop("_mask")
    )
