"""Similarity join of word-shingle sets by their rarest shingles.

Sets of similarity p / q or more have at least p / q of each one's shingles in common. So if all sets are sorted in one order,
and o of n shingles must be common, two similar sets share two of their first n - o + 2. These are a set's signatures. Any order
gives all links; few sets share a signature if what is frequent comes last. So shingles are first counted in a table of fixed size, by
slots that several may share: the order is by the slot's level, which tells how far its count is above the average,
then by the shingle's hash. A passage that very many texts have is no signature of texts that say enough beside it.

Signatures travel packed, many in a row, to buckets that number with the data; what many sets of one task share is
sent once. What comes back are the classes of equal sets that share a signature, with the signature's place in each one's order. At
the first signature that two sets share, neither has anything in common with the other before it: the places bound
what can be common. Each class is first compared with a leader, the class with the least place of a signature, as what stands before
it is the class's own; linked classes are merged. Only classes in different components are then compared with each other, at the
signatures whose places allow it and before which they do not visibly share another. Candidates pass a bound (the distance of two
histograms of the shingles is at most that of the sets); every link is then decided by exact intersection of whole sets.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.llm.components import components
from pairloom.llm.shared import TEXTS, add_columns, giving_back, membership, texts_of, whole, with_membership, written
from pairloom.llm.words import SHORT_STEP, mix, shingles_of, steps, words_of

#: Slots of the table of counts (a power of two), and of one piece of it.
SLOTS, PIECE = 1 << 22, 1 << 15
#: Signatures that a task gathers before it packs them; shingles of all texts for each bucket.
GATHERED = 1 << 18
BUCKET = 1 << 21
#: Places of a class's histogram.
PLACES = 256
#: Bytes beside each signature: its place (65535 at most), and 40 bits of each of the two signatures before it.
BESIDE = 12
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def signatures(held: np.ndarray, p: int, q: int, levels: np.ndarray | None = None) -> list[np.ndarray]:
    """The signatures of a set, given as sorted distinct 64-bit hashes: its first shingles by level, then hash. Sets that could only be equal have none."""
    n = len(held)
    if n * q < p * (n + 1):  # another set has at least one shingle more or less
        return []
    first = min(n, n - -(-n * p // q) + 2)
    if levels is not None:
        level = levels[held & np.uint64(len(levels) - 1)]
        if level.any():
            held = held[np.argsort(level, kind="stable")]
    return [mix(held[:first] + _ODD[2])]


def _sets(texts: list[str], size: int):
    for a, b in steps(texts, SHORT_STEP):
        hashes, offsets, _, _, _ = words_of(texts[a:b])
        yield from shingles_of(hashes, offsets, size)


def _class(held: np.ndarray) -> int:
    """One number for equal sets. Different sets share one with a chance of n^2 / 2^65 among n."""
    total = int(mix(held).sum(dtype=np.uint64)) + len(held) * int(_ODD[0])
    return int(mix(np.array([total & 2**64 - 1], np.uint64)).view(np.int64)[0])


def _histogram(held: np.ndarray) -> bytes:
    """How many shingles fall to each place, 255 at most: places differ by no more in sum than two sets do."""
    return np.minimum(np.bincount((held >> np.uint64(56)).astype(np.int64), minlength=PLACES), 255).astype(np.uint8).tobytes()


def shingle_classes(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(_key, _n shingles, _class, _histogram) of every row; null class and histogram for empty sets."""

    def run(texts):
        made = [(len(h), _class(h) if len(h) else None, _histogram(h) if len(h) else None) for h in _sets(texts, size)]
        return [list(column) for column in zip(*made)] if made else [[], [], []]

    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_source"))
    return add_columns(rows, whole(F.col("_source")), run, "_n long, _class long, _histogram binary", keep=["_key"], rows=TEXTS)


def _added(parts) -> np.ndarray:
    total = np.zeros(PIECE, np.uint32)
    for raw in parts:
        held = np.frombuffer(raw, np.uint16 if len(raw) == 2 * PIECE else np.uint32)
        total += np.minimum(held, 2**32 - 1 - total)
    return total


def shingle_levels(docs: DataFrame, text: str, size: int, total: int) -> np.ndarray:
    """For each slot of shingles, 0 if its count in all texts is about the average, then one more each time what it has above that doubles."""
    usual = total / SLOTS
    spread = max(1.0, usual**0.5)  # of counts of rare shingles alone

    def count(batches):
        from pyspark import TaskContext

        held = np.zeros(SLOTS, np.uint32)
        for texts in texts_of(batches):
            for one in _sets(texts, size):
                held[(one & np.uint64(SLOTS - 1)).astype(np.int64)] += np.uint32(1)  # two of one set in a slot count as one
        small = np.minimum(held, 65535).astype("<u2")
        rows = [small[x : x + PIECE].tobytes() for x in range(0, SLOTS, PIECE)]
        part = TaskContext.get().partitionId() // 64  # at most 64 tasks' pieces meet at first
        columns = [np.full(len(rows), part, np.int32), np.arange(len(rows), dtype=np.int32), rows]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["part", "piece", "counts"])

    def some(pdf):
        return pd.DataFrame({"piece": [pdf["piece"].iloc[0]], "counts": [_added(pdf["counts"]).tobytes()]})

    def every(pdf):
        above = np.maximum(_added(pdf["counts"]) - (usual + 3 * spread + 2), 0)
        level = np.clip(np.floor(np.log2(above / spread + 1)), 0, 255)
        return pd.DataFrame({"piece": [pdf["piece"].iloc[0]], "levels": [level.astype(np.uint8).tobytes()]})

    texts = docs.select(whole(F.col(text)).alias("_text"))
    one = texts.mapInArrow(giving_back(count), "part int, piece int, counts binary").groupBy("part", "piece").applyInPandas(some, "piece int, counts binary")
    levels = np.zeros(SLOTS, np.uint8)
    for r in one.groupBy("piece").applyInPandas(every, "piece int, levels binary").collect():  # one byte for each slot
        levels[r["piece"] * PIECE : (r["piece"] + 1) * PIECE] = np.frombuffer(r["levels"], np.uint8)
    return levels


def _bytes(numbers: np.ndarray, n: int) -> np.ndarray:
    """The n lowest bytes of each number."""
    return numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n]


def _numbers(held: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(held), 8), np.uint8)
    wide[:, : held.shape[1]] = held
    return wide.reshape(-1).view("<u8")


def _beside(signs: np.ndarray, owner: int) -> np.ndarray:
    """What goes with each signature of a class; where none is before it, bits of the class, which no other one has."""
    before = np.concatenate((mix(np.array([owner, ~owner], np.int64).view(np.uint64)), signs))
    place = np.minimum(np.arange(len(signs)), 65535)
    return np.concatenate((_bytes(place, 2), _bytes(before[1:-1], 5), _bytes(before[:-2], 5)), axis=1)


def _groups(signs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows by sign, and where in that order a sign begins."""
    order = np.argsort(signs)
    held = signs[order]
    return order, np.concatenate(([True], held[1:] != held[:-1]))


def _packed(bucket: int, signs: np.ndarray, owners: np.ndarray, beside: np.ndarray) -> tuple:
    """A row: 40 bits of each sign as bytes, the owners, which of them each sign has, and what is beside the signs."""
    table, which = np.unique(owners, return_inverse=True)
    return bucket, _bytes(signs, 5).tobytes(), table.tobytes(), which.astype(np.uint32 if len(table) > 65535 else np.uint16).tobytes(), beside.tobytes()


def _unpacked(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    signs, owners = [], []
    for small, table, which in zip(pdf["signs"], pdf["owners"], pdf["which"]):
        n = len(small) // 5
        signs.append(_numbers(np.frombuffer(small, np.uint8).reshape(n, 5)))
        owners.append(np.frombuffer(table, np.int64)[np.frombuffer(which, np.uint16 if len(which) == 2 * n else np.uint32)])
    return np.concatenate(signs), np.concatenate(owners), np.concatenate([np.frombuffer(x, np.uint8).reshape(-1, BESIDE) for x in pdf["beside"]])


def _pack(signs: np.ndarray, owners: np.ndarray, beside: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Rows (bucket, signs, owners, which, beside) of what was gathered. A signature of several classes here is told at once, in
    a row whose bucket is negative, and sent on with one of them only, marked by its lowest bit."""
    home = ((signs >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
    signs = (signs & np.uint64((1 << 40) - 2)) | home.astype(np.uint64) << np.uint64(40)
    order, first = _groups(signs)
    signs, owners, beside = signs[order], owners[order], beside[order]
    several = np.diff(np.append(np.flatnonzero(first), len(signs))) > 1
    told = several[np.cumsum(first) - 1]
    rows = []

    def add(signs, owners, beside, sign):
        home = (signs >> np.uint64(40)).astype(np.int64)
        edges = np.flatnonzero(np.concatenate(([True], home[1:] != home[:-1], [True]))) if len(home) else []
        for x, y in zip(edges[:-1], edges[1:]):
            rows.append(_packed(int(home[x]) if sign > 0 else -1 - int(home[x]), signs[x:y], owners[x:y], beside[x:y]))

    add(signs[told], owners[told], beside[told], -1)
    add((signs | told.astype(np.uint64))[first], owners[first], beside[first], 1)
    kinds = [pa.int32()] + [pa.binary()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["bucket", "signs", "owners", "which", "beside"])


def packed_signatures(docs: DataFrame, text: str, size: int, p: int, q: int, buckets: int, levels: np.ndarray) -> DataFrame:
    order = docs.sparkSession.sparkContext.broadcast(levels)

    def run(batches):
        signs, owners, beside, seen, n = [], [], [], set(), 0
        for texts in texts_of(batches):
            for held in _sets(texts, size):
                owner = _class(held)
                if owner in seen:
                    continue
                seen.add(owner)
                for found in signatures(held, p, q, order.value):
                    signs.append(found)
                    owners.append(np.full(len(found), owner, np.int64))
                    beside.append(_beside(found, owner))
                    n += len(found)
                if n >= GATHERED:
                    yield _pack(np.concatenate(signs), np.concatenate(owners), np.concatenate(beside), buckets)
                    signs, owners, beside, seen, n = [], [], [], set(), 0
        if n:
            yield _pack(np.concatenate(signs), np.concatenate(owners), np.concatenate(beside), buckets)

    return docs.select(whole(F.col(text)).alias("_text")).mapInArrow(giving_back(run), "bucket int, signs binary, owners binary, which binary, beside binary")


def _shared(pdf: pd.DataFrame) -> pd.DataFrame:
    """(sign, class, place, last, other) of the signatures that several classes have, of one bucket; of a negative one, of all."""
    signs, owners, beside = _unpacked(pdf)
    bucket = int(pdf["bucket"].iloc[0])
    if bucket >= 0:
        told, plain = (signs & np.uint64(1)).astype(bool), signs & ~np.uint64(1)
        order, first = _groups(plain)
        group = np.cumsum(first) - 1
        # Told classes have others beside them in their own task already.
        many = (np.bincount(group) > 1) | (np.bincount(group, weights=told[order]) > 0)
        keep = order[many[group] & ~told[order]]
        signs, owners, beside = plain[keep], owners[keep], beside[keep]
    else:
        bucket = -1 - bucket
    sign, place = (signs | np.uint64(bucket) << np.uint64(40)).astype(np.int64), _numbers(beside[:, :2]).astype(np.int32)
    last, other = (_numbers(beside[:, x : x + 5]).astype(np.int64) for x in (2, 7))
    return pd.DataFrame({"sign": sign, "class": owners, "place": place, "last": last, "other": other}).drop_duplicates(["sign", "class", "place"])


def sharing_classes(packed: DataFrame) -> DataFrame:
    """(sign, class, place, last, other) of all signatures that several classes have; last and other are the two before it. What tasks have told already goes through the same shuffle, in
    groups of its own, so that signatures are made once and a task runs one Python worker."""
    return packed.groupBy("bucket").applyInPandas(_shared, "sign long, class long, place int, last long, other long")


def class_sets(docs: DataFrame, text: str, size: int, wanted: DataFrame) -> DataFrame:
    """(class, set) of the classes wanted: sorted hashes as bytes. A fixed-size filter keeps the others from the shuffle."""

    def rows(one):
        return pa.RecordBatch.from_arrays([pa.array(list(one), pa.int64()), pa.array(list(one.values()), pa.binary())], names=["class", "set"])

    def run(batches):
        one, n = {}, 0
        for texts in texts_of(batches):
            for held in _sets(texts, size):
                if len(held):
                    one[_class(held)] = held.tobytes()
                    n += len(held)
                if n >= GATHERED:  # a task's sets are not held all at once
                    yield rows(one)
                    one, n = {}, 0
        if one:
            yield rows(one)

    every = docs.select(whole(F.col(text)).alias("_text")).mapInArrow(giving_back(run), "class long, set binary")
    some = with_membership(every, "class", membership(wanted, "class"), "_hit").where("_hit").drop("_hit")
    return some.groupBy("class").agg(F.any_value("set").alias("set")).join(wanted, "class", "left_semi")


@F.pandas_udf(T.LongType())
def _common(a: pd.Series, b: pd.Series) -> pd.Series:
    out = np.zeros(len(a), np.int64)
    for i, (x, y) in enumerate(zip(a, b)):
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        at = np.searchsorted(y, x)
        at[at == len(y)] = 0
        out[i] = (y[at] == x).sum()
    return pd.Series(out)


@F.pandas_udf(T.LongType())
def _distance(a: pd.Series, b: pd.Series) -> pd.Series:
    if not len(a):
        return pd.Series([], dtype="int64")
    x, y = (np.frombuffer(b"".join(s), np.uint8).reshape(-1, PLACES).astype(np.int16) for s in (a, b))
    return pd.Series(np.abs(x - y).sum(axis=1, dtype=np.int64))


def _likely(pairs: DataFrame, sketches: DataFrame, p: int, q: int) -> DataFrame:
    """Of pairs (a, b) with sizes na, nb those that sizes and histograms leave possible."""
    fits = pairs.where(q * F.least("na", "nb") >= p * F.greatest("na", "nb")).select("a", "b", "na", "nb")
    joined = fits.join(sketches.select(F.col("class").alias("a"), F.col("histogram").alias("_ha")), "a")
    joined = joined.join(sketches.select(F.col("class").alias("b"), F.col("histogram").alias("_hb")), "b")
    near = joined.select("a", "b", "na", "nb", _distance("_ha", "_hb").alias("_d"))
    return near.where(F.col("_d") * (p + q) <= (F.col("na") + F.col("nb")) * (q - p)).drop("_d")


def _links(pairs: DataFrame, sets: DataFrame, p: int, q: int) -> DataFrame:
    """Of pairs (a, b) with sizes na, nb those that are similar."""
    joined = pairs.join(sets.select(F.col("class").alias("a"), F.col("set").alias("_sa")), "a")
    joined = joined.join(sets.select(F.col("class").alias("b"), F.col("set").alias("_sb")), "b")
    common = joined.select("a", "b", "na", "nb", _common("_sa", "_sb").alias("c"))
    return common.where(F.col("c") * q >= (F.col("na") + F.col("nb") - F.col("c")) * p).select("a", "b")


def _possible(p: int, q: int):
    """That sets of na and nb shingles whose first common ones are at places ia and ib may be similar: no more than what follows is common."""
    needed = (F.col("na") + F.col("nb")) * p
    return ((F.col("na") - F.col("ia")) * (p + q) >= needed) & ((F.col("nb") - F.col("ib")) * (p + q) >= needed)


def _side(shared: DataFrame, x: str) -> DataFrame:
    named = {"class": x, "n": f"n{x}", "place": f"i{x}", "last": f"l{x}", "other": f"o{x}", "root": f"r{x}"}
    return shared.select("sign", *[F.col(c).alias(named[c]) for c in shared.columns if c != "sign"])


def _pairs_with_leaders(shared: DataFrame, p: int, q: int) -> DataFrame:
    """Pairs of each class with a leader: of a signature, the class that has it at the least place. Of its leaders, a
    class is compared with the one it shares most signatures with."""
    leader = F.struct(F.col("place").alias("ib"), F.xxhash64("class").alias("o"), F.col("class").alias("b"), F.col("n").alias("nb"))
    leaders = shared.groupBy("sign").agg(F.min(leader).alias("l")).select("sign", "l.ib", "l.b", "l.nb")
    led = _side(shared.select("sign", "class", "n", "place"), "a").join(leaders, "sign").where(F.col("a") != F.col("b")).where(_possible(p, q))
    best = led.groupBy("a", "na", "b", "nb").count().groupBy("a", "na").agg(F.max(F.struct("count", "b", "nb")).alias("x"))
    return best.select("a", F.col("x.b").alias("b"), "na", F.col("x.nb").alias("nb"))


def _pairs_across(shared: DataFrame, roots: DataFrame, p: int, q: int) -> DataFrame:
    """Pairs of classes of different components, (sign, class, n, place, last, other), by the signatures that may be the first
    they share. It is not the first if one of the two before it is the same: then the pair comes from an earlier one."""
    fresh = written(shared.join(roots.select("class", "root"), "class"), "op10-fresh")
    mixed = fresh.groupBy("sign").agg(F.min("root").alias("_x"), F.max("root").alias("_y")).where("_x != _y").select("sign")
    large = written(fresh.join(mixed, "sign", "left_semi"), "op10-mixed")
    first = (F.col("la") != F.col("lb")) & (F.col("la") != F.col("ob")) & (F.col("oa") != F.col("lb")) & (F.col("oa") != F.col("ob"))
    one, two = _side(large, "a"), _side(large, "b").withColumnRenamed("sign", "_sign")
    met = one.join(two, (F.col("sign") == F.col("_sign")) & (F.col("ra") < F.col("rb")) & _possible(p, q) & first)
    return met.select("a", "b", "na", "nb").distinct()


def _merge(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Roots (class, root) after links between classes."""
    ends = links.join(roots.select(F.col("class").alias("a"), F.col("root").alias("ra")), "a")
    ends = ends.join(roots.select(F.col("class").alias("b"), F.col("root").alias("rb")), "b")
    moved = components(ends.select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    return written(
        roots.join(moved.select(F.col("node").alias("root"), F.col("root").alias("_new")), "root", "left").select("class", F.coalesce("_new", "root").alias("root"), "n"), "op10-roots"
    )


def similarity_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, similarity: tuple[int, int] = (80, 100)
) -> DataFrame:
    """One row per row of docs: key, n_shingles, component_id (the smallest key reachable by links, its own included).

    Sets are of distinct shingles of `size` words, A-Z as a-z; a shorter text's whole sequence is one shingle. Rows link
    when q * intersection >= p * union, similarity being (p, q). Null, empty and blank texts have the
    empty set and link with nothing. Repeated rows and equal sets link with each other. Rows with a null key get
    the component of the others of their set, null if all are null. Other columns are ignored.
    """
    p, q = similarity
    base = written(shingle_classes(docs, key, text, size), "op10-classes")
    filled = base.where("_class is not null").select(F.col("_class").alias("class"), "_n", "_key", F.col("_histogram").alias("histogram"))
    classes = filled.groupBy("class").agg(F.max("_n").alias("n"), F.min("_key").alias("_least"))
    total = base.agg(F.sum("_n")).first()[0] or 0
    buckets = max(8, -(-total // BUCKET))
    levels = shingle_levels(docs, text, size, total)
    shared = written(sharing_classes(packed_signatures(docs, text, size, p, q, buckets, levels)), "op10-shared")
    involved = written(classes.join(shared.select("class").distinct(), "class", "left_semi").select("class", F.col("class").alias("root"), "n"), "op10-involved")
    sketches = written(filled.join(involved, "class", "left_semi").groupBy("class").agg(F.any_value("histogram").alias("histogram")), "op10-sketches")
    pending = written(shared.join(involved.drop("root"), "class"), "op10-pending")

    def settle(roots: DataFrame, pairs: DataFrame) -> DataFrame:
        likely = written(_likely(pairs, sketches, p, q), "op10-likely")
        wanted = likely.select(F.col("a").alias("class")).unionByName(likely.select(F.col("b").alias("class"))).distinct()
        sets = written(class_sets(docs, text, size, wanted), "op10-sets")
        return _merge(roots, written(_links(likely, sets, p, q), "op10-links"))

    roots = settle(involved, _pairs_with_leaders(pending, p, q))
    roots = settle(roots, _pairs_across(pending, roots, p, q))

    every = classes.join(roots.select("class", "root"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    least = every.groupBy("root").agg(F.min("_least").alias("_component"))
    of_class = written(every.join(least, "root").select("class", "_component"), "op10-components")
    there = base.where("_class is not null").join(of_class, F.col("_class") == F.col("class"))
    alone = base.where("_class is null")
    return there.select(F.col("_key").alias(key), F.col("_n").alias("n_shingles"), F.col("_component").alias("component_id")).unionByName(
        alone.select(F.col("_key").alias(key), F.col("_n").alias("n_shingles"), F.col("_key").alias("component_id"))
    )
