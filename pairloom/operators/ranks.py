"""Values at ranks of numeric columns, exactly: ranges of integer images are counted until each rank's range holds one value."""

from __future__ import annotations

import math
import struct
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits that one pass resolves: at most 4,096 counts per range looked into.
_BITS = 12
_LOW = (1 << 63) - 1


def ordered_image(x: Column) -> Column:
    """A 64-bit integer per double, in the same order (one for both zeros; NaN is the greatest). To be computed in a
    table that is written: the expression is not among those that Spark plans freely."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), x + F.lit(0.0)).cast("bigint")
    return F.when(bits >= 0, bits).otherwise(bits.bitwiseXOR(F.lit(_LOW)))


def value_of_image(image: int) -> float:
    return struct.unpack("<d", struct.pack("<q", image if image >= 0 else image ^ _LOW))[0]


def images_at_ranks(
    images: DataFrame, ranks_of_total: Callable[[int], list[int]]
) -> dict[int, tuple[int, dict[int, int]]]:
    """Per column number its count of values and the images at the 1-based ranks that ``ranks_of_total(count)`` asks for.

    ``images`` has the columns ``column`` (int) and ``image`` (not null). All ranks of all columns are searched for in the same
    passes, six at most; each counts the rows per leading bits of the ranges that hold a rank, which combines before the
    shuffle, whatever the spread of the values. A range of one value is found by its bounds.
    """
    shift, found, totals = 64 - _BITS, {}, {}
    open_ranks: dict[tuple[int, int | None], list[tuple[int, int]]] = {}  # (column, range) -> (rank, rank within the range)
    before = None
    while True:
        rows = images
        if before is not None:
            inside = [
                (F.col("column") == c) & F.shiftright("image", before).isin([p for k, p in open_ranks if k == c])
                for c in sorted({c for c, _ in open_ranks})
            ]
            rows = images.where(reduce(Column.__or__, inside))
        counts = (
            rows.groupBy("column", F.shiftright("image", shift).alias("lead"))
            .agg(F.count("*").alias("n"), F.min("image").alias("low"), F.max("image").alias("high"))
            .orderBy("column", "lead")
            .collect()
        )
        ranges: dict[tuple[int, int | None], list] = {}
        for r in counts:
            ranges.setdefault((r["column"], None if before is None else r.lead >> (before - shift)), []).append(r)
        if before is None:
            totals = {c: sum(r.n for r in held) for (c, _), held in ranges.items()}
            open_ranks = {(c, None): [(n, n) for n in ranks_of_total(t)] for c, t in totals.items()}
            found = {c: {} for c in totals}
        narrower: dict[tuple[int, int | None], list[tuple[int, int]]] = {}
        for (c, p), wanted in open_ranks.items():
            for rank, within in wanted:
                for r in ranges[c, p]:
                    if within <= r.n:
                        break
                    within -= r.n
                if r.low == r.high:
                    found[c][rank] = r.low
                else:
                    narrower.setdefault((c, r.lead), []).append((rank, within))
        if not narrower:
            return {c: (totals[c], found[c]) for c in totals}
        open_ranks, before, shift = narrower, shift, max(shift - _BITS, 0)


def percentiles(images: DataFrame, probabilities: tuple[float, ...]) -> dict[int, tuple[int, list[float]]]:
    """Per column number its count of values and its percentiles, interpolated between the two values next to each."""

    def ranks(total: int) -> list[int]:
        places = [(total - 1) * q for q in probabilities]
        return sorted({math.floor(p) + 1 for p in places} | {math.ceil(p) + 1 for p in places})

    made = {}
    for c, (total, at) in images_at_ranks(images, ranks).items():
        values = {rank: value_of_image(i) for rank, i in at.items()}
        made[c] = (total, [])
        for q in probabilities:
            place = (total - 1) * q
            low, high = values[math.floor(place) + 1], values[math.ceil(place) + 1]
            made[c][1].append(low if low == high else low + (high - low) * (place - math.floor(place)))
    return made
