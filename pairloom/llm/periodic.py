"""Runs of words that repeat with a period, by seeds and diagonals.

A run of period q has at least max(12 - q, q) places whose word equals the one q further on. Lags are taken in classes
[lo, 2 lo); all stretches of a class are long enough to hold one aligned block of k words (k = 3 for lags under 8,
else lo / 2) whole. Those blocks are the seeds: an index of k-grams gives the occurrences of a seed's words that lie a
lag of the class further on, and each such pair is extended along its diagonal. A table of the furthest place covered
per lag keeps one stretch from being extended twice. As there are n / k seeds with at most 2 k lags each, a class has
at most 2 n pairs, whatever the text; seeds deep within a run of much smaller period are left out beforehand.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.shared import add_columns, whole
from pairloom.llm.words import mix, steps, words_of

#: Words that a run has at least, beside twice its period. The classes of lags are made for this value.
LEAST = 12
#: Lags of the first class, and the k-gram and stride that fit its guaranteed overlap of 6.
_FIRST, _GRAM, _STRIDE = 8, 3, 4
#: Pairs that are held at once.
_PAIRS = 1 << 20


class _Runs:
    """The runs found so far in a step's words, in ascending order of lags."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.covered: dict[int, int] = {}
        self.found: dict[tuple[int, int], int] = {}

    def _matches(self, at: int, lag: int, step: int) -> int:
        """Up to which place, from at on, words are equal to those a lag further on; step: 1 to the right, -1 to the left.
        Texts are parted by words that occur once, so no stretch leaves its text."""
        words, width = self.words, 32
        while True:
            if step > 0:
                end = min(at + width, len(words) - lag)
                differs = words[at:end] != words[at + lag : end + lag]
                if differs.any():
                    return at + int(differs.argmax())
                if end == len(words) - lag:
                    return end
            else:
                end = max(at - width, -1)
                differs = words[end + 1 : at + 1] != words[end + 1 + lag : at + 1 + lag]
                if differs.any():
                    return at - int(differs[::-1].argmax())
                if end == -1:
                    return -1
            at, width = end, min(width * 2, 1 << 16)

    def extend(self, seeds: np.ndarray, lags: np.ndarray) -> None:
        """Pairs of places (seed, seed + lag) with equal words, of lags not smaller than those before."""
        order = np.lexsort((seeds, lags))
        lag_before, far = 0, -1
        for at, lag in zip(seeds[order].tolist(), lags[order].tolist()):
            if lag != lag_before:
                lag_before, far = lag, self.covered.get(lag, -1)
            if at < far or self.words[at] != self.words[at + lag]:
                continue
            stop = self._matches(at, lag, 1)
            start = self._matches(at, lag, -1) + 1 if at else 0
            far = self.covered[lag] = stop
            # A stretch with a smaller period is that period's run, which has the same ends and is known already.
            if stop + lag - start >= max(LEAST, 2 * lag):
                self.found.setdefault((start, stop + lag), lag)

    def covering(self, period: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the runs of at most that period in order, and the furthest end of the runs up to each."""
        held = sorted(k for k, q in self.found.items() if q <= period)
        starts, ends = np.array(held, np.int64).reshape(-1, 2).T
        return starts, np.maximum.accumulate(ends) if len(ends) else ends


def find_runs(hashes: np.ndarray, offsets: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """Per text its runs (start, length, period) by start, then period; words come as hashes, offsets part the texts."""
    texts = len(offsets) - 1
    sizes = np.diff(offsets)
    # One word that occurs nowhere else behind each text.
    words = np.insert(hashes, offsets[1:], mix(np.arange(texts, dtype=np.uint64) + np.uint64(1 << 40)))
    begins = offsets[:-1] + np.arange(texts)
    text_of = np.repeat(np.arange(texts), sizes + 1)
    place = np.arange(len(words)) - begins[text_of]
    runs = _Runs(words)

    gram = np.zeros(len(words), np.uint64)
    for k in range(_GRAM):
        gram[: len(words) - k] += words[k:] * (mix(np.array([k + 1], np.uint64)) | np.uint64(1))
    seeds = np.flatnonzero(place % _STRIDE == 0)
    for lag in range(1, _FIRST):
        inside = seeds[seeds + lag + _GRAM <= len(words)]
        same = inside[gram[inside] == gram[inside + lag]]
        runs.extend(same, np.full(len(same), lag))

    # Grams of 4 words, then of twice as many: what occurs once in its text has no longer gram that occurs again.
    k, longest = _FIRST // 2, int(sizes.max(initial=0))
    names = mix(text_of.astype(np.uint64)) + words
    live = np.arange(len(words))
    for half in (1, 2):
        names, live = _doubled(names, live, half)
    while 4 * k <= longest and len(live):
        # A table of counts by some bits of the name leaves few of those that occur once to be sorted.
        slots = (names & np.uint64((1 << (len(names).bit_length() + 2)) - 1)).astype(np.int64)
        again = np.bincount(slots)[slots] > 1
        names, live = names[again], live[again]
        if not len(names):
            break
        order = np.lexsort((live, names))
        names, live = names[order], live[order]
        same = names[1:] == names[:-1]
        repeated = np.concatenate((same, [False])) | np.concatenate(([False], same))
        names, live = names[repeated], live[repeated]
        if not len(names):
            break
        _pairs_of_class(runs, names, live, place, k)
        order = np.argsort(live)
        names, live = _doubled(names[order], live[order], k)
        k *= 2

    out: list[list[tuple[int, int, int]]] = [[] for _ in range(texts)]
    for (start, end), q in sorted(runs.found.items(), key=lambda x: (x[0][0], x[1])):
        t = int(text_of[start])
        out[t].append((start - int(begins[t]), end - start, q))
    return out


def _doubled(names: np.ndarray, live: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """From the names of grams of k words at the places live (ascending) those of grams of 2 k words."""
    at = np.searchsorted(live, live + k)
    held = at < len(live)
    held[held] = live[at[held]] == live[held] + k
    return mix(names[held] * np.uint64(0x9E3779B97F4A7C15) + mix(names[at[held]])), live[held]


def _pairs_of_class(runs: _Runs, names: np.ndarray, live: np.ndarray, place: np.ndarray, k: int) -> None:
    """Extend the pairs of aligned grams and their occurrences 2 k to 4 k - 1 words further on. names and live: the index
    of the grams of k words, ordered by name, then place."""
    width = np.int64(len(place) + 4 * k)
    group = np.cumsum(np.concatenate(([True], names[1:] != names[:-1]))) * width
    index = group + live
    aligned = np.flatnonzero(place[live] % k == 0)
    seeds, group = live[aligned], group[aligned]
    low = seeds + 2 * k
    # A gram within a run of at most half its period occurs in it at multiples of that period alone, which give
    # the same run again; so only what goes beyond the run's end counts.
    starts, ends = runs.covering(k // 2)
    if len(starts):
        at = np.searchsorted(starts, seeds, "right") - 1
        end = np.where(at >= 0, ends[at], 0)
        low = np.where(end >= seeds + k, np.maximum(low, end - k + 1), low)
    first = np.searchsorted(index, group + low)
    last = np.maximum(np.searchsorted(index, group + seeds + 4 * k), first)
    # By lags, so that smaller periods are known first; in parts of the range of lags that hold few pairs.
    most = max(1, int((last - first).sum()) // _PAIRS + 1)
    bounds = np.unique(np.linspace(2 * k, 4 * k, min(most, 2 * k) + 1).astype(np.int64))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        x = np.maximum(np.searchsorted(index, group + seeds + a), first) if most > 1 else first
        y = np.minimum(np.searchsorted(index, group + seeds + b), last) if most > 1 else last
        n = np.maximum(y - x, 0)
        if not n.any():
            continue
        of = np.repeat(np.arange(len(seeds)), n)
        hit = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + x[of]
        runs.extend(seeds[of], live[hit] - seeds[of])


def periodic_runs(docs: DataFrame, text: str = "text", runs: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """docs with the runs of each text, array of (start, length, period) in words by start, then period, and the text
    collapsed: its words without those that some run holds after its first period, joined by one space.

    Words are `[^\\x20\\x09-\\x0D]+` and equal if their 64-bit hashes are. A run is a stretch of words with smallest period q, of at
    least 12 and 2 q words, that no word beside it extends. Texts are whole; null and empty texts, and texts without
    words, have no runs and collapse to ''. Runs of equal length all count; equal rows have equal results. An empty table gives an
    empty one. Other columns remain; a column named like a result is an error. One narrow pass: no shuffle; a step holds
    a million characters or one text.
    """
    clash = {runs, collapsed} & set(docs.columns)
    if clash:
        raise ValueError(f"The columns {sorted(clash)} are there already; name the results otherwise")

    def compute(texts):
        found, kept = [], []
        for a, b in steps(texts):
            hashes, offsets, starts, ends, data = words_of(texts[a:b], lower=False)
            for t, held in enumerate(find_runs(hashes, offsets)):
                x, y = int(offsets[t]), int(offsets[t + 1])
                found.append([{"start": s, "length": n, "period": q} for s, n, q in held])
                keep = np.ones(y - x, bool)
                for s, n, q in held:
                    keep[s + q : s + n] = False
                at = np.flatnonzero(keep) + x
                kept.append(b" ".join([data[i:j] for i, j in zip(starts[at].tolist(), ends[at].tolist())]).decode("utf-8", "surrogatepass"))
        return found, kept

    added = f"`{runs}` array<struct<start: long, length: long, period: long>>, `{collapsed}` string"
    return add_columns(docs, whole(F.col(text)), compute, added)
