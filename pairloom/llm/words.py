"""Words of many texts at once, as hashes in numpy arrays: tasks work on whole batches, not on single rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Characters that one step holds in memory; a longer text is a step of its own.
STEP_CHARS = 1 << 20
#: The same where a task's memory counts more: words_of takes about 40 bytes for each.
SHORT_STEP = 1 << 18

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_ODD = 0x2545F4914F6CDD1D
_INVERSE = pow(_ODD, -1, 1 << 64)
_BYTES = np.random.default_rng(20240229).integers(0, 1 << 64, 256, np.uint64)
_POWERS: dict[int, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64; up to the usual length of a step they are kept."""
    held = _POWERS.get(base)
    if held is None or len(held) < n:
        held = np.full(n, base, np.uint64)
        held[:1] = 1
        held = np.multiply.accumulate(held)
        if n <= 8 * STEP_CHARS:
            _POWERS[base] = held
    return held[:n]


def steps(texts: list, limit: int = STEP_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts with at most that many characters together, at least one text each."""
    yield from steps_of([len(t) for t in texts], limit)


def steps_of(sizes: list[int], limit: int = STEP_CHARS) -> Iterator[tuple[int, int]]:
    """The ranges that steps gives for texts of these sizes."""
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield start, len(sizes)


def byte_ranges(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts whose sizes in bytes add up to about the limit."""
    part = np.cumsum(sizes) // limit
    edges = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(sizes)])).tolist()
    yield from ((a, b) for a, b in zip(edges, edges[1:]) if b > a)


def words_of(texts: list[str], lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    """(hashes, offsets, starts, ends, data): 64-bit hashes of the words `[^\\x20\\x09-\\x0D]+` of all texts,
    where each text's words begin (one more entry than texts), and the words' places in the bytes data.
    With lower, A-Z count as a-z."""
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = b"\n".join(parts)
    data = data.lower() if lower else data  # of bytes, it changes A-Z alone
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), np.zeros(len(texts) + 1, np.int64), none, none, data
    edge = np.diff(np.concatenate(([True], _BLANK[raw], [True])).view(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTES[raw] * _powers(_ODD, len(raw)), out=total[1:])
    hashes = mix((total[ends] - total[starts]) * _powers(_INVERSE, len(raw))[starts] + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    ends_of_texts = np.cumsum([len(p) + 1 for p in parts])
    offsets = np.concatenate(([0], np.searchsorted(starts, ends_of_texts)))
    return hashes, offsets, starts, ends, data


def hashes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes and offsets of words_of, made in short steps: all that lies beside them is held for one step only."""
    made = [words_of(texts[a:b])[:2] for a, b in steps(texts, SHORT_STEP)]
    hashes = np.concatenate([np.zeros(0, np.uint64)] + [h for h, _ in made])
    counts = np.concatenate([np.zeros(1, np.int64)] + [np.diff(o) for _, o in made])
    return hashes, np.cumsum(counts)


def shingles_of(hashes: np.ndarray, offsets: np.ndarray, size: int = 5) -> Iterator[np.ndarray]:
    """For each text its set of word shingles, as sorted distinct hashes; a text with fewer words gives its
    whole sequence as one, a text without words none."""
    factors = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    n = len(hashes) - size + 1
    whole = np.zeros(max(n, 0), np.uint64)
    for k in range(size if n > 0 else 0):
        whole += hashes[k : k + n] * factors[k]
    whole = mix(whole)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= size:
            held = np.sort(whole[a : b - size + 1])
            yield held[np.concatenate(([True], held[1:] != held[:-1]))]
        elif b > a:
            yield mix((hashes[a:b] * factors[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)
