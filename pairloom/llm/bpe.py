"""Byte-level BPE: vectorised pre-tokenisation, cached pair merging, decoding by retained offsets.

Pre-tokenisation is the action of a small automaton on classes of code points. Each class is a function
from states to states; the functions form a finite monoid, so a text's states come from an associative
scan over small integers: blocks of positions are composed side by side, then the blocks' totals in the same way.
What the pattern looks ahead for (white space before more white space, the letters after an apostrophe) is
told from the arrays of classes beforehand. No regular expression runs. The slices between boundaries
go through a bounded cache to the pair merging.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import struct
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pairloom.llm.shared import giving_back, whole
from pairloom.llm.words import byte_ranges, steps

#: Characters of the slices whose merges a task keeps, and of one such slice.
CACHED = 4_000_000
LONGEST_CACHED = 128
#: Bytes of texts that are encoded, and whose tokens are sent, at a time.
SENT = 1 << 20

# Classes of code points, and the symbols that the automaton reads: a class, or what lies ahead of it.
_LETTER, _NUMBER, _OTHER, _SPACE = range(4)
LETTER, NUMBER, OTHER, SHORT, LONG, BLANK_NEXT, SPACE_NEXT, SPACE, RESET = range(9)
# States: what the last character belongs to. After `LEAD` (a blank that opens a slice) any run goes on.
END, IN_LETTERS, IN_NUMBERS, IN_OTHER, LEAD, IN_SPACE, TWO_LEFT, ONE_LEFT = range(8)
_WHITE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_BLOCK = 64
# Letters and numbers that Unicode 16 added; Python's own tables may be of an earlier version.
_NEW_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1),
    (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF),
    (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
_NEW_NUMBERS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
)


@cache
def _classes() -> np.ndarray:
    kinds = {"L": _LETTER, "N": _NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    for kind, added in ((_LETTER, _NEW_LETTERS), (_NUMBER, _NEW_NUMBERS)):
        for a, b in added:
            table[a : b + 1] = kind
    table[_WHITE] = _SPACE
    return table


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a slice begins at this symbol."""
    if symbol == LETTER:
        if state == TWO_LEFT:
            return ONE_LEFT, False
        if state == ONE_LEFT:
            return END, False
        return IN_LETTERS, state not in (IN_LETTERS, LEAD)
    if symbol == NUMBER:
        return IN_NUMBERS, state not in (IN_NUMBERS, LEAD)
    if symbol == OTHER:
        return IN_OTHER, state not in (IN_OTHER, LEAD)
    if symbol in (SHORT, LONG):  # an apostrophe before s t m d, or before re ve ll
        if state in (IN_OTHER, LEAD):
            return IN_OTHER, False
        return (ONE_LEFT if symbol == SHORT else TWO_LEFT), True
    if symbol == BLANK_NEXT:  # U+0020 before something else
        return LEAD, True
    if symbol == SPACE_NEXT:  # other white space before something else
        return END, True
    if symbol == SPACE:  # white space before white space or the end
        return IN_SPACE, state != IN_SPACE
    return END, True


@cache
def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(symbol -> element, products, actions of elements on states, boundaries by state and symbol)."""
    states, symbols = range(8), range(9)
    first = [tuple(_step(s, c)[0] for s in states) for c in symbols]
    number = {tuple(states): 0}
    queue = [tuple(states)]
    for f in queue:
        for g in first:
            h = tuple(g[x] for x in f)
            if h not in number:
                number[h] = len(number)
                queue.append(h)
    products = np.array([[number[tuple(g[x] for x in f)] for g in queue] for f in queue], np.uint8)
    starts = np.array([[_step(s, c)[1] for c in symbols] for s in states])
    assert len(number) < 256
    return np.array([number[f] for f in first], np.uint8), products, np.array(queue, np.uint8), starts


def _states(elements: np.ndarray, begin: int) -> np.ndarray:
    """The state after each position, by blocks: products within all blocks at once, then over their totals."""
    _, products, actions, _ = _monoid()
    n = len(elements)
    rows = -(-n // _BLOCK)
    padded = np.zeros(rows * _BLOCK, np.uint8)
    padded[:n] = elements
    across = padded.reshape(rows, _BLOCK).T.copy()
    for j in range(1, _BLOCK):
        across[j] = products[across[j - 1], across[j]]
    if rows > 1:
        before = np.concatenate(([begin], _states(across[-1, :-1], begin))).astype(np.uint8)
    else:
        before = np.full(1, begin, np.uint8)
    return actions[across, before[None, :]].T.reshape(-1)[:n]


def slice_starts(points: np.ndarray, resets: np.ndarray) -> np.ndarray:
    """Where slices begin in an array of code points; resets: line feeds that part two texts."""
    of_symbol, _, _, starts = _monoid()
    kind = _classes()[points]
    nothing = np.uint32(10)
    after = np.concatenate((points[1:], [nothing]))
    after2 = np.concatenate((points[2:], [nothing, nothing]))[: len(points)]
    symbols = kind.copy()  # letters, numbers and others are symbols as they are
    space = kind == _SPACE
    goes_on = np.concatenate((kind[1:] == _SPACE, [True]))
    symbols[space] = np.where(goes_on[space], SPACE, np.where(points[space] == 32, BLANK_NEXT, SPACE_NEXT))
    quote = np.flatnonzero(points == 39)
    a, b = after[quote], after2[quote]
    symbols[quote[np.isin(a, [ord(c) for c in "stmd"])]] = SHORT
    symbols[quote[((a == 114) | (a == 118)) & (b == 101) | (a == 108) & (b == 108)]] = LONG
    symbols[resets] = RESET
    state = _states(of_symbol[symbols], END)
    before = np.concatenate(([END], state[:-1]))
    return starts[before, symbols]


class Vocabulary:
    """Ranks read from lines of `base64 rank`, the merging of slices, and the bytes of all ids for decoding."""

    def __init__(self, lines: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines.splitlines() if x)}
        top = max(self.ranks.values(), default=-1) + 1
        parts = [b""] * top
        for token, i in self.ranks.items():
            parts[i] = token
        self.lengths = np.array([len(x) for x in parts], np.int64)
        self.places = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(parts), np.uint8)
        # The rank of each pair of ids that merges, by one integer.
        self.pairs = {}
        for token, i in self.ranks.items():
            for k in range(1, len(token)):
                a, b = self.ranks.get(token[:k]), self.ranks.get(token[k:])
                if a is not None and b is not None:
                    self.pairs[a << 32 | b] = i
        self.single = [self.ranks.get(bytes([i])) for i in range(256)]
        self.cached: dict[str, bytes] = {}
        self.cached_chars = 0

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """The ids of a slice: of all neighbours, those with the lowest rank are merged, the leftmost first."""
        ranks = self.ranks
        if piece in ranks:
            return (ranks[piece],)
        get, none = self.pairs.get, 1 << 32
        ids = [self.single[x] for x in piece]
        if len(ids) > 48:
            return self._merge_long(ids)
        low = [get(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
        while low and (least := min(low)) < none:
            i = low.index(least)
            ids[i] = least
            del ids[i + 1], low[i]
            if i:
                low[i - 1] = get(ids[i - 1] << 32 | least, none)
            if i < len(low):
                low[i] = get(least << 32 | ids[i + 1], none)
        return tuple(ids)

    def _merge_long(self, ids: list) -> tuple[int, ...]:
        """The same by a heap of pairs over a linked list: a long run without a boundary costs n log n."""
        get, n = self.pairs.get, len(ids)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = right[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # one of the two has been merged meanwhile
            ids[i], ids[j] = rank, None
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            for x in (left[i], i):
                y = right[x] if x >= 0 else n
                if y < n and (r := get(ids[x] << 32 | ids[y])) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return tuple(x for x in ids if x is not None)

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        cached = self.cached
        for a, b in steps(texts):
            joined = "\n".join(texts[a:b]) + "\n"
            points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
            resets = np.cumsum([len(t) + 1 for t in texts[a:b]]) - 1
            marks = np.flatnonzero(slice_starts(points, resets))
            if self.cached_chars > CACHED:
                cached.clear()
                self.cached_chars = 0
            marks = marks.tolist()
            ids = []
            for x, y in zip(marks, marks[1:] + [len(joined)]):
                piece = joined[x:y]
                got = cached.get(piece)
                if got is None:
                    merged = self.merge(piece.encode("utf-8", "replace"))
                    got = struct.pack(f"<{len(merged)}I", *merged)
                    if y - x <= LONGEST_CACHED:
                        cached[piece] = got
                        self.cached_chars += y - x
                ids.append(got)
            at = np.concatenate(([0], np.searchsorted(marks, resets) + 1)).tolist()
            for d in range(b - a):  # the last slice of each text is the line feed that parts it from the next
                yield np.frombuffer(b"".join(ids[at[d] : at[d + 1] - 1]), "<u4")

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """Where each token begins in the text's bytes, and their number."""
        return np.concatenate(([0], np.cumsum(self.lengths[ids])))

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> bytes:
        """The bytes of ids, each written at its offset."""
        sizes = self.lengths[ids]
        shift = np.repeat(self.places[ids] - offsets[:-1], sizes)
        return self.flat[shift + np.arange(len(shift))].tobytes()


def encode(
    docs: DataFrame, vocabulary: str, text: str = "text", arrays: bool = True, digests: bool = False, offsets: bool = True
) -> DataFrame:
    """docs without the text but with n_tokens; with arrays, ids (array of ids) and, with offsets too, offsets (byte places of
    the tokens, one more than ids); with digests, ids_sha256 (ids as little-endian unsigned 32-bit integers) and
    decoded_sha256 (the bytes decoded from them).

    vocabulary is a file of `base64 rank` lines on the driver; it has a fixed size and is broadcast.
    Null counts as empty; an empty text has no tokens; texts of any length are encoded whole; equal rows have equal results, an
    empty table gives an empty one. Other columns remain; one named like a result is an error. One narrow pass, no
    shuffle; a task holds the tokens of some texts at a time, or of one long text. It makes the vocabulary anew (about 0.15 s), so
    that a worker keeps neither it nor the merges for what comes after.
    """
    with open(vocabulary, "rb") as f:
        held = docs.sparkSession.sparkContext.broadcast(f.read())
    added = ["n_tokens long"] + ["ids array<int>"] * arrays + ["offsets array<long>"] * (arrays and offsets) + ["ids_sha256 string, decoded_sha256 string"] * digests
    rest = [f for f in docs.schema.fields if f.name != text]
    schema = T.StructType(rest + T._parse_datatype_string(", ".join(added)).fields)
    clash = {f.name for f in rest} & {f.name for f in schema.fields[len(rest) :]}
    if clash:
        raise ValueError(f"The columns {sorted(clash)} are there already")
    kinds = list(to_arrow_schema(schema))[len(rest) :]

    def values(vocab: Vocabulary, texts: list[str]) -> list:
        rows = []
        for ids in vocab.encode(texts):
            at = vocab.offsets(ids)
            row = [len(ids)] + [ids.astype(np.int32)] * arrays + [at] * (arrays and offsets)
            if digests:
                row += [hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(vocab.decode(ids, at)).hexdigest()]
            rows.append(row)
        return list(zip(*rows))

    def run(batches):
        vocab = None
        for batch in batches:
            vocab = vocab or Vocabulary(held.value)
            texts = batch.column(batch.num_columns - 1)
            for a, b in byte_ranges(pc.binary_length(texts).to_numpy(), SENT):
                made = [pa.array(v, k.type) for v, k in zip(values(vocab, texts.slice(a, b - a).to_pylist()), kinds)]
                yield pa.RecordBatch.from_arrays([c.slice(a, b - a) for c in batch.columns[:-1]] + made, names=schema.names)

    return docs.select(*[F.col(f"`{f.name}`") for f in rest], whole(F.col(text)).alias("_whole_text")).mapInArrow(giving_back(run), schema)


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """The rows of encode(digests=False) with text made again from ids and offsets, and without these."""
    with open(vocabulary, "rb") as f:
        held = encoded.sparkSession.sparkContext.broadcast(f.read())
    rest = [f for f in encoded.schema.fields if f.name not in ("ids", "offsets")]
    schema = T.StructType(rest + [T.StructField("text", T.StringType())])

    def run(batches):
        vocab = None
        for pdf in batches:
            vocab = vocab or Vocabulary(held.value)
            pairs = zip(pdf.pop("ids"), pdf.pop("offsets"))
            yield pdf.assign(text=[vocab.decode(np.asarray(i, np.int64), np.asarray(o, np.int64)).decode("utf-8", "replace") for i, o in pairs])

    return encoded.mapInPandas(giving_back(run), schema)
