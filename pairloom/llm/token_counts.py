"""Exact token counts of every prefix of a text, by dynamic programming over byte-level BPE.

The merges of a byte string end in a token that depends on the string alone, so the tokens of a prefix are those of a
shorter prefix and one more: of all tokens that the prefix ends in, the one that would stay apart from the last
token of what is before it (the two alone, merged, remain the two). Counts follow: one more than at the shorter prefix.
The rule is applied to the slices that the tokenizer parts a text into, each distinct slice once per task as long as it
is remembered. A prefix's slices are those of the text up to its end but for two cases, which are counted apart: white space that
ends the prefix is one slice (in the text its last character belongs to what follows), and an apostrophe with one letter
of a longer contraction is two.

The counts answer questions about prefixes and budgets by SQL alone; nothing is encoded again.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pairloom.llm.bpe import slice_starts
from pairloom.llm.shared import whole
from pairloom.llm.words import STEP_CHARS, steps

#: Counts of remembered slices (with the slices, some 200 MB) and remembered pairs of tokens (some 60 MB) of a task.
HELD_COUNTS = 1 << 23
HELD_PAIRS = 1 << 19
#: Characters of a slice that is remembered beyond its step.
LONG_SLICE = 256
#: Counts in one row of the result.
CHUNK = 1 << 16
#: Slices by two letters, which a prefix can cut.
_CONTRACTIONS = ("'re", "'ve", "'ll")
#: A blank between word characters always opens a slice, so what follows is counted as a text of its own.
_SAFE = re.compile(r"(?<=\w) (?=\w)")


def byte_symbols() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies: printable Latin-1 for itself, the
    other bytes from U+0100 on, in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


class PrefixCounter:
    """Counts by a tokenizer file (JSON) of byte-level BPE without normalisation."""

    def __init__(self, held: bytes):
        made = json.loads(held)
        model, splitter = made["model"], made["pre_tokenizer"]
        if model["type"] != "BPE" or splitter["type"] != "ByteLevel" or splitter["add_prefix_space"] or made["normalizer"] or model["ignore_merges"]:
            raise ValueError("Only byte-level BPE without normalisation and added blanks is counted")
        symbols = byte_symbols()
        own = {t["content"] for t in made["added_tokens"]}
        for t in made["added_tokens"]:
            if t["single_word"] or t["lstrip"] or t["rstrip"]:
                raise ValueError(f"Added token {t['content']!r} takes in what is beside it")
            if any(o in t["content"][:-1] for o in own):
                raise ValueError(f"Added token {t['content']!r} holds another")
        to_bytes = lambda s: bytes(symbols[c] for c in s)
        ids = {to_bytes(s): i for s, i in model["vocab"].items() if s not in own}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.merges = {}
        for rank, (a, b) in enumerate(pairs):
            a, b = to_bytes(a), to_bytes(b)
            self.merges[ids[a], ids[b]] = (rank, ids[a + b])
        self.single = [ids[bytes([b])] for b in range(256)]
        self.special = re.compile("|".join(map(re.escape, sorted(own, key=len, reverse=True)))) if own else None
        self.tokens = {t: i for t, i in ids.items() if self._merged(t) == [i]}
        self.bytes_of = {i: t for t, i in self.tokens.items()}
        # Finds the tokens that end at each place of a slice, the longest first; bytes are characters up to U+00FF to it.
        self.finder = ahocorasick.Automaton()
        for t, i in self.tokens.items():
            self.finder.add_word(t.decode("latin-1"), (i, len(t) - 1))
        self.finder.make_automaton()
        self.apart: dict[int, bool] = {}
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        self.new: list[int] = []
        self.places: list[int] = []
        self.totals: list[int] = []

    def _merged(self, piece: bytes) -> list[int]:
        """The tokens of a short byte string."""
        ids = [self.single[b] for b in piece]
        while len(ids) > 1:
            found = [(self.merges[p], k) for k, p in enumerate(zip(ids, ids[1:])) if p in self.merges]
            if not found:
                break
            (_, token), k = min(found)
            ids[k : k + 2] = [token]
        return ids

    def _stay_apart(self, a: int, b: int) -> bool:
        """Do two tokens, merged as one string, remain these two? The answer is remembered."""
        if len(self.apart) >= HELD_PAIRS:
            self.apart.clear()
        found = self.apart[a << 32 | b] = self._merged(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return found

    def prefix_counts(self, piece: bytes) -> list[int]:
        """Tokens of each prefix of one slice, by bytes, from the empty one on."""
        last, counts = [-1], [0]
        known, done = self.apart.get, 0
        for end, (token, before) in self.finder.iter(piece.decode("latin-1")):
            if end < done:
                continue
            begin = end - before
            if begin:
                fits = known(last[begin] << 32 | token)
                if not (self._stay_apart(last[begin], token) if fits is None else fits):
                    continue
            last.append(token)
            counts.append(counts[begin] + 1)
            done = end + 1
        return counts

    def _number(self, piece: str) -> int:
        """The place of a slice among those remembered, for one that is new."""
        held = piece.encode("utf-8", "replace")
        counts = self.prefix_counts(held)
        if len(held) != len(piece):
            counts = [n for n, b in zip(counts, held) if b & 0xC0 != 0x80] + counts[-1:]
        if piece in _CONTRACTIONS:
            counts[2] = 2
        self.places.append(self.used)
        self.totals.append(counts[-1])
        self.used += len(counts) - 1
        self.new += counts[1:]
        self.known[piece] = number = len(self.places) - 1
        return number

    def _flat(self) -> np.ndarray:
        """The counts of all slices remembered, one behind the other."""
        if self.used > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros(max(len(self.flat), len(self.new)), np.int32)))
        self.flat[self.used - len(self.new) : self.used] = self.new
        self.new = []
        return self.flat

    def _counts(self, texts: list[str]) -> Iterator[np.ndarray]:
        """For each text, taken without special tokens, the tokens of its prefixes by code points."""
        if self.used > HELD_COUNTS:
            self._forget()
        joined = "\n".join(texts) + "\n"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        resets = np.cumsum([len(t) + 1 for t in texts]) - 1
        marks = np.flatnonzero(slice_starts(points, resets))
        lengths = np.diff(np.concatenate((marks, [len(points)])))
        known, number = self.known, self._number
        places = marks.tolist()
        pieces = [joined[x:y] for x, y in zip(places, places[1:] + [len(joined)])]
        of = [known.get(p, -1) for p in pieces]
        for k in np.flatnonzero(np.array(of, np.int64) < 0).tolist():
            p = pieces[k]
            of[k] = known[p] if p in known else number(p)
        of = np.array(of, np.int64)
        totals = np.array(self.totals, np.int64)[of]
        totals[np.searchsorted(marks, resets)] = 0  # the line feeds between texts
        before = np.cumsum(totals) - totals
        counts = np.repeat(before, lengths) + self._flat()[np.repeat(np.array(self.places, np.int64)[of] - marks, lengths) + np.arange(len(points))]

        parted = np.zeros(len(points) + 2, bool)
        parted[resets + 1], parted[resets + 2] = True, True  # the first two places of a text have no white space before them both
        space = np.isin(points, _white(points))
        ends = np.flatnonzero(space[:-2] & space[1:-1] & ~space[2:] & ~parted[2 : len(points)]) + 2
        begins = np.searchsorted(marks, ends - 2, "right") - 1
        for end, k in zip(ends.tolist(), begins.tolist()):
            p = joined[places[k] : end]
            i = known[p] if p in known else number(p)
            counts[end - 1] = before[k] + self.totals[i]

        start = 0
        for end in resets.tolist():
            first = before[np.searchsorted(marks, start)]
            yield counts[start:end] - first
            start = end + 1
        for p in [p for p in known if len(p) > LONG_SLICE]:
            del known[p]

    def of_texts(self, texts: list[str]) -> Iterator[tuple[int, list[np.ndarray]]]:
        """For each text its number and, in parts, the tokens of all its prefixes."""
        parts = [(i, piece, special) for i, t in enumerate(texts) for piece, special in self._windows(t)]
        base, held, of = 0, [], 0
        for a, b in steps([p[1] for p in parts]):
            for (i, piece, special), counts in zip(parts[a:b], self._counts([p[1] for p in parts[a:b]])):
                if i != of:
                    yield of, held
                    base, held, of = 0, [], i
                counts = counts + base
                if special:  # up to its last character a special token is ordinary text, then it is one token
                    before = len(piece) - (special - 1)
                    counts = np.concatenate((counts, [(counts[before - 1] if before else base) + 1]))
                if len(counts):
                    base = int(counts[-1])
                held.append(counts.astype(np.int32))
        if texts:
            yield of, held

    def _windows(self, text: str) -> Iterator[tuple[str, int]]:
        """The text in parts that are counted by themselves: (part, length of the special token that it ends in before its last
        character, or 0). At least one part."""
        start, special = 0, self.special
        for m in special.finditer(text) if special else ():
            *whole_parts, rest = self._cut(text[start : m.start()])
            yield from ((p, 0) for p in whole_parts)
            yield rest + m.group()[:-1], len(m.group())
            start = m.end()
        yield from ((p, 0) for p in self._cut(text[start:]))

    @staticmethod
    def _cut(text: str) -> Iterator[str]:
        """Parts of about STEP_CHARS characters; a text without a safe place is one part."""
        start = 0
        while len(text) - start > STEP_CHARS and (m := _SAFE.search(text, start + STEP_CHARS)):
            yield text[start : m.start()]
            start = m.start()
        yield text[start:]


def _white(points: np.ndarray) -> np.ndarray:
    """The white space among the code points at hand, as the slices have it."""
    from pairloom.llm.bpe import _SPACE, _classes

    found = np.unique(points)
    return found[_classes()[found] == _SPACE]


_HELD: dict = {}


def _counter(held) -> PrefixCounter:
    if _HELD.get("of") is not held.value:
        _HELD.update(of=held.value, made=PrefixCounter(held.value))
    return _HELD["made"]


def prefix_counts(docs: DataFrame, tokenizer: str, text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """The exact token count of every prefix of every text: docs without the text, in rows (chunk, first, counts,
    n_bytes, last) of at most `chunk` counts, so that long texts make no long rows. counts[i] is the number of tokens of
    the first `first + i + 1` code points, encoded by themselves; n_bytes is the UTF-8 length up to the row's end; last
    marks a text's last row.

    tokenizer is a JSON file of byte-level BPE on the driver; it has a fixed size and is broadcast. Special
    strings within texts are special tokens, as the library has it by default; nothing is added, truncated or padded.
    A null or empty text has one row without counts. Texts are whole; a text is counted in parts cut at blanks between
    words, so memory is bounded unless it has none. Equal rows have equal rows; an empty table gives an empty one. Other
    columns remain, and one named like a result is an error. One narrow pass: no shuffle.
    """
    with open(tokenizer, "rb") as f:
        held = docs.sparkSession.sparkContext.broadcast(f.read())
    added = T._parse_datatype_string("chunk int, first long, counts array<int>, n_bytes long, last boolean").fields
    rest = [f for f in docs.schema.fields if f.name != text]
    clash = {f.name for f in rest} & {f.name for f in added}
    if clash:
        raise ValueError(f"The columns {sorted(clash)} are there already")
    schema = T.StructType(rest + added)
    kinds = list(to_arrow_schema(T.StructType(added)))

    def rows_of(batch, rows):
        at = pa.array([r[0] for r in rows], pa.int64())
        sizes = np.cumsum([0] + [len(r[3]) for r in rows]).astype(np.int32)
        counts = pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate([r[3] for r in rows] or [np.zeros(0, np.int32)])))
        made = [pa.array([r[k] for r in rows], kinds[i].type) for i, k in ((0, 1), (1, 2), (3, 4), (4, 5))]
        columns = [c.take(at) for c in batch.columns[:-1]] + made[:2] + [counts.cast(kinds[2].type)] + made[2:]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    def run(batches):
        for batch in batches:
            counter, texts = _counter(held), batch.column(batch.num_columns - 1).to_pylist()
            rows, sent = [], 0
            for i, parts in counter.of_texts(texts):
                counts = np.concatenate(parts)
                n_bytes = 0
                for c, first in enumerate(range(0, max(len(counts), 1), chunk)):
                    n_bytes += len(texts[i][first : first + chunk].encode("utf-8", "replace"))
                    rows.append((i, c, first, counts[first : first + chunk], n_bytes, first + chunk >= len(counts)))
                sent += len(counts)
                if sent >= STEP_CHARS:
                    yield rows_of(batch, rows)
                    rows, sent = [], 0
            yield rows_of(batch, rows)

    columns = [F.col(f"`{f.name}`") for f in rest]
    return docs.select(*columns, whole(F.col(text)).alias("_whole_text")).mapInArrow(run, schema)


def totals(table: DataFrame) -> DataFrame:
    """One row per text from the rows of prefix_counts: the other columns, n_bytes and n_tokens."""
    tokens = F.coalesce(F.get("counts", F.size("counts") - 1), F.lit(0)).cast("long")
    return table.where("last").withColumn("n_tokens", tokens).drop("chunk", "first", "counts", "last")


def tokens_of_prefix(length: Column) -> Column:
    """The tokens of the first `length` code points; null in the rows of prefix_counts that do not hold that prefix (that of
    no code points is in each text's first row)."""
    at = length - F.col("first") - 1
    return F.when((length == 0) & (F.col("first") == 0), 0).when((at >= 0) & (at < F.size("counts")), F.get("counts", at.cast("int")))


def longest_within(table: DataFrame, budget: int, keys: list[str]) -> DataFrame:
    """Per text (named by its keys) the code points of its longest prefix of at most `budget` tokens. More text can mean
    fewer tokens, so it is the last prefix that fits, not the one before the first that does not. The rows of one
    text combine before the shuffle."""
    fits = F.reverse(F.transform("counts", lambda c: c <= F.lit(budget)))
    at = F.array_position(fits, True)
    reached = F.when(at > 0, F.col("first") + F.size("counts") - at + 1).otherwise(0)
    return table.groupBy(*keys).agg(F.max(reached).cast("long").alias("n_chars"))


def truncated(docs: DataFrame, table: DataFrame, budget: int, key: str, text: str = "text") -> DataFrame:
    """docs with each text cut to its longest prefix of at most `budget` tokens; key is unique and not null."""
    lengths = longest_within(table, budget, [key]).withColumnRenamed("n_chars", "_n_chars")
    cut = F.substring(F.col(text), F.lit(1), F.col("_n_chars").cast("int"))
    return docs.join(lengths, key).withColumn(text, cut).drop("_n_chars")
