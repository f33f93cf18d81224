"""Alignment of two tokenizers' tokens of the same bytes, by fragments that compose.

The places where tokens of both end cut a text into groups. A range of a text's bytes is described by a fragment: the
tokens up to its first common end (open: what they belong to begins before the range), its closed groups, and the
tokens after its last common end (open: they go on behind it). Fragments of neighbouring ranges compose, and composing
is associative, so long texts are cut into ranges, described by many tasks and composed in a tree; a short text is one range.

Links are the pairs of tokens that share bytes: for each place where a token of either ends, the two tokens that hold
the byte before it. How many texts hold a pair of ids linked is counted over the corpus: each batch of texts sends
its distinct pairs once, with the number of texts, and gets their counts back.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property, reduce
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pairloom.llm.bpe import Vocabulary
from pairloom.llm.shared import whole, written
from pairloom.llm.token_counts import byte_symbols
from pairloom.llm.words import byte_ranges, steps

#: Bytes of the range of one fragment; longer texts are described by several.
RANGE = 1 << 16
#: Fragments composed by one task at a time.
FAN_IN = 32
#: Bytes of a batch of texts, whose distinct pairs are counted together, and characters that are aligned at once.
BATCH_BYTES = 1 << 21
STEP = 1 << 18
#: Ids that a tokenizer may have.
MOST_IDS = 1 << 18
#: Fixed value: the public expression by which byte-level BPE parts a text.
SLICES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LONG_SPACE = re.compile(r"\s{1024}")
#: Blanks between word characters: tokens of neither tokenizer go over their left side.
_SAFE = re.compile(r"(?<=\w) (?=\w)")
_COMMA, _BAR, _SEMICOLON = b",|;"

Tokens = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # ids and ends of the one, ids and ends of the other
_NONE: Tokens = tuple(np.zeros(0, np.int64) for _ in range(4))


def _joined(x: Tokens, y: Tokens) -> Tokens:
    return tuple(np.concatenate(p) for p in zip(x, y))


def links_of(tokens: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ends of either, ids of the one, ids of the other): the links of closed groups, in order."""
    a, a_ends, b, b_ends = tokens
    ends = np.sort(np.concatenate((a_ends, b_ends)), kind="stable")
    ends = ends[np.concatenate(([True], ends[1:] != ends[:-1]))] if len(ends) else ends
    return ends, a[np.searchsorted(a_ends, ends)], b[np.searchsorted(b_ends, ends)]


def groups_of(tokens: Tokens, digits: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, places behind the groups, ends of the groups) of closed groups: `a1,a2|b1;` for each, in order, as bytes."""
    a, a_ends, b, b_ends = tokens
    table, sizes = digits
    at = np.searchsorted(b_ends, a_ends)
    common = b_ends[np.minimum(at, len(b_ends) - 1)] == a_ends
    last_a, last_b = np.flatnonzero(common), at[common]
    # Where each token comes in the text: behind the tokens of its own side and those of the other side before it.
    b_before = np.concatenate(([0], last_b + 1))
    place_a = np.arange(len(a)) + b_before[np.cumsum(common) - common]
    closes = np.zeros(len(b), np.int64)
    closes[last_b] = 1
    place_b = np.arange(len(b)) + (last_a + 1)[np.cumsum(closes) - closes]
    ids = np.empty(len(a) + len(b), np.int64)
    ids[place_a], ids[place_b] = a, b
    marks = np.full(len(ids), _COMMA, np.uint8)
    marks[place_a[last_a]], marks[place_b[last_b]] = _BAR, _SEMICOLON
    wide = table[ids]
    size = sizes[ids].astype(np.int64)
    wide[np.arange(len(ids)), size] = marks
    text = wide[np.arange(wide.shape[1]) <= size[:, None]]
    return text, np.cumsum(size + 1)[place_b[last_b]], a_ends[common]


@dataclass
class Fragment:
    """What is known of a range of bytes. Without a cut all its tokens are in `head`."""

    begin: int
    head: Tokens = _NONE
    tail: Tokens = _NONE
    cut: bool = False
    valid: bool = True
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    groups: list[bytes] = field(default_factory=list)
    codes: list[np.ndarray] = field(default_factory=list)


class Aligner:
    """One: a JSON file of byte-level BPE, taken without special tokens. Other: a sentencepiece model that puts a blank before a
    text. Both are held as bytes; what a task doesn't need isn't made, as composing needs no tokenizer."""

    def __init__(self, one: bytes, other: bytes):
        self.files = one, other

    @cached_property
    def ranks(self) -> dict[bytes, int]:
        made = json.loads(self.files[0])
        model, symbols, own = made["model"], byte_symbols(), {t["content"] for t in made["added_tokens"]}
        if model["type"] != "BPE" or made["normalizer"] or made["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("The one tokenizer must be byte-level BPE without normalisation")
        order = [model["vocab"]["".join(m) if not isinstance(m, str) else m.replace(" ", "")] for m in model["merges"]]
        if order != sorted(order):
            raise ValueError("The one tokenizer's ids must be in the order of its merges")
        return {bytes(symbols[c] for c in s): i for s, i in model["vocab"].items() if s not in own}

    @cached_property
    def one(self):
        import tiktoken

        return tiktoken.Encoding("one", pat_str=SLICES, mergeable_ranks=self.ranks, special_tokens={})

    @cached_property
    def one_without_regex(self) -> Vocabulary:
        return Vocabulary(b"\n".join(base64.b64encode(t) + b" %d" % i for t, i in self.ranks.items()))

    @cached_property
    def one_sizes(self) -> np.ndarray:
        sizes = np.zeros(max(self.ranks.values()) + 1, np.int64)
        for t, i in self.ranks.items():
            sizes[i] = len(t)
        return sizes

    @cached_property
    def other(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=self.files[1])

    @cached_property
    def other_bytes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sizes, places, bytes) of the other's pieces."""
        pieces = [self.other.id_to_piece(i) for i in range(self.other.get_piece_size())]
        parts = [bytes([int(p[3:5], 16)]) if self.other.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        sizes = np.array([len(p) for p in parts], np.int64)
        return sizes, np.cumsum(sizes) - sizes, np.frombuffer(b"".join(parts), np.uint8)

    @property
    def cuttable(self) -> bool:
        """Does no piece of the other go over the left side of a blank?"""
        return not any("▁" in self.other.id_to_piece(i).lstrip("▁") for i in range(self.other.get_piece_size()))

    @cached_property
    def digits(self) -> tuple[np.ndarray, np.ndarray]:
        """The ids' decimal digits, with room for a mark, and their number."""
        names = [str(i) for i in range(MOST_IDS)]
        width = len(names[-1]) + 1
        text = np.array([n.ljust(width) for n in names], f"S{width}")
        return text.view(np.uint8).reshape(MOST_IDS, width), np.array([len(n) for n in names], np.uint8)

    def tokens(self, texts: list[str]) -> tuple[list[bool], list[bytes], Tokens, np.ndarray, np.ndarray]:
        """(validity of each text, their bytes, the valid texts' tokens with ends counted through them all, and how many tokens
        of the one and of the other each has). A blank is put before each text."""
        sources = [(" " + t).encode("utf-8", "replace") for t in texts]
        of_b = self.other.encode(texts, num_threads=1) if texts else []
        sizes = np.array([len(x) for x in of_b], np.int64)
        b = np.fromiter(chain.from_iterable(of_b), np.int64, int(sizes.sum()))
        b_sizes, b_places, b_flat = self.other_bytes
        lengths = b_sizes[b]
        stops = np.cumsum(lengths)
        made = b_flat[np.repeat(b_places[b] - (stops - lengths), lengths) + np.arange(int(lengths.sum()))].tobytes()
        edges = np.concatenate(([0], stops))[np.concatenate(([0], np.cumsum(sizes)))].tolist()
        valid = [bool(t) and made[x:y] == s for t, x, y, s in zip(texts, edges, edges[1:], sources)]
        kept = np.array(valid, bool)
        of_a = [self._one_ids(" " + t) if v else () for t, v in zip(texts, valid)]
        n_a = np.array([len(x) for x in of_a], np.int64)
        a = np.fromiter(chain.from_iterable(of_a), np.int64, int(n_a.sum()))
        b = b[np.repeat(kept, sizes)]
        return valid, sources, (a, np.cumsum(self.one_sizes[a]), b, np.cumsum(b_sizes[b])), n_a, np.where(kept, sizes, 0)

    def _one_ids(self, text: str) -> list[int] | np.ndarray:
        """The one's ids. The library's regular expression overflows its stack on very long white space; such texts are sliced
        without it."""
        return next(self.one_without_regex.encode([text])) if _LONG_SPACE.search(text) else self.one.encode_ordinary(text)

    def whole_texts(self, texts: list[str]) -> Iterator[tuple[int, int, int, str, np.ndarray]]:
        """For each text (tokens of the one, of the other, groups, their text, the links' codes): one fragment each, closed
        on both sides."""
        valid, sources, tokens, n_a, n_b = self.tokens(texts)
        ends, x, y = links_of(tokens)
        codes = x << 32 | y
        text, behind, group_ends = groups_of(tokens, self.digits) if len(x) else (np.zeros(0, np.uint8),) * 3
        text = text.tobytes().decode("ascii")
        done = np.cumsum([len(s) if v else 0 for s, v in zip(sources, valid)])
        links = np.concatenate(([0], np.searchsorted(ends, done, "right"))).tolist()
        groups = np.concatenate(([0], np.searchsorted(group_ends, done, "right"))).tolist()
        edges = np.concatenate(([0], behind)).tolist()
        for t in range(len(texts)):
            g, h = groups[t], groups[t + 1]
            yield int(n_a[t]), int(n_b[t]), h - g, text[edges[g] : max(edges[h] - 1, edges[g])], codes[links[t] : links[t + 1]]

    @staticmethod
    def pieces(text: str, cuttable: bool) -> Iterator[tuple[int, str]]:
        """Parts of a long text that are encoded by themselves, each without the blank before it, and the place of that
        blank in the bytes of the text with its own blank. A text without a safe place is one part."""
        start, place = 0, 0
        while cuttable and len(text) - start > RANGE and (m := _SAFE.search(text, start + RANGE)):
            part = text[start : m.start()]
            yield place, part
            start, place = m.end(), place + 1 + len(part.encode("utf-8", "replace"))
        yield place, text[start:]

    def fragments(self, place: int, part: str) -> Iterator[Fragment]:
        """The fragments of a part by ranges of bytes, whose borders are multiples of RANGE."""
        valid, sources, (a, a_ends, b, b_ends), _, _ = self.tokens([part])
        if not valid[0]:
            yield Fragment(place, valid=False)
            return
        a_ends, b_ends = a_ends + place, b_ends + place
        for low in range(place // RANGE * RANGE, place + len(sources[0]), RANGE):
            i, j = np.searchsorted(a_ends, [low, low + RANGE], "right")
            k, n = np.searchsorted(b_ends, [low, low + RANGE], "right")
            yield self.described(max(low, place), (a[i:j], a_ends[i:j], b[k:n], b_ends[k:n]))

    def described(self, begin: int, tokens: Tokens) -> Fragment:
        a, a_ends, b, b_ends = tokens
        made = Fragment(begin, n_a=len(a), n_b=len(b))
        common = np.intersect1d(a_ends, b_ends, assume_unique=True)
        if not len(common):
            made.head = tokens
            return made
        first, last = common[0], common[-1]
        i, j = np.searchsorted(a_ends, [first, last], "right")
        k, n = np.searchsorted(b_ends, [first, last], "right")
        made.cut = True
        made.head = (a[:i], a_ends[:i], b[:k], b_ends[:k])
        made.tail = (a[j:], a_ends[j:], b[n:], b_ends[n:])
        self._close(made, (a[i:j], a_ends[i:j], b[k:n], b_ends[k:n]))
        return made

    def _close(self, made: Fragment, tokens: Tokens) -> None:
        if len(tokens[0]):
            _, x, y = links_of(tokens)
            text, behind, _ = groups_of(tokens, self.digits)
            made.codes.append(x << 32 | y)
            made.groups.append(text.tobytes())
            made.n_groups += len(behind)

    def composed(self, x: Fragment, y: Fragment) -> Fragment:
        """x, which is to the left, and y as one fragment. x is not to be used afterwards."""
        made = Fragment(x.begin, valid=x.valid and y.valid, cut=x.cut or y.cut, n_a=x.n_a + y.n_a, n_b=x.n_b + y.n_b)
        made.n_groups, made.groups, made.codes = x.n_groups, x.groups, x.codes
        between = _joined(x.tail if x.cut else x.head, y.head)
        made.head, made.tail = (x.head, between) if x.cut else (between, y.tail)
        if x.cut and y.cut:
            self._close(made, between)
            made.tail = y.tail
        made.n_groups += y.n_groups
        made.groups += y.groups
        made.codes += y.codes
        return made

    def finished(self, x: Fragment) -> tuple[int, int, int, str, np.ndarray]:
        """A whole text's fragment in the form of whole_texts: its ends are common ends, so nothing stays open."""
        if not x.valid:
            return 0, 0, 0, "", np.zeros(0, np.int64)
        first = Fragment(0)
        self._close(first, x.head)
        self._close(x, x.tail)
        groups = b"".join(first.groups + x.groups)[:-1].decode("ascii")
        return x.n_a, x.n_b, first.n_groups + x.n_groups, groups, np.concatenate(first.codes + x.codes or [np.zeros(0, np.int64)])


# A fragment as a row: its lists travel as bytes of 64-bit integers.
_FRAGMENT = "row long, begin long, cut boolean, valid boolean, n_a long, n_b long, n_groups long, groups binary, codes binary, head array<binary>, tail array<binary>"


def _to_row(row: int, x: Fragment) -> dict:
    raw = lambda tokens: [t.tobytes() for t in tokens]
    codes = np.concatenate(x.codes or [np.zeros(0, np.int64)]).tobytes()
    return {"row": row, "begin": x.begin, "cut": x.cut, "valid": x.valid, "n_a": x.n_a, "n_b": x.n_b, "n_groups": x.n_groups,
            "groups": b"".join(x.groups), "codes": codes, "head": raw(x.head), "tail": raw(x.tail)}


def _from_row(r: dict) -> Fragment:
    tokens = lambda held: tuple(np.frombuffer(h, np.int64) for h in held)
    return Fragment(r["begin"], tokens(r["head"]), tokens(r["tail"]), r["cut"], r["valid"], r["n_a"], r["n_b"], r["n_groups"],
                    [r["groups"]], [np.frombuffer(r["codes"], np.int64)])


def _packed(places: np.ndarray) -> bytes:
    """Ascending places as steps of 2 or 4 bytes, led by which it is."""
    gaps = np.diff(places, prepend=0)
    wide = gaps.max(initial=0) > 0xFFFF
    return (b"\4" if wide else b"\2") + gaps.astype("<u4" if wide else "<u2").tobytes()


def _unpacked(held: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(held, f"<u{held[0]}", offset=1), dtype=np.int64)


_RESULTS = "n_a long, n_b long, n_groups long, n_links long, groups string"
_INNER = "_batch long, _links binary, _codes array<long>, _texts array<int>"
_HELD: dict = {}


def _aligner(held) -> Aligner:
    if _HELD.get("of") is not held.value:
        _HELD.update(of=held.value, made=Aligner(*held.value))
    return _HELD["made"]


def _batch_columns(batch: int, made: list[tuple]) -> list[list]:
    """The values of _RESULTS and _INNER for the texts of one batch; its distinct pairs are on the first row."""
    of, codes = pd.factorize(np.concatenate([m[4] for m in made]), sort=True)
    edges = np.cumsum([0] + [len(m[4]) for m in made]).tolist()
    places = [np.sort(of[x:y]) for x, y in zip(edges, edges[1:])]
    texts = np.zeros(len(codes), np.int32)
    for p in places:
        texts[p[np.concatenate(([True], p[1:] != p[:-1]))] if len(p) else p] += 1
    rest = [None] * (len(made) - 1)
    return [
        *([m[k] for m in made] for k in range(3)), [len(m[4]) for m in made], [m[3] for m in made],
        [batch] * len(made), [_packed(p) for p in places], [codes.tolist(), *rest], [texts.tolist(), *rest],
    ]


def aligned_tokens(docs: DataFrame, one: str, other: str, text: str = "text") -> DataFrame:
    """docs without the text but with n_a, n_b (tokens), n_groups, n_links and groups, a text `a1,a2|b1;a3|b2,b3` of ids,
    and the columns _batch, _links, _codes, _texts that with_pair_counts reads.

    one: a JSON file of byte-level BPE, whose special strings are ordinary text here; other: a sentencepiece model; both on the
    driver, of fixed size and broadcast. Both get the text behind one blank. Null and empty texts, and texts whose bytes the
    other does not give back, have no tokens: zeros and ''. Texts are whole: those of more than RANGE bytes are cut at blanks
    between words, spread over the tasks, and composed from fragments in a tree; one without such blanks is encoded by
    one task, and composed likewise. Equal rows have equal results; an empty table gives an empty one. Other columns remain,
    and one named like a result is an error.
    """
    spark = docs.sparkSession
    with open(one, "rb") as f, open(other, "rb") as g:
        held = spark.sparkContext.broadcast((f.read(), g.read()))
    rest = [f for f in docs.schema.fields if f.name != text]
    added = T._parse_datatype_string(f"{_RESULTS}, {_INNER}").fields
    clash = {f.name for f in rest} & ({f.name for f in added} | {"_row", "_begin", "_whole_text"})
    if clash:
        raise ValueError(f"The columns {sorted(clash)} are there already")
    kinds = list(to_arrow_schema(T.StructType(added)))
    names = [f.name for f in rest]
    columns = [F.col(f"`{c}`") for c in names]
    long = F.octet_length(whole(F.col(text))) > RANGE

    schema = T.StructType(rest + added)

    def short_texts(batches):
        number = (TaskContext.get().partitionId()) << 32
        for batch in batches:
            aligner, column = _aligner(held), batch.column(batch.num_columns - 1)
            for a, b in byte_ranges(pc.binary_length(column).to_numpy(), BATCH_BYTES):
                texts = column.slice(a, b - a).to_pylist()
                made = [m for x, y in steps(texts, STEP) for m in aligner.whole_texts(texts[x:y])]
                values = [pa.array(v, k.type) for v, k in zip(_batch_columns(number, made), kinds)]
                yield pa.RecordBatch.from_arrays([c.slice(a, b - a) for c in batch.columns[:-1]] + values, names=schema.names)
                number += 1

    short = docs.where(~long).select(*columns, whole(F.col(text)).alias("_whole_text")).mapInArrow(short_texts, schema)

    # Rows are told apart by a number of their own, as they may be equal.
    rows = written(docs.where(long).select("*", F.monotonically_increasing_id().alias("_row")), "long-texts")
    ranges = rows.agg(F.max(F.octet_length(text))).first()[0]
    if ranges is None:
        return short
    part_schema = "_row long, _begin long, _part string"

    cuttable = Aligner(*held.value).cuttable

    def cut(batches):
        for batch in batches:
            for row, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for place, part in Aligner.pieces(t, cuttable):
                    yield pa.RecordBatch.from_pydict({"_row": [row], "_begin": [place], "_part": [part]})

    def describe(batches):
        aligner = _aligner(held)
        for batch in batches:
            for r in batch.to_pylist():
                for x in aligner.fragments(r["_begin"], r["_part"]):
                    yield pa.RecordBatch.from_pylist([_to_row(r["_row"], x)], fragment_schema)

    def compose(table):
        aligner = _aligner(held)
        rows = sorted(table.to_pylist(), key=lambda r: r["begin"])
        return rows[0]["row"], reduce(aligner.composed, map(_from_row, rows))

    def compose_some(table):
        return pa.Table.from_pylist([_to_row(*compose(table))], fragment_schema)

    def compose_all(table):  # the last level also finishes, so that a task runs one Python worker, not two
        row, made = compose(table)
        values = _batch_columns(-1 - row, [_aligner(held).finished(made)])
        return pa.Table.from_arrays([pa.array([row], pa.int64())] + [pa.array(v, k.type) for v, k in zip(values, kinds)], names=["_row", *[f.name for f in added]])

    fragment_schema = to_arrow_schema(T._parse_datatype_string(_FRAGMENT))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = rows.select("_row", F.col(text).cast("string")).mapInArrow(cut, part_schema).repartition(tasks, "_row", "_begin")
    fragments = parts.mapInArrow(describe, _FRAGMENT)
    span, part = RANGE * FAN_IN, lambda span: F.floor(F.col("begin") / span).alias("part")
    while span <= ranges:
        fragments = fragments.groupBy("row", part(span)).applyInArrow(compose_some, _FRAGMENT)
        span *= FAN_IN
    made = fragments.groupBy("row", part(span)).applyInArrow(compose_all, T.StructType([T.StructField("_row", T.LongType()), *added]))
    joined = rows.select("_row", *columns).join(made, "_row").select(*columns, *[f.name for f in added])
    return short.unionByName(joined)


def with_pair_counts(aligned: DataFrame) -> DataFrame:
    """The rows of aligned_tokens with n_best and count_sum instead of the inner columns. A pair's count is the number
    of texts that hold it linked; n_best counts the links whose count is the highest of all pairs of their one id (ties
    included), count_sum adds the counts of all links.

    aligned is written once, as the counts and the rows both need it. A batch of texts asks for its distinct pairs
    only; counting is by hash aggregation, which combines before the shuffle. No table of pairs is broadcast or gathered.
    """
    made = written(aligned, "aligned")
    pairs = made.where("_codes is not null").select("_batch", F.explode(F.arrays_zip("_codes", "_texts")).alias("p"))
    asked = pairs.select(F.col("_batch").alias("batch"), F.col("p._codes").alias("code"), F.col("p._texts").alias("texts"))
    counts = written(asked.groupBy("code").agg(F.sum("texts").alias("count")), "pair-counts")
    counts = counts.withColumn("one", F.shiftright("code", 32))
    highest = counts.groupBy("one").agg(F.max("count").alias("highest"))
    scored = counts.join(highest, "one").select("code", "count", (F.col("count") == F.col("highest")).alias("best"))
    answers = asked.select("batch", "code").join(scored, "code").select("batch", "code", "count", "best")

    inner = ("_batch", "_links", "_codes", "_texts")
    rest = [f for f in made.schema.fields if f.name not in inner]
    schema = T.StructType(rest + T._parse_datatype_string("n_best long, count_sum long").fields)

    def summed(rows, answered):
        order = np.argsort(answered["code"].to_numpy())
        count = answered["count"].to_numpy()[order]
        best = answered["best"].to_numpy(zero_copy_only=False)[order].astype(np.int64)
        places = [_unpacked(x) for x in rows["_links"].to_pylist()]
        sums = [pa.array([int(v[p].sum()) for p in places], pa.int64()) for v in (best, count)]
        return pa.Table.from_arrays([rows[f.name] for f in rest] + sums, names=schema.names)

    left = made.drop("_codes", "_texts").groupBy("_batch")
    return left.cogroup(answers.groupBy("batch")).applyInArrow(summed, schema)
