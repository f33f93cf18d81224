"""JSON arrays of objects read by many tasks: byte ranges report what they do to the parser's state, a scan over the ranges
finds the state each begins in, and then every range gives its own records.

A file is read as text cut at closing braces, which Spark splits at any byte. What a range does depends only on whether it begins
within a string: it ends within one or not, and moves the depth of brackets up or down. Those two cases compose, so
the ranges are described side by side and their begins told from left to right. A record that goes over the end of a range is put
together from its parts, which alone are shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.sources.paths import path_size, require_path

#: Read splits of one input: their states, some 100 bytes each, are broadcast.
MOST_SPLITS = 1 << 20
#: Bytes that one task reads on average where splits are smaller.
TASK_BYTES = 1 << 25
#: Above any depth: no bracket is closed.
_NEVER = 1 << 40
_ESCAPE = re.compile(r"\\.", re.DOTALL)
_BRACKET = re.compile(r"[\[\]{]")
_FIRST, _NEXT, _LAST = re.compile(r"\ufeff?[ \t\r\n]*\[[ \t\r\n]*"), re.compile(r"[ \t\r\n]*,[ \t\r\n]*"), re.compile(r"[ \t\r\n]*\]")
_EMPTY = re.compile(r"\ufeff?[ \t\r\n]*\[[ \t\r\n]*\]")


def _effect(row: str, in_string: bool) -> tuple[bool, int, int]:
    """(ends within a string, change of depth, least depth after a closing bracket) of a row and the brace behind it."""
    if "\\" in row:
        row = _ESCAPE.sub("", row)
    parts = row.split('"')
    outside = "".join(parts[1::2] if in_string else parts[0::2])
    ends_in_string = in_string ^ (len(parts) % 2 == 0)
    depth, least = 0, _NEVER
    if "]" in outside:
        for c in _BRACKET.findall(outside):
            if c == "]":
                depth -= 1
                least = min(least, depth)
            else:
                depth += 1
    else:
        depth = outside.count("{") + outside.count("[")
    if not ends_in_string:
        depth -= 1
        least = min(least, depth)
    return ends_in_string, depth, least


@dataclass
class _Range:
    """What a range does to the state, for both ways it may begin: (within a string at its end, depth, least depth)."""

    outside: tuple[bool, int, int] = (False, 0, _NEVER)
    inside: tuple[bool, int, int] = (True, 0, _NEVER)

    def add(self, row: str) -> None:
        for name in ("outside", "inside"):
            in_string, depth, least = getattr(self, name)
            ends, change, low = _effect(row, in_string)
            setattr(self, name, (ends, depth + change, min(least, depth + low)))


@dataclass(frozen=True)
class _State:
    """How a range begins: before the array, between its records, within one, or behind it; ``since`` is the block where
    the record that is open there begins."""

    in_string: bool = False
    depth: int = 0
    closed: bool = False
    since: int | None = None


@dataclass
class _Reader:
    """Goes through the rows of one range from its state on: whole records, and parts of those that go over its ends."""

    block: int
    state: _State
    held: list[str] = field(default_factory=list)
    number: int = 0
    blank: bool = False

    def __post_init__(self):
        self.in_string, self.depth, self.closed = self.state.in_string, self.state.depth, self.state.closed
        self.since = self.state.since

    def row(self, row: str) -> Iterator[tuple[int, int, bool, str]]:
        """(block where the record begins, its number there, is it whole, text)."""
        if self.blank:
            raise ValueError("A closing brace before the array")
        if self.closed:
            return
        if not self.depth and not row.strip():  # a file without text
            self.blank = True
            return
        if self.depth <= 1 and not self.in_string:
            begin = (_NEXT if self.depth else _FIRST).match(row)
            if not begin or not row.startswith("{", begin.end()):
                if not (_LAST if self.depth else _EMPTY).match(row):
                    raise ValueError(f"Not an array of objects near {row[:80]!r}")
                self.closed = True
                return
            row, self.depth, self.since = row[begin.end() :], 1, None
        self.held.append(row)
        self.in_string, change, _ = _effect(row, self.in_string)
        self.depth += change
        self.held.append("}")
        if self.depth == 1 and not self.in_string:
            yield self._out(True)
        elif self.depth < 1:
            raise ValueError(f"A bracket is closed that was not opened near {row[:80]!r}")

    def end(self) -> Iterator[tuple[int, int, bool, str]]:
        if self.held:
            yield self._out(False)

    def _out(self, ended: bool) -> tuple[int, int, bool, str]:
        text, self.held = "".join(self.held), []
        if self.since is not None:  # it began before this range: the last number of that block
            since, self.since = self.since, None
            return since, -1, False, text
        self.number += 1
        return (self.block, self.number - 1, True, text) if ended else (self.block, -1, False, text)


def _runs(batches) -> Iterator[tuple[str, int, int, Iterator[str]]]:
    """Consecutive rows of one file and block: (file, block, length, texts)."""
    from itertools import groupby

    def rows():
        for batch in batches:
            files, blocks, lengths, texts = (batch.column(i) for i in range(4))
            for start in range(0, batch.num_rows, 512):
                part = (c.slice(start, 512).to_pylist() for c in (files, blocks, lengths, texts))
                yield from zip(*part)

    for (file, block, length), held in groupby(rows(), key=lambda r: r[:3]):
        yield file, block, length, (r[3] for r in held)


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all splits. Small splits are read many by a task: what a task costs by itself would take longer than their text."""
    text = spark.read.option("lineSep", "}").text(path)
    tasks = max(4 * spark.sparkContext.defaultParallelism, -(-path_size(spark, path) // TASK_BYTES))
    return text.select("_metadata.file_path", "_metadata.file_block_start", "_metadata.file_block_length", "value").coalesce(tasks)


_EFFECTS = "file string, block long, out_string boolean, out_depth long, out_least long, in_string boolean, in_depth long, in_least long"


def _described(batches):
    for file, block, _, rows in _runs(batches):
        held = _Range()
        for row in rows:
            held.add(row)
        columns = [[file], [block], *([v] for v in (*held.outside, *held.inside))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[f.split()[0] for f in _EFFECTS.split(", ")])


def _states(path: str, chunks: DataFrame) -> dict[tuple[str, int], _State]:
    """The state that each range begins in. One row per range comes to the driver."""
    ranges = chunks.mapInArrow(_described, _EFFECTS).collect()
    if len(ranges) > MOST_SPLITS:
        raise ValueError(f"{path} is read in {len(ranges)} splits, more than {MOST_SPLITS}; write JSON lines, or read larger splits")
    states, file, now = {}, None, _State(closed=True)

    def require_end():
        if not now.closed:
            raise ValueError(f"The array in {file} is not closed")

    for r in sorted(ranges, key=lambda r: (r.file, r.block)):
        if r.file != file:
            require_end()
            file, now = r.file, _State()
        states[r.file, r.block] = now
        in_string, depth, least = (r.in_string, r.in_depth, r.in_least) if now.in_string else (r.out_string, r.out_depth, r.out_least)
        # The brace that is added to a file's last row is behind the array, or the array is not closed.
        closed = now.closed or now.depth + least <= 0
        within = not closed and (in_string or now.depth + depth > 1)
        # A record that is open at the end began here, unless the range lies within it altogether.
        wholly_inside = now.since is not None and (now.in_string or now.depth > 1) and now.depth + least > 1
        since = (now.since if wholly_inside else r.block) if within else None
        now = _State(in_string, now.depth + depth, closed, since)
    require_end()
    return states


_PARTS = "file string, block long, length long, row long, at long, whole boolean, text string"


def array_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of the arrays in a file or folder as text: (file, block, length, row, text), where block and row order the
    records of a file. An input that is not an array of objects, or not closed, ends the job; files without text hold
    nothing, and what is behind the closing bracket is passed over."""
    chunks = _chunks(spark, require_path(spark, path))
    states = spark.sparkContext.broadcast(_states(path, chunks))
    names = [f.split()[0] for f in _PARTS.split(", ")]

    def reading(whole: bool):
        def run(batches):
            for file, block, length, rows in _runs(batches):
                reader, held, size = _Reader(block, states.value[file, block]), [], 0

                def batch(held):
                    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
                    columns = [[file] * len(held), [h[0] for h in held], [length] * len(held), [h[1] for h in held], [block] * len(held), [h[2] for h in held], [h[3] for h in held]]
                    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

                def found():
                    for row in rows:
                        yield from reader.row(row)
                    yield from reader.end()

                for made in found():
                    if made[2] == whole:
                        held.append(made)
                        size += len(made[3])
                        if size > 1 << 20:
                            yield batch(held)
                            held, size = [], 0
                if held:
                    yield batch(held)

        return run

    ended = chunks.mapInArrow(reading(True), _PARTS).select("file", "block", "length", "row", "text")
    pieces = chunks.mapInArrow(reading(False), _PARTS).groupBy("file", "block")
    joined = F.array_join(F.transform(F.sort_array("parts"), lambda p: p["text"]), "")
    # The record that goes over a block's end is its last one.
    over = pieces.agg(
        F.collect_list(F.struct("at", "text")).alias("parts"),
        F.max(F.when(F.col("at") == F.col("block"), F.col("length"))).alias("length"),
    ).select("file", "block", "length", F.lit(2**62).alias("row"), joined.alias("text"))
    return ended.unionByName(over)
