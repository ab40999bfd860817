"""Best-fit packing with large-item matching: all pieces of the corpus against one table of bin patterns.

A document's ids are those of its text and one end id; only longer ones are cut,
into pieces of ``LENGTH``. What can go into a bin depends on lengths alone, so
the packing is found on the histogram of lengths (at most ``LENGTH`` numbers,
however large the corpus) and holds for all documents at once:

1. Pieces above a third of the capacity are matched: from the longest down each
   takes the longest other one that fits beside it, so a bin holds two at most.
2. The smaller ones, from the longest down, go where they leave the least room;
   bins are opened only when no gap fits.

Bins filled alike are one group with a count. A length splits one group at
most three ways, so there are a few thousand groups at most (``Patterns``), which
are a table of a few hundred kilobytes in the tasks that place the pieces.

A piece's place among those of its length is its number within its task plus the
counts of the tasks before; no task sees more than its own pieces, and a length
that a third of them have is spread over all tasks. Staging the numbered pieces fixes
their places, so lost executors change nothing.

A null or empty text is one end id. Rows of one doc_id are separate documents.
An empty table gives no rows; extra columns are ignored. Sequence ids are dense from 0.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import as_schema, map_batches, prepare, stage
from tidemark.llm.packing import encoder

LENGTH = 4096
END_ID = 1
PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task int, number bigint"
RESULT = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"


# --- patterns ----------------------------------------------------------------------


class _Gaps:
    """Groups of bins by the room that is left in them."""

    def __init__(self):
        self.sizes: list[int] = []
        self.groups: dict[int, list[tuple[int, tuple]]] = {}

    def add(self, room: int, bins: int, content: tuple) -> None:
        if not bins:
            return
        if room not in self.groups:
            insort(self.sizes, room)
            self.groups[room] = []
        self.groups[room].append((bins, content))

    def least(self, length: int) -> tuple[int, int, tuple] | None:
        """A group with the least room that the length fits, taken out; none if all have less."""
        at = bisect_left(self.sizes, length)
        if at == len(self.sizes):
            return None
        room = self.sizes[at]
        bins, content = self.groups[room].pop()
        if not self.groups[room]:
            del self.groups[room]
            self.sizes.pop(at)
        return room, bins, content

    def all(self) -> list[tuple[int, tuple]]:
        return [g for room in self.sizes for g in self.groups[room]]


def _matched(counts: Mapping[int, int], capacity: int) -> _Gaps:
    """Bins of the pieces above a third of the capacity, at most two in each."""
    left = {n: c for n, c in counts.items() if 3 * n > capacity and c}
    lengths, gaps = sorted(left), _Gaps()

    def take(length: int, bins: int) -> None:
        left[length] -= bins
        if not left[length]:
            lengths.remove(length)

    while lengths:
        length = lengths[-1]
        at = bisect_right(lengths, capacity - length) - 1
        if at >= 0 and lengths[at] == length and left[length] == 1:
            at -= 1
        if at < 0:
            gaps.add(capacity - length, left[length], ((length, 1),))
            take(length, left[length])
        elif (other := lengths[at]) == length:
            bins = left[length] // 2
            gaps.add(capacity - 2 * length, bins, ((length, 2),))
            take(length, 2 * bins)
        else:
            bins = min(left[length], left[other])
            gaps.add(capacity - length - other, bins, ((length, 1), (other, 1)))
            take(length, bins)
            take(other, bins)
    return gaps


def bin_groups(counts: Mapping[int, int], capacity: int) -> list[tuple[int, tuple]]:
    """(bins, ((length, times), ...)): how many bins are filled with which lengths, for ``counts`` pieces of each length."""
    gaps = _matched(counts, capacity)
    for length in sorted((n for n, c in counts.items() if 3 * n <= capacity and c), reverse=True):
        left = counts[length]
        while left:
            # A bin that took one piece has the least room for the next, so a bin takes as many as fit.
            room, bins, content = gaps.least(length) or (capacity, left, ())
            times = room // length
            full = min(bins, left // times)
            rest = left - full * times if full < bins else 0
            gaps.add(room - times * length, full, (*content, (length, times)))
            if rest:
                gaps.add(room - rest * length, 1, (*content, (length, rest)))
            if content:  # bins of the group that got nothing
                gaps.add(room, bins - full - bool(rest), content)
            left -= full * times + rest
    return gaps.all()


class Patterns:
    """Where the n-th piece of each length goes."""

    def __init__(self, counts: Mapping[int, int], capacity: int):
        runs, first = [], 0
        taken = dict.fromkeys(counts, 0)
        for bins, content in bin_groups(counts, capacity):
            offset = 0
            for length, times in content:
                runs.append((length, taken[length], times, first, offset))
                taken[length] += bins * times
                offset += length * times
            first += bins
        self.sequences = first
        self.length, self.number, self.times, self.first, self.offset = np.array(sorted(runs), np.int64).reshape(-1, 5).T
        self.keys = (self.length << 44) | self.number

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of pieces given by length and number among the pieces of that length."""
        run = np.searchsorted(self.keys, (length << 44) | number, side="right") - 1
        at = number - self.number[run]
        return self.first[run] + at // self.times[run], self.offset[run] + at % self.times[run] * length


# --- documents ---------------------------------------------------------------------


def _numbered(path: str, capacity: int, end_id: int) -> Callable:
    encode, end = encoder(path), np.array([end_id], "<u4").tobytes()
    seen = np.zeros(capacity + 1, np.int64)
    task = TaskContext.get().partitionId()

    def pieces(ids, texts):
        out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "task", "number")}
        for doc_id, text in zip(ids, texts, strict=True):
            data = memoryview(encode(text or "") + end)
            for piece, start in enumerate(range(0, len(data) // 4, capacity)):
                part = data[4 * start : 4 * (start + capacity)]
                n = len(part) // 4
                for k, v in zip(out, (doc_id, piece, start, n, zlib.crc32(part), task, int(seen[n])), strict=True):
                    out[k].append(v)
                seen[n] += 1
        return out

    return pieces


def numbered_pieces(docs: DataFrame, path: str, capacity: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Pieces of every row, with the task that made them and their number there among the pieces of their length."""
    return map_batches(docs, ["doc_id", "text"], lambda: _numbered(path, capacity, end_id), PIECE)


def pack_best_fit(docs: DataFrame, path: str, capacity: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of all pieces of ``docs`` (doc_id, text)."""
    prepare(docs.sparkSession)
    pieces = stage(numbered_pieces(docs, path, capacity, end_id), "numbered-pieces")
    counts = stage(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "piece-counts")
    before = F.coalesce(F.sum("n").over(W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    shifts = counts.select("length", "task", before.alias("before"))  # grows with the tasks: not to be broadcast
    total = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    patterns = Patterns(total, capacity)
    numbered = pieces.join(shifts.hint("merge"), ["length", "task"]).withColumn("number", F.col("number") + F.col("before"))
    schema = as_schema(RESULT)
    kept = [f.name for f in schema][:5]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = patterns.place(batch.column("length").to_numpy(), batch.column("number").to_numpy())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), *map(pa.array, at)], schema=to_arrow_schema(schema))

    return numbered.select(*kept, "number").mapInArrow(placed, schema)
