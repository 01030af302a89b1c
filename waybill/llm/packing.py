"""Minimum bin slack: whole windows of tokens from the multiset of what documents leave over.

A document of n tokens fills n // capacity windows by itself; what is left over, shorter than a window,
is packed with the rests of other documents. The driver only sees how many rests there are of each
length, a table of fewer than ``capacity`` rows whatever the corpus. For each window a bitset of
reachable sums finds the multiset of lengths that comes closest to the capacity, and the window is
repeated as often as the counts allow, so the plan too grows with the lengths and not with documents.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm import shared, tokens, words

CAPACITY = 1024
STAGED = "part int, doc_id long, n long, full_before long, length int, local long, ids binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def closest(counts: dict[int, int], target: int) -> dict[int, int]:
    """Counts of lengths, none above ``counts``, of the largest sum up to ``target``.

    ``reached`` holds a bit for every sum; the bitsets before each length are kept, and the counts are
    read off backwards. Long lengths come first, so equal sums prefer fewer pieces.
    """
    mask, reached, trail = (1 << (target + 1)) - 1, 1, []
    for length in sorted(counts, reverse=True):
        copies = min(counts[length], target // length)
        if copies:
            trail.append((length, copies, reached))
            step = 1
            while copies:
                step = min(step, copies)
                reached |= (reached << step * length) & mask
                copies, step = copies - step, 2 * step
            if reached >> target & 1:
                break
    left, out = reached.bit_length() - 1, {}
    for length, copies, before in reversed(trail):
        used = next(k for k in range(copies + 1) if left >= k * length and before >> (left - k * length) & 1)
        if used:
            out[length], left = used, left - used * length
    return out


class Rests:
    """Rests by present length: runs ``(first length, first rank, count, start)`` of equal ones."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {length: n for length, n in counts.items() if n}
        self.runs = {length: deque([(length, 0, n, 0)]) for length, n in self.counts.items()}

    def take(self, length: int, n: int) -> list[tuple[int, int, int, int]]:
        out, runs = [], self.runs[length]
        self.counts[length] -= n
        if not self.counts[length]:
            del self.counts[length]
        while n:
            origin, rank, size, start = runs.popleft()
            if size > n:
                runs.appendleft((origin, rank + n, size - n, start))
                size = n
            out.append((origin, rank, size, start))
            n -= size
        return out

    def put(self, length: int, runs: list[tuple[int, int, int, int]]) -> None:
        self.counts[length] = self.counts.get(length, 0) + sum(r[2] for r in runs)
        self.runs.setdefault(length, deque()).extend(runs)


@dataclass
class Plan:
    """Rows ``(length, first rank, count, start, size, sequence, offset)``: of the rests of that length and
    of these ranks, ``size`` tokens from ``start`` on go to as many sequences from ``sequence`` on, at
    ``offset``. Rows without sequence lie one after the other from ``offset`` on in a stream of ``stream``
    tokens, cut into sequences from ``packed`` on: full ones, then powers of two."""

    rows: list[tuple]
    packed: int
    stream: int
    capacity: int

    @property
    def bounds(self) -> list[int]:
        """Where the sequences after the last full one of the stream begin, and its end."""
        at = self.stream // self.capacity * self.capacity
        out = [at]
        for bit in reversed(range(self.capacity.bit_length())):
            if self.stream % self.capacity >> bit & 1:
                out.append(out[-1] + (1 << bit))
        return out

    @property
    def sequences(self) -> int:
        return self.packed + self.stream // self.capacity + len(self.bounds) - 1


def plan(counts: dict[int, int], capacity: int = CAPACITY, patterns: int | None = None) -> Plan:
    """Where the rests go.

    The longest rest opens each window. What slack the closest sum leaves is filled by cutting a rest that
    remains, so no window is padded. Cutting can go on for long when counts are large, so after
    ``patterns`` kinds of window (eight times the capacity) what is left is laid out as one stream and cut
    at every capacity; the plan therefore has a size that no corpus exceeds. Less than a window at the very
    end is cut into powers of two, which need no padding.
    """
    rests, rows, sequence = Rests(counts), [], 0

    def send(runs: list, size: int, first: int, offset: int) -> None:
        for origin, rank, n, start in runs:
            rows.append((origin, rank, n, start, size, first, offset))
            first += n

    for _ in range(8 * capacity if patterns is None else patterns):
        if not rests.counts:
            break
        longest = max(rests.counts)
        others = dict(rests.counts)
        others[longest] -= 1
        window = closest({k: n for k, n in others.items() if n}, capacity - longest)
        window[longest] = window.get(longest, 0) + 1
        slack = capacity - sum(k * n for k, n in window.items())
        times = min(rests.counts[k] // n for k, n in window.items())
        cut = None
        if slack:
            cut = min((k for k, n in rests.counts.items() if n > window.get(k, 0)), default=None)
            if cut is None:
                break
            times = min(times, rests.counts[cut] // (window.get(cut, 0) + 1))
        offset = 0
        for length, n in sorted(window.items(), reverse=True):
            for _ in range(n):
                send(rests.take(length, times), length, sequence, offset)
                offset += length
        if slack:
            runs = rests.take(cut, times)
            send(runs, slack, sequence, offset)
            rests.put(cut - slack, [(o, rank, n, start + slack) for o, rank, n, start in runs])
        sequence += times
    stream = 0
    for length in sorted(rests.counts, reverse=True):
        for origin, rank, n, start in rests.take(length, rests.counts[length]):
            rows.append((origin, rank, n, start, length, -1, stream))
            stream += n * length
    return Plan(rows, sequence, stream, capacity)


class Places:
    """The plan, to be asked for the parts of one rest."""

    def __init__(self, plan_: Plan):
        self.plan, self.bounds = plan_, plan_.bounds
        self.by: dict[tuple[int, int], tuple[list, list]] = {}
        for row in sorted(plan_.rows):
            ranks, places = self.by.setdefault((row[0], row[3]), ([], []))
            ranks.append(row[1])
            places.append(row)

    def of(self, length: int, rank: int) -> Iterator[tuple[int, int, int, int]]:
        """``(start, size, sequence, offset)`` of each part of the rest, in order."""
        at = 0
        while at < length:
            ranks, places = self.by[length, at]
            _, first, _, start, size, sequence, offset = places[bisect_right(ranks, rank) - 1]
            if sequence >= 0:
                yield start, size, sequence + rank - first, offset
            else:
                yield from self._streamed(start, size, offset + (rank - first) * size)
            at += size

    def _streamed(self, start: int, size: int, position: int) -> Iterator[tuple[int, int, int, int]]:
        capacity, full = self.plan.capacity, self.bounds[0]
        while size:
            if position < full:
                number, offset = divmod(position, capacity)
                room = capacity - offset
            else:
                k = bisect_right(self.bounds, position) - 1
                number, offset, room = full // capacity + k, position - self.bounds[k], self.bounds[k + 1] - position
            part = min(size, room)
            yield start, part, self.plan.packed + number, offset
            start, size, position = start + part, size - part, position + part


def tokenized(documents: DataFrame, vocabulary: str, end: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Ids of every document with ``end`` after them, kept as a table.

    ``part`` is the task, ``full_before`` the full windows before the document in it, ``length`` of the
    rest, and ``local`` the rest's number among those of its length in the task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(vocabulary)
        part, full, seen = TaskContext.get().partitionId(), 0, np.zeros(capacity, np.int64)
        for batch in batches:
            data, offsets = words.utf8(batch.column(1))
            for a, b in words.slices(offsets, words.SLICE_BYTES // 2):
                ids, first = encoder.encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                out = {name: [] for name in ("n", "full_before", "length", "local", "ids")}
                tail = np.array([end], np.uint16).tobytes()
                for k in range(b - a):
                    n = int(first[k + 1] - first[k]) + 1
                    length = n % capacity
                    out["n"].append(n)
                    out["full_before"].append(full)
                    out["length"].append(length)
                    out["local"].append(int(seen[length]))
                    out["ids"].append(ids[first[k] : first[k + 1]].tobytes() + tail)
                    full += n // capacity
                    seen[length] += 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(b - a, part, np.int32)),
                        batch.column(0)[a:b],
                        pa.array(out["n"], pa.int64()),
                        pa.array(out["full_before"], pa.int64()),
                        pa.array(out["length"], pa.int32()),
                        pa.array(out["local"], pa.int64()),
                        pa.array(out["ids"], pa.binary()),
                    ],
                    [x.split()[0] for x in STAGED.split(", ")],
                )

    return shared.table(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(shared.lean(run), STAGED), "tokens")


def packed(documents: DataFrame, vocabulary: str, end: int = 0, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Every document's tokens as pieces of sequences of at most ``capacity``; ``ids`` too if asked for.

    NULL and empty texts consist of the end id alone. Repeated rows are packed as often as they come, a
    NULL doc_id stays NULL, an empty table gives no pieces, other columns are ignored. All sequences
    are full but at most ten, which are powers of two.
    """
    staged = tokenized(documents, vocabulary, end, capacity)
    rest = F.col("length") > 0
    per_part = staged.groupBy("part", "length").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.floor(F.col("n") / capacity)).alias("_full")
    )
    lengths = per_part.where(rest).groupBy("length").agg(F.sum("_n").alias("n")).collect()
    layout = plan({r["length"]: r["n"] for r in lengths}, capacity)
    places = staged.sparkSession.sparkContext.broadcast(Places(layout))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    full_base = per_part.groupBy("part").agg(F.sum("_full").alias("_f")).select(
        "part", (F.coalesce(F.sum("_f").over(before), F.lit(0)) + layout.sequences).alias("base")
    )
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    rest_base = per_part.where(rest).select("part", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("base"))

    def pieces(batch: pa.RecordBatch, found: list[tuple]) -> pa.RecordBatch:
        """``found``: ``(row of the batch, start, size, sequence, offset, ids)``."""
        row, start, size, sequence, offset, ids = zip(*found)
        columns = [
            batch.column(0).take(pa.array(row)),
            pa.array(start, pa.int64()),
            pa.array(size, pa.int64()),
            pa.array([zlib.crc32(np.frombuffer(x, "<u2").astype("<u4").tobytes()) for x in ids], pa.int64()),
            batch.column(1).take(pa.array(row)),
            pa.array(sequence, pa.int64()),
            pa.array(offset, pa.int64()),
        ]
        if with_ids:
            columns.append(pa.array([np.frombuffer(x, "<u2").astype(np.int32) for x in ids], pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in schema.split(", ")])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row, (n, before, base, ids) in enumerate(zip(*(batch.column(k).to_pylist() for k in (1, 2, 3, 4)))):
                for k in range(n // capacity):
                    at = k * capacity
                    found.append((row, at, capacity, base + before + k, 0, ids[2 * at : 2 * (at + capacity)]))
            if found:
                yield pieces(batch, found)

    def rests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan_ = places.value
        for batch in batches:
            found = []
            for row, (n, length, rank, ids) in enumerate(zip(*(batch.column(k).to_pylist() for k in (1, 2, 3, 4)))):
                for start, size, sequence, offset in plan_.of(length, rank):
                    found.append((row, n - length + start, size, sequence, offset, ids[2 * start : 2 * (start + size)]))
            if found:
                yield pieces(batch, found)

    schema = PIECES + (", ids array<int>" if with_ids else "")
    one = staged.where(F.col("n") >= capacity).join(full_base, "part").select("doc_id", "n", "full_before", "base", "ids")
    tail = F.expr("substring(ids, cast(2 * (n - length) AS int) + 1, 2 * length)")
    two = staged.where(rest).select("part", "doc_id", "n", "length", "local", tail.alias("ids")).join(rest_base, ["part", "length"])
    two = two.select("doc_id", "n", "length", (F.col("local") + F.col("base")).alias("rank"), "ids")
    return one.mapInArrow(shared.lean(whole), schema).unionByName(two.mapInArrow(shared.lean(rests), schema))
