"""Best-fit packing of token sequences by linear grouping.

Documents are encoded once and cut into pieces of at most ``capacity`` tokens.
How pieces are packed depends on their lengths alone, so the plan is made on
the driver from the number of pieces of each length (at most ``capacity``
numbers), whatever the number of documents:

1. *Group.*  Large lengths (over ``capacity // SMALL``) are sorted and cut into
   ``GROUPS`` groups of equally many pieces; a group counts as its largest.
2. *Configurations.*  For so few sizes the least number of sequences is a
   linear programme over configurations (how many pieces of each group go
   into one sequence), solved by column generation; whole multiples of its
   configurations are used.
3. *Substitute.*  Slots of a group are filled with its actual pieces, longest
   first, so what rounding up wasted is free again.
4. *Best fit.*  What is left of the large ones and all small ones follow by
   falling length, each into the fullest sequence that still takes it.

Sequences of equal content form runs, so a step places any number of pieces.
The plan says for each length which ranks go to which run at which offset
(``MOST_RUNS`` at most); pieces are ranked within their length by the task
that wrote them, and look up their own place.

Defined cases: NULL and empty texts are one piece, the end id alone; pieces of
one length are interchangeable, so ties are settled by where they were
written; repeated rows are packed as often as they stand; an empty table gives
no piece; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.llm.frames import columns
from fieldbook.llm.wordids import WordIds
from fieldbook.llm.words import row_slices, text_buffers
from fieldbook.session import materialize

CAPACITY = 2048
SMALL = 3                 # a piece of at most capacity // SMALL tokens is small
GROUPS = 256
MOST_RUNS = 1 << 20       # rows of a plan; far above what CAPACITY lengths can need
EPSILON, NEAR, STEPS = 1e-9, 1e-4, 20

_PIECES = ("doc_id long, piece int, start long, length int, ids binary, ids_crc32 long, part int, place long")
_WORKER: dict = {}


@dataclass
class Plan:
    """For the pieces of ``length[i]`` with ranks from ``rank[i]``: ``count[i]``
    of them go to sequences from ``first[i]``, at ``offset[i]``."""
    length: np.ndarray
    rank: np.ndarray
    count: np.ndarray
    first: np.ndarray
    offset: np.ndarray
    sequences: int

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces by length and rank within it."""
        at = np.searchsorted(self.length << 44 | self.rank, length.astype(np.int64) << 44 | rank, "right") - 1
        return self.first[at] + rank - self.rank[at], self.offset[at]


def _best_configuration(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> np.ndarray:
    """The multiset of sizes of most worth that fits (knapsack, one more piece a round)."""
    best, chosen = np.zeros(capacity + 1), []
    while True:
        more, last = best.copy(), np.full(capacity + 1, -1)
        for i in np.flatnonzero(worth > EPSILON):
            value = best[:capacity + 1 - sizes[i]] + worth[i]
            better = value > more[sizes[i]:] + EPSILON
            more[sizes[i]:][better] = value[better]
            last[sizes[i]:][better] = i
        if (last < 0).all():
            break
        best = more
        chosen.append(last)
    out, room = np.zeros(len(sizes)), capacity
    for last in reversed(chosen):
        if last[room] >= 0:
            out[last[room]] += 1
            room -= int(sizes[last[room]])
    return out


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Whole multiples of the configurations of a near-optimal solution of the
    cutting-stock programme (column generation, revised simplex): it stops when
    a better one would save less than ``NEAR`` of the sequences or half a
    sequence, or after ``STEPS`` exchanges a size.  No demand is exceeded."""
    m = len(sizes)
    basis = np.diag(np.maximum(1, capacity // sizes)).astype(float)
    # demands a little apart: equal ones could go round in circles
    inverse, amount = np.diag(1 / basis.diagonal()), demand * (1 + np.arange(m) * 1e-7) / basis.diagonal()
    for _ in range(STEPS * m):
        duals = inverse.sum(axis=0)
        column = _best_configuration(sizes, np.maximum(duals, 0), capacity)
        # no solution is better than this one by more than the factor worth
        worth = float((column * np.maximum(duals, 0)).sum())
        if amount.sum() * (1 - 1 / max(worth, 1)) <= max(0.5, NEAR * amount.sum()):
            break
        direction = (inverse * column).sum(axis=1)      # no threads of a matrix library on the driver
        ratio = np.where(direction > EPSILON, amount / np.where(direction > EPSILON, direction, 1), np.inf)
        out = int(ratio.argmin())
        amount = np.maximum(amount - ratio[out] * direction, 0)
        amount[out], basis[:, out] = ratio[out], column
        row = inverse[out] / direction[out]
        inverse -= direction[:, None] * row
        inverse[out] = row
    left, used = demand.astype(np.int64).copy(), []
    for j in np.argsort(-amount):
        column = basis[:, j].astype(np.int64)
        times = min(int(amount[j] + EPSILON), int((left[column > 0] // column[column > 0]).min()))
        if times > 0:
            used.append((column, times))
            left -= times * column
    return used


class _Packer:
    def __init__(self, counts: np.ndarray, capacity: int):
        self.capacity, self.left = capacity, counts.astype(np.int64).copy()
        self.rank = np.zeros(capacity + 1, np.int64)
        self.free: dict[int, list[tuple[int, int]]] = defaultdict(list)     # room: runs (first sequence, count)
        self.sequences, self.rows = 0, []

    def _take(self, length: int, count: int, first: int, offset: int) -> None:
        self.rows.append((length, int(self.rank[length]), count, first, offset))
        self.rank[length] += count
        self.left[length] -= count

    def _open(self, count: int) -> int:
        self.sequences += count
        return self.sequences - count

    def large(self, smallest: int, groups: int) -> None:
        """Group the lengths from ``smallest``, solve, and substitute."""
        lengths = np.flatnonzero(self.left)[::-1]
        lengths = lengths[(lengths >= smallest) & (lengths < self.capacity)]
        if not len(lengths):
            return
        before = np.concatenate([[0], np.cumsum(self.left[lengths])])
        total = int(before[-1])
        # a group begins where its share of the pieces begins; groups of one size are one group
        begin = np.unique(np.searchsorted(before, np.arange(groups) * total // groups, "right") - 1)
        sizes, edges = lengths[begin], np.concatenate([before[begin], [total]])
        taken = edges[:-1].copy()
        for column, times in configurations(sizes, np.diff(edges), self.capacity):
            slots = [g for g in np.flatnonzero(column) for _ in range(int(column[g]))]
            where, cuts = {}, {0, times}
            for s, g in enumerate(slots):               # each slot takes the next ``times`` pieces of its group
                where[s] = int(taken[g])
                taken[g] += times
                inside = before[(before > where[s]) & (before < where[s] + times)] - where[s]
                cuts.update(inside.tolist())
            marks, first = sorted(cuts), self._open(times)
            for a, b in zip(marks, marks[1:], strict=False):
                offset = 0
                for s in range(len(slots)):
                    length = int(lengths[np.searchsorted(before, where[s] + a, "right") - 1])
                    self.pending.append((length, where[s] + a, b - a, first + a, offset))
                    offset += length
                self.free[self.capacity - offset].append((first + a, b - a))

    def run(self, smallest: int, groups: int) -> Plan:
        full = int(self.left[self.capacity])
        if full:
            self._take(self.capacity, full, self._open(full), 0)
        self.pending: list[tuple] = []
        self.large(smallest, groups)
        for length, _, count, first, offset in sorted(self.pending, key=lambda r: (-r[0], r[1])):
            self._take(length, count, first, offset)
        for length in np.flatnonzero(self.left)[::-1].tolist():
            self._fit(length)
        rows = np.array(sorted(self.rows), np.int64).reshape(-1, 5)
        if len(rows) > MOST_RUNS:
            raise OverflowError(f"a plan of {len(rows)} runs")
        return Plan(*rows.T, sequences=self.sequences)

    def _fit(self, length: int) -> None:
        """All that is left of one length, each into the least room that takes it."""
        rooms = sorted(r for r, runs in self.free.items() if r >= length and runs)
        for room in rooms:
            while self.free[room] and self.left[length]:
                self._fill(length, room, *self.free[room].pop())
            if not self.left[length]:
                return
        per = self.capacity // length
        count = -(-int(self.left[length]) // per)
        if count:
            self._fill(length, self.capacity, self._open(count), count)

    def _fill(self, length: int, room: int, first: int, count: int) -> None:
        """Sequences of one room take as many of the length as go in, one after the other."""
        per, offset = room // length, self.capacity - room
        whole = min(count, int(self.left[length]) // per)
        for k in range(per if whole else 0):
            self._take(length, whole, first, offset + k * length)
        if whole:
            self.free[room - per * length].append((first, whole))
        some = int(self.left[length]) if whole < count else 0          # fewer than ``per``: one sequence takes them
        for k in range(some):
            self._take(length, 1, first + whole, offset + k * length)
        if some:
            self.free[room - some * length].append((first + whole, 1))
        if (rest := count - whole - bool(some)) > 0:
            self.free[room].append((first + count - rest, rest))


def plan(counts: np.ndarray, capacity: int = CAPACITY, groups: int = GROUPS) -> Plan:
    """Packs ``counts[n]`` pieces of each length n (0 .. ``capacity``)."""
    return _Packer(counts, capacity).run(capacity // SMALL + 1, groups)


def _encode(path: str, capacity: int, end_id: int):
    def pieces(batches):
        if path not in _WORKER:
            _WORKER[path] = WordIds(path)
        store, part = _WORKER[path], TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            offsets, data = text_buffers(batch.column("text"))
            for lo, hi in row_slices(offsets):
                ids, begin = store.encode(offsets, data, lo, hi, end_id)
                yield _cut(batch.column("doc_id").slice(lo, hi - lo), ids, begin, capacity, part, seen)
    return pieces


def _cut(doc_ids: pa.Array, ids: np.ndarray, begin: np.ndarray, capacity: int, part: int, seen: np.ndarray) -> pa.RecordBatch:
    """Pieces of the texts of a slice, numbered within their length."""
    sizes = np.diff(begin)
    n = -(-sizes // capacity)
    row = np.repeat(np.arange(len(sizes)), n)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    length = np.minimum(sizes[row] - piece * capacity, capacity)
    order = np.argsort(length, kind="stable")
    same = length[order]
    place = np.empty(len(row), np.int64)
    place[order] = np.arange(len(row)) - np.searchsorted(same, same) + seen[same]
    seen += np.bincount(length, minlength=len(seen))
    wide = memoryview(ids.astype("<u4").tobytes())
    at = begin[:-1][row] + piece * capacity
    crc = [zlib.crc32(wide[4 * a:4 * b]) for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)]
    raw = memoryview(ids.tobytes())
    w = ids.itemsize
    own = [bytes(raw[w * a:w * b]) for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)]
    return pa.RecordBatch.from_arrays(
        [doc_ids.take(pa.array(row)).cast(pa.int64()), pa.array(piece, pa.int32()), pa.array(piece.astype(np.int64) * capacity),
         pa.array(length, pa.int32()), pa.array(own, pa.binary()), pa.array(crc, pa.int64()),
         pa.array(np.full(len(row), part), pa.int32()), pa.array(place)],
        names=["doc_id", "piece", "start", "length", "ids", "ids_crc32", "part", "place"])


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """Encoded pieces, written once: doc_id, piece, start, length, ``ids`` (little-endian,
    two bytes an id where the vocabulary allows), ids_crc32, and where each was written."""
    docs = columns(docs, [key, text]).toDF("doc_id", "text")
    return materialize(docs.mapInArrow(_encode(tokenizer, capacity, end_id), _PIECES), "pieces")


def packed(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    runs = materialize(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    counts = np.zeros(capacity + 1, np.int64)
    for row in runs.groupBy("length").agg(F.sum("n").alias("n")).collect():          # one row per length
        counts[row.length] = row.n
    made = spark.sparkContext.broadcast(plan(counts, capacity, groups))              # MOST_RUNS rows at most
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = runs.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["part", "length"]).withColumn("rank", F.col("before") + F.col("place")).drop("before", "part", "place")

    def put(batches):
        for batch in batches:
            sequence, offset = made.value.places(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            batch = batch.drop_columns(["rank"])
            yield batch.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    kept = [f for f in ranked.schema.fields if f.name != "rank"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["sequence_id long", "offset long"])
    return ranked.mapInArrow(put, schema)


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids): each sequence's ids and the documents of its
    pieces in order; ``capacity`` tokens at most."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return placed.groupBy("sequence_id").agg(inside.alias("p")).select(
        "sequence_id", F.expr("aggregate(p, X'', (a, x) -> concat(a, x.ids))").alias("ids"), F.col("p.doc_id").alias("doc_ids"))
