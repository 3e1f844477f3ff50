"""Packing documents into fixed-length sequences by bin completion (operator 10).

The pieces of a corpus are described by how many there are of each length, at
most ``capacity`` numbers however large the corpus is. Bin completion solves
that multiset: around the largest remaining piece it enumerates the fillings
of the rest of a sequence that no other filling dominates, repeats a filling
as often as the counts allow, prunes branches whose bins plus a lower bound
(total length, or pieces over half) cannot beat the best solution, or whose
waste exceeds what a better solution may waste, and completes every node by
best-fit decreasing as the incumbent. Fillings come fullest first, one by one as
the search returns to a node, so none is left out. The search stops when the
bound is met, when nothing is left to try, or after ``NODES`` nodes or ``STEPS``
steps (packing is NP-hard; the incumbent is then the answer, not proven best).

The plan maps ranges of the pieces' global order (length, then id) to
sequences and offsets, so Spark assigns every piece by one look-up: the order
comes from a range-partitioned sort, its positions from one offset a
partition.
"""

from __future__ import annotations

import logging
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import free_name, need, save

CAPACITY = 4096  # ids a sequence
NODES, STEPS = 4000, 2_000_000  # of the search: nodes, whatever the number of lengths; lengths looked at for their fillings

log = logging.getLogger(__name__)

#: A plan is a list of (times, lengths): `times` sequences hold pieces of these lengths each.
Plan = list[tuple[int, tuple[int, ...]]]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins needed at least: for every k up to half a bin, pieces over ``capacity - k`` stand alone,

    the other pieces over half a bin need one bin each, and those from k on
    that do not fit beside them need more (k = 0 gives the total length).
    """
    number, amount = np.zeros(capacity + 1, np.int64), np.arange(capacity + 1)
    number[list(counts)] = list(counts.values())
    n, total = np.cumsum(number), np.cumsum(number * amount)
    half = capacity // 2
    k = np.arange(half + 1)
    over = n[-1] - n[capacity - k]
    mid, mid_sum = n[capacity - k] - n[half], total[capacity - k] - total[half]
    small = total[half] - np.where(k > 0, total[np.maximum(k - 1, 0)], 0)
    more = np.maximum(0, small - (mid * capacity - mid_sum))
    return int((over + mid + -(-more // capacity)).max())


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing; equal bins are handled together."""
    open_bins: dict[int, list[list]] = {}  # room -> [times, lengths]
    rooms: list[int] = []

    def add(room: int, times: int, lengths: tuple[int, ...]) -> None:
        if room not in open_bins:
            open_bins[room] = []
            rooms.insert(bisect_left(rooms, room), room)
        open_bins[room].append([times, lengths])

    for n in sorted(counts, reverse=True):
        left = counts[n]
        while left:
            at = bisect_left(rooms, n)
            if at < len(rooms):
                room = rooms[at]
                group = open_bins[room][-1]
                times = min(left, group[0])
                group[0] -= times
                if not group[0]:
                    open_bins[room].pop()
                    if not open_bins[room]:
                        del open_bins[room], rooms[at]
                add(room - n, times, (*group[1], n))
                left -= times
            else:  # new bins, filled with this length as best fit would do
                each = capacity // n
                full = left // each
                if full:
                    add(capacity - each * n, full, (n,) * each)
                    left -= full * each
                if left:
                    add(capacity - left * n, 1, (n,) * left)
                    left = 0
    return [(t, ls) for groups in open_bins.values() for t, ls in groups]


def dominates(a: tuple[int, ...], b: tuple[int, ...]) -> bool:
    """Whether the pieces of ``b`` can be laid into the pieces of ``a`` (as if those were bins)."""
    if not b:
        return True
    if sum(b) > sum(a):
        return False
    tried = set()
    for i, x in enumerate(a):
        if x >= b[0] and x not in tried:
            tried.add(x)
            if dominates(tuple(sorted((*a[:i], *a[i + 1 :], *([x - b[0]] if x > b[0] else [])), reverse=True)), b[1:]):
                return True
    return False


class _Search:
    """Depth-first state: one table of remaining counts, changed on the way down and restored on the way back.

    A node keeps its place among its fillings (a generator) and nothing that
    grows with the number of lengths: the table of reachable sums is built
    again when the search returns to a node.
    """

    def __init__(self, counts: dict[int, int], capacity: int, nodes: int, steps: int):
        self.left, self.capacity, self.nodes, self.steps = dict(counts), capacity, nodes, steps

    @property
    def over(self) -> bool:
        return self.nodes <= 0 or self.steps <= 0

    def enter(self, top: int) -> None:
        """Lengths that fit beside ``top``, falling, and can[i]: bit s is set if those from place i on make the sum s."""
        room = self.capacity - top
        self.sizes = sorted((n for n in self.left if n <= room), reverse=True)
        self.below = [-n for n in self.sizes]
        can, mask = [1], (1 << (room + 1)) - 1
        for n in reversed(self.sizes):
            sums, more, k = can[-1], min(self.left[n] - (n == top), room // n), 1
            while more > 0:
                k = min(k, more)
                sums |= sums << k * n & mask
                more, k = more - k, 2 * k
            can.append(sums)
        self.can = can[::-1]

    def exact(self, at: int, chosen: tuple[int, ...], room: int, top: int) -> Iterator[tuple[int, ...]]:
        """All ways to fill ``room`` to the brim with lengths from place ``at`` on."""
        if not room:
            yield chosen
            return
        at = max(at, bisect_left(self.below, -room))
        while at < len(self.sizes) and self.can[at] >> room & 1 and not self.over:
            self.steps -= 1
            n = self.sizes[at]
            for k in range(min(self.left[n] - (n == top), room // n), 0, -1):
                if self.can[at + 1] >> (room - k * n) & 1:
                    yield from self.exact(at + 1, chosen + (n,) * k, room - k * n, top)
            at += 1

    def fillings(self, top: int, waste: Callable[[], int]) -> Iterator[tuple[int, ...]]:
        """Undominated fillings beside ``top`` that waste at most ``waste()``, fullest first; all, if the effort lasts.

        A filling is dominated if a remaining piece could be added to it, or if
        its pieces can be laid into those of a former one (looked for among
        up to 8 pieces; beyond, both are tried).
        """
        room, total = self.capacity - top, self.capacity - top
        kept: list[tuple[int, ...]] = []
        while total >= max(0, room - waste()) and not self.over:
            self.steps -= 1
            if self.can[0] >> total & 1:
                for f in self.exact(0, (), total, top):
                    if any(f.count(n) < self.left[n] - (n == top) for n in self.sizes[bisect_left(self.below, total - room):]):
                        continue
                    if len(f) > 8 or not any(dominates(k, f) for k in kept):
                        if len(f) <= 8:
                            kept.append(f)
                        yield f
                        if total < room - waste():
                            return
            total -= 1

    def take(self, times: int, lengths: tuple[int, ...]) -> None:
        for n in lengths:
            self.left[n] -= times
            if not self.left[n]:
                del self.left[n]

    def give(self, times: int, lengths: tuple[int, ...]) -> None:
        for n in lengths:
            self.left[n] = self.left.get(n, 0) + times


def search(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES, steps: int = STEPS) -> tuple[Plan, int, bool]:
    """(plan, lower bound, whether it is proven that no plan has fewer bins) for pieces of 1 to ``capacity``."""
    counts = {n: c for n, c in counts.items() if c}
    if any(not 0 < n <= capacity for n in counts):
        raise ValueError("piece lengths must be between 1 and the capacity")
    bound = lower_bound(counts, capacity)
    best = best_fit(counts, capacity)
    fewest = sum(t for t, _ in best)
    slack = -sum(n * c for n, c in counts.items())
    at = _Search(counts, capacity, nodes, steps)
    plan: Plan = []  # bins on the way down, one entry a level
    path: list[list] = []  # a node: [top, fillings, its bins still to be tried]
    bins = lost = 0
    descend = True
    while fewest > bound and not at.over:
        if descend:
            at.nodes -= 1
            descend = False
            least = bins + (lower_bound(at.left, capacity) if at.left else 0)
            if least < fewest:
                done = best_fit(at.left, capacity)
                if bins + sum(t for t, _ in done) < fewest:
                    best = plan + done
                    fewest = sum(t for t, _ in best)
            if least < fewest and at.left:
                top = max(at.left)
                at.enter(top)
                path.append([top, at.fillings(top, lambda lost=lost: (fewest - 1) * capacity + slack - lost), []])
                plan.append((0, ()))
        # the next way to fill a bin around the node's largest piece, or back to the node above
        if not path:
            break
        top, ways, todo = path[-1]
        times, lengths = plan[-1]
        if times:  # undo the way just tried
            at.give(times, lengths)
            bins -= times
            lost -= times * (capacity - sum(lengths))
            plan[-1] = (0, ())
            if not todo:
                at.enter(top)
        if not todo:
            f = next(ways, None)
            if f is None:
                path.pop()
                plan.pop()
                continue
            lengths = (top, *f)
            gap = capacity - sum(lengths)
            often = min(at.left[n] // lengths.count(n) for n in set(lengths))
            if gap:
                often = max(1, min(often, ((fewest - 1) * capacity + slack - lost) // gap))
            todo += [(t, lengths) for t in dict.fromkeys((1, often))]  # as often as can be first, then once and others after it
        times, lengths = plan[-1] = todo.pop()
        at.take(times, lengths)
        bins += times
        lost += times * (capacity - sum(lengths))
        descend = True
    return best, bound, fewest == bound or not at.over


def bin_completion(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> tuple[Plan, int]:
    """(plan, lower bound) of :func:`search`."""
    return search(counts, capacity, nodes)[:2]


def _ranges(plan: Plan, counts: dict[int, int]) -> dict[str, np.ndarray]:
    """The plan as ranges of the global order (by length): one row per run of sequences and place."""
    first, start = {}, 0
    for n in sorted(counts):
        first[n] = start
        start += counts[n]
    rows, base = [], 0
    for times, lengths in plan:
        offset = 0
        for n in sorted(set(lengths), reverse=True):
            k = lengths.count(n)
            rows.append((first[n], base, k, offset, n))
            first[n] += k * times
            offset += k * n
        base += times
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 5).T
    return dict(zip(("start", "base", "each", "offset", "length"), cols))


def _cut(path: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pulsekit.llm.tokens import encoder

        enc, tail = encoder(path), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                rows = []
                for doc, ids in zip(part.column(0).to_pylist(), enc.encode(part.column(1).to_pylist())):
                    ids += tail
                    for k, p in enumerate(range(0, len(ids), 4 * capacity)):
                        x = ids[p : p + 4 * capacity]
                        rows.append((doc, k, p // 4, len(x) // 4, zlib.crc32(x)))
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[2:])],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def cut_documents(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the ids of each whole text and ``end_id``, cut only if longer than ``capacity``.

    Null and empty texts are the end id alone; a repeated or null id gives each of
    its rows its own pieces; a text of any length is cut whole. Other columns of
    ``docs`` are not read, so none can clash. An empty table gives no pieces.
    """
    src = need(docs, id_col, text_col).toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return src.mapInArrow(_cut(tokenizer, end_id, capacity), "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(pieces: DataFrame, capacity: int = CAPACITY, length_col: str = "length", order: tuple[str, ...] = ("doc_id", "piece", "ids_crc32")) -> DataFrame:
    """``pieces`` with sequence_id and offset: gapless from 0 in each sequence, in as few sequences as found.

    ``order`` makes the assignment repeatable; rows that tie in all of these
    columns are interchangeable. Lengths must be from 1 to ``capacity``. An
    empty table gives an empty result; other columns pass through, but ones
    already called sequence_id or offset (in any case) are replaced.
    """
    pieces = pieces.drop(*[c for c in pieces.columns if c.lower() in ("sequence_id", "offset")])
    place_col = free_name(pieces, "__place")
    pieces = save(pieces, "pack-pieces")
    spark = pieces.sparkSession
    ranged = pieces.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), length_col, *order)
    placed = save(ranged.sortWithinPartitions(length_col, *order).withColumn(place_col, F.monotonically_increasing_id()), "pack-sorted")
    counts = {r[0]: r[1] for r in placed.groupBy(length_col).count().collect()}  # at most `capacity` rows
    plan, bound, proven = search(counts, capacity)
    if not proven:
        log.warning("packing: %d sequences, lower bound %d; effort spent, not proven fewest", sum(t for t, _ in plan), bound)
    table = _ranges(plan, counts)
    names = list(pieces.columns)
    offsets, n = {}, 0
    for r in placed.groupBy(F.shiftright(place_col, 33).alias("p")).count().orderBy("p").collect():  # a row a partition
        offsets[r[0]] = n
        n += r[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column(place_col).to_numpy()
            part, inside = np.unique(place >> 33, return_inverse=True)
            rank = np.array([offsets[p] for p in part.tolist()], np.int64)[inside] + (place & ((1 << 33) - 1))
            at = np.searchsorted(table["start"], rank, side="right") - 1
            k = rank - table["start"][at]
            seq = table["base"][at] + k // table["each"][at]
            off = table["offset"][at] + k % table["each"][at] * table["length"][at]
            cols = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(seq, pa.int64()), pa.array(off, pa.int64())],
                                             names=[*names, "sequence_id", "offset"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return placed.mapInArrow(assign, f"{kinds}, sequence_id long, offset long")
