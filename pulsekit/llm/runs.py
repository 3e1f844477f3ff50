"""Periodic runs of words by maximal pairs (operator 11).

A run is a stretch of words that repeats itself at least four times in a row
(``max(6, 4 q)`` words of smallest period q) and that no neighbouring word
extends. Two places i < j are a maximal pair if the words from both on are
equal for exactly ``depth`` words and the words before them differ (or one has
none). A maximal pair whose distance d is at most a third of its depth, with
depth + d >= 6, spans ``[i, j + depth)``: a stretch of period d that cannot be
extended, so it is a run as it stands. Pairs at multiples of the period span
the same stretch; the smallest distance is the period.

Maximal pairs are enumerated bottom-up in the tree of LCP intervals of the
suffix array. A node keeps its places in lists by the word to their left
("no word" is a word of its own); when two children meet, the places of the
smaller one look for partners with another left word in the larger one's
lists. Partners must lie within a third of the depth, and equal strings that
close to one another lie at multiples of one period and have one and the same
word to their left, but for the first of them. So a place has at most one list
to read on its right and one partner on its left, and everything that is read
is a pair; there are as many as runs have periods, at most linear in the words.

Runs need a depth of five words at least, so the tree is only built above
five words: over the places whose next five words stand elsewhere in the same
text. The suffix arrays of many texts are built together, by doubling.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import need

SHORTEST, TIMES = 6, 4  # words of a run, periods of a run at least
DEPTH = 5  # words of a maximal pair that can be a run
GROUP = 4_000_000  # characters of text whose suffixes are sorted together

Run = tuple[int, int, int]  # start, length, period


def suffix_ranks(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rank of each suffix, number of its first DEPTH words or -1 where they stand nowhere else in the text).

    ``codes`` are the words of several texts in a row, ``ends`` the end of each
    word's text; suffixes end with their text. Ranks order the suffixes of a
    text by their words. Places leave the sorting as soon as their rank is their own.
    """
    n = len(codes)
    shared = np.full(n, -1, np.int64)
    if not n:
        return np.zeros(0, np.int64), shared
    # by text and word; a rank is the place of the first of its equals in sorted order
    first = ends * (int(codes.max()) + 1) + codes
    alive = np.argsort(first, kind="stable")
    key = first[alive]
    rank, k = np.empty(n, np.int64), 1

    def regroup(alive: np.ndarray, old: np.ndarray, second: np.ndarray | None) -> np.ndarray:
        at = np.arange(len(alive))
        fresh = np.empty(len(alive), bool)
        fresh[0], fresh[1:] = True, old[1:] != old[:-1]
        begin = np.maximum.accumulate(np.where(fresh, at, 0))
        if second is None:
            rank[alive] = begin
            same = fresh
        else:
            same = fresh.copy()
            same[1:] |= second[1:] != second[:-1]
            rank[alive] = old + np.maximum.accumulate(np.where(same, at, 0)) - begin
        alone = same & np.append(same[1:], True)
        return alive[~alone]

    alive = regroup(alive, key, None)
    while len(alive):
        if k == 4:  # five words are equal where the four from here and the four from the next word on are
            at = alive[alive + 1 < ends[alive]]
            both = rank[at] * (n + 1) + rank[at + 1]
            order = np.argsort(both, kind="stable")
            number = np.cumsum(np.diff(both[order], prepend=-1) != 0) - 1
            many = np.bincount(number)[number] > 1 if len(number) else np.zeros(0, bool)
            shared[at[order[many]]] = number[many]
            if not many.any():
                break
        follow = alive + k
        inside = follow < ends[alive]
        second = np.where(inside, rank[np.where(inside, follow, 0)], -1)
        order = np.argsort(rank[alive] * (n + 1) + second + 1, kind="stable")
        alive = alive[order]
        alive = regroup(alive, rank[alive], second[order])
        k *= 2
    return rank, shared


def common_prefixes(codes: list[int], places: list[int], before: dict[int, int]) -> dict[int, int]:
    """Words that the suffix at each of ``places`` (ascending) shares with the one before it in sorted order.

    Going from a place to the next the number falls by one at most, so it is counted on from there.
    """
    n, out, h, last = len(codes), {}, 0, -2
    for p in places:
        q = before.get(p, -1)
        if q < 0:
            h = 0
        else:
            h = h if p == last + 1 else 0
            top = n - max(p, q)
            while h < top and codes[p + h] == codes[q + h]:
                h += 1
            out[p] = h
        last, h = p, max(h - 1, 0)
    return out


def _meet(a: tuple[list, dict], b: tuple[list, dict], depth: int, left: Callable[[int], int], found: dict) -> tuple[list, dict]:
    """Two children of a node become one; their maximal pairs that are runs are entered in ``found``."""
    if len(a[0]) < len(b[0]):
        a, b = b, a
    places, lists = a
    reach = depth // (TIMES - 1)

    def pair(i: int, j: int) -> None:
        d = j - i
        if depth + d >= SHORTEST:
            span = (i, j + depth)
            if found.get(span, d + 1) > d:
                found[span] = d

    for i in b[0]:
        at = bisect_right(places, i)
        if at < len(places) and places[at] - i <= reach and left(places[at]) != left(i):
            row = lists[left(places[at])]
            for k in range(bisect_right(row, i), len(row)):
                if row[k] - i > reach:
                    break
                pair(i, row[k])
        low = bisect_left(places, i - reach, 0, at)
        if low < at and left(places[low]) != left(i):
            pair(places[low], i)
    for i in b[0]:
        insort(places, i)
    for word, row in b[1].items():
        mine = lists.get(word)
        if mine is None:
            lists[word] = row
        else:
            for i in row:
                insort(mine, i)
    return places, lists


def runs_of(codes: list[int], order: list[int], group: list[int]) -> list[Run]:
    """Runs of one text by start, then period.

    ``order``: the places whose first DEPTH words are shared, sorted by suffix; ``group``: the number of these words.
    """
    before = {p: q for q, p, g, h in zip(order, order[1:], group, group[1:]) if g == h}
    prefix = common_prefixes(codes, sorted(order), before)
    left = lambda p: codes[p - 1] if p else -1
    found: dict[tuple[int, int], int] = {}
    stack: list[tuple[int, tuple[list, dict]]] = []
    for k, p in enumerate(order):
        node = ([p], {left(p): [p]})
        depth = prefix.get(order[k + 1], 0) if k + 1 < len(order) else 0  # with the next suffix
        while stack and stack[-1][0] > depth:
            top, other = stack.pop()
            node = _meet(other, node, top, left, found)
        if depth:
            if stack and stack[-1][0] == depth:
                node = _meet(stack.pop()[1], node, depth, left, found)
            stack.append((depth, node))
    return sorted((s, e - s, d) for (s, e), d in found.items())


def collapse(words: list, runs: list[Run]) -> list:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [w for w, g in zip(words, np.cumsum(gone).tolist()) if not g]


def runs_of_texts(texts: list[list[bytes]]) -> list[list[Run]]:
    """Runs of each text, given by its words."""
    sizes = np.array([len(t) for t in texts], np.int64)
    out: list[list[Run]] = [[] for _ in texts]
    flat = pa.array([w for t in texts for w in t], pa.binary())
    codes = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    rank, shared = suffix_ranks(codes, np.repeat(ends, sizes))
    order = np.flatnonzero(shared >= 0)
    order = order[np.argsort(rank[order], kind="stable")]
    text = np.searchsorted(ends, order, side="right")
    by_text = np.argsort(text, kind="stable")
    order, text = order[by_text], text[by_text]
    cuts = np.flatnonzero(np.diff(text, prepend=-1, append=-1))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        t = int(text[a])
        start = int(ends[t] - sizes[t])
        out[t] = runs_of(codes[start : int(ends[t])].tolist(), (order[a:b] - start).tolist(), shared[order[a:b]].tolist())
    return out


def words_of(text: str | None) -> list[bytes]:
    """Runs of anything but space, tab, line feed, vertical tab, form feed and carriage return."""
    return (text or "").encode("utf-8").split()


def _find(reword: Callable[[object, list[bytes]], list[bytes]] | None):
    def group(ids: list, texts: list[str | None]) -> pa.RecordBatch:
        words = [words_of(t) for t in texts]
        if reword is not None:
            words = [reword(i, w) if w else w for i, w in zip(ids, words)]
        runs = runs_of_texts(words)
        kept = [b" ".join(collapse(w, r)) for w, r in zip(words, runs)]
        rows = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        return [pa.array(rows, kind), pa.array([x.decode("utf-8") for x in kept], pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = 0
            while at < len(ids):
                end, size = at, 0
                while end < len(ids) and (end == at or size < GROUP):
                    size += len(texts[end] or "")
                    end += 1
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), *group(ids[at:end], texts[at:end])],
                                                 names=["doc_id", "runs", "collapsed"])
                at = end

    return run


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              reword: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(doc_id, runs, collapsed): the runs of each whole text by start and period, and the text without their repetitions.

    ``collapsed`` has the words that no run contains after its first period,
    joined by one space. ``reword`` may change a text's words (not none) beforehand.
    Null and empty texts have no runs and an empty result. Every row is
    answered by itself, so repeated rows get equal answers and any id, null
    too, is carried along; other columns of the input are not read and cannot
    clash. A text is handled whole, in memory linear in its words.
    """
    src = need(docs, id_col, text_col).toDF("doc_id", "text")
    kind = src.schema[0].dataType.simpleString()
    return src.mapInArrow(_find(reword), f"doc_id {kind}, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def digest(found: DataFrame) -> DataFrame:
    """The run of greatest length (ties: smallest start, then period), and digests of all runs and of the collapsed text."""
    best = "array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))"
    lines = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    return found.withColumn("best", F.expr(best)).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.expr("-best.start").alias("start"), F.expr("best.length").alias("length"),
        F.expr("-best.period").alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.expr(lines).cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
