"""Approximate nearest neighbours on robust-pruned graphs (operator 4).

Rows are dealt to shards of at most about ``SHARD`` vectors by a hash; each shard
gets a directed graph. Points join in blocks that double in size: a greedy
beam search on the graph so far proposes neighbours, robust pruning keeps
those that no kept, ``ALPHA`` times nearer neighbour makes redundant, and the
chosen ones link back (pruned again where the degree overflows). The graph
(edges as a column) is a table; a query block meets every shard, beam search
finds its nearest there, and the shards' answers are merged.

All points of a block, and all queries of a block, take each step together in
NumPy, so a task holds one shard and one block of queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.llm.common import need, save
from pulsekit.llm.vectors import unit, usable

SHARD, DEGREE, ALPHA, BUILD_BEAM, QUERY_BEAM, QUERY_BLOCK = 2048, 32, 1.2, 64, 96, 4096




def beam_search(x: np.ndarray, edges: np.ndarray, start: int, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and distances (1 - cosine) of the ``beam`` best places found for each query, nearest first.

    ``edges`` is -1 where a point has fewer neighbours; -1 ids fill short results.
    """
    n, rows = len(x), np.arange(len(q))
    ids = np.full((len(q), beam), -1, np.int64)
    dist = np.full((len(q), beam), np.inf)
    ids[:, 0], dist[:, 0] = start, 1 - q @ x[start]
    done = np.ones((len(q), beam), bool)
    done[:, 0] = False
    seen = np.zeros((len(q), n + 1), bool)
    seen[:, start] = seen[:, n] = True
    live = rows
    while len(live):
        at = np.argmax(~done[live], axis=1)  # the nearest place not expanded yet
        here = ids[live, at]
        done[live, at] = True
        near = edges[here]
        near = np.where(near < 0, n, near)
        new = ~seen[live[:, None], near]
        seen[live[:, None], near] = True
        d = np.where(new, 1 - np.einsum("qrd,qd->qr", x[np.minimum(near, n - 1)], q[live]), np.inf)
        all_ids = np.concatenate([ids[live], np.where(new, near, -1)], axis=1)
        all_dist = np.concatenate([dist[live], d], axis=1)
        all_done = np.concatenate([done[live], ~new], axis=1)
        best = np.argsort(all_dist, axis=1, kind="stable")[:, :beam]
        pick = np.arange(len(live))[:, None]
        ids[live], dist[live], done[live] = all_ids[pick, best], all_dist[pick, best], all_done[pick, best]
        live = live[(~done[live]).any(axis=1)]
    return ids, dist


def robust_prune(x: np.ndarray, points: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Up to ``degree`` diverse neighbours of each point out of its candidates (-1: none)."""
    n = len(x)
    cand = np.where((cand == points[:, None]) | (cand < 0), n, cand)
    cand = np.sort(cand, axis=1)
    cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = n  # each once
    vecs = x[np.minimum(cand, n - 1)]
    to_point = np.where(cand < n, 1 - np.einsum("bcd,bd->bc", vecs, x[points]), np.inf)
    order = np.argsort(to_point, axis=1, kind="stable")
    pick = np.arange(len(points))[:, None]
    cand, to_point, vecs = cand[pick, order], to_point[pick, order], vecs[pick, order]
    out = np.full((len(points), degree), -1, np.int64)
    alive, rows, kept = cand < n, np.arange(len(points)), np.zeros(len(points), np.int64)
    while True:
        go = alive.any(axis=1) & (kept < degree)
        if not go.any():
            return out
        at, r = np.argmax(alive[go], axis=1), rows[go]
        out[r, kept[go]] = cand[r, at]
        kept[r] += 1
        between = 1 - np.einsum("bcd,bd->bc", vecs[r], vecs[r, at])
        alive[r] &= alpha * np.maximum(between, 0) > to_point[r]  # squared distances: alpha is relaxed accordingly
        alive[r, at] = False


def build_graph(x: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA, beam: int = BUILD_BEAM, seed: int = 7) -> tuple[np.ndarray, int]:
    """(edges, entry point) over unit vectors ``x``; the entry is the point nearest to the mean."""
    n = len(x)
    start = int(np.argmax(x @ x.mean(axis=0)))
    edges = np.full((n, degree), -1, np.int64)
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate([[start], order[order != start]])
    for k, a in enumerate((1.0, alpha)):  # a first pass without, a second with relaxed pruning
        at, size = (1, 1) if k == 0 else (0, 512)
        while at < n:
            points = order[at : at + size]
            at, size = at + size, min(2 * size, 512)
            found, _ = beam_search(x, edges, start, x[points], beam)
            if k == 0 and len(points) < 64:  # the first points know each other
                found = np.concatenate([found, np.tile(points, (len(points), 1))], axis=1)
            edges[points] = robust_prune(x, points, np.concatenate([found, edges[points]], axis=1), degree, a)
            src, dst = np.repeat(points, degree), edges[points].ravel()
            src, dst = src[dst >= 0], dst[dst >= 0]
            by = np.argsort(dst, kind="stable")
            src, dst = src[by], dst[by]
            to, first, many = np.unique(dst, return_index=True, return_counts=True)
            back = np.full((len(to), int(many.max(initial=0))), -1, np.int64)
            back[np.repeat(np.arange(len(to)), many), np.arange(len(dst)) - np.repeat(first, many)] = src
            for b in range(0, len(to), 256):
                edges[to[b : b + 256]] = robust_prune(
                    x, to[b : b + 256], np.concatenate([edges[to[b : b + 256]], back[b : b + 256]], axis=1), degree, a)
    return connect(x, edges, start, beam), start


def connect(x: np.ndarray, edges: np.ndarray, start: int, beam: int) -> np.ndarray:
    """Two more columns of edges that make every point reachable from the entry.

    Pruning can leave points without a way in (copies above all). They are
    hung, one after another, below the nearest point that a search finds.
    """
    wide = np.concatenate([edges, np.full((len(x), 2), -1, np.int64)], axis=1)
    seen, now = np.zeros(len(x), bool), np.array([start])
    while len(now):
        seen[now] = True
        now = np.unique(edges[now])
        now = now[(now >= 0)]
        now = now[~seen[now]]
    lost = np.flatnonzero(~seen)
    if len(lost):
        above = np.concatenate([beam_search(x, edges, start, x[lost[k : k + 512]], beam)[0][:, 0] for k in range(0, len(lost), 512)])
        order = np.argsort(above, kind="stable")
        lost, above = lost[order], above[order]
        first = np.diff(above, prepend=-1) != 0
        wide[above[first], -2] = lost[first]
        wide[lost[:-1][~first[1:]], -1] = lost[1:][~first[1:]]
    return wide


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["vec_id", "tie"], kind="stable").reset_index(drop=True)
    edges, start = build_graph(unit(np.stack(pdf["vec"].to_numpy()).astype(np.float64)))
    return pd.DataFrame({"shard": pdf["shard"], "vec_id": pdf["vec_id"], "vec": pdf["vec"], "place": np.arange(len(pdf)),
                         "entry": np.arange(len(pdf)) == start, "edges": [e[e >= 0] for e in edges.astype(np.int32)]})


def build_index(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", shard_rows: int = SHARD) -> DataFrame:
    """The index as a table: shard, vec_id, vec, place, entry, edges (places in the same shard).

    Every usable vector is indexed, repeated ids and vectors too. Vectors of
    different length are in different shards.
    """
    rows = need(vectors, id_col, vec_col).toDF("vec_id", "vec")
    rows = rows.filter(F.col("vec_id").isNotNull() & usable("vec")).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("vec").cast("array<double>").alias("vec"))
    rows = save(rows, "ann-vectors")
    sizes = {r[0]: r[1] for r in rows.groupBy(F.size("vec")).count().collect()}  # a row per vector length
    many = F.lit(1)
    for d, n in sizes.items():
        many = F.when(F.size("vec") == d, F.lit(max(1, -(-n // shard_rows)))).otherwise(many)
    rows = save(rows.withColumn("tie", F.monotonically_increasing_id()), "ann-dealt").withColumn(
        "shard", F.concat_ws("-", F.size("vec"), F.pmod(F.xxhash64("vec_id", "tie"), many)))
    return save(rows.groupBy("shard").applyInPandas(
        _build, "shard string, vec_id long, vec array<double>, place int, entry boolean, edges array<int>"), "ann-index")


def _search(k: int, beam: int):
    def run(key, shard: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        if not len(shard) or not len(queries):
            return empty
        shard = shard.sort_values("place").reset_index(drop=True)
        x = unit(np.stack(shard["vec"].to_numpy()).astype(np.float64))
        degree = max(1, max(len(e) for e in shard["edges"]))
        edges = np.full((len(x), degree), -1, np.int64)
        for i, e in enumerate(shard["edges"]):
            edges[i, : len(e)] = e
        q, ids = unit(np.stack(queries["vec"].to_numpy()).astype(np.float64)), shard["vec_id"].to_numpy()
        out = []
        for at in range(0, len(q), 512):
            block = q[at : at + 512]
            found, _ = beam_search(x, edges, int(np.argmax(shard["entry"].to_numpy())), block, min(beam, len(x)))
            own = queries["query_id"].to_numpy()[at : at + 512]
            score = np.einsum("qbd,qd->qb", x[np.maximum(found, 0)], block)
            ok = (found >= 0) & (ids[np.maximum(found, 0)] != own[:, None])
            score = np.where(ok, score, -np.inf)
            best = np.lexsort((np.where(ok, ids[np.maximum(found, 0)], 0), -score), axis=1)[:, : k]
            pick = np.arange(len(block))[:, None]
            good = ok[pick, best]
            out.append(pd.DataFrame({"query_id": np.repeat(own, good.sum(axis=1)), "vec_id": ids[found[pick, best][good]], "score": score[pick, best][good]}))
        return pd.concat(out) if out else empty

    return run


def search(index: DataFrame, queries: DataFrame, k: int = 5, beam: int = QUERY_BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for each row of ``queries`` (query_id, vec).

    The score is the cosine in double precision; ties go to the smaller id. A
    vector with the query's own id is never its neighbour. Queries meet shards
    of their vector length only.
    """
    queries = save(queries.withColumn("block", F.monotonically_increasing_id()), "ann-queries")
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("query_id", "block"), F.lit(blocks)).cast("int"))
    shards = index.select(F.col("shard").alias("at"), F.size("vec").alias("d")).distinct()
    at_shard = queries.join(shards, F.size("vec") == F.col("d")).select("at", "block", "query_id", "vec")
    at_block = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = at_block.groupBy("shard", "block").cogroup(at_shard.groupBy("at", "block")).applyInPandas(
        _search(k, beam), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
