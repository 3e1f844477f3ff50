"""Near-duplicate vectors by iterative quantisation (operator 7).

Model: on a bounded sample, centred vectors are rotated onto their principal
axes and the rotation is refined by alternating between binary codes and the
best orthogonal map to them (Procrustes), which balances the bits. Several
such rotations, from different starts, give codes of any length.

Retrieval: the code is cut into substrings, one hash table each. The substring
length follows the number of vectors. The number of tables is measured: sample
vectors are paired with made ones at the threshold, both are coded like any
vector (centred, so a common mean widens their angle), and tables are added until
a share of ``RECALL`` of the pairs has a substring in common. Where ``MOST``
tables do not reach it, substrings get shorter, down to none (all are compared).

Rerank: vectors that share a table's substring are compared by the cosine of
their original vectors. Equal vectors are folded first. A bucket is cut into
blocks of ``BLOCK`` vectors, and each pair of blocks is a work item of its own, so
no bucket, however large, meets in one task. A pair counts in the first table
it shares; items return each vector's number of links and a spanning forest,
never the pairs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import need, save
from pulsekit.llm.components import connected_components
from pulsekit.llm.vectors import unit, usable

THRESHOLD, RECALL = 0.98, 0.995
MOST, PAIRS = 96, 4000  # tables before substrings get shorter; measured pairs of either kind
SAMPLE, ROUNDS, BLOCK = 20_000, 25, 128  # vectors that the rotations are learned on; refinements; vectors a block


def learn_rotations(x: np.ndarray, n: int, rounds: int = ROUNDS, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """(mean, n rotations of d x d) from sample rows ``x`` of unit vectors."""
    mean = x.mean(axis=0)
    x = x - mean
    d = x.shape[1]
    _, axes = np.linalg.eigh(x.T @ x + 1e-9 * np.eye(d))
    v = x @ axes
    out, rng = [], np.random.default_rng(seed)
    for _ in range(n):
        r = np.linalg.qr(rng.standard_normal((d, d)))[0]
        for _ in range(rounds):
            b = np.where(v @ r >= 0, 1.0, -1.0)
            u, _, w = np.linalg.svd(b.T @ v)
            r = (u @ w).T
        out.append(axes @ r)
    return mean, np.stack(out)


def tables_for(bits: int, threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """Substrings of ``bits`` bits that a pair at the threshold needs at least to share one with probability ``recall``."""
    same = (1 - np.arccos(threshold) / np.pi) ** bits
    return int(np.ceil(np.log(1 - recall) / np.log(1 - same)))


def threshold_pairs(x: np.ndarray, threshold: float, n: int = PAIRS, seed: int = 13) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``x`` and unit vectors at the threshold from them: ``n`` towards other rows, then ``n`` in any direction."""
    rng = np.random.default_rng(seed)
    a = x[rng.integers(0, len(x), 2 * n)]
    to = np.concatenate([x[rng.integers(0, len(x), n)], rng.standard_normal((n, x.shape[1]))])
    for _ in range(2):  # a row towards itself has no direction: any will do
        to = to - (to * a).sum(axis=1, keepdims=True) * a
        none = np.linalg.norm(to, axis=1) < 1e-6
        to[none] = rng.standard_normal((int(none.sum()), x.shape[1]))
    to = to - (to * a).sum(axis=1, keepdims=True) * a
    long = np.maximum(np.linalg.norm(to, axis=1, keepdims=True), 1e-300)
    return a, threshold * a + np.sqrt(1 - threshold**2) * to / long


def fit_tables(x: np.ndarray, bits: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[np.ndarray, np.ndarray, int, int]:
    """(mean, rotations, bits, tables) with which pairs at the threshold share a substring with probability ``recall``."""
    d = x.shape[1]
    least = tables_for(bits, threshold, recall)
    a, b = threshold_pairs(x, threshold)
    tries = [(bits, least), (bits, max(MOST, least)), *((k, MOST) for k in range(bits - 1, 0, -1))]
    mean, rotations = learn_rotations(x, -(-bits * least // d))
    for k, most in tries:
        if k * most > len(rotations) * d:
            mean, rotations = learn_rotations(x, -(-k * most // d))
        same = substrings(a, mean, rotations, k, most) == substrings(b, mean, rotations, k, most)
        share = np.logical_or.accumulate(same, axis=1).reshape(2, -1, most).mean(axis=1).min(axis=0)
        if share[-1] >= recall:
            tables = max(least if k == bits else 1, int(np.argmax(share >= recall)) + 1)
            return mean, rotations[: -(-k * tables // d)], k, tables
    return mean, rotations[:1], 0, 1


def substrings(x: np.ndarray, mean: np.ndarray, rotations: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Code of each row of ``x`` as integers, rows x tables."""
    y = (x - mean) @ rotations.transpose(1, 0, 2).reshape(x.shape[1], -1)
    b = (y >= 0)[:, : bits * tables].reshape(len(x), tables, bits)
    return (b << np.arange(bits)).sum(axis=2)


def _coder(models: dict[int, tuple[np.ndarray, np.ndarray, int, int]], tables: int):
    """Task: append each vector's codes; those beyond the tables of its length are -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs = batch.column("vec")
            sizes = np.diff(vecs.offsets.to_numpy())
            codes = np.full((len(vecs), tables), -1, np.int64)
            for d in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == d)
                mine = vecs.take(pa.array(at))
                codes[at, : models[d][3]] = substrings(unit(mine.flatten().to_numpy().reshape(-1, d)), *models[d])
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(vecs) + 1, dtype=np.int32) * tables), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, flat], names=[*batch.schema.names, "code"])

    return run


def _item(table: int, side: np.ndarray, x: np.ndarray, code: np.ndarray, many: np.ndarray, threshold: float):
    """(number of links, smallest place reached) for each row of a work item."""
    a, b = np.flatnonzero(side != 2), np.flatnonzero(side != 1)  # one block against another, or (side 0) itself
    link = x[a] @ x[b].T >= threshold
    for t in range(table):  # a pair belongs to the first table it shares
        link &= code[a, t][:, None] != code[b, t][None, :]
    n = np.zeros(len(x), np.int64)
    if side[0] == 0:
        np.fill_diagonal(link, False)
        n += link @ many
    else:
        n[a] += link @ many[b]
        n[b] += link.T @ many[a]
    top = np.arange(len(x))
    i, j = np.nonzero(link)
    i, j = a[i], b[j]
    while True:
        old = top.copy()
        low = np.minimum(top[i], top[j])
        np.minimum.at(top, i, low)
        np.minimum.at(top, j, low)
        top = top[top]
        if (top == old).all():
            return n, top


def _compare(threshold: float):
    """Work items, whole and one after another in a sorted partition -> link counts and forest edges."""

    def items(rows: pa.RecordBatch, last: bool) -> tuple[list, int]:
        key = rows.column("item").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), *([len(key)] if last else [])]
        ids, many, side, table = (rows.column(c).to_numpy() for c in ("cls", "many", "side", "table"))
        vec, code = rows.column("vec"), rows.column("code")
        at, width = vec.offsets.to_numpy(), len(code[0])
        values, codes = vec.values.to_numpy(), code.flatten().to_numpy().reshape(-1, width)
        done = []
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            x = unit(values[at[lo] : at[hi]].reshape(hi - lo, -1))
            n, top = _item(int(table[lo]), side[lo:hi], x, codes[lo:hi], many[lo:hi], threshold)
            mine = ids[lo:hi]
            keep = n > 0
            done.append((mine[keep], n[keep], mine[top][keep]))
        return done, cuts[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in itertools.chain(batches, [None]):
            if batch is None and rest is None:
                return
            parts = [x for x in (rest, batch) if x is not None]
            rows = pa.Table.from_batches(parts).combine_chunks().to_batches()
            if not rows:
                continue
            done, end = items(rows[0], last=batch is None)
            rest = rows[0].slice(end)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*done)], names=["cls", "n", "top"])

    return run


def near_duplicate_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str | None = "label",
    threshold: float = THRESHOLD,
    sample: int = SAMPLE,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``.

    Vectors are compared if they have the same label and length; a null label
    or id, or a vector that is null, zero or holds null or non-finite
    components, links with nothing. Repeated rows link with each other (same
    vector) and are answered each by itself. An empty table gives an empty
    result.
    """
    names = [id_col, vec_col] + ([label_col] if label_col else [])
    rows = need(vectors, *names).toDF("vec_id", "vec", *(["label"] if label_col else []))
    label = F.col("label").cast("string") if label_col else F.lit("")
    fine = usable("vec") & label.isNotNull() & F.col("vec_id").isNotNull()
    rows = save(rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"),
                            F.when(fine, F.col("vec").cast("array<double>")).alias("vec")), "itq-rows")
    # equal vectors of a label are one class; its weight is their number
    classes = rows.filter("vec is not null").groupBy("label", "vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("many"))
    classes = save(classes.withColumn("cls", F.monotonically_increasing_id()), "itq-classes")
    found = _links(classes, threshold, sample)
    count = found.groupBy("cls").agg(F.sum("n").alias("n"))
    labels = connected_components(found, "cls", "top")
    tops = labels.join(classes, labels["node"] == classes["cls"]).groupBy("component").agg(F.min("rep").alias("smallest"))
    answer = (
        classes.join(count, "cls", "left").join(labels.withColumnRenamed("node", "cls"), "cls", "left").join(tops, "component", "left")
        .select("label", "vec", (F.coalesce("n", F.lit(0)) + F.col("many") - 1).alias("n_links"), F.coalesce("smallest", "rep").alias("top"))
    )
    out = rows.join(answer, ["label", "vec"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("top", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _links(classes: DataFrame, threshold: float, sample: int) -> DataFrame:
    """(cls, n, top): partial link counts and, for each linked class, one it is connected with in its work item."""
    sizes = {r[0]: r[1] for r in classes.groupBy(F.size("vec")).count().collect()}  # a row per vector length
    total = sum(sizes.values())
    bits = int(min(30, max(8, np.ceil(np.log2(max(total, 2))))))
    models = {}
    for d in sizes:
        rows = min(sample, max(200, 4_000_000 // d))  # bounds the sample's memory for long vectors
        got = classes.filter(F.size("vec") == d).select("vec").orderBy(F.xxhash64("vec"), "vec").limit(rows).collect()
        models[d] = fit_tables(unit(np.array([r[0] for r in got], np.float64)), bits, threshold)
    tables = max((m[3] for m in models.values()), default=1)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema.fields)
    coded = save(classes.mapInArrow(_coder(models, tables), f"{kinds}, code array<long>"), "itq-codes")
    place = coded.select("cls", F.posexplode("code").alias("table", "value"), "label", F.size("vec").alias("d")).filter("value >= 0")
    place = place.select("cls", "table", F.concat_ws("/", "table", "d", "value", "label").alias("bucket"))
    big = place.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    place = place.join(big, "bucket").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    place = place.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2)
    item = F.concat_ws("/", F.least("block", "other"), F.greatest("block", "other"), "bucket")
    work = place.select("cls", "table", side.alias("side"), item.alias("item"))
    work = work.join(coded.select("cls", "vec", "many", "code"), "cls").repartition("item").sortWithinPartitions("item", "cls", "side")
    return save(work.select("item", "table", "side", "cls", "many", "vec", "code").mapInArrow(
        _compare(threshold), "cls long, n long, top long"), "itq-links")
