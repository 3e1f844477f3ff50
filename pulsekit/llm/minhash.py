"""Near-duplicate documents by SuperMinHash signatures (operator 1).

Signature: every element (a distinct 5-word shingle) walks one random
permutation of the slots; at step j it offers the value ``j + r`` to the slot
at the permutation's place j. A slot keeps its minimum, so once all slots hold
a value, no later step can change anything and the walk stops (early stop).
All elements of a batch of documents take step j together in NumPy.

Search: bands of the signature are bucket keys. Exact copies (equal shingle
sets) are folded first, so a bucket holds different texts only. Two rounds
compare every text with one member of each of its buckets, a hub, which settles
groups of near copies with one comparison a text; after that, whatever in a
bucket is outside the bucket's largest component is compared with all members
of other components. So every pair that shares a band ends up in one component
or has been compared, and no group of copies is expanded into pairs.

Before two texts meet, their sketches do (a few bits of each slot, of a longer
signature in the last round): pairs whose slots differ more than those of a
pair at the threshold do in one of 10^5 cases, about as rare as a pair that
misses all bands, are no candidates. Links are confirmed on the full shingle
sets and grouped by union-find.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import GOLDEN, mix, need, save
from pulsekit.llm.components import connected_components

SLOTS, BANDS = 128, 32  # 4 slots a band: at similarity 0.75 a pair misses all bands with probability 5e-6
WORDS = 5
#: Sketches: slots, bits a slot, and the most slots that may differ. A pair at 0.75
#: differs in 30 of 128 (standard deviation 4.8), and in 192 of 1024 (12.5 at most).
SHORT, WIDE = (SLOTS, 4, 55), (1024, 2, 250)
WORD_CACHE = 150_000
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


class _WordHash(dict):
    """word -> 64-bit hash; a bounded memo of the worker, never a result."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = xxhash.xxh3_64_intdigest(word)
        if len(self) >= WORD_CACHE:
            self.clear()
        self[word] = h
        return h


_HASH = _WordHash()


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``words``-word shingles of a whole text.

    A-Z are lower-cased; words are runs of anything but space and U+0009 to
    U+000D. Fewer words than ``words`` form one shingle; no words, none.
    """
    if not text:
        return np.empty(0, np.uint64)
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(parts)
    if n == 0:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_HASH.__getitem__, parts), np.uint64, n)
    size = min(words, n)
    out = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        out = mix((out ^ h[i : n - size + 1 + i]) + GOLDEN)
    return np.unique(out)


def superminhash(elements: np.ndarray, counts: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """Signatures (documents x slots, uint64) of consecutive runs of ``elements``.

    ``counts[i]`` elements belong to document i; an empty document keeps the
    largest value in all slots. A value holds step j in its top bits and the
    random rank below.
    """
    docs = np.repeat(np.arange(len(counts)), counts)
    sig = np.full(len(counts) * slots, _EMPTY, np.uint64)
    shift = np.uint64(64 - int(slots).bit_length())
    low = np.uint64(64) - shift
    live, perm = np.arange(len(elements)), None
    for j in range(slots):
        z = mix(elements[live] + np.uint64(int(GOLDEN) * (j + 1) & 0xFFFFFFFFFFFFFFFF))
        pick = j + ((mix(z + GOLDEN) >> np.uint64(32)) * np.uint64(slots - j) >> np.uint64(32)).astype(np.int64)
        if perm is None:
            slot = pick
        else:
            rows = np.arange(len(live))
            slot = perm[rows, pick]
            perm[rows, pick] = perm[rows, j]
        np.minimum.at(sig, docs[live] * slots + slot, (np.uint64(j) << shift) | (z >> low))
        full = (sig.reshape(-1, slots) != _EMPTY).all(axis=1)
        stay = ~full[docs[live]]
        if not stay.any():
            break
        if perm is None:  # place 0 has gone to the slot that was picked
            live, pick = live[stay], pick[stay]
            perm = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16), (len(live), 1))
            perm[np.arange(len(live)), pick] = 0
        elif stay.mean() < 0.7:
            live, perm = live[stay], perm[stay]
    return sig.reshape(-1, slots)


def band_keys(sig: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key a band, documents x bands."""
    rows = sig.reshape(len(sig), bands, -1)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * GOLDEN, (len(sig), bands))
    for i in range(rows.shape[2]):
        key = mix((key ^ rows[:, :, i]) + GOLDEN)
    return key


def sketches(sig: np.ndarray, bits: int) -> np.ndarray:
    """The last ``bits`` bits of each slot's hash, in 64-bit words."""
    rows = (mix(sig + GOLDEN) & np.uint64((1 << bits) - 1)).reshape(len(sig), -1, 64 // bits)
    return (rows << np.arange(0, 64, bits, dtype=np.uint64)).sum(axis=2, dtype=np.uint64)


def _differing(a: str, b: str, kind: tuple[int, int, int]) -> Column:
    """Number of slots in which two sketches (columns ``a0``, ``b0`` and on) differ."""
    slots, bits, _ = kind
    total, lowest = F.lit(0), sum(1 << i for i in range(0, 63, bits))
    for i in range(slots * bits // 64):
        x = F.col(f"{a}{i}").bitwiseXOR(F.col(f"{b}{i}"))
        for k in (1, 2)[: bits // 2]:  # each slot's bits to its lowest
            x = x.bitwiseOR(F.shiftrightunsigned(x, k))
        total = total + F.bit_count(x.bitwiseAND(F.lit(lowest)))
    return total


def _may_link(a: str, b: str, kind: tuple[int, int, int]) -> Column:
    """Sizes and sketches allow a similarity of 75 %."""
    n, m = F.col(f"{a}n"), F.col(f"{b}n")
    return (100 * F.least(n, m) >= 75 * F.greatest(n, m)) & (_differing(a, b, kind) <= kind[2])


def _wide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rep, n, words of the long signature's sketch) of each text."""
    slots, bits, _ = WIDE
    for batch in batches:
        for at in range(0, batch.num_rows, 16):
            part = batch.slice(at, 16)
            sets = [shingle_set(t) for t in part.column(1).to_pylist()]
            counts = np.array([len(x) for x in sets])
            words = sketches(superminhash(np.concatenate(sets), counts, slots), bits).astype(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64()), *map(pa.array, words.T)],
                                             names=["rep", "n", *map(str, range(words.shape[1]))])


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    for batch in batches:
        ids, texts, at = batch.column(0), batch.column(1), 0
        while at < len(texts):
            sets, n, start = [], 0, at
            while at < len(texts) and n < 100_000 and len(sets) < 2000:  # bounded working set, whole texts
                sets.append(shingle_set(texts[at].as_py()))
                n += len(sets[-1])
                at += 1
            counts = np.array([len(s) for s in sets])
            sig = superminhash(np.concatenate(sets), counts)
            keys = band_keys(sig).astype(np.int64)[counts > 0].ravel()
            offsets = np.concatenate([[0], np.cumsum(np.where(counts > 0, BANDS, 0))]).astype(np.int32)
            words = sketches(sig, SHORT[1]).astype(np.int64)
            places = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * words.shape[1])
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [ids.slice(start, at - start), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys)),
                 pa.ListArray.from_arrays(places, pa.array(words.ravel()))],
                names=["doc_id", "n_shingles", "digest", "bands", "sketch"],
            )


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep the pairs whose full shingle sets have a similarity of at least 75 %."""
    sets: dict[tuple[int, str], np.ndarray] = {}  # a hub's pairs come one after another; an id can have several texts

    def of(i: int, text: str) -> np.ndarray:
        got = sets.get((i, text))
        if got is None:
            if len(sets) >= 64:
                sets.clear()
            got = sets[i, text] = shingle_set(text)
        return got

    for batch in batches:
        a, b, ta, tb = batch.column(0), batch.column(1), batch.column(2), batch.column(3)
        keep = []
        for i in range(batch.num_rows):
            x, y = of(a[i].as_py(), ta[i].as_py()), shingle_set(tb[i].as_py())
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(both > 0 and 100 * both >= 75 * (len(x) + len(y) - both))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Null and empty texts, and texts of white space, have no shingles and link
    with nothing. Repeated rows are answered each by itself; a repeated id
    links whatever any of its texts links. Rows with a null id take part, and
    are kept only if no text with an id equals theirs (component_id is then
    null). An empty table gives an empty result.
    """
    src = need(docs, id_col, text_col).toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    sigs = save(
        src.mapInArrow(_signatures, "doc_id long, n_shingles long, digest binary, bands array<long>, sketch array<long>"), "minhash-sigs")
    reps = sigs.filter("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("rep"))
    classes = save(
        sigs.join(reps, "digest", "left").select("doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("rep"),
                                                 *[F.when(F.col("doc_id") == F.col("rep"), F.col(c)).alias(c) for c in ("bands", "sketch")]),
        "minhash-classes",
    )
    links = _links(src, classes)
    labels = connected_components(links, "a", "b")
    return (
        classes.join(labels, classes["rep"] == labels["node"], "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def _links(src: DataFrame, classes: DataFrame) -> DataFrame:
    """Confirmed links (a, b) that join all texts which are similar and share a band."""
    texts = classes.filter("bands is not null")
    rows = texts.select("rep", F.posexplode("bands").alias("place", "bucket"))
    shared = rows.groupBy("bucket").agg(F.min("rep").alias("hub"), F.max("rep").alias("last")).filter("last > hub")
    left = save(rows.join(shared, "bucket").select("bucket", "place", "rep", "hub").distinct(), "minhash-buckets")
    ids = left.select("rep").distinct()
    body = save(src.join(ids, src["doc_id"] == ids["rep"]).select("rep", "text"), "minhash-texts")
    sketch = save(texts.join(ids, "rep", "left_semi").select(
        "rep", F.col("n_shingles").alias("n"), *[F.col("sketch")[i].alias(str(i)) for i in range(SHORT[0] * SHORT[1] // 64)]), "minhash-sketches")

    def side(name: str, of: DataFrame) -> DataFrame:
        return of.select(*[F.col(f"`{c}`").alias(name if c == "rep" else f"{name}{c}") for c in of.columns])

    def confirmed(pairs: DataFrame) -> DataFrame:
        a = body.select(F.col("rep").alias("a"), F.col("text").alias("ta"))
        b = body.select(F.col("rep").alias("b"), F.col("text").alias("tb"))
        full = pairs.join(b, "b").join(a, "a").select("a", "b", "ta", "tb")
        return save(full.mapInArrow(_linked, "a long, b long"), "minhash-links")

    def stars(pairs: DataFrame) -> DataFrame:
        """Of each text's hubs, the one with the nearest sketch is compared."""
        near = pairs.join(side("rep", sketch), "rep").join(side("hub", sketch), "hub").filter(_may_link("rep", "hub", SHORT))
        best = near.groupBy("rep").agg(F.min(F.struct(_differing("rep", "hub", SHORT).alias("d"), "hub")).alias("h"))
        return confirmed(best.select(F.least("rep", "h.hub").alias("a"), F.greatest("rep", "h.hub").alias("b")).distinct())

    def still_open(links: DataFrame) -> DataFrame:
        """Rows of the buckets that hold more than one component."""
        labels = connected_components(links, "a", "b").withColumnRenamed("node", "rep")
        now = save(left.drop("hub").join(labels, "rep", "left").select(
            "bucket", "place", "rep", F.coalesce("component", "rep").alias("component")), "minhash-labelled")
        mixed = now.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo != hi")
        return now.join(mixed, "bucket").select("bucket", "place", "rep", "component", "hi")

    links = stars(left.filter("rep != hub").select("rep", "hub").distinct())
    # second hub: a member of the component with the largest label
    now = save(still_open(links), "minhash-open")
    hubs = now.filter("component = hi").groupBy("bucket").agg(F.min("rep").alias("hub"))
    links = links.unionByName(stars(now.filter("component != hi").join(hubs, "bucket").select("rep", "hub").distinct()))
    # what is outside a bucket's largest component, against all members of other components
    now = save(still_open(links).drop("hi"), "minhash-open")
    most = now.groupBy("bucket", "component").count().groupBy("bucket").agg(F.max(F.struct("count", "component")).alias("m"))
    odd = now.join(most.select("bucket", F.col("m.component").alias("main")), "bucket").filter("component != main")
    words = WIDE[0] * WIDE[1] // 64
    open_texts = body.join(now.select("rep").distinct(), "rep", "left_semi").select("rep", "text")
    wide = save(open_texts.mapInArrow(_wide, "rep long, n long, " + ", ".join(f"`{i}` long" for i in range(words))), "minhash-wide")
    wide = wide.join(texts.select("rep", "bands"), "rep")
    odd = odd.join(side("odd", wide), F.col("rep") == F.col("odd")).select(
        F.col("bucket").alias("at"), F.col("component").alias("apart"), *[f"`{c}`" for c in side("odd", wide).columns])
    every = now.join(side("all", wide), F.col("rep") == F.col("all")).drop("rep")
    # a pair counts in the first bucket that it shares
    sooner = F.arrays_overlap(F.slice("oddbands", 1, F.col("place")), F.slice("allbands", 1, F.col("place")))
    near = (F.col("at") == F.col("bucket")) & (F.col("apart") != F.col("component")) & _may_link("odd", "all", WIDE) & ~sooner
    pairs = odd.join(every, near).select(F.least("odd", "all").alias("a"), F.greatest("odd", "all").alias("b")).distinct()
    return links.unionByName(confirmed(save(pairs, "minhash-pairs")))
