"""Alignment of two tokenizers' tokens over a corpus (operator 13).

Both tokenizers encode the whole text (A the text behind one space, B adds the
space itself). If the tokens of each, joined, are these bytes again, they cover
the same bytes, and their ends can be compared. Where both have an end and the
next token of both begins with a space lies an anchor; anchors cut a text into
windows, and a window is fully described by its ids of A and of B. Windows
repeat, so each different one of a chunk is aligned once and remembered by its id tuples:
its groups (cut where both have an end) and its links (pairs of tokens that
share bytes). Everything about a text is a sum, or a string, over its windows.

How often a pair of ids is linked in the corpus takes one exchange. Tasks write
their documents in chunks of about ``CHUNK`` characters: a row a document with
the numbers of its windows, and a row a chunk with the chunk's different
windows, pairs and their counts. Only these distinct pairs are exchanged, at
most once a chunk each, however common a pair is: summed up, compared with the
highest of their id of B, and sent back to their chunk, where documents are
summed from their windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from pulsekit.llm.common import need, save
from pulsekit.llm.tokens import TextEncoder, byte_symbols

GROUP, CHUNK = 2_000_000, 8_000_000  # characters encoded together; of a chunk

#: ids of A and of B
Window = tuple[tuple[int, ...], tuple[int, ...]]

class PlainTextEncoder(TextEncoder):
    """A :class:`TextEncoder` to which the strings of special tokens are text like any other."""

    def __init__(self, path: str):
        super().__init__(path)
        self.library.encode_special_tokens = True
        self.special = {}


class Tokens:
    """The bytes of a vocabulary's tokens: their joint string, lengths, and which begin with a space."""

    def __init__(self, tokens: list[bytes]):
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.spaced = np.array([t.startswith(b" ") for t in tokens], bool)
        self.decimal = pa.array([str(i) for i in range(len(tokens))])

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the tokens in a row."""
        size = self.size[ids]
        ends = np.cumsum(size)
        return self.blob[np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size - self.start[ids], size)]


def join(items: pa.Array, cuts: np.ndarray, by: str) -> pa.Array:
    """Between each two cuts the items, joined."""
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(cuts, pa.int64()), items), by)


def byte_level_tokens(enc: TextEncoder) -> Tokens:
    value = {s: b for b, s in enumerate(byte_symbols())}
    names = {i: s for s, i in enc.spec["model"]["vocab"].items()}
    return Tokens([bytes(value[c] for c in names.get(i, "") if c in value) for i in range(max(names) + 1)])


def piece_tokens(model) -> Tokens:
    """A piece in UTF-8 with U+2581 as space; a byte piece <0xHH> is that byte."""
    return Tokens([bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode("utf-8")
                   for i, p in enumerate(model.id_to_piece(list(range(model.get_piece_size()))))])


class Aligner:
    """Encodes texts with both tokenizers and aligns their windows."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.enc_a = PlainTextEncoder(path_a)
        self.enc_b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.a, self.b = byte_level_tokens(self.enc_a), piece_tokens(self.enc_b)

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and B of each text; none of both if null, empty, or if the joined bytes are others."""
        full = [" " + t if t else "" for t in texts]
        got_a = [np.frombuffer(x, "<u4").astype(np.int64) for x in self.enc_a.encode(full)]
        got_b = [np.array(x, np.int64) for x in self.enc_b.encode([t or "" for t in texts], num_threads=1)]
        out, none = [], np.zeros(0, np.int64)
        for text, a, b in zip(full, got_a, got_b):
            raw = np.frombuffer(text.encode("utf-8"), np.uint8)
            same = len(raw) and np.array_equal(self.a.joined(a), raw) and np.array_equal(self.b.joined(b), raw)
            out.append((a, b) if same else (none, none))
        return out

    def align(self, windows: list[Window]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """(groups as text, number of groups, number of links) of each window, and the links' pairs (a << 32 | b) in a row.

        The windows lie in a row, so that an end has a place: each different
        end of A or B closes one link, and one of both closes a group.
        """
        size_a, size_b = (np.fromiter((len(w[k]) for w in windows), np.int64, len(windows)) for k in (0, 1))
        a, b = (np.fromiter((x for w in windows for x in w[k]), np.int64, n.sum()) for k, n in ((0, size_a), (1, size_b)))
        end_a, end_b = np.cumsum(self.a.size[a]), np.cumsum(self.b.size[b])
        ends = np.union1d(end_a, end_b)
        at_a, at_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        shared = np.flatnonzero((end_a[at_a] == ends) & (end_b[at_b] == ends))
        links = np.bincount(np.repeat(np.arange(len(windows)), size_a)[at_a], minlength=len(windows))
        groups = np.diff(np.searchsorted(shared, np.cumsum(links) - 1, side="right"), prepend=0)
        text = [join(tokens.decimal.take(pa.array(ids)), np.append(0, at[shared] + 1), ",")
                for tokens, ids, at in ((self.a, a, at_a), (self.b, b, at_b))]
        rows = join(pc.binary_join_element_wise(*text, "|"), np.append(0, np.cumsum(groups)), ";")
        return rows, groups, links, a[at_a] << 32 | b[at_b]

    def windows(self, coded: list[tuple[np.ndarray, np.ndarray]]) -> tuple[list[Window], np.ndarray, np.ndarray]:
        """(different windows, the number of each window in text order, how many windows each text has)."""
        a, b = np.concatenate([x for x, _ in coded]), np.concatenate([x for _, x in coded])
        if not len(a):
            return [], np.zeros(0, np.int64), np.zeros(len(coded), np.int64)
        end_a, end_b = np.cumsum(self.a.size[a]), np.cumsum(self.b.size[b])
        # every text begins with a space, so the texts' own borders are anchors as well
        anchor_a = end_a[np.append(self.a.spaced[a[1:]], True)]
        anchor_b = end_b[np.append(self.b.spaced[b[1:]], True)]
        anchors = np.intersect1d(anchor_a, anchor_b, assume_unique=True)
        cut_a, cut_b = (np.concatenate([[0], np.searchsorted(e, anchors) + 1]) for e in (end_a, end_b))
        codes = []
        for ids, cut in ((a, cut_a), (b, cut_b)):
            raw = pa.py_buffer(ids.astype("<i4").tobytes())
            rows = pa.Array.from_buffers(pa.large_binary(), len(cut) - 1, [None, pa.py_buffer((4 * cut).astype("<i8").tobytes()), raw])
            codes.append(rows.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64))
        _, first, number = np.unique(codes[0] << 32 | codes[1], return_index=True, return_inverse=True)
        list_a, list_b = a.tolist(), b.tolist()
        keys = [(tuple(list_a[i:j]), tuple(list_b[k:m])) for i, j, k, m in
                zip(*(c[x].tolist() for c in (cut_a, cut_b) for x in (first, first + 1)))]
        borders = np.cumsum([int(self.a.size[x].sum()) for x, _ in coded])
        many = np.diff(np.searchsorted(anchors, borders, side="right"), prepend=0)
        return keys, number, many


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One a worker; workers outlive tasks."""
    return Aligner(path_a, path_b)


_KIND = ("chunk string, doc_id {id}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, "
         "windows binary, sizes binary, links binary, pairs array<long>, counts array<long>")


class _Chunk:
    """What a task keeps of a chunk until it is written: its different windows by their ids, and their alignment."""

    def __init__(self, name: str):
        self.name, self.chars = name, 0
        self.number: dict[Window, int] = {}
        self.text = pa.array([], pa.string())
        self.groups, self.links, self.times = (np.zeros(0, np.int64) for _ in range(3))
        self.pairs: list[np.ndarray] = []

    def numbers(self, windows: list[Window], tool: Aligner) -> np.ndarray:
        """Numbers of the windows; those met for the first time are aligned."""
        known = self.number
        out = np.array([known.setdefault(w, len(known)) for w in windows], np.int64)
        new = [w for w, n in zip(windows, out.tolist()) if n >= len(self.groups)]
        if new:
            text, groups, links, pairs = tool.align(new)
            self.text = pa.concat_arrays([self.text, text])
            self.groups, self.links = np.append(self.groups, groups), np.append(self.links, links)
            self.times = np.append(self.times, np.zeros(len(new), np.int64))
            self.pairs.append(pairs)
        return out

    def row(self) -> dict:
        pairs, place = np.unique(np.concatenate(self.pairs), return_inverse=True)
        counts = np.zeros(len(pairs), np.int64)
        np.add.at(counts, place, np.repeat(self.times, self.links))
        return {"sizes": self.links.astype("<i4").tobytes(), "links": place.astype("<i4").tobytes(), "pairs": pairs, "counts": counts}


def _align(path_a: str, path_b: str, keep_groups: bool, chunk_chars: int, kind: pa.DataType):
    """Task of the first pass: texts -> a row a document and a row a chunk."""
    types = [pa.string(), kind, *[pa.int64()] * 4, pa.string(), pa.string(), *[pa.binary()] * 3, *[pa.list_(pa.int64())] * 2]
    names = ["chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups", "windows", "sizes", "links", "pairs", "counts"]

    def batch_of(n: int, **cols) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[c], t) if c in cols and not isinstance(cols[c], pa.Array) else cols[c] if c in cols else pa.nulls(n, t)
             for c, t in zip(names, types)], names=names)

    def documents(ids: pa.Array, texts: list, tool: Aligner, chunk: _Chunk) -> pa.RecordBatch:
        coded = tool.encode(texts)
        keys, number, many = tool.windows(coded)
        mine = chunk.numbers(keys, tool)[number] if keys else number
        chunk.times += np.bincount(mine, minlength=len(chunk.times))
        ends = np.cumsum(many)
        texts = join(chunk.text.take(pa.array(mine)), np.append(0, ends), ";").to_pylist()
        rows = []
        for n, end, (a, b), text in zip(many.tolist(), ends.tolist(), coded, texts):
            w = mine[end - n : end]
            g = int(chunk.groups[w].sum())
            rows.append((len(a), len(b), g, len(a) + len(b) - g, hashlib.sha256(text.encode()).hexdigest() if n else "",
                         text if keep_groups else None, w.astype("<i4").tobytes()))
        n_a, n_b, groups, links, sha, text, windows = zip(*rows)
        return batch_of(len(rows), chunk=[chunk.name] * len(rows), doc_id=ids, n_a=n_a, n_b=n_b, n_groups=groups, n_links=links,
                        groups_sha256=sha, groups=text, windows=windows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tool, part, n_chunks = aligner(path_a, path_b), TaskContext.get().partitionId(), 0
        chunk = _Chunk(f"{part}-0")
        for batch in batches:
            texts, at = batch.column(1).to_pylist(), 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size < min(GROUP, chunk_chars)):
                    size += len(texts[end] or "")
                    end += 1
                yield documents(batch.column(0).slice(at, end - at), texts[at:end], tool, chunk)
                at, chunk.chars = end, chunk.chars + size
                if chunk.chars >= chunk_chars:
                    yield batch_of(1, chunk=[chunk.name], **{k: [v] for k, v in chunk.row().items()})
                    n_chunks += 1
                    chunk = _Chunk(f"{part}-{n_chunks}")
        if chunk.number:
            yield batch_of(1, chunk=[chunk.name], **{k: [v] for k, v in chunk.row().items()})

    return run


def _sum_up(left: pa.Table, right: pa.Table) -> pa.Table:
    """Second pass, a chunk: its documents and its windows (left) with the corpus counts of its pairs (right)."""
    is_doc = left.column("is_doc")
    docs, chunk = left.filter(is_doc), left.filter(pc.invert(is_doc)).to_pylist()
    total, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
    place = right.column("place").to_numpy()
    total[place], best[place] = right.column("total").to_numpy(), right.column("is_best").to_numpy()
    sizes, links = (np.frombuffer(chunk[0][c], "<i4").astype(np.int64) if chunk else np.zeros(0, np.int64) for c in ("sizes", "links"))
    before = np.cumsum(sizes) - sizes
    sums = [np.add.reduceat(x[links], before) if len(links) else np.zeros(0, np.int64) for x in (total, best)]
    rows = [np.frombuffer(w, "<i4") for w in docs.column("windows").to_pylist()]
    out = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    for name, x in zip(("count_sum", "n_best"), sums):
        out = out.append_column(name, pa.array([int(x[w].sum()) for w in rows], pa.int64()))
    return out.append_column("groups_sha256", docs.column("groups_sha256")).append_column("groups", docs.column("groups"))


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
          keep_groups: bool = False, chunk_chars: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs): each text's alignment, and how often each pair of ids is linked in the corpus.

    ``documents``: doc_id, n_a, n_b, n_groups, n_links, count_sum, n_best,
    groups_sha256 and groups (``a1,a2|b1;a3|b2,b3``; null unless
    ``keep_groups``). ``pairs``: a, b, total, is_best (no pair of b has a higher
    total). A null or empty text, and one whose joined tokens are other bytes
    than the text behind a space, has zeros and ''. Every row is answered by
    itself and counts by itself, repeated ones too; any id, null too, is
    carried along and other columns are not read. A very long text is encoded
    whole, in one chunk, whatever its size. An empty table
    gives two empty results.
    """
    src = need(docs, id_col, text_col).toDF("doc_id", "text")
    kind = src.schema[0].dataType.simpleString()
    first = save(src.mapInArrow(_align(path_a, path_b, keep_groups, chunk_chars, to_arrow_type(src.schema[0].dataType)), _KIND.format(id=kind)), "align-windows")
    asked = first.filter("pairs is not null").select("chunk", F.posexplode(F.arrays_zip("pairs", "counts")).alias("place", "x")).select(
        "chunk", "place", F.col("x.pairs").alias("pair"), F.col("x.counts").alias("n"))
    pairs = asked.groupBy("pair").agg(F.sum("n").alias("total")).withColumn("b", F.expr("pair & 4294967295"))
    pairs = save(pairs, "align-pairs")
    high = pairs.groupBy("b").agg(F.max("total").alias("high"))
    pairs = pairs.join(high, "b").select("pair", F.shiftright("pair", 32).alias("a"), "b", "total", (F.col("total") == F.col("high")).alias("is_best"))
    answers = asked.join(pairs, "pair").select("chunk", "place", "total", F.col("is_best").cast("long").alias("is_best"))
    left = first.withColumn("is_doc", F.col("pairs").isNull()).drop("pairs", "counts").withColumn("of", F.col("chunk")).drop("chunk")
    out = left.groupBy("of").cogroup(answers.groupBy("chunk")).applyInArrow(
        _sum_up, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, count_sum long, n_best long, groups_sha256 string, groups string")
    return out, pairs.select("a", "b", "total", "is_best")
