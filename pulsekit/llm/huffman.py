"""Token ids of a corpus in Huffman-coded archive files (operator 5).

1. Documents are range-partitioned and sorted by id; each task encodes whole
   texts and spools the ids (compressed Arrow stream) to the shared folder,
   with the number of times each id occurs.
2. The counts of all ids (one number per vocabulary entry, whatever the
   corpus) give one canonical Huffman code whose lengths are limited by
   package-merge.
3. Each spool becomes one archive file; reading needs nothing but the files.

File: ``HUFIDS01``, then blocks, then a footer (JSON, compressed), its length
(8 bytes) and ``HUFIDS01`` again. A block holds up to ``BLOCK`` ids as a bit
string of its own, starting at a byte; the footer lists each block's place,
its number of ids and, for every ``STEP`` ids, the bit offset at which the
next id begins. A reader looks the next ``limit`` bits up in a table (id and
code length); all checkpoints of a group of blocks are decoded side by side,
so one table look-up step serves thousands of places.

A task that is run again writes another file; only the files named in the
manifest, which Spark writes when the tasks have ended, are ever read.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.llm.common import filesystem, need, save, shared_folder

MAGIC = b"HUFIDS01"
BLOCK, STEP, GROUP = 1 << 16, 1 << 10, 64  # ids a block, ids a checkpoint, blocks decoded together
SUMS = 8  # tasks that add the counts up
LIMIT = 16  # longest code, unless there are more than 2**16 ids


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Optimal code lengths (0: id does not occur) of at most ``limit`` bits, by package-merge.

    Ties go to the smaller id. A single id gets one bit.
    """
    if limit > 24:
        raise ValueError("codes of more than 24 bits are not supported")
    ids = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(ids) <= 1:
        out[ids] = 1
        return out
    if len(ids) > 1 << limit:
        raise ValueError(f"{len(ids)} ids do not fit codes of {limit} bits")
    ids = ids[np.argsort(counts[ids], kind="stable")]
    leaf = counts[ids].astype(np.int64)
    levels, row = [], leaf
    for _ in range(limit - 1):
        levels.append(np.zeros(len(row), bool) if row is leaf else is_pair)
        pairs = row[: len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaf, pairs])
        order = np.argsort(both, kind="stable")
        row, is_pair = both[order], order >= len(leaf)
    levels.append(np.zeros(len(row), bool) if row is leaf else is_pair)
    take, length = 2 * len(ids) - 2, np.zeros(len(ids), np.uint8)
    for pair in reversed(levels):  # of the first `take` items, leaves lengthen a code, pairs unfold below
        chosen = pair[:take]
        length[: take - int(chosen.sum())] += 1
        take = 2 * int(chosen.sum())
    out[ids] = length
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id): the lengths alone define them."""
    codes = np.zeros(len(lengths), np.uint64)
    code, last = 0, 0
    order = np.lexsort((np.arange(len(lengths)), lengths))
    for length in range(1, int(lengths.max(initial=0)) + 1):
        ids = order[lengths[order] == length]
        code <<= length - last
        codes[ids] = code + np.arange(len(ids), dtype=np.uint64)
        code, last = code + len(ids), length
    return codes


def encode_block(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, list[int]]:
    """Bit string of the ids and the bit offset of every STEP-th of them."""
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    at = ends - size
    word, room = at >> 5, np.uint64(64) - (at & 31).astype(np.uint64)
    bits = codes[ids] << (room - size.astype(np.uint64))  # at most 31 + 32 bits from a word's start
    words = np.zeros(int(ends[-1] >> 5) + 2, np.uint64)
    first = np.flatnonzero(np.diff(word, prepend=-1))
    words[word[first]] += np.add.reduceat(bits >> np.uint64(32), first)
    words[word[first] + 1] += np.add.reduceat(bits & np.uint64(0xFFFFFFFF), first)
    return words.astype(">u4").tobytes()[: (int(ends[-1]) + 7) // 8], at[::STEP].tolist()


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """For every string of ``limit`` bits the id (times 32) and the length of the code it begins with."""
    limit = max(int(lengths.max(initial=1)), 1)
    ids = np.flatnonzero(lengths)
    ids = ids[np.lexsort((ids, lengths[ids]))]
    span = 1 << (limit - lengths[ids].astype(np.int64))
    fill = (1 << limit) - int(span.sum())  # only a lone id leaves strings unused
    entry = np.append(ids * 32 + lengths[ids], 1)
    return np.repeat(entry, np.append(span, fill)).astype(np.uint32), limit


def decode_blocks(data: bytes, starts: list[int], counts: np.ndarray, table: tuple[np.ndarray, int]) -> np.ndarray:
    """Ids from the given bit offsets in ``data``; ``counts[i]`` ids (STEP at most) follow offset i.

    All offsets are followed side by side; what is read beyond a count is cut off.
    """
    entry, limit = table
    raw = np.frombuffer(data + b"\0" * (STEP * limit // 8 + 8), np.uint8).astype(np.uint32)
    word = raw[:-3] << np.uint32(24) | raw[1:-2] << np.uint32(16) | raw[2:-1] << np.uint32(8) | raw[3:]  # 32 bits from every byte on
    at = np.array(starts, np.int64)
    steps = int(counts.max(initial=0))
    out = np.zeros((steps, len(at)), np.uint32)
    mask = np.uint32((1 << limit) - 1)
    room = 32 - limit  # a code begins at one of 8 bits: limit + 7 bits are enough
    for j in range(steps):
        look = word[at >> 3] >> (room - (at & 7)).astype(np.uint32) & mask
        out[j] = entry[look]
        at += out[j] & np.uint32(31)
    return (out.T >> np.uint32(5))[np.arange(steps) < counts[:, None]]


def _spool(path: str, end_id: int, folder: str, ids_type: str):
    """Task of step 1: sorted documents -> one spool file and its manifest row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pulsekit.llm.tokens import encoder

        enc, tail = encoder(path), np.array([end_id], "<u4").tobytes()
        fs, base = filesystem(folder)
        name, out, sink, n_docs, counts = f"{folder}/spool-{uuid.uuid4().hex}", None, None, 0, np.zeros(0, np.int64)
        schema, first = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())]), None
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                if out is None:
                    fs.create_dir(base)
                    sink = fs.open_output_stream(filesystem(name)[1])
                    out = pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression="lz4"))
                    first = part.column(2)[0].as_py()
                rows = [np.frombuffer(x + tail, "<u4") for x in enc.encode(part.column(1).to_pylist())]
                got = np.bincount(np.concatenate(rows), minlength=len(counts))
                got[: len(counts)] += counts
                counts, n_docs = got, n_docs + len(rows)
                out.write_batch(pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([x.astype(ids_type).tobytes() for x in rows], pa.binary())], schema=schema))
        if out is not None:
            out.close()
            sink.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([first], pa.int32()), pa.array([name]), pa.array([n_docs], pa.int64()), pa.array([int(counts.sum())], pa.int64()),
                 pa.array([zlib.compress(counts.astype("<i8").tobytes(), 1)], pa.binary())],
                names=["part", "spool", "n_docs", "n_tokens", "counts"])

    return run


def _sum_counts(top: int):
    """Partial sums of the spools' counts, one row a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(top + 1, np.int64)
        for batch in batches:
            for x in batch.column(0).to_pylist():
                got = np.frombuffer(zlib.decompress(x), "<i8")
                total[: len(got)] += got
        yield pa.RecordBatch.from_arrays([pa.array([total.astype("<i8").tobytes()], pa.binary())], names=["counts"])

    return run


def _archive(lengths: bytes, folder: str, ids_type: str):
    """Task of step 3: one spool -> one archive file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = np.frombuffer(lengths, np.uint8)
        codes = canonical_codes(size)
        for batch in batches:
            for row in batch.to_pylist():
                name = f"{folder}/part-{row['part']:06d}-{uuid.uuid4().hex}.huf"
                fs, at = filesystem(name)
                fs.create_dir(filesystem(folder)[1])
                docs, tokens, blocks, place, rest = [], [], [], len(MAGIC), np.zeros(0, ids_type)
                with fs.open_output_stream(at) as out, filesystem(row["spool"])[0].open_input_stream(filesystem(row["spool"])[1]) as src:
                    out.write(MAGIC)
                    stream = iter(pa.ipc.open_stream(src))
                    while True:
                        part = next(stream, None)
                        if part is not None:
                            docs += part.column(0).to_pylist()
                            ids = [np.frombuffer(x, ids_type) for x in part.column(1).to_pylist()]
                            tokens += map(len, ids)
                            rest = np.concatenate([rest, *ids])
                        end = len(rest) if part is None else len(rest) // BLOCK * BLOCK
                        for k in range(0, end, BLOCK):
                            ids = rest[k : k + BLOCK].astype(np.int64)
                            data, marks = encode_block(ids, codes, size)
                            out.write(data)
                            blocks.append([place, len(data), len(ids), marks])
                            place += len(data)
                        rest = rest[end:]
                        if part is None:
                            break
                    foot = {"start": row["start"], "lengths": zlib.compress(lengths).hex(), "docs": docs, "tokens": tokens, "blocks": blocks}
                    foot = zlib.compress(json.dumps(foot).encode(), 3)
                    out.write(foot + len(foot).to_bytes(8, "little") + MAGIC)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]], pa.int32()), pa.array([name]), pa.array([row["start"]], pa.int64()),
                     pa.array([len(docs)], pa.int64()), pa.array([sum(tokens)], pa.int64()), pa.array([place], pa.int64())],
                    names=["part", "path", "start", "n_docs", "n_tokens", "n_bytes"])

    return run


def read_file(uri: str) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, start, ids) of every document of an archive file, in order; a group of blocks at a time."""
    fs, path = filesystem(uri)
    with fs.open_input_file(path) as f:
        total = f.size()
        f.seek(total - 16)
        n, magic = int.from_bytes(f.read(8), "little"), f.read(8)
        if magic != MAGIC:
            raise ValueError(f"{uri} is no archive of this format")
        f.seek(total - 16 - n)
        foot = json.loads(zlib.decompress(f.read(n)))
        table = decode_table(np.frombuffer(zlib.decompress(bytes.fromhex(foot["lengths"])), np.uint8))
        have, at, start = np.zeros(0, np.uint32), 0, foot["start"]
        docs = zip(foot["docs"], foot["tokens"], strict=True)
        doc = next(docs, None)
        for k in range(0, len(foot["blocks"]), GROUP):
            group = foot["blocks"][k : k + GROUP]
            f.seek(group[0][0])
            data = f.read(group[-1][0] + group[-1][1] - group[0][0])
            marks = [8 * (b[0] - group[0][0]) + m for b in group for m in b[3]]
            counts = np.array([min(STEP, b[2] - i * STEP) for b in group for i in range(len(b[3]))])
            have, at = np.concatenate([have[at:], decode_blocks(data, marks, counts, table)]), 0
            while doc is not None and at + doc[1] <= len(have):
                yield doc[0], start, have[at : at + doc[1]]
                at, start, doc = at + doc[1], start + doc[1], next(docs, None)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def packed(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([len(r[2]) for r in rows], pa.int64()), pa.array([r[2].astype("<u4").tobytes() for r in rows], pa.binary())],
            names=["doc_id", "start", "n_tokens", "ids"])

    for batch in batches:
        for uri in batch.column("path").to_pylist():
            rows, n = [], 0
            for r in read_file(uri):
                rows.append(r)
                n += len(r[2])
                if n > 1_000_000 or len(rows) >= 2000:
                    yield packed(rows)
                    rows, n = [], 0
            if rows:
                yield packed(rows)


def write_archive(
    docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT
) -> DataFrame:
    """Write the documents' ids in ascending id order; returns the manifest, one row per file.

    Manifest: part, path, start (ids in all files before), n_docs, n_tokens,
    n_bytes. Null texts are empty texts; null ids come first; rows with equal
    ids are ordered by text and stay separate documents. An empty table gives
    no files.
    """
    spark = docs.sparkSession
    src = need(docs, id_col, text_col).toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    ranged = src.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id")
    ranged = ranged.sortWithinPartitions("doc_id", "text").withColumn("part", F.spark_partition_id())
    from tokenizers import Tokenizer

    top = max(end_id, Tokenizer.from_file(tokenizer).get_vocab_size() - 1)
    ids_type = "<u2" if top < 1 << 16 else "<u4"
    folder = shared_folder(spark, "ids")
    spools = save(ranged.mapInArrow(
        _spool(tokenizer, end_id, f"{folder}/spool", ids_type),
        "part int, spool string, n_docs long, n_tokens long, counts binary"), "ids-spools")
    # one number per vocabulary entry from each of a fixed number of tasks
    sums = spools.select("counts").repartition(SUMS).mapInArrow(_sum_counts(top), "counts binary").collect()
    count = np.zeros(top + 1, np.int64)
    for r in sums:
        count += np.frombuffer(r[0], "<i8")
    lengths = code_lengths(count, max(limit, int(np.ceil(np.log2(max(2, np.count_nonzero(count)))))))
    rows, start = [], 0
    for r in spools.select("part", "spool", "n_tokens").orderBy("part").collect():  # one row per file
        rows.append((r["part"], r["spool"], start))
        start += r["n_tokens"]
    todo = spark.createDataFrame(rows, "part int, spool string, start long").repartition(max(1, len(rows)))
    manifest = save(todo.mapInArrow(
        _archive(lengths.tobytes(), folder, ids_type),
        "part int, path string, start long, n_docs long, n_tokens long, n_bytes long"), "ids-manifest")
    spool = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/spool")
    spool.getFileSystem(spark._jsc.hadoopConfiguration()).delete(spool, True)
    return manifest


def read_archive(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the files of a manifest; ids are little-endian unsigned 32-bit."""
    files = manifest.select("path")
    return files.repartition(max(1, manifest.count())).mapInArrow(_read, "doc_id long, start long, n_tokens long, ids binary")
