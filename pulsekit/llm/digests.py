"""Byte-pair encoding and decoding over a table: ids, texts and their digests (operator 9)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.bpe import BpeEncoder
from pulsekit.llm.common import need
from pulsekit.llm.tokens import encoder


def encode_texts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): ids of each whole text (null: empty) as the tokenizer's library gives them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, BpeEncoder)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                ids = [np.frombuffer(x, "<i4") for x in enc.encode(part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    src = need(docs, id_col, text_col).toDF("doc_id", "text")
    return src.mapInArrow(run, f"doc_id {src.schema[0].dataType.simpleString()}, ids array<int>")


def decode_ids(encoded: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text): the decoded text of each row's ids (null: empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(tokenizer, BpeEncoder).bpe
        for batch in batches:
            texts = [bpe.decode(np.array(x or [], np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    src = need(encoded, id_col, ids_col).toDF("doc_id", "ids")
    return src.mapInArrow(run, f"doc_id {src.schema[0].dataType.simpleString()}, text string")


def bpe_digests(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode each whole text, decode its ids, and digest both.

    Null and empty texts have no ids and the digests of nothing. Repeated rows
    are answered each by itself; any id, null too, is carried along.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, BpeEncoder)
        decimal = [b"%d" % i for i in range(len(enc.bpe.size))]
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                rows = []
                for x in enc.encode(part.column(1).to_pylist()):
                    ids = np.frombuffer(x, "<u4").astype(np.int64)
                    rows.append((len(ids), sha(b" ".join(map(decimal.__getitem__, ids.tolist()))), sha(enc.bpe.decode(ids).encode("utf-8"))))
                n, i, d = zip(*rows)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(i), pa.array(d)],
                                                 names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    src = need(docs, id_col, text_col).select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = src.schema[0].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
