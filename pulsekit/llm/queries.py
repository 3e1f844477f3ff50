"""The registered queries of the corpus operators: thin, each over its whole table."""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.llm import align, graph_ann, html_text, huffman, itq, langid, lines, minhash, packing, runs, toxicity, warc
from pulsekit.llm.digests import bpe_digests
from pulsekit.llm.vectors import usable

WORD_BPE, BYTE_BPE, PIECES = "word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"
PIECE_END, FILE_END = 1, 2  # ids appended to a document


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).drop("source")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.read_archive(spark, warc.write_archive(table(spark, sf_dir, "pages")))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_graph_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    queries = vectors.filter((F.col("vec_id") % 50 == 0) & usable("embedding")).select(
        F.col("vec_id").cast("long").alias("query_id"), F.col("embedding").cast("array<double>").alias("vec"))
    return graph_ann.search(graph_ann.build_index(vectors), queries, k=5)


def op5_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = huffman.write_archive(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), FILE_END)
    return huffman.read_archive(spark, manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def toxicity_model(docs: DataFrame, labels: DataFrame) -> dict:
    """Trained on labels of rows that are not held out."""
    return toxicity.fit(docs, labels.filter(~held_out()))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity_model(docs, table(spark, sf_dir, "labels")), keep=["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    text = html_text.extract_text(pages, html_text.learn_weights(pages), keep=["page_id", "url"])
    joined = F.array_join("blocks", "\n\n")
    return text.select("page_id", "url", joined.alias("text"), F.length(joined).cast("long").alias("n_chars"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.cut_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), PIECE_END))


def periodic(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Of one document in ten, by its id's checksum, the words from a place on repeat with a period."""
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or doc_id is None:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[: a + p] + [words[a + (i - a) % p] for i in range(a + p, n)]


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(runs.find_runs(table(spark, sf_dir, "documents"), reword=periodic))


def not_learned() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op12_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.fit(docs.filter(~not_learned())))
    return found.select("doc_id", not_learned().alias("held_out"), F.col("lang").alias("lang_pred"), "score", "accepted")


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return align.align(docs, public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECES))[0].drop("groups")


QUERIES = {f.__name__: f for f in (
    op1_minhash, op2_line_dedup, op3_warc, op4_graph_ann, op5_huffman_ids, op6_toxicity, op7_itq, op8_html_text, op9_bpe, op10_packing,
    op11_runs, op12_langid, op13_align)}
ORACLES = {"op2_line_dedup": lines.ORACLE_SQL, "op3_warc": warc.ORACLE_SQL}
