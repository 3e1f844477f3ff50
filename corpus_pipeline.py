"""From raw documents to packed sequences: toxicity, line dedup, near-duplicates, packing.

Each stage takes what its predecessor kept, as a table written and read again.
The near-duplicate stage judges rows, not ids: rows with one id and unlike texts
all stay, and rows with a null id are compared like any other. Null texts count
as empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.llm import lines, minhash, packing, queries, toxicity
from pulsekit.llm.common import free_name, save


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose noisy-or score is below one half stay (operator 6)."""
    model = queries.toxicity_model(docs, queries.table(spark, sf_dir, "labels"))
    score, spans = free_name(docs, "__toxic_score"), free_name(docs, "__toxic_sentences")
    scored = toxicity.score(docs, model, score_col=score, spans_col=spans)
    return scored.filter(F.col(score) < 0.5).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go from every document of their site (operator 2); n_chars follows the text."""
    out = lines.drop_boilerplate(docs, counts=None)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(
            F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of each group of near-duplicates stays: by id (null last), then by a digest of the text.

    Rows are numbered in that order, and operator 1 sees the number as the id.
    Texts without words (null, empty, white space) form no group: all rows with them stay.
    """
    order = [F.col("doc_id").asc_nulls_last(), F.md5(F.col("text")), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])]
    row = free_name(docs, "__row")
    rows = docs.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(row, F.monotonically_increasing_id())
    rows = save(rows, "pipeline-rows")
    kept = minhash.near_duplicates(rows, id_col=row).filter("kept").select("doc_id")
    return rows.join(kept, rows[row] == kept["doc_id"], "left_semi").drop(row)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents with their place in a sequence (operator 10)."""
    return packing.pack(packing.cut_documents(docs, public_tokenizers.path(queries.WORD_BPE), queries.PIECE_END))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("minhash", drop_near_duplicates),
    ("packing", pack_sequences),
]

#: No SQL expresses trained scores, signatures or bin completion.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
