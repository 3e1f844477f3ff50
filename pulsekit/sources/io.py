"""Measurement scans and sinks.

Scans are lazy and schema-first: with an explicit schema nothing is
inferred, Catalyst prunes columns and pushes filters into the parquet reader.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsekit.functions import round_half_up, secret
from pulsekit.schema import MEASUREMENT_SCHEMA


def normalize_nans(df: DataFrame) -> DataFrame:
    """NaN -> NULL in every floating column (Spark keeps them apart, pandas does not)."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not floats:
        return df
    return df.withColumns({c: F.when(F.isnan(c), F.lit(None).cast(df.schema[c].dataType)).otherwise(F.col(c))
                           for c in floats})


def read_measurements(
    spark: SparkSession,
    source: str | DataFrame,
    schema: T.StructType | None = None,
    fmt: str | None = None,
) -> DataFrame:
    """Parquet / CSV path or an in-memory DataFrame; other formats raise.

    ``schema`` defaults to the canonical measurement schema for CSV (no
    inference on large inputs); parquet keeps its own schema unless given.
    """
    if isinstance(source, DataFrame):
        return normalize_nans(source)
    path = source.rstrip("/")
    kind = fmt or ("parquet" if path.endswith(".parquet") else "csv" if path.endswith(".csv") else None)
    if kind == "parquet":
        reader = spark.read.schema(schema) if schema is not None else spark.read
        df = reader.parquet(source)
    elif kind == "csv":
        df = _read_csv(spark, source, schema or MEASUREMENT_SCHEMA)
    else:
        raise ValueError(f"cannot read {source!r}: only parquet and CSV sources are known")
    return normalize_nans(df)


def _read_csv(spark: SparkSession, source: str, schema: T.StructType) -> DataFrame:
    """Columns by their names in the header, in any order; those the file lacks are NULL, others are ignored."""
    raw = spark.read.option("header", True).option("mode", "FAILFAST").csv(source)  # strings: no inference pass
    known = set(raw.columns)
    return raw.select(*[
        (F.col(f"`{f.name}`") if f.name in known else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def write_measurements(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Parquet sink (optionally partitioned, e.g. by date, for partition pruning)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """JSON-lines sink for reports (drift per feature, evaluation reports)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)


def to_json_document(df: DataFrame, name: str = "report") -> DataFrame:
    """One JSON string per row (``to_json(struct(*))``)."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(name))


# ---------------------------------------------------------------------------
# File integrity manifest
# ---------------------------------------------------------------------------

def file_manifest(spark: SparkSession, path_glob: str, expected: list[str] | None = None) -> DataFrame:
    """(file, sha256, size_bytes, size_kb 2 dp, size_mb 3 dp) per file.

    ``binaryFile`` reads each file as one row in its own task; it cannot read
    files over 2 GB (a JVM array limit), which covers model artifacts and
    ordinary parquet parts. Expected files that are absent get zero sizes
    and a NULL checksum.
    """
    files = spark.read.format("binaryFile").load(path_glob).select(
        F.element_at(F.split("path", "/"), -1).alias("file"),
        F.sha2("content", 256).alias("sha256"),
        F.col("length").alias("size_bytes"),
    )
    if expected:
        exp = spark.createDataFrame([(e,) for e in expected], "file string")
        files = exp.join(files, "file", "left").select(
            "file", "sha256", F.coalesce("size_bytes", F.lit(0)).cast("bigint").alias("size_bytes")
        )
    return files.select(
        "file",
        "sha256",
        "size_bytes",
        round_half_up(F.col("size_bytes") / 1024.0, 2).alias("size_kb"),
        round_half_up(F.col("size_bytes") / (1024.0 * 1024.0), 3).alias("size_mb"),
    )


def artifact_manifest(df: DataFrame, name_col: str, content_col: str) -> DataFrame:
    """S9 over a table of artifacts, one per row: same columns as :func:`file_manifest`.

    Narrow, so it scales with the table; a NULL content has size 0 and no checksum.
    """
    content = F.col(content_col).cast("binary")
    size = F.coalesce(F.octet_length(content), F.lit(0)).cast("bigint")
    return df.select(
        F.col(name_col).cast("string").alias("file"),
        F.sha2(content, 256).alias("sha256"),
        size.alias("size_bytes"),
        round_half_up(size / 1024.0, 2).alias("size_kb"),
        round_half_up(size / (1024.0 * 1024.0), 3).alias("size_mb"),
    )


def manifest_audit(manifest: DataFrame, budget_kb: float = 2048.0) -> DataFrame:
    """Per file: within budget (inclusive) and how many files share its checksum."""
    dup = manifest.where(F.col("sha256").isNotNull()).groupBy("sha256").agg(F.count(F.lit(1)).alias("copies"))
    return manifest.join(dup, "sha256", "left").select(
        "file",
        "sha256",
        "size_kb",
        (F.col("size_kb") <= budget_kb).alias("is_within_budget"),
        F.coalesce("copies", F.lit(0)).alias("copies"),
        (F.coalesce("copies", F.lit(0)) > 1).alias("duplicate_checksum"),
    )


# ---------------------------------------------------------------------------
# Order-insensitive dataset fingerprint
# ---------------------------------------------------------------------------

def row_digest(cols: list[str | Column]) -> Column:
    """SHA-256 of one row: every value as text behind its length, so that no two rows read alike."""
    parts = []
    for c in cols:
        text = (F.col(f"`{c}`") if isinstance(c, str) else c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _fingerprint_columns(df: DataFrame) -> list[str | Column]:
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    return [F.to_json(f"`{f.name}`") if isinstance(f.dataType, nested) else f.name for f in df.schema.fields]


def _lanes(digest: str) -> list[Column]:
    return [F.sum(F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(38,0)")).cast("string") for at in range(1, 65, 15)]


def dataset_fingerprint(df: DataFrame, cols: list[str | Column] | None = None) -> DataFrame:
    """(n_rows, fingerprint): the rows' SHA-256 digests, summed in lanes of 60 bits, exact in decimal(38,0).

    All 256 bits and, by default, all columns count (those without a text form as JSON).
    A sum is independent of row order and partitioning, hence stable under retries.
    """
    digests = df.select(row_digest(_fingerprint_columns(df) if cols is None else cols).alias("h"))
    return digests.agg(F.count(F.lit(1)).alias("n_rows"), digests_fingerprint("h").alias("fingerprint"))


def with_row_digest(df: DataFrame, out: str) -> DataFrame:
    """Each row's SHA-256 over all columns, for a later :func:`digests_fingerprint`."""
    return df.withColumn(out, row_digest(_fingerprint_columns(df)))


def digests_fingerprint(digest: str) -> Column:
    """S11 as an aggregate over a column of :func:`with_row_digest`: that of :func:`dataset_fingerprint`."""
    return F.concat_ws("-", *_lanes(digest))


# ---------------------------------------------------------------------------
# Encryption at rest (AES-GCM, key = SHA-256 of a passphrase)
# ---------------------------------------------------------------------------

def _key(passphrase: str | None) -> Column:
    if not passphrase:
        raise ValueError("An encryption key is required; refusing to write plaintext.")
    return secret(hashlib.sha256(passphrase.encode()).digest())


def encrypt_column(c: str | Column, passphrase: str) -> Column:
    """AES-256-GCM; output = 12-byte nonce || ciphertext || 16-byte tag.

    The key stands in no plan (``functions.secret``).
    """
    col = F.col(c) if isinstance(c, str) else c
    return F.aes_encrypt(col.cast("binary"), _key(passphrase), F.lit("GCM"))


def decrypt_column(c: str | Column, passphrase: str, as_string: bool = True) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    out = F.aes_decrypt(col, _key(passphrase), F.lit("GCM"))
    return out.cast("string") if as_string else out
