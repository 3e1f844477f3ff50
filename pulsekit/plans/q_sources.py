"""Registered queries: dataset fingerprint, encryption round trip, file manifests."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsekit.plans.catalog import register
from pulsekit.plans.oracles import R
from pulsekit.sources import io
from pulsekit.sources.adapter import read_table

# Fixed passphrase for the round-trip check only (never a production key).
QUERY_PASSPHRASE = "pulsekit-roundtrip-check"


_EVENT_TEXTS = ("CAST(event_id AS VARCHAR)", "CAST(user_id AS VARCHAR)", "event_type", "CAST(epoch_us(ts) AS VARCHAR)",
                "printf('%.6f', value)", "props")
_LANES = " || '-' || ".join(
    f"coalesce(CAST(sum(CAST(('0x' || substr(h, {at}, 15)) AS BIGINT)) AS VARCHAR), '')" for at in range(1, 65, 15))


@register(
    "dataset_fingerprint",
    "SELECT count(*) AS n_rows, " + _LANES + " AS fingerprint FROM (SELECT sha256("
    + " || ".join(f"coalesce(CAST(length({x}) AS VARCHAR) || ':' || {x}, '-')" for x in _EVENT_TEXTS) + ") AS h FROM events)",
)
def q_fingerprint(spark, sf_dir):
    """All columns of ``events``; time and value in a text form that other engines write alike."""
    ev = read_table(spark, sf_dir, "events")
    return io.dataset_fingerprint(ev, [
        "event_id", "user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")),
        F.format_string("%.6f", "value"), "props"])


@register("encrypt_roundtrip", "SELECT event_id, props, length(props) + 28 AS cipher_bytes FROM events")
def q_encrypt_roundtrip(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    enc = ev.select("event_id", io.encrypt_column("props", QUERY_PASSPHRASE).alias("cipher"))
    return enc.select(
        "event_id",
        io.decrypt_column("cipher", QUERY_PASSPHRASE).alias("props"),
        F.length("cipher").cast("bigint").alias("cipher_bytes"),
    )


# S9 / S10 over a given table: each document is an artifact. The file form stays a helper.
_MANIFEST_SQL = (
    "m AS (SELECT CAST(doc_id AS VARCHAR) AS file, CASE WHEN text IS NOT NULL THEN sha256(text) END AS sha256, "
    "CAST(coalesce(octet_length(encode(text)), 0) AS BIGINT) AS size_bytes FROM documents), "
    f"k AS (SELECT *, {R('size_bytes / 1024.0', 2)} AS size_kb, {R('size_bytes / 1048576.0', 3)} AS size_mb FROM m)"
)
DOC_BUDGET_KB = 4.0


@register("file_manifest", f"WITH {_MANIFEST_SQL} SELECT file, sha256, size_bytes, size_kb, size_mb FROM k")
def q_file_manifest(spark, sf_dir):
    return io.artifact_manifest(read_table(spark, sf_dir, "documents"), "doc_id", "text")


@register(
    "manifest_audit",
    f"WITH {_MANIFEST_SQL}, d AS (SELECT sha256, count(*) AS n FROM k WHERE sha256 IS NOT NULL GROUP BY sha256) "
    f"SELECT k.file, k.sha256, k.size_kb, k.size_kb <= {DOC_BUDGET_KB} AS is_within_budget, "
    "CAST(coalesce(d.n, 0) AS BIGINT) AS copies, coalesce(d.n, 0) > 1 AS duplicate_checksum "
    "FROM k LEFT JOIN d ON k.sha256 = d.sha256",
)
def q_manifest_audit(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return io.manifest_audit(io.artifact_manifest(docs, "doc_id", "text"), DOC_BUDGET_KB)
