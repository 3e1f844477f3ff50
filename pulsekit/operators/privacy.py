"""Consent filter, PII removal, pseudonymisation and audit counts.

Everything is a narrow projection plus one global aggregate for the audit
row; nothing is joined, so there is no shuffle besides the audit's tiny
final aggregation. Tokens are a salted SHA-256 prefix: deterministic within a
run (stable across task retries, unlike ``uuid()``) and unlinkable across
runs when the salt changes.
"""

from __future__ import annotations

import secrets

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsekit.functions import secret
from pulsekit.schema import PII_COLUMNS

CONSENT_COL = "consent_for_ml_training"
#: Hex digits of a pseudonymous id.
TOKEN_LEN = 32
AUDIT_SCHEMA = ("action string, records_total long, records_consented_processed long, patients_count long, "
                "dataset string, purpose string")


class ConsentError(ValueError):
    """Raised when consent is missing or nobody consented."""


def new_salt() -> str:
    """A fresh random salt per run."""
    return secrets.token_hex(16)


def consent_filter(df: DataFrame, consent_col: str = CONSENT_COL) -> DataFrame:
    """Keep rows with consent = true; NULL consent counts as no consent."""
    if consent_col not in df.columns:
        raise ConsentError(f"Dataset lacks the '{consent_col}' consent flag.")
    dtype = df.schema[consent_col].dataType
    if not isinstance(dtype, T.BooleanType):
        raise TypeError(f"'{consent_col}' must be boolean, found {dtype.simpleString()}")
    return df.filter(F.col(consent_col))


def drop_pii(df: DataFrame, pii_columns: list[str] | None = None) -> DataFrame:
    """Drop whichever personal-data columns exist."""
    cols = [c for c in (pii_columns or PII_COLUMNS) if c in df.columns]
    return df.drop(*cols)


def pseudonymize(
    df: DataFrame, salt: str, id_col: str = "patient_id", token_len: int = TOKEN_LEN, prefix: str = "anon-"
) -> DataFrame:
    """Id -> prefix + first ``token_len`` hex chars of sha256(salt || id).

    NULL ids stay NULL so a later null-id check still fires. The default of 128 bits
    keeps patients apart at any size; ``token_len=12`` gives the short tokens of older
    tables, of which two may be equal from about 2^24 ids on.
    """
    if id_col not in df.columns:
        return df
    ident = F.col(id_col).cast("string")
    token = F.concat(F.lit(prefix), F.substring(F.sha2(F.concat(secret(salt), ident), 256), 1, token_len))
    return df.withColumn(id_col, F.when(ident.isNull(), F.lit(None).cast("string")).otherwise(token))


def audit_counts(
    df: DataFrame,
    consent_col: str = CONSENT_COL,
    id_col: str = "patient_id",
    dataset: str = "health_measurements",
    purpose: str = "model_training",
) -> DataFrame:
    """One-row audit event computed in a single aggregate over the raw rows."""
    consent = F.coalesce(F.col(consent_col), F.lit(False))
    patients = (
        F.count_distinct(F.when(consent, F.col(id_col))) if id_col in df.columns else F.lit(0).cast("bigint")
    )
    return df.agg(
        F.count(F.lit(1)).alias("records_total"),
        F.count_if(consent).alias("records_consented_processed"),
        patients.alias("patients_count"),
    ).select(
        F.lit("ml_dataset_read").alias("action"),
        "records_total",
        "records_consented_processed",
        "patients_count",
        F.lit(dataset).alias("dataset"),
        F.lit(purpose).alias("purpose"),
    )


def patient_count(df: DataFrame, id_col: str = "patient_id") -> int:
    """Different ids that are not NULL; 0 without the column."""
    return df.agg(F.count_distinct(F.col(id_col))).first()[0] if id_col in df.columns else 0


def audit_event(
    spark: SparkSession,
    total: int,
    consented: int,
    patients: int,
    dataset: str = "health_measurements",
    purpose: str = "model_training",
) -> DataFrame:
    """The row of :func:`audit_counts` from counts taken elsewhere."""
    return spark.createDataFrame([("ml_dataset_read", total, consented, patients, dataset, purpose)], AUDIT_SCHEMA)


def anonymize(
    df: DataFrame,
    salt: str | None = None,
    dataset: str = "health_measurements",
    audit_sink: str | None = None,
    token_len: int = TOKEN_LEN,
) -> tuple[DataFrame, dict]:
    """P1-P4 as one step: returns the anonymised (lazy) frame and the audit row.

    The audit aggregate is the only action; it doubles as the zero-consent
    check. When ``audit_sink`` is given the audit row is appended there.
    """
    consented = consent_filter(df)
    audit = audit_counts(df, dataset=dataset)
    row = audit.first().asDict()
    if row["records_consented_processed"] == 0:
        raise ConsentError("Zero records with active consent for ML training.")
    if audit_sink:
        audit.withColumn("logged_at", F.current_timestamp()).write.mode("append").parquet(audit_sink)
    out = pseudonymize(drop_pii(consented), salt or new_salt(), token_len=token_len)
    return out, row
