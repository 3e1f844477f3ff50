"""Structured Streaming forms of the row-local operators.

Stateless operators -- adapter, consent filter, PII drop, pseudonymisation,
quarantine, feature projections, scaler transform with fitted literals,
isolation-forest / autoencoder scoring -- are the same DataFrame code applied
to a streaming DataFrame. The only stateful one is the bucket mean of the
resampler, expressed as a watermarked tumbling-window aggregate, so state is
bounded by the watermark instead of growing with the stream. Interpolation
needs future values and stays a batch operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pulsekit.operators import privacy, quality
from pulsekit.session import checkpoint_dir


def read_stream(spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int = 100) -> DataFrame:
    """Parquet files arriving in ``path`` as a stream (schema is required for streams)."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)


def anonymize_stream(df: DataFrame, salt: str, token_len: int = privacy.TOKEN_LEN) -> DataFrame:
    """P1-P3 per micro-batch; the salt must be fixed for the life of the query; with a batch's salt the tokens are the batch's."""
    return privacy.pseudonymize(privacy.drop_pii(privacy.consent_filter(df)), salt, token_len=token_len)


def quarantine_stream(df: DataFrame) -> DataFrame:
    """A7 per row: ``reasons`` and ``is_valid`` columns (route with two sinks or foreachBatch)."""
    return quality.quarantine(df)


def bucket_means_stream(
    df: DataFrame,
    columns: list[str],
    freq: str = "15 minutes",
    watermark: str = "1 hour",
    keys: list[str] | None = None,
    time_col: str = "timestamp",
) -> DataFrame:
    """W3 bucket mean as a watermarked tumbling window per key.

    Spark windows start at the epoch, which equals the batch resampler's
    midnight anchor whenever the step divides a day (1 min, 15 min, 1 h ...).
    """
    keys = ["patient_id"] if keys is None else keys
    ts = F.col(time_col).cast("timestamp")
    staged = df.withColumn("__ts", ts).withWatermark("__ts", watermark)
    out = staged.groupBy(*keys, F.window("__ts", freq).alias("w")).agg(
        *[F.avg(F.col(c).cast("double")).alias(c) for c in columns], F.count(F.lit(1)).alias("n_rows")
    )
    return out.select(*keys, F.col("w.start").cast("timestamp_ntz").alias(time_col), *columns, "n_rows")


def start(
    df: DataFrame,
    name: str,
    sink: str = "parquet",
    path: str | None = None,
    output_mode: str = "append",
    trigger_seconds: int | None = None,
    checkpoint_location: str | None = None,
) -> StreamingQuery:
    """Start a query; progress is checkpointed under the shared checkpoint folder.

    The default location is stable per query name so a restarted query
    resumes where it stopped (exactly-once with file sinks).
    """
    spark = df.sparkSession
    ckpt = checkpoint_location or f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    w = df.writeStream.queryName(name).outputMode(output_mode).option("checkpointLocation", ckpt)
    if trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    w = w.format(sink)
    if path:
        w = w.option("path", path)
    return w.start()
