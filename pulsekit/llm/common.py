"""Storage and hashing helpers of the corpus operators.

Everything that must outlive a task goes to the folder that the session names
in ``spark.checkpoint.dir``: tables through Spark's own writer, archive files
through :mod:`pyarrow.fs` (``file``, ``hdfs``, ``s3``, ``gs`` URIs), so that
any executor can read what another one wrote.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.session import checkpoint_dir, ship_package

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new, qualified folder URI below the shared checkpoint folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return f"file://{uri[5:]}" if uri.startswith("file:/") and not uri.startswith("file://") else uri


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there."""
    spark, folder = df.sparkSession, shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def filesystem(uri: str):
    """(pyarrow file system, path) of a URI; called inside tasks as well."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix): bijective, so distinct inputs stay distinct."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Rows that Spark hands to a Python worker at once: texts can be long, and a worker holds a batch or two.
BATCH_ROWS = 1000


def workers_ready(spark: SparkSession) -> None:
    """Executors can import this package, and batches of whole texts stay small."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def need(df: DataFrame, *cols: str) -> DataFrame:
    """The named columns only, so that no other column of the input can clash."""
    workers_ready(df.sparkSession)
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"input lacks the columns {missing}")
    return df.select(*[F.col(f"`{c}`") for c in cols])


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` is called so (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
