"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Scratch roots of local sessions that name none, by application id.
_local_roots: dict[str, str] = {}


def use_utc(spark: SparkSession) -> SparkSession:
    """All timestamps are UTC; text to timestamp and back follows the session zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster must name one, because every executor has to see what is written there. Only a
    local session may go without; it then gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="twinledger-")
    return _local_roots[app]


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to scratch as a table and read it back.

    This cuts the lineage at a table that outlives lost executors, and the next step reads only
    the columns it needs.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
