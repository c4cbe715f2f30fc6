"""Session helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings the jobs are designed for; all but the first are cluster defaults too.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def recommended_builder(builder=None):
    """A session builder with the recommended settings applied."""
    builder = builder or SparkSession.builder
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return builder


_local_base: list[str] = []


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    Only a local session, as in tests, may fall back to a folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        if not _local_base:
            _local_base.append(tempfile.mkdtemp(prefix="trendloom-"))
        base = _local_base[0]
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def materialize(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table written to the shared folder.

    It cuts the lineage: lost executors re-read files, they recompute nothing.
    """
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
