"""Intermediate tables on storage that every executor can reach."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder named by the session; a temporary one only where the master is known to be local."""
    configured = spark.conf.get(_CONF, None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {_CONF} to a folder shared by all executors")
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="supplycast-")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Used where several actions read the same result (iterative fits, several
    forecasting models).  The copy is columnar, carries statistics and does
    not depend on executors staying alive.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
