"""Rows dealt out to tasks of bounded size, ahead of aggregations that keep nearly every row."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

#: rows of one task; an aggregation of nearly unique keys keeps some 500 bytes for each
TASK_ROWS = 300_000


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Number of tasks of at most ``TASK_ROWS`` rows, no fewer than the cluster's cores."""
    return max(spark.sparkContext.defaultParallelism, math.ceil(rows / TASK_ROWS))


def dealt(df: DataFrame, keys: list[str], tasks: int | None = None) -> DataFrame:
    """``df`` in a fixed number of partitions by ``keys``, by default Spark's shuffle partitions.

    Distinct counts over these keys need no further shuffle, and no map-side table that holds nearly
    all rows of a task beside the sorts of the join before it.
    """
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks, *keys)
