"""Small helpers for operators that keep every column of their input."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fresh(name: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has, whatever the case."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
