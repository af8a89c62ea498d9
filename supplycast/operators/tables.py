"""Frequency tables, contingency tables and correlations."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from supplycast.functions.stats import pearson


def frequency(df: DataFrame, column: str) -> DataFrame:
    """Count and share of every value."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def contingency(df: DataFrame, rows: str, columns: str) -> DataFrame:
    """Two-way counts in long form with the share inside each row value."""
    counts = df.groupBy(rows, columns).agg(F.count("*").alias("n"))
    of_row = Window.partitionBy(rows)
    return counts.withColumn("row_share", F.col("n") / F.sum("n").over(of_row))


def adjusted_rand(df: DataFrame, a: str, b: str) -> DataFrame:
    """Agreement of two labelings: cells, expected index and adjusted Rand index."""
    cells = df.groupBy(a, b).agg(F.count("*").alias("n"))
    sums = cells.groupingSets([[a, b], [a], [b], []], a, b).agg(
        F.sum("n").cast("double").alias("n"), F.grouping_id().alias("level")
    )

    def same(level: int):
        return F.sum(F.when(F.col("level") == level, F.col("n") * (F.col("n") - 1) / 2))

    pairs = sums.agg(
        same(0).alias("both"),
        same(1).alias("by_a"),
        same(2).alias("by_b"),
        same(3).alias("all"),
        F.max("n").cast("bigint").alias("n"),
    )
    expected = F.try_divide(F.col("by_a") * F.col("by_b"), F.col("all"))
    ceiling = (F.col("by_a") + F.col("by_b")) / 2
    index = F.try_divide(F.col("both") - expected, ceiling - expected)
    return pairs.select("n", index.alias("adjusted_rand"))


def correlation(df: DataFrame, columns: list[str], keys: list[str] = ()) -> DataFrame:
    """Pearson correlations ``(keys, x, y, r)`` of every pair of columns, in one pass."""
    cells = F.array(
        *[
            F.struct(
                F.lit(x).alias("x"),
                F.lit(y).alias("y"),
                F.col(x).cast("double").alias("_a"),
                F.col(y).cast("double").alias("_b"),
            )
            for x, y in combinations_with_replacement(columns, 2)
        ]
    )
    # one small aggregate over column pairs; wide forms of it compile for seconds
    pairs = df.select(*keys, F.inline(cells))
    return pairs.groupBy(*keys, "x", "y").agg(pearson(F.col("_a"), F.col("_b")).alias("r"))
