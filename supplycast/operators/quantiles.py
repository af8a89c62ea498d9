"""Exact quantiles and box-plot statistics without gathering a group."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from supplycast.sources.scratch import materialize


#: distinct values that one range may hold on average: what one task sorts
RANGE_ROWS = 500_000
#: bytes up to which a table with a row for each key is sent to all executors
SMALL_BYTES = 8 << 20


def exact_quantiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    probs: dict[str, float],
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Linear-interpolation quantiles per key, one column per entry of ``probs``.

    Values are counted first, then cut into ranges of about ``range_rows`` distinct
    values, however many there are.  Exact range counts tell which few ranges hold
    the wanted ranks, and only those are sorted.  The cut points come from a
    sketch, but they only influence how even the ranges are, not the result.
    """
    return _Counts(df, keys, value, range_rows).quantiles(probs)


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    known = df.where(F.col(value).isNotNull())
    return known.groupBy(*keys, value).agg(F.count("*").alias("_n"))


class _Counts:
    """Written counts of the distinct values of each key."""

    def __init__(self, df: DataFrame, keys: list[str], value: str, range_rows: int) -> None:
        self.keys, self.value = keys, value
        self.rows = materialize(value_counts(df, keys, value), "value-counts")
        per_key = self.rows.groupBy(*keys).agg(F.count("*").alias("rows"))
        self.n_keys, largest = per_key.agg(F.count("*"), F.max("rows")).first()
        # halvings until the values of the largest key fit, one more as the ranges are not quite even
        self.depth = max(1, math.ceil(math.log2(max(1, (largest or 0) / range_rows))) + 1)

    def with_keys(self, small: DataFrame, row_bytes: int) -> DataFrame:
        """The counts joined to a row of each key, without a shuffle of the counts if there are few keys."""
        if self.n_keys * row_bytes <= SMALL_BYTES:
            small = F.broadcast(small)
        return self.rows.join(small, self.keys)

    def tagged(self) -> DataFrame:
        """The counts with the total of their key and the number of their range."""
        keys, value, buckets = self.keys, self.value, 2**self.depth
        grid = [i / buckets for i in range(1, buckets)]
        cuts = self.rows.groupBy(*keys).agg(
            # each cut is off by less than a quarter of a range
            F.percentile_approx(value, grid, max(1000, 4 * buckets)).alias("_cuts"),
            F.sum("_n").alias("_total"),
        )
        # number of cut points below the value, by halving
        tagged = self.with_keys(cuts, 64 + 8 * buckets).withColumn("_bucket", F.lit(0))
        for step in (2**i for i in reversed(range(self.depth))):
            cut = F.col("_cuts")[F.col("_bucket") + (step - 1)]
            tagged = tagged.withColumn(
                "_bucket", F.col("_bucket") + F.when(cut < F.col(value), step).otherwise(0)
            )
        return tagged.select(*keys, value, "_n", "_total", "_bucket")

    def quantiles(self, probs: dict[str, float]) -> DataFrame:
        return _from_ranges(self.tagged(), self.keys, self.value, probs)


def _from_ranges(tagged: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    wanted = F.lit(False)
    positions = {}
    for name, p in probs.items():
        rank = F.lit(float(p)) * (F.col("_total") - 1)
        low = F.floor(rank)
        positions[name] = (low, F.least(low + 1, F.col("_total") - 1), rank - low)

    ranges = tagged.groupBy(*keys, "_bucket").agg(
        F.sum("_n").alias("_in"), F.max("_total").alias("_total")
    )
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    ranges = ranges.withColumn("_before", F.coalesce(F.sum("_in").over(before), F.lit(0)))
    for low, high, _ in positions.values():
        for rank in (low, high):
            wanted |= (F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_in"))
    ranges = ranges.where(wanted).select(*keys, "_bucket", "_before")

    inside = (
        Window.partitionBy(*keys, "_bucket")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = tagged.join(ranges, [*keys, "_bucket"]).withColumn(
        "_upto", F.col("_before") + F.sum("_n").over(inside)
    )

    def at(rank):
        covers = (F.col("_upto") - F.col("_n") <= rank) & (rank < F.col("_upto"))
        return F.max(F.when(covers, F.col(value)))

    picks, results = [], []
    for name, (low, high, share) in positions.items():
        picks += [
            at(low).alias(f"_{name}_lo"),
            at(high).alias(f"_{name}_hi"),
            F.max(share).alias(f"_{name}_share"),
        ]
        lo, hi, s = (F.col(f"_{name}_{part}") for part in ("lo", "hi", "share"))
        results.append((lo + (hi - lo) * s).cast("double").alias(name))
    return ranked.groupBy(*keys).agg(*picks).select(*keys, *results)


QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def unpivot(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Long form ``(keys, metric, value)``."""
    wide = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot(keys, columns, "metric", "value")


def box_stats(
    df: DataFrame,
    keys: list[str],
    columns: list[str],
    reach: float = 1.5,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Quartiles, whiskers at ``reach`` x IQR and outlier count of each column."""
    by = [*keys, "metric"]
    counts = _Counts(unpivot(df, keys, columns), by, "value", range_rows)
    quartiles = counts.quantiles(QUARTILES)
    iqr = F.col("q3") - F.col("q1")
    low, high = F.col("q1") - reach * iqr, F.col("q3") + reach * iqr
    inner = F.when(F.col("value").between(low, high), F.col("value"))
    return (
        counts.with_keys(quartiles, 128)
        .groupBy(*by, "q1", "median", "q3")
        .agg(
            F.sum("_n").alias("n"),
            F.min(inner).alias("whisker_low"),
            F.max(inner).alias("whisker_high"),
            F.sum(F.when(inner.isNull(), F.col("_n")).otherwise(0)).alias("n_outliers"),
        )
    )


def flag_outliers(df: DataFrame, columns: list[str], reach: float = 1.5) -> DataFrame:
    """Outlier limits, count and share per column over all rows."""
    boxes = box_stats(df, [], columns, reach)
    return boxes.withColumn("share", F.col("n_outliers") / F.col("n"))
