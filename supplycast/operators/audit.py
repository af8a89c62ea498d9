"""Exploratory checks of the source tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplycast.functions.stats import money_sum, pearson, slope


def granularity(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values of every column, one row per column.

    Each column is reduced on its own (column, value) pair, so the work spreads
    over the values and the rows are read once.
    """
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], columns, "entity", "value"
    )
    distinct = long.where("value IS NOT NULL").groupBy("entity", "value").agg(F.lit(1).alias("k"))
    return distinct.groupBy("entity").agg(F.count("*").alias("n_distinct"))


def time_extent(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.min(column).alias("first_day"),
        F.max(column).alias("last_day"),
        (F.datediff(F.max(column), F.min(column)) + 1).alias("n_days"),
    )


def missing_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Missing values and complete-case share, per table and column."""

    def one(name: str, df: DataFrame) -> DataFrame:
        whole = reduce(lambda a, c: a & F.col(c).isNotNull(), df.columns, F.lit(True))
        counts = df.agg(
            F.count("*").alias("n"),
            F.sum(whole.cast("bigint")).alias("n_complete"),
            *[F.sum(F.col(c).isNull().cast("bigint")).alias(f"m_{c}") for c in df.columns],
        )
        cells = F.array(
            *[
                F.struct(F.lit(c).alias("column_name"), F.col(f"m_{c}").alias("n_missing"))
                for c in df.columns
            ]
        )
        return counts.select(F.lit(name).alias("table_name"), "n", "n_complete", F.inline(cells))

    profile = reduce(DataFrame.unionByName, [one(n, d) for n, d in tables.items()])
    return profile.withColumns(
        {
            "missing_share": F.try_divide(F.col("n_missing"), F.col("n")),
            "complete_share": F.try_divide(F.col("n_complete"), F.col("n")),
        }
    )


def volume_spikes(orders: DataFrame, factor: float, day: str = "dt_purchase") -> DataFrame:
    """Days whose volume is at least ``factor`` times the mean daily volume."""
    daily = orders.groupBy(day).agg(F.count("*").alias("n"))
    mean = daily.agg(F.sum("n") / F.count("*")).scalar()
    return daily.withColumn("ratio", F.col("n") / mean).where(F.col("ratio") >= factor)


def revenue_by_month(items: DataFrame, place: str = "customer_region") -> DataFrame:
    return items.groupBy(F.trunc("dt_purchase", "MM").alias("month"), place).agg(
        money_sum(F.col("price")).cast("double").alias("revenue"),
        F.count("*").alias("n_items"),
    )


def violations(items: DataFrame) -> DataFrame:
    """Items tagged with the process rule they break; one row per broken rule."""
    rules = {
        "delivered_without_approval": F.col("dt_delivered").isNotNull()
        & F.col("dt_approved").isNull(),
        "approved_after_posting": F.col("dt_approved") > F.col("dt_shipped"),
        "approved_after_delivery": F.col("dt_approved") > F.col("dt_delivered"),
    }
    broken = F.array_compact(F.array(*[F.when(rule, F.lit(n)) for n, rule in rules.items()]))
    return items.withColumn("violation", F.explode(broken))


def violation_counts(items: DataFrame) -> DataFrame:
    return violations(items).groupBy("violation").agg(F.count("*").alias("n"))


def count_by_place(customers: DataFrame, sellers: DataFrame, points: DataFrame) -> DataFrame:
    """Customers and sellers per region."""
    sides = []
    for side, people in (("customer", customers), ("seller", sellers)):
        place = points.select(F.col("zip").alias(f"{side}_zip"), "region")
        sides.append(
            people.join(place, f"{side}_zip", "left")
            .groupBy("region")
            .agg(F.count("*").alias("n"))
            .withColumn("side", F.lit(side))
        )
    return sides[0].unionByName(sides[1])


def distance_trend(items: DataFrame, flag: str = "late_delivery") -> DataFrame:
    """Delivery time against distance: line and correlation per lateness flag."""
    x, y = F.col("distance"), F.col("days_to_deliver").cast("double")
    pairs = items.where(x.isNotNull() & y.isNotNull())
    return pairs.groupBy(flag).agg(
        F.count("*").alias("n"),
        slope(y, x).alias("slope"),
        (F.avg("days_to_deliver") - slope(y, x) * F.avg(x)).alias("intercept"),
        pearson(y, x).alias("r"),
    )


def distance_spread(
    items: DataFrame, flag: str = "late_delivery", width: float = 2000.0
) -> DataFrame:
    """Mean and spread of delivery time in distance bins of ``width`` kilometres."""
    return items.groupBy(flag, F.floor(F.col("distance") / width).alias("distance_bin")).agg(
        F.count("*").alias("n"),
        F.avg("days_to_deliver").alias("mean_days"),
        F.stddev_samp("days_to_deliver").alias("sd_days"),
    )
