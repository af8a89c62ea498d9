"""Order facts per period and group, and coarser calendars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplycast.functions.stats import money_sum
from supplycast.operators.dealing import dealt

METRICS = ["orders", "avg_price", "revenue"]
TRUNC = {"day": "DD", "week": "WEEK", "month": "MM"}


def period(day: str, grain: str) -> Column:
    """First day of the period as a DATE."""
    if grain == "day":
        return F.col(day).cast("date")
    return F.trunc(F.col(day), TRUNC[grain])


def period_facts(
    items: DataFrame,
    keys: list[str],
    *,
    day: str = "dt_purchase",
    grain: str = "day",
    distinct_orders: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """Items, price ratio and revenue per period and key.

    ``orders`` counts items and ``avg_price`` divides by all rows, so a missing
    price stays in the denominator; ``mean_price`` leaves it out.  For
    ``distinct_orders`` the items are dealt out to ``tasks`` partitions first,
    because an aggregation per order keeps nearly every item of its task.
    """
    revenue = money_sum(F.col("price")).cast("double")
    extra = [F.countDistinct("order_id").alias("n_orders")] if distinct_orders else []
    when = period(day, grain).alias("ds")
    if distinct_orders:
        items = items.select(when, *keys, "order_id", "order_item_id", "price")
        items, when = dealt(items, ["ds", *keys, "order_id"], tasks), F.col("ds")
    return items.groupBy(when, *keys).agg(
        F.count("order_item_id").cast("double").alias("orders"),
        F.try_divide(revenue, F.count("order_id").cast("double")).alias("avg_price"),
        F.try_divide(revenue, F.count("price").cast("double")).alias("mean_price"),
        revenue.alias("revenue"),
        *extra,
    )


def resample(
    facts: DataFrame, keys: list[str], grain: str, how: dict[str, str], day: str = "ds"
) -> DataFrame:
    """Apply ``sum`` or ``mean`` per metric over calendar periods.

    ``last_ds`` is the last observed day of the period, the label used by
    calendar-apply tools; ``ds`` is its first day.
    """
    functions = {"sum": F.sum, "mean": F.avg}
    return facts.groupBy(*keys, period(day, grain).alias("_period")).agg(
        *[functions[f](metric).alias(metric) for metric, f in how.items()],
        F.max(day).alias("last_ds"),
    ).withColumnRenamed("_period", "ds")


def monthly_rollup(daily: DataFrame, keys: list[str]) -> DataFrame:
    """Daily to monthly; the price is given as sum, mean and ratio."""
    return daily.groupBy(*keys, period("ds", "month").alias("month")).agg(
        F.sum("orders").alias("orders"),
        F.sum("avg_price").alias("avg_price_sum"),
        F.avg("avg_price").alias("avg_price_mean"),
        F.try_divide(F.sum("revenue"), F.sum("orders")).alias("price_ratio"),
        F.sum("revenue").alias("revenue"),
    ).withColumnRenamed("month", "ds")


def merge_metrics(parts: list[DataFrame], on: list[str]) -> DataFrame:
    """Inner join of metric tables on the series and time keys."""
    out = parts[0]
    for part in parts[1:]:
        out = out.join(part, on)
    return out


def total_by_day(facts: DataFrame) -> DataFrame:
    return facts.groupBy("ds").agg(F.sum("orders").alias("n_orders"))
