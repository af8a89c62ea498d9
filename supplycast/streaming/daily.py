"""Daily facts kept up to date from a stream of order items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplycast.functions.stats import money_sum


def daily_facts(
    items: DataFrame, keys: list[str], ts: str = "ts_purchase", lateness: str = "2 days"
) -> DataFrame:
    """Items, price ratio and revenue per day and key over a stream.

    The state holds one row per open day and key; a day closes, and in append
    mode is emitted, once the watermark passes its end.
    """
    days = items.withWatermark(ts, lateness).groupBy(F.window(ts, "1 day"), *keys)
    facts = days.agg(
        F.count("order_item_id").cast("double").alias("orders"),
        money_sum(F.col("price")).cast("double").alias("revenue"),
    )
    return facts.select(
        F.col("window.start").cast("date").alias("ds"),
        *keys,
        "orders",
        F.try_divide("revenue", "orders").alias("avg_price"),
        "revenue",
    )
