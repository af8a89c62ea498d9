"""Supplier KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplycast.functions.stats import money_sum
from supplycast.operators.dealing import dealt

KPI_COLUMNS = [
    "n_orders",
    "n_products",
    "n_categories",
    "avg_price",
    "revenue",
    "price_range",
    "avg_shipping",
    "avg_score",
    "avg_distance",
    "pct_delayed",
]


#: item column -> the KPI that averages it
SERVICE = {"days_shipping": "avg_shipping", "review_score": "avg_score", "distance": "avg_distance"}


def seller_category_kpis(items: DataFrame, tasks: int | None = None) -> DataFrame:
    """One row per seller and category.

    ``reach`` counts distinct orders and products, ``money`` holds the exact revenue and the mean and
    limits of the prices, ``service`` the means of ``SERVICE``, ``late`` the items posted too late.
    Orders and products are counted apart, each on items dealt out to ``tasks`` partitions: two distinct
    counts in one aggregation would hold every item three times, each time with all other sums.
    """
    shelf = ["seller_id", "category"]
    amount = money_sum(F.col("price"))
    money = {
        "revenue": amount,
        "mean_price": amount.cast("double") / F.count("price"),
        "cheapest": F.min("price"),
        "dearest": F.max("price"),
    }
    service = {kpi: F.avg(column) for column, kpi in SERVICE.items()}
    themes = [
        F.struct(*[value.alias(name) for name, value in theme.items()]).alias(title)
        for title, theme in (("money", money), ("service", service))
    ]
    late = F.sum(F.col("delayed_shipping").cast("int")).alias("late")
    columns = ["product_id", "price", *SERVICE, "delayed_shipping"]
    sums = (
        dealt(items.select(*shelf, *columns), [*shelf, "product_id"], tasks)
        .groupBy(*shelf)
        .agg(F.countDistinct("product_id").alias("products"), *themes, late)
    )
    counted = (
        dealt(items.select(*shelf, "order_id"), [*shelf, "order_id"], tasks)
        .groupBy(*[F.col(c).alias(f"_{c}") for c in shelf])
        .agg(F.countDistinct("order_id").alias("orders"))
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in shelf]
    reach = F.struct("orders", "products").alias("reach")
    return sums.join(counted, same).select(*shelf, reach, "money", "service", "late")


def flat(per_category: DataFrame) -> DataFrame:
    """The themes of ``seller_category_kpis`` as plain columns, with the span of the prices."""
    span = (F.col("money.dearest") - F.col("money.cheapest")).alias("price_span")
    return per_category.select(
        "seller_id", "category", "reach.*", "money.*", span, "service.*", "late"
    )


def seller_kpis(per_category: DataFrame) -> DataFrame:
    """KPIs per seller from the per-category ones.

    Averages are unweighted means of the category means, and an order that
    spans two categories counts twice in ``n_orders``; ``pct_delayed`` divides
    late items by those orders and may exceed one.
    """
    added = {"n_orders": "reach.orders", "n_products": "reach.products", "revenue": "money.revenue"}
    averaged = {"avg_price": "money.mean_price"} | {k: f"service.{k}" for k in SERVICE.values()}
    folded = per_category.groupBy("seller_id").agg(
        *[F.sum(source).alias(kpi) for kpi, source in added.items()],
        *[F.avg(source).alias(kpi) for kpi, source in averaged.items()],
        F.count("category").alias("n_categories"),
        F.struct(F.max("money.dearest").alias("top"), F.min("money.cheapest").alias("low")).alias("_p"),
        F.sum("late").cast("double").alias("_late"),
    )
    whole = folded.withColumns(
        {
            "revenue": F.col("revenue").cast("double"),
            "price_range": F.col("_p.top") - F.col("_p.low"),
            "pct_delayed": F.try_divide("_late", F.col("n_orders").cast("double")),
        }
    )
    return whole.select("seller_id", *KPI_COLUMNS)


def complete_cases(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.dropna("any", subset=columns)


def completeness(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows before and after the complete-case filter, and the number removed."""
    missing = F.lit(False)
    for name in columns:
        missing |= F.col(name).isNull()
    return df.agg(
        F.count("*").alias("n_before"),
        F.coalesce(F.sum((~missing).cast("bigint")), F.lit(0)).alias("n_after"),
        F.coalesce(F.sum(missing.cast("bigint")), F.lit(0)).alias("n_removed"),
    )
