"""Logistics features of an order item."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplycast.functions.geo import haversine_km


def logistics(items: DataFrame) -> DataFrame:
    """Durations in days, later minus earlier, and the lateness flags.

    ``late_delivery`` compares an estimate counted from the purchase with days
    counted from the approval; ``late_vs_estimate_date`` compares the two dates.
    """
    return items.withColumns(
        {
            "est_delivery_days": F.datediff("dt_estimated", "dt_purchase"),
            "days_to_deliver": F.datediff("dt_delivered", "dt_approved"),
            "days_approved": F.datediff("dt_approved", "dt_purchase"),
            "days_shipping": F.datediff("dt_shipped", "dt_approved"),
            "delayed_shipping": F.col("dt_limit") < F.col("dt_shipped"),
            "late_vs_estimate_date": F.col("dt_estimated") < F.col("dt_delivered"),
        }
    ).withColumn("late_delivery", F.col("est_delivery_days") < F.col("days_to_deliver"))


def delivery_distance(items: DataFrame) -> DataFrame:
    """Kilometres between the seller's and the buyer's postal code."""
    return items.withColumn(
        "distance",
        haversine_km(
            F.col("seller_lat"), F.col("seller_lng"), F.col("customer_lat"), F.col("customer_lng")
        ),
    )


def postal_points(geolocation: DataFrame) -> DataFrame:
    """One coordinate per postal code, so that a join cannot multiply rows."""
    return geolocation.groupBy("zip").agg(F.avg("lat").alias("lat"), F.avg("lng").alias("lng"))


def with_category(items: DataFrame, products: DataFrame) -> DataFrame:
    """Left join of the product category; a product with two categories is an error."""
    low, high = F.min("category"), F.max("category")
    conflict = F.raise_error(F.concat(F.lit("two categories of product "), "product_id"))
    catalogue = products.groupBy("product_id").agg(
        F.when(low != high, conflict.cast("string")).otherwise(high).alias("category")
    )
    return items.join(catalogue, "product_id", "left")


def recode_category(items: DataFrame, label: str = "nao_informada") -> DataFrame:
    return items.withColumn("category", F.coalesce("category", F.lit(label)))


def with_cluster(items: DataFrame, labels: DataFrame) -> DataFrame:
    """Write the seller's cluster back; sellers without one keep NULL."""
    return items.join(labels.select("seller_id", "cluster"), "seller_id", "left")


def assemble(
    items: DataFrame,
    orders: DataFrame,
    *,
    customers: DataFrame | None = None,
    sellers: DataFrame | None = None,
    products: DataFrame | None = None,
    reviews: DataFrame | None = None,
    payments: DataFrame | None = None,
    points: DataFrame | None = None,
) -> DataFrame:
    """Star join of the source tables, one output row per order item.

    Reviews and payments are reduced to one row per order first.  They share
    the join key of ``orders``, so the item side is shuffled once for all three.
    """
    order_side = orders
    if customers is not None:
        order_side = order_side.join(customers, "customer_id", "left")
    if reviews is not None:
        scores = reviews.groupBy("order_id").agg(
            F.avg("score").alias("review_score"), F.count("*").alias("n_reviews")
        )
        order_side = order_side.drop("review_score").join(scores, "order_id", "left")
    if payments is not None:
        paid = payments.groupBy("order_id").agg(
            F.sum(F.col("payment_value").cast("decimal(18,2)")).cast("double").alias("paid"),
            F.count("*").alias("n_payments"),
        )
        order_side = order_side.join(paid, "order_id", "left")
    out = items.join(order_side, "order_id")
    if sellers is not None:
        out = out.join(sellers, "seller_id", "left")
    if products is not None:
        out = with_category(out, products)
    if points is not None:
        for side in ("seller", "customer"):
            named = points.select(
                F.col("zip").alias(f"{side}_zip"),
                F.col("lat").alias(f"{side}_lat"),
                F.col("lng").alias(f"{side}_lng"),
            )
            out = out.join(named, f"{side}_zip", "left")
    return out


def exclude(items: DataFrame, pairs: DataFrame, on: list[str]) -> DataFrame:
    """Drop the listed combinations, for instance a seller on one day."""
    return items.join(pairs, on, "left_anti")
