"""Marketplace tables derived from the star-schema parquet files.

The mapping is stated in FIXTURES.md section 3: line items stand for order
items, suppliers for sellers, parts for products, nations for postal codes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from supplycast.sources import schemas


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Declared schema: no job to infer it, and a column of another type fails."""
    return spark.read.schema(schemas.STAR[name]).parquet(f"{folder}/{name}.parquet")


def _day(ts: str) -> Column:
    return F.col(ts).cast("date")


def latitude(nation: str) -> Column:
    return F.lit(-60.0) + F.lit(5.0) * F.col(nation)


def longitude(nation: str) -> Column:
    return F.lit(-170.0) + F.lit(13.0) * F.col(nation)


def orders(spark: SparkSession, folder: str) -> DataFrame:
    purchased = _day("o_orderdate")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .otherwise(F.col("o_orderstatus"))
        .alias("status"),
        purchased.alias("dt_purchase"),
        F.date_add(purchased, (F.col("o_orderkey") % 4).cast("int")).alias("dt_approved"),
        F.date_add(purchased, 10).alias("dt_limit"),
        F.date_add(purchased, 60).alias("dt_estimated"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("review_score"),
        F.col("o_totalprice").alias("order_value"),
    )


def items(spark: SparkSession, folder: str) -> DataFrame:
    shipped = _day("l_shipdate")
    transit = (3 + (F.col("l_orderkey") + F.col("l_partkey")) % 20).cast("int")
    freight = F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_tax").cast("decimal(4,2)")
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_extendedprice").alias("price"),
        freight.cast("double").alias("freight_value"),
        shipped.alias("dt_shipped"),
        F.date_add(shipped, transit).alias("dt_delivered"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_size") % 17 != 0, F.col("p_type")).alias("category"),
    )


def sellers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("seller_id"), F.col("s_nationkey").alias("seller_zip")
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").alias("customer_zip")
    )


def zip_points(spark: SparkSession, folder: str) -> DataFrame:
    """One coordinate and region per postal code."""
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("zip"),
        latitude("n_nationkey").alias("lat"),
        longitude("n_nationkey").alias("lng"),
        F.col("r_name").alias("region"),
    )


def geolocation(spark: SparkSession, folder: str) -> DataFrame:
    """Several scattered points per postal code, one for each customer."""
    scatter = (F.col("c_custkey") % 7).cast("double") / 100
    return table(spark, folder, "customer").select(
        F.col("c_nationkey").alias("zip"),
        (latitude("c_nationkey") + scatter).alias("lat"),
        (longitude("c_nationkey") - scatter).alias("lng"),
    )


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """One review per order, a second one with the mirrored score for every tenth."""
    score = F.substring("o_orderpriority", 1, 1).cast("int")
    scores = F.when(F.col("o_orderkey") % 10 == 0, F.array(score, 6 - score)).otherwise(
        F.array(score)
    )
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.explode(scores).alias("score")
    )


def payments(spark: SparkSession, folder: str) -> DataFrame:
    """One to three equal payments per order."""
    parts = (1 + F.col("o_orderkey") % 3).cast("int")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.explode(F.sequence(F.lit(1), parts)).alias("payment_sequence"),
        F.col("o_totalprice").alias("payment_value"),
    )


def cluster_label(seller: Column) -> Column:
    """Deterministic stand-in label, with gaps, for the SQL-checked queries."""
    return F.when(seller % 10 != 9, (1 + seller % 3).cast("string"))


def order_items(
    spark: SparkSession,
    folder: str,
    *,
    category: bool = False,
    places: bool = False,
) -> DataFrame:
    """Items with their order, and on request category and coordinates.

    The joins that a query does not need are left out rather than pruned.
    """
    order_side = orders(spark, folder)
    if places:
        points = zip_points(spark, folder)
        buyer = customers(spark, folder).join(
            points.select(
                F.col("zip").alias("customer_zip"),
                F.col("lat").alias("customer_lat"),
                F.col("lng").alias("customer_lng"),
                F.col("region").alias("customer_region"),
            ),
            "customer_zip",
        )
        order_side = order_side.join(buyer, "customer_id", "left")
    joined = items(spark, folder).join(order_side, "order_id")
    if places:
        seller = sellers(spark, folder).join(
            points.select(
                F.col("zip").alias("seller_zip"),
                F.col("lat").alias("seller_lat"),
                F.col("lng").alias("seller_lng"),
                F.col("region").alias("seller_region"),
            ),
            "seller_zip",
        )
        joined = joined.join(seller, "seller_id", "left")
    if category:
        joined = joined.join(products(spark, folder), "product_id", "left")
    return joined
