"""One seller, order and category holding a third of all rows changes no result."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from supplycast.operators import audit, facts, features, kpi, quantiles, tables


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(0)
    n = 6000
    hot = np.arange(n) < n // 3
    day = pd.Timestamp("2017-01-01") + pd.to_timedelta(rng.integers(0, 90, n), unit="D")
    return pd.DataFrame(
        {
            "order_id": np.where(hot, 1, rng.integers(2, 2000, n)),
            "order_item_id": rng.integers(1, 5, n),
            "product_id": rng.integers(1, 300, n),
            "seller_id": np.where(hot, 7, rng.integers(8, 60, n)),
            "category": np.where(hot, "toys", rng.choice(["home", "toys", "auto"], n)),
            "price": np.where(hot & (rng.random(n) < 0.5), 9.9, rng.integers(1, 90000, n) / 100),
            "days_shipping": rng.integers(-3, 40, n),
            "delayed_shipping": rng.random(n) < 0.2,
            "review_score": rng.integers(1, 6, n),
            "distance": rng.random(n) * 1000,
            "dt_purchase": day.date,
        }
    )


@pytest.fixture(scope="module")
def items(spark, frame):
    # many partitions and a small skew limit, so that the split of hot keys takes place
    for name, value in {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }.items():
        spark.conf.set(name, value)
    yield spark.createDataFrame(frame).repartition(16)
    for name in (
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes",
        "spark.sql.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.autoBroadcastJoinThreshold",
    ):
        spark.conf.unset(name)


def test_kpis(items, frame):
    got = kpi.seller_kpis(kpi.seller_category_kpis(items)).toPandas().set_index("seller_id")
    per = frame.groupby(["seller_id", "category"]).agg(
        orders=("order_id", "nunique"),
        products=("product_id", "nunique"),
        price=("price", "mean"),
        revenue=("price", "sum"),
        late=("delayed_shipping", "sum"),
    )
    want = per.groupby("seller_id").agg(
        n_orders=("orders", "sum"),
        n_products=("products", "sum"),
        avg_price=("price", "mean"),
        revenue=("revenue", "sum"),
        late=("late", "sum"),
    )
    got = got.loc[want.index]
    assert got["n_orders"].tolist() == want["n_orders"].tolist()
    assert got["n_products"].tolist() == want["n_products"].tolist()
    assert got["avg_price"].to_numpy() == pytest.approx(want["avg_price"].to_numpy())
    assert got["revenue"].to_numpy() == pytest.approx(want["revenue"].to_numpy())
    share = (want["late"] / want["n_orders"]).to_numpy()
    assert got["pct_delayed"].to_numpy() == pytest.approx(share)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _deals(plan):
    """Keys of the shuffles to seven partitions, in a plan where these are asked for."""
    found = re.findall(r"hashpartitioning\(([^()]*), 7\), REPARTITION_BY_NUM", plan)
    return [re.findall(r"(\w+)#", keys) for keys in found]


def test_no_distinct_count_holds_every_item_of_a_join_task(items):
    """No item is held once for each distinct count, and items are dealt out before they are counted."""
    plan = _plan(kpi.seller_category_kpis(items, 7))
    assert "Expand" not in plan
    assert sorted(_deals(plan)) == [["seller_id", "category", "order_id"], ["seller_id", "category", "product_id"]]


def test_shelves_without_seller_or_category(items, frame):
    odd = items.withColumns(
        {
            "category": F.when(F.col("category") != "auto", F.col("category")),
            "seller_id": F.when(F.col("seller_id") % 5 != 0, F.col("seller_id")),
            "order_id": F.when(F.col("order_id") % 3 != 0, F.col("order_id")),
        }
    )
    got = kpi.flat(kpi.seller_category_kpis(odd)).toPandas()
    want = odd.select("seller_id", "category", "order_id", "product_id", "price").toPandas()
    none = {"seller_id": -1, "category": "none"}
    got, want = got.fillna(none), want.fillna(none)
    want = want.groupby(["seller_id", "category"]).agg(
        orders=("order_id", "nunique"), products=("product_id", "nunique"), price=("price", "sum")
    )
    got = got.set_index(["seller_id", "category"]).reindex(want.index)
    assert got["orders"].tolist() == want["orders"].tolist()
    assert got["products"].tolist() == want["products"].tolist()
    assert got["revenue"].astype(float).to_numpy() == pytest.approx(want["price"].to_numpy())


def test_join_of_a_hot_order_keeps_every_item(spark, items, frame):
    orders = spark.range(1, 2000).select(
        F.col("id").alias("order_id"), (F.col("id") % 9).alias("customer_id")
    )
    reviews = spark.range(1, 2000).select(F.col("id").alias("order_id"), F.lit(4).alias("score"))
    out = features.assemble(items.drop("review_score"), orders, reviews=reviews)
    assert out.count() == len(frame)
    assert out.where("order_id = 1").count() == (frame["order_id"] == 1).sum()


def test_facts_and_distinct_orders(items, frame):
    got = facts.period_facts(items, ["seller_id"], distinct_orders=True)
    row = got.groupBy().agg(F.sum("orders").alias("n"), F.sum("n_orders").alias("d")).first()
    assert row["n"] == len(frame)
    assert row["d"] == frame.groupby(["seller_id", "dt_purchase"])["order_id"].nunique().sum()


def test_distinct_orders_are_counted_after_the_deal(items):
    plan = _plan(facts.period_facts(items, ["seller_id"], distinct_orders=True, tasks=7))
    assert _deals(plan) == [["ds", "seller_id", "order_id"]]


def test_quantiles_with_a_value_that_repeats(items, frame):
    got = quantiles.exact_quantiles(items, ["category"], "price", quantiles.QUARTILES)
    for row in got.collect():
        prices = frame.loc[frame["category"] == row["category"], "price"]
        want = np.quantile(prices, [0.25, 0.5, 0.75])
        assert [row["q1"], row["median"], row["q3"]] == pytest.approx(want)


def test_counts(items, frame):
    found = {r["entity"]: r["n_distinct"] for r in audit.granularity(items, ["order_id", "seller_id"]).collect()}
    assert found == {c: frame[c].nunique() for c in found}
    shares = {r["category"]: r["share"] for r in tables.frequency(items, "category").collect()}
    assert shares == pytest.approx((frame["category"].value_counts() / len(frame)).to_dict())


def test_ranges_of_quantiles_stay_small(spark):
    """Near-unique values: the largest sorted range does not grow with the rows."""
    for n in (20_000, 200_000):
        df = spark.range(n).select(
            (F.col("id") % 2).alias("g"), (F.xxhash64("id") % 1_000_003).cast("double").alias("v")
        )
        counts = quantiles._Counts(df, ["g"], "v", 1000)
        largest = counts.tagged().groupBy("g", "_bucket").count().agg(F.max("count")).first()[0]
        assert largest <= 1000
        got = {r["g"]: (r["q1"], r["median"], r["q3"]) for r in counts.quantiles(quantiles.QUARTILES).collect()}
        frame = df.toPandas()
        for g, part in frame.groupby("g"):
            assert got[g] == pytest.approx(tuple(part["v"].quantile([0.25, 0.5, 0.75])))


def test_counts_of_few_keys_are_not_shuffled_by_key(spark):
    df = spark.range(5000).select(F.rand(3).alias("v"), F.lit("a").alias("g"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tagged = quantiles._Counts(df, ["g"], "v", 1000).tagged()
        plan = tagged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
