"""Quantiles, files, joins and the shape of the plans."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from supplycast.operators import audit, facts, features, kpi, quantiles, spine
from supplycast.sources import csv2, marketplace, schemas, scratch
from supplycast.streaming import daily as streaming
from workload import queries


# -- quantiles ------------------------------------------------------------------------------


def test_quantiles_against_numpy_on_skewed_groups(spark):
    rng = np.random.default_rng(0)
    groups = {
        "hot": np.round(rng.lognormal(3, 2, 20000), 2),
        "ties": rng.integers(0, 3, 500).astype(float),
        "one": np.array([4.5]),
        "negative": rng.normal(-50, 30, 333),
    }
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("hot", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = {"p01": 0.01, "q1": 0.25, "med": 0.5, "q3": 0.75, "p99": 0.99, "top": 1.0}
    found = {r["g"]: r for r in quantiles.exact_quantiles(df, ["g"], "v", probs).collect()}
    assert set(found) == set(groups)
    for g, vs in groups.items():
        assert [found[g][p] for p in probs] == pytest.approx(np.quantile(vs, list(probs.values())))


def test_box_statistics(spark):
    values = [*range(1, 20), 100]
    df = spark.createDataFrame([(float(v),) for v in values], "v double").withColumn("g", F.lit("a"))
    row = quantiles.box_stats(df, ["g"], ["v"]).first()
    assert (row["q1"], row["median"], row["q3"]) == (5.75, 10.5, 15.25)
    assert (row["whisker_low"], row["whisker_high"], row["n_outliers"], row["n"]) == (1, 19, 1, 20)


# -- files ----------------------------------------------------------------------------------


def test_month_names(spark):
    df = spark.createDataFrame([("mai 2018",), ("Set 2017",), (None,)], "m string")
    days = [r["d"] for r in df.select(csv2.month_from_name(F.col("m")).alias("d")).collect()]
    assert days == [dt.date(2018, 5, 1), dt.date(2017, 9, 1), None]
    name = spark.range(1).select(csv2.month_to_name(F.lit("2018-02-01").cast("date")).alias("n"))
    assert name.first()["n"] == "fev 2018"


def test_csv_dialect_and_nulls(spark, tmp_path):
    file = tmp_path / "products.csv"
    file.write_text("product_id;category\nP1;casa\nP2;NA\n")
    rows = csv2.read_csv2(spark, str(file), schemas.PRODUCTS).orderBy("product_id").collect()
    assert [r["category"] for r in rows] == ["casa", None]
    series = tmp_path / "daily.csv"
    series.write_text('"";"dates";"orders";"avg_price";"revenue"\n"1";2017-01-05;3;12,5;37,5\n')
    row = csv2.read_csv2(spark, str(series), schemas.SERIES, row_number=True).first()
    assert (row["dates"], row["avg_price"], row["revenue"]) == (dt.date(2017, 1, 5), 12.5, 37.5)


@pytest.mark.parametrize(
    "text", ["product;category\nP1;casa\n", "product_id;category;more\nP1;casa;x\n"]
)
def test_csv_with_another_header_fails(spark, tmp_path, text):
    file = tmp_path / "bad.csv"
    file.write_text(text)
    with pytest.raises((PySparkException, Py4JJavaError)):
        csv2.read_csv2(spark, str(file), schemas.PRODUCTS).collect()


def test_csv_with_a_bad_number_fails(spark, tmp_path):
    file = tmp_path / "bad.csv"
    file.write_text("_;dates;orders;avg_price;revenue\n1;2017-01-05;three;1,0;1,0\n")
    with pytest.raises(PySparkException):
        csv2.read_csv2(spark, str(file), schemas.SERIES, row_number=True).collect()


def test_scratch_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert scratch.scratch_path(spark, "x").startswith(folder)


class _Session:
    """Stands for a session with given settings."""

    def __init__(self, **settings):
        self.conf = self
        self.settings = settings

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_scratch_folder_without_a_setting():
    local = _Session(**{"spark.master": "local[4]"})
    assert scratch.scratch_dir(local) == scratch.scratch_dir(local)
    with pytest.raises(ValueError):
        scratch.scratch_dir(_Session(**{"spark.master": "yarn"}))


# -- joins and audits -----------------------------------------------------------------------


def test_reviews_and_payments_do_not_multiply_items(spark, small):
    m = marketplace
    items, orders = m.items(spark, small), m.orders(spark, small)
    out = features.assemble(
        items, orders, reviews=m.reviews(spark, small), payments=m.payments(spark, small)
    )
    assert out.count() == items.count()


def test_repeated_products_do_not_multiply_items(spark):
    items = spark.createDataFrame([(1,), (2,), (3,)], "product_id int")
    products = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "product_id int, category string")
    out = features.recode_category(features.with_category(items, products))
    assert sorted((r["product_id"], r["category"]) for r in out.collect()) == [
        (1, "a"), (2, "nao_informada"), (3, "nao_informada"),
    ]


def test_order_over_two_categories_counts_twice(spark):
    rows = [(1, 1, 1, "a", 10.0, 1, True, 5, 2.0), (1, 1, 2, "b", 30.0, 3, True, 5, 2.0)]
    items = spark.createDataFrame(
        rows,
        "seller_id int, order_id int, product_id int, category string, price double, "
        "days_shipping int, delayed_shipping boolean, review_score int, distance double",
    )
    row = kpi.seller_kpis(kpi.seller_category_kpis(items)).first()
    assert (row["n_orders"], row["n_categories"], row["avg_price"]) == (2, 2, 20)
    assert (row["price_range"], row["pct_delayed"]) == (20, 1)


def test_violation_rules(spark):
    rows = [
        (1, dt.date(2018, 1, 5), dt.date(2018, 1, 4), dt.date(2018, 1, 9)),
        (2, None, dt.date(2018, 1, 4), dt.date(2018, 1, 9)),
        (3, dt.date(2018, 1, 3), dt.date(2018, 1, 4), dt.date(2018, 1, 9)),
    ]
    df = spark.createDataFrame(rows, "order_id int, dt_approved date, dt_shipped date, dt_delivered date")
    found = {(r["order_id"], r["violation"]) for r in audit.violations(df).collect()}
    assert found == {(1, "approved_after_posting"), (2, "delivered_without_approval")}


# -- plans ----------------------------------------------------------------------------------


def plan_of(df, mode="extended"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def test_date_filter_and_columns_reach_the_scan(spark, small):
    items = queries.labelled_items(spark, small).where(
        F.col("dt_purchase").between(F.lit("1997-01-01").cast("date"), F.lit("1997-12-31").cast("date"))
    )
    plan = plan_of(facts.period_facts(items, ["cluster"]), "formatted")
    assert "GreaterThanOrEqual(o_orderdate" in plan
    scans = [line for line in plan.splitlines() if line.startswith("ReadSchema")]
    assert not any("o_orderpriority" in s or "l_returnflag" in s for s in scans)


@pytest.mark.parametrize(
    "name",
    ["seller_kpis", "daily_facts", "kpi_boxstats", "spine_join", "interpolate", "accuracy",
     "region_month_revenue", "late_by_review", "cluster_profile", "granularity"],
)
def test_no_cross_join_no_python_no_single_task_window(spark, small, name):
    plan = plan_of(queries.QUERIES[name](spark, small))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "InPandas" not in plan
    assert "Exchange SinglePartition" not in plan or "Window" not in plan.split("SinglePartition")[0][-400:]


def test_results_do_not_depend_on_the_partitioning(spark, small):
    names = ("seller_kpis", "interpolate", "outlier_median", "accuracy")
    results = []
    for parts in ("3", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        results.append(
            {n: sorted(map(str, queries.QUERIES[n](spark, small).collect())) for n in names}
        )
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1]


def test_padding_is_marked_and_counted(spark):
    rows = [("a", dt.date(2017, 1, 2), 1.0), ("b", dt.date(2017, 1, 4), 2.0)]
    df = spark.createDataFrame(rows, "k string, ds date, orders double")
    out = spine.densify(df, ["k"], start="2017-01-01")
    assert out.count() == 8
    assert out.where("is_padding").count() == 2
    assert out.agg(F.max("t")).first()[0] == 4


# -- streaming ------------------------------------------------------------------------------


def test_streamed_days_equal_the_batch(spark, small, tmp_path):
    items = queries.labelled_items(spark, small).withColumn(
        "ts_purchase", F.col("dt_purchase").cast("timestamp")
    )
    columns = ["order_item_id", "order_id", "cluster", "price", "dt_purchase", "ts_purchase"]
    source = str(tmp_path / "items")
    rows = items.select(*columns).where("dt_purchase < DATE '1995-03-01'")
    rows.coalesce(1).write.parquet(source)
    # a late row with a far date closes all earlier days
    rows.limit(1).withColumn("ts_purchase", F.lit("1996-01-01").cast("timestamp")).write.mode(
        "append"
    ).parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    facts_stream = streaming.daily_facts(stream, ["cluster"])
    run = (
        facts_stream.writeStream.format("memory").queryName("days").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    )
    run.awaitTermination(120)
    streamed = spark.table("days").where("ds < DATE '1995-03-01'")
    batch = facts.period_facts(rows, ["cluster"]).select(streamed.columns)
    assert sorted(map(str, streamed.collect())) == sorted(map(str, batch.collect()))
