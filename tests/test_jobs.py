"""End-to-end jobs on the small tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from supplycast.operators import evaluate, facts, spine
from supplycast.plans import jobs
from supplycast.sources import marketplace
from workload import queries


def test_profiles_cover_every_seller_with_kpis(spark, small):
    items = queries.kpi_items(spark, small)
    labels = jobs.profile_sellers(items)
    sellers = items.select("seller_id").distinct().count()
    assert labels.count() == sellers
    sizes = [r["n"] for r in labels.groupBy("cluster").agg(F.count("*").alias("n")).orderBy("cluster").collect()]
    assert len(sizes) == 3 and sizes == sorted(sizes)


def test_forecast_by_profile(spark, small):
    out = jobs.forecast_by_profile(
        queries.kpi_items(spark, small), marketplace.order_items(spark, small), horizon=4
    ).collect()
    assert len(out) == 12 and {r["h"] for r in out} == {1, 2, 3, 4}
    assert all(r["lo_95"] <= r["lo_80"] <= r["mean"] <= r["hi_80"] <= r["hi_95"] for r in out)
    assert {r["verdict"] for r in out} <= {"up", "down", "flat"}


@pytest.mark.parametrize("trend", ["supersmoother", "running_median"])
def test_clean_series_are_dense_and_complete(spark, small, trend):
    items = queries.labelled_items(spark, small)
    clean = jobs.clean_daily(items, ["cluster"], trend, start="1994-12-01")
    raw = facts.period_facts(items, ["cluster"])
    last = raw.agg(F.max("ds")).first()[0]
    sizes = clean.groupBy("cluster").agg(F.count("*").alias("n"), F.max("ds").alias("last")).collect()
    assert len(sizes) == 3 and len({r["n"] for r in sizes}) == 1
    assert {r["last"] for r in sizes} == {last}
    missing = [F.sum(F.col(m).isNull().cast("int")) for m in facts.METRICS]
    assert set(clean.agg(*missing).first()) == {0}


def test_models_are_compared_on_the_same_rows(spark, small):
    split = spine.split_last(queries.monthly(spark, small), ["cluster"], 6)
    scores = jobs.compare_models(split, ["cluster"], 6, season=12)
    rows = scores.collect()
    assert {(r["model"], r["n"]) for r in rows} == {("holt_damped", 6), ("arima", 6)}
    best = {r["cluster"]: r for r in evaluate.best_model(scores, ["cluster"]).collect()}
    for cluster, row in best.items():
        assert row["best_rmse"] == min(r["rmse"] for r in rows if r["cluster"] == cluster)


def test_entry_has_rows_and_a_stable_schema(spark):
    out = entry_point.entry(spark)
    assert out.columns[:4] == ["cluster", "model", "h", "t"]
    assert out.count() == 12


def test_every_query_is_documented_by_name():
    registered = entry_point.queries()
    assert len(registered) >= 90
    assert not any(n.startswith("op") and n[2:].isdigit() for n in registered)
