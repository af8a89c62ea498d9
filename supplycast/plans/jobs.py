"""End-to-end jobs: supplier profiles, clean series, forecasts and their comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from supplycast.operators import (
    arima,
    cluster,
    evaluate,
    facts,
    features,
    kpi,
    repair,
    smoothing,
    spine,
)
from supplycast.sources.scratch import materialize

CLUSTER = ["cluster"]


def scaled_series(dense: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """Z-score of every metric within its series; NULL for a constant one."""
    series = Window.partitionBy(*keys)
    return dense.withColumns(
        {
            f"s_{m}": F.try_divide(
                F.col(m) - F.avg(m).over(series), F.stddev_samp(m).over(series)
            )
            for m in metrics
        }
    )


def profile_sellers(items: DataFrame, k: int = 3, tasks: int | None = None) -> DataFrame:
    """KPIs and k-means label per seller with complete KPIs."""
    kpis = kpi.complete_cases(kpi.seller_kpis(kpi.seller_category_kpis(items, tasks)))
    return cluster.kmeans_labels(cluster.with_vector(kpis), k)


def clean_daily(
    items: DataFrame, keys: list[str], trend: str = "supersmoother", start: str | None = None
) -> DataFrame:
    """Gap-free, outlier-corrected daily metrics in wide form."""
    dense = spine.densify(facts.period_facts(items, keys), keys, start=start)
    fixed = repair.repair(dense, keys, facts.METRICS, trend)
    values = [F.max(F.when(F.col("metric") == m, F.col("fixed"))).alias(m) for m in facts.METRICS]
    return fixed.groupBy(*keys, "ds", "t", "is_padding").agg(*values)


def compare_models(
    split: DataFrame, keys: list[str], horizon: int, season: int = 1
) -> DataFrame:
    """Damped trend and automatic ARIMA scored on the hold-out of a labelled series."""
    train = split.where("split = 'train'")
    packed = spine.pack(train, keys)
    holt = smoothing.holt_forecast(smoothing.holt_fit(packed, keys), keys, horizon)
    best = arima.forecast(arima.auto(packed, keys, horizon), keys)
    # one label for all orders, so that models compare across series
    best = best.withColumn("model", F.lit("arima"))
    forecasts = holt.unionByName(best).withColumnRenamed("mean", "forecast")
    actuals = split.where("split = 'valid'").withColumnRenamed("value", "actual")
    scored = evaluate.match_actuals(forecasts, actuals, keys).withColumn("split", F.lit("valid"))
    return evaluate.accuracy(scored, train.withColumnRenamed("value", "actual"), keys, season)


def forecast_by_profile(
    items: DataFrame, sales: DataFrame, horizon: int = 4, k: int = 3, tasks: int | None = None
) -> DataFrame:
    """Forecast of monthly orders per supplier profile, with the growth verdict.

    ``items`` carries the features of the KPIs; ``sales`` the same rows with
    only seller, date and price, so that the series need none of their joins.
    ``tasks`` is the number of partitions of the KPI step.
    """
    labels = materialize(profile_sellers(items, k, tasks).select("seller_id", "cluster"), "labels")
    labelled = features.with_cluster(sales, labels).where("cluster IS NOT NULL")
    daily = clean_daily(labelled, CLUSTER)
    dense = spine.densify(facts.monthly_rollup(daily, CLUSTER), CLUSTER, "month")
    packed = spine.pack(dense, CLUSTER, "orders")
    paths = smoothing.holt_forecast(smoothing.holt_fit(packed, CLUSTER), CLUSTER, horizon)
    verdict = evaluate.growth_verdict(paths, packed, CLUSTER)
    return paths.join(verdict.select("cluster", "last_actual", "verdict"), "cluster")
