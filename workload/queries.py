"""One query per operator, over the whole star-schema tables.

Every query takes the session and the folder of the parquet tables.  Doubles
whose last digits depend on the order of summation are cut by ``q4``; dates are
given as ISO text, so that results compare across engines.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supplycast.operators import (
    arima,
    audit,
    boxcox,
    cluster,
    dealing,
    decompose,
    diagnose,
    evaluate,
    facts,
    features,
    kpi,
    quantiles,
    repair,
    smoothing,
    spine,
    tables,
)
from supplycast.plans import jobs
from supplycast.sources import csv2, marketplace, schemas
from supplycast.sources.scratch import materialize, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CLUSTER = ["cluster"]
MONTHS_VALID = 12
SHORT_VALID = 3
DAYS_VALID = 17
DAYS_ARIMA = 12
BOUNDS = ("mean", "lo_80", "hi_80", "lo_95", "hi_95")
FIT = ("alpha", "beta", "level", "trend", "sse", "sigma2", "aic", "aicc", "bic")


def query(function: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return iso(function(spark, folder))

    QUERIES[function.__name__] = run
    return run


def q4(x: Column) -> Column:
    """Four decimals, cut off the decimal lattice so that ties cannot differ."""
    return F.floor(x * 10000 + 0.4863) / 10000


def cut(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: q4(F.col(c)) for c in columns})


def iso(df: DataFrame) -> DataFrame:
    dates = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]
    return df.withColumns({c: F.col(c).cast("string") for c in dates}) if dates else df


# -- inputs ---------------------------------------------------------------------------------


def kpi_items(spark: SparkSession, folder: str) -> DataFrame:
    items = marketplace.order_items(spark, folder, category=True, places=True)
    return features.recode_category(features.delivery_distance(features.logistics(items)))


def item_tasks(spark: SparkSession, folder: str) -> int:
    """Partitions for steps that hold every item; the count comes from the file footers."""
    return dealing.tasks_for(spark, marketplace.table(spark, folder, "lineitem").count())


def shelf_kpis(spark: SparkSession, folder: str) -> DataFrame:
    return kpi.seller_category_kpis(kpi_items(spark, folder), item_tasks(spark, folder))


def kpi_table(spark: SparkSession, folder: str) -> DataFrame:
    return kpi.complete_cases(kpi.seller_kpis(shelf_kpis(spark, folder)))


def written_kpis(spark: SparkSession, folder: str) -> DataFrame:
    """KPIs as a table, for queries that read them more than once."""
    return materialize(kpi_table(spark, folder), "kpis")


def labelled_items(spark: SparkSession, folder: str, category: bool = False) -> DataFrame:
    items = marketplace.order_items(spark, folder, category=category)
    return items.withColumn("cluster", marketplace.cluster_label(F.col("seller_id"))).where(
        "cluster IS NOT NULL"
    )


def daily(spark: SparkSession, folder: str) -> DataFrame:
    return facts.period_facts(labelled_items(spark, folder), CLUSTER)


def dense_daily(spark: SparkSession, folder: str) -> DataFrame:
    return spine.densify(daily(spark, folder), CLUSTER)


def monthly(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly number of items per cluster: ``(cluster, ds, t, value)``."""
    by_month = facts.period_facts(labelled_items(spark, folder), CLUSTER, grain="month")
    dense = spine.densify(by_month, CLUSTER, "month")
    return dense.select("cluster", "ds", "t", F.col("orders").alias("value"))


def seller_monthly(spark: SparkSession, folder: str) -> DataFrame:
    """Gap-free monthly number of items of every seller."""
    items = marketplace.order_items(spark, folder)
    by_month = facts.period_facts(items, ["seller_id"], grain="month")
    dense = spine.densify(by_month, ["seller_id"], "month")
    filled = repair.interpolate(dense, ["seller_id"], "orders")
    return filled.select("seller_id", "ds", "t", F.col("filled").alias("value"))


def filled_daily(spark: SparkSession, folder: str) -> DataFrame:
    """Gap-free daily number of items per cluster: ``(cluster, ds, t, value)``."""
    filled = repair.interpolate(dense_daily(spark, folder), CLUSTER, "orders")
    return filled.select("cluster", "ds", "t", F.col("filled").alias("value"))


def packed_monthly(spark: SparkSession, folder: str) -> DataFrame:
    return spine.pack(monthly(spark, folder), CLUSTER)


def trend_residuals(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = decompose.polynomial_trend(monthly(spark, folder), CLUSTER, 1)
    return rows


def train_valid(spark: SparkSession, folder: str) -> DataFrame:
    return spine.split_last(monthly(spark, folder), CLUSTER, MONTHS_VALID)


def training(spark: SparkSession, folder: str) -> DataFrame:
    return train_valid(spark, folder).where("split = 'train'")


# -- sources and sinks ----------------------------------------------------------------------


@query
def csv_items(spark, folder):
    """Clustered items written and read back in the decimal-comma dialect."""
    items = features.delivery_distance(
        features.logistics(marketplace.order_items(spark, folder, category=True, places=True))
    ).withColumn("cluster", marketplace.cluster_label(F.col("seller_id")))
    typed = items.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.CLUSTERED_ITEMS.fields]
    )
    path = scratch_path(spark, "clustered_items")
    csv2.write_csv2(typed, path)
    back = csv2.read_csv2(spark, path, schemas.CLUSTERED_ITEMS)
    days = {c: F.col(c).cast("date") for c in ("dt_purchase", "dt_approved")}
    return cut(back.withColumns(days), "distance")


def _written_series(spark, frame, date_format):
    path = scratch_path(spark, "series")
    csv2.write_csv2(
        frame, path, row_number="t", date_format=date_format, partition_by=("cluster",)
    )
    return csv2.read_csv2(
        spark, path, schemas.SERIES, row_number=True, date_format=date_format,
        partition_by=("cluster",),
    )


@query
def csv_daily_series(spark, folder):
    """Daily series files, row-number column skipped on reading."""
    frame = dense_daily(spark, folder).select(
        "t", F.col("ds").alias("dates"), *facts.METRICS, "cluster"
    )
    return _written_series(spark, frame, csv2.DATE_FORMAT)


@query
def csv_monthly_series(spark, folder):
    """Monthly series files with Portuguese month names."""
    by_month = facts.period_facts(labelled_items(spark, folder), CLUSTER, grain="month")
    frame = spine.densify(by_month, CLUSTER, "month").select(
        "t", F.col("ds").alias("dates"), *facts.METRICS, "cluster"
    )
    return _written_series(spark, frame, csv2.MONTH_FORMAT)


@query
def series_sink(spark, folder):
    """Daily and monthly facts in one table partitioned by grain and cluster."""
    items = labelled_items(spark, folder)
    path = scratch_path(spark, "facts")
    csv2.write_series(
        facts.period_facts(items, CLUSTER)
        .withColumn("grain", F.lit("daily"))
        .unionByName(
            facts.period_facts(items, CLUSTER, grain="month").withColumn("grain", F.lit("monthly"))
        ),
        path,
    )
    back = spark.read.parquet(path)
    return back.groupBy("grain", F.col("cluster").cast("string").alias("cluster")).agg(
        F.count("*").alias("n"),
        F.sum("orders").alias("orders"),
        F.min("ds").alias("first_day"),
        F.max("ds").alias("last_day"),
    )


# -- projections and filters ----------------------------------------------------------------


@query
def item_projection(spark, folder):
    """Column choice, null filter, inclusive date range, recode, date parts."""
    items = labelled_items(spark, folder, category=True)
    day = F.col("dt_purchase")
    return (
        features.recode_category(items)
        .where(day.between(F.lit("1997-01-01").cast("date"), F.lit("1998-08-29").cast("date")))
        .drop("freight_value", "review_score")
        .select(
            "order_id", "order_item_id", "seller_id", "category", "cluster", "price",
            day.alias("order_date"),
            F.trunc(day, "MM").alias("month"),
            F.year(day).alias("year"),
            F.month(day).alias("month_number"),
            F.dayofyear(day).alias("day_of_year"),
            F.concat_ws(" ", F.lit("cluster"), "cluster").alias("label"),
        )
    )


@query
def excluded_items(spark, folder):
    """Items without the spike seller-days: days on which a seller sold most."""
    items = marketplace.order_items(spark, folder)
    per_day = items.groupBy("seller_id", "dt_purchase").agg(F.count("*").alias("n"))
    spikes = per_day.where("n >= 5").drop("n")
    kept = features.exclude(items, spikes, ["seller_id", "dt_purchase"])
    return kept.where(F.col("price") > 0).groupBy("seller_id").agg(F.count("*").alias("n"))


@query
def delivered_scope(spark, folder):
    """Delivered orders from January 1997 on."""
    orders = marketplace.orders(spark, folder)
    return orders.where(
        (F.col("status") == "delivered") & (F.col("dt_purchase") >= F.lit("1997-01-01").cast("date"))
    ).select("order_id", "customer_id", "status", "dt_purchase")


@query
def zscore_series(spark, folder):
    scaled = jobs.scaled_series(dense_daily(spark, folder), CLUSTER, ["orders", "revenue"])
    return cut(scaled.select("cluster", "ds", "s_orders", "s_revenue"), "s_orders", "s_revenue")


@query
def completeness(spark, folder):
    """Items before and after the complete-case filter, category not yet recoded."""
    items = marketplace.order_items(spark, folder, category=True)
    return kpi.completeness(items, ["order_id", "seller_id", "category", "price", "dt_purchase"])


# -- features -------------------------------------------------------------------------------


@query
def order_features(spark, folder):
    items = features.logistics(marketplace.order_items(spark, folder))
    return items.select(
        "order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value",
        "est_delivery_days", "days_to_deliver", "days_approved", "days_shipping",
        "delayed_shipping", "late_delivery", "late_vs_estimate_date",
    )


@query
def delivery_distance(spark, folder):
    items = features.delivery_distance(marketplace.order_items(spark, folder, places=True))
    pairs = items.groupBy("seller_zip", "customer_zip").agg(
        F.count("*").alias("n"), F.max("distance").alias("distance")
    )
    return cut(pairs, "distance")


@query
def postal_points(spark, folder):
    return cut(features.postal_points(marketplace.geolocation(spark, folder)), "lat", "lng")


@query
def assembled_items(spark, folder):
    """All eight tables; reviews and payments reduced before the join."""
    m = marketplace
    out = features.assemble(
        m.items(spark, folder),
        m.orders(spark, folder),
        customers=m.customers(spark, folder),
        sellers=m.sellers(spark, folder),
        products=m.products(spark, folder),
        reviews=m.reviews(spark, folder),
        payments=m.payments(spark, folder),
        points=features.postal_points(m.geolocation(spark, folder)),
    )
    out = features.delivery_distance(out).select(
        "order_id", "order_item_id", "product_id", "seller_id", "customer_id", "category",
        "price", "dt_shipped", "review_score", "n_reviews", "paid", "n_payments", "seller_zip",
        "customer_zip", "distance",
    )
    return cut(out, "distance")


# -- joins ----------------------------------------------------------------------------------


@query
def items_with_category(spark, folder):
    items = marketplace.items(spark, folder).select("order_id", "product_id", "seller_id", "price")
    return features.recode_category(
        features.with_category(items, marketplace.products(spark, folder))
    )


@query
def items_with_cluster(spark, folder):
    """Cluster and category written back to the items; sellers without one keep NULL."""
    items = marketplace.items(spark, folder).select("order_id", "product_id", "seller_id", "price")
    labels = marketplace.sellers(spark, folder).select(
        "seller_id", marketplace.cluster_label(F.col("seller_id")).alias("cluster")
    )
    labels = labels.where("cluster IS NOT NULL")
    return features.with_category(
        features.with_cluster(items, labels), marketplace.products(spark, folder)
    )


@query
def spine_join(spark, folder):
    return dense_daily(spark, folder).select("cluster", "ds", "t", *facts.METRICS, "is_padding")


@query
def merged_metrics(spark, folder):
    """Metrics aggregated apart and joined on the time index."""
    by_day = daily(spark, folder)
    parts = [by_day.select("cluster", "ds", m) for m in facts.METRICS]
    return facts.merge_metrics(parts, ["cluster", "ds"])


@query
def forecast_vs_actual(spark, folder):
    series = monthly(spark, folder)
    actuals = series.withColumnRenamed("value", "actual")
    forecast = series.withColumn(
        "forecast", decompose.trailing_mean(F.col("value"), CLUSTER, 3)
    )
    rows = forecast.where("forecast IS NOT NULL").select("cluster", "ds", "t", "forecast")
    return cut(evaluate.match_actuals(rows, actuals, CLUSTER), "forecast")


# -- aggregations ---------------------------------------------------------------------------


@query
def seller_category_kpis(spark, folder):
    shelves = kpi.flat(shelf_kpis(spark, folder))
    return cut(
        shelves.withColumn("revenue", F.col("revenue").cast("double")),
        "mean_price", *kpi.SERVICE.values(),
    )


@query
def seller_kpis(spark, folder):
    return cut(
        kpi_table(spark, folder),
        "avg_price", "price_range", "avg_shipping", "avg_score", "avg_distance", "pct_delayed",
    )


@query
def daily_facts(spark, folder):
    tasks = item_tasks(spark, folder)
    return facts.period_facts(
        labelled_items(spark, folder), CLUSTER, distinct_orders=True, tasks=tasks
    )


@query
def daily_facts_by_category(spark, folder):
    items = features.recode_category(labelled_items(spark, folder, category=True))
    return facts.period_facts(items, ["cluster", "category"])


@query
def monthly_facts_by_category(spark, folder):
    items = features.recode_category(labelled_items(spark, folder, category=True))
    return facts.period_facts(items, ["cluster", "category"], grain="month")


@query
def monthly_rollup(spark, folder):
    rolled = facts.monthly_rollup(daily(spark, folder), CLUSTER)
    return cut(rolled, "avg_price_sum", "avg_price_mean", "price_ratio", "revenue")


@query
def weekly_apply(spark, folder):
    how = {"orders": "sum", "avg_price": "mean", "revenue": "sum"}
    return cut(
        facts.resample(daily(spark, folder), CLUSTER, "week", how), "avg_price", "revenue"
    )


@query
def monthly_apply(spark, folder):
    how = {"orders": "mean", "avg_price": "mean", "revenue": "mean"}
    return cut(
        facts.resample(daily(spark, folder), CLUSTER, "month", how),
        "orders", "avg_price", "revenue",
    )


@query
def orders_by_date(spark, folder):
    return facts.total_by_day(daily(spark, folder))


@query
def kpi_correlation(spark, folder):
    return cut(tables.correlation(kpi_table(spark, folder), kpi.KPI_COLUMNS), "r")


@query
def series_correlation(spark, folder):
    return cut(tables.correlation(daily(spark, folder), facts.METRICS, CLUSTER), "r")


@query
def category_frequency(spark, folder):
    items = marketplace.order_items(spark, folder, category=True)
    return tables.frequency(features.recode_category(items), "category")


@query
def status_by_score(spark, folder):
    return tables.contingency(marketplace.orders(spark, folder), "status", "review_score")


@query
def kpi_boxstats(spark, folder):
    labelled = written_kpis(spark, folder).withColumn(
        "cluster", marketplace.cluster_label(F.col("seller_id"))
    )
    boxes = quantiles.box_stats(
        labelled.where("cluster IS NOT NULL AND avg_shipping >= 0"),
        CLUSTER,
        ["n_orders", *cluster.FEATURES],
    )
    return cut(boxes, "q1", "median", "q3", "whisker_low", "whisker_high")


# -- audits ---------------------------------------------------------------------------------


@query
def granularity(spark, folder):
    """Distinct entities of every table, sold or not; postal codes stand in for cities."""
    m = marketplace
    parts = [
        audit.granularity(m.orders(spark, folder), ["order_id"]),
        audit.granularity(m.customers(spark, folder), ["customer_id", "customer_zip"]),
        audit.granularity(m.sellers(spark, folder), ["seller_id", "seller_zip"]),
        audit.granularity(m.products(spark, folder), ["product_id", "category"]),
        audit.granularity(m.zip_points(spark, folder), ["zip", "region"]),
    ]
    return functools.reduce(DataFrame.unionByName, parts)


@query
def time_extent(spark, folder):
    return audit.time_extent(marketplace.orders(spark, folder), "dt_purchase")


@query
def missing_profile(spark, folder):
    """All columns of all eight tables."""
    m = marketplace
    tables_of = {
        "customers": m.customers,
        "sellers": m.sellers,
        "products": m.products,
        "orders": m.orders,
        "items": m.items,
        "reviews": m.reviews,
        "payments": m.payments,
        "geolocation": m.geolocation,
    }
    return audit.missing_profile({name: read(spark, folder) for name, read in tables_of.items()})


@query
def status_share(spark, folder):
    return tables.frequency(marketplace.orders(spark, folder), "status")


@query
def volume_spikes(spark, folder):
    return cut(audit.volume_spikes(marketplace.orders(spark, folder), 1.5), "ratio")


@query
def region_month_revenue(spark, folder):
    return audit.revenue_by_month(marketplace.order_items(spark, folder, places=True))


@query
def state_month_revenue(spark, folder):
    """Revenue below the region: nations stand in for states."""
    items = marketplace.order_items(spark, folder, places=True)
    return audit.revenue_by_month(items, "customer_zip")


@query
def process_violations(spark, folder):
    rows = audit.violations(marketplace.order_items(spark, folder))
    return rows.select("order_id", "product_id", "seller_id", "price", "violation")


@query
def violation_counts(spark, folder):
    return audit.violation_counts(marketplace.order_items(spark, folder))


@query
def late_by_review(spark, folder):
    items = features.logistics(marketplace.order_items(spark, folder))
    return tables.contingency(items, "late_delivery", "review_score")


@query
def places_by_region(spark, folder):
    m = marketplace
    return audit.count_by_place(
        m.customers(spark, folder), m.sellers(spark, folder), m.zip_points(spark, folder)
    )


@query
def distance_delay_trend(spark, folder):
    items = features.logistics(marketplace.order_items(spark, folder, places=True))
    return cut(
        audit.distance_trend(features.delivery_distance(items)), "slope", "intercept", "r"
    )


@query
def distance_delay_spread(spark, folder):
    items = features.logistics(marketplace.order_items(spark, folder, places=True))
    return cut(audit.distance_spread(features.delivery_distance(items)), "mean_days", "sd_days")


@query
def price_freight_outliers(spark, folder):
    items = marketplace.items(spark, folder)
    flagged = quantiles.flag_outliers(items, ["price", "freight_value"])
    return cut(flagged, "q1", "median", "q3", "whisker_low", "whisker_high", "share")


# -- windows and series preparation ---------------------------------------------------------


@query
def daily_spine(spark, folder):
    return spine.spine(daily(spark, folder), CLUSTER)


@query
def padded_spine(spark, folder):
    """Calendar begun before the data, with the early days marked as padding."""
    padded = spine.densify(daily(spark, folder), CLUSTER, start="1994-08-29")
    return padded.select("cluster", "ds", "t", "orders", "is_padding")


@query
def monthly_spine(spark, folder):
    items = marketplace.order_items(spark, folder)
    by_month = facts.period_facts(items, ["seller_id"], grain="month")
    return spine.densify(by_month, ["seller_id"], "month").select("seller_id", "ds", "t", "orders")


@query
def time_slices(spark, folder):
    part = spine.time_slice(dense_daily(spark, folder), "1997-03-01", "1997-12-31")
    return part.select("cluster", "ds", "t", "orders")


@query
def train_valid_split(spark, folder):
    return train_valid(spark, folder)


@query
def train_valid_overlap(spark, folder):
    """Split at a month that belongs to both parts."""
    return spine.split_at(monthly(spark, folder), "1996-08-01", "2001-05-01", overlap=True)


@query
def seasonal_diff(spark, folder):
    out = spine.seasonal_diff(dense_daily(spark, folder), CLUSTER, 7, "orders")
    return out.select("cluster", "ds", "diff")


@query
def moving_average(spark, folder):
    series = dense_daily(spark, folder).withColumn("value", F.coalesce("orders", F.lit(0.0)))
    out = series.withColumns(
        {
            "ma_30": decompose.moving_average(F.col("value"), CLUSTER, 30),
            "ma_7": decompose.moving_average(F.col("value"), CLUSTER, 7),
            "ma_2": decompose.moving_average(F.col("value"), CLUSTER, 2),
        }
    )
    return cut(out.select("cluster", "ds", "ma_30", "ma_7", "ma_2"), "ma_30", "ma_7", "ma_2")


@query
def interpolate(spark, folder):
    items = marketplace.order_items(spark, folder)
    by_month = facts.period_facts(items, ["seller_id"], grain="month")
    padded = spine.densify(by_month, ["seller_id"], "month", start="1994-08-01")
    out = repair.interpolate(padded, ["seller_id"], "revenue")
    return cut(out.select("seller_id", "ds", "t", "filled", "is_imputed"), "filled")


@query
def outlier_median(spark, folder):
    filled = repair.interpolate(dense_daily(spark, folder), CLUSTER, "orders")
    out = repair.median_outliers(filled, CLUSTER, "filled")
    return cut(out.select("cluster", "ds", "t", "filled", "fixed", "is_outlier"), "filled", "fixed")


@query
def outlier_supersmooth(spark, folder):
    filled = repair.interpolate(dense_daily(spark, folder), CLUSTER, "orders")
    out = repair.smooth_outliers(filled, CLUSTER, "filled")
    return cut(out.select("cluster", "ds", "t", "filled", "fixed", "is_outlier"), "filled", "fixed")


@query
def series_repair(spark, folder):
    """Raw and corrected values of all metrics side by side."""
    out = repair.repair(dense_daily(spark, folder), CLUSTER, facts.METRICS)
    return cut(out.drop("is_padding"), "raw", "fixed")


@query
def time_index(spark, folder):
    begin = F.lit("1995-01-01").cast("date")
    dense = dense_daily(spark, folder)
    indexed = spine.time_index(dense, 365, F.dayofyear(begin), F.year(begin))
    return cut(indexed.select("cluster", "ds", "t", "phase", "decimal_time"), "decimal_time")


@query
def fourier_regressors(spark, folder):
    """Fourier terms at a frequency that is not a whole number."""
    terms = decompose.fourier_terms(F.col("t").cast("double"), 241 / 8, 2)
    rows = dense_daily(spark, folder).withColumns(terms)
    return cut(rows.select("cluster", "ds", *terms), *terms)


@query
def unpivoted_series(spark, folder):
    return quantiles.unpivot(dense_daily(spark, folder), ["cluster", "ds"], facts.METRICS)


# -- decomposition and regression -----------------------------------------------------------


@query
def fourier_decompose(spark, folder):
    out = decompose.fourier_decompose(monthly(spark, folder), CLUSTER, 12, 3)
    return cut(out, "trend", "season", "remainder")


@query
def fourier_decompose_daily(spark, folder):
    out = decompose.fourier_decompose(filled_daily(spark, folder), CLUSTER, 365, 7)
    return cut(out, "trend", "season", "remainder")


@query
def linear_trend(spark, folder):
    fits = decompose.linear_trend(monthly(spark, folder), CLUSTER)
    return cut(fits, "slope", "intercept", "r2", "sigma2")


@query
def quadratic_trend(spark, folder):
    rows, _ = decompose.polynomial_trend(monthly(spark, folder), CLUSTER, 2)
    return cut(rows.select("cluster", "ds", "fitted", "residual"), "fitted", "residual")


@query
def polynomial_criteria(spark, folder):
    """Degrees one to four and the exponential trend side by side."""
    series = monthly(spark, folder)
    forms = {f"degree_{d}": (d, False) for d in range(1, 5)} | {"exponential": (1, True)}
    out = None
    for name, (degree, log) in forms.items():
        _, summary = decompose.polynomial_trend(series, CLUSTER, degree, log=log)
        part = summary.withColumn("form", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return cut(out, "sse", "r2", "aic", "aicc")


@query
def classical_additive(spark, folder):
    out = decompose.classical(monthly(spark, folder), CLUSTER, 12)
    parts = ["trend", "seasonal", "remainder"]
    return cut(out.select("cluster", "ds", "value", *parts), *parts)


@query
def classical_multiplicative(spark, folder):
    out = decompose.classical(monthly(spark, folder), CLUSTER, 12, "multiplicative")
    parts = ["trend", "seasonal", "remainder"]
    return cut(out.select("cluster", "ds", "value", *parts), *parts)


@query
def stl_decompose(spark, folder):
    return decompose.stl_decompose(monthly(spark, folder), CLUSTER, 12)


@query
def ar_spectrum(spark, folder):
    """Dominant period by the autoregressive spectrum, per seller."""
    out = decompose.autoregressive_spectrum(seller_monthly(spark, folder), ["seller_id"])
    return cut(out, "density")


@query
def dominant_period(spark, folder):
    return cut(decompose.dominant_period(monthly(spark, folder), CLUSTER), "power", "period")


# -- diagnostics ----------------------------------------------------------------------------


@query
def acf(spark, folder):
    packed = spine.pack(trend_residuals(spark, folder), CLUSTER, "residual")
    return cut(diagnose.acf(packed, CLUSTER, 24), "acf", "bound")


@query
def ljung_box(spark, folder):
    packed = spine.pack(trend_residuals(spark, folder), CLUSTER, "residual")
    return cut(diagnose.ljung_box(packed, CLUSTER, fit_df=2), "q", "p_value")


@query
def ljung_box_daily(spark, folder):
    """Residuals of the daily trend over up to two years of lags."""
    rows, _ = decompose.polynomial_trend(filled_daily(spark, folder), CLUSTER, 1)
    packed = spine.pack(rows, CLUSTER, "residual")
    return cut(diagnose.ljung_box(packed, CLUSTER, freq=365, fit_df=1), "q", "p_value")


@query
def residual_histogram(spark, folder):
    return diagnose.residual_histogram(trend_residuals(spark, folder), CLUSTER)


@query
def residual_moments(spark, folder):
    out = diagnose.residual_moments(trend_residuals(spark, folder), CLUSTER)
    return cut(out, "mean", "sd", "skewness", "excess_kurtosis")


@query
def kpss(spark, folder):
    out = diagnose.kpss(spine.pack(monthly(spark, folder), CLUSTER), CLUSTER)
    return cut(out, "statistic")


@query
def model_summary(spark, folder):
    packed = spine.pack(training(spark, folder), CLUSTER)
    return cut(smoothing.holt_fit(packed, CLUSTER).drop("ys", "fitted"), *FIT)


@query
def ljung_box_holt(spark, folder):
    """Residuals of the fitted damped trend; weights and start take four degrees of freedom."""
    fit = smoothing.holt_fit(spine.pack(training(spark, folder), CLUSTER), CLUSTER)
    packed = spine.pack(
        smoothing.fitted_rows(fit, CLUSTER), CLUSTER, value="residual", day="t"
    )
    return cut(diagnose.ljung_box(packed, CLUSTER, fit_df=4), "q", "p_value")


# -- forecasting ----------------------------------------------------------------------------


@query
def holt_fixed(spark, folder):
    out = smoothing.holt_fixed(packed_monthly(spark, folder), CLUSTER, 0.5, 0.1, 0.9)
    return cut(out.select("cluster", "n", "level", "trend", "sse"), "level", "trend", "sse")


@query
def holt_fixed_forecast(spark, folder):
    """Forecasts and bounds of the recursion with fixed weights, per seller."""
    packed = spine.pack(seller_monthly(spark, folder), ["seller_id"])
    run = smoothing.holt_fixed(packed, ["seller_id"], 0.5, 0.1, 0.9)
    out = smoothing.holt_forecast(run, ["seller_id"], 4).drop("model")
    return cut(out, "mean", "lo_80", "hi_80", "lo_95", "hi_95")


def _daily_holdout(spark, folder):
    """Daily series with its last days held out, and their forecast with fixed weights."""
    split = spine.split_last(filled_daily(spark, folder), CLUSTER, DAYS_VALID)
    packed = spine.pack(split.where("split = 'train'"), CLUSTER)
    run = smoothing.holt_fixed(packed, CLUSTER, 0.5, 0.1, 0.9)
    return split, smoothing.holt_forecast(run, CLUSTER, DAYS_VALID)


@query
def holt_daily(spark, folder):
    """Seventeen days ahead from all but the last seventeen, fixed weights."""
    _, out = _daily_holdout(spark, folder)
    return cut(out.drop("model"), "mean", "lo_80", "hi_80", "lo_95", "hi_95")


@query
def growth_verdict_fixed(spark, folder):
    """Direction of every seller's forecast with fixed weights."""
    packed = spine.pack(seller_monthly(spark, folder), ["seller_id"])
    run = smoothing.holt_fixed(packed, ["seller_id"], 0.5, 0.1, 0.9)
    paths = smoothing.holt_forecast(run, ["seller_id"], 4)
    out = evaluate.growth_verdict(paths, packed, ["seller_id"])
    return cut(out, "mean_forecast", "path_change", "last_actual")


@query
def holt_fit(spark, folder):
    """Damped Holt per seller: fitted parameters of many series at once."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = spine.pack(seller_monthly(spark, folder), ["seller_id"], tasks=tasks)
    return cut(smoothing.holt_fit(packed, ["seller_id"]).drop("ys", "fitted"), *FIT)


@query
def holt_forecast(spark, folder):
    fit = smoothing.holt_fit(spine.pack(training(spark, folder), CLUSTER), CLUSTER)
    return cut(smoothing.holt_forecast(fit, CLUSTER, MONTHS_VALID), *BOUNDS)


@query
def holt_forecast_short(spark, folder):
    """Three months ahead from all but the last three."""
    split = spine.split_last(monthly(spark, folder), CLUSTER, SHORT_VALID)
    fit = smoothing.holt_fit(spine.pack(split.where("split = 'train'"), CLUSTER), CLUSTER)
    return cut(smoothing.holt_forecast(fit, CLUSTER, SHORT_VALID), *BOUNDS)


@query
def holt_daily_fit(spark, folder):
    """Seventeen days ahead from all but the last seventeen, fitted weights."""
    split = spine.split_last(filled_daily(spark, folder), CLUSTER, DAYS_VALID)
    fit = smoothing.holt_fit(spine.pack(split.where("split = 'train'"), CLUSTER), CLUSTER)
    return cut(smoothing.holt_forecast(fit, CLUSTER, DAYS_VALID), *BOUNDS)


@query
def boxcox_lambda(spark, folder):
    return cut(boxcox.guerrero(monthly(spark, folder), CLUSTER, 12), "lambda")


@query
def boxcox_transform(spark, folder):
    lam = F.lit(0.3)
    rows = monthly(spark, folder).withColumn("z", boxcox.transform(F.col("value"), lam))
    return cut(rows.withColumn("back", boxcox.inverse(F.col("z"), lam)), "z", "back")


@query
def arima_auto(spark, folder):
    """Full search per cluster: chosen order, coefficients and criteria."""
    return arima.summary(
        arima.auto(spine.pack(training(spark, folder), CLUSTER), CLUSTER, MONTHS_VALID), CLUSTER
    )


@query
def arima_forecast(spark, folder):
    fit = arima.auto(spine.pack(training(spark, folder), CLUSTER), CLUSTER, MONTHS_VALID)
    return arima.forecast(fit, CLUSTER)


def _seller_arima(spark, folder):
    """First-order autoregression of the monthly changes of every seller."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = spine.pack(seller_monthly(spark, folder), ["seller_id"], tasks=tasks)
    return arima.fixed(packed, 4, (1, 1, 0))


@query
def arima_fixed(spark, folder):
    """Coefficient, its error and the criteria of a given order, per seller."""
    fit = _seller_arima(spark, folder).withColumns(
        {"phi": F.col("coefficients")[0], "std_error": F.col("std_errors")[0]}
    )
    numbers = ("phi", "std_error", "sigma2", "loglik", "aic", "aicc", "bic")
    return cut(fit.select("seller_id", "model", *numbers), *numbers)


@query
def arima_fixed_forecast(spark, folder):
    out = arima.forecast(_seller_arima(spark, folder), ["seller_id"])
    return cut(out.drop("model"), *BOUNDS)


@query
def ljung_box_arima(spark, folder):
    """Residuals of the given order, per seller; the coefficient takes one degree of freedom."""
    rows = arima.residual_rows(_seller_arima(spark, folder), ["seller_id"])
    packed = spine.pack(rows, ["seller_id"], value="residual", day="t")
    return cut(diagnose.ljung_box(packed, ["seller_id"], fit_df=1), "q", "p_value")


@query
def arima_daily(spark, folder):
    """Twelve days ahead on the Box-Cox scale, from all but the last seventeen days."""
    split = spine.split_last(filled_daily(spark, folder), CLUSTER, DAYS_VALID)
    fit = arima.auto_boxcox(split.where("split = 'train'"), CLUSTER, DAYS_ARIMA, 365)
    return arima.forecast(fit, [*CLUSTER, "lambda"])


@query
def arima_seasonal(spark, folder):
    """Search with seasonal terms and the seasonal differencing rule."""
    packed = spine.pack(training(spark, folder), CLUSTER)
    fit = arima.auto(packed, CLUSTER, MONTHS_VALID, freq=12, seasonal=True)
    return arima.summary(fit, CLUSTER)


@query
def seasonal_strength(spark, folder):
    out = diagnose.seasonal_strength(packed_monthly(spark, folder), 12)
    return cut(out.select("cluster", "strength"), "strength")


@query
def difference_order(spark, folder):
    """Differences asked for by the stationarity test, for the running total of items."""
    totals = monthly(spark, folder).withColumn(
        "value", F.sum("value").over(Window.partitionBy("cluster").orderBy("t"))
    )
    return diagnose.difference_order(spine.pack(totals, CLUSTER)).select("cluster", "d")


@query
def arima_boxcox_forecast(spark, folder):
    """Search on the Box-Cox scale, forecasts transformed back."""
    fit = arima.auto_boxcox(training(spark, folder), CLUSTER, MONTHS_VALID, 12)
    return arima.forecast(fit, [*CLUSTER, "lambda"])


@query
def ets_auto(spark, folder):
    fit = smoothing.ets_fit(spine.pack(training(spark, folder), CLUSTER), CLUSTER, 12)
    return fit.drop("ys")


@query
def ets_forecast(spark, folder):
    fit = smoothing.ets_fit(spine.pack(training(spark, folder), CLUSTER), CLUSTER, 12)
    return smoothing.ets_forecast(fit, CLUSTER, MONTHS_VALID, 12, levels=(0.8,))


@query
def moving_average_forecast(spark, folder):
    series = monthly(spark, folder)
    out = series.withColumn("forecast", decompose.trailing_mean(F.col("value"), CLUSTER, 6))
    return cut(out.select("cluster", "ds", "value", "forecast"), "forecast")


@query
def simple_smoothing(spark, folder):
    return cut(smoothing.ses_fixed(packed_monthly(spark, folder), CLUSTER, 0.3), "forecast")


# -- evaluation -----------------------------------------------------------------------------


def _scored(series):
    models = {"mean_3": 3, "mean_6": 6, "last_value": 1}
    out = None
    for name, order in models.items():
        part = series.withColumns(
            {
                "forecast": decompose.trailing_mean(F.col("value"), CLUSTER, order),
                "model": F.lit(name),
            }
        ).withColumnRenamed("value", "actual")
        out = part if out is None else out.unionByName(part)
    return out.where("forecast IS NOT NULL")


def _scores(spark, folder):
    series = train_valid(spark, folder)
    train = series.where("split = 'train'").withColumnRenamed("value", "actual")
    return evaluate.accuracy(_scored(series), train, CLUSTER, season=12)


SCORES = ("me", "rmse", "mae", "mpe", "mape", "acf1", "theils_u", "mase")


@query
def accuracy(spark, folder):
    return cut(_scores(spark, folder), *SCORES)


@query
def accuracy_daily(spark, folder):
    """Scores of the daily forecast on the days held out; weekly steps scale MASE."""
    split, paths = _daily_holdout(spark, folder)
    actual = split.withColumnRenamed("value", "actual")
    forecast = paths.select("cluster", "t", "model", F.col("mean").alias("forecast"))
    scored = actual.where("split = 'valid'").join(forecast, ["cluster", "t"])
    train = actual.where("split = 'train'")
    return cut(evaluate.accuracy(scored, train, CLUSTER, season=7), *SCORES)


@query
def best_model(spark, folder):
    return cut(evaluate.best_model(_scores(spark, folder), CLUSTER), "best_rmse")


@query
def holt_vs_arima(spark, folder):
    """Both fitted models scored on the hold-out, best one per cluster."""
    scores = jobs.compare_models(train_valid(spark, folder), CLUSTER, MONTHS_VALID, season=12)
    return evaluate.best_model(scores, CLUSTER)


@query
def overlay(spark, folder):
    """Training, fitted, forecast and validation rows of the damped trend."""
    split = train_valid(spark, folder)
    series = split.withColumnRenamed("value", "actual")
    fit = smoothing.holt_fit(spine.pack(split.where("split = 'train'"), CLUSTER), CLUSTER)
    return evaluate.overlay(
        CLUSTER,
        series,
        cut(smoothing.fitted_rows(fit, CLUSTER), "fitted"),
        cut(smoothing.holt_forecast(fit, CLUSTER, MONTHS_VALID), *BOUNDS),
    )


@query
def growth_verdict(spark, folder):
    """Final four-month forecast on the full series and its direction."""
    packed = packed_monthly(spark, folder)
    fit = smoothing.holt_fit(packed, CLUSTER)
    out = evaluate.growth_verdict(smoothing.holt_forecast(fit, CLUSTER, 4), packed, CLUSTER)
    return cut(out, "mean_forecast", "path_change", "last_actual")


# -- clustering -----------------------------------------------------------------------------

# Three fixed centres on the scaled features, for the SQL-checked labels.
CENTRES = [
    [-0.5, 0.0, -0.5, 0.0, -0.5, 0.0, -0.5],
    [0.0, 0.0, 0.5, 0.5, 0.0, 0.0, 0.5],
    [0.5, 0.0, 0.0, -0.5, 0.5, 0.0, 0.0],
]


def _assigned(spark, folder):
    z = [f"z_{c}" for c in cluster.FEATURES]
    return cluster.nearest_centre(cluster.zscore(written_kpis(spark, folder)), z, CENTRES)


@query
def seller_features_scaled(spark, folder):
    z = [f"z_{c}" for c in cluster.FEATURES]
    return cut(cluster.zscore(written_kpis(spark, folder)).select("seller_id", *z), *z)


@query
def cluster_assign(spark, folder):
    return _assigned(spark, folder).select("seller_id", "cluster")


@query
def cluster_profile(spark, folder):
    columns = ["n_orders", *cluster.FEATURES]
    means = [f"mean_{c}" for c in columns]
    return cut(cluster.profile(_assigned(spark, folder), "cluster", columns), *means)


@query
def cluster_agreement(spark, folder):
    both = _assigned(spark, folder).withColumn(
        "other", marketplace.cluster_label(F.col("seller_id"))
    )
    return cut(
        tables.adjusted_rand(both.where("other IS NOT NULL"), "cluster", "other"), "adjusted_rand"
    )


@query
def cluster_crosstab(spark, folder):
    both = _assigned(spark, folder).withColumn(
        "other", marketplace.cluster_label(F.col("seller_id"))
    )
    return tables.contingency(both.where("other IS NOT NULL"), "cluster", "other")


@query
def kmeans_sellers(spark, folder):
    vectors = cluster.with_vector(kpi_table(spark, folder))
    return cluster.kmeans_labels(vectors, 3).select("seller_id", "cluster")


@query
def choose_k(spark, folder):
    indices = cluster.choose_k(cluster.with_vector(kpi_table(spark, folder)))
    return indices.join(cluster.votes(indices), "k")


@query
def linkage_sellers(spark, folder):
    """Ward cut at six groups and centroid linkage cut at three."""
    vectors = cluster.with_vector(kpi_table(spark, folder))
    cuts = {"hc_ward": ("ward", 6), "hc_centroid": ("centroid", 3)}
    return cluster.hierarchical_labels(vectors, cuts).select("seller_id", *cuts)


# -- end to end -----------------------------------------------------------------------------


@query
def profile_forecast(spark, folder):
    """Items to KPIs, clusters, monthly series, damped forecast and verdict."""
    sales = marketplace.order_items(spark, folder)
    tasks = item_tasks(spark, folder)
    return jobs.forecast_by_profile(kpi_items(spark, folder), sales, tasks=tasks)
