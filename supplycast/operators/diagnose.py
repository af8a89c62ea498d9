"""Residual and stationarity diagnostics on packed series (one row per series)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplycast.functions.stats import array_total, chi2_sf


def _demeaned(ys: Column) -> Column:
    mean = array_total(ys) / F.size(ys)
    return F.transform(ys, lambda y: y - mean)


def lag_product(values: Column, lag: Column) -> Column:
    """Sum of products of the values with themselves ``lag`` steps earlier."""
    length = F.greatest(F.size(values) - lag, F.lit(0))
    return array_total(
        F.zip_with(
            F.slice(values, lag + 1, length), F.slice(values, F.lit(1), length), lambda a, b: a * b
        )
    )


def autocorrelations(packed: DataFrame, max_lag: Column) -> DataFrame:
    """Adds ``n``, the lag bound ``_lags`` and the array ``_r`` of autocorrelations."""
    centred = packed.withColumn("_e", _demeaned(F.col("ys"))).withColumns(
        {"n": F.size("ys"), "_lags": F.least(max_lag, F.size("ys") - 1).cast("int")}
    )
    total = lag_product(F.col("_e"), F.lit(0))
    r = F.when(F.col("_lags") >= 1, F.transform(
        F.sequence(F.lit(1), F.greatest(F.col("_lags"), F.lit(1))),
        lambda k: F.try_divide(lag_product(F.col("_e"), k), total),
    ))
    return centred.withColumn("_r", r)


def acf(packed: DataFrame, keys: list[str], max_lag: int) -> DataFrame:
    """Autocorrelation per lag with the white-noise bound 1.96 / sqrt(n)."""
    r = autocorrelations(packed, F.lit(max_lag))
    return r.select(*keys, "n", F.posexplode("_r").alias("_pos", "acf")).select(
        *keys,
        (F.col("_pos") + 1).alias("lag"),
        "acf",
        (1.96 / F.sqrt(F.col("n").cast("double"))).alias("bound"),
    )


def ljung_box(
    packed: DataFrame, keys: list[str], freq: int = 1, fit_df: int = 0
) -> DataFrame:
    """Portmanteau test; min(10, n/5) lags, min(2 freq, n/5) for seasonal series."""
    most = 2 * freq if freq > 1 else 10
    lags = F.least(F.lit(most), F.floor(F.size("ys") / 5)).cast("int")
    r = autocorrelations(packed, lags).withColumn("_n", F.col("n").cast("double"))
    terms = F.transform("_r", lambda x, i: x * x / (F.col("_n") - 1 - i))
    q = F.col("_n") * (F.col("_n") + 2) * array_total(terms)
    tested = r.select(
        *keys, "n", F.col("_lags").alias("lag"), q.alias("q"), (F.col("_lags") - fit_df).alias("df")
    )
    return tested.withColumn("p_value", chi2_sf(F.col("q"), F.col("df")))


def residual_histogram(
    residuals: DataFrame, keys: list[str], value: str = "residual", bins: int = 10
) -> DataFrame:
    """Counts in ``bins`` equal ranges between the extremes of each series."""
    extent = residuals.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    share = F.try_divide(F.col(value) - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    cell = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * bins), F.lit(bins - 1)) + 1
    return (
        residuals.where(F.col(value).isNotNull())
        .join(extent, keys)
        .groupBy(*keys, cell.alias("bin"))
        .agg(F.count("*").alias("n"))
    )


def residual_moments(residuals: DataFrame, keys: list[str], value: str = "residual") -> DataFrame:
    return residuals.groupBy(*keys).agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("sd"),
        F.skewness(value).alias("skewness"),
        F.kurtosis(value).alias("excess_kurtosis"),
    )


# Critical values of the level-stationarity test
# (Kwiatkowski, Phillips, Schmidt and Shin 1992).
KPSS_CRITICAL = {"cv_10": 0.347, "cv_05": 0.463, "cv_025": 0.574, "cv_01": 0.739}


def kpss_statistic(ys: Column) -> Column:
    """Level statistic with the short lag 4 (n/100)^(1/4) and Bartlett weights."""
    n = F.size(ys).cast("double")
    e = _demeaned(ys)
    lags = F.floor(4 * F.pow(n / 100, F.lit(0.25))).cast("int")
    partial = F.aggregate(
        e,
        F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("total")),
        lambda a, x: F.struct(
            (a["s"] + x).alias("s"), (a["total"] + (a["s"] + x) * (a["s"] + x)).alias("total")
        ),
        lambda a: a["total"],
    )
    weighted = F.transform(
        F.filter(F.sequence(F.lit(0), lags), lambda k: k > 0),
        lambda k: (1 - k / (lags + 1)) * lag_product(e, k),
    )
    variance = (lag_product(e, F.lit(0)) + 2 * array_total(weighted)) / n
    return F.try_divide(partial / (n * n), variance)


def kpss(packed: DataFrame, keys: list[str]) -> DataFrame:
    n = F.size("ys")
    return packed.select(
        *keys,
        n.alias("n"),
        F.floor(4 * F.pow(n / 100, F.lit(0.25))).cast("int").alias("lags"),
        kpss_statistic(F.col("ys")).alias("statistic"),
        *[F.lit(v).alias(name) for name, v in KPSS_CRITICAL.items()],
    ).withColumn("stationary_05", F.col("statistic") < F.col("cv_05"))


def difference(ys: Column, lag: int = 1) -> Column:
    length = F.greatest(F.size(ys) - lag, F.lit(0))
    return F.zip_with(
        F.slice(ys, F.lit(lag + 1), length), F.slice(ys, F.lit(1), length), lambda a, b: a - b
    )


def difference_order(packed: DataFrame, column: str = "ys", most: int = 2) -> DataFrame:
    """Adds ``d``: differences needed until the level test no longer rejects."""
    out = packed.withColumns({"_z": F.col(column), "d": F.lit(0), "_open": F.lit(True)})
    for _ in range(most):
        reject = F.col("_open") & F.coalesce(
            kpss_statistic(F.col("_z")) > KPSS_CRITICAL["cv_05"], F.lit(False)
        )
        out = out.withColumn("_open", reject).withColumns(
            {
                "d": F.col("d") + F.col("_open").cast("int"),
                "_z": F.when(F.col("_open"), difference(F.col("_z"))).otherwise(F.col("_z")),
            }
        )
    return out.drop("_z", "_open")


def seasonal_strength(packed: DataFrame, freq: int, column: str = "ys") -> DataFrame:
    """Adds ``strength``: share of the detrended variance due to the phase means.

    The trend is the centred moving average over one cycle; NULL for series of
    fewer than two cycles.
    """
    half = freq // 2
    ys, n = F.col(column), F.size(column)

    def detrended(t: Column) -> Column:
        window = array_total(F.slice(ys, t - half, 2 * half + 1))
        if freq % 2 == 0:
            window -= (F.element_at(ys, t - half) + F.element_at(ys, t + half)) / 2
        return F.struct(
            (t % freq).alias("phase"), (F.element_at(ys, t) - window / freq).alias("d")
        )

    enough = n >= 2 * freq
    middle = F.sequence(F.lit(half + 1), F.greatest(n - half, F.lit(half + 1)))
    points = packed.withColumn("_pts", F.when(enough, F.transform(middle, detrended)))

    def phase_mean(phase: Column) -> Column:
        inside = F.transform(F.filter("_pts", lambda p: p["phase"] == phase), lambda p: p["d"])
        return F.try_divide(array_total(inside), F.size(inside))

    means = points.withColumn(
        "_means", F.transform(F.sequence(F.lit(0), F.lit(freq - 1)), phase_mean)
    )
    rest = F.transform("_pts", lambda p: p["d"] - F.element_at("_means", (p["phase"] + 1).cast("int")))

    def spread(values: Column) -> Column:
        return array_total(F.transform(_demeaned(values), lambda e: e * e))

    share = 1 - F.try_divide(spread(rest), spread(F.transform("_pts", lambda p: p["d"])))
    return means.withColumn("strength", F.greatest(share, F.lit(0.0))).drop("_pts", "_means")
