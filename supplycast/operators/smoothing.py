"""Exponential smoothing on packed series.

A series is one row with its values in time order.  One run of the recursion is
an array fold inside that row; the search over many weights is an Arrow-batched
function (a fold per weight was measured fifty times slower).  Both are narrow
projections that run in parallel over series.
"""

from __future__ import annotations


import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplycast.functions import search
from supplycast.functions.stats import array_total, normal_quantile


def _damping_sum(phi: Column, h: Column) -> Column:
    """phi + phi^2 + ... + phi^h."""
    return F.when(phi == 1, h.cast("double")).otherwise(phi * (1 - F.pow(phi, h)) / (1 - phi))


# -- damped linear trend ------------------------------------------------------------------


def holt_fold(
    ys: Column, alpha: Column, beta: Column, phi: Column, level: Column, trend: Column
) -> Column:
    """Run the recursion from a given start: final level and trend, SSE, fitted values."""

    def step(a: Column, y: Column) -> Column:
        forecast = a["l"] + phi * a["b"]
        error = y - forecast
        return F.struct(
            (forecast + alpha * error).alias("l"),
            (phi * a["b"] + beta * error).alias("b"),
            (a["sse"] + error * error).alias("sse"),
            F.array_append(a["fitted"], forecast).alias("fitted"),
        )

    start = F.struct(
        level.cast("double").alias("l"),
        trend.cast("double").alias("b"),
        F.lit(0.0).alias("sse"),
        F.array().cast("array<double>").alias("fitted"),
    )
    return F.aggregate(ys, start, step)


def holt_fixed(
    packed: DataFrame, keys: list[str], alpha: float, beta: float, phi: float
) -> DataFrame:
    """Fixed parameters; starts at the first value with the first difference as trend.

    ``beta`` weights the change of level against the old trend, so that an error
    moves the trend by ``alpha * beta``.
    """
    a, b, p = F.lit(alpha), F.lit(alpha * beta), F.lit(phi)
    first, second = F.element_at("ys", 1), F.try_element_at(F.col("ys"), F.lit(2))
    rest = F.slice("ys", F.lit(2), F.greatest(F.size("ys") - 1, F.lit(0)))
    run = holt_fold(rest, a, b, p, first, F.coalesce(second - first, F.lit(0.0)))
    sse, n = F.col("_run.sse"), F.size("ys").cast("double")
    return packed.withColumn("_run", run).select(
        *keys,
        F.lit("holt_fixed").alias("model"),
        F.size("ys").alias("n"),
        a.alias("alpha"),
        b.alias("beta"),
        p.alias("phi"),
        F.col("_run.l").alias("level"),
        F.col("_run.b").alias("trend"),
        sse.alias("sse"),
        (sse / F.greatest(n - 1, F.lit(1.0))).alias("sigma2"),
        "last_ds",
        "last_t",
    )


def holt_fit(
    packed: DataFrame,
    keys: list[str],
    phi: float = 0.9,
    points: int = 9,
    rounds: int = 4,
) -> DataFrame:
    """Level and trend weights with the least squared one-step error, per series.

    A grid of ``points`` x ``points`` weights is narrowed around its best point
    in each round, with the least-squares start for every weight pair.
    """

    @F.pandas_udf("alpha double, beta double, l0 double, b0 double")
    def weights(ys: pd.Series) -> pd.DataFrame:
        found = [search.damped_trend(y, phi, points, rounds) for y in ys]
        return pd.DataFrame(found, columns=["alpha", "beta", "l0", "b0"])

    p, best = F.lit(phi), F.col("_best")
    run = holt_fold(F.col("ys"), best["alpha"], best["beta"], p, best["l0"], best["b0"])
    fitted = packed.withColumn("_best", weights("ys")).withColumn("_run", run)
    n = F.size("ys").cast("double")
    k = 5  # alpha, beta, two start values, error variance
    sse = F.col("_run.sse")
    lik = n * F.ln(F.greatest(sse, F.lit(1e-300)) / n)
    return fitted.select(
        *keys,
        F.lit("holt_damped").alias("model"),
        F.size("ys").alias("n"),
        best["alpha"].alias("alpha"),
        best["beta"].alias("beta"),
        p.alias("phi"),
        F.col("_run.l").alias("level"),
        F.col("_run.b").alias("trend"),
        sse.alias("sse"),
        (sse / F.greatest(n - 4, F.lit(1.0))).alias("sigma2"),
        (lik + 2 * k).alias("aic"),
        (lik + 2 * k + F.try_divide(F.lit(2.0 * k * (k + 1)), n - k - 1)).alias("aicc"),
        (lik + k * F.ln(n)).alias("bic"),
        "ys",
        F.col("_run.fitted").alias("fitted"),
        "last_ds",
        "last_t",
    )


def holt_forecast(
    fit: DataFrame, keys: list[str], horizon: int, levels: tuple[float, ...] = (0.8, 0.95)
) -> DataFrame:
    """Point forecasts and normal bounds; variance sigma2 (1 + sum c_j^2)."""
    steps = fit.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    mean = F.col("level") + F.col("trend") * _damping_sum(F.col("phi"), F.col("h"))
    weights = F.transform(
        F.filter(F.sequence(F.lit(0), F.col("h") - 1), lambda j: j > 0),
        lambda j: F.pow(F.col("alpha") + F.col("beta") * _damping_sum(F.col("phi"), j), 2),
    )
    sd = F.sqrt(F.col("sigma2") * (1 + array_total(weights)))
    return _with_bounds(steps, keys, mean, sd, levels)


def _with_bounds(steps, keys, mean, sd, levels) -> DataFrame:
    bounds = []
    for level in levels:
        z, tag = normal_quantile(level), round(level * 100)
        bounds += [(mean - z * sd).alias(f"lo_{tag}"), (mean + z * sd).alias(f"hi_{tag}")]
    return steps.select(
        *keys, "model", "h", (F.col("last_t") + F.col("h")).alias("t"), mean.alias("mean"), *bounds
    )


def fitted_rows(fit: DataFrame, keys: list[str]) -> DataFrame:
    """One row per observed period: value, one-step forecast, residual."""
    start = F.col("last_t") - F.size("ys")
    pairs = F.zip_with("ys", "fitted", lambda y, f: F.struct(y.alias("y"), f.alias("f")))
    return fit.select(*keys, "model", start.alias("_start"), F.posexplode(pairs).alias("_i", "_p")).select(
        *keys,
        "model",
        (F.col("_start") + F.col("_i") + 1).alias("t"),
        F.col("_p.y").alias("actual"),
        F.col("_p.f").alias("fitted"),
        (F.col("_p.y") - F.col("_p.f")).alias("residual"),
    )


# -- automatic error / trend / season choice ----------------------------------------------

def ets_fit(packed: DataFrame, keys: list[str], freq: int = 1) -> DataFrame:
    """Error, trend and season form with the least corrected AIC, per series."""
    fields = ("alpha", "beta", "gamma", "phi", "level", "trend", "sigma2", "aicc")
    layout = "model string, season array<double>, " + ", ".join(f"{f} double" for f in fields)

    @F.pandas_udf(layout)
    def choose(ys: pd.Series) -> pd.DataFrame:
        found = [search.automatic(y, freq) for y in ys]
        table = pd.DataFrame(found, index=ys.index, dtype=object)
        table = table.reindex(columns=["model", "season", *fields]).astype(object)
        return table.where(table.notna(), None)

    fitted = packed.withColumn("_fit", choose("ys"))
    return fitted.select(*keys, F.size("ys").alias("n"), "_fit.*", "ys", "last_ds", "last_t")


def ets_forecast(
    fit: DataFrame,
    keys: list[str],
    horizon: int,
    freq: int = 1,
    levels: tuple[float, ...] = (0.8, 0.95),
) -> DataFrame:
    """Point forecasts and normal bounds.

    Additive errors use the exact variance; multiplicative errors the recursion
    of Hyndman et al. (2008, section 6.3), an approximation for a multiplicative
    season.
    """
    form = F.regexp_extract("model", r"\((\w),(\w+),(\w)\)", 3)
    error = F.regexp_extract("model", r"\((\w),(\w+),(\w)\)", 1)
    steps = F.sequence(F.lit(1), F.lit(horizon))

    def mean_at(h: Column) -> Column:
        base = F.col("level") + F.col("trend") * _damping_sum(F.col("phi"), h)
        s = F.try_element_at(F.col("season"), ((h - 1) % max(freq, 1) + 1).cast("int"))
        return F.when(form == "A", base + s).when(form == "M", base * s).otherwise(base)

    def weight(j: Column) -> Column:
        seasonal = F.when((form != "N") & (j % max(freq, 1) == 0), F.col("gamma")).otherwise(0.0)
        return F.pow(
            F.col("alpha") + F.col("beta") * _damping_sum(F.col("phi"), j) + seasonal, 2
        )

    prepared = fit.withColumns(
        {"_mu": F.transform(steps, mean_at), "_c2": F.transform(steps, weight)}
    )

    def grow(acc: Column, h: Column) -> Column:
        past = F.zip_with(
            F.slice("_c2", F.lit(1), h - 1), F.reverse(F.slice(acc, F.lit(1), h - 1)),
            lambda c, v: c * v,
        )
        own = F.when(error == "A", F.lit(1.0)).otherwise(F.pow(F.element_at("_mu", h), 2))
        inner = F.when(error == "A", array_total(F.slice("_c2", F.lit(1), h - 1))).otherwise(
            F.col("sigma2") * array_total(past)
        )
        return F.array_append(acc, own + inner)

    theta = F.aggregate(steps, F.array().cast("array<double>"), grow)
    rows = prepared.withColumn("_theta", theta).withColumn("h", F.explode(steps))
    mu, th = F.element_at("_mu", F.col("h")), F.element_at("_theta", F.col("h"))
    variance = F.when(error == "A", F.col("sigma2") * th).otherwise(
        (1 + F.col("sigma2")) * th - mu * mu
    )
    return _with_bounds(rows, keys, mu, F.sqrt(F.greatest(variance, F.lit(0.0))), levels)


def ses_fixed(packed: DataFrame, keys: list[str], alpha: float) -> DataFrame:
    """Simple smoothing from the first value: its level is the flat forecast."""
    a = F.lit(alpha)
    level = F.aggregate(
        F.slice("ys", F.lit(2), F.greatest(F.size("ys") - 1, F.lit(0))),
        F.element_at("ys", 1),
        lambda l, y: l + a * (y - l),
    )
    return packed.select(*keys, F.size("ys").alias("n"), level.alias("forecast"))
