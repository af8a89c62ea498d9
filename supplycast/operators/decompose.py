"""Trend, season and remainder of long series ``(keys, t, value)``."""

from __future__ import annotations

import math
from functools import reduce
from operator import add, and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supplycast.functions import smoothers
from supplycast.functions.stats import array_total, pearson, slope
from supplycast.operators.spine import pack


def moving_average(value: Column, keys: list[str], order: int, centre: bool = True) -> Column:
    """Centred mean of ``order`` periods, NULL where the window is incomplete.

    An even order averages two neighbouring windows, which gives half weight
    to both end points.
    """
    by_time = Window.partitionBy(*keys).orderBy("t")

    def full_mean(first: int, last: int) -> Column:
        frame = by_time.rowsBetween(first, last)
        return F.when(F.count(value).over(frame) == order, F.avg(value).over(frame))

    half = order // 2
    if order % 2:
        return full_mean(-half, half)
    if not centre:
        return full_mean(1 - half, half)
    return (full_mean(-half, half - 1) + full_mean(1 - half, half)) / 2


def trailing_mean(value: Column, keys: list[str], order: int) -> Column:
    """Mean of the ``order`` periods before the current one: a one-step forecast."""
    frame = Window.partitionBy(*keys).orderBy("t").rowsBetween(-order, -1)
    return F.when(F.count(value).over(frame) == order, F.avg(value).over(frame))


def classical(
    df: DataFrame, keys: list[str], freq: int, kind: str = "additive", value: str = "value"
) -> DataFrame:
    """Moving-average trend, phase means and remainder.

    Series shorter than two full periods keep NULL components and a reason.
    ``t`` must be dense; phases follow ``pmod(t - 1, freq)``.
    """
    y = F.col(value)
    series = Window.partitionBy(*keys)
    phase = F.pmod(F.col("t") - 1, F.lit(freq))
    combine = {
        "additive": (lambda a, b: a - b),
        "multiplicative": F.try_divide,
    }[kind]
    with_trend = df.withColumns(
        {"trend": moving_average(y, keys, freq), "_phase": phase, "_n": F.count(y).over(series)}
    )
    detrended = with_trend.withColumn("_raw", combine(y, F.col("trend")))
    by_phase = detrended.withColumn(
        "_figure", F.avg("_raw").over(Window.partitionBy(*keys, "_phase"))
    )
    # mean of the freq phase means: take each phase once, from its first cycle
    first_t = by_phase.withColumn("_first", F.min("t").over(series))
    one_cycle = F.avg(
        F.when(F.col("t") < F.col("_first") + freq, F.col("_figure"))
    ).over(series)
    enough = F.col("_n") >= 2 * freq
    seasonal = F.when(enough, combine(F.col("_figure"), one_cycle))
    out = first_t.withColumn("seasonal", seasonal)
    rest = combine(combine(y, F.col("trend")), F.col("seasonal"))
    return out.withColumns(
        {
            "trend": F.when(enough, F.col("trend")),
            "remainder": F.when(enough, rest),
            "reason": F.when(~enough, "fewer than two periods"),
        }
    ).drop("_phase", "_n", "_raw", "_figure", "_first")


def linear_trend(df: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Line per series: intercept, slope, R squared and residual variance."""
    y, t = F.col(value).cast("double"), F.col("t").cast("double")
    fits = df.where(y.isNotNull()).groupBy(*keys).agg(
        F.count("*").alias("n"),
        slope(y, t).alias("slope"),
        (F.avg(y) - slope(y, t) * F.avg(t)).alias("intercept"),
        F.pow(pearson(y, t), 2).alias("r2"),
        (F.var_pop(y) * F.count("*")).alias("_syy"),
    )
    sigma2 = F.try_divide(F.col("_syy") * (1 - F.col("r2")), F.col("n") - 2)
    return fits.withColumn("sigma2", sigma2).drop("_syy")


def _orthogonal_polynomials(x: Column, n: Column, degree: int) -> list[Column]:
    """Gram polynomials on n equally spaced points centred at zero."""
    basis = [F.lit(1.0), x]
    for j in range(1, degree):
        back = F.lit(float(j * j)) * (n * n - j * j) / (4.0 * (4 * j * j - 1))
        basis.append(x * basis[j] - back * basis[j - 1])
    return basis[: degree + 1]


def polynomial_trend(
    df: DataFrame, keys: list[str], degree: int, value: str = "value", log: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Polynomial (or, with ``log``, exponential) trend on dense series.

    The basis is orthogonal on the time grid, so every coefficient is a ratio
    of two sums and no system has to be solved.  Returns the fitted rows and a
    summary per series with R squared, AIC and corrected AIC.
    """
    y = F.ln(F.when(F.col(value) > 0, F.col(value))) if log else F.col(value).cast("double")
    series = Window.partitionBy(*keys)
    n = F.count(y).over(series).cast("double")
    base = df.withColumns({"_y": y, "_n": n, "_x": F.col("t") - F.avg("t").over(series)})
    basis = _orthogonal_polynomials(F.col("_x"), F.col("_n"), degree)
    base = base.withColumns({f"_p{j}": p for j, p in enumerate(basis)})
    coefficient = {
        f"_c{j}": F.try_divide(
            F.sum(F.col("_y") * F.col(f"_p{j}")).over(series),
            F.sum(F.col(f"_p{j}") * F.col(f"_p{j}")).over(series),
        )
        for j in range(degree + 1)
    }
    fit = sum(
        (F.coalesce(F.col(f"_c{j}"), F.lit(0.0)) * F.col(f"_p{j}") for j in range(1, degree + 1)),
        F.col("_c0") * F.col("_p0"),
    )
    fitted = base.withColumns(coefficient).withColumn("_fit", fit)
    rows = fitted.withColumns(
        {
            "fitted": F.exp("_fit") if log else F.col("_fit"),
            "residual": F.col("_y") - F.col("_fit"),
        }
    )
    k = degree + 2
    summary = rows.groupBy(*keys).agg(
        F.count("residual").alias("n"),
        F.sum(F.col("residual") * F.col("residual")).alias("sse"),
        (F.var_pop("_y") * F.count("residual")).alias("_syy"),
    )
    size, aic = F.col("n").cast("double"), F.col("aic")
    summary = summary.withColumns(
        {
            "r2": 1 - F.try_divide(F.col("sse"), F.col("_syy")),
            "aic": size * F.ln(F.try_divide(F.col("sse"), size)) + 2 * k,
        }
    ).withColumn("aicc", aic + F.try_divide(F.lit(2.0 * k * (k + 1)), size - k - 1))
    kept = [c for c in rows.columns if not c.startswith("_")]
    return rows.select(*kept), summary.drop("_syy")


def fourier_terms(t: Column, freq: float, k: int) -> dict[str, Column]:
    """Sine and cosine pairs; the sine that vanishes at 2k = freq is left out."""
    terms = {}
    for i in range(1, k + 1):
        angle = F.lit(2 * math.pi * i / freq) * t
        if not math.isclose(2 * i, freq):
            terms[f"s{i}"] = F.sin(angle)
        terms[f"c{i}"] = F.cos(angle)
    return terms


def _solved(rows: Column, size: int) -> Column:
    """Solution of normal equations given as rows with the right side last, by elimination.

    A term that the earlier ones already span has no pivot left and gets the coefficient 0.
    """

    def step(m: Column, k: Column) -> Column:
        lead = F.get(m, k)
        pivot = F.get(lead, k)
        usable = pivot > 1e-11 * F.get(F.get(rows, k), k)

        def reduced(row: Column, i: Column) -> Column:
            factor = F.get(row, k) / pivot
            return (
                F.when((i == k) & usable, F.transform(row, lambda v: v / pivot))
                .when(i == k, F.transform(row, lambda v: F.lit(0.0)))
                .when(usable, F.zip_with(row, lead, lambda v, w: v - factor * w))
                .otherwise(row)
            )

        return F.transform(m, reduced)

    done = F.aggregate(F.sequence(F.lit(0), F.lit(size - 1)), rows, step)
    return F.transform(done, lambda row: F.element_at(row, -1))


def fourier_decompose(
    df: DataFrame, keys: list[str], freq: float, k: int, value: str = "value"
) -> DataFrame:
    """Least squares on a line and ``k`` Fourier pairs.

    Trend is the line, season the Fourier part, remainder the residual.  The normal equations are sums
    over the rows of a series, solved in one fold.  Terms that a short series cannot tell from earlier
    ones are left out; a series without values has NULL parts.
    """
    y, t = F.col(value).cast("double"), F.col("t").cast("double")
    terms = fourier_terms(F.col("t").cast("double"), freq, k)
    basis = [F.lit(1.0), t, *terms.values()]
    size = len(basis)
    data = F.when(~F.isnan(y), y)
    rows = df.select(*keys, "t", "ds", data.alias("data"))
    known = rows.where("data IS NOT NULL").select(
        *keys, *[b.alias(f"_x{i}") for i, b in enumerate(basis)], F.col("data").alias(f"_x{size}")
    )
    products = [
        F.sum(F.col(f"_x{i}") * F.col(f"_x{j}")).alias(f"_s{i}_{j}")
        for i in range(size)
        for j in range(i, size + 1)
    ]
    sums = known.groupBy(*keys).agg(*products)
    system = F.array(*[
        F.array(*[F.col(f"_s{min(i, j)}_{max(i, j)}") for j in range(size + 1)])
        for i in range(size)
    ])
    series = sums.select(*[F.col(c).alias(f"_k_{c}") for c in keys], system.alias("_m"))
    series = series.withColumn("_c", _solved(F.col("_m"), size)).drop("_m")
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys])
    parts = [F.get("_c", F.lit(i)) * b for i, b in enumerate(basis)]
    whole = rows.join(series, same, "left").withColumns(
        {"trend": parts[0] + parts[1], "season": reduce(add, parts[2:])}
    )
    return whole.withColumn("remainder", F.col("data") - F.col("trend") - F.col("season")).select(
        *keys, "t", "ds", "data", "trend", "season", "remainder"
    )


def stl_decompose(
    df: DataFrame,
    keys: list[str],
    freq: int,
    *,
    t_window: int = 7,
    s_window: int = 10,
    s_degree: int = 0,
    robust: bool = True,
    value: str = "value",
) -> DataFrame:
    """Loess decomposition in parallel over series; short series keep NULL parts."""
    rows = df.select(*keys, "t", "ds", F.col(value).cast("double").alias("data"))
    parts = ["trend", "seasonal", "remainder"]
    schema = T.StructType(rows.schema.fields + [T.StructField(p, T.DoubleType()) for p in parts])

    def fit(series: pd.DataFrame) -> pd.DataFrame:
        series = series.sort_values("t", ignore_index=True)
        y = series["data"].to_numpy(float)
        if len(y) < 2 * freq or np.isnan(y).any():
            return series.assign(trend=None, seasonal=None, remainder=None)
        trend, season = smoothers.stl(y, freq, s_window, t_window, s_degree, robust)
        return series.assign(trend=trend, seasonal=season, remainder=y - trend - season)

    return rows.groupBy(*keys).applyInPandas(fit, schema)


def dominant_period(df: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Period with the largest periodogram ordinate of the detrended series."""
    series = Window.partitionBy(*keys)
    y, t = F.col(value).cast("double"), F.col("t").cast("double")

    def over(aggregate: Column) -> Column:
        return aggregate.over(series)

    b = F.try_divide(over(F.covar_pop(y, t)), over(F.var_pop(t)))
    line = over(F.avg(y)) + F.coalesce(b, F.lit(0.0)) * (t - over(F.avg(t)))
    packed = pack(df.withColumn("_rest", y - line), keys, "_rest")
    n = F.size("ys")
    index = F.sequence(F.lit(1), n)

    def power(k: Column) -> Column:
        angle = 2 * math.pi * k / n
        real = F.zip_with("ys", index, lambda v, i: v * F.cos(angle * i))
        imag = F.zip_with("ys", index, lambda v, i: v * F.sin(angle * i))
        total = F.pow(array_total(real), 2) + F.pow(array_total(imag), 2)
        return F.struct((total / n).alias("power"), k.alias("k"))

    # a series needs four points to have a frequency below one half
    spectrum = F.when(n >= 4, F.array_max(F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.floor(n / 2).cast("int"))), power
    )))
    best = packed.select(*keys, n.alias("n"), spectrum.alias("best"))
    return best.select(
        *keys,
        "n",
        F.col("best.power").alias("power"),
        (F.col("n") / F.col("best.k")).alias("period"),
    )


def _levinson(state: Column, lag: Column) -> Column:
    """Fold step of the Levinson-Durbin recursion over the autocorrelations ``_r`` (from lag 1).

    The state holds the latest coefficients, the error variance as a share of that of the series, and
    both for every order so far.
    """
    a, v = state["a"], state["v"]
    past = F.slice(F.col("_r"), F.lit(1), lag - 1)
    carried = array_total(F.zip_with(a, F.reverse(past), lambda x, y: x * y))
    k = F.when(v > 1e-12, (F.element_at("_r", lag) - carried) / v).otherwise(0.0)
    now = F.concat(F.zip_with(a, F.reverse(a), lambda x, y: x - k * y), F.array(k))
    left = v * (1 - k * k)
    fits = F.concat(state["fits"], F.array(F.struct(now.alias("a"), left.alias("v"))))
    return F.struct(now.alias("a"), left.alias("v"), fits.alias("fits"))


def autoregressive_spectrum(
    df: DataFrame,
    keys: list[str],
    frequencies: int = 500,
    least: float = 10.0,
    value: str = "value",
) -> DataFrame:
    """Dominant period by the spectral density of an autoregression of the detrended series.

    Autocorrelations give the Yule-Walker coefficients of all orders up to ``10 log10 n`` by one fold;
    the order with the least AIC is kept and its density taken at ``frequencies`` equal steps from 0 to
    one half.  ``period`` is the nearest whole period of the largest density; where that lies at
    frequency 0, it is the one of the largest density from the first rise on.  It is 1 where the largest
    density does not exceed ``least``, never rises again or does so up to one half.  Series with fewer than four values or without variation have NULL.
    """
    series = Window.partitionBy(*keys)
    y, t = F.col(value).cast("double"), F.col("t").cast("double")
    b = F.try_divide(F.covar_pop(y, t).over(series), F.var_pop(t).over(series))
    line = F.avg(y).over(series) + F.coalesce(b, F.lit(0.0)) * (t - F.avg(t).over(series))
    packed = pack(df.withColumn("_rest", y - line), keys, "_rest")
    n = F.size("ys")
    size = n.cast("double")
    most = F.least(n - 1, F.floor(10 * F.log10(size)).cast("int"))

    def product(lag: Column) -> Column:
        ahead = F.slice(F.col("ys"), lag + 1, n - lag)
        near = F.slice(F.col("ys"), F.lit(1), n - lag)
        return array_total(F.zip_with(near, ahead, lambda u, v: u * v))

    square = array_total(F.transform("ys", lambda v: v * v))
    usable = (n >= 4) & ~F.exists("ys", lambda v: v.isNull()) & (square > 1e-9 * size)
    lags = F.sequence(F.lit(1), F.greatest(most, F.lit(1)))
    scored = packed.select(*keys, n.alias("n"), "ys", square.alias("_s")).where(usable)
    scored = scored.withColumn("_r", F.transform(lags, lambda k: product(k) / F.col("_s")))
    empty = F.array().cast("array<double>")
    none = F.struct(empty.alias("a"), F.lit(1.0).alias("v"))
    start = F.struct(empty.alias("a"), F.lit(1.0).alias("v"), F.array(none).alias("fits"))
    fits = F.aggregate(lags, start, _levinson, lambda s: s["fits"])
    aic = F.transform(fits, lambda f, i: F.struct(
        (F.col("n") * F.ln(F.greatest(f["v"], F.lit(1e-12))) + 2 * i).alias("aic"),
        i.alias("order"), f["a"].alias("a"), f["v"].alias("v"),
    ))
    chosen = scored.withColumn("_b", F.array_min(aic))

    def density(i: Column) -> Column:
        angle = math.pi * i / (frequencies - 1)
        order = F.sequence(F.lit(1), F.size("_b.a"))
        terms = F.when(F.size("_b.a") > 0, F.zip_with("_b.a", order, lambda a, j: F.struct(
            (a * F.cos(angle * j)).alias("re"), (a * F.sin(angle * j)).alias("im"))))
        real = 1 - F.coalesce(array_total(F.transform(terms, lambda x: x["re"])), F.lit(0.0))
        imag = F.coalesce(array_total(F.transform(terms, lambda x: x["im"])), F.lit(0.0))
        return F.col("_b.v") / (real * real + imag * imag)

    points = chosen.withColumn(
        "_d", F.transform(F.sequence(F.lit(0), F.lit(frequencies - 1)), density)
    )
    indices = F.sequence(F.lit(1), F.lit(frequencies - 1))

    def highest(since: Column) -> Column:
        """First index of the largest density from an index on."""
        heights = F.transform("_d", lambda d, i: F.struct(d.alias("d"), (-i).alias("i")))
        return -F.array_max(F.filter(heights, lambda h: -h["i"] >= since))["i"]

    rises = F.filter(indices, lambda i: F.get("_d", i) > F.get("_d", i - 1))
    found = points.withColumns({"_top": highest(F.lit(0)), "_up": F.array_min(rises)})
    later = highest(F.col("_up"))
    peak = F.when(F.col("_top") > 0, F.col("_top")).when(later < frequencies - 1, later)
    spread = F.col("_s") / (F.col("n") - F.col("_b.order") - 1)
    found = found.withColumns({"_peak": peak, "_high": spread * F.get("_d", "_top")})
    period = F.when(
        F.col("_high") > least, F.floor(2.0 * (frequencies - 1) / F.col("_peak") + 0.5)
    )
    out = found.select(
        *keys,
        F.col("_b.order").alias("ar_order"),
        F.col("_high").alias("density"),
        F.coalesce(period.cast("int"), F.lit(1)).alias("period"),
    )
    return packed.select(*keys, n.alias("n")).join(out, keys, "left")
