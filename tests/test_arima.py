"""Automatic ARIMA: recovery of simulated orders, forecasts, odd input."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from conftest import series_frame
from pyspark.sql import types as T

from supplycast.functions import arma
from supplycast.operators import arima, spine

ID = ["series_id"]


def simulate(n, ar=(), ma=(), seed=0, mean=0.0):
    rng = np.random.default_rng(seed)
    e = rng.normal(size=n + 50)
    y = np.zeros(n + 50)
    for t in range(5, n + 50):
        y[t] = e[t] + sum(a * y[t - i - 1] for i, a in enumerate(ar))
        y[t] += sum(m * e[t - j - 1] for j, m in enumerate(ma))
    return y[50:] + mean


def fit_and_predict(y, *candidate, horizon):
    fit = arma.fit(y, *candidate)
    return fit | arma.predict(y, *candidate, fit["coefficients"], fit["sigma2"], horizon)


def dense(x, ar, ma, horizon):
    """Errors, log scales, forecasts from the whole covariance matrix, by far-reaching psi weights."""
    psi = np.zeros(4000)
    for k in range(len(psi)):
        psi[k] = ma[k] if k < len(ma) else 0.0
        psi[k] -= sum(ar[j] * psi[k - j] for j in range(1, min(k, len(ar) - 1) + 1))
    n = len(x) + horizon
    lagged = np.array([psi[: len(psi) - h] @ psi[h:] for h in range(n)])
    every = lagged[np.abs(np.subtract.outer(np.arange(n), np.arange(n)))]
    known = every[: len(x), : len(x)]
    root = np.linalg.cholesky(known)
    ahead = every[len(x) :, : len(x)] @ np.linalg.solve(known, x)
    return np.linalg.solve(root, x), np.log(np.diag(root)), ahead


YEARLY = (
    np.convolve([1, -0.5], np.r_[1, np.zeros(11), -0.4]),
    np.convolve([1, 0.4], np.r_[1, np.zeros(11), 0.5, np.zeros(11), 0.2]),
)


@pytest.mark.parametrize("ar, ma", [
    ([1, -0.7], [1]), ([1], [1, 0.5]), ([1, -0.5, 0.3], [1, 0.4, -0.2]), ([1], [1]), YEARLY,
])
@pytest.mark.parametrize("n", [3, 16, 33, 150])
def test_innovations_match_the_whole_covariance(ar, ma, n):
    x = np.random.default_rng(n).normal(size=n)
    ar, ma = np.array(ar, float), np.array(ma, float)
    got = arma.innovations(x[None], ar[None], ma[None], 12)
    for mine, plain in zip(got, dense(x, ar, ma, 12)):
        assert mine[0] == pytest.approx(plain, abs=1e-11)


def test_coefficients_of_a_known_process():
    y = simulate(600, ar=(0.7,), ma=(0.4,), seed=1, mean=5)
    fit = arma.fit(y, 1, 0, 1, 0, 0, 0, 1, True)
    ar, ma, mean = fit["coefficients"]
    assert ar == pytest.approx(0.7, abs=0.1)
    assert ma == pytest.approx(0.4, abs=0.12)
    assert mean == pytest.approx(5, abs=0.6)
    assert fit["sigma2"] == pytest.approx(1, abs=0.15)


def exact_loglik(y, coefficients):
    e, logs, _ = dense(y, np.r_[1, -np.array(coefficients)], np.ones(1), 0)
    return -len(y) / 2 * (np.log(2 * np.pi * (e @ e) / len(y)) + 1) - logs.sum()


def test_fit_is_the_likelihood_maximum():
    y = simulate(150, ar=(0.5, 0.2), seed=2)
    fit = arma.fit(y, 2, 0, 0, 0, 0, 0, 1, False)
    best = exact_loglik(y, fit["coefficients"])
    assert fit["loglik"] == pytest.approx(best)
    for shift in np.vstack([np.eye(2), -np.eye(2)]) * 1e-3:
        assert exact_loglik(y, fit["coefficients"] + shift) < best
    # the curvature of the likelihood gives the errors of the coefficients
    step = 1e-3 * np.eye(2)
    at = lambda i, j, s, t: exact_loglik(y, fit["coefficients"] + s * step[i] + t * step[j])
    hessian = [
        [(at(i, j, 1, 1) - at(i, j, 1, -1) - at(i, j, -1, 1) + at(i, j, -1, -1)) / 4e-6 for j in (0, 1)]
        for i in (0, 1)
    ]
    errors = np.sqrt(np.diag(np.linalg.inv(-np.array(hessian))))
    assert fit["std_errors"] == pytest.approx(errors, rel=0.03)


def test_random_walk_forecast_and_errors():
    y = np.cumsum(np.random.default_rng(3).normal(size=80))
    fit = fit_and_predict(y, 0, 1, 0, 0, 0, 0, 1, False, horizon=4)
    assert fit["mean"] == pytest.approx([y[-1]] * 4)
    assert np.array(fit["se"]) ** 2 == pytest.approx(fit["sigma2"] * np.arange(1, 5))
    drift = fit_and_predict(y, 0, 1, 0, 0, 0, 0, 1, True, horizon=4)
    step = (y[-1] - y[0]) / 79
    assert drift["mean"] == pytest.approx(y[-1] + step * np.arange(1, 5), abs=1e-6)


def test_seasonal_difference_repeats_the_last_cycle():
    figure = np.tile([1.0, 5.0, 2.0, 8.0], 10) + np.random.default_rng(4).normal(0, 0.01, 40)
    fit = fit_and_predict(figure, 0, 0, 0, 0, 1, 0, 4, False, horizon=4)
    assert fit["mean"] == pytest.approx(figure[-4:])


def test_search_picks_the_order_and_reports_failures(spark):
    series = {
        "ar": simulate(200, ar=(0.8,), seed=5, mean=20),
        "walk": np.cumsum(simulate(200, seed=6) + 0.3),
        "short": [1.0, 2.0, 4.0],
        "const": [3.0] * 30,
    }
    packed = spine.pack(series_frame(spark, series), ID)
    tried = arima.search(packed, ID)
    failed = {r["series_id"] for r in tried.where("reason IS NOT NULL").collect()}
    assert "short" in failed
    best = {r["series_id"]: r for r in arima.auto(packed, ID, 3).collect()}
    assert best["ar"]["d"] == 0 and best["ar"]["p"] + best["ar"]["q"] >= 1
    assert best["walk"]["d"] == 1
    scores = tried.where("reason IS NULL AND series_id = 'ar'").collect()
    assert len(scores) == 42
    assert best["ar"]["aicc"] == min(r["aicc"] for r in scores)
    rows = arima.forecast(arima.auto(packed, ID, 3), ID).where("series_id = 'ar'").collect()
    assert len(rows) == 3 and all(r["lo_95"] < r["lo_80"] < r["mean"] < r["hi_80"] for r in rows)
    residuals = arima.residual_rows(arima.auto(packed, ID, 3), ID)
    assert residuals.where("series_id = 'ar'").count() == 200


def test_seasonal_search(spark):
    rng = np.random.default_rng(7)
    y = np.tile([10.0, 14.0, 9.0, 20.0], 12) + np.arange(48) * 0.2 + rng.normal(0, 0.3, 48)
    packed = spine.pack(series_frame(spark, {"y": y}), ID)
    fit = arima.auto(packed, ID, 4, freq=4, seasonal=True, most=2)
    row = fit.first()
    assert row["sd"] == 1
    truth = np.array([10.0, 14.0, 9.0, 20.0]) + np.arange(48, 52) * 0.2
    assert np.abs(np.array(row["mean"]) - truth).max() < 1.5


def test_boxcox_forecast_is_on_the_original_scale(spark):
    rng = np.random.default_rng(8)
    y = np.exp(np.linspace(1, 3, 60) + rng.normal(0, 0.1, 60))
    fit = arima.auto_boxcox(series_frame(spark, {"y": y}), ID, 2, 12, most=2)
    row = arima.forecast(fit, ID).where("h = 1").first()
    assert 10 < row["mean"] < 40 and row["lo_95"] < row["mean"] < row["hi_95"]


def test_no_series_vanishes(spark):
    series = {
        "const": [7.0] * 48,
        "gap": [1.0, 2.0, None, 3.0] * 12,
        "short": [1.0, 2.0],
        "empty": [None] * 24,
        "zero": [0.0 if t % 9 == 4 else 10.0 + t % 5 for t in range(60)],
    }
    long = series_frame(spark, series)
    packed = spine.pack(long, ID)
    fits = {r["series_id"]: r for r in arima.auto(packed, ID, 3).collect()}
    assert set(fits) == set(series)
    for name in ("gap", "short", "empty"):
        assert fits[name]["model"] is None and fits[name]["reason"]
        assert fits[name]["mean"] is None
    assert fits["gap"]["reason"] == "series has gaps"
    given = {r["series_id"]: r for r in arima.fixed(packed, 3, (1, 0, 0)).collect()}
    assert set(given) == set(series)
    assert given["zero"]["model"] == "ARIMA(1,0,0)" and len(given["zero"]["mean"]) == 3
    assert given["gap"]["model"] is None and given["gap"]["reason"] == "series has gaps"
    assert fits["const"]["mean"] == pytest.approx([7.0] * 3)
    assert fits["zero"]["reason"] is None
    scaled = {r["series_id"]: r for r in arima.auto_boxcox(long, ID, 3, 12).collect()}
    assert set(scaled) == set(series)
    assert scaled["zero"]["model"] is not None


def test_boxcox_keeps_zeros_at_positive_exponents(spark):
    from pyspark.sql import functions as F

    from supplycast.operators import boxcox

    rows = [(y, lam) for y in (-3.0, 0.0, 2.5) for lam in (-0.5, 0.0, 0.5, 1.0)]
    df = spark.createDataFrame(rows, "y double, lam double")
    z = boxcox.transform(F.col("y"), F.col("lam"))
    for r in df.select("y", "lam", boxcox.inverse(z, F.col("lam")).alias("back")).collect():
        if r["y"] > 0 or r["lam"] > 0:
            assert r["back"] == pytest.approx(r["y"])
        else:
            assert r["back"] is None


def test_fixed_order_takes_one_python_pass_in_slices(spark):
    """A second pass doubles the Python workers of a task, a whole batch their results."""
    rows = [(k, [float((k * t) % 7 + t) for t in range(12)], 12) for k in range(3)]
    packed = spark.createDataFrame(rows, "k int, ys array<double>, last_t int")
    fit = arima.fixed(packed, 2, (1, 0, 0))
    plan = fit._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInPandas") == 1
    sizes = []

    class Frame:
        def mapInPandas(self, run, schema):
            batch = pd.DataFrame({"k": range(3 * arima.SLICE + 1)})
            sizes.extend(len(part) for part in run(iter([batch])))

        schema = T.StructType([T.StructField("k", T.LongType())])

    arima._added(Frame(), [T.StructField("x", T.DoubleType())], lambda r: {"x": 1.0})
    assert sizes == [arima.SLICE] * 3 + [1]
