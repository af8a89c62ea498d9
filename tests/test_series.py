"""Hand-built series with known answers."""

from __future__ import annotations

import math

import numpy as np
import plain_smoother
import pytest
from conftest import series_frame
from pyspark.sql import functions as F

from supplycast.functions import search
from supplycast.operators import (
    boxcox,
    decompose,
    diagnose,
    evaluate,
    facts,
    repair,
    smoothing,
    spine,
)

ID = ["series_id"]
LINE = [3 + 2 * t for t in range(1, 49)]
SINE = [5 * math.sin(2 * math.pi * t / 12) + 20 for t in range(1, 49)]
SPIKE = [v * 10 if t == 24 else v for t, v in enumerate(LINE)]


def by_id(df):
    return {r["series_id"]: r for r in df.collect()}


def values(df, column, name):
    rows = df.where(F.col("series_id") == name).orderBy("t").collect()
    return [r[column] for r in rows]


def test_interpolation_fills_gaps_and_keeps_observed(spark):
    gaps = [None, None, 4, None, 8, None, None, 2, None]
    df = series_frame(spark, {"gaps": gaps, "empty": [None] * 4, "single": [7]})
    out = repair.interpolate(df, ID)
    assert values(out, "filled", "gaps") == [4, 4, 4, 6, 8, 6, 4, 2, 2]
    assert values(out, "is_imputed", "gaps") == [v is None for v in gaps]
    assert values(out, "filled", "empty") == [None] * 4
    assert values(out, "filled", "single") == [7]


@pytest.mark.parametrize("method", [repair.median_outliers, repair.smooth_outliers])
def test_outlier_replaced_and_clean_series_untouched(spark, method):
    rng = np.random.default_rng(3)
    noisy = [v + e for v, e in zip(LINE, rng.normal(0, 1, 48))]
    spiked = [v + 200 if t == 24 else v for t, v in enumerate(noisy)]
    out = method(series_frame(spark, {"spike": spiked, "const": [7.0] * 24}), ID)
    flags = values(out, "is_outlier", "spike")
    assert flags[24]
    fixed = values(out, "fixed", "spike")
    assert abs(fixed[24] - noisy[24]) < 10
    assert all(a == b for a, b, f in zip(fixed, spiked, flags) if not f)
    assert values(out, "fixed", "const") == [7.0] * 24
    assert not any(values(out, "is_outlier", "const"))


def test_repair_handles_empty_and_short_series(spark):
    df = series_frame(spark, {"empty": [None] * 6, "single": [3.0], "gap": [1, None, 3, 4, 5, 6]})
    dense = df.withColumnRenamed("value", "orders").withColumn("is_padding", F.lit(False))
    out = repair.repair(dense, ID, ["orders"])
    assert values(out, "fixed", "gap") == [1, 2, 3, 4, 5, 6]
    assert values(out, "fixed", "single") == [3.0]
    assert out.count() == 13


def test_variable_span_follows_a_line_exactly(spark):
    y = np.array(LINE, float)
    assert np.allclose(plain_smoother.super_smoother(y), y)
    out = repair.variable_span(series_frame(spark, {"line": LINE}), ID, "value", 48)
    assert values(out, "smooth", "line") == pytest.approx(LINE)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 20, 150])
def test_variable_span_equals_the_plain_form(spark, n):
    rng = np.random.default_rng(n)
    series = {
        "walk": rng.normal(size=n).cumsum(),
        "wave": np.sin(np.arange(n) / 9) + rng.normal(0, 0.2, n),
        "step": np.where(np.arange(n) > n / 2, 5.0, 1.0) + rng.normal(0, 0.1, n),
    }
    out = repair.variable_span(series_frame(spark, series), ID, "value", n)
    for name, y in series.items():
        assert values(out, "smooth", name) == pytest.approx(list(plain_smoother.super_smoother(y)), abs=1e-8)


def test_smoothed_outliers_equal_the_plain_form(spark):
    rng = np.random.default_rng(12)
    series = {k: rng.normal(0, 1, 120) + 20 * np.sin(np.arange(120) / 15) for k in "abc"}
    series["a"][[30, 31, 80]] += 40
    series["b"][5] -= 60
    out = repair.smooth_outliers(series_frame(spark, series), ID)
    for name, y in series.items():
        fixed, flagged = plain_smoother.replace_outliers(y)
        assert values(out, "is_outlier", name) == list(flagged)
        assert values(out, "fixed", name) == pytest.approx(list(fixed))


def test_linear_and_polynomial_trend(spark):
    cubic = [0.01 * t**3 - 0.2 * t**2 + t + 5 for t in range(1, 49)]
    df = series_frame(spark, {"line": LINE, "cubic": cubic, "const": [7.0] * 24})
    fits = by_id(decompose.linear_trend(df, ID))
    assert fits["line"]["slope"] == pytest.approx(2)
    assert fits["line"]["intercept"] == pytest.approx(3)
    assert fits["line"]["r2"] == pytest.approx(1)
    assert fits["const"]["slope"] == 0 and fits["const"]["r2"] is None
    rows, summary = decompose.polynomial_trend(df, ID, 3)
    assert values(rows, "fitted", "cubic") == pytest.approx(cubic)
    assert by_id(summary)["cubic"]["r2"] == pytest.approx(1)


def test_exponential_trend(spark):
    growth = [2 * math.exp(0.1 * t) for t in range(1, 25)]
    rows, _ = decompose.polynomial_trend(series_frame(spark, {"g": growth}), ID, 1, log=True)
    assert values(rows, "fitted", "g") == pytest.approx(growth)


def test_classical_decomposition_of_line_plus_season(spark):
    season = [math.sin(2 * math.pi * t / 12) for t in range(12)]
    y = [10 + 0.5 * t + season[(t - 1) % 12] for t in range(1, 49)]
    df = series_frame(spark, {"y": y, "short": LINE[:20]})
    out = decompose.classical(df, ID, 12)
    trend, rest = values(out, "trend", "y"), values(out, "remainder", "y")
    assert trend[:6] == [None] * 6 and trend[-6:] == [None] * 6
    assert trend[6:-6] == pytest.approx([10 + 0.5 * t for t in range(7, 43)])
    assert rest[6:-6] == pytest.approx([0] * 36, abs=1e-9)
    assert values(out, "seasonal", "y")[:12] == pytest.approx(season, abs=1e-9)
    assert set(values(out, "reason", "short")) == {"fewer than two periods"}
    assert set(values(out, "seasonal", "short")) == {None}


def test_fourier_parts_add_up_and_residual_is_orthogonal(spark):
    rng = np.random.default_rng(1)
    y = [v + s + e for v, s, e in zip(LINE, SINE, rng.normal(0, 1, 48))]
    out = decompose.fourier_decompose(series_frame(spark, {"y": y}), ID, 12, 3)
    rows = out.orderBy("t").collect()
    total = [r["trend"] + r["season"] + r["remainder"] for r in rows]
    assert total == pytest.approx(y)
    rest = np.array([r["remainder"] for r in rows])
    t = np.arange(1, 49)
    for regressor in (np.ones(48), t, np.sin(2 * np.pi * t / 12), np.cos(6 * np.pi * t / 12)):
        assert rest @ regressor == pytest.approx(0, abs=1e-6)


def test_fourier_drops_the_vanishing_sine():
    terms = decompose.fourier_terms(F.lit(1.0), 12, 6)
    assert "s6" not in terms and "c6" in terms and len(terms) == 11


def test_stl_parts_add_up_and_find_the_season(spark):
    y = [0.3 * t + s for t, s in enumerate(SINE)]
    df = series_frame(spark, {"y": y, "short": LINE[:20]})
    out = decompose.stl_decompose(df, ID, 12, t_window=19, s_window=35)
    rows = out.where("series_id = 'y'").orderBy("t").collect()
    assert [r["trend"] + r["seasonal"] + r["remainder"] for r in rows] == pytest.approx(y)
    season = np.array([r["seasonal"] for r in rows])[12:36]
    assert np.corrcoef(season, np.array(SINE)[12:36])[0, 1] > 0.99
    assert set(values(out, "trend", "short")) == {None}


def test_dominant_period(spark):
    df = series_frame(spark, {"sine": SINE, "seven": [math.cos(2 * math.pi * t / 7) for t in range(70)]})
    found = by_id(decompose.dominant_period(df, ID))
    assert found["sine"]["period"] == pytest.approx(12)
    assert found["seven"]["period"] == pytest.approx(7)


def test_kpss_matches_a_plain_computation(spark):
    rng = np.random.default_rng(5)
    noise, walk = rng.normal(size=120), np.cumsum(rng.normal(size=120))
    df = series_frame(spark, {"noise": noise, "walk": walk, "const": [1.0] * 30})
    found = by_id(diagnose.kpss(spine.pack(df, ID), ID))

    def plain(y):
        e = y - y.mean()
        n, lags = len(y), int(4 * (len(y) / 100) ** 0.25)
        s2 = e @ e / n + 2 / n * sum((1 - k / (lags + 1)) * (e[k:] @ e[:-k]) for k in range(1, lags + 1))
        return (np.cumsum(e) ** 2).sum() / n**2 / s2

    assert found["noise"]["statistic"] == pytest.approx(plain(noise))
    assert found["walk"]["statistic"] == pytest.approx(plain(walk))
    assert found["noise"]["stationary_05"] and not found["walk"]["stationary_05"]
    assert found["const"]["statistic"] is None


def test_difference_order(spark):
    rng = np.random.default_rng(8)
    noise = rng.normal(size=200)
    df = series_frame(spark, {"d0": noise, "d1": np.cumsum(noise + 0.5), "const": [2.0] * 20})
    found = by_id(diagnose.difference_order(spine.pack(df, ID)))
    assert [found[k]["d"] for k in ("d0", "d1", "const")] == [0, 1, 0]


def test_ljung_box_tail(spark):
    # chi-square tail with one and two degrees of freedom in closed form
    from supplycast.functions.stats import chi2_sf

    row = spark.range(1).select(
        chi2_sf(F.lit(3.0), F.lit(2)).alias("two"),
        chi2_sf(F.lit(3.0), F.lit(1)).alias("one"),
        chi2_sf(F.lit(200.0), F.lit(4)).alias("far"),
        chi2_sf(F.lit(1.0), F.lit(0)).alias("none"),
    ).first()
    assert row["two"] == pytest.approx(math.exp(-1.5))
    assert row["one"] == pytest.approx(math.erfc(math.sqrt(1.5)))
    assert row["far"] == pytest.approx(0, abs=1e-9)
    assert row["none"] is None


def test_holt_with_fixed_weights(spark):
    df = series_frame(spark, {"holt5": [10, 12, 15, 14, 18]})
    row = smoothing.holt_fixed(spine.pack(df, ID), ID, 0.5, 0.1, 0.9).first()
    assert row["level"] == pytest.approx(17.0983036125)
    assert row["trend"] == pytest.approx(1.38837936375)
    assert row["sse"] == pytest.approx(8.6845387729472)


def plain_holt(y, alpha, beta, phi, level, trend):
    errors = []
    for value in y:
        forecast = level + phi * trend
        errors.append(value - forecast)
        level, trend = forecast + alpha * errors[-1], phi * trend + beta * errors[-1]
    return level, trend, float(np.square(errors).sum())


def test_holt_fit_beats_random_weights_and_starts(spark):
    rng = np.random.default_rng(2)
    y = np.cumsum(rng.normal(1, 2, 60)) + 50
    row = smoothing.holt_fit(spine.pack(series_frame(spark, {"y": y}), ID), ID).first()
    assert row["beta"] <= row["alpha"]
    assert row["sse"] == pytest.approx(sum((a - f) ** 2 for a, f in zip(row["ys"], row["fitted"])))
    for _ in range(300):
        alpha = rng.uniform(0, 1)
        trial = plain_holt(
            y, alpha, alpha * rng.uniform(), 0.9, y[0] + rng.normal(0, 3), rng.normal(0, 3)
        )
        assert row["sse"] <= trial[2] * 1.001


def test_holt_search_agrees_with_plain_recursion():
    rng = np.random.default_rng(9)
    y = rng.normal(size=30).cumsum()
    alpha, beta, level, trend = search.damped_trend(y, 0.9)
    sse = plain_holt(y, alpha, beta, 0.9, level, trend)[2]
    for d in (-1e-3, 1e-3):
        assert sse <= plain_holt(y, alpha, beta, 0.9, level + d, trend)[2] + 1e-9
        assert sse <= plain_holt(y, alpha, beta, 0.9, level, trend + d)[2] + 1e-9


def test_holt_forecast_shape_and_bounds(spark):
    rng = np.random.default_rng(4)
    df = series_frame(spark, {k: rng.normal(5, 1, 40).cumsum() for k in "ab"})
    fit = smoothing.holt_fit(spine.pack(df, ID), ID)
    rows = smoothing.holt_forecast(fit, ID, 6).orderBy("series_id", "h").collect()
    assert len(rows) == 12
    widths = [r["hi_95"] - r["lo_95"] for r in rows if r["series_id"] == "a"]
    assert all(b >= a for a, b in zip(widths, widths[1:]))
    assert all(r["lo_95"] <= r["lo_80"] <= r["mean"] <= r["hi_80"] <= r["hi_95"] for r in rows)
    assert [r["t"] for r in rows[:6]] == list(range(41, 47))
    fitted = smoothing.fitted_rows(fit, ID)
    assert fitted.count() == 80


def test_holt_on_short_and_constant_series(spark):
    df = series_frame(spark, {"one": [4.0], "two": [4.0, 6.0], "const": [7.0] * 24})
    fit = smoothing.holt_fit(spine.pack(df, ID), ID)
    found = {(r["series_id"], r["h"]): r for r in smoothing.holt_forecast(fit, ID, 2).collect()}
    assert found["const", 2]["mean"] == pytest.approx(7)
    assert found["one", 1]["mean"] == pytest.approx(4)
    assert found["two", 1]["mean"] is not None


def test_ets_chooses_season_and_trend(spark):
    rng = np.random.default_rng(6)
    base = np.arange(72)
    figure = np.array([3, 1, -2, 4, 8, 2, -6, -5, 0, 1, -4, -2], float)
    y = 100 + 0.8 * base + 3 * np.tile(figure, 6) + rng.normal(0, 0.5, 72)
    level = 50 + rng.normal(0, 1, 60)
    packed = spine.pack(series_frame(spark, {"seasonal": y, "level": level}), ID)
    fit = smoothing.ets_fit(packed, ID, 12)
    found = by_id(fit)
    assert found["seasonal"]["model"].split(",")[2] in ("A)", "M)")
    assert found["level"]["model"].endswith("N,N)")
    rows = smoothing.ets_forecast(fit, ID, 12, 12).orderBy("series_id", "h").collect()
    ahead = [r["mean"] for r in rows if r["series_id"] == "seasonal"]
    truth = 100 + 0.8 * np.arange(72, 84) + 3 * figure
    assert np.abs(np.array(ahead) - truth).max() < 5
    assert all(r["lo_95"] <= r["mean"] <= r["hi_95"] for r in rows)
    widths = [r["hi_95"] - r["lo_95"] for r in rows if r["series_id"] == "level"]
    assert all(b >= a - 1e-9 for a, b in zip(widths, widths[1:]))


def test_ets_variance_of_simple_smoothing(spark):
    rng = np.random.default_rng(11)
    packed = spine.pack(series_frame(spark, {"y": rng.normal(0, 1, 80)}), ID)
    fit = smoothing.ets_fit(packed, ID)
    f = fit.first()
    assert f["model"] == "ETS(A,N,N)"  # negative values rule the others out
    row = smoothing.ets_forecast(fit, ID, 3, levels=(0.8,)).where("h = 3").first()
    half = (row["hi_80"] - row["lo_80"]) / 2
    assert half == pytest.approx(1.2815515655 * math.sqrt(f["sigma2"] * (1 + 2 * f["alpha"] ** 2)))


def test_boxcox_round_trip_and_exponent(spark):
    rng = np.random.default_rng(12)
    growth = np.exp(np.linspace(0, 4, 96) + rng.normal(0, 0.2, 96))
    df = series_frame(spark, {"growth": growth, "negative": -growth, "short": growth[:20]})
    found = by_id(boxcox.guerrero(df, ID, 12))
    assert abs(found["growth"]["lambda"]) < 0.3
    assert found["negative"]["lambda"] == 1 and found["short"]["lambda"] == 1
    for lam in (0.0, 0.5, -0.4):
        z = boxcox.transform(F.col("value"), F.lit(lam))
        worst = df.where("value > 0").select(
            F.max(F.abs(boxcox.inverse(z, F.lit(lam)) - F.col("value"))).alias("d")
        )
        assert worst.first()["d"] < 1e-8


def test_moving_average_edges_and_half_weights(spark):
    df = series_frame(spark, {"y": [1, 2, 4, 8, 16, 32]})
    out = df.withColumns(
        {
            "m3": decompose.moving_average(F.col("value"), ID, 3),
            "m2": decompose.moving_average(F.col("value"), ID, 2),
        }
    )
    assert values(out, "m3", "y")[0] is None
    assert values(out, "m3", "y")[1] == pytest.approx(7 / 3)
    assert values(out, "m2", "y")[1] == pytest.approx((1 + 2 * 2 + 4) / 4)


def test_time_index_and_refused_frequency(spark):
    df = series_frame(spark, {"y": [1.0] * 14})
    out = spine.time_index(df, 12, F.lit(8), F.lit(2016)).orderBy("t").collect()
    assert [r["phase"] for r in out][:6] == [8, 9, 10, 11, 12, 1]
    assert out[5]["decimal_time"] == pytest.approx(2017)
    with pytest.raises(ValueError):
        spine.time_index(df, 400, F.lit(1), F.lit(2016))


def test_split_last(spark):
    df = series_frame(spark, {"y": list(range(20)), "z": list(range(10))})
    out = spine.split_last(df, ID, 4)
    counts = {(r["series_id"], r["split"]): r["count"] for r in out.groupBy("series_id", "split").count().collect()}
    assert counts == {("y", "train"): 16, ("y", "valid"): 4, ("z", "train"): 6, ("z", "valid"): 4}


def test_mean_price_leaves_missing_prices_out(spark):
    items = spark.createDataFrame(
        [(1, 1, "a", 10.0), (1, 2, "a", None), (2, 1, "a", 20.0)],
        "order_id int, order_item_id int, cluster string, price double",
    ).withColumn("dt_purchase", F.lit("2018-01-05").cast("date"))
    row = facts.period_facts(items, ["cluster"], distinct_orders=True).first()
    assert (row["orders"], row["n_orders"]) == (3, 2)
    assert row["avg_price"] == pytest.approx(10) and row["mean_price"] == pytest.approx(15)


def test_accuracy_of_a_known_error(spark):
    rows = [("s", "m", "valid", t, 10.0 + t, 9.0 + t) for t in range(1, 6)]
    scored = spark.createDataFrame(
        rows, "series_id string, model string, split string, t int, actual double, forecast double"
    )
    train = spark.createDataFrame([("s", t, 2.0 * t) for t in range(1, 4)], "series_id string, t int, actual double")
    row = evaluate.accuracy(scored, train, ID).first()
    assert (row["me"], row["rmse"], row["mae"]) == (1, 1, 1)
    assert row["mase"] == pytest.approx(0.5)
    short = evaluate.accuracy(scored, train, ID, season=12).first()
    assert short["mase"] is None and row["acf1"] is None


def test_verdict(spark):
    df = series_frame(spark, {"up": LINE, "down": [100 - 2 * t for t in range(40)]})
    packed = spine.pack(df, ID)
    paths = smoothing.holt_forecast(smoothing.holt_fit(packed, ID), ID, 4)
    found = by_id(evaluate.growth_verdict(paths, packed, ID))
    assert found["up"]["verdict"] == "up" and found["down"]["verdict"] == "down"


def test_other_series_do_not_change_a_fit(spark):
    alone = series_frame(spark, {"y": SINE})
    joined = series_frame(spark, {"y": SINE, "z": LINE})
    fits = [
        smoothing.holt_fit(spine.pack(df, ID), ID).where("series_id = 'y'").drop("ys", "fitted").first()
        for df in (alone, joined)
    ]
    assert fits[0] == fits[1]


def test_fits_on_series_too_short_or_empty(spark):
    df = series_frame(spark, {"one": [4.0], "three": [1.0, 2.0, 3.0]})
    found = by_id(smoothing.ets_fit(spine.pack(df, ID), ID, 12))
    assert found["one"]["model"] is None and found["three"]["season"] is None
    empty = series_frame(spark, {"empty": [None, None], "long": LINE})
    fits = by_id(smoothing.ets_fit(spine.pack(empty, ID), ID))
    assert fits["empty"]["model"] is None and fits["long"]["model"] is not None
    holts = by_id(smoothing.holt_fit(spine.pack(empty, ID), ID))
    assert holts["empty"]["alpha"] is None and holts["long"]["alpha"] is not None


def test_chi_square_tail_has_no_limits(spark):
    """Against the finite Poisson sum that even degrees of freedom allow."""
    import math

    from supplycast.functions.stats import chi2_sf

    def poisson(x, df):
        half = x / 2
        return math.fsum(
            math.exp(k * math.log(half) - half - math.lgamma(k + 1)) for k in range(df // 2)
        )

    points = [
        (df * factor, df)
        for df in (2, 4, 10, 100, 480, 730, 2000)
        for factor in (0.1, 0.7, 0.95, 1.0, 1.02, 1.1, 1.5, 5.0)
    ] + [(1e5, 10), (1e5, 2000), (1200.0, 10), (900.0, 10), (1.0, 2000)]
    df = spark.createDataFrame(points, "x double, df int")
    for r in df.select("x", "df", chi2_sf(F.col("x"), F.col("df")).alias("p")).collect():
        assert r["p"] == pytest.approx(poisson(r["x"], r["df"]), rel=1e-8, abs=1e-13)
    odd = df.limit(1).select(chi2_sf(F.lit(3.841458820694124), F.lit(1)).alias("p")).first()["p"]
    assert odd == pytest.approx(0.05, abs=1e-12)


def test_ljung_box_of_a_daily_series(spark):
    from supplycast.operators import diagnose

    rng = np.random.default_rng(8)
    noise, level, path = rng.normal(size=2500), 0.0, []
    for e in noise:
        level = 0.9 * level + e
        path.append(level)
    packed = spine.pack(
        series_frame(spark, {"ar": path, "white": noise.tolist()}, step="day"), ["series_id"]
    )
    got = {r["series_id"]: r for r in diagnose.ljung_box(packed, ["series_id"], 365).collect()}
    assert got["ar"]["lag"] == 500 and got["ar"]["p_value"] == pytest.approx(0.0, abs=1e-12)
    assert 0.001 < got["white"]["p_value"] < 0.999


def test_autoregressive_spectrum(spark):
    rng = np.random.default_rng(11)
    quarter = [30 * math.sin(2 * math.pi * t / 12) + 0.5 * t + rng.normal(0, 3) for t in range(96)]
    walk = np.cumsum(rng.normal(size=120) * 5).tolist()
    series = {
        "year": quarter, "walk": walk, "const": [7.0] * 24, "short": [1.0, 5.0, 2.0],
        "gaps": [1.0, None, 3.0, 4.0, 8.0, 2.0], "small": rng.normal(0, 0.1, 60).tolist(),
    }
    out = by_id(decompose.autoregressive_spectrum(series_frame(spark, series), ID))
    assert set(out) == set(series)
    assert out["year"]["period"] == 12
    assert out["small"]["period"] == 1
    assert out["const"]["period"] is None and out["short"]["period"] is None
    assert out["gaps"]["period"] is None
    # coefficients by solving the Yule-Walker system at the chosen order
    x = np.array(quarter) - np.polyval(np.polyfit(np.arange(96), quarter, 1), np.arange(96))
    r = np.array([x[: 96 - k] @ x[k:] for k in range(25)]) / (x @ x)
    aic = []
    for p in range(20):
        lags = np.abs(np.subtract.outer(np.arange(p), np.arange(p)))
        a = np.linalg.solve(r[lags], r[1 : p + 1]) if p else np.zeros(0)
        aic.append((96 * np.log(1 - a @ r[1 : p + 1]) + 2 * p, p, a))
    _, p, a = min(aic, key=lambda c: c[:2])
    assert out["year"]["ar_order"] == p
    angle = np.pi * np.arange(500) / 499
    gain = np.abs(1 - np.exp(-1j * np.outer(angle, np.arange(1, p + 1))) @ a) ** 2
    density = (x @ x) / (96 - p - 1) * (1 - a @ r[1 : p + 1]) / gain
    assert out["year"]["density"] == pytest.approx(density.max(), rel=1e-6)


def test_fourier_matches_least_squares_with_gaps_and_short_series(spark):
    rng = np.random.default_rng(3)
    whole = rng.normal(size=60).tolist()
    gaps = [None if t % 7 == 3 else v for t, v in enumerate(whole)]
    series = {"whole": whole, "gaps": gaps, "none": [None] * 9, "two": [4.0, 6.0], None: whole}
    rows = decompose.fourier_decompose(series_frame(spark, series), ID, 12, 3).collect()
    assert len(rows) == 60 * 3 + 9 + 2
    t = np.arange(1, 61)
    design = np.column_stack(
        [np.ones(60), t, *[f(2 * np.pi * i * t / 12) for i in (1, 2, 3) for f in (np.sin, np.cos)]]
    )
    for name in ("whole", "gaps", None):
        y = np.array(series[name], float)
        known = ~np.isnan(y)
        coef = np.linalg.lstsq(design[known], y[known], rcond=None)[0]
        mine = sorted((r for r in rows if r["series_id"] == name), key=lambda r: r["t"])
        assert [r["trend"] for r in mine] == pytest.approx(design[:, :2] @ coef[:2], abs=1e-8)
        assert [r["season"] for r in mine] == pytest.approx(design[:, 2:] @ coef[2:], abs=1e-8)
        assert all((r["remainder"] is None) == (r["data"] is None) for r in mine)
    assert all(r["trend"] is None and r["season"] is None for r in rows if r["series_id"] == "none")
    # two points are met by the line alone
    assert [r["season"] for r in rows if r["series_id"] == "two"] == pytest.approx([0, 0])
    assert [r["remainder"] for r in rows if r["series_id"] == "two"] == pytest.approx([0, 0], abs=1e-9)
