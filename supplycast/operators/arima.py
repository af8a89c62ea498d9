"""ARIMA by exact Gaussian likelihood: given orders, or a search over (series, candidate) rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import product

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supplycast.functions import arma
from supplycast.functions.stats import normal_quantile
from supplycast.operators import boxcox
from supplycast.operators.diagnose import difference, difference_order, seasonal_strength
from supplycast.operators.spine import pack

ORDERS = ("p", "q", "sp", "sq", "constant")
SHAPE = ("p", "d", "q", "sp", "sd", "sq")
# Fixed value: share of variance above which a season is differenced.
SEASONAL = 0.64
_NUMBERS = ("sigma2", "loglik", "aic", "aicc", "bic")
_ESTIMATES = ("coefficients", "std_errors")
_PATHS = ("residuals", "mean", "se")
#: rows whose results a Python worker holds at a time
SLICE = 250


def candidates(most: int, season: bool) -> list[tuple[int, int, int, int, int]]:
    """(p, q, P, Q, constant) with p, q <= 5, P, Q <= 2 and at most ``most`` terms."""
    seasonal = range(3) if season else range(1)
    return [
        (p, q, sp, sq, c)
        for p, q, sp, sq, c in product(range(6), range(6), seasonal, seasonal, (0, 1))
        if p + q + sp + sq <= most
    ]


def _doubles(names: Iterable[str], arrays: bool) -> list[T.StructField]:
    kind = T.ArrayType(T.DoubleType()) if arrays else T.DoubleType()
    return [T.StructField(n, kind) for n in names]


def _added(df: DataFrame, fields: list[T.StructField], one_row) -> DataFrame:
    """``df`` with the columns that ``one_row`` gives for each of its rows, NULL where it gives none."""
    names = [f.name for f in fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), SLICE):
                part = batch.iloc[start : start + SLICE]
                found = [one_row(r) for r in part.itertuples()]
                extra = pd.DataFrame(found, index=part.index).reindex(columns=names)
                extra = extra.astype(object).where(extra.notna(), None)
                yield pd.concat([part, extra], axis=1)

    return df.mapInPandas(run, T.StructType(df.schema.fields + fields))


def _estimated(rows: DataFrame, freq: int, horizon: int | None = None) -> DataFrame:
    """Fitted rows; with a horizon also their residuals and forecasts, by the same Python worker."""
    fields = [
        T.StructField("reason", T.StringType()),
        *_doubles(_NUMBERS, False),
        *_doubles(_ESTIMATES, True),
    ]

    def one_row(r) -> dict:
        shape = [getattr(r, c) for c in SHAPE]
        found = arma.fit(r.ys, *shape, freq, r.constant)
        if horizon is None or found.get("coefficients") is None:
            return found
        estimates = found["coefficients"], found["sigma2"]
        return found | arma.predict(r.ys, *shape, freq, r.constant, *estimates, horizon)

    paths = [] if horizon is None else _doubles(_PATHS, True)
    return _added(rows, fields + paths, one_row)


def _extended(fits: DataFrame, freq: int, horizon: int) -> DataFrame:
    """Residuals and forecasts of the fitted rows, from their coefficients."""

    def one_row(r) -> dict:
        if r.coefficients is None:
            return {}
        shape = (int(getattr(r, c)) for c in SHAPE)
        return arma.predict(
            r.ys, *shape, freq, int(r.constant), r.coefficients, r.sigma2, horizon
        )

    return _added(fits, _doubles(_PATHS, True), one_row)


def _named(fits: DataFrame) -> DataFrame:
    order = F.format_string("(%d,%d,%d)", "p", "d", "q")
    season = F.when(
        F.col("sp") + F.col("sd") + F.col("sq") > 0, F.format_string("(%d,%d,%d)", "sp", "sd", "sq")
    ).otherwise("")
    drift = F.when(F.col("constant") == 1, " with constant").otherwise("")
    name = F.concat(F.lit("ARIMA"), order, season, drift)
    return fits.withColumn("model", F.when(F.col("coefficients").isNotNull(), name))


def fixed(
    packed: DataFrame,
    horizon: int,
    order: tuple[int, int, int],
    season: tuple[int, int, int] = (0, 0, 0),
    *,
    freq: int = 1,
    constant: bool = False,
) -> DataFrame:
    """One given order for every series; those it does not fit keep their row, with a ``reason``."""
    shape = {c: F.lit(v) for c, v in zip(SHAPE, (*order, *season))}
    rows = packed.withColumns({**shape, "constant": F.lit(int(constant)), "n_candidates": F.lit(1)})
    return _named(_estimated(rows, freq, horizon))


def search(
    packed: DataFrame,
    keys: list[str],
    *,
    freq: int = 1,
    seasonal: bool = False,
    most: int = 5,
    tasks: int | None = None,
) -> DataFrame:
    """Every candidate fitted, one row each; failed ones carry a reason.

    A series is differenced at the season when that explains most of its
    detrended variance, and then as often as the level-stationarity test asks.
    Seasonal terms need two whole cycles.  Rows are spread over ``tasks`` by
    series and candidate, because few bytes stand for much work.
    """
    spark = packed.sparkSession
    use_season = seasonal and freq > 1
    grid = F.array(
        *[
            F.struct(*[F.lit(v).alias(n) for n, v in zip(ORDERS, cell)])
            for cell in candidates(most, use_season)
        ]
    )
    ordered = packed.withColumns({"sd": F.lit(0), "_w": F.col("ys")})
    if use_season:
        strong = F.coalesce(F.col("strength") > SEASONAL, F.lit(False))
        ordered = seasonal_strength(packed, freq).withColumn("sd", strong.cast("int"))
        ordered = ordered.withColumn(
            "_w", F.when(F.col("sd") == 1, difference(F.col("ys"), freq)).otherwise(F.col("ys"))
        )
    rows = (
        difference_order(ordered, "_w")
        .select(*packed.columns, "d", "sd", F.inline(grid))
        .where((F.size("ys") >= 2 * freq) | (F.col("sp") + F.col("sq") == 0))
        .where("constant = 0 OR d + sd <= 1")
    )
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return _estimated(rows.repartition(tasks, *keys, *ORDERS), freq)


def auto(packed: DataFrame, keys: list[str], horizon: int, **options) -> DataFrame:
    """Candidate with the least corrected AIC per series, with its forecast arrays.

    Candidates are compared by their criteria and coefficients only; residuals and forecasts are
    made for the chosen one.  A series that no candidate fits (too short, gaps) keeps its row, with a ``reason`` and no model.
    """
    tried = search(packed, keys, **options)
    whole = F.struct(*[c for c in tried.columns if c not in [*keys, "reason"]])
    fitted = F.col("reason").isNull()
    best = tried.groupBy(*keys).agg(
        F.min_by(F.when(fitted, whole), F.when(fitted, F.struct("aicc", *ORDERS))).alias("_b"),
        F.count_if(fitted).alias("n_candidates"),
        F.min("reason").alias("_reason"),
    )
    failed = F.when(F.col("n_candidates") == 0, F.col("_reason"))
    chosen = best.select(*keys, "n_candidates", failed.alias("reason"), "_b.*")
    return _named(_extended(chosen, options.get("freq", 1), horizon))


def auto_boxcox(
    df: DataFrame, keys: list[str], horizon: int, freq: int, value: str = "value", **options
) -> DataFrame:
    """Search on the Box-Cox scale with the automatic exponent; adds ``lambda``."""
    exponents = boxcox.guerrero(df, keys, freq, value)
    scaled = df.join(exponents, keys).withColumn(
        "_z", boxcox.transform(F.col(value), F.col("lambda"))
    )
    packed = pack(scaled, [*keys, "lambda"], "_z")
    return auto(packed, [*keys, "lambda"], horizon, freq=freq, **options)


def forecast(
    fit: DataFrame, keys: list[str], levels: tuple[float, ...] = (0.8, 0.95)
) -> DataFrame:
    """Forecast rows with normal bounds, back on the original scale if transformed."""
    pairs = F.zip_with("mean", "se", lambda m, s: F.struct(m.alias("m"), s.alias("s")))
    back = (
        (lambda z: boxcox.inverse(z, F.col("lambda"))) if "lambda" in fit.columns else (lambda z: z)
    )
    rows = fit.select(*fit.columns, F.posexplode(pairs).alias("_i", "_f"))
    bounds = []
    for level in levels:
        z, tag = normal_quantile(level), round(level * 100)
        bounds += [
            back(F.col("_f.m") - z * F.col("_f.s")).alias(f"lo_{tag}"),
            back(F.col("_f.m") + z * F.col("_f.s")).alias(f"hi_{tag}"),
        ]
    return rows.select(
        *keys,
        "model",
        (F.col("_i") + 1).alias("h"),
        (F.col("last_t") + F.col("_i") + 1).alias("t"),
        back(F.col("_f.m")).alias("mean"),
        *bounds,
    )


def residual_rows(fit: DataFrame, keys: list[str]) -> DataFrame:
    """Residuals on the fitted scale, aligned with the last periods of the series."""
    start = F.col("last_t") - F.size("residuals")
    rows = fit.select(*keys, "model", start.alias("_s"), F.posexplode("residuals").alias("_i", "residual"))
    return rows.select(*keys, "model", (F.col("_s") + F.col("_i") + 1).alias("t"), "residual")


def summary(fit: DataFrame, keys: list[str]) -> DataFrame:
    """Order, coefficients with their errors, and criteria per series."""
    return fit.select(
        *keys, "model", "reason", *_ESTIMATES, F.size("ys").alias("n"), "n_candidates", *_NUMBERS
    )
