"""Gap filling and outlier replacement on long series ``(keys, t, value)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Shares of the calendar that a running line covers.
SPANS = (0.05, 0.2, 0.5)


def interpolate(
    df: DataFrame, keys: list[str], value: str = "value", output: str = "filled"
) -> DataFrame:
    """Linear inside, constant at the ends; adds ``output`` and ``is_imputed``."""
    known = F.when(F.col(value).isNotNull(), F.struct(F.col("t"), F.col(value).alias("v")))
    series = Window.partitionBy(*keys)
    so_far = Window.unboundedPreceding, Window.currentRow
    before = F.last(known, ignorenulls=True).over(series.orderBy("t").rowsBetween(*so_far))
    after = F.last(known, ignorenulls=True).over(
        series.orderBy(F.col("t").desc()).rowsBetween(*so_far)
    )
    p, n = F.col("_before"), F.col("_after")
    line = p["v"] + (n["v"] - p["v"]) * (F.col("t") - p["t"]) / (n["t"] - p["t"])
    filled = (
        F.when(F.col(value).isNotNull(), F.col(value))
        .when(p.isNull(), n["v"])
        .when(n.isNull(), p["v"])
        .otherwise(line)
    )
    return (
        df.withColumn("_before", before)
        .withColumn("_after", after)
        .withColumns({output: filled, "is_imputed": F.col(value).isNull()})
        .drop("_before", "_after")
    )


def _replace_far(rest: DataFrame, keys: list[str]) -> DataFrame:
    """Interpolate the points of ``fixed`` whose distance ``_rest`` from the trend is far out."""
    series = Window.partitionBy(*keys)
    quartiles = rest.withColumn(
        "_q", F.percentile("_rest", F.array(F.lit(0.25), F.lit(0.75))).over(series)
    )
    low, high = F.col("_q")[0], F.col("_q")[1]
    far = (F.col("_rest") < low - 3 * (high - low)) | (F.col("_rest") > high + 3 * (high - low))
    is_outlier = F.coalesce(far & (high - low > 1e-14), F.lit(False))
    marked = quartiles.withColumns(
        {
            "is_outlier": F.col("is_outlier") | is_outlier,
            "_kept": F.when(~(F.col("is_outlier") | is_outlier), F.col("fixed")),
        }
    )
    if "is_imputed" in rest.columns:
        marked = marked.withColumnRenamed("is_imputed", "_was")
    out = interpolate(marked, keys, "_kept", "fixed").drop("_rest", "_q", "_kept", "is_imputed")
    return out.withColumnRenamed("_was", "is_imputed")


def median_outliers(
    df: DataFrame, keys: list[str], value: str = "value", reach: int = 7, passes: int = 2
) -> DataFrame:
    """Replace points far from a running median; adds ``fixed`` and ``is_outlier``.

    Far means outside the residual quartiles by three times their distance.
    """
    out = df.withColumns({"fixed": F.col(value), "is_outlier": F.lit(False)})
    near = Window.partitionBy(*keys).orderBy("t").rowsBetween(-reach, reach)
    for _ in range(passes):
        rest = F.col("fixed") - F.percentile("fixed", 0.5).over(near)
        out = _replace_far(out.withColumn("_rest", rest), keys)
    return out


def _running_lines(
    df: DataFrame,
    keys: list[str],
    lines: list[tuple[str, int, str, str | None]],
    centre: Column | None = None,
) -> DataFrame:
    """Least-squares lines through the ``2 * half + 1`` nearest points of each row.

    ``lines`` are ``(value, half, fit, error)`` with the names of the new columns; the error is that
    of the line without the row itself.  At the ends of a series the nearest points are its first or last
    ones.  Moments are differences of running sums, so the work does not depend on the width; a
    ``centre`` near the values keeps these sums small.
    """
    by_time = Window.partitionBy(*keys).orderBy("t")
    so_far = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    series = by_time.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    centre = F.lit(0.0) if centre is None else centre
    out = df.withColumns(
        {
            name: F.sum(moment).over(so_far)
            for v in dict.fromkeys(value for value, *_ in lines)
            for name, moment in (
                (f"_sum_{v}", F.col(v) - centre),
                (f"_dot_{v}", F.col("_at") * (F.col(v) - centre)),
            )
        }
    )
    n, at = F.col("_n"), F.col("_at")
    halves = dict.fromkeys(half for _, half, *_ in lines)
    out = out.withColumns({f"_w_{h}": F.least(F.lit(2.0 * h + 1), n) for h in halves})
    out = out.withColumns(
        {
            f"_first_{h}": F.least(F.greatest(at - h, F.lit(0.0)), n - F.col(f"_w_{h}"))
            for h in halves
        }
    )

    def total(sums: str, half: int) -> Column:
        width, first = F.col(f"_w_{half}"), F.col(f"_first_{half}")
        at_row = lambda i: F.max(F.when(at == i, F.col(sums))).over(series)
        left, right = first == 0, first == n - width
        upper = F.when(left, at_row(width - 1)).when(right, at_row(n - 1))
        lower = F.when(left, 0.0).when(right, at_row(n - width - 1))
        return upper.otherwise(F.lead(sums, half).over(by_time)) - lower.otherwise(
            F.lag(sums, half + 1).over(by_time)
        )

    added = {}
    for value, half, fit, _ in lines:
        added[f"_my_{fit}"] = total(f"_sum_{value}", half) / F.col(f"_w_{half}")
        added[f"_mxy_{fit}"] = total(f"_dot_{value}", half) / F.col(f"_w_{half}")
    out, fits, errors = out.withColumns(added), {}, {}
    for value, half, fit, error in lines:
        width, first = F.col(f"_w_{half}"), F.col(f"_first_{half}")
        my, mxy = F.col(f"_my_{fit}"), F.col(f"_mxy_{fit}")
        mx, spread = first + (width - 1) / 2, F.greatest((width * width - 1) / 12, F.lit(1e-12))
        fits[fit] = centre + my + (mxy - mx * my) / spread * (at - mx)
        own = 1 / width + (at - mx) * (at - mx) / (width * spread)
        if error:
            alone = 1 - F.least(F.greatest(own, F.lit(0.0)), F.lit(0.999))
            errors[error] = F.abs(F.col(value) - F.col(fit)) / alone
    out = out.withColumns(fits).withColumns(errors) if errors else out.withColumns(fits)
    return out.select(*df.columns, *[c for _, _, *both in lines for c in both if c])


def variable_span(
    df: DataFrame, keys: list[str], value: str, periods: int, output: str = "smooth"
) -> DataFrame:
    """Running lines over 5, 20 or 50 percent of ``periods``, the span chosen anew at every point.

    The span with the least smoothed error of the lines without the point itself is wanted; wanted spans
    are smoothed, the lines of the two spans around them mixed, and the result smoothed once more.
    """
    halves = [max(int(0.5 * s * periods + 0.5), 2) for s in SPANS]
    by_time = Window.partitionBy(*keys).orderBy("t")
    series = by_time.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = df.withColumns(
        {
            "_at": (F.row_number().over(by_time) - 1).cast("double"),
            "_n": F.count("*").over(series).cast("double"),
            "_centre": F.avg(value).over(series),
        }
    )
    centre = F.col("_centre")
    fits = [(value, h, f"_f{k}", f"_e{k}") for k, h in enumerate(halves)]
    rows = _running_lines(rows, keys, fits, centre)
    rows = _running_lines(rows, keys, [(f"_e{k}", halves[1], f"_r{k}", None) for k in range(3)])
    least = F.least("_r0", "_r1", "_r2")
    wanted = F.when(F.col("_r0") == least, SPANS[0]).when(F.col("_r1") == least, SPANS[1])
    rows = rows.withColumn("_best", wanted.otherwise(SPANS[2]))
    rows = _running_lines(rows, keys, [("_best", halves[1], "_span", None)])
    span = F.least(F.greatest(F.col("_span"), F.lit(SPANS[0])), F.lit(SPANS[-1]))
    low, high = (span - SPANS[0]) / (SPANS[1] - SPANS[0]), (span - SPANS[1]) / (SPANS[2] - SPANS[1])
    mixed = F.when(
        span <= SPANS[1], F.col("_f0") * (1 - low) + F.col("_f1") * low
    ).otherwise(F.col("_f1") * (1 - high) + F.col("_f2") * high)
    last = [("_mixed", halves[0], output, None)]
    rows = _running_lines(rows.withColumn("_mixed", mixed), keys, last, centre)
    return rows.select(*df.columns, output)


def smooth_outliers(
    df: DataFrame,
    keys: list[str],
    value: str = "value",
    passes: int = 2,
    periods: int | None = None,
) -> DataFrame:
    """As ``median_outliers`` with the variable-span smoother as trend.

    ``periods`` is the length of the common calendar, by default that of the longest series.
    """
    if periods is None:
        periods = df.agg(F.max("t") - F.min("t") + 1).first()[0] or 1
    out = df.withColumns({"fixed": F.col(value), "is_outlier": F.lit(False)})
    for _ in range(passes):
        trend = variable_span(out, keys, "fixed", periods, "_trend")
        rest = trend.withColumn("_rest", F.col("fixed") - F.col("_trend")).drop("_trend")
        out = _replace_far(rest, keys)
    return out


def repair(
    dense: DataFrame, keys: list[str], metrics: list[str], trend: str = "supersmoother"
) -> DataFrame:
    """Gaps filled, then outliers replaced, for all metrics of a dense table.

    Returns the comparison table ``(keys, metric, t, ds, raw, fixed, is_imputed,
    is_outlier)``.
    """
    long = dense.unpivot([*keys, "ds", "t", "is_padding"], metrics, "metric", "raw")
    by = [*keys, "metric"]
    filled = interpolate(long, by, "raw")
    replace = {"supersmoother": smooth_outliers, "running_median": median_outliers}[trend]
    return replace(filled, by, "filled").drop("filled")
