"""Hold-out scores, model choice and comparison tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def match_actuals(forecasts: DataFrame, actuals: DataFrame, keys: list[str]) -> DataFrame:
    """Forecast and observed value of the same series and period."""
    return forecasts.join(actuals.select(*keys, "t", "actual"), [*keys, "t"])


def accuracy(
    scored: DataFrame, train: DataFrame, keys: list[str], season: int = 1
) -> DataFrame:
    """Error measures per series, model and split.

    ``scored`` holds ``(keys, model, split, t, actual, forecast)``; ``train``
    holds ``(keys, t, actual)`` and gives the scale of MASE, the mean absolute
    lag-``season`` difference, NULL when the training part is too short.
    """
    by_time = Window.partitionBy(*keys).orderBy("t")
    naive = F.abs(F.col("actual") - F.lag("actual", season).over(by_time))
    scale = train.withColumn("_naive", naive).groupBy(*keys).agg(F.avg("_naive").alias("_scale"))

    group = [*keys, "model", "split"]
    whole = Window.partitionBy(*group)
    rows = scored.withColumn("_e", F.col("actual") - F.col("forecast"))
    rows = rows.withColumn("_c", F.col("_e") - F.avg("_e").over(whole))
    order = whole.orderBy("t")
    before = F.lag("actual").over(order)
    rows = rows.withColumns(
        {
            "_c1": F.lag("_c").over(order),
            "_fpe": F.try_divide(F.col("_e"), before),
            "_ape": F.try_divide(F.col("actual") - before, before),
        }
    )
    pct = 100 * F.try_divide(F.col("_e"), F.col("actual"))
    scores = rows.groupBy(*group).agg(
        F.count("_e").alias("n"),
        F.avg("_e").alias("me"),
        F.sqrt(F.avg(F.col("_e") * F.col("_e"))).alias("rmse"),
        F.avg(F.abs("_e")).alias("mae"),
        F.avg(pct).alias("mpe"),
        F.avg(F.abs(pct)).alias("mape"),
        F.try_divide(F.sum(F.col("_c") * F.col("_c1")), F.sum(F.col("_c") * F.col("_c"))).alias(
            "acf1"
        ),
        F.sqrt(
            F.try_divide(F.sum(F.col("_fpe") * F.col("_fpe")), F.sum(F.col("_ape") * F.col("_ape")))
        ).alias("theils_u"),
    )
    return (
        scores.join(scale, keys, "left")
        .withColumn("mase", F.try_divide(F.col("mae"), F.col("_scale")))
        .drop("_scale")
    )


def best_model(
    scores: DataFrame, keys: list[str], by: str = "rmse", split: str = "valid"
) -> DataFrame:
    """Model with the least error on the hold-out; ties go to the first name."""
    return (
        scores.where(F.col("split") == split)
        .groupBy(*keys)
        .agg(
            F.min_by("model", F.struct(by, "model")).alias("best_model"),
            F.min(by).alias(f"best_{by}"),
            F.count("*").alias("n_models"),
        )
    )


def overlay(
    keys: list[str],
    observed: DataFrame,
    fitted: DataFrame,
    forecasts: DataFrame,
    level: int = 95,
) -> DataFrame:
    """Plot-ready rows: observed (with its split), fitted and forecast with bounds."""
    none = F.lit(None).cast("double")
    parts = [
        observed.select(*keys, "t", F.col("split").alias("kind"), F.col("actual").alias("value"),
                        none.alias("lo"), none.alias("hi")),
        fitted.select(*keys, "t", F.lit("fitted").alias("kind"), F.col("fitted").alias("value"),
                      none.alias("lo"), none.alias("hi")),
        forecasts.select(*keys, "t", F.lit("forecast").alias("kind"), F.col("mean").alias("value"),
                         F.col(f"lo_{level}").alias("lo"), F.col(f"hi_{level}").alias("hi")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def growth_verdict(forecasts: DataFrame, packed: DataFrame, keys: list[str]) -> DataFrame:
    """Up, down or flat: mean forecast against the last observed value."""
    path = forecasts.groupBy(*keys).agg(
        F.avg("mean").alias("mean_forecast"),
        (F.max_by("mean", "h") - F.min_by("mean", "h")).alias("path_change"),
    )
    last = packed.select(*keys, F.element_at("ys", -1).alias("last_actual"))
    change = F.col("mean_forecast") - F.col("last_actual")
    return path.join(last, keys).withColumn(
        "verdict", F.when(change > 0, "up").when(change < 0, "down").otherwise("flat")
    )
