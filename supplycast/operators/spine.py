"""Dense calendars per series, time index, slices and splits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplycast.sources.scratch import materialize

STEP = {"day": "1 day", "week": "7 days", "month": "1 month"}


def _bound(facts: DataFrame, given: str | dt.date | None, function) -> Column:
    if given is not None:
        return F.lit(str(given)).cast("date")
    return facts.agg(function("ds")).scalar()


def spine(
    facts: DataFrame,
    keys: list[str],
    grain: str = "day",
    start: str | dt.date | None = None,
    end: str | dt.date | None = None,
) -> DataFrame:
    """All periods from start to end for every series.

    The calendar is common to all series and defaults to the extent of the
    facts.  It is generated per series row, without a join.
    """
    return _calendar(materialize(facts.select(*keys, "ds"), "calendar"), keys, grain, start, end)


def _calendar(facts, keys, grain, start, end) -> DataFrame:
    first, last = _bound(facts, start, F.min), _bound(facts, end, F.max)
    days = F.sequence(first, last, F.expr(f"interval {STEP[grain]}"))
    if not keys:
        return facts.sparkSession.range(1).select(F.explode(days).alias("ds"))
    return facts.select(*keys).distinct().select(*keys, F.explode(days).alias("ds"))


def densify(
    facts: DataFrame,
    keys: list[str],
    grain: str = "day",
    start: str | dt.date | None = None,
    end: str | dt.date | None = None,
) -> DataFrame:
    """Left join of the facts on the calendar; ``is_padding`` marks periods before the data.

    ``t`` counts periods from 1.  The facts are written once, because extent,
    keys and values read them, and recomputing them reads all items again.
    """
    facts = materialize(facts, "facts")
    calendar = _calendar(facts, keys, grain, start, end)
    first_seen = facts.agg(F.min("ds")).scalar()
    begin = _bound(facts, start, F.min)
    return calendar.join(facts, [*keys, "ds"], "left").withColumns(
        {"t": period_number(F.col("ds"), begin, grain), "is_padding": F.col("ds") < first_seen}
    )


def period_number(day: Column, begin: Column, grain: str) -> Column:
    if grain == "month":
        months = (F.year(day) - F.year(begin)) * 12 + F.month(day) - F.month(begin)
        return months + 1
    days = F.datediff(day, begin)
    return (days if grain == "day" else F.floor(days / 7).cast("int")) + 1


def time_index(df: DataFrame, freq: float, start_period: Column, start_year: Column) -> DataFrame:
    """``phase`` within the cycle and ``decimal_time`` of row ``t``.

    A frequency up to 12 is monthly, up to 365 daily; others are refused.
    """
    if not 1 <= freq <= 365:
        raise ValueError(f"frequency must lie between 1 and 365, got {freq}")
    offset = start_period - 1 + F.col("t") - 1
    columns = {"decimal_time": start_year + offset / F.lit(float(freq))}
    if float(freq).is_integer():
        columns["phase"] = F.pmod(offset, F.lit(int(freq))) + 1
    return df.withColumns(columns)


def time_slice(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Inclusive window on ``ds``."""
    if start is not None:
        df = df.where(F.col("ds") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col("ds") <= F.lit(end).cast("date"))
    return df


def split_at(df: DataFrame, start: str, cut: str, *, overlap: bool = False) -> DataFrame:
    """Label rows from ``start`` on as train (before ``cut``) or valid.

    With ``overlap`` the period of the cut belongs to both parts.
    """
    cut_day = F.lit(cut).cast("date")
    kept = time_slice(df, start)
    if not overlap:
        label = F.when(F.col("ds") < cut_day, "train").otherwise("valid")
        return kept.withColumn("split", label)
    labels = (
        F.when(F.col("ds") < cut_day, F.array(F.lit("train")))
        .when(F.col("ds") == cut_day, F.array(F.lit("train"), F.lit("valid")))
        .otherwise(F.array(F.lit("valid")))
    )
    return kept.withColumn("split", F.explode(labels))


def split_last(df: DataFrame, keys: list[str], n_valid: int) -> DataFrame:
    """The last ``n_valid`` periods of every series are the hold-out."""
    last = F.max("t").over(Window.partitionBy(*keys))
    label = F.when(F.col("t") > last - n_valid, "valid").otherwise("train")
    return df.withColumn("split", label)


def seasonal_diff(df: DataFrame, keys: list[str], lag: int, value: str = "value") -> DataFrame:
    by_time = Window.partitionBy(*keys).orderBy("t")
    return df.withColumn("diff", F.col(value) - F.lag(value, lag).over(by_time))


def pack(
    df: DataFrame, keys: list[str], value: str = "value", day: str = "ds", tasks: int | None = None
) -> DataFrame:
    """One row per series with the values in time order.

    The length of a series is bounded by its calendar, whatever the number of
    order items behind it.  ``tasks`` fixes the number of partitions ahead of
    costly fits, where few bytes stand for much work.
    """
    if tasks:
        df = df.repartition(tasks, *keys)
    points = F.array_sort(F.collect_list(F.struct(F.col("t"), F.col(value).alias("y"))))
    return df.groupBy(*keys).agg(
        F.transform(points, lambda p: p["y"].cast("double")).alias("ys"),
        F.max(day).alias("last_ds"),
        F.max("t").alias("last_t"),
    )
