"""Box-Cox transform with the automatic exponent of Guerrero (1993)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplycast.functions.stats import array_total


def transform(y: Column, lam: Column) -> Column:
    """Box-Cox scale; a positive exponent keeps the sign and so takes any value.

    NULL where it is undefined: a value of zero or below with an exponent of zero or below.
    """
    power = (F.signum(y) * F.pow(F.abs(y), lam) - 1) / lam
    logged = F.abs(lam) < 1e-12
    return F.when((y > 0) | ((lam > 0) & ~logged), F.when(logged, F.ln(y)).otherwise(power))


def inverse(z: Column, lam: Column) -> Column:
    base = lam * z + 1
    base = F.when(lam > 0, base).otherwise(F.greatest(base, F.lit(0.0)))
    power = F.signum(base) * F.pow(F.abs(base), 1 / lam)
    return F.when(z.isNotNull(), F.when(F.abs(lam) < 1e-12, F.exp(z)).otherwise(power))


def guerrero(
    df: DataFrame,
    keys: list[str],
    freq: int,
    value: str = "value",
    low: float = -1.0,
    high: float = 2.0,
    steps: int = 300,
) -> DataFrame:
    """Exponent per series with the least variation of sd / mean^(1 - lambda) over blocks.

    Blocks are whole cycles counted from the end.  Series of two cycles or
    fewer, or with non-positive values, keep the exponent 1.
    """
    period = max(freq, 2)
    sizes = df.groupBy(*keys).agg(
        F.max("t").alias("_last"),
        F.count(value).alias("n"),
        F.min(value).alias("_least"),
    )
    block = F.floor((F.col("_last") - F.col("t")) / period)
    blocks = (
        df.join(sizes, keys)
        .withColumn("_block", block)
        .groupBy(*keys, "n", "_least", "_block")
        .agg(
            F.avg(value).alias("m"), F.stddev_samp(value).alias("s"), F.count(value).alias("_size")
        )
        .groupBy(*keys, "n", "_least")
        .agg(
            F.array_sort(
                F.collect_list(F.when(F.col("_size") == period, F.struct("_block", "m", "s")))
            ).alias("_b")
        )
    )
    exponents = F.transform(
        F.sequence(F.lit(0), F.lit(steps)), lambda i: F.lit(low) + i * ((high - low) / steps)
    )

    def variation(lam: Column) -> Column:
        ratios = F.transform("_b", lambda b: b["s"] / F.pow(b["m"], 1 - lam))
        mean = array_total(ratios) / F.size(ratios)
        spread = array_total(F.transform(ratios, lambda r: (r - mean) * (r - mean)))
        sd = F.sqrt(F.try_divide(spread, F.size(ratios) - 1))
        return F.struct(F.coalesce(F.try_divide(sd, mean), F.lit(1e300)).alias("cv"), lam.alias("lambda"))

    usable = (F.col("n") > 2 * freq) & (F.col("_least") > 0) & (F.size("_b") >= 2)
    best = blocks.withColumn(
        "_best", F.when(usable, F.array_min(F.transform(exponents, variation)))
    )
    return best.select(
        *keys, F.coalesce(F.col("_best")["lambda"], F.lit(1.0)).alias("lambda")
    )
