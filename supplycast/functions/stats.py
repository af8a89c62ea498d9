"""Statistical expressions that stay defined on constant and empty input."""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money_sum(price: Column) -> Column:
    """Exact sum of an amount, whatever the order of the rows."""
    return F.sum(price.cast(MONEY))


def pearson(x: Column, y: Column) -> Column:
    """Correlation over complete pairs; NULL when a side does not vary."""
    both = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))


def slope(y: Column, x: Column) -> Column:
    both = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(xs, ys), F.var_pop(xs))


def normal_quantile(level: float) -> float:
    """Half-width of a two-sided interval in standard deviations."""
    return NormalDist().inv_cdf(0.5 + level / 2)


def array_total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


#: fixed values: Lanczos coefficients for g = 7
_LANCZOS = (
    0.99999999999980993,
    676.5203681218851,
    -1259.1392167224028,
    771.32342877765313,
    -176.61502916214059,
    12.507343278686905,
    -0.13857109526572012,
    9.9843695780195716e-6,
    1.5056327351493116e-7,
)


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for arguments from one half on."""
    total = F.lit(_LANCZOS[0])
    for k, c in enumerate(_LANCZOS[1:]):
        total = total + F.lit(c) / (x + k)
    t = x + 6.5
    return F.lit(0.5 * math.log(2 * math.pi)) + (x - 0.5) * F.ln(t) - t + F.ln(total)


def chi2_sf(x: Column, df: Column) -> Column:
    """Upper tail of the chi-square law, for any number of degrees of freedom.

    Below the mean the power series of the lower tail is summed, above it the continued fraction of
    the upper one.  Both need a multiple of the square root of the degrees of freedom in steps.
    """
    a, half = df / 2.0, x / 2.0
    steps = F.sequence(F.lit(1), (60 + 20 * F.sqrt(a)).cast("int"))
    one, tiny = F.lit(1.0), F.lit(1e-300)
    series = F.aggregate(
        steps,
        F.struct(one.alias("term"), one.alias("total")),
        lambda acc, i: F.struct(
            (acc["term"] * half / (a + i)).alias("term"),
            (acc["total"] + acc["term"] * half / (a + i)).alias("total"),
        ),
        lambda acc: acc["total"],
    )
    start = half + 1 - a

    def away(value: Column) -> Column:
        return F.when(F.abs(value) < tiny, tiny).otherwise(value)

    def step(acc: Column, i: Column) -> Column:
        weight, base = -i * (i - a), start + 2 * i
        below = 1 / away(weight * acc["d"] + base)
        above = away(base + weight / acc["c"])
        return F.struct(
            above.alias("c"), below.alias("d"), (acc["h"] * above * below).alias("h")
        )

    first = 1 / away(start)
    fraction = F.aggregate(
        steps,
        F.struct((1 / tiny).alias("c"), first.alias("d"), first.alias("h")),
        step,
        lambda acc: acc["h"],
    )
    scale = a * F.ln(half) - half
    lower = F.exp(scale - log_gamma(a + 1)) * series
    upper = F.exp(scale - log_gamma(a)) * fraction
    tail = F.when(half < a + 1, 1 - lower).otherwise(upper)
    within = F.greatest(F.lit(0.0), F.least(one, tail))
    return F.when(df < 1, None).when(x <= 0, one).otherwise(within)
