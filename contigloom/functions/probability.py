"""Log-probabilities as column expressions, so that they stay inside generated code."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def log_gamma(x: Column) -> Column:
    """ln of the gamma function for x > 0: Stirling's series after a shift by 8."""
    shifted = x + F.lit(8.0)
    product = F.lit(1.0)
    for i in range(8):
        product = product * (x + float(i))
    inv = F.lit(1.0) / shifted
    square = inv * inv
    series = inv * (F.lit(1 / 12) - square * (F.lit(1 / 360) - square * (F.lit(1 / 1260) - square * (F.lit(1 / 1680) - square * F.lit(1 / 1188)))))
    return (shifted - 0.5) * F.log(shifted) - shifted + 0.5 * math.log(2 * math.pi) + series - F.log(product)


def stirling_log_factorial(n: Column) -> Column:
    """Stirling's formula for ln n!, 0 for n below 2."""
    return F.when(n < 2, F.lit(0.0)).otherwise(n * F.log(n) - n + 0.5 * F.log(2 * math.pi * n))


def nb_logpmf(k: Column, mean: Column, r: Column) -> Column:
    """Negative binomial with the given mean and dispersion r; k is rounded; null where mean or r is not positive."""
    k = F.round(k)
    ok = (mean > 0) & (r > 0)
    m, d = F.when(ok, mean.cast("double")), F.when(ok, r.cast("double"))
    return d * F.log(d / (d + m)) + log_gamma(d + k) + k * F.log(m / (d + m)) - log_gamma(k + 1.0) - log_gamma(d)


def poisson_logpmf(k: Column, mean: Column) -> Column:
    """Poisson with a mean that is rounded first; null where the rounded mean is not positive."""
    m = F.nullif(F.greatest(F.round(mean.cast("double")), F.lit(0.0)), F.lit(0.0))
    return k * F.log(m) - m - log_gamma(k + 1.0)


LIKELIHOODS = {"negative_binomial": nb_logpmf, "poisson": lambda k, mean, r: poisson_logpmf(k, mean)}
