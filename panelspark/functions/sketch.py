"""Small statistical helpers: corrected moments, stable hashing, normal quantile, F tail."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def skewness(x: Column) -> Column:
    """Bias-corrected skewness G1 (Spark's own is the population value)."""
    n = F.count(x).cast("double")
    g1 = nan_to_null(F.skewness(x))
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def kurtosis(x: Column) -> Column:
    """Bias-corrected excess kurtosis G2."""
    n = F.count(x).cast("double")
    g2 = nan_to_null(F.kurtosis(x))
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation over rows where both are present; NULL when undefined."""
    return nan_to_null(F.corr(x, y))


def hash_unit(key: Column, seed: int = 42) -> Column:
    """Uniform-looking number in [0, 1) that depends on the key only.

    Taken from md5, so any engine can recompute a split; row order, partitioning and
    retries do not change it.
    """
    text = F.concat_ws(":", F.lit(str(seed)), key.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def hash_fold(key: Column, k: int, seed: int = 42) -> Column:
    return F.floor(hash_unit(key, seed) * k).cast("int")


# Coefficients of Acklam's rational approximation of the normal quantile.
_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
      1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
      6.680131188771972e+01, -1.328068155288572e+01, 1.0)
_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
      -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
      3.754408661907416e+00, 1.0)


def normal_quantile(p: np.ndarray) -> np.ndarray:
    """Inverse normal CDF for 0 < p < 1, relative error about 1e-9."""
    p = np.asarray(p, dtype=float)
    q = p - 0.5
    t = q * q
    centre = q * np.polyval(_A, t) / np.polyval(_B, t)
    u = np.sqrt(-2.0 * np.log(np.minimum(p, 1.0 - p)))
    edge = np.polyval(_C, u) / np.polyval(_D, u)
    edge = np.where(p < 0.5, edge, -edge)
    return np.where(np.abs(q) <= 0.5 - 0.02425, centre, edge)


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 500):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d = 1.0 + term * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + term / c
            c = c if abs(c) > tiny else tiny
            value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return value


def regularised_beta(a: float, b: float, x: float) -> float:
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def f_tail(f: float, d1: float, d2: float) -> float:
    """P(F > f) for the F distribution with (d1, d2) degrees of freedom."""
    return regularised_beta(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))
