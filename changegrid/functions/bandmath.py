"""Per-pixel formulas as Column expressions.  Missing values are NULL, never NaN."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Chebyshev coefficients of erfc (Numerical Recipes), highest order last.
ERFC = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)


def floored(x: Column, least: float = 1e-6) -> Column:
    """x, at least ``least``; NULL stays NULL (``greatest`` alone would skip it)."""
    return F.when(x.isNotNull(), F.greatest(x, F.lit(least)))


def change_ratio(before: Column, after: Column) -> Column:
    """after / max(before, 1e-6)."""
    return after / floored(before)


def lrt_statistic(before: Column, after: Column, enl: float = 4.4) -> Column:
    """-2 ln of the likelihood ratio that two gamma intensities are equal, between 0 and -2 ln(1e-12)."""
    total = floored(before + after)
    look = F.lit(float(enl))
    ratio = F.pow(before / total, look) * F.pow(after / total, look) * F.lit(2.0 ** (2 * enl))
    return floored(-2 * F.log(floored(ratio, 1e-12)), 0.0)


def chi2_tail(stat: Column) -> Column:
    """Survival function of chi-square with one degree of freedom: erfc(sqrt(stat / 2))."""
    z = F.sqrt(stat / 2)
    t = 1 / (1 + z / 2)
    poly = reduce(lambda acc, c: acc * t + F.lit(c), reversed(ERFC[:-1]), F.lit(ERFC[-1]))
    return t * F.exp(-z * z + poly)


def normalized_difference(a: Column, b: Column) -> Column:
    return (a - b) / floored(a + b)


def spectral_indices() -> dict[str, Column]:
    """NDVI, NDBI, MNDWI and BSI of columns blue, green, red, nir, swir1."""
    blue, green, red, nir, swir = (F.col(c) for c in ("blue", "green", "red", "nir", "swir1"))
    return {
        "ndvi": normalized_difference(nir, red),
        "ndbi": normalized_difference(swir, nir),
        "mndwi": normalized_difference(green, swir),
        "bsi": ((swir + red) - (nir + blue)) / floored(swir + red + nir + blue),
    }


def amplitude_change(before: Column, after: Column, ratio_min: float = 1.5, log_ratio_min: float = 0.9) -> dict[str, Column]:
    """Ratio, log1p(ratio), and whether both reach their thresholds (inclusive)."""
    ratio = change_ratio(before, after)
    log_ratio = F.log1p(ratio)
    return {"ratio": ratio, "log_ratio": log_ratio, "candidate": holds((ratio >= ratio_min) & (log_ratio >= log_ratio_min))}


def holds(condition: Column) -> Column:
    """A condition with NULL as false, as comparisons with missing values are."""
    return F.coalesce(condition, F.lit(False))
