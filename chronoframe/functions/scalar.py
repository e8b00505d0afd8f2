"""Scalar helpers (F15–F20, F23) over columns and arrays."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronoframe.config import EPS_ENTROPY, FALLBACK_INTERVAL, GEO_FEATURES, LAG_MARKERS, TIME_FEATURES

__all__ = [
    "feature_category", "array_argmax", "entropy_bits", "confidence_from_entropy",
    "fallback_interval", "snake_lower", "round_half_even", "sorted_quantiles",
]


def feature_category(name: Column) -> Column:
    """ordered rules lag → rolling → time → geographic → raw."""
    lag = None
    for m in LAG_MARKERS:
        c = name.contains(m)
        lag = c if lag is None else (lag | c)
    return (F.when(lag, "Lag Features")
             .when(name.contains("roll"), "Rolling Features")
             .when(name.isin(TIME_FEATURES), "Time Features")
             .when(name.isin(GEO_FEATURES), "Geographic")
             .otherwise("Raw Weather"))


def array_argmax(p: Column) -> Column:
    """0-based position of the first maximum."""
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def entropy_bits(p: Column, eps: float = EPS_ENTROPY) -> Column:
    """Shannon entropy in bits, ``-sum(p * log2(p + eps))``."""
    terms = F.transform(p, lambda x: x * F.log2(x + F.lit(eps)))
    return -F.aggregate(terms, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def confidence_from_entropy(h: Column, k: int) -> Column:
    """``1 - H / log2(k)``."""
    return F.lit(1.0) - h / F.lit(math.log2(k))


def fallback_interval(pred: Column, q: Column | None, sign: int, width: float = FALLBACK_INTERVAL) -> Column:
    """a quantile if present, else point ± width."""
    fb = pred + F.lit(sign * width)
    return fb if q is None else F.coalesce(q, fb)


def snake_lower(s: Column) -> Column:
    """lower-case, spaces → underscores."""
    return F.translate(F.lower(s), " ", "_")


def round_half_even(c: Column, digits: int) -> Column:
    """F16: banker's rounding, as Python's ``round``."""
    return F.bround(c, digits)


def sorted_quantiles(*qs: Column) -> list[Column]:
    """Q11: make independently fitted quantiles non-crossing per row."""
    arr = F.array_sort(F.array(*qs))
    return [F.element_at(arr, i + 1) for i in range(len(qs))]
