"""Threshold rules and labels.

Comparisons are NULL-guarded: a missing input yields label 0, as a pandas
comparison with NaN does. NaN must be normalised to NULL first
(:func:`chronoframe.operators.clean.nan_to_null`) because Spark orders NaN
above every number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronoframe.config import CLASS_NAMES, LabelRules

__all__ = [
    "guarded", "regional_threshold", "rain_label", "heat_label", "storm_label",
    "priority_class", "label_columns", "alert_level", "one_hot", "above_half",
    "two_way_label", "class_name",
]


def guarded(cond: Column) -> Column:
    """NULL condition → 0, else the condition as int."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def regional_threshold(key: Column, members: Sequence, special: float, default: float) -> Column:
    """F9 (+P7, P11): ``special`` for members of the list (``isin``), ``default`` otherwise —
    a masked assignment ``df.loc[mask, c] = x`` becomes ``when(mask, x).otherwise(c)``."""
    return F.when(key.isin(list(members)), F.lit(float(special))).otherwise(F.lit(float(default)))


def rain_label(v: Column, gt: float) -> Column:
    """strictly greater than the threshold."""
    return guarded(v > F.lit(gt))


def heat_label(v: Column, thr: Column) -> Column:
    """greater than or equal to the (per-row) threshold."""
    return guarded(v >= thr)


def storm_label(a: Column, a_ge: float, b: Column, b_ge: float) -> Column:
    """both conditions hold."""
    return guarded((a >= F.lit(a_ge)) & (b >= F.lit(b_ge)))


def priority_class(storm: Column, rain: Column, heat: Column) -> Column:
    """storm 3 > rain 2 > heat 1 > normal 0."""
    return (F.when(storm == 1, 3).when(rain == 1, 2).when(heat == 1, 1).otherwise(0)).cast("int")


def label_columns(rules: LabelRules, threshold_col: Column | None = None) -> dict[str, Column]:
    """All five label columns of the feature table, in dependency order."""
    thr = threshold_col if threshold_col is not None else regional_threshold(
        F.col(rules.heat_special_col), rules.heat_special_members, rules.heat_special, rules.heat_default)
    rain = rain_label(F.col(rules.rain_col), rules.rain_gt)
    heat = heat_label(F.col(rules.heat_col), F.col("heatwave_threshold"))
    storm = storm_label(F.col(rules.storm_a_col), rules.storm_a_ge, F.col(rules.storm_b_col), rules.storm_b_ge)
    return {
        "heatwave_threshold": thr,
        "target_rain": rain,
        "target_heatwave": heat,
        "target_storm": storm,
        "target_disaster": priority_class(F.col("target_storm"), F.col("target_rain"), F.col("target_heatwave")),
    }


def alert_level(temp: Column, p_rain: Column, p_heat: Column, cls: Column) -> Column:
    """cascaded alert rules, first match wins."""
    return (F.when((cls == 3) | (p_rain > 0.8), "RED")
             .when((cls == 1) | (p_heat > 0.7) | (temp > 42), "ORANGE")
             .when((cls == 2) | (p_rain > 0.5), "YELLOW")
             .otherwise("GREEN"))


def one_hot(y: Column, k: int) -> Column:
    """one-vs-rest indicator."""
    return (y == F.lit(k)).cast("int")


def above_half(p: Column, thr: float = 0.5) -> Column:
    """decision threshold, strictly greater."""
    return (p > F.lit(thr)).cast("int")


def two_way_label(v: Column, thr: Column, pos: str = "Heatwave", neg: str = "Normal") -> Column:
    """F24."""
    return F.when(v >= thr, pos).otherwise(neg)


def class_name(cls: Column, names: Sequence[str] = CLASS_NAMES) -> Column:
    """Class id → name via a literal array (no join needed)."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), cls + 1)
