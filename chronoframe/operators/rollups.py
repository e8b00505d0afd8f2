"""Label and calendar roll-ups.

Every roll-up is a single ``groupBy().agg()`` (partial + final aggregation
chosen by Catalyst) — several measures per pass instead of one group-by per
chart followed by joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chronoframe.config import CLASS_NAMES, EPS_MINMAX, MONTH_NAMES
from chronoframe.functions.scalar import feature_category
from chronoframe.operators.scalars import join_null_safe, with_scalars

__all__ = [
    "label_distribution", "label_partials", "label_distribution_from_partials", "label_totals", "class_frequency", "class_balance", "balanced_class_weights",
    "apply_class_weights", "majority_class", "period_stats", "exceedance_by_period", "sum_by_month_of_year",
    "mean_by_hour", "actual_vs_predicted_events", "count_by_class", "mean_by", "linear_trend_projection",
    "importance_by_category", "daily_resample", "positives_by_entity", "conditional_means",
    "fold_summary", "headline_counts", "minmax_normalise",
]


def _pct(c: Column, digits: int = 2) -> Column:
    return F.bround(c * 100, digits)


def label_distribution(df: DataFrame, entity: str, labels: Sequence[tuple[str, str]],
                       class_col: str, classes: Sequence[tuple[int, str]], attrs: Sequence[str] = (),
                       threshold_col: str | None = None, threshold_alias: str = "heatwave_threshold_C",
                       count_suffix: str = "_hours", total_name: str = "total_hours",
                       class_prefix: str = "disaster_") -> DataFrame:
    """A10: per-entity totals, label counts / percentages and class shares (one pass).

    ``attrs`` are constants of the entity: the facts are aggregated by (entity,
    attributes) with hash aggregates, then combined per entity, so a NULL
    attribute on some rows does not split the entity.
    """
    parts = label_partials(df, [entity, *attrs], labels, class_col, classes, threshold_col)
    return label_distribution_from_partials(parts, entity, labels, classes, attrs, bool(threshold_col), threshold_alias,
                                            count_suffix, total_name, class_prefix)


def label_partials(df: DataFrame, key: str | Sequence[str], labels: Sequence[tuple[str, str]], class_col: str,
                   classes: Sequence[tuple[int, str]], threshold_col: str | None = None) -> DataFrame:
    """A10, first level: decomposable per-``key`` partials (rows, label sums, class counts, min threshold).

    Aggregate the facts by a fine key *before* joining a dimension, so only one
    row per key crosses the join instead of every fact row.
    """
    aggs = [F.count(F.lit(1)).alias("_n")]
    if threshold_col:
        aggs.append(F.min(threshold_col).cast("double").alias("_thr"))
    aggs += [F.sum(F.col(col).cast("long")).alias(f"_l_{name}") for name, col in labels]
    aggs += [F.count_if(F.col(class_col) == k).alias(f"_k_{cname}") for k, cname in classes]
    return df.groupBy(*([key] if isinstance(key, str) else key)).agg(*aggs)


def label_distribution_from_partials(partials: DataFrame, entity: str, labels: Sequence[tuple[str, str]],
                                     classes: Sequence[tuple[int, str]], attrs: Sequence[str] = (),
                                     threshold: bool = True, threshold_alias: str = "heatwave_threshold_C",
                                     count_suffix: str = "_hours", total_name: str = "total_hours",
                                     class_prefix: str = "disaster_") -> DataFrame:
    """A10, second level: combine partials per entity into the report of :func:`label_distribution`."""
    n = F.sum("_n")
    aggs = []
    if threshold:
        aggs.append(F.min("_thr").alias(threshold_alias))
    aggs.append(n.cast("long").alias(total_name))
    for name, _ in labels:
        aggs += [F.sum(f"_l_{name}").cast("long").alias(f"{name}{count_suffix}"),
                 _pct(F.sum(f"_l_{name}") / n).alias(f"{name}_pct")]
    for _, cname in classes:
        aggs.append(_pct(F.sum(f"_k_{cname}") / n).alias(f"{class_prefix}{cname}_pct"))
    order = [entity, *attrs, *[c for c in [threshold_alias] if threshold], total_name]
    out = partials.groupBy(entity).agg(*aggs, *[F.max(a).alias(a) for a in attrs])
    return out.select(*order, *[c for c in out.columns if c not in order])


def label_totals(df: DataFrame, labels: Sequence[tuple[str, str]]) -> DataFrame:
    """Positives and positive rate per label (long form)."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for name, col in labels:
        aggs += [F.sum(col).alias(f"_p_{name}")]
    one = df.agg(*aggs)
    items = [F.struct(F.lit(name).alias("label"), F.col(f"_p_{name}").cast("long").alias("positives"),
                      (F.col(f"_p_{name}") / F.col("_n") * 100).alias("positive_pct")) for name, _ in labels]
    return one.select(F.explode(F.array(*items)).alias("r")).select("r.*")


def class_frequency(df: DataFrame, class_col: str, n_classes: int | None = None,
                    names: Sequence[str] = CLASS_NAMES, group_cols: Sequence[str] = ()) -> DataFrame:
    """Count and share of every class, zero-filled over ``0..n_classes-1`` (per group)."""
    group_cols = list(group_cols)
    n_classes = n_classes or len(names)
    counts = df.groupBy(*group_cols, class_col).agg(F.count(F.lit(1)).alias("count"))
    grid = df.select(*group_cols).distinct() if group_cols else df.sparkSession.range(1).select()
    grid = grid.withColumn(class_col, F.explode(F.sequence(F.lit(0), F.lit(n_classes - 1))))
    out = join_null_safe(grid, counts, [*group_cols, class_col], "left") \
              .withColumn("count", F.coalesce(F.col("count"), F.lit(0)).cast("long"))
    tot = F.sum("count").over(W.partitionBy(*group_cols)) if group_cols else F.sum("count").over(W.partitionBy())
    return out.select(*group_cols, F.col(class_col).cast("int").alias(class_col),
                      F.element_at(F.array(*[F.lit(n) for n in names]), F.col(class_col) + 1).alias("class_name"),
                      "count", (F.col("count") / tot * 100).alias("share_pct"))


def class_balance(df: DataFrame, y: str) -> DataFrame:
    """Negatives, positives and ``scale_pos_weight = neg / max(pos, 1)``."""
    return df.agg(F.count_if(F.col(y) == 0).cast("long").alias("negatives"),
                  F.count_if(F.col(y) == 1).cast("long").alias("positives")) \
             .withColumn("scale_pos_weight", F.col("negatives") / F.greatest(F.col("positives"), F.lit(1)))


def balanced_class_weights(df: DataFrame, y: str) -> DataFrame:
    """``total / (n_classes * count)`` with the *observed* class count (Q10)."""
    c = df.groupBy(y).agg(F.count(F.lit(1)).alias("count"))
    w = W.partitionBy()
    return c.select(F.col(y), F.col("count").cast("long"),
                    (F.sum("count").over(w) / (F.count(F.lit(1)).over(w) * F.col("count"))).alias("weight"))


def apply_class_weights(df: DataFrame, y: str, weights: DataFrame, out: str = "weight") -> DataFrame:
    """Attach the class weight to every row. The weights have one row for each class: broadcast, else the rows
    would be dealt over tasks by a column of few values."""
    return df.join(F.broadcast(weights.select(y, F.col("weight").alias(out))), y, "left")


def majority_class(df: DataFrame, y: str) -> DataFrame:
    """Most frequent class (ties → smallest class) and the positive prior ``avg(y)``."""
    c = df.groupBy(y).agg(F.count(F.lit(1)).alias("n"))
    best = c.agg(F.max_by(F.col(y), F.struct(F.col("n"), -F.col(y))).alias("majority"))
    prior = df.agg(F.avg(F.col(y).cast("double")).alias("prior"), F.count(F.lit(1)).cast("long").alias("rows"))
    return with_scalars(best, prior)


def period_stats(df: DataFrame, ts: str, measures: dict[str, Column], unit: str = "month",
                 group_cols: Sequence[str] = (), period_name: str = "period") -> DataFrame:
    """Measures by ``date_trunc(unit, ts)`` (and groups)."""
    p = F.date_format(F.date_trunc(unit, F.col(ts)), "yyyy-MM-dd HH:mm:ss").alias(period_name)
    return df.groupBy(*group_cols, p).agg(*[c.alias(n) for n, c in measures.items()])


def exceedance_by_period(df: DataFrame, value: str, threshold: Column, period: Column,
                         period_name: str = "year", out: str = "hours") -> DataFrame:
    """Rows with ``value >= threshold`` per period."""
    return df.groupBy(period.alias(period_name)).agg(
        F.sum((F.col(value) >= threshold).cast("int")).cast("long").alias(out))


def sum_by_month_of_year(df: DataFrame, ts: str, value: str, out: str | None = None) -> DataFrame:
    """Totals by calendar month across years, with month name."""
    out = out or value
    m = F.month(F.col(ts))
    g = df.groupBy(m.alias("month")).agg(F.sum(value).alias(out))
    return g.withColumn("month_name", F.element_at(F.array(*[F.lit(n) for n in MONTH_NAMES]), F.col("month")))


def mean_by_hour(df: DataFrame, ts: str, value: str) -> DataFrame:
    """Diurnal cycle."""
    return df.groupBy(F.hour(F.col(ts)).alias("hour")).agg(F.avg(value).alias(value))


def actual_vs_predicted_events(df: DataFrame, period: Column, pairs: Sequence[tuple[str, str, str]],
                               threshold: float = 0.5, period_name: str = "year") -> DataFrame:
    """A19 (+J3): per period, actual positives and predicted positives ``prob > threshold``.

    ``pairs`` = (name, label column, probability column); one pass replaces a
    group-by per series plus a join on the period.
    """
    aggs = []
    for name, y, p in pairs:
        aggs += [F.sum(y).cast("long").alias(f"{name}_actual"),
                 F.count_if(F.col(p) > F.lit(threshold)).cast("long").alias(f"{name}_predicted")]
    return df.groupBy(period.alias(period_name)).agg(*aggs)


def count_by_class(df: DataFrame, period: Column, class_col: str, names: Sequence[str] = CLASS_NAMES,
                   period_name: str = "year") -> DataFrame:
    """A20 (+J4): rows by (period, class) with the class name."""
    g = df.groupBy(period.alias(period_name), F.col(class_col)).agg(F.count(F.lit(1)).cast("long").alias("count"))
    return g.withColumn("class_name", F.element_at(F.array(*[F.lit(n) for n in names]), F.col(class_col) + 1))


def mean_by(df: DataFrame, keys: Sequence[Column], value: str, out: str | None = None) -> DataFrame:
    """Mean by arbitrary keys."""
    return df.groupBy(*keys).agg(F.avg(value).alias(out or value))


def linear_trend_projection(yearly: DataFrame, entity: str, x: str, y: str, horizon: int = 2,
                            band: float = 1.5) -> DataFrame:
    """Least-squares line per entity over (x, y) points, evaluated at
    ``max(x) .. max(x)+horizon-1`` with a fixed ± band (as the dashboard draws)."""
    fit = yearly.groupBy(entity).agg(F.regr_slope(F.col(y), F.col(x)).alias("slope"),
                                     F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
                                     F.max(x).alias("_xmax"))
    proj = fit.withColumn(x, F.explode(F.sequence(F.col("_xmax"), F.col("_xmax") + horizon - 1)))
    val = F.col("intercept") + F.col("slope") * F.col(x)
    return proj.select(entity, F.col(x), "slope", "intercept", val.alias("projected"),
                       (val - band).alias("projected_lo"), (val + band).alias("projected_hi"))


def importance_by_category(imp: DataFrame, feature: str = "feature", value: str = "importance") -> DataFrame:
    """Sum of importance by F15 feature category."""
    return imp.groupBy(feature_category(F.col(feature)).alias("category")).agg(F.sum(value).alias(value))


def daily_resample(df: DataFrame, entity: str, ts: str, value: str, unit: str = "day",
                   step: str = "1 day") -> DataFrame:
    """Per-entity mean per day *including empty days* (NULL mean, zero rows).

    The calendar is generated per entity from its own [first, last] day with
    ``sequence`` — bounded by the time span, not the row count.
    """
    d = F.date_trunc(unit, F.col(ts))
    daily = df.groupBy(entity, d.alias("_d")).agg(F.avg(value).alias(value), F.count(F.lit(1)).alias("rows"))
    span = daily.groupBy(entity).agg(F.min("_d").alias("_a"), F.max("_d").alias("_b"))
    cal = span.select(entity, F.explode(F.sequence("_a", "_b", F.expr(f"INTERVAL {step}"))).alias("_d"))
    out = join_null_safe(cal, daily, [entity, "_d"], "left")
    return out.select(entity, F.date_format("_d", "yyyy-MM-dd").alias("day"), F.col(value),
                      F.coalesce(F.col("rows"), F.lit(0)).cast("long").alias("rows"))


def positives_by_entity(df: DataFrame, entity: str, y: str) -> DataFrame:
    """Positive rows per entity (entities without positives absent), ascending."""
    return df.where(F.col(y) == 1).groupBy(entity).agg(F.count(F.lit(1)).cast("long").alias("count"))


def conditional_means(df: DataFrame, value: str, flag: Column, prefix: str) -> DataFrame:
    """Overall mean, mean where ``flag`` and where not (NULL for an empty side)."""
    return df.agg(F.avg(value).alias(f"{prefix}_mean"),
                  F.avg(F.when(flag, F.col(value))).alias(f"{prefix}_when_true"),
                  F.avg(F.when(~flag, F.col(value))).alias(f"{prefix}_when_false"))


def fold_summary(results: DataFrame, metric: str) -> DataFrame:
    """Mean and population std (ddof=0) over folds."""
    return results.agg(F.avg(metric).alias(f"{metric}_mean"), F.stddev_pop(metric).alias(f"{metric}_std"),
                       F.count(F.lit(1)).cast("long").alias("folds"))


def headline_counts(df: DataFrame, entity: str) -> DataFrame:
    """Rows, distinct entities and column count."""
    return df.agg(F.count(F.lit(1)).cast("long").alias("rows"),
                  F.count_distinct(entity).cast("long").alias("entities")) \
             .withColumn("columns", F.lit(len(df.columns)).cast("long"))


def minmax_normalise(df: DataFrame, value: str, out: str | None = None, eps: float = EPS_MINMAX) -> DataFrame:
    """``(x - min) / (max - min + eps)`` using a one-row global aggregate."""
    r = df.agg(F.min(value).alias("_mn"), F.max(value).alias("_mx"))
    return with_scalars(df, r).withColumn(
        out or f"{value}_norm", (F.col(value) - F.col("_mn")) / (F.col("_mx") - F.col("_mn") + F.lit(eps))
    ).drop("_mn", "_mx")
