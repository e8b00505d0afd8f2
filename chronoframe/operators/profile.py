"""Data-quality profiling.

Quantiles are exact and come from :func:`chronoframe.operators.ordered.exact_quantiles`
(sketch brackets + bounded refinement: scans with partial aggregation, no
group is ever buffered or sorted whole). Outlier and whisker counts are one
more scan joined to the small per-group fence table.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chronoframe.config import IQR_K
from chronoframe.operators.ordered import exact_quantiles
from chronoframe.operators.scalars import join_null_safe, with_scalars

__all__ = [
    "to_long", "iqr_bounds", "quality_report", "quality_summary", "describe_exact",
    "correlation_matrix", "histogram", "box_summary", "distinct_count",
]

_VAR, _VAL = "variable", "value"


def _ts_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def to_long(df: DataFrame, keys: Sequence[str], cols: Sequence[str], coded: bool = False) -> DataFrame:
    """Unpivot ``cols`` to ``(keys..., variable, value)`` as doubles.

    With ``coded`` the variable is its 0-based position in ``cols`` (an int
    key hashes and compares faster than a string in the shuffles that follow).
    """
    if coded:
        arr = F.array(*[F.col(c).cast("double") for c in cols])
        return df.select(*keys, F.posexplode(arr).alias(_VAR, _VAL))
    cast = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols])
    return cast.unpivot(list(keys), list(cols), _VAR, _VAL)


def iqr_bounds(long_df: DataFrame, group_cols: Sequence[str], k: float = IQR_K) -> DataFrame:
    """Per-group exact q1, q3 and the Tukey fences ``q1 − k·iqr`` / ``q3 + k·iqr``."""
    q = exact_quantiles(long_df, _VAL, [0.25, 0.75], list(group_cols), names=["q1", "q3"])
    return q.withColumn("iqr", F.col("q3") - F.col("q1")) \
            .withColumn("lower", F.col("q1") - F.lit(k) * F.col("iqr")) \
            .withColumn("upper", F.col("q3") + F.lit(k) * F.col("iqr"))


def quality_report(df: DataFrame, entity: str, order: str, variables: Sequence[str],
                   expected_rows: int, attrs: Sequence[str] = (), dimension: DataFrame | None = None,
                   stats_col: str | None = None, stats_prefix: str = "temp",
                   outlier_k: float = IQR_K) -> DataFrame:
    """A1–A4 + P14: one row per entity.

    ``total_rows, expected_rows, coverage_pct, date_start, date_end,
    missing_<v>, missing_<v>_pct, outliers_<v>, <prefix>_mean/min/max/std, status``.
    Entities of ``dimension`` without rows get ``status='FAILED'`` and
    ``total_rows=0``. ``attrs`` are entity constants, taken from
    ``dimension`` where it has them. A variable without values has NULL outliers.
    """
    variables = list(variables)
    aggs = [F.count(F.lit(1)).alias("total_rows"), F.min(order).alias("_t0"), F.max(order).alias("_t1")]
    for v in variables:
        aggs.append(F.count_if(F.col(v).isNull()).alias(f"missing_{v}"))
    if stats_col:
        aggs += [F.avg(stats_col).alias("_s_mean"), F.min(stats_col).alias("_s_min"),
                 F.max(stats_col).alias("_s_max"), F.stddev_samp(stats_col).alias("_s_std")]
    for v in variables:
        aggs.append(F.count(v).alias(f"_present_{v}"))
    attrs = list(attrs)
    own = [a for a in attrs if dimension is None or a not in dimension.columns]
    # attributes come from the dimension; those it lacks are the largest value met, so a NULL never splits an entity
    base = df.groupBy(entity).agg(*aggs, *[F.max(a).alias(a) for a in own])
    if dimension is not None and len(own) < len(attrs):
        base = join_null_safe(base, dimension.select(entity, *[a for a in attrs if a not in own]), [entity], "left")

    long_df = to_long(df, [entity], variables, coded=True).where(F.col(_VAL).isNotNull())
    bounds = iqr_bounds(long_df, [entity, _VAR], outlier_k)
    # one more scan: rows outside the fences (the bounds table has one row per group)
    outside = (F.col(_VAL) < F.col("lower")) | (F.col(_VAL) > F.col("upper"))
    outl = join_null_safe(long_df, bounds.select(entity, _VAR, "lower", "upper"), [entity, _VAR]) \
                  .groupBy(entity).agg(*[F.count_if(outside & (F.col(_VAR) == i)).cast("long").alias(f"outliers_{v}")
                                         for i, v in enumerate(variables)])

    n = F.col("total_rows")
    cols = [F.col(entity)] + [F.col(a) for a in attrs] + [
        n.cast("long").alias("total_rows"),
        F.lit(int(expected_rows)).cast("long").alias("expected_rows"),
        F.bround(n / F.lit(float(expected_rows)) * 100, 2).alias("coverage_pct"),
        _ts_text(F.col("_t0")).alias("date_start"), _ts_text(F.col("_t1")).alias("date_end")]
    for v in variables:
        cols += [F.col(f"missing_{v}").cast("long").alias(f"missing_{v}"),
                 F.bround(F.col(f"missing_{v}") / n * 100, 4).alias(f"missing_{v}_pct")]
    # a variable without any value has no fences: its outlier count is NULL, not 0
    cols += [F.when(F.col(f"_present_{v}") > 0, F.coalesce(F.col(f"outliers_{v}"), F.lit(0))).cast("long").alias(f"outliers_{v}") for v in variables]
    if stats_col:
        cols += [F.bround(F.col(f"_s_{s}"), 2).alias(f"{stats_prefix}_{s}") for s in ("mean", "min", "max", "std")]
    rep = join_null_safe(base, outl, [entity], "left").select(*cols).withColumn("status", F.lit("OK"))
    if dimension is None:
        return rep
    missing = dimension.select(entity, *[a for a in attrs if a in dimension.columns]) \
                       .join(rep.select(entity), entity, "left_anti")
    failed = missing.withColumn("total_rows", F.lit(0).cast("long")).withColumn("status", F.lit("FAILED"))
    return rep.unionByName(failed, allowMissingColumns=True)


def quality_summary(report: DataFrame, entity: str, variables: Sequence[str],
                    stats_prefix: str = "temp") -> DataFrame:
    """A5 + A6: one-row roll-up of a quality report."""
    ok = F.col("status") == "OK"
    mean_col, min_col, max_col = f"{stats_prefix}_mean", f"{stats_prefix}_min", f"{stats_prefix}_max"

    def argext(fn, val):
        return fn(F.when(ok, F.col(entity)), F.when(ok, F.struct(F.col(val), F.col(entity))))

    aggs = [F.count(F.lit(1)).alias("entities"), F.count_if(ok).alias("ok"),
            F.count_if(F.col("status") == "FAILED").alias("failed"),
            F.sum("total_rows").cast("long").alias("total_rows"),
            F.avg(F.when(ok, F.col("coverage_pct"))).alias("avg_coverage_pct"),
            F.min(F.when(ok, F.col("coverage_pct"))).alias("min_coverage_pct")]
    aggs += [F.avg(F.when(ok, F.col(f"missing_{v}_pct"))).alias(f"avg_missing_{v}_pct") for v in variables]
    aggs += [argext(F.min_by, mean_col).alias("coldest"), F.min(F.when(ok, F.col(mean_col))).alias("coldest_mean"),
             argext(F.max_by, mean_col).alias("hottest"), F.max(F.when(ok, F.col(mean_col))).alias("hottest_mean"),
             argext(F.min_by, min_col).alias("abs_min_entity"), F.min(F.when(ok, F.col(min_col))).alias("abs_min"),
             argext(F.max_by, max_col).alias("abs_max_entity"), F.max(F.when(ok, F.col(max_col))).alias("abs_max")]
    return report.agg(*aggs)


def describe_exact(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pandas ``describe()`` per numeric column with exact quantiles (long form)."""
    long_df = to_long(df, [], cols).where(F.col(_VAL).isNotNull())

    def moments(v):  # computed in the quantiles' own counting pass (no extra scan)
        return {"count": F.count(F.lit(1)), "mean": F.avg(v), "std": F.stddev_samp(v), "min": F.min(v),
                "max": F.max(v)}
    q = exact_quantiles(long_df, _VAL, [0.25, 0.5, 0.75], [_VAR], names=["q25", "q50", "q75"], extra_aggs=moments)
    return q.select(
        F.col(_VAR).alias("column_name"), F.col("count").cast("long"), "mean", "std", "min",
        "q25", "q50", "q75", "max")


#: A variance below this share of the mean square is rounding: the column is constant among those rows.
NO_VARIANCE = 1e-12


def _values(batch) -> np.ndarray:
    """The rows of an Arrow batch of doubles as a matrix; NULL becomes NaN."""
    return np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])


def _products(z: np.ndarray, there: np.ndarray) -> np.ndarray:
    """``(n, sa, sb, saa, sbb, sab)`` of all pairs of columns over the rows where both have a value."""
    m = there.astype(float)
    if np.isfinite(z).all():
        n, sa, saa, sab = m.T @ m, z.T @ m, (z * z).T @ m, z.T @ z
    else:                   # an infinite value must not meet the zero of a missing one
        k = z.shape[1]
        n, sa, saa, sab = (np.zeros((k, k)) for _ in range(4))
        for i in range(k):
            both = there[:, i:i + 1] & there
            a = np.where(both, z[:, i:i + 1], 0.0)
            n[i], sa[i], saa[i], sab[i] = both.sum(0), a.sum(0), (a * a).sum(0), (a * np.where(both, z, 0.0)).sum(0)
    return np.stack([n, sa, sa.T, saa, saa.T, sab])


def gram_blocks(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete cross products of numeric columns: ``(i, j, n, sa, sb, saa, sbb, sab)`` for column numbers i <= j.

    Values are taken less a fixed value of each column (its mean; the value
    itself if it has only one), so large offsets do not cancel. Each task turns
    its Arrow batches into matrix products and sends one row per pair; one
    aggregation sums them. NULL and NaN are left out pair by pair.
    """
    cols = list(cols)
    k = len(cols)
    rows = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])

    def outline(batches):
        n, total, low, high = np.zeros(k), np.zeros(k), np.full(k, np.inf), np.full(k, -np.inf)
        with np.errstate(invalid="ignore"):
            for x in map(_values, batches):
                if len(x):
                    n, total = n + (~np.isnan(x)).sum(0), total + np.nansum(x, 0)
                    low, high = np.fmin(low, np.fmin.reduce(x, 0)), np.fmax(high, np.fmax.reduce(x, 0))
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in (np.arange(k), n, total, low, high)], names=["i", "n", "s", "lo", "hi"])

    stats = rows.mapInArrow(outline, "i long, n double, s double, lo double, hi double").groupBy("i").agg(
        (F.sum("s") / F.sum("n")).alias("m"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n")).where("n > 0")
    shift = {r["i"]: (r["lo"] if r["lo"] == r["hi"] else r["m"]) or 0.0 for r in stats.collect()}      # one number for each column
    centre = np.array([float(shift.get(i, 0.0)) for i in range(k)])

    def products(batches):
        total, upper = None, np.triu_indices(k)
        with np.errstate(invalid="ignore", over="ignore"):
            for x in map(_values, batches):
                if len(x):
                    there = ~np.isnan(x)
                    p = _products(np.where(there, x - centre, 0.0), there)
                    total = p if total is None else total + p
        if total is not None:
            sums = [pa.array(t[upper]) for t in total]
            yield pa.RecordBatch.from_arrays([pa.array(u.astype(np.int32)) for u in upper] + [sums[0].cast(pa.int64())] + sums[1:], names=["i", "j", "n", "sa", "sb", "saa", "sbb", "sab"])

    parts = rows.mapInArrow(products, "i int, j int, n long, sa double, sb double, saa double, sbb double, sab double")
    return parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sa", "sb", "saa", "sbb", "sab")])


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlations in long form ``(col_a, col_b, corr)``; NULL without variance.

    From :func:`gram_blocks`; the matrix is mirrored without touching the data again.
    """
    cols = list(cols)
    g = gram_blocks(df, cols)
    va, vb = (F.col("n") * F.col(f"s{x}{x}") - F.col(f"s{x}") * F.col(f"s{x}") for x in "ab")
    some = (va > NO_VARIANCE * F.col("n") * F.col("saa")) & (vb > NO_VARIANCE * F.col("n") * F.col("sbb"))
    r = (F.col("n") * F.col("sab") - F.col("sa") * F.col("sb")) / (F.sqrt(va) * F.sqrt(vb))
    corr = F.when(some & (F.col("i") == F.col("j")), F.lit(1.0)).when(some, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))
    names = F.array(*[F.lit(c) for c in cols])
    pair = g.select(F.get(names, F.col("i")).alias("a"), F.get(names, F.col("j")).alias("b"), corr.alias("corr"), (F.col("i") < F.col("j")).alias("two"))
    both = F.array_compact(F.array(F.struct(F.col("a").alias("col_a"), F.col("b").alias("col_b"), "corr"),
                                   F.when(F.col("two"), F.struct(F.col("b").alias("col_a"), F.col("a").alias("col_b"), "corr"))))
    return pair.select(F.explode(both).alias("c")).select("c.*")


def histogram(df: DataFrame, value: str, bins: int, by: str | None = None, density: bool = True) -> DataFrame:
    """Equal-width bins over the global [min, max]; last bin closed; empty bins kept.

    Output: ``[by], bin, bin_lo, bin_hi, count[, density]``.
    """
    v = F.col(value).cast("double")
    rng = df.agg(F.min(v).alias("_lo"), F.max(v).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    binned = with_scalars(df.where(v.isNotNull()), rng).withColumn(
        "bin", F.when(width > 0, F.least(F.floor((v - F.col("_lo")) / width), F.lit(bins - 1)))
                .otherwise(F.lit(0)).cast("int"))
    keys = ([by] if by else []) + ["bin"]
    counts = binned.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    if by:  # every present class gets every bin (explode, not a join)
        base = with_scalars(df.where(v.isNotNull()).select(by).distinct(), rng)
    else:
        base = rng
    grid = base.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    out = join_null_safe(grid, counts, keys, "left").withColumn("count", F.coalesce(F.col("count"), F.lit(0)).cast("long"))
    out = out.withColumn("bin_lo", F.col("_lo") + F.col("bin") * width) \
             .withColumn("bin_hi", F.col("_lo") + (F.col("bin") + 1) * width)
    if density:
        tot = F.sum("count").over(W.partitionBy(*([by] if by else [])))
        out = out.withColumn("density", F.col("count") / (tot * width))
    return out.select(*([by] if by else []), "bin", "bin_lo", "bin_hi", "count", *(["density"] if density else []))


def box_summary(df: DataFrame, value: str, group_cols: Sequence[str], k: float = IQR_K) -> DataFrame:
    """Five-number summary + Tukey whiskers + outlier count per group."""
    group_cols = list(group_cols)
    long_df = df.select(*group_cols, F.col(value).cast("double").alias(_VAL)).where(F.col(_VAL).isNotNull())
    q = exact_quantiles(long_df, _VAL, [0.25, 0.5, 0.75], group_cols, names=["q1", "median", "q3"])
    q = q.withColumn("lower_fence", F.col("q1") - F.lit(k) * (F.col("q3") - F.col("q1"))) \
         .withColumn("upper_fence", F.col("q3") + F.lit(k) * (F.col("q3") - F.col("q1")))
    inside = (F.col(_VAL) >= F.col("lower_fence")) & (F.col(_VAL) <= F.col("upper_fence"))
    # one scan for extremes, whiskers and outliers (the fence table has one row per group)
    wh = join_null_safe(long_df, q.select(*group_cols, "lower_fence", "upper_fence"), group_cols) \
                .groupBy(*group_cols).agg(
                    F.count(F.lit(1)).cast("long").alias("n"), F.min(_VAL).alias("min"), F.max(_VAL).alias("max"),
                    F.min(F.when(inside, F.col(_VAL))).alias("whisker_lo"),
                    F.max(F.when(inside, F.col(_VAL))).alias("whisker_hi"),
                    F.count_if(~inside).cast("long").alias("outliers"))
    return join_null_safe(q, wh, group_cols).select(
        *group_cols, "n", "min", "q1", "median", "q3", "max", "whisker_lo", "whisker_hi", "outliers")


def distinct_count(df: DataFrame, col: str, approx: bool = False) -> DataFrame:
    """A7 (exact by default; ``approx`` for HyperLogLog++ at scale)."""
    fn = F.approx_count_distinct(col) if approx else F.count_distinct(col)
    return df.agg(fn.cast("long").alias(f"n_{col}"))
