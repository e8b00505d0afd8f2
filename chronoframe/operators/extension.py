"""W2–W5 for new hours: features of rows that arrive, from a stored tail per entity, without reading the history.

The tail holds each entity's last ``halo + late_rows`` rows as they came (not
filled), and the last non-NULL value before them. An append brings new rows and
corrections (rows with a key that is known; the later version counts). Out come
the features of every row from the entity's first changed one on, as upserts by
key, and the new tail. Only entities with changes are worked on.

A correction reaches the features of at most ``halo`` rows after it, and needs
``halo`` rows before it: so one up to ``late_rows`` rows back is exact. Older
ones cannot be placed and are returned apart, none is dropped in silence.
Leading NULLs are filled from the entity's first value, also when that comes
with a later append, as far back as the tail reaches.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chronoframe.config import FeatureSpec, PanelSpec
from chronoframe.operators.panel import feature_names, with_lag_rolling
from chronoframe.operators.scalars import join_null_safe

__all__ = ["Extension", "empty_tail", "extend_panel", "merge_upserts"]

_BEFORE, _WHOLE, _NEW = "_cf_before_", "_cf_whole", "_cf_new"


@dataclass
class Extension:
    """``features``: upserts by key; ``tail``: to be stored for the next append; ``too_late``: corrections older than the tail reaches."""

    features: DataFrame
    tail: DataFrame
    too_late: DataFrame


def empty_tail(rows: DataFrame, fill_cols: Sequence[str]) -> DataFrame:
    """The tail before the first append."""
    return rows.limit(0).withColumns({**{f"{_BEFORE}{c}": F.col(c) for c in fill_cols}, _WHOLE: F.lit(True)})


def extend_panel(tail: DataFrame, new: DataFrame, spec: PanelSpec, fs: FeatureSpec, fill_cols: Sequence[str] = (), late_rows: int = 168) -> Extension:
    """Features of ``new`` (the columns of the panel, one version of each key) after ``tail``.

    ``spec.order_cols`` must identify an entity's rows. ``late_rows`` must be
    the same for every append of a panel.
    """
    o, order, cols, fill_cols = spec.entity, spec.order_cols, new.columns, list(fill_cols)
    keep = fs.halo + late_rows
    known = tail.withColumn(_NEW, F.lit(False))
    fresh = new.withColumns({**{f"{_BEFORE}{c}": F.lit(None).cast(new.schema[c].dataType) for c in fill_cols}, _WHOLE: F.lit(True), _NEW: F.lit(True)})
    busy = new.select(F.col(o).alias("_cf_o")).distinct()
    touched = known.join(busy, known[o].eqNullSafe(busy["_cf_o"]), "left_semi")
    idle = tail.join(busy, tail[o].eqNullSafe(busy["_cf_o"]), "left_anti")

    # what is known of an entity: where its tail begins, whether that is its whole history, the last values before
    start = touched.groupBy(o).agg(F.min(F.struct(*order)).alias("_cf_start"), F.first(_WHOLE).alias("_cf_all"),
                                   *[F.first(f"{_BEFORE}{c}").alias(f"_cf_b_{c}") for c in fill_cols])
    rows = join_null_safe(fresh.select(*touched.columns), start, [o], "left")
    late = F.coalesce((F.struct(*order) < F.col("_cf_start")) & ~F.col("_cf_all"), F.lit(False))
    # in an incomplete tail the first ``halo`` rows are context only: a correction there is too late as well
    w = W.partitionBy(o).orderBy(*order)
    merged = rows.where(~late).drop("_cf_start", "_cf_all", *[f"_cf_b_{c}" for c in fill_cols]).unionByName(touched)
    newest = W.partitionBy(o, *order).orderBy(F.col(_NEW).desc())
    merged = merged.withColumn("_cf_v", F.row_number().over(newest)).where("_cf_v = 1").drop("_cf_v")
    merged = join_null_safe(merged.drop(_WHOLE, *[f"{_BEFORE}{c}" for c in fill_cols]), start.drop("_cf_start"), [o], "left")
    merged = merged.withColumns({"_cf_all": F.coalesce("_cf_all", F.lit(True)), "_cf_at": F.row_number().over(w), "_cf_of": F.count(F.lit(1)).over(W.partitionBy(o))})
    context = ~F.col("_cf_all") & (F.col("_cf_at") <= fs.halo) & F.col(_NEW)
    out_of_reach = merged.where(context).select(*cols)

    whole = W.partitionBy(o)
    filled = {}
    revealed = []
    for c in fill_cols:
        before = F.last(c, True).over(w.rowsBetween(W.unboundedPreceding, 0))
        first = F.first(c, True).over(w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
        filled[f"_cf_f_{c}"] = F.coalesce(before, F.col(f"_cf_b_{c}"), first)
        # the entity's first value comes with this append: its leading NULLs change
        old = F.max(F.when(~F.col(_NEW) & F.col(c).isNotNull(), 1)).over(whole)
        revealed.append(F.col(f"_cf_b_{c}").isNull() & old.isNull() & first.isNotNull())
    work = merged.withColumns({**filled, **{f"_cf_r_{c}": r for c, r in zip(fill_cols, revealed)}})
    changed = F.max(F.when(F.col(_NEW), 1)).over(w.rowsBetween(W.unboundedPreceding, 0)).isNotNull()
    again = reduce(or_, [F.col(f"_cf_r_{c}") for c in fill_cols]) if fill_cols else F.lit(False)
    work = work.withColumn("_cf_out", (changed | again) & (F.col("_cf_all") | (F.col("_cf_at") > fs.halo)))
    raw = {f"_cf_w_{c}": F.col(c) for c in fill_cols}
    work = with_lag_rolling(work.withColumns(raw).withColumns({c: F.col(f"_cf_f_{c}") for c in fill_cols}), w, fs)
    features = work.where("_cf_out").select(*cols, *feature_names(fs))

    # the new tail: the last rows as they came, and the last value before each entity's first of them
    gone = F.col("_cf_of") - F.col("_cf_at") >= keep
    passed = {f"{_BEFORE}{c}": F.coalesce(F.last(F.when(gone, F.col(f"_cf_w_{c}")), True).over(w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)), F.col(f"_cf_b_{c}")) for c in fill_cols}
    rest = work.withColumns({**passed, _WHOLE: F.col("_cf_all") & (F.col("_cf_of") <= keep)}).where(~gone)
    rest = rest.withColumns({c: F.col(f"_cf_w_{c}") for c in fill_cols}).select(*tail.columns)
    too_late = rows.where(late).select(*cols).unionByName(out_of_reach)
    return Extension(features, idle.unionByName(rest), too_late)


def merge_upserts(parts: Sequence[DataFrame], key: Sequence[str]) -> DataFrame:
    """The feature table after several appends: of each key the row of the last one."""
    key = list(key)
    rows = reduce(DataFrame.unionByName, [p.withColumn("_cf_no", F.lit(i)) for i, p in enumerate(parts)])
    cols = [c for c in rows.columns if c not in (*key, "_cf_no")]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*cols), "_cf_no").alias("_r")).select(*key, "_r.*")
