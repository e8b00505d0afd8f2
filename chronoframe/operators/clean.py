"""Cleaning operators (W1, W2, P1, P9, P10, NaN→NULL)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

__all__ = ["nan_to_null", "drop_if_present", "dedup_keep_first", "fill_forward_backward",
           "drop_null_rows", "fill_defaults"]


def nan_to_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Normalise floating NaN to NULL (Spark orders NaN above every number)."""
    return df.withColumns({c: F.when(F.isnan(F.col(c)), F.lit(None)).otherwise(F.col(c)) for c in cols})


def drop_if_present(df: DataFrame, *cols: str) -> DataFrame:
    """``drop`` is already a no-op for absent columns."""
    return df.drop(*cols)


def dedup_keep_first(df: DataFrame, keys: Sequence[str], ordinal: str | Sequence[str]) -> DataFrame:
    """Keep the row with the lowest ``ordinal`` per key (deterministic ``keep='first'``).

    Expressed as ``min_by`` over a struct so the shuffle carries partial
    aggregates (one row per key and map task), not a sorted window.
    """
    ords = [ordinal] if isinstance(ordinal, str) else list(ordinal)
    payload = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*[F.col(c) for c in payload]), F.struct(*[F.col(o) for o in ords]))
    return df.groupBy(*keys).agg(best.alias("_cf_row")).select(*keys, "_cf_row.*").select(*df.columns)


def fill_forward_backward(df: DataFrame, entity: str | Sequence[str], order: Sequence[str],
                          cols: Sequence[str]) -> DataFrame:
    """Per-entity forward fill, then backward fill of what is left (leading NULLs).

    One window stage for all columns. For entities too large for one task use
    :func:`chronoframe.operators.panel.panel_features` with ``layout='chunked'``.
    """
    ents = [entity] if isinstance(entity, str) else list(entity)
    w = W.partitionBy(*ents).orderBy(*order)
    before = w.rowsBetween(W.unboundedPreceding, 0)
    whole = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)  # once per partition, O(n)
    return df.withColumns({c: F.coalesce(F.last(c, True).over(before), F.first(c, True).over(whole))
                           for c in cols})


def drop_null_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """P9."""
    return df.na.drop(subset=list(subset))


def fill_defaults(df: DataFrame, defaults: Mapping[str, object] | object) -> DataFrame:
    """P10: fill NULLs with one value or a per-column mapping."""
    if isinstance(defaults, Mapping):
        return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()
                               if c in df.columns})
    return df.na.fill(defaults)
