"""Attaching global aggregates to rows, and joins on keys that may be NULL."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_scalars(df: DataFrame, one_row: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Add the columns of a one-row global aggregate to every row of ``df``.

    Each column becomes a scalar subquery (``DataFrame.scalar()``): Catalyst
    merges them into one subquery that is evaluated once and inlined as a
    literal — no join, no pairs, nothing proportional to ``df`` is shipped.
    ``one_row`` must be a global aggregate (exactly one row by construction).
    """
    cols = list(cols) if cols is not None else one_row.columns
    return df.withColumns({c: one_row.select(c).scalar() for c in cols})


def join_null_safe(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``cols`` where NULL keys match each other; the key columns come out once, from ``left``.

    ``groupBy`` keeps a NULL group, so tables derived from the same groups are
    joined back this way or that group is lost.
    """
    cols = list(cols)
    other = right.select(*[F.col(c).alias(f"_cf_k{i}") for i, c in enumerate(cols)],
                         *[F.col(c) for c in right.columns if c not in cols])
    on = reduce(and_, [left[c].eqNullSafe(other[f"_cf_k{i}"]) for i, c in enumerate(cols)])
    return left.join(other, on, how).drop(*[f"_cf_k{i}" for i in range(len(cols))])
