"""Registered queries: one Spark plan per surveyed operator, plus its DuckDB oracle SQL.

Every query reads the driver's tables (or data Spark derives from them) in
full; nothing is filtered to ids, prefixes or row caps. Doubles come out as
computed; only what the surveyed reports round is rounded.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, digits: int) -> DataFrame:
    """Doubles rounded to ``digits`` decimals, half away from zero as SQL's ``round``: for registered queries whose exact
    decimal ties two engines' summation orders would print differently. The operators themselves return raw doubles.

    In Arrow batches: as expressions, some forty of them make generated code that the JVM no longer compiles.
    """
    at = [i for i, (_, kind) in enumerate(df.dtypes) if kind == "double"]

    def run(batches):
        for batch in batches:
            cols = list(batch.columns)
            for i in at:
                cols[i] = pa.array(half_up(cols[i].to_numpy(zero_copy_only=False), digits), mask=cols[i].is_null().to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names)

    return df.mapInArrow(run, df.schema)


def half_up(x: np.ndarray, digits: int) -> np.ndarray:
    scale = 10.0 ** digits
    with np.errstate(invalid="ignore", over="ignore"):
        y = np.abs(x) * scale
        whole = np.rint(y)
        whole += y - whole == 0.5                    # rint takes ties to the even neighbour
        return np.where(y < 2.0 ** 53, np.copysign(whole, x) / scale + 0.0, x)


def _load_modules() -> None:
    # Importing the modules registers their queries.
    from chronoframe.plans import q_labels, q_panel, q_profile, q_metrics, q_rollups, q_ml  # noqa: F401
    from chronoframe.plans import q_dirty, q_incremental, q_stream  # noqa: F401


__all__ = ["QUERIES", "ORACLE", "register", "rounded"]
