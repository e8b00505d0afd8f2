"""Encodings and dimension lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chronoframe.config import FEATURE_EXCLUDE
from chronoframe.operators.ordered import global_row_index
from chronoframe.session import ensure_checkpoint_dir

__all__ = ["category_codes", "fit_encoders", "save_encoders", "load_encoders", "encode_columns", "lookup_with_default", "feature_columns",
           "pinned_features", "columns_matching"]

#: Encoder tables of at most so many values are broadcast to tables of more rows than the second number.
FEW_CODES, MANY_ROWS = 100_000, 1_000_000


def category_codes(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Encoder table for W7: alphabetical code from 0 over the *distinct* values.

    The rank runs over the distinct values only, with the distributed row
    index (no single-task ``Window.orderBy``), so a high-cardinality column
    does not end up in one task either.
    """
    d = df.select(col).where(F.col(col).isNotNull()).distinct()
    return global_row_index(d, [col], out="_cf_code").select(col, F.col("_cf_code").cast("int").alias(out or f"{col}_id"))


def fit_encoders(values: DataFrame, mapping: Mapping[str, str]) -> dict[str, DataFrame]:
    """W7 encoders for a small table of the values present (a dimension): codes by rank, no pass over the facts."""
    return {col: values.select(col).where(F.col(col).isNotNull()).distinct()
            .select(col, (F.dense_rank().over(W.partitionBy().orderBy(col)) - 1).cast("int").alias(code))
            for col, code in mapping.items()}


def save_encoders(encoders: Mapping[str, DataFrame], path: str) -> None:
    """Q7: one table of (column, value, code) to serve with; codes stay those of the fit."""
    rows = [e.select(F.lit(col).alias("column"), F.col(col).cast("string").alias("value"), F.col(e.columns[1]).alias("code"))
            for col, e in encoders.items()]
    reduce(DataFrame.unionByName, rows).write.mode("overwrite").partitionBy("column").parquet(path)


def load_encoders(spark: SparkSession, path: str, mapping: Mapping[str, str]) -> dict[str, DataFrame]:
    """Encoders written by :func:`save_encoders`, for ``encode_columns(..., encoders=)``."""
    rows = spark.read.parquet(path)
    return {col: rows.where(F.col("column") == col).select(F.col("value").alias(col), F.col("code").cast("int").alias(code))
            for col, code in mapping.items()}


def encode_columns(df: DataFrame, mapping: Mapping[str, str], encoders: Mapping[str, DataFrame] | None = None,
                   missing: int = -1) -> DataFrame:
    """Attach codes for several columns; NULL or unseen values → ``missing`` (-1).

    Pass persisted ``encoders`` at serving time so codes equal the training
    codes (Q7); otherwise they are fitted on ``df``, in one pass for all columns.
    """
    out = df
    fitted = [c for c in mapping if not (encoders and c in encoders)]
    if fitted:
        ensure_checkpoint_dir(df.sparkSession)
        values = df.groupBy(*fitted).agg(F.count(F.lit(1)).alias("_cf_n")).checkpoint()
        many = (values.agg(F.sum("_cf_n")).first()[0] or 0) > MANY_ROWS
    for col, code in mapping.items():
        if encoders and col in encoders:
            enc = encoders[col]
        else:
            enc = category_codes(values, col, code)
            if many and enc.count() <= FEW_CODES:       # else the rows would be dealt over tasks by a column of few values
                enc = F.broadcast(enc)
        out = out.join(enc.select(col, code), col, "left") \
                 .withColumn(code, F.coalesce(F.col(code), F.lit(missing)).cast("int"))
    return out


def lookup_with_default(df: DataFrame, dim: DataFrame, key: str, defaults: Mapping[str, object],
                        only_missing: bool = True) -> DataFrame:
    """Left join a dimension and fill gaps with defaults.

    With ``only_missing`` a column already present in ``df`` is kept as is
    (the dashboard only fills absent columns).
    """
    cols = [c for c in defaults if not (only_missing and c in df.columns)]
    if not cols:
        return df
    j = df.join(dim.select(key, *[c for c in cols if c in dim.columns]), key, "left")
    return j.withColumns({c: F.coalesce(F.col(c), F.lit(defaults[c])) if c in dim.columns else F.lit(defaults[c])
                          for c in cols})


def feature_columns(df: DataFrame, exclude: Sequence[str] = FEATURE_EXCLUDE) -> list[str]:
    """Every column not in the exclude set, in table order."""
    ex = set(exclude)
    return [c for c in df.columns if c not in ex]


def pinned_features(df: DataFrame, pinned: Sequence[str]) -> list[str]:
    """P5: the pinned list intersected with present columns, in pinned order."""
    have = set(df.columns)
    return [c for c in pinned if c in have]


def columns_matching(df: DataFrame, *, contains: str | None = None, prefix: str | None = None,
                     suffix: str | None = None) -> list[str]:
    """Column selection by substring / prefix / suffix."""
    out = []
    for c in df.columns:
        if contains is not None and contains not in c:
            continue
        if prefix is not None and not c.startswith(prefix):
            continue
        if suffix is not None and not c.endswith(suffix):
            continue
        out.append(c)
    return out
