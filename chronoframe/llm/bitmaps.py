"""Joins of wide rows with a set of ids that few of them have: only rows that may have one are shuffled.

The ids are hashed into ``BITS`` bits, a table of at most ``BITS / 64`` rows
whatever the number of ids, so it can always be broadcast. Rows whose bit is
off surely have none of the ids and stay where they are; the others are joined
exactly. With more ids than bits all rows are joined, and the answer is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 23


def _bit(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BITS))


def marked(df: DataFrame, key: str, ids: DataFrame, id_col: str) -> DataFrame:
    """``df`` with ``__maybe``: whether the key's bit is on."""
    bit = _bit(F.col(id_col).cast("long"))
    words = ids.where(F.col(id_col).isNotNull()).select(F.floor(bit / 64).alias("__word"), F.expr("1L").alias("one"), (bit % 64).cast("int").alias("k")).select("__word", F.expr("shiftleft(one, k)").alias("b")).groupBy("__word").agg(F.bit_or("b").alias("__bits"))
    own = _bit(F.col(key).cast("long"))
    out = df.withColumn("__own", own).withColumn("__w", F.floor(F.col("__own") / 64)).join(F.broadcast(words), F.col("__w") == F.col("__word"), "left")
    on = F.expr("shiftright(__bits, cast(__own % 64 as int)) & 1L") == 1
    return out.withColumn("__maybe", F.coalesce(on, F.lit(False)) & F.col(key).isNotNull()).drop("__own", "__w", "__word", "__bits")


def having(df: DataFrame, key: str, ids: DataFrame, id_col: str) -> DataFrame:
    """Rows of ``df`` whose key is among the ids."""
    few = marked(df, key, ids, id_col).where("__maybe").drop("__maybe")
    return few.join(ids.select(F.col(id_col).cast("long").alias("__id")).distinct(), F.col(key).cast("long") == F.col("__id"), "left_semi")


def without(df: DataFrame, key: str, ids: DataFrame, id_col: str) -> DataFrame:
    """Rows of ``df`` whose key is not among the ids (null keys stay)."""
    rows = marked(df, key, ids, id_col)
    few = rows.where("__maybe").join(ids.select(F.col(id_col).cast("long").alias("__id")).distinct(), F.col(key).cast("long") == F.col("__id"), "left_anti")
    return rows.where("not __maybe").unionByName(few).drop("__maybe")
