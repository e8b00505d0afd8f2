"""Bindings of the panel concepts to the driver's tables.

The weather tables of the surveyed system are not available; the same
operators run over these stand-ins:

* observation panel — ``events``: entity ``user_id`` (or ``event_type`` for
  deep 72-lag / 168-row frames), order ``ts``, tie-break ``event_id``;
* multi-rule labels — ``lineitem`` ⋈ ``supplier`` ⋈ ``nation`` ⋈ ``region``:
  entity = supplier nation, "continent" = region;
* multi-year series — ``orders`` per customer (1995–2001): year splits,
  next-value targets, calendar roll-ups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoframe.config import FeatureSpec, LabelRules, PanelSpec
from chronoframe.functions.rules import label_columns

# Binding parameters (our choice, not reference values).
LINEITEM_RULES = LabelRules(
    rain_col="l_discount", rain_gt=0.05,
    heat_col="l_extendedprice", heat_default=90000.0, heat_special=95000.0,
    heat_special_col="l_returnflag", heat_special_members=("R",),
    storm_a_col="l_quantity", storm_a_ge=40.0, storm_b_col="l_tax", storm_b_ge=0.07,
)
USER_PANEL = PanelSpec("user_id", "ts", "event_id", ("value",))
TYPE_PANEL = PanelSpec("event_type", "ts", "event_id", ("value",))
ORDER_PANEL = PanelSpec("o_custkey", "o_orderdate", "o_orderkey", ("o_totalprice",))
USER_FEATURES = FeatureSpec(variables=("value",), lags=(1, 2, 3), windows={"3r": 3, "24r": 24}, lag_suffix="")
DEEP_FEATURES = FeatureSpec(variables=("value",))  # weather sizes: lags 24/48/72, windows 24/168
PANEL_CHUNK_ROWS = 1_000_000  # rows of one window task in the chunked layout
SMALL_CHUNK_ROWS = 500        # chunks of the *_chunked queries: small, so that the tables here have many
ROLLING_METHOD = "blocks"      # 168-row windows merged from 24-row blocks
SOUTH_NATION_BELOW = 12
SPLIT_TRAIN, SPLIT_VAL, SPLIT_TEST = (1995, 1998), 1999, (2000, 2001)
EVENT_POSITIVE = "error"
EVENT_SCORE_SCALE = 500.0
EVENT_TRAIN_END = "2024-01-20"
LINE_PROB_COLS = ("l_discount", "l_tax", "l_quantity", "l_extendedprice")
LINE_PROB_SCALE = (0.1, 0.08, 50.0, 105000.0)


class DirtyDir(str):
    """A table folder whose tables get faults put in by rule (:mod:`chronoframe.plans.q_dirty`)."""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if isinstance(sf_dir, DirtyDir):
        from chronoframe.plans.q_dirty import soil
        return soil(df, name)
    return df


def nation_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed-size dimension (25 nations × 5 regions): safe to broadcast."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")


def lineitem_panel(spark: SparkSession, sf_dir: str, with_labels: bool = True) -> DataFrame:
    """``lineitem`` with the supplier's nation / region and the rule labels."""
    li = table(spark, sf_dir, "lineitem")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    df = li.join(s, li.l_suppkey == s.s_suppkey).drop("s_suppkey") \
           .join(F.broadcast(nation_dim(spark, sf_dir)), F.col("s_nationkey") == F.col("n_nationkey")) \
           .drop("n_nationkey")
    if with_labels:
        df = add_labels(df, LINEITEM_RULES)
    return df


def lineitem_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` with the rule labels only — the rules read line columns, so queries that
    do not report by nation need no join (no shuffle of the fact table)."""
    return add_labels(table(spark, sf_dir, "lineitem"), LINEITEM_RULES)


def supplier_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier → (nation name, region name); joined to per-supplier partial aggregates."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return s.join(F.broadcast(nation_dim(spark, sf_dir)), F.col("s_nationkey") == F.col("n_nationkey")) \
            .select("s_suppkey", "s_nationkey", "n_name", "r_name")


def add_labels(df: DataFrame, rules: LabelRules) -> DataFrame:
    """Label columns depend on each other, so add them one after the other."""
    for name, c in label_columns(rules).items():
        df = df.withColumn(name, c)
    return df


def line_probabilities(df: DataFrame) -> DataFrame:
    """A 4-class probability vector per line: scaled columns normalised to sum 1."""
    parts = [F.col(c) / F.lit(s) for c, s in zip(LINE_PROB_COLS, LINE_PROB_SCALE)]
    total = parts[0] + parts[1] + parts[2] + parts[3]
    return df.withColumn("prob", F.array(*[p / total for p in parts]))


def event_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary truth and score on ``events``: y = error event, p = value / 500."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", "user_id", "ts", "event_type",
                     (F.col("event_type") == EVENT_POSITIVE).cast("int").alias("y"),
                     F.least(F.col("value") / F.lit(EVENT_SCORE_SCALE), F.lit(1.0)).alias("p"))
