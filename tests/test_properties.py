"""Property tests from SURVEY §5.3 on generated panels (both layouts)."""

import random

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chronoframe.config import FeatureSpec, LabelRules, PanelSpec
from chronoframe.operators import panel as P
from chronoframe.plans.bindings import add_labels

SPEC = PanelSpec("e", "t", "k")


def _panel(spark, n=3000, seed=11):
    rnd = random.Random(seed)
    rows = [(rnd.choice("abc"), i, float(i) * 60.0, None if rnd.random() < 0.1 else rnd.gauss(20, 8))
            for i in range(n)]
    return spark.createDataFrame(rows, "e string, k long, s double, v double") \
                .withColumn("t", F.timestamp_seconds("s")).drop("s")


def test_lag_then_lead_is_identity(spark):
    df = _panel(spark)
    for layout, kw in (("entity", {}), ("chunked", dict(chunk_rows=200))):
        lagged = P.panel_features(df, SPEC, FeatureSpec(variables=("v",), lags=(3,), windows={}, lag_suffix=""),
                                  layout=layout, **kw)
        back = P.panel_features(lagged, SPEC, layout=layout, leads={"v_back": ("v_lag_3", 3)}, **kw)
        bad = back.where(~F.col("v_back").eqNullSafe(F.col("v")) & F.col("v_back").isNotNull())
        assert bad.count() == 0, layout
        # only the last 3 rows of each entity have no way back
        assert back.where(F.col("v_back").isNull() & F.col("v").isNotNull()).groupBy("e").count() \
                   .where("count > 3").count() == 0


def test_rolling_one_row_is_value(spark):
    df = _panel(spark)
    out = P.panel_features(df, SPEC, FeatureSpec(variables=("v",), lags=(), windows={"1": 1}))
    assert out.where(~F.col("v_roll_1_mean").eqNullSafe(F.col("v"))).count() == 0
    assert out.where(F.col("v_roll_1_std").isNotNull()).count() == 0


def test_fill_is_idempotent(spark):
    df = _panel(spark)
    for layout, kw in (("entity", {}), ("chunked", dict(chunk_rows=150))):
        once = P.panel_features(df, SPEC, fill_cols=["v"], layout=layout, **kw)
        twice = P.panel_features(once, SPEC, fill_cols=["v"], layout=layout, **kw)
        assert once.exceptAll(twice).count() == 0 and once.where("v IS NULL").count() == 0


def test_labels_partition_rows(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice(["Delhi", "Oslo"]), rnd.uniform(0, 3), rnd.uniform(20, 45), rnd.uniform(0, 80),
             rnd.uniform(0, 100)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "city string, precipitation double, temperature_2m double, "
                                     "windspeed_10m double, cloudcover double")
    lab = add_labels(df, LabelRules())
    counts = {r.target_disaster: r["count"] for r in lab.groupBy("target_disaster").count().collect()}
    assert sum(counts.values()) == 2000 and set(counts) <= {0, 1, 2, 3}
    # priority: a storm row is class 3 whatever the other labels
    assert lab.where("target_storm = 1 AND target_disaster <> 3").count() == 0
    assert lab.where("target_storm = 0 AND target_rain = 1 AND target_disaster <> 2").count() == 0


def test_lead_matches_window_lead(spark):
    df = _panel(spark)
    ref = df.withColumn("nx", F.lead("v", 2).over(W.partitionBy("e").orderBy("t", "k")))
    got = P.next_value_target(df, SPEC, "v", "nx", offset=2, layout="chunked", chunk_rows=100)
    assert ref.exceptAll(got.select(*ref.columns)).count() == 0
