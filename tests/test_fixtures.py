"""Hand-written micro-fixtures (FIXTURES.md §4)."""

import datetime as dt
import math

from pyspark.sql import functions as F

from chronoframe.config import FeatureSpec, LabelRules, PanelSpec
from chronoframe.functions.calendar import season_hemisphere
from chronoframe.functions.rules import label_columns
from chronoframe.operators import clean as C
from chronoframe.operators import metrics as M
from chronoframe.operators import panel as P
from chronoframe.operators import profile as PR
from chronoframe.operators import rollups as R
from chronoframe.operators.ordered import exact_quantiles
from chronoframe.operators.splits import assign_cv_folds

T0 = dt.datetime(2020, 1, 1)


def _series(spark):
    rows = [("a", T0 + dt.timedelta(hours=i), i, v) for i, v in enumerate([10.0, None, 12.0])]
    rows += [("b", T0 + dt.timedelta(hours=i), 10 + i, v) for i, v in enumerate([None, 5.0])]
    return spark.createDataFrame(rows, "e string, t timestamp, k long, v double")


def test_fill_forward_backward(spark):
    for layout in ("entity", "chunked"):
        out = P.panel_features(_series(spark), PanelSpec("e", "t", "k"), fill_cols=["v"], layout=layout,
                               chunk_rows=2)
        got = [r.v for r in out.orderBy("e", "t").collect()]
        assert got == [10.0, 10.0, 12.0, 5.0, 5.0], layout


def test_rolling_two_rows(spark):
    fs = FeatureSpec(variables=("v",), lags=(), windows={"2": 2})
    for layout in ("entity", "chunked"):
        out = P.panel_features(_series(spark), PanelSpec("e", "t", "k"), fs, layout=layout, chunk_rows=2).orderBy("e", "t").collect()
        assert [r.v_roll_2_mean for r in out] == [10.0, 10.0, 12.0, None, 5.0]
        assert all(r.v_roll_2_std is None for r in out)


def test_null_and_nan_comparison(spark):
    rules = LabelRules()
    df = spark.createDataFrame([("x", float("nan"), None, 50.0, 80.0)],
                               "city string, precipitation double, temperature_2m double, windspeed_10m double, "
                               "cloudcover double")
    df = C.nan_to_null(df, ["precipitation", "temperature_2m"])
    for name, c in label_columns(rules).items():
        df = df.withColumn(name, c)
    r = df.first()
    assert r.precipitation is None and r.target_rain == 0 and r.target_heatwave == 0
    assert r.target_storm == 1 and r.target_disaster == 3


def test_duplicates_lower_ordinal_wins(spark):
    df = spark.createDataFrame([("a", T0, 2, 1.0), ("a", T0, 1, 2.0)], "e string, t timestamp, ord long, v double")
    assert C.dedup_keep_first(df, ["e", "t"], "ord").first().v == 2.0
    for layout in ("entity", "chunked"):
        out = P.panel_features(df, PanelSpec("e", "t"), dedup_ordinal="ord", layout=layout)
        assert [r.v for r in out.collect()] == [2.0]


def test_priority_label(spark):
    rules = LabelRules()
    df = spark.createDataFrame([("Karachi", 5.0, 41.0, 45.0, 90.0), ("Oslo", 5.0, 36.0, 10.0, 10.0),
                                ("Karachi", 0.0, 39.0, 0.0, 0.0)],
                               "city string, precipitation double, temperature_2m double, windspeed_10m double, "
                               "cloudcover double")
    for name, c in label_columns(rules).items():
        df = df.withColumn(name, c)
    assert [r.target_disaster for r in df.collect()] == [3, 2, 0]


def test_season_flip(spark):
    df = spark.createDataFrame([(12, False), (12, True), (9, False), (9, True)], "m int, south boolean")
    got = [r.s for r in df.select(season_hemisphere(F.col("m"), F.col("south")).alias("s")).collect()]
    assert got == [0, 2, 3, 1]


def test_gap_day(spark):
    df = spark.createDataFrame([("a", T0, 1.0), ("a", T0 + dt.timedelta(days=3), 3.0)], "e string, t timestamp, v double")
    out = R.daily_resample(df, "e", "t", "v").orderBy("day").collect()
    assert len(out) == 4 and [r.v for r in out].count(None) == 2 and [r.rows for r in out] == [1, 0, 0, 1]


def test_bins(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,)], "v double")
    out = PR.histogram(df, "v", 2).orderBy("bin").collect()
    assert [r["count"] for r in out] == [1, 2]


def test_calibration_edge(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 1), (0.15, 1)], "p double, y int")
    out = {r.bin: r.n for r in M.calibration_curve(df, "y", "p", 10).collect()}
    assert out == {0: 1, 1: 2}


def test_auc_ties_and_single_class(spark):
    tied = spark.createDataFrame([(0.5, 0), (0.5, 1), (0.5, 1), (0.5, 0)], "p double, y int")
    assert M.roc_auc(tied, "y", "p").first().auc == 0.5
    one = spark.createDataFrame([(0.1, 1), (0.9, 1)], "p double, y int")
    assert M.roc_auc(one, "y", "p").first().auc is None


def test_half_even(spark):
    r = spark.range(1).select(F.bround(F.lit(2.5), 0).alias("a"), F.bround(F.lit(0.125), 2).alias("b")).first()
    assert r.a == 2.0 and r.b == 0.12


def test_quantile(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "v double")
    assert exact_quantiles(df, "v", [0.25]).first()[0] == 1.75


def test_folds(spark):
    df = spark.range(20).withColumnRenamed("id", "i")
    f = assign_cv_folds(df, ["i"], k=5).orderBy("i").collect()
    assert [r.test_fold for r in f][:5] == [-1] * 5
    assert [r.test_fold for r in f][5:8] == [0, 0, 0]
    assert f[5].train_end == 5 and max(r.test_fold for r in f) == 4
    assert math.isclose(sum(1 for r in f if r.test_fold == 4), 3)
