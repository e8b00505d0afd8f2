"""Metric operators against brute force on small fixtures (SQL is not needed here)."""

import itertools
import math
import random

import numpy as np
from pyspark.sql import functions as F

from chronoframe.operators import metrics as M


def _scores(spark, n=300, seed=7):
    rnd = random.Random(seed)
    rows = [(i, rnd.randint(0, 1), round(rnd.random(), 2), i % 3) for i in range(n)]  # rounding → ties
    return spark.createDataFrame(rows, "id long, y int, p double, g int"), rows


def _brute_auc(rows):
    pos = [p for _, y, p, _ in rows if y == 1]
    neg = [p for _, y, p, _ in rows if y == 0]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in itertools.product(pos, neg))
    return s / (len(pos) * len(neg))


def test_auc_matches_pairs(spark):
    df, rows = _scores(spark)
    assert math.isclose(M.roc_auc(df, "y", "p").first().auc, _brute_auc(rows), rel_tol=1e-12)
    per = {r.g: r.auc for r in M.roc_auc(df, "y", "p", ["g"]).collect()}
    for g in range(3):
        assert math.isclose(per[g], _brute_auc([r for r in rows if r[3] == g]), rel_tol=1e-12)


def test_auc_symmetry(spark):
    df, _ = _scores(spark)
    a = M.roc_auc(df, "y", "p").first().auc
    b = M.roc_auc(df.withColumn("p", -F.col("p")), "y", "p").first().auc
    assert math.isclose(a + b, 1.0, rel_tol=1e-12)


def test_roc_curve_endpoints(spark):
    df, rows = _scores(spark)
    pts = M.roc_curve(df, "y", "p").orderBy(F.col("threshold").desc()).collect()
    assert pts[-1].tpr == 1.0 and pts[-1].fpr == 1.0
    assert all(a.tpr <= b.tpr and a.fpr <= b.fpr for a, b in zip(pts, pts[1:]))


def test_confusion_sums(spark):
    df, rows = _scores(spark)
    d = df.withColumn("pred", (F.col("p") > 0.5).cast("int"))
    cm = M.confusion_matrix(d, "y", "pred", [0, 1]).collect()
    assert len(cm) == 4 and sum(r["count"] for r in cm) == len(rows)


def test_wilcoxon_by_hand(spark):
    a = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]
    b = [1.5, 1.0, 3.0, 2.0, 8.0, 6.5]
    df = spark.createDataFrame(list(zip(a, b)), "a double, b double")
    r = M.wilcoxon_signed_rank(df, "a", "b").first()
    d = [x - y for x, y in zip(a, b) if x != y]          # -0.5, 1, 2, -3, -0.5
    ranks = {0.5: 1.5, 1.0: 3.0, 2.0: 4.0, 3.0: 5.0}     # |d| average ranks
    wp = sum(ranks[abs(x)] for x in d if x > 0)
    wm = sum(ranks[abs(x)] for x in d if x < 0)
    assert (r.n, r.w_plus, r.w_minus, r.statistic) == (5, wp, wm, min(wp, wm))
    n = 5
    var = n * (n + 1) * (2 * n + 1) / 24 - (2 ** 3 - 2) / 48
    z = (min(wp, wm) - n * (n + 1) / 4) / math.sqrt(var)
    assert math.isclose(r.z, z, rel_tol=1e-12)
    assert math.isclose(r.p_value, math.erfc(abs(z) / math.sqrt(2)), rel_tol=1e-6)


def test_mcnemar(spark):
    rows = [(1, 1, 0)] * 10 + [(0, 1, 0)] * 3 + [(1, 1, 1)] * 5
    df = spark.createDataFrame(rows, "y int, m int, b int")
    r = M.mcnemar(df, "y", "m", "b").first()
    n01, n10 = 10, 3   # model right & base wrong / model wrong & base right
    chi2 = (abs(n01 - n10) - 1) ** 2 / (n01 + n10)
    assert (r.n01, r.n10) == (n01, n10) and math.isclose(r.chi2, chi2)
    assert math.isclose(r.p_value, math.erfc(math.sqrt(chi2 / 2)), rel_tol=1e-6)


def test_multiclass_against_numpy(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 3), rnd.randint(0, 3)) for _ in range(400)]
    df = spark.createDataFrame(rows, "y int, p int")
    r = M.multiclass_metrics(df, "y", "p").first()
    y, p = np.array(rows).T
    f1s, sup = [], []
    for k in sorted(set(y) | set(p)):
        tp = np.sum((y == k) & (p == k)); fp = np.sum((y != k) & (p == k)); fn = np.sum((y == k) & (p != k))
        f1s.append(2 * tp / (2 * tp + fp + fn)); sup.append(np.sum(y == k))
    assert math.isclose(r.accuracy, np.mean(y == p))
    assert math.isclose(r.macro_f1, np.mean(f1s))
    assert math.isclose(r.weighted_f1, np.average(f1s, weights=sup))


def test_regression_and_intervals(spark):
    rows = [(1.0, 1.5, 0.0, 2.0), (2.0, 1.0, 1.5, 3.0), (-3.0, -2.0, -4.0, -2.5), (0.5, 0.5, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "y double, p double, lo double, hi double")
    r = M.regression_metrics(df, "y", "p").first()
    y, p = np.array([x[0] for x in rows]), np.array([x[1] for x in rows])
    assert math.isclose(r.rmse, math.sqrt(np.mean((p - y) ** 2)))
    assert math.isclose(r.r2, 1 - np.sum((p - y) ** 2) / np.sum((y - y.mean()) ** 2))
    assert math.isclose(r.mape_pct, np.mean(np.abs((p - y) / y)[np.abs(y) > 1]) * 100)
    iv = M.interval_metrics(df, "y", "lo", "hi").first()
    assert math.isclose(iv.coverage, 0.75)  # rows 1-3 inside, row 4 (0.5 vs [1, 2]) outside


def test_erfc_accuracy(spark):
    xs = [-3.0, -1.0, -0.1, 0.0, 0.3, 1.0, 2.5, 5.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r.e for r in df.select(M.erfc(F.col("x")).alias("e")).collect()]
    for x, e in zip(xs, got):
        assert abs(e - math.erfc(x)) <= 1.2e-7 * max(math.erfc(x), 1e-300) + 1e-15


def test_erfc_to_double_precision(spark):
    import math

    xs = [-3.0, -0.7, 0.0, 1e-9, 0.3, 0.999, 1.5, 1.999, 2.0, 2.001, 2.7, 4.0, 6.5, 10.0, 20.0]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", M.erfc(F.col("x")).alias("e")).collect()
    for r in got:
        assert abs(r.e - math.erfc(r.x)) <= 1e-12 * math.erfc(r.x), r


def test_large_tie_groups_do_not_overflow(spark):
    n = 2_200_000
    df = spark.range(n).select(F.lit(2.0).alias("a"), F.when(F.col("id") % 4 == 0, 3.0).otherwise(1.0).alias("b"))
    r = M.wilcoxon_signed_rank(df, "a", "b").first()
    assert r.n == n and r.w_plus == 0.75 * n * (n + 1) / 2 and r.z is not None


def test_null_groups_stay(spark):
    df = spark.range(400).select(F.when(F.col("id") % 2 == 0, F.lit("g")).alias("g"), (F.col("id") % 4 < 2).cast("int").alias("y"),
                                 ((F.col("id") * 37 % 101) / 101.0).alias("p"))
    whole = {r.g: r for r in M.binary_metrics(df, "y", "p", group_cols=["g"]).collect()}
    assert set(whole) == {None, "g"} and all(r.n == 200 and r.auc is not None for r in whole.values())
    assert M.roc_curve(df, "y", "p", ["g"]).where("g is null").count() > 0
    cells = M.confusion_matrix(df.withColumn("q", F.lit(1)), "y", "q", [0, 1], ["g"]).where("g is null").collect()
    assert sum(r["count"] for r in cells) == 200


def test_features_leave_the_next_value_out(spark):
    from chronoframe.operators.encode import feature_columns

    df = spark.createDataFrame([(1.0, 2.0, 0)], "temperature_2m double, target_temperature_next double, target_rain int")
    assert feature_columns(df) == ["temperature_2m"]


def test_quality_of_an_empty_column_and_a_null_attribute(spark):
    from chronoframe.operators import profile as PR

    rows = [("a", "x" if k else None, k, float(k), None) for k in range(5)] + [("b", "y", k, 1.0, None) for k in range(3)]
    df = spark.createDataFrame(rows, "e string, attr string, t long, v double, w double").withColumn("t", F.timestamp_seconds("t"))
    dim = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z")], "e string, attr string")
    got = {r.e: r for r in PR.quality_report(df, "e", "t", ["v", "w"], 5, attrs=["attr"], dimension=dim, stats_col="v").collect()}
    assert got["a"].total_rows == 5 and got["a"].attr == "x" and got["a"].outliers_w is None and got["a"].outliers_v == 0
    assert got["c"].status == "FAILED" and got["c"].total_rows == 0 and len(got) == 3
