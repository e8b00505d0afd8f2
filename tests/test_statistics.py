"""M8's exact distribution against enumeration, A25's Gram blocks against numpy."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoframe.operators import metrics as M
from chronoframe.operators import profile as PR


def enumerated(d):
    """Two-sided p-value over all signs of the ranks."""
    rank = {x: r for r, x in enumerate(sorted(map(abs, d)), 1)}
    n = len(d)
    plus = sum(rank[abs(x)] for x in d if x > 0)
    least = min(plus, n * (n + 1) // 2 - plus)
    below = sum(sum(r for r, s in zip(range(1, n + 1), signs) if s) <= least for signs in itertools.product((0, 1), repeat=n))
    return min(1.0, 2 * below / 2 ** n)


def test_exact_p_values_equal_enumeration(spark):
    rng, rows, want = random.Random(8), [], {}
    for n in range(1, 13):
        for k in range(3):
            d = [m * rng.choice((1, -1)) if k else m for m in rng.sample(range(1, 400), n)]
            want[f"{n}-{k}"] = enumerated(d)
            rows += [(f"{n}-{k}", float(x), 0.0) for x in d]
    df = spark.createDataFrame(rows, "g string, a double, b double").repartition(4)
    got = {r["g"]: r for r in M.wilcoxon_signed_rank(df, "a", "b", ["g"]).collect()}
    assert got.keys() == want.keys()
    for g, r in got.items():
        assert r["exact"] and math.isclose(r["p_value"], want[g], rel_tol=1e-12), g


def test_exact_only_where_it_holds(spark):
    rng = random.Random(2)
    sizes = rng.sample(range(1, 5000), 51)
    groups = {"fifty": [x * rng.choice((1, -1)) for x in sizes[:50]], "more": [x * rng.choice((1, -1)) for x in sizes],
              "tie": [3, -3, 5, 7], "zero": [0, 2, -5, 9], "none": [0, 0], None: [1, 2, 3]}
    rows = [(g, float(x), 0.0) for g, d in groups.items() for x in d] + [("null", None, 1.0), ("fifty", float("nan"), 1.0)]
    got = {r["g"]: r for r in M.wilcoxon_signed_rank(spark.createDataFrame(rows, "g string, a double, b double"), "a", "b", ["g"]).collect()}
    assert {g: r["exact"] for g, r in got.items()} == {"fifty": True, "more": False, "tie": False, "zero": False, "none": False, None: True}
    assert (got["zero"]["n"], got["zero"]["w_plus"], got["zero"]["w_minus"]) == (3, 4.0, 2.0)
    assert got["none"]["n"] == 0 and got["none"]["p_value"] is None and got[None]["p_value"] == 0.25
    # the two agree where both hold well
    approx = {r["g"]: r for r in M.wilcoxon_signed_rank(spark.createDataFrame(rows, "g string, a double, b double"), "a", "b", ["g"], exact_pairs=0).collect()}
    assert not approx["fifty"]["exact"] and abs(approx["fifty"]["p_value"] - got["fifty"]["p_value"]) < 0.01
    with pytest.raises(ValueError):
        M.wilcoxon_signed_rank(spark.createDataFrame(rows, "g string, a double, b double"), "a", "b", exact_pairs=51)


def test_gram_blocks_equal_numpy(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (400, 10))
    x[:, 1] += 0.8 * x[:, 0]
    x[:, 2] = x[:, 0] * -2 + 5
    x[:, 3] += 1e9                       # a large offset
    x[:, 4] = 7.25                       # constant
    x[:, 5] = np.where(rng.random(400) < 0.4, np.nan, x[:, 5] + x[:, 1])
    x[:, 6] = np.where(np.isnan(x[:, 5]), x[:, 6], 0.1)      # constant where column 5 has a value
    x[:, 7] = np.nan
    x[:, 8] = np.where(rng.random(400) < 0.5, x[:, 8], np.nan)
    rows = [tuple(None if np.isnan(v) and i % 2 else float(v) for v in r) for i, r in enumerate(x)]         # NULL or NaN
    cols = [f"c{k}" for k in range(10)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(3)
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in PR.correlation_matrix(df, cols).collect()}
    assert len(got) == 100
    for i, j in itertools.product(range(10), repeat=2):
        both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        a, b = x[both, i], x[both, j]
        r = got[cols[i], cols[j]]
        if len(a) < 2 or np.ptp(a) == 0 or np.ptp(b) == 0:
            assert r is None, (i, j, r)
        else:
            assert abs(r - np.corrcoef(a, b)[0, 1]) < 1e-9, (i, j)
    assert {r["n"] for r in PR.gram_blocks(df, cols).where("i = 7").collect()} == {0}


def test_gram_blocks_of_no_rows(spark):
    df = spark.createDataFrame([], "a double, b int")
    assert PR.correlation_matrix(df, ["a", "b"]).collect() == []


def test_one_aggregation_with_generated_code(spark):
    """49 columns: the sums are one hash aggregation inside whole-stage generated code, whatever the number of columns."""
    df = spark.range(100).select(*[(F.col("id") * (k + 3) % 17).cast("double").alias(f"c{k}") for k in range(49)])
    plan = PR.gram_blocks(df, df.columns)._jdf.queryExecution().executedPlan()
    plan = plan.toString()
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan and "Window" not in plan
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = PR.gram_blocks(df, df.columns)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    marked = [line for line in text.splitlines() if "HashAggregate" in line or "Generate" in line]
    assert marked and all("*(" in line for line in marked), marked


def test_rolling_windows_are_batches_not_frames():
    """windows merged in batches equal plain ones: an entity across batches, missing and infinite values, a constant run."""
    import pyarrow as pa
    from chronoframe.operators.panel import rolling_stats
    rng = np.random.default_rng(8)
    v = rng.normal(1e6, 1, 90)
    v[40:60] = 3.7
    for bad in (None, np.inf):
        if bad:
            v[10] = bad
        at = np.concatenate([np.arange(1, 36), np.arange(1, 56)])
        missing = rng.random(90) < 0.2
        for n, (count, mean, std) in zip((7, 24), rolling_stats([pa.array(v, mask=missing)], at, (7, 24))):
            for i in range(90):
                own = [v[k] for k in range(max(i - min(n, at[i]) + 1, 0), i + 1) if not missing[k]]
                assert count[0, i] == len(own)
                if own and np.isfinite(own).all():
                    np.testing.assert_allclose(mean[0, i], np.mean(own), rtol=1e-13)
                    if len(own) > 1:
                        np.testing.assert_allclose(std[0, i], np.std(own, ddof=1), rtol=1e-8, atol=1e-12)
                elif own:
                    assert mean[0, i] == np.inf and (len(own) < 2 or np.isnan(std[0, i]))


def test_stage_plan_has_no_sliding_frame(spark):
    from conftest import SF01
    from chronoframe.plans import q_panel
    plan = q_panel.feature_stage(spark, SF01)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "-167" not in plan and "-23" not in plan and "round(" not in plan
