"""Plan-shape tests and the driver contract."""

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from chronoframe.plans import catalog
from chronoframe.config import FeatureSpec, PanelSpec
from chronoframe.operators import panel as P
from tests.conftest import SF

FAST_ML = {"gbt_regression_scores", "gbt_classifier_scores", "rf_multiclass_scores", "model_search",
           "model_importance", "live_panel", "quantile_forest_scores", "quantile_forest_metrics", "boosted_class_scores",
           "stream_dedup", "stream_daily_rollup", "stream_labels", "stream_features"}      # streams: what they return is read from their sink


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_stage_single_exchange(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    fs = FeatureSpec(variables=("value",), lags=(1, 24), windows={"a": 3, "b": 24}, lag_suffix="")
    out = P.panel_features(ev, PanelSpec("user_id", "ts", "event_id"), fs, fill_cols=["value"],
                           dedup_ordinal="event_id")
    plan = out._jdf.queryExecution().sparkPlan().toString()
    plan_exec = _plan(out)
    assert plan_exec.count("Exchange hashpartitioning") == 1 or plan_exec.count("Exchange") <= 2, plan_exec
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_column_pruning_reaches_scan(spark):
    q = E.queries()["label_distribution"](spark, SF)
    plan = _plan(q)
    scan = [ln for ln in plan.splitlines() if "lineitem" in ln and "ReadSchema" in ln]
    assert scan and "l_linestatus" not in scan[0] and "l_partkey" not in scan[0]


def test_no_python_udfs_in_registered_queries(spark):
    qs = E.queries()
    for name, fn in qs.items():
        if name not in catalog.QUERIES or name in FAST_ML:      # the panel library's own queries
            continue
        plan = _plan(fn(spark, SF))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and "rain_pct" in df.columns


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert not any(k.startswith("op") or "pipeline" in k for k in catalog.QUERIES)


@pytest.mark.parametrize("name", ["label_distribution", "quality_report", "feature_table", "binary_metrics",
                                  "wilcoxon", "roc_curve", "cv_folds", "histogram", "multiclass_metrics"])
def test_queries_match_duckdb_sf0001(spark, name):
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "labels"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sp = E.queries()[name](spark, SF).toPandas()
    dk = con.execute(E.oracle_sql()[name]).df()
    assert sorted(sp.columns) == sorted(dk.columns)
    cols = sorted(sp.columns)

    def norm(pdf):
        def cell(v):
            if v is None or (not isinstance(v, str) and pd.isna(v)):
                return None
            return round(float(v), 6) if isinstance(v, float) else v
        rows = [tuple(cell(v) for v in rec)
                for rec in pdf[cols].astype(object).itertuples(index=False, name=None)]
        return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))
    assert norm(sp) == norm(dk)


def test_split_filters_reach_the_scan(spark):
    for name, table, col in (("regression_metrics", "orders", "o_orderdate"), ("class_balance", "lineitem", "l_shipdate")):
        plan = _plan(E.queries()[name](spark, SF))
        scans = [ln for ln in plan.splitlines() if f"{table}.parquet" in ln or ("PushedFilters" in ln and col in ln)]
        assert any("PushedFilters" in ln and col in ln and "GreaterThanOrEqual" in ln for ln in scans), name
