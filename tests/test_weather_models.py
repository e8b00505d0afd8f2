"""The model pipelines on a small weather table: whole test sets, metrics equal to a recomputation from the stored scores."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from chronoframe.operators import encode as E
from chronoframe.plans import weather as WX
from chronoframe.plans import weather_models as WM
from chronoframe.schemas import MASTER_SCHEMA


@pytest.fixture(scope="module")
def table(spark):
    rows = []
    for city, lat, base in (("Karachi", 24.86, 36.0), ("Sydney", -33.87, 18.0)):
        for year in (2016, 2018, 2019):
            for h in range(200):
                t = dt.datetime(year, 3, 1) + dt.timedelta(hours=h)
                temp = base + 6 * math.sin(h / 24 * 2 * math.pi) + (h % 5) * 0.3
                rain = 3.0 if h % 9 == 0 else 0.0
                rows.append([t.strftime("%Y-%m-%d %H:%M:%S"), temp, 50.0 + h % 7, rain, 45.0 if h % 13 == 0 else 5.0, 1010.0, 80.0, 200.0,
                             None, city, "X", "Asia" if lat > 0 else "Oceania", lat, 10.0, 1, "Arid"])
    master = spark.createDataFrame(rows, MASTER_SCHEMA).withColumn("datetime", F.to_timestamp("datetime"))
    return WX.labelled_table(master).checkpoint()


SMALL = [dict(max_iter=3, max_depth=2, step=0.3, subsample=1.0, min_instances=1), dict(max_iter=6, max_depth=3, step=0.3, subsample=1.0, min_instances=1)]


def test_labels_are_counted_before_the_trim(table):
    assert table.count() == 2 * 3 * 200
    report = WX.target_distribution_report(table).collect()
    assert sum(r.total_hours for r in report) == 1200


def test_inputs_hold_no_target(table):
    names = WM.inputs(WM.with_next_hour(table))
    assert "temperature_2m" in names and not [c for c in names if c.startswith("target_") or c == "heatwave_threshold"]


def test_temperature(table):
    scored, doc = WM.temperature(table, SMALL, folds=2)
    rows = scored.collect()
    assert len(rows) == 2 * 199                                     # the last hour of each city and split has no next one
    d = doc.first()
    rmse = math.sqrt(sum((r.prediction - r.y) ** 2 for r in rows) / len(rows))
    base = math.sqrt(sum((r.persistence - r.y) ** 2 for r in rows) / len(rows))
    assert d.test_metrics.n == len(rows) and abs(d.test_metrics.rmse - rmse) < 1e-9
    assert abs(d.improvement_over_baseline_pct.rmse - (base - rmse) / base * 100) < 1e-6
    inside = sum(r.pred_q10 <= r.y <= r.pred_q90 for r in rows) / len(rows)
    assert abs(d.uncertainty_metrics.coverage - inside) < 1e-12 and d.cross_validation.rmse_mean > 0


def test_rain(table):
    scored, doc = WM.event(table, "target_rain", "B", "rainfall_classification", SMALL[:1])
    rows, d = scored.collect(), doc.first()
    assert len(rows) == 400 and d.test_metrics.n == 400
    hits = sum(r.prediction == r.y for r in rows) / len(rows)
    assert abs(d.test_metrics.accuracy - hits) < 1e-12 and d.baseline.majority == 0 and 0 <= d.statistical_significance.p_value <= 1


def test_disaster(table):
    scored, doc = WM.disaster(table, num_trees=3, max_depth=3)
    rows, d = scored.collect(), doc.first()
    assert len(rows) == 400 and abs(d.test_metrics.accuracy - sum(r.prediction == r.y for r in rows) / 400) < 1e-12
    assert all(abs(sum(r.prob) - 1) < 1e-9 for r in rows) and d.entropy_uncertainty.n == 400


def test_encoders_are_kept_for_serving(spark, tmp_dir):
    codes = {"c": "c_id"}
    seen = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "c string")
    E.save_encoders(E.fit_encoders(seen, codes), f"{tmp_dir}/enc")
    later = spark.createDataFrame([("c",), ("zzz",), (None,)], "c string")
    got = E.encode_columns(later, codes, E.load_encoders(spark, f"{tmp_dir}/enc", codes)).collect()
    assert {r.c: r.c_id for r in got} == {"c": 2, "zzz": -1, None: -1}
