"""The weather preset on a small hand-made master table in the surveyed schema."""

import datetime as dt

from pyspark.sql import functions as F

from chronoframe.plans import weather as WX
from chronoframe.plans.bindings import add_labels
from chronoframe.config import WEATHER_RULES
from chronoframe.schemas import MASTER_SCHEMA


def _master(spark, hours=100):
    rows = []
    for city, lat, temp0 in (("Karachi", 24.86, 38.0), ("Sydney", -33.87, 20.0)):
        for h in range(hours):
            t = dt.datetime(2017, 12, 30) + dt.timedelta(hours=h)
            temp = temp0 + (h % 7)
            rows.append([t.strftime("%Y-%m-%d %H:%M:%S"), temp, 50.0, 2.0 if h % 10 == 0 else 0.0, 45.0 if h % 13 == 0 else 5.0,
                         1010.0, 80.0, 200.0, None, city, "X", "Asia" if lat > 0 else "Oceania", lat, 10.0, 1, "Arid"])
    df = spark.createDataFrame(rows, MASTER_SCHEMA)
    return df.withColumn("datetime", F.to_timestamp("datetime"))


def test_weather_feature_table(spark):
    ft = WX.feature_table(_master(spark))
    assert ft.count() == 2 * (100 - 72)                       # warm-up trim per city
    r = ft.where("city = 'Sydney'").orderBy("datetime").first()
    assert r.season == 2                                      # December, southern hemisphere
    assert {"temperature_2m_roll_7d_std", "city_id", "target_disaster", "split"} <= set(ft.columns)
    assert ft.where("city = 'Karachi'").agg(F.max("heatwave_threshold")).first()[0] == 40.0


def test_weather_reports(spark):
    m = _master(spark)
    q = WX.quality_report(m).collect()
    assert {r.city for r in q} == {"Karachi", "Sydney"} and all(r.total_rows == 100 for r in q)
    assert all(r.missing_visibility_pct == 100.0 for r in q)
    lab = add_labels(m, WEATHER_RULES)
    rep = {r.city: r for r in WX.target_distribution_report(lab).collect()}
    assert rep["Karachi"].rain_hours == 10 and rep["Karachi"].total_hours == 100
