"""Sources / sinks and the streaming twins against their batch forms."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from pyspark.sql import Window as W

from chronoframe.config import PanelSpec
from chronoframe.operators import panel as P
from chronoframe.operators import rollups as R
from chronoframe.sources import readers as RD
from chronoframe.sources import writers as WR
from chronoframe.streaming import twins as T
from tests.conftest import SF01


def test_parse_api_payload(spark, tmp_dir):
    doc = {"hourly": {"time": ["2009-01-01T00:00", "2009-01-01T01:00"],
                      "temperature_2m": [1.5, 2.5], "precipitation": [0.0, None]}}
    with open(os.path.join(tmp_dir, "Oslo_2009.json"), "w") as fh:
        json.dump(doc, fh)
    with open(os.path.join(tmp_dir, "Lima_2009.json"), "w") as fh:
        json.dump({"hourly": {"time": []}}, fh)
    rows = RD.parse_api_payload(spark, tmp_dir).orderBy("datetime").collect()
    assert [r.city for r in rows] == ["Oslo", "Oslo"]
    assert rows[0].datetime == dt.datetime(2009, 1, 1, 0, 0) and rows[1].temperature_2m == 2.5
    assert rows[1].precipitation is None and rows[0].visibility is None


def test_dimension_json_roundtrip(spark, tmp_dir):
    dim = spark.createDataFrame([("Oslo", "Norway", "Europe", 59.9, 10.7, True, "Temperate", ""),
                                 ("Lima", "Peru", "Americas", -12.0, -77.0, True, "Arid", "")],
                                "city string, country string, continent string, latitude double, longitude double, "
                                "coastal boolean, climate_zone string, note string")
    WR.write_dimension_json(dim, f"{tmp_dir}/dim")
    back = RD.read_dimension_json(spark, f"{tmp_dir}/dim").orderBy("city").collect()
    assert [(r.city, r.coastal, r.latitude) for r in back] == [("Lima", 1, -12.0), ("Oslo", 1, 59.9)]


def test_cache_is_idempotent_and_splits_prune(spark, tmp_dir):
    ev = spark.read.parquet(f"{SF01}/events.parquet").withColumnRenamed("ts", "datetime") \
              .withColumnRenamed("event_type", "city")
    WR.write_cache(ev, f"{tmp_dir}/cache")
    WR.write_cache(ev.where("city = 'view'"), f"{tmp_dir}/cache")  # re-run one chunk
    assert spark.read.parquet(f"{tmp_dir}/cache").count() == ev.count()
    sp = ev.withColumn("split", F.when(F.dayofmonth("datetime") < 20, "train").otherwise("test"))
    WR.write_splits(sp, f"{tmp_dir}/splits")
    test = RD.read_splits(spark, f"{tmp_dir}/splits", "test")
    plan = test._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "split" in plan
    assert test.count() == sp.where("split = 'test'").count()


def test_master_and_reports(spark, tmp_dir):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    WR.write_master(ev, f"{tmp_dir}/master", "user_id", "ts", num_partitions=4)
    assert spark.read.parquet(f"{tmp_dir}/master").count() == ev.count()
    rep = R.headline_counts(ev, "user_id")
    WR.write_report(rep, f"{tmp_dir}/rep")
    assert spark.read.option("header", True).csv(f"{tmp_dir}/rep").count() == 1
    man = WR.feature_manifest(spark, spark.createDataFrame([(1, 2.0, 3.0, 1)], "a int, a_lag_1 double, "
                                                           "a_roll_3_mean double, target_x int"), ["a"])
    assert {r.column: r.grp for r in man.collect()} == {"a": "excluded", "a_lag_1": "lag",
                                                         "a_roll_3_mean": "rolling", "target_x": "target"}


def _stream_dir(spark, tmp_dir):
    ev = spark.read.parquet(f"{SF01}/events.parquet").where("user_id < 6")
    d = f"{tmp_dir}/stream_in"
    # three time slices written one after the other: files arrive in time order, nothing is late
    for lo, hi in (("2024-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "2024-03-01")):
        ev.where((F.col("ts") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("ts") < F.lit(hi).cast("timestamp_ntz"))) \
          .coalesce(1).write.mode("append").parquet(d)
    return ev, spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(d)


def _run(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.sql(f"SELECT * FROM {name}")


def test_stream_dedup_and_labels(spark, tmp_dir):
    ev, st = _stream_dir(spark, tmp_dir)
    out = _run(T.stream_dedup(st.unionByName(st), ["user_id", "ts"], "ts"), "t1")
    assert out.count() == ev.count()


def test_stream_daily_rollup(spark, tmp_dir):
    ev, st = _stream_dir(spark, tmp_dir)
    out = _run(T.stream_daily_rollup(st, "user_id", "ts", "value"), "t2")
    batch = R.daily_resample(ev, "user_id", "ts", "value").where("rows > 0")
    # windows still open at the end of the input are not emitted in append mode
    assert 0 < out.count() <= batch.count()
    b = batch.withColumnRenamed("value", "batch_value").withColumnRenamed("rows", "batch_rows")
    j = out.withColumn("day", F.date_format("window_start", "yyyy-MM-dd")).join(b, ["user_id", "day"])
    assert j.count() == out.count()
    assert j.where((F.abs(F.col("value") - F.col("batch_value")) > 1e-9) | (F.col("rows") != F.col("batch_rows"))) \
            .count() == 0


def test_stream_lag_features_equal_batch(spark, tmp_dir):
    ev, st = _stream_dir(spark, tmp_dir)
    out = _run(T.stream_lag_features(st, "user_id", "ts", "event_id", "value", lags=(1, 2), window=3),
               "t4")
    batch = P.panel_features(ev, PanelSpec("user_id", "ts", "event_id"),
                             windows={"value_mean_3": ("value", 3)}).withColumns(
        {"value_lag_1": F.lag("value", 1).over(W.partitionBy("user_id").orderBy("ts", "event_id")),
         "value_lag_2": F.lag("value", 2).over(W.partitionBy("user_id").orderBy("ts", "event_id"))})
    cols = ["user_id", "event_id", "value", "value_lag_1", "value_lag_2", "value_mean_3"]
    a = out.select(*[F.round(c, 9).alias(c) for c in cols])
    b = batch.select(*[F.round(c, 9).alias(c) for c in cols])
    assert a.count() == ev.count() and a.exceptAll(b).count() == 0


def test_scored_csv_gzip_metrics_and_reports(spark, tmp_dir):
    import gzip

    from pyspark.sql.types import DoubleType, StringType, StructField, StructType
    from chronoframe.schemas import PREDICTION_SCHEMA
    # S3: gzip CSV read transparently, year / month derived
    path = f"{tmp_dir}/test_predictions.csv.gz"
    with gzip.open(path, "wt") as fh:
        fh.write("datetime,city,temperature_2m,pred_temperature\n2019-03-01 10:00:00,Oslo,3.5,3.1\n"
                 "2020-07-02 11:00:00,Lima,18.0,18.4\n")
    df = RD.read_scored(spark, path, PREDICTION_SCHEMA)
    rows = df.orderBy("datetime").collect()
    assert [(r.year, r.month, r.city) for r in rows] == [(2019, 3, "Oslo"), (2020, 7, "Lima")]
    # Nested one-row metrics document round trip
    m = spark.createDataFrame([(0.62, 0.42)], "rmse double, mae double").selectExpr("struct(rmse, mae) AS test")
    WR.write_metrics_json(m, f"{tmp_dir}/metrics")
    back = RD.read_metrics_json(spark, f"{tmp_dir}/metrics").first()
    assert back.test.rmse == 0.62
    # S13 + S14: explicit-schema report read; ordered export with the first-N limit
    schema = StructType([StructField("city", StringType()), StructField("rmse", DoubleType())])
    rep = spark.createDataFrame([("b", 2.0), ("a", 1.0), ("c", 3.0)], schema)
    WR.export_rows(rep, f"{tmp_dir}/export", ["city"], limit=2)
    got = RD.read_report_csv(spark, f"{tmp_dir}/export", schema).orderBy("city").collect()
    assert [r.city for r in got] == ["a", "b"]


def test_master_csv_reader(spark, tmp_dir):
    from chronoframe.config import HOURLY_VARIABLES
    header = ["datetime"] + HOURLY_VARIABLES + ["city", "country", "continent", "latitude", "longitude", "coastal",
                                                "climate_zone"]
    line = ["2009-01-01 00:00:00"] + ["1.0"] * (len(HOURLY_VARIABLES) - 1) + [""] + \
        ["Oslo", "Norway", "Europe", "59.9", "10.7", "1", "Temperate"]
    with open(f"{tmp_dir}/master.csv", "w") as fh:
        fh.write(",".join(header) + "\n" + ",".join(line) + "\n")
    df = RD.read_master_csv(spark, f"{tmp_dir}/master.csv")
    assert "visibility" not in df.columns                      # S1 + P1
    r = df.first()
    assert r.city == "Oslo" and str(r.datetime) == "2009-01-01 00:00:00"
