"""Incremental features, resumable ingest, bad-record channel."""

import datetime as dt
import json
import os

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType, TimestampType

from chronoframe.config import FeatureSpec, PanelSpec
from chronoframe.operators import extension as X
from chronoframe.operators import panel as P
from chronoframe.schemas import API_PAYLOAD_SCHEMA
from chronoframe.sources import ingest as I

SPEC, FS = PanelSpec("who", "ts", "k"), FeatureSpec(variables=("a",), lags=(1, 3), windows={"4r": 4}, lag_suffix="")
SCHEMA = "who string, ts timestamp, k int, a double"


def rows(n, seed, who=("x", "y", None), start=0):
    rng = np.random.default_rng(seed)
    return [(who[i % len(who)], dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), i, None if rng.random() < 0.3 else float(rng.integers(0, 50))) for i in range(start, start + n)]


def appended(spark, *parts, late_rows=6):
    tail, feats, late = X.empty_tail(spark.createDataFrame([], SCHEMA), ["a"]), [], []
    for p in parts:
        e = X.extend_panel(tail, spark.createDataFrame(p, SCHEMA), SPEC, FS, ["a"], late_rows)
        feats.append(e.features.checkpoint())
        late += e.too_late.collect()
        tail = e.tail.checkpoint()
    return X.merge_upserts(feats, ["who", "ts", "k"]), tail, late


def same(got, want):
    key = lambda r: (str(r["who"]), r["ts"])
    x, y = sorted(got.select(want.columns).collect(), key=key), sorted(want.collect(), key=key)
    assert len(x) == len(y)
    for p, q in zip(x, y):
        for c in want.columns:
            assert p[c] == q[c] or p[c] is not None and q[c] is not None and abs(p[c] - q[c]) < 1e-9, (c, p, q)


def full(spark, data):
    return P.panel_features(spark.createDataFrame(data, SCHEMA), SPEC, FS, fill_cols=["a"])


def test_appends_equal_one_run(spark):
    data = rows(60, 1)
    got, tail, late = appended(spark, data[:25], data[25:28], data[28:])
    same(got, full(spark, data))
    assert not late and max(r["count"] for r in tail.groupBy("who").count().collect()) <= FS.halo + 6


def test_late_correction_and_insertion(spark):
    data = rows(60, 2)
    fixed = [(w, t, k, 77.0) if k in (34, 36) else (w, t, k, None) if k == 38 else (w, t, k, v) for w, t, k, v in data]
    extra = ("x", dt.datetime(2024, 1, 2, 11, 30), 500, 3.5)                            # a row that was missing
    got, _, late = appended(spark, data[:40], [r for r in fixed if r[2] in (34, 36, 38)] + [extra], fixed[40:])
    same(got, full(spark, fixed + [extra]))
    assert not late


def test_corrections_out_of_reach_are_returned(spark):
    data = rows(90, 3, who=("x",))
    old = (*data[5][:3], 99.0)
    got, _, late = appended(spark, data[:60], [old], data[60:])
    assert [tuple(r) for r in late] == [old]
    same(got, full(spark, data))


def test_leading_nulls_are_filled_by_a_later_append(spark):
    data = [("x", dt.datetime(2024, 1, 1, h), h, None if h < 4 else float(h)) for h in range(9)]
    got, _, _ = appended(spark, data[:3], data[3:])
    same(got, full(spark, data))


def test_empty_append(spark):
    data = rows(20, 4)
    got, _, _ = appended(spark, data, [])
    same(got, full(spark, data))


class Source:
    def __init__(self, df):
        self.df, self.asked = df, []

    def __call__(self, pending):
        self.asked.append(pending.count())
        return self.df.join(pending.select("city", "year"), (self.df["city"] == pending["city"]) & (F.year("datetime") == pending["year"]), "left_semi")


def test_ingest_stopped_between_write_and_commit(spark, tmp_dir):
    data = [(f"c{i % 3}", dt.datetime(2009 + i % 4, 1, 1 + i % 20), float(i)) for i in range(200)]
    df = spark.createDataFrame(data, "city string, datetime timestamp, v double")
    work = df.select("city").distinct().crossJoin(spark.range(2009, 2014).select(F.col("id").cast("int").alias("year")))
    store, load = I.ChunkStore(spark, f"{tmp_dir}/store"), Source(df)
    assert store.read(df.schema).collect() == [] and store.pending(work).count() == 15
    first = store.pending(work).where("year < 2011").checkpoint()
    store.commit(store.write(first, load))                                               # one good run over six chunks
    store.write(store.pending(work).checkpoint(), load)                                  # written, then stopped before the commit
    assert store.read(df.schema).count() == df.where(F.year("datetime") < 2011).count()   # what was not committed is not seen
    assert store.run(work, load) == 9 and store.run(work, load) == 0
    got = store.read(df.schema)
    assert got.exceptAll(df).count() == 0 and df.exceptAll(got).count() == 0
    assert load.asked == [6, 9, 9]
    m = {(r["city"], r["year"]): r["rows"] for r in store.manifest(work).collect()}
    assert len(m) == 15 and m["c0", 2013] == 0 and sum(m.values()) == 200


CSV = StructType([StructField("city", StringType()), StructField("datetime", TimestampType()), StructField("n", IntegerType()), StructField("v", DoubleType())])


def test_csv_quarantine(spark, tmp_dir):
    lines = ["city,datetime,n,v", "Oslo,2009-01-01 00:00:00,1,1.5", "Oslo,2009-01-01 01:00:00,x,1.5", "Oslo,not a time,2,1.5", "Lima,2009-01-01 02:00:00,,", "Lima,2009-01-01 03:00:00",
             "Lima,,4,2.5", ",2009-01-01 04:00:00,5,2.5", "Rome,2009-01-01 05:00:00,6,2.5,7"]
    with open(f"{tmp_dir}/a.csv", "w") as fh:
        fh.write("\n".join(lines) + "\n")
    good, bad = I.read_csv_checked(spark, f"{tmp_dir}/a.csv", CSV, "datetime", ["city"])
    assert good.schema == CSV
    assert sorted(str(r["datetime"]) for r in good.collect()) == ["2009-01-01 00:00:00", "2009-01-01 02:00:00", "None"]
    got = {(r["reason"], r["record"]) for r in bad.collect()}
    assert {r for r, _ in got} == {"malformed", "bad time", "missing city"} and sum(r == "malformed" for r, _ in got) == 3
    assert ("malformed", lines[2]) in got and good.count() + bad.count() == len(lines) - 1
    assert all(r["file"].endswith("a.csv") for r in bad.collect())


def test_payload_quarantine(spark, tmp_dir):
    names = API_PAYLOAD_SCHEMA["hourly"].dataType.names
    docs = {"good": {"hourly": {"time": ["2009-01-01T00:00", "2009-01-01T01:00"], names[1]: [1.0, 2.0]}},
            "ragged": {"hourly": {"time": ["2009-01-01T00:00", "2009-01-01T01:00"], names[1]: [1.0]}}, "empty": {"hourly": {"time": []}}}
    for k, d in docs.items():
        with open(os.path.join(tmp_dir, f"{k}.json"), "w") as fh:
            json.dump(d, fh)
    with open(os.path.join(tmp_dir, "broken.json"), "w") as fh:
        fh.write('{"hourly": {"time": ["2009-')
    good, bad = I.read_payload_checked(spark, tmp_dir, API_PAYLOAD_SCHEMA, names)
    assert sorted(os.path.basename(r["file"]) for r in good.collect()) == ["empty.json", "good.json"]
    assert {(os.path.basename(r["file"]), r["reason"]) for r in bad.collect()} == {("ragged.json", f"ragged {names[1]}"), ("broken.json", "malformed")}


def test_manifest_without_a_run(spark, tmp_dir):
    work = spark.createDataFrame([("a", 2009)], "city string, year int")
    assert I.ChunkStore(spark, f"{tmp_dir}/none").manifest(work).count() == 0


def test_per_entity_sink_and_dimension_lines(spark, tmp_dir):
    from chronoframe.sources import readers as RD
    from chronoframe.sources import writers as WR

    df = spark.createDataFrame([(f"c{i % 3}", dt.datetime(2024, 1, 1, i % 24), float(i)) for i in range(60)], "city string, datetime timestamp, v double")
    WR.write_per_entity(df, f"{tmp_dir}/cities", num_partitions=4)
    assert sorted(x for x in os.listdir(f"{tmp_dir}/cities") if x.startswith("city=")) == ["city=c0", "city=c1", "city=c2"]
    back = spark.read.option("header", True).schema("datetime timestamp, v double").csv(f"{tmp_dir}/cities/city=c1")
    assert back.count() == 20
    dim = spark.createDataFrame([("Oslo", "Norway", "Europe", 59.9, 10.7, True, "T", "a}\n{b"), ("Lima", "Peru", "South America", -12.0, -77.0, True, "D", None)],
                                "city string, country string, continent string, latitude double, longitude double, coastal boolean, climate_zone string, note string")
    WR.write_dimension_json(dim.repartition(1), f"{tmp_dir}/dim")
    rows = {r["city"]: r for r in RD.read_dimension_json(spark, f"{tmp_dir}/dim").collect()}
    assert set(rows) == {"Oslo", "Lima"} and rows["Lima"]["country"] == "Peru" and rows["Oslo"]["coastal"] == 1
