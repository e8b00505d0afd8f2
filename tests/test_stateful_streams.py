"""T1–T4 with state: equal to batch, late rows, idle entities, restart after a failure, the idempotent sink."""

import datetime as dt

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from chronoframe.config import FeatureSpec, PanelSpec
from chronoframe.operators import panel as P
from chronoframe.streaming import runs as R
from chronoframe.streaming.stateful import stream_panel_features, trailing_features

SPEC = PanelSpec("who", "ts", "k")
FS = FeatureSpec(variables=("a", "b"), lags=(1, 3), windows={"2r": 2, "5r": 5}, lag_suffix="")
SCHEMA = "who string, ts timestamp, k long, a double, b double"


def hour(h):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)


def feats(spark, path, delay="3 hours", idle=None):
    return stream_panel_features(spark.readStream.schema(SCHEMA).parquet(path), SPEC, FS, delay, idle)


def run(spark, tmp_dir, *slices, sink=None, **kw):
    """Each slice lands and is processed before the next; the rows the sink holds."""
    src, out = f"{tmp_dir}/in", R.BatchFolders(f"{tmp_dir}/out")
    for rows in slices:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        made = feats(spark, src, **kw)
        R.run_to_end(made, sink or out, f"{tmp_dir}/checkpoint")
    return out.read(spark, made.schema)


def panel(n, who=("x", "y", None)):
    rng = np.random.default_rng(n)
    return [(who[i % len(who)], hour(i), i, None if i % 7 == 0 else float(rng.integers(0, 9)), float(rng.normal(1e6, 1))) for i in range(n)]


def batch(spark, rows, upto):
    df = spark.createDataFrame(rows, SCHEMA)
    return P.panel_features(df, SPEC, FS).where(F.col("ts") <= F.lit(upto))


def same(a, b):
    cols = [c for c in b.columns]
    key = lambda r: (str(r["who"]), r["k"])
    x, y = sorted(a.select(cols).collect(), key=key), sorted(b.collect(), key=key)
    assert len(x) == len(y)
    for p, q in zip(x, y):
        for c in cols:
            assert p[c] == q[c] or p[c] is not None and q[c] is not None and abs(p[c] - q[c]) < 1e-6 * max(1, abs(q[c])), (c, p, q)


def test_features_equal_batch_out_of_order(spark, tmp_dir):
    rows = panel(60)
    shuffled = [rows[i] for i in np.argsort([i + 2.5 * ((i * 7) % 3) / 2 for i in range(60)], kind="stable")]     # up to 2.5 hours late
    got = run(spark, tmp_dir, shuffled[:20], shuffled[20:41], shuffled[41:])
    same(got, batch(spark, rows, hour(59 - 3)))


def test_late_rows_are_dropped_and_ties_kept(spark, tmp_dir):
    rows = [("x", hour(i), i, float(i), 0.0) for i in range(12)] + [("x", hour(11), 100, 50.0, 0.0)]
    late = ("x", hour(2), 999, 9.0, 9.0)
    end = ("x", hour(30), 12, 12.0, 0.0)
    got = run(spark, tmp_dir, rows, [late, ("x", None, 7, 1.0, 1.0), end])
    same(got, batch(spark, rows, hour(12)))
    assert got.where("k = 999 or ts is null").count() == 0


def test_idle_entities_start_anew(spark, tmp_dir):
    gap = [("x", hour(h), h, float(h), 1.0) for h in (0, 1, 2, 40, 41)]
    busy = [("y", hour(h), h, float(h), 1.0) for h in range(0, 60, 2)]
    one = run(spark, f"{tmp_dir}/one", gap[:3] + busy[:10], busy[10:20], gap[3:] + busy[20:], idle=12 * 3600)      # forgotten, then back
    other = run(spark, f"{tmp_dir}/other", gap + busy, idle=12 * 3600)                                            # all in one micro-batch
    same(one, other)
    x = {r["k"]: r for r in one.where("who = 'x'").collect()}
    assert x[2]["a_lag_1"] == 1.0 and x[40]["a_lag_1"] is None and x[41]["a_lag_1"] == 40.0 and x[40]["a_roll_5r_mean"] == 40.0
    kept = run(spark, f"{tmp_dir}/kept", gap + busy)
    assert {r["k"]: r["a_lag_1"] for r in kept.where("who = 'x'").collect()}[40] == 2.0


class Breaks:
    """Writes a batch, then fails once: the process dies between the sink's write and Spark's commit."""

    def __init__(self, sink, at):
        self.sink, self.at = sink, at

    def __call__(self, rows, batch_id):
        self.sink(rows, batch_id)
        if batch_id == self.at:
            self.at = None
            raise RuntimeError("killed")


def test_killed_and_restarted_equals_one_run(spark, tmp_dir):
    rows = panel(40)
    whole = run(spark, f"{tmp_dir}/whole", rows[:15], rows[15:])
    src, out = f"{tmp_dir}/in", R.BatchFolders(f"{tmp_dir}/out")
    breaks = Breaks(out, 1)
    failures = 0
    for part in (rows[:15], rows[15:]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        while True:
            made = feats(spark, src)
            try:
                R.run_to_end(made, breaks, f"{tmp_dir}/checkpoint")
                break
            except Exception as e:  # noqa: BLE001
                assert "killed" in str(e)
                failures += 1
    assert failures == 1
    got = out.read(spark, made.schema)
    assert got.count() == whole.count() > 20 and got.exceptAll(whole).count() == 0


def test_sink_replaces_a_batch(spark, tmp_dir):
    sink = R.BatchFolders(f"{tmp_dir}/sink")
    df = spark.range(5)
    assert sink.read(spark, df.schema).collect() == []
    sink(df, 0)
    sink(df.where("id > 1"), 0)
    sink(df.where("id = 0"), 1)
    assert sorted(r["id"] for r in sink.read(spark, df.schema).collect()) == [0, 2, 3, 4]


def test_arrival_slices_hold_every_row_and_keep_the_delay(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "ts")
    parts = [p.select("event_id", F.col("ts").cast("timestamp").cast("double").alias("t")).collect() for p in R.arrival_slices(ev, "ts", F.col("event_id"), 7200, 5)]
    assert sorted(r["event_id"] for p in parts for r in p) == sorted(r["event_id"] for r in ev.collect())
    latest = 0.0
    for p in parts:
        assert p and min(r["t"] for r in p) > latest - 7200
        latest = max(latest, max(r["t"] for r in p))
    none = ev.where("event_id < 0")
    assert [p.count() for p in R.arrival_slices(none, "ts", F.col("event_id"), 7200, 5)] == [0]


def test_empty_stream(spark, tmp_dir):
    assert run(spark, tmp_dir, []).collect() == []


@pytest.mark.parametrize("n", [1, 2, 7])
def test_trailing_features_plain(n):
    rng = np.random.default_rng(n)
    x = np.where(rng.random(50) < 0.3, np.nan, rng.normal(0, 1, 50))[:, None]
    start = np.maximum.accumulate(np.where(np.arange(50) % 17 == 0, np.arange(50), 0))
    got = trailing_features(x, start, 10, FeatureSpec(variables=("v",), lags=(2,), windows={"w": n}, lag_suffix=""))
    for j, i in enumerate(range(10, 50)):
        w = x[max(start[i], i - n + 1):i + 1, 0]
        w = w[~np.isnan(w)]
        assert np.isclose(got["v_roll_w_mean"][j], w.mean() if len(w) else np.nan, equal_nan=True)
        assert np.isclose(got["v_roll_w_std"][j], w.std(ddof=1) if len(w) > 1 else np.nan, equal_nan=True)
        assert np.isclose(got["v_lag_2"][j], x[i - 2, 0] if i - 2 >= start[i] else np.nan, equal_nan=True)
