"""Layout equivalence, pandas cross-checks and hot-key skew for the ordered primitives."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chronoframe.config import FeatureSpec, PanelSpec
from chronoframe.operators import panel as P
from chronoframe.operators.ordered import exact_quantiles, global_row_index, running_sum
from tests.conftest import SF01


def _events_with_gaps(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    # fixture only: NULLs and duplicate keys injected so fill / dedup paths are exercised
    base = ev.withColumn("value", F.when(F.col("event_id") % 7 == 0, None).otherwise(F.col("value"))) \
             .withColumn("ord", F.lit(0))
    dups = ev.where(F.col("event_id") % 5 == 0).withColumn("value", F.col("value") + 1000).withColumn("ord", F.lit(1))
    return base.unionByName(dups)


FS = FeatureSpec(variables=("value",), lags=(1, 24), windows={"s": 3, "l": 24}, lag_suffix="")


def _rounded(df, cols):
    return df.select(*[F.round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])


def test_chunked_equals_entity_layout(spark):
    src = _events_with_gaps(spark)
    spec = PanelSpec("user_id", "ts", "event_id")
    kw = dict(fill_cols=["value"], dedup_ordinal="ord", leads={"nxt": ("value", 2)}, windows={"ma": ("value", 5)})
    a = P.panel_features(src, spec, FS, layout="entity", **kw)
    feats = P.feature_names(FS) + ["value", "nxt", "ma"]
    for chunk in (24, 25, 100):
        b = P.panel_features(src, spec, FS, layout="chunked", chunk_rows=chunk, **kw)
        ra, rb = _rounded(a, feats), _rounded(b, feats)
        assert ra.count() == rb.count() == 10000
        assert ra.exceptAll(rb).count() == 0 and rb.exceptAll(ra).count() == 0


def test_entity_layout_matches_pandas(spark):
    src = _events_with_gaps(spark).where("ord = 0")
    out = P.panel_features(src, PanelSpec("event_type", "ts", "event_id"), FS, fill_cols=["value"]).toPandas()
    pdf = src.toPandas().sort_values(["event_type", "ts", "event_id"])
    g = pdf.groupby("event_type")["value"]
    pdf["value"] = g.transform(lambda s: s.ffill().bfill())
    g = pdf.groupby("event_type")["value"]
    pdf["value_lag_24"] = g.shift(24)
    pdf["value_roll_l_mean"] = g.transform(lambda s: s.rolling(24, min_periods=1).mean())
    pdf["value_roll_l_std"] = g.transform(lambda s: s.rolling(24, min_periods=1).std())
    m = out.merge(pdf, on="event_id", suffixes=("", "_pd"))
    for c in ("value", "value_lag_24", "value_roll_l_mean", "value_roll_l_std"):
        np.testing.assert_allclose(m[c].astype(float), m[f"{c}_pd"].astype(float), rtol=1e-9, equal_nan=True)


def _hot_key_frame(spark, n=20000):
    # one key holds ~2/3 of the rows
    return spark.range(n).select(F.when(F.col("id") % 3 == 0, F.col("id") % 11).otherwise(F.lit(99)).alias("g"),
                                 (F.col("id") * 7919 % 1000).cast("double").alias("v"), F.col("id"))


def test_running_sum_hot_key(spark):
    df = _hot_key_frame(spark).withColumn("one", F.lit(1))
    got = running_sum(df, ["v", "id"], ["one"], ["g"], num_partitions=16)
    ref = df.withColumn("want", F.sum("one").over(W.partitionBy("g").orderBy("v", "id")
                                                  .rowsBetween(W.unboundedPreceding, 0)))
    j = got.join(ref.select("id", "want"), "id")
    assert j.where(F.col("cum_one") != F.col("want")).count() == 0


def test_exact_quantiles_hot_key(spark):
    df = _hot_key_frame(spark)
    got = {r.g: (r.q25, r.q50, r.q90) for r in exact_quantiles(df, "v", [0.25, 0.5, 0.9], ["g"]).collect()}
    pdf = df.toPandas()
    for g, s in pdf.groupby("g")["v"]:
        np.testing.assert_allclose(got[g], np.quantile(s.to_numpy(), [0.25, 0.5, 0.9]), rtol=1e-12)


def test_global_row_index_dense(spark):
    df = _hot_key_frame(spark)
    idx = global_row_index(df, ["v", "id"], ["g"], num_partitions=16)
    agg = idx.groupBy("g").agg(F.min("row_idx").alias("a"), F.max("row_idx").alias("b"), F.count("*").alias("n"),
                               F.countDistinct("row_idx").alias("d")).collect()
    assert all(r.a == 0 and r.b == r.n - 1 and r.d == r.n for r in agg)


def test_positions_split_hot_entity_over_tasks(spark):
    """The chunked layout's largest window partition is bounded by chunk + halo, whatever the skew."""
    df = _hot_key_frame(spark).withColumn("t", F.timestamp_seconds(F.col("id") * 60))
    out = P.panel_features(df, PanelSpec("g", "t", "id"), FeatureSpec(variables=("v",), lags=(1,), windows={}),
                           layout="chunked", chunk_rows=1000)
    assert out.count() == 20000
    ref = P.panel_features(df, PanelSpec("g", "t", "id"), FeatureSpec(variables=("v",), lags=(1,), windows={}))
    assert out.exceptAll(ref).count() == 0


def test_exact_quantiles_refinement_levels(spark):
    """Force several sketch-narrowing levels (tiny bracket budget, coarse sketch): still exact."""
    df = _hot_key_frame(spark)
    probs = [0.0, 0.1, 0.5, 0.75, 1.0]
    got = {r.g: tuple(r[1:]) for r in exact_quantiles(df, "v", probs, ["g"], max_bracket=40, accuracy=200).collect()}
    pdf = df.toPandas()
    for g, s in pdf.groupby("g")["v"]:
        np.testing.assert_allclose(got[g], np.quantile(s.to_numpy(), probs), rtol=1e-12)
    one = exact_quantiles(df, "v", probs, max_bracket=40, accuracy=200).first()
    np.testing.assert_allclose(tuple(one), np.quantile(pdf.v.to_numpy(), probs), rtol=1e-12)


def test_block_rolling_equals_frames(spark):
    """Windows merged from blocks: NULLs, a constant run and a large offset, in both layouts."""
    src = _events_with_gaps(spark).withColumn("value", F.when(F.col("event_type") == "click", F.lit(7.25))
                                              .when(F.col("event_type") == "view", F.col("value") + 1e6).otherwise(F.col("value")))
    spec = PanelSpec("event_type", "ts", "event_id")
    fs = FeatureSpec(variables=("value",), lags=(2,), windows={"a": 2, "b": 24, "c": 168}, lag_suffix="")
    for fill in ([], ["value"]):
        ref = P.panel_features(src, spec, fs, fill_cols=fill, dedup_ordinal="ord", layout="entity", rolling="frame")
        for layout, kw in (("entity", {}), ("chunked", dict(chunk_rows=500))):
            got = P.panel_features(src, spec, fs, fill_cols=fill, dedup_ordinal="ord", layout=layout, rolling="blocks", **kw)
            j = ref.alias("a").join(got.alias("b"), "event_id")
            for c in P.feature_names(fs):
                bad = j.where((F.col(f"a.{c}").isNull() != F.col(f"b.{c}").isNull()) |
                              (F.abs(F.col(f"a.{c}") - F.col(f"b.{c}")) > 1e-7 * F.greatest(F.abs(F.col(f"a.{c}")), F.lit(1.0))))
                assert bad.count() == 0, (layout, c)


def _odd_panel(spark):
    """NULL entity, NULL times, an ordinal that disagrees with the tie-break, one day with most rows."""
    rows = [("a", k // 40, k, 100 - k, float(k % 7)) for k in range(200)]
    rows += [("a", 2, 500 + k, 50 - k, None) for k in range(3)]
    rows += [(None, k, 1000 + k, k, float(k)) for k in range(40)]
    rows += [("b", None, 2000 + k, k, float(k)) for k in range(8)] + [("b", 1, 3000, 2, 1.0), ("b", 1, 3001, 1, 2.0)]
    df = spark.createDataFrame(rows, "e string, day int, id long, ord int, v double")
    return df.withColumn("t", F.timestamp_seconds(F.col("day") * 86400))


def test_layouts_give_one_answer_on_odd_rows(spark):
    fs = FeatureSpec(variables=("v",), lags=(1, 3), windows={"w": 4}, lag_suffix="")
    spec = PanelSpec("e", "t", "id")
    df = _odd_panel(spark)
    for ordinal in (None, "ord"):
        kw = dict(fs=fs, fill_cols=["v"], dedup_ordinal=ordinal, leads={"nx": ("v", 1)})
        a = P.panel_features(df, spec, layout="entity", **kw)
        for chunk in (4, 25, 1000):
            b = P.panel_features(df, spec, layout="chunked", chunk_rows=chunk, **kw)
            cols = [c for c in a.columns if not c.endswith("_std")]
            assert a.count() == b.count()
            assert a.select(cols).exceptAll(b.select(cols)).count() == 0, (ordinal, chunk)
        if ordinal:
            kept = {r.id for r in b.where("e = 'b' and t is not null").collect()}
            assert kept == {3001} and b.where("e is null").count() == 40 and b.where("t is null").count() == 8


def test_chunked_tasks_hold_a_chunk_and_its_halo(spark):
    """One (entity, day) slice far above ``chunk_rows``: no window partition of the feature stage exceeds chunk + halo."""
    df = spark.range(20000).select(F.lit("hot").alias("e"), F.lit(0).cast("timestamp").alias("t"), F.col("id"), F.rand(1).alias("v"))
    chunk, halo = 500, 3
    pos = P.panel_positions(df, PanelSpec("e", "t", "id")).withColumn("c", F.floor(F.col("_cf_pos") / chunk))
    sizes = [r["count"] for r in pos.groupBy("c").count().collect()]
    assert max(sizes) == chunk and len(sizes) == 40
    fs = FeatureSpec(variables=("v",), lags=(halo,), windows={}, lag_suffix="")
    out = P.panel_features(df, PanelSpec("e", "t", "id"), fs, layout="chunked", chunk_rows=chunk)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "_cf_chunk" in plan and out.count() == 20000
    assert out.where("id >= 3 and v_lag_3 is null").count() == 0


def test_quantiles_of_few_values_are_not_narrowed(spark):
    df = spark.range(30000).select((F.col("id") % 11).cast("double").alias("v"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"))
    seen = []
    original = type(df).checkpoint

    def counted(self, *a, **k):
        seen.append(1)
        return original(self, *a, **k)
    type(df).checkpoint = counted
    try:
        got = {r.g: tuple(r[1:]) for r in exact_quantiles(df, "v", [0.25, 0.5], ["g"], max_bracket=100).collect()}
    finally:
        type(df).checkpoint = original
    assert len(seen) == 1 and len(got) == 3
    pdf = df.toPandas()
    for g, s in pdf.groupby("g", dropna=False)["v"]:
        np.testing.assert_allclose(got[None if g != g else int(g)], np.quantile(s.to_numpy(), [0.25, 0.5]))


def test_bracket_filter_stands_below_the_distinct_aggregate(spark):
    df = spark.range(5000).select(F.col("id").cast("double").alias("v"))
    plan = exact_quantiles(df, "v", [0.5], max_bracket=100, accuracy=200)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    distinct = next(k for k, line in enumerate(plan) if "Aggregate" in line and "_v" in line.split("],")[0] and "count(1)" in line)
    assert any("Filter" in line and ">=" in line for line in plan[distinct + 1:])


def test_many_groups_of_values_are_narrowed_by_counted_cells(spark):
    """Groups whose distinct values together are many are narrowed without a sketch per group; ties, infinities and a NULL group."""
    rng = np.random.default_rng(6)
    rows = [(int(g) if g else None, float(v)) for g, v in zip(rng.integers(0, 6, 4000), rng.normal(0, 1, 4000))]
    rows += [(7, 2.0)] * 900 + [(8, float("inf"))] * 3 + [(8, float("-inf"))] + [(8, 1.0)] * 3
    df = spark.createDataFrame(rows, "g int, v double").repartition(4)
    probs = [0.1, 0.5, 0.9]
    out = exact_quantiles(df, "v", probs, ["g"], max_bracket=1000)       # no group alone has as many
    got = {r.g: tuple(r[1:]) for r in out.collect()}
    assert len(got) == 8
    for g in {r[0] for r in rows} - {8}:
        np.testing.assert_allclose(got[g], np.quantile([v for h, v in rows if h == g], probs), rtol=1e-12)
    assert got[8][1] == 1.0
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile_approx" not in plan and ">=" in plan


def test_codes_of_few_values_do_not_deal_the_rows_by_them(spark, monkeypatch):
    """many rows keep their partitions when a column of three values is encoded."""
    from chronoframe.operators import encode
    from chronoframe.operators.encode import encode_columns
    monkeypatch.setattr(encode, "MANY_ROWS", 1000)
    df = spark.range(3000).select("id", (F.col("id") % 3).cast("string").alias("c"))
    plan = encode_columns(df, {"c": "c_id"})._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_chunked_blocks_deal_rows_once_and_store_nothing(spark, monkeypatch):
    """fill, lags and windows across the borders of range partitions; no position, no copy of the rows in the checkpoint folder."""
    rng = np.random.default_rng(9)
    rows = []
    for e, n in ((None, 30), (1, 700), (2, 1), (3, 90), (4, 5), (5, 400)):
        for k in range(n):
            v = None if (e == 1 and 50 <= k < 500) or (e == 3 and k < 80) or e == 4 or (e == 5 and k < 399) or rng.random() < 0.2 else float(rng.normal(5, 2))
            rows.append((e, k // 9 if k else None, len(rows), v, float(k % 4) if k % 3 else None, f"r{len(rows)}"))
    df = spark.createDataFrame(rows, "e long, day int, id long, v double, u double, z string").repartition(3)
    df = df.withColumn("t", F.timestamp_seconds(F.col("day") * 86400)).drop("day")
    fs = FeatureSpec(variables=("v", "u"), lags=(1, 11), windows={"a": 2, "b": 12}, lag_suffix="")
    stored, original = [], type(df).checkpoint
    monkeypatch.setattr(type(df), "checkpoint", lambda self, *a, **k: stored.append(1) or original(self, *a, **k))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for fill, layouts in (([], [(7, 11)]), (["u", "v", "z"], [(1, 11), (24, 25)])):
            ref = _rounded(P.panel_features(df, PanelSpec("e", "t", "id"), fs, fill, layout="entity"), P.feature_names(fs))
            want = sorted(map(str, ref.collect()))
            for parts, chunk in layouts:
                spark.conf.set("spark.sql.shuffle.partitions", parts)
                out = P.panel_features(df, PanelSpec("e", "t", ("id",)), fs, fill, layout="chunked", chunk_rows=chunk, rolling="blocks")
                plan = out._jdf.queryExecution().executedPlan().toString()
                assert sorted(map(str, _rounded(out, P.feature_names(fs)).collect())) == want, (fill, parts, chunk)
                assert "Exchange" not in plan and not stored
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
