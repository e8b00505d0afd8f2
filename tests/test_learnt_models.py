"""L7 quantile forest and four-class boosting: the quantile step against plain Python, coverage, and the held comparison."""

import numpy as np
import pytest
from conftest import SF, SF01
from pyspark.sql import functions as F

from chronoframe.operators import metrics as M
from chronoframe.operators import ml as ML
from chronoframe.operators import rollups as R
from chronoframe.operators.encode import encode_columns
from chronoframe.plans import q_ml


def test_leaf_and_forest_quantiles_equal_plain(spark):
    rng = np.random.default_rng(5)
    train = [(int(i), [int(rng.integers(0, 3)), int(rng.integers(0, 2))], float(rng.normal(0, 5))) for i in range(200)] + [(900, [0, 0], None)]
    test = [(0, [0, 1], None), (1, [2, 0], None), (2, [7, 1], None), (3, [7, 9], None)]          # a leaf, and a row, without training rows
    schema = "id int, leaves array<int>, y double"
    probs = [0.9, 0.1, 0.5]
    table = ML.leaf_quantiles(spark.createDataFrame(train, schema).repartition(3), "leaves", "y", probs)
    got = {r["id"]: [r["a"], r["b"], r["c"]] for r in ML.forest_quantiles(spark.createDataFrame(test, schema), "leaves", table, ["id"], ["a", "b", "c"]).collect()}
    for i, leaves, _ in test:
        each = []
        for tree, leaf in enumerate(leaves):
            own = [y for _, ls, y in train if ls[tree] == leaf and y is not None]
            if own:
                each.append(np.quantile(own, probs))
        want = sorted(np.mean(each, axis=0)) if each else [None] * 3
        assert got[i] == want or np.allclose(got[i], want), i


def test_forest_intervals_vary_cover_and_beat_the_constant_width(spark):
    t = q_ml.price_intervals(spark, SF01).checkpoint()
    assert t.count() == t.select(*q_ml.LINE_KEY).distinct().count() > 10_000
    assert t.where("not (q10 <= q50 and q50 <= q90)").count() == 0
    width = t.select(F.stddev(F.col("q90") - F.col("q10")) / F.avg(F.col("q90") - F.col("q10"))).first()[0]
    assert width > 0.2
    forest, constant = (M.interval_metrics(t, "amount", lo, hi).first() for lo, hi in (("q10", "q90"), ("c10", "c90")))
    assert abs(forest["coverage"] - 0.80) <= 0.03
    assert forest["pinball_lo"] < constant["pinball_lo"] and forest["pinball_hi"] < constant["pinball_hi"]


@pytest.fixture(scope="module")
def boosted(spark):
    return q_ml.boosted_class_scores(spark, SF01).checkpoint()


def test_boosting_beats_the_forest(spark, boosted):
    forest = q_ml.rf_multiclass_scores(spark, SF01)
    ours, theirs = (M.multiclass_metrics(x, "target_disaster", "pred_class").first()["macro_f1"] for x in (boosted, forest))
    assert ours > theirs
    off = boosted.where(F.abs(F.col("p0") + F.col("p1") + F.col("p2") + F.col("p3") - 1) > 1e-9).count()
    assert off == 0


def test_boosting_is_deterministic_and_stops_early(spark):
    rows = spark.range(600).select((F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"), (F.col("id") % 3).cast("int").alias("y"),
                                   (F.col("id") % 4 == 0).alias("val"), F.lit(1.0).alias("w"))
    models = [ML.fit_boosted_classes(rows, ["a", "b"], "y", [0, 1, 2], "w", "val", max_iter=12, max_depth=2) for _ in range(2)]
    first, again = (sorted(map(str, m.score(rows).select("a", "b", "prob", "prediction").distinct().collect())) for m in models)
    assert first == again and all(len(m.stages[-1].trees) < 12 for m in models[0].models)


def test_large_fits_read_stored_rows_in_bounded_partitions(spark, monkeypatch):
    """more rows than FIT_ROWS come stored, with the fit's columns alone, and classes whose rows are many are fitted one at a time."""
    monkeypatch.setattr(ML, "FIT_ROWS", 200)
    monkeypatch.setattr(ML, "SIDE_BY_SIDE_ROWS", 1500)
    df = spark.range(1000).coalesce(1).select("id", (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 3).cast("int").alias("y"), F.lit("unused").alias("z"))
    rows, n = ML.fit_input(df, ["x"], "y")
    sizes = rows.groupBy(F.spark_partition_id()).count().collect()
    assert n == 1000 and rows.columns == ["x", "y"] and len(sizes) == 5 and max(r["count"] for r in sizes) <= 250
    pools = []
    original = ML.ThreadPoolExecutor

    def pool(size):
        pools.append(size)
        return original(size)
    monkeypatch.setattr(ML, "ThreadPoolExecutor", pool)
    model = ML.fit_boosted_classes(df, ["x"], "y", [0, 1, 2], max_iter=1, max_depth=1)
    assert pools == [1] and model.score(df).count() == 1000


def test_class_weights_do_not_deal_rows_by_class(spark):
    """the weights are broadcast whatever Spark thinks of their size, else the rows of a class meet in one task."""
    df = spark.range(100).select("id", (F.col("id") % 3).cast("int").alias("y"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = R.apply_class_weights(df, "y", R.balanced_class_weights(df, "y"))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert out.where("weight is null").count() == 0 and out.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_live_panel_stores_its_training_rows_once(spark, monkeypatch):
    """both classifiers fit on the same stored rows."""
    asked = []
    original = ML.fit_input
    monkeypatch.setattr(ML, "fit_input", lambda *a, **k: asked.append(1) or original(*a, **k))
    out = q_ml.live_panel(spark, SF).collect()
    assert len(asked) == 1 and out and all(r["p_rain"] is not None and r["alert"] is not None for r in out)


def test_a_search_stores_its_training_rows_once(spark, monkeypatch):
    """the rows that every configuration reads are dealt and stored once, not once more for each fit."""
    monkeypatch.setattr(ML, "FIT_ROWS", 200)
    df = spark.range(1000).select((F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 2).cast("int").alias("y"))
    dealt = []
    original = type(df).repartition
    monkeypatch.setattr(type(df), "repartition", lambda self, *a: dealt.append(a) or original(self, *a))
    out = ML.grid_search(df, df.limit(300), ["x"], "y", [dict(max_iter=1, max_depth=1), dict(max_iter=2, max_depth=1)])
    assert dealt == [(5,)] and out.count() == 2


def test_codes_of_several_columns_are_fitted_in_one_pass(spark):
    """finding the values of the columns and the number of rows reads the table once."""
    read = spark.sparkContext.accumulator(0)

    def seen(i):
        read.add(1)
        return (i, "ab"[i % 2] if i % 5 else None, "xyz"[i % 3])
    df = spark.createDataFrame(spark.sparkContext.range(60, numSlices=2).map(seen), "id long, a string, b string")
    out = encode_columns(df, {"a": "a_id", "b": "b_id"})
    assert read.value == 60
    got = {r["id"]: (r["a_id"], r["b_id"]) for r in out.collect()}
    assert got == {i: (i % 2 if i % 5 else -1, i % 3) for i in range(60)}


def test_shared_growth_scores_as_mllib_and_reads_the_rows_once_for_all(spark, monkeypatch):
    """the models of many rows grow side by side on binned rows, keep MLlib's class and follow its trees."""
    from pyspark.ml.classification import GBTClassificationModel

    from chronoframe.operators import boosting as G
    rng = np.random.default_rng(3)
    rows = [(float(a), float(b), float(c), int((a > 0.3) ^ (b > 5) ^ (rng.random() < 0.05)), float(1 + (a > 0))) for a, b, c in zip(rng.normal(0, 1, 3000), rng.integers(0, 9, 3000), rng.normal(0, 9, 3000))]
    df = spark.createDataFrame(rows, "a double, b double, c double, y int, w double").repartition(3).checkpoint()
    configs = [dict(max_iter=7, max_depth=3, subsample=1.0), dict(max_iter=3, max_depth=5, subsample=1.0, min_instances=40)]
    monkeypatch.setattr(ML, "FIT_ROWS", 700)
    seen, original = [], G._read
    monkeypatch.setattr(G, "_read", lambda blocks, models, base: seen.append(len(models)) or original(blocks, models, base))
    found = ML._grown(df, ["a", "b", "c"], "y", [1], "w", None, configs, binary=True)
    assert seen == [2] * 21                                          # as many readings as the larger model has levels
    for (model, _), cfg in zip(found, configs):
        assert isinstance(model.stages[-1], GBTClassificationModel) and len(model.stages[-1].trees) == cfg["max_iter"]
        theirs = ML.fit_gbt_classifier(df, ["a", "b", "c"], "y", "w", **cfg)
        p, q = ([r["p"] for r in ML.score(m, df, positive_prob="p").select("p").collect()] for m in (model, theirs))
        assert np.corrcoef(p, q)[0, 1] > 0.99 and np.mean(np.abs(np.array(p) - q)) < 0.02


def test_margins_of_blocks_are_the_models(spark, monkeypatch):
    """what the blocks add up (stored margins and codes) is what the finished model predicts; large tables keep no row as an object."""
    from chronoframe.operators import boosting as G
    monkeypatch.setattr(G, "REFRESH", 2)
    df = spark.range(2000).select((F.col("id") % 97).cast("double").alias("x"), (F.col("id") % 5).cast("double").alias("z"), ((F.col("id") % 97 > 40) & (F.col("id") % 5 < 3)).cast("int").alias("y"),
                                  (F.col("id") % 4 == 0).alias("val"))
    blocks = G.binned(df, ["x", "z"], F.col("y"), None, "val", 300)
    assert blocks.rows == 2000 and max(r["n"] for r in blocks.frame.select("n").collect()) <= 300
    m = G.grow(blocks, [G.Model(1, max_iter=6, max_depth=6, step=0.3, tol=-1.0)], True)[0]
    java = G.as_model(spark, m, blocks.borders)
    reader = G._Reader(blocks.bins, blocks.packs)
    trees = reader.ready(m, 0, len(m.trees))
    assert len(m.trees) == 6 and len({len(t.leaves()) for t in m.trees}) >= 1 and max(len(t.leaves()) for t in m.trees) > 2
    scored = ML.assembler(["x", "z"]).transform(df).select("features", "x", "z").distinct()
    for r in java.transform(scored).collect():
        bins = [int(np.searchsorted(b, v)) for b, v in zip(blocks.borders, (r["x"], r["z"]))]
        codes = []
        for p in blocks.packs:
            code = 0
            for f in p:
                code = code * blocks.bins[f] + bins[f]
            codes.append(np.array([code], np.uint16))
        assert abs(float(np.ravel(reader.margin(trees, codes))[0]) - r["rawPrediction"][1]) < 1e-9
