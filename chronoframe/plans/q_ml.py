"""Model queries (L1–L10). Model outputs depend on the estimator, so most are rows-only checks (no SQL oracle); their
metrics reuse the oracle-checked M-operators. ``leaf_quantile_scores`` holds L7's quantile step against SQL under stated trees."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chronoframe.functions.rules import alert_level
from chronoframe.functions.scalar import array_argmax
from chronoframe.operators import metrics as M
from chronoframe.operators import ml as ML
from chronoframe.config import PanelSpec
from chronoframe.operators import panel as P
from chronoframe.operators import rollups as R
from chronoframe.operators.encode import encode_columns
from chronoframe.operators.scalars import with_scalars
from chronoframe.operators.splits import split_label
from chronoframe.plans import bindings as B
from chronoframe.plans.catalog import register
from chronoframe.plans.sqlgen import SPLIT_EXPR
from chronoframe.session import ensure_checkpoint_dir

LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "returnflag_id", "linestatus_id",
                 "ship_month", "ship_dow"]
EVENT_FEATURES = ["value", "value_lag_1", "value_lag_2", "value_lag_3", "value_roll_3r_mean", "value_roll_3r_std",
                  "value_roll_24r_mean", "value_roll_24r_std", "hour", "day_of_week", "day_of_year"]
EVENT_VAL_START, EVENT_TEST_START = "2024-01-20", "2024-01-25"


def _lines(spark, sf_dir):
    df = B.lineitem_panel(spark, sf_dir)
    df = encode_columns(df, {"l_returnflag": "returnflag_id", "l_linestatus": "linestatus_id"})
    return df.withColumn("ship_month", F.month("l_shipdate")).withColumn("ship_dow", F.weekday("l_shipdate")) \
             .withColumn("split", split_label(F.year("l_shipdate"), B.SPLIT_TRAIN, B.SPLIT_VAL, B.SPLIT_TEST))


def _events(spark, sf_dir):
    from chronoframe.plans.q_panel import feature_table
    ft = feature_table(spark, sf_dir, keep_ts=True)
    ft = P.next_value_target(ft, B.USER_PANEL, "value", "y", layout="entity").where(F.col("y").isNotNull())
    ts = F.col("ts")
    return ft.withColumn("split", F.when(ts < F.lit(EVENT_VAL_START).cast("timestamp_ntz"), "train")
                         .when(ts < F.lit(EVENT_TEST_START).cast("timestamp_ntz"), "val").otherwise("test"))


@register("gbt_regression_scores")
def gbt_regression_scores(spark, sf_dir):
    """L1 + L2 + L7 + L8: next-value GBT with early stopping on the validation period,
    conformal 80 % interval, scores for every test row."""
    ev = _events(spark, sf_dir)
    fit_df = ev.where(F.col("split") != "test").withColumn("is_val", F.col("split") == "val")
    model = ML.fit_gbt_regressor(fit_df, EVENT_FEATURES, "y", "is_val", max_iter=30, max_depth=4)
    val = ML.score(model, ev.where(F.col("split") == "val"), prob=None)
    test = ML.score(model, ev.where(F.col("split") == "test"), prob=None)
    out = ML.conformal_interval(val, test, "y", "prediction")
    return out.select("event_id", "user_id", "y", F.col("prediction").alias("pred_value"), "pred_q10", "pred_q90")


@register("gbt_classifier_scores")
def gbt_classifier_scores(spark, sf_dir):
    """L3 + L8 (+A11): weighted boosted classifier of the rain label; test-year probabilities."""
    df = _lines(spark, sf_dir)
    train = df.where(F.col("split") == "train")
    bal = R.class_balance(train, "target_rain")
    train = with_scalars(train, bal, ["scale_pos_weight"]) \
                 .withColumn("w", F.when(F.col("target_rain") == 1, F.col("scale_pos_weight")).otherwise(1.0))
    model = ML.fit_gbt_classifier(train, LINE_FEATURES, "target_rain", "w", max_iter=20, max_depth=4)
    s = ML.score(model, df.where(F.col("split") == "test"), positive_prob="p_rain")
    return s.select("l_orderkey", "l_linenumber", "l_partkey", "target_rain", "p_rain",
                    F.col("prediction").cast("int").alias("pred_rain"))


@register("rf_multiclass_scores")
def rf_multiclass_scores(spark, sf_dir):
    """L4 + L8 (+A12, J5, F17, F18): class-weighted random forest over four classes."""
    df = _lines(spark, sf_dir)
    train = df.where(F.col("split") == "train")
    w = R.balanced_class_weights(train, "target_disaster")
    train = R.apply_class_weights(train, "target_disaster", w)
    model = ML.fit_rf_classifier(train, LINE_FEATURES, "target_disaster", "weight", num_trees=20, max_depth=6)
    s = ML.score(model, df.where(F.col("split") == "test"))
    from chronoframe.functions.scalar import confidence_from_entropy, entropy_bits
    return s.select("l_orderkey", "l_linenumber", "l_partkey", "target_disaster",
                    F.col("prediction").cast("int").alias("pred_class"), array_argmax(F.col("prob")).alias("argmax"),
                    entropy_bits(F.col("prob")).alias("entropy"),
                    confidence_from_entropy(entropy_bits(F.col("prob")), 4).alias("confidence"))


SEARCH_CONFIGS = [dict(max_iter=10, max_depth=3, step=0.1), dict(max_iter=20, max_depth=4, step=0.1),
                  dict(max_iter=20, max_depth=5, step=0.05)]


@register("model_search")
def model_search(spark, sf_dir):
    """L5 + M21: configuration grid on the fixed train / validation split, champion flagged."""
    df = _lines(spark, sf_dir)
    res = ML.grid_search(df.where(F.col("split") == "train"), df.where(F.col("split") == "val"), LINE_FEATURES,
                         "target_rain", SEARCH_CONFIGS)
    from chronoframe.operators.metrics import champion
    best = champion(res, "val_f1", minimize=False).select(F.col("config").alias("_best"))
    return with_scalars(res, best).withColumn("champion", F.col("config") == F.col("_best")).drop("_best", "time_sec")


@register("model_importance")
def model_importance(spark, sf_dir):
    """L9 + S15: train, save and reload the model from the shared checkpoint folder, rank features."""
    df = _lines(spark, sf_dir)
    model = ML.fit_rf_classifier(df.where(F.col("split") == "train"), LINE_FEATURES, "target_disaster",
                                 num_trees=20, max_depth=6)
    path = ML.save_model(model, f"{ensure_checkpoint_dir(spark)}/models/rf_disaster")
    return ML.feature_ranking(ML.load_model(path), LINE_FEATURES, top=15)


@register("live_panel")
def live_panel(spark, sf_dir):
    """L10 (+W8, F14): latest row of every entity scored by the classifiers, with an alert level."""
    df = _lines(spark, sf_dir)
    train, _ = ML.fit_input(df.where(F.col("split") == "train"), LINE_FEATURES, None, ["target_rain", "target_disaster"], stored=True)
    rain = ML.fit_gbt_classifier(train, LINE_FEATURES, "target_rain", max_iter=10, max_depth=3, prepared=True)
    disaster = ML.fit_rf_classifier(train, LINE_FEATURES, "target_disaster", num_trees=10, max_depth=5, prepared=True)
    spec = PanelSpec("n_name", "l_shipdate", "l_orderkey")
    latest = P.latest_per_entity(df.select("n_name", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey",
                                           *LINE_FEATURES), spec)
    s1 = ML.score(rain, latest, prob="rain_prob_vec", positive_prob="p_rain").withColumnRenamed("prediction", "pr")
    s2 = ML.score(disaster, s1, prob="class_prob").withColumn("cls", F.col("prediction").cast("int"))
    return s2.select("n_name", "l_shipdate", "l_orderkey", "p_rain", "cls",
                     alert_level(F.col("l_quantity"), F.col("p_rain"), F.element_at("class_prob", 2),
                                 F.col("cls")).alias("alert"))


# ----------------------------------------------------------------------------- L7: conditional quantiles
PRICE_FEATURES = ["l_quantity", "l_discount", "l_tax", "returnflag_id", "linestatus_id", "ship_month", "ship_dow"]
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "row"]


def _priced(spark, sf_dir):
    """Lines with a key of their own: repeated lines are told apart by number."""
    df = _lines(spark, sf_dir)
    alike = W.partitionBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").orderBy("l_shipdate", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return df.withColumn("row", F.row_number().over(alike)).select(*LINE_KEY, (F.col("l_extendedprice") * F.col("l_quantity")).alias("amount"), *PRICE_FEATURES, "split").checkpoint()


def price_intervals(spark, sf_dir):
    """Test rows with the quantiles of the forest (``q10``, ``q50``, ``q90``) and the constant-width interval (``c10``, ``c90``) around its prediction."""
    df = _priced(spark, sf_dir)
    part = {k: df.where(F.col("split") == k) for k in ("train", "val", "test")}
    forest = ML.fit_quantile_forest(part["train"], part["val"], PRICE_FEATURES, "amount", LINE_KEY, num_trees=10, max_depth=6)
    test = forest.score(part["test"], LINE_KEY)
    val = ML.score(forest.model, part["val"], prob=None).select("amount", "prediction")
    both = ML.conformal_interval(val, test, "amount", "prediction")
    return both.withColumnsRenamed({"pred_q10": "c10", "pred_q90": "c90"})


@register("quantile_forest_scores")
def quantile_forest_scores(spark, sf_dir):
    """Quantiles of every test line's amount (price times quantity, so its spread grows with the quantity) from a quantile forest, calibrated on the validation year."""
    return price_intervals(spark, sf_dir).select(*LINE_KEY, "amount", "q10", "q50", "q90")


@register("quantile_forest_metrics")
def quantile_forest_metrics(spark, sf_dir):
    """L7 + M6 + M7: coverage, width and pinball loss of the forest's interval beside the constant-width one."""
    t = price_intervals(spark, sf_dir).checkpoint()
    forest = M.interval_metrics(t, "amount", "q10", "q90").withColumn("interval", F.lit("quantile forest"))
    return forest.unionByName(M.interval_metrics(t, "amount", "c10", "c90").withColumn("interval", F.lit("constant width")))


# Three stated trees over the lines, for the oracle of the quantile step.
_TREES_SQL = ("CASE WHEN l_quantity < 13 THEN 0 WHEN l_quantity < 26 THEN 1 WHEN l_quantity < 39 THEN 2 ELSE 3 END",
              "CASE WHEN l_quantity < 20 THEN CASE WHEN l_discount < 0.05 THEN 0 ELSE 1 END ELSE 2 END",
              "CASE WHEN l_tax < 0.04 THEN 0 WHEN l_quantity < 30 THEN 1 ELSE 2 END")


@register("leaf_quantile_scores", f"""
WITH t AS (SELECT *, {SPLIT_EXPR.format(c="l_shipdate")} AS split, {", ".join(f"{x} AS t{i}" for i, x in enumerate(_TREES_SQL))},
             row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey, l_suppkey ORDER BY l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax) AS row FROM lineitem),
{", ".join(f"g{i} AS (SELECT t{i}, quantile_cont(l_extendedprice, 0.1) AS a, quantile_cont(l_extendedprice, 0.5) AS b, quantile_cont(l_extendedprice, 0.9) AS c FROM t WHERE split = 'train' GROUP BY t{i})" for i in range(3))}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(row AS INTEGER) AS row, round((g0.a + g1.a + g2.a) / 3, 6) AS q10, round((g0.b + g1.b + g2.b) / 3, 6) AS q50, round((g0.c + g1.c + g2.c) / 3, 6) AS q90
FROM t JOIN g0 USING (t0) JOIN g1 USING (t1) JOIN g2 USING (t2) WHERE split = 'test'""")
def leaf_quantile_scores(spark, sf_dir):
    """L7's quantile step under three stated trees: exact quantiles per leaf of the training years, their mean for each test line."""
    df = B.table(spark, sf_dir, "lineitem").withColumn("leaves", F.array(*[F.expr(x).cast("int") for x in _TREES_SQL]))
    df = df.withColumn("split", split_label(F.year("l_shipdate"), B.SPLIT_TRAIN, B.SPLIT_VAL, B.SPLIT_TEST))
    alike = W.partitionBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").orderBy("l_shipdate", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    df = df.withColumn("row", F.row_number().over(alike))
    table = ML.leaf_quantiles(df.where("split = 'train'"), "leaves", "l_extendedprice", [0.1, 0.5, 0.9])
    out = ML.forest_quantiles(df.where("split = 'test'"), "leaves", table, LINE_KEY, ["q10", "q50", "q90"])
    return out.select(*LINE_KEY, *[F.round(c, 6).alias(c) for c in ("q10", "q50", "q90")])


# ----------------------------------------------------------------------------- L3 + L4: boosting for four classes

def boosted_lines(spark, sf_dir, **parameters):
    """Test lines with the four-class probabilities of weighted one-vs-rest boosting, stopped early on the validation year."""
    df = _lines(spark, sf_dir)
    fit_df = df.where(F.col("split").isin("train", "val")).withColumn("is_val", F.col("split") == "val")
    weights = R.balanced_class_weights(fit_df.where("not is_val"), "target_disaster")
    fit_df = R.apply_class_weights(fit_df, "target_disaster", weights)
    model = ML.fit_boosted_classes(fit_df, LINE_FEATURES, "target_disaster", [0, 1, 2, 3], "weight", "is_val", **parameters)
    return model.score(df.where(F.col("split") == "test"))


@register("boosted_class_scores")
def boosted_class_scores(spark, sf_dir):
    """L3 + L4 + L8: four classes by boosting with row weights and early stopping; probabilities of every test line."""
    out = boosted_lines(spark, sf_dir, max_iter=15, max_depth=4)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "target_disaster", F.col("prediction").alias("pred_class"),
                      *[F.col("prob")[k].alias(f"p{k}") for k in range(4)])
