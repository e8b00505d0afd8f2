"""Metric queries (M1–M22, W6, W11, W14, L5-style grids, F14, F17, F18)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chronoframe.config import PanelSpec
from chronoframe.functions.calendar import season_name
from chronoframe.functions.rules import alert_level
from chronoframe.functions.scalar import array_argmax, confidence_from_entropy, entropy_bits, sorted_quantiles
from chronoframe.operators import metrics as M
from chronoframe.operators import panel as P
from chronoframe.operators import rollups as R
from chronoframe.operators.ordered import exact_quantiles
from chronoframe.operators.scalars import with_scalars
from chronoframe.operators.splits import assign_cv_folds, split_label, split_predicate
from chronoframe.plans import bindings as B
from chronoframe.plans.catalog import register
from chronoframe.plans.sqlgen import LINEITEM_LABELS, LINEITEM_PANEL, SEASON_NAMES_SQL, SPLIT_EXPR, rsig, season_sql

CANDIDATES = [(1, "persistence", 1), (2, "moving_mean_2", 2), (3, "moving_mean_3", 3), (4, "moving_mean_5", 5)]


# ----------------------------------------------------------------- shared plans

def order_predictions(spark, sf_dir, splits=None):
    """Next-order value target (within customer and split, Q3) with simple predictors.

    ``pred`` = persistence (W14), ``ma{k}`` = trailing k-row means.
    The window is partitioned by split, so other splits never influence a
    split's rows: with ``splits`` the scan reads only those date ranges
    (range predicates pushed into Parquet).
    """
    o = B.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    if splits:
        o = o.where(split_predicate(o, "o_orderdate", splits, B.SPLIT_TRAIN, B.SPLIT_VAL, B.SPLIT_TEST))
    o = o.withColumn("split", split_label(F.year("o_orderdate"), B.SPLIT_TRAIN, B.SPLIT_VAL, B.SPLIT_TEST)) \
         .withColumn("_ent", F.struct("o_custkey", "split"))
    spec = PanelSpec("_ent", "o_orderdate", "o_orderkey")
    f = P.panel_features(o, spec, layout="entity",
                         leads={"y": ("o_totalprice", 1)},
                         windows={f"ma{k}": ("o_totalprice", k) for _, _, k in CANDIDATES if k > 1})
    return f.drop("_ent").withColumn("pred", F.col("o_totalprice"))


_W = "PARTITION BY o_custkey, split ORDER BY o_orderdate, o_orderkey"
ORDER_PRED_CTE = f"""
op AS (SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice, {SPLIT_EXPR.format(c="o_orderdate")} AS split FROM orders),
pr AS (SELECT *, o_totalprice AS pred, lead(o_totalprice) OVER ({_W}) AS y,
  {", ".join(f"avg(o_totalprice) OVER ({_W} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW) AS ma{k}"
             for _, _, k in CANDIDATES if k > 1)}
  FROM op)"""


def _test(df):
    return df.where((F.col("split") == "test") & F.col("y").isNotNull())


def _reg_sql(pred: str, where: str, group: str | None = None) -> str:
    e = f"({pred} - y)"
    g = f"{group}, " if group else ""
    return f"""SELECT {g}count(*) AS n, sqrt(avg({e} * {e})) AS rmse, avg(abs({e})) AS mae,
  CASE WHEN count(*) * var_pop(y) > 0 THEN 1 - sum({e} * {e}) / (count(*) * var_pop(y)) END AS r2,
  avg(CASE WHEN abs(y) > 1 THEN abs({e} / y) END) * 100 AS mape_pct
FROM pr WHERE {where} {"GROUP BY " + group if group else ""}"""


_TEST = "split = 'test' AND y IS NOT NULL"


@register("regression_metrics", rsig(f"WITH {ORDER_PRED_CTE} {_reg_sql('pred', _TEST)}",
                                     ["rmse", "mae", "r2", "mape_pct"]))
def regression_metrics(spark, sf_dir):
    """M1 + M2 (+W6, W14): persistence forecast of the next order value on the test years."""
    return M.regression_metrics(_test(order_predictions(spark, sf_dir, ["test"])), "y", "pred")


def _grouped_sql(group_expr: str, group: str, rows_name: str, join: str = "") -> str:
    e = "(pred - y)"
    return rsig(f"""WITH {ORDER_PRED_CTE},
g AS (SELECT pr.*, {group_expr} AS {group} FROM pr {join} WHERE {_TEST}),
m AS (SELECT {group}, count(*) AS n, sqrt(avg({e} * {e})) AS rmse, avg(abs({e})) AS mae,
  CASE WHEN count(*) * var_pop(y) > 0 THEN 1 - sum({e} * {e}) / (count(*) * var_pop(y)) END AS r2 FROM g GROUP BY {group})
SELECT {group}, n AS {rows_name}, round_even(rmse, 3) AS rmse, round_even(mae, 3) AS mae, round_even(r2, 4) AS r2
FROM m WHERE n >= 10""", ["rmse", "mae", "r2"])


@register("regression_by_entity", _grouped_sql("c_nationkey", "c_nationkey", "test_rows",
                                               "JOIN customer ON pr.o_custkey = c_custkey"))
def regression_by_entity(spark, sf_dir):
    """M3 (+P13, O2): per-entity RMSE / MAE / R² for groups with at least 10 rows."""
    t = _test(order_predictions(spark, sf_dir, ["test"]))
    c = B.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    t = t.join(c, t.o_custkey == c.c_custkey)
    return M.grouped_regression_table(t, "y", "pred", "c_nationkey").orderBy("rmse", "c_nationkey")


@register("regression_by_season", _grouped_sql(
    f"{SEASON_NAMES_SQL}[{season_sql('month(o_orderdate)')} + 1]", "season_name", "rows"))
def regression_by_season(spark, sf_dir):
    """M4: per-season regression table."""
    t = _test(order_predictions(spark, sf_dir, ["test"])).withColumn("season_name", season_name(F.month("o_orderdate")))
    return M.grouped_regression_table(t, "y", "pred", "season_name", rows_name="rows")


@register("interval_metrics", rsig(f"""
WITH {ORDER_PRED_CTE},
q AS (SELECT quantile_cont(y - pred, 0.1) AS q10, quantile_cont(y - pred, 0.9) AS q90 FROM pr
      WHERE split = 'val' AND y IS NOT NULL),
t AS (SELECT y, least(pred + q10, pred + q90) AS lo, greatest(pred + q10, pred + q90) AS hi FROM pr, q WHERE {_TEST})
SELECT count(*) AS n, avg(CAST(y >= lo AND y <= hi AS DOUBLE)) AS coverage, avg(hi - lo) AS avg_width,
  avg(greatest(CAST(0.1 AS DOUBLE) * (y - lo), CAST(-0.9 AS DOUBLE) * (y - lo))) AS pinball_lo,
  avg(greatest(CAST(0.9 AS DOUBLE) * (y - hi), CAST(-0.09999999999999998 AS DOUBLE) * (y - hi))) AS pinball_hi,
  CAST(0.8 AS DOUBLE) AS target_coverage, avg(CAST(y >= lo AND y <= hi AS DOUBLE)) - CAST(0.8 AS DOUBLE) AS coverage_gap
FROM t""", ["coverage", "avg_width", "pinball_lo", "pinball_hi", "target_coverage", "coverage_gap"]))
def interval_metrics(spark, sf_dir):
    """L7(a) + M6 + M7: split-conformal 80 % interval from validation residuals, scored on test."""
    pr = order_predictions(spark, sf_dir, ["val", "test"])
    val = pr.where((F.col("split") == "val") & F.col("y").isNotNull()).withColumn("resid", F.col("y") - F.col("pred"))
    q = exact_quantiles(val, "resid", [0.1, 0.9], names=["rq10", "rq90"])
    t = with_scalars(_test(pr), q)
    lo, hi = sorted_quantiles(F.col("pred") + F.col("rq10"), F.col("pred") + F.col("rq90"))
    t = t.withColumn("lo", lo).withColumn("hi", hi)
    return M.interval_metrics(t, "y", "lo", "hi")


@register("model_improvement", rsig(f"""
WITH {ORDER_PRED_CTE},
m AS (SELECT sqrt(avg((ma3 - y) * (ma3 - y))) AS model_rmse, avg(abs(ma3 - y)) AS model_mae,
             sqrt(avg((pred - y) * (pred - y))) AS baseline_rmse, avg(abs(pred - y)) AS baseline_mae FROM pr WHERE {_TEST})
SELECT *, (baseline_rmse - model_rmse) / baseline_rmse * 100 AS rmse_improvement_pct,
  (baseline_mae - model_mae) / baseline_mae * 100 AS mae_improvement_pct FROM m""",
    ["model_rmse", "model_mae", "baseline_rmse", "baseline_mae", "rmse_improvement_pct", "mae_improvement_pct"]))
def model_improvement(spark, sf_dir):
    """M5: improvement of a 3-row moving mean over persistence."""
    return M.improvement_of(_test(order_predictions(spark, sf_dir, ["test"])), "y", "ma3", "pred")


def _erfc_sql(x: str) -> str:
    """2/√π times the integral of exp(-t²) from x on, by Simpson's rule (independent of the Spark side's formula)."""
    n, width = 4000, 10.0
    f = f"exp(-pow(abs({x}) + {width / n!r} * k, 2))"
    total = (f"(SELECT sum(CASE WHEN k = 0 OR k = {n} THEN 1.0 WHEN k % 2 = 1 THEN 4.0 ELSE 2.0 END * {f}) "
             f"* {width / n / 3!r} * 2 / sqrt(pi()) FROM range({n + 1}) g(k))")
    return f"(CASE WHEN {x} >= 0 THEN {total} ELSE 2.0 - {total} END)"


@register("wilcoxon", rsig(f"""
WITH {ORDER_PRED_CTE},
d AS (SELECT abs(y - ma3) - abs(y - pred) AS d FROM pr WHERE {_TEST}),
c AS (SELECT abs(d) AS ad, count(*) AS n, sum(CAST(d > 0 AS BIGINT)) AS pos, sum(CAST(d < 0 AS BIGINT)) AS neg
      FROM d WHERE d IS NOT NULL AND d <> 0 GROUP BY abs(d)),
r AS (SELECT *, coalesce(sum(n) OVER (ORDER BY ad ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                + (n + 1) / 2.0 AS avg_rank FROM c),
s AS (SELECT sum(n) AS n, sum(pos * avg_rank) AS w_plus, sum(neg * avg_rank) AS w_minus, sum(n * n * n - n) AS ties FROM r),
z AS (SELECT *, least(w_plus, w_minus) AS statistic,
  (least(w_plus, w_minus) - CAST(n AS DOUBLE) * (n + 1) / 4)
    / sqrt(CAST(n AS DOUBLE) * (n + 1) * (2 * CAST(n AS DOUBLE) + 1) / 24 - ties / 48) AS z FROM s)
SELECT CAST(n AS BIGINT) AS n, w_plus, w_minus, statistic, z, least({_erfc_sql("abs(z) / sqrt(2.0)")}, 1.0) AS p_value
FROM z""", ["w_plus", "w_minus", "statistic", "z", "p_value"]))
def wilcoxon(spark, sf_dir):
    """M8: Wilcoxon signed-rank test of moving-mean vs persistence absolute errors."""
    t = _test(order_predictions(spark, sf_dir, ["test"])).select(
        F.abs(F.col("y") - F.col("ma3")).alias("err_model"), F.abs(F.col("y") - F.col("pred")).alias("err_base"))
    return M.wilcoxon_signed_rank(t, "err_model", "err_base").drop("exact")


_CHANGES = """
c AS (SELECT user_id, event_type, abs(value - lag(value, 1) OVER w) AS e1, abs(value - lag(value, 2) OVER w) AS e2 FROM events
      WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id))"""


@register("wilcoxon_by_entity", rsig(f"""
WITH RECURSIVE {_CHANGES},
d AS (SELECT user_id, event_type, e1 - e2 AS d FROM c WHERE e1 - e2 IS NOT NULL),
r AS (SELECT *, rank() OVER (PARTITION BY user_id, event_type ORDER BY abs(d)) + (count(*) OVER (PARTITION BY user_id, event_type, abs(d)) - 1) / 2.0 AS rk,
             count(*) OVER (PARTITION BY user_id, event_type, abs(d)) AS alike FROM d WHERE d <> 0),
z AS (SELECT user_id, event_type, count_if(d = 0) AS zeros FROM d GROUP BY ALL),
s AS (SELECT z.user_id, z.event_type, any_value(zeros) AS zeros, count(d) AS n, coalesce(sum(rk) FILTER (WHERE d > 0), 0) AS w_plus, coalesce(sum(rk) FILTER (WHERE d < 0), 0) AS w_minus,
             coalesce(sum(CAST(alike AS DOUBLE) * alike - 1), 0) AS ties FROM z LEFT JOIN r ON z.user_id = r.user_id AND z.event_type = r.event_type GROUP BY 1, 2),
dist(k, c) AS (SELECT 0, [1.0::DOUBLE] UNION ALL
  SELECT k + 1, list_transform(range(1, len(c) + k + 2), lambda i: (CASE WHEN i <= len(c) THEN c[i] ELSE 0 END) + (CASE WHEN i > k + 1 THEN c[i - k - 1] ELSE 0 END)) FROM dist WHERE k < 50),
t AS (SELECT *, least(w_plus, w_minus) AS statistic, CAST(n AS DOUBLE) * (n + 1) * (2 * n + 1) / 24 - ties / 48 AS var, n BETWEEN 1 AND 50 AND zeros = 0 AND ties = 0 AS exact FROM s),
u AS (SELECT *, CASE WHEN var > 0 THEN (statistic - CAST(n AS DOUBLE) * (n + 1) / 4) / sqrt(var) END AS z FROM t)
SELECT user_id, event_type, CAST(n AS BIGINT) AS n, w_plus, w_minus, statistic, z, exact,
  least(CASE WHEN exact THEN 2 * list_sum(c[1:CAST(floor(statistic) AS INTEGER) + 1]) / pow(2.0, n) ELSE {_erfc_sql("abs(z) / sqrt(2.0)")} END, 1.0) AS p_value
FROM u LEFT JOIN dist ON k = n""", ["w_plus", "w_minus", "statistic", "z", "p_value"]))
def wilcoxon_by_entity(spark, sf_dir):
    """M8 on small groups: persistence against the value before it, per user and event type; exact where the group allows it."""
    w = W.partitionBy("user_id", "event_type").orderBy("ts", "event_id")
    ev = B.table(spark, sf_dir, "events").select("user_id", "event_type", F.abs(F.col("value") - F.lag("value", 1).over(w)).alias("e1"),
                                                 F.abs(F.col("value") - F.lag("value", 2).over(w)).alias("e2"))
    return M.wilcoxon_signed_rank(ev, "e1", "e2", ["user_id", "event_type"])


def _grid_sql() -> str:
    parts = []
    for cfg, name, k in CANDIDATES:
        col = "pred" if k == 1 else f"ma{k}"
        parts.append(f"SELECT {cfg} AS config, '{name}' AS predictor, {k} AS window_rows, "
                     f"sqrt(avg(({col} - y) * ({col} - y))) AS val_rmse, avg(abs({col} - y)) AS val_mae "
                     f"FROM pr WHERE split = 'val' AND y IS NOT NULL")
    return " UNION ALL ".join(parts)


def _grid(spark, sf_dir):
    v = order_predictions(spark, sf_dir, ["val"]).where((F.col("split") == "val") & F.col("y").isNotNull())
    aggs = []
    for cfg, name, k in CANDIDATES:
        col = F.col("pred") if k == 1 else F.col(f"ma{k}")
        e = col - F.col("y")
        aggs += [F.sqrt(F.avg(e * e)).alias(f"rmse_{cfg}"), F.avg(F.abs(e)).alias(f"mae_{cfg}")]
    one = v.agg(*aggs)  # every candidate in one pass
    items = [F.struct(F.lit(cfg).alias("config"), F.lit(name).alias("predictor"), F.lit(k).alias("window_rows"),
                      F.col(f"rmse_{cfg}").alias("val_rmse"), F.col(f"mae_{cfg}").alias("val_mae"))
             for cfg, name, k in CANDIDATES]
    return one.select(F.explode(F.array(*items)).alias("r")).select("r.*")


@register("search_results", rsig(f"WITH {ORDER_PRED_CTE} {_grid_sql()}", ["val_rmse", "val_mae"]))
def search_results(spark, sf_dir):
    """L5-style grid: candidate predictors scored on the fixed validation split."""
    return _grid(spark, sf_dir)


@register("champion_selection", rsig(f"""
WITH {ORDER_PRED_CTE}, g AS ({_grid_sql()})
SELECT * FROM g ORDER BY val_rmse, config LIMIT 1""", ["val_rmse", "val_mae"]))
def champion_selection(spark, sf_dir):
    """The best configuration (lowest RMSE, first config wins ties)."""
    return M.champion(_grid(spark, sf_dir), "val_rmse")


@register("cv_summary", rsig(f"""
WITH {ORDER_PRED_CTE},
i AS (SELECT pred, y, row_number() OVER (ORDER BY o_custkey, o_orderdate, o_orderkey) - 1 AS row_idx,
             count(*) OVER () AS n FROM pr WHERE y IS NOT NULL),
f AS (SELECT pred, y, CASE WHEN row_idx < n - 5 * floor(n / 6) THEN -1
                           ELSE floor((row_idx - (n - 5 * floor(n / 6))) / floor(n / 6)) END AS fold FROM i),
r AS (SELECT fold, sqrt(avg((pred - y) * (pred - y))) AS rmse FROM f WHERE fold >= 0 GROUP BY fold)
SELECT avg(rmse) AS rmse_mean, stddev_pop(rmse) AS rmse_std, count(*) AS folds FROM r""", ["rmse_mean", "rmse_std"]))
def cv_summary(spark, sf_dir):
    """W11 + L6 + A31: per-fold RMSE of persistence on expanding-window test blocks; mean and std (ddof=0)."""
    pr = order_predictions(spark, sf_dir).where(F.col("y").isNotNull())
    f = assign_cv_folds(pr, ["o_custkey", "o_orderdate", "o_orderkey"], k=5).where(F.col("test_fold") >= 0)
    per_fold = M.regression_metrics(f, "y", "pred", ["test_fold"])
    return R.fold_summary(per_fold, "rmse")


# ----------------------------------------------------------------- binary (events)

_EV = f"""ev AS (SELECT event_id, user_id, ts, CAST(event_type = '{B.EVENT_POSITIVE}' AS INTEGER) AS y,
  least(value / {B.EVENT_SCORE_SCALE!r}, 1.0) AS p FROM events)"""
_EPS = 2.220446049250313e-16


def _auc_sql(src: str, group: str | None = None) -> str:
    g = f"{group}, " if group else ""
    part = f"PARTITION BY {group} " if group else ""
    return f"""c AS (SELECT {g}p, sum(y) AS pos, sum(1 - y) AS neg FROM {src} GROUP BY {g}p),
r AS (SELECT *, coalesce(sum(neg) OVER ({part}ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM c),
a AS (SELECT {g}CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) END AS auc
      FROM r {"GROUP BY " + group if group else ""})"""


def _bin_counts_sql(src: str, group: str | None = None) -> str:
    g = f"{group}, " if group else ""
    return f"""m AS (SELECT {g}count(*) AS n, count_if(y = 1 AND p > 0.5) AS tp, count_if(y = 0 AND p > 0.5) AS fp,
  count_if(y = 1 AND NOT p > 0.5) AS fn, count_if(y = 0 AND NOT p > 0.5) AS tn,
  avg((p - y) * (p - y)) AS brier,
  -avg(CASE WHEN y = 1 THEN ln(least(greatest(p, {_EPS!r}), {1 - _EPS!r}))
            ELSE ln(1.0 - least(greatest(p, {_EPS!r}), {1 - _EPS!r})) END) AS log_loss
  FROM {src} {"GROUP BY " + group if group else ""})"""


_PRF_SQL = """CAST(n AS BIGINT) AS n, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn,
  CAST(tn AS BIGINT) AS tn, (tp + tn) / n AS accuracy,
  CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
  CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1"""


@register("binary_metrics", rsig(f"""
WITH {_EV}, {_auc_sql("ev")}, {_bin_counts_sql("ev")}
SELECT {_PRF_SQL}, brier, log_loss, auc FROM m, a""",
    ["accuracy", "precision", "recall", "f1", "brier", "log_loss", "auc"]))
def binary_metrics(spark, sf_dir):
    """M9 + M10 + M11: threshold metrics, ROC-AUC, Brier score and log-loss."""
    return M.binary_metrics(B.event_scores(spark, sf_dir), "y", "p")


@register("classification_by_entity", rsig(f"""
WITH {_EV}, {_auc_sql("ev", "user_id")}, {_bin_counts_sql("ev", "user_id")}
SELECT m.user_id, CAST(n AS BIGINT) AS test_rows, round_even((tp + fn) / n * 100, 2) AS pos_pct,
  round_even(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END, 4) AS f1,
  round_even(auc, 4) AS auc, round_even(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END, 4) AS recall
FROM m LEFT JOIN a ON m.user_id = a.user_id WHERE n >= 10 AND tp + fn > 0""", ["pos_pct", "f1", "auc", "recall"]))
def classification_by_entity(spark, sf_dir):
    """M19 (+P13): per-entity positive %, F1, AUC and recall; groups ≥ 10 rows with positives."""
    return M.per_group_classification(B.event_scores(spark, sf_dir), "y", "p", "user_id")


@register("roc_curve", rsig(f"""
WITH {_EV},
c AS (SELECT p AS threshold, sum(y) AS pos, sum(1 - y) AS neg FROM ev GROUP BY p),
r AS (SELECT *, sum(pos) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
               sum(neg) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
               sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM c)
SELECT threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CASE WHEN N > 0 THEN fp / N END AS fpr,
  CASE WHEN P > 0 THEN tp / P END AS tpr FROM r""", ["threshold", "fpr", "tpr"]))
def roc_curve(spark, sf_dir):
    """ROC points for every distinct score."""
    return M.roc_curve(B.event_scores(spark, sf_dir), "y", "p")


def _calib_bin_sql(p: str) -> str:
    return " + ".join(f"CAST({e!r} < {p} AS INTEGER)" for e in M.calibration_edges(10))


@register("calibration_curve", rsig(f"""
WITH {_EV}
SELECT {_calib_bin_sql("p")} AS bin, count(*) AS n, avg(p) AS mean_predicted, avg(CAST(y AS DOUBLE)) AS fraction_positive
FROM ev WHERE p IS NOT NULL GROUP BY 1""", ["mean_predicted", "fraction_positive"]))
def calibration_curve(spark, sf_dir):
    """10-bin calibration curve."""
    return M.calibration_curve(B.event_scores(spark, sf_dir), "y", "p", 10)


@register("confusion_binary", f"""
WITH {_EV}, c AS (SELECT y AS actual, CAST(p > 0.5 AS INTEGER) AS predicted, count(*) AS n FROM ev GROUP BY 1, 2)
SELECT a.actual, b.predicted, CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM (VALUES (0), (1)) a(actual) CROSS JOIN (VALUES (0), (1)) b(predicted)
LEFT JOIN c ON c.actual = a.actual AND c.predicted = b.predicted""")
def confusion_binary(spark, sf_dir):
    """Binary confusion matrix with zero cells."""
    s = B.event_scores(spark, sf_dir).withColumn("pred", (F.col("p") > 0.5).cast("int"))
    return M.confusion_matrix(s, "y", "pred", [0, 1])


@register("mcnemar", rsig(f"""
WITH {_EV},
c AS (SELECT count_if((p > 0.5) = (y = 1) AND y = 0) AS n11, count_if((p > 0.5) = (y = 1) AND y <> 0) AS n01,
             count_if((p > 0.5) <> (y = 1) AND y = 0) AS n10, count_if((p > 0.5) <> (y = 1) AND y <> 0) AS n00 FROM ev),
x AS (SELECT *, CASE WHEN n01 + n10 > 0 THEN (abs(n01 - n10) - 1) * (abs(n01 - n10) - 1) / (n01 + n10) ELSE 0.0 END AS chi2 FROM c)
SELECT CAST(n11 AS BIGINT) AS n11, CAST(n01 AS BIGINT) AS n01, CAST(n10 AS BIGINT) AS n10, CAST(n00 AS BIGINT) AS n00, chi2,
  CASE WHEN n01 + n10 > 0 THEN {_erfc_sql("sqrt(chi2 / 2)")} ELSE 1.0 END AS p_value,
  CASE WHEN n01 + n10 > 0 THEN {_erfc_sql("sqrt(chi2 / 2)")} ELSE 1.0 END < 0.01 AS significant_at_0_01
FROM x""", ["chi2", "p_value"]))
def mcnemar(spark, sf_dir):
    """McNemar test of the thresholded score against the always-negative baseline."""
    s = B.event_scores(spark, sf_dir).withColumn("pred", (F.col("p") > 0.5).cast("int")).withColumn("base", F.lit(0))
    return M.mcnemar(s, "y", "pred", "base")


@register("majority_baseline", rsig(f"""
WITH {_EV},
tr AS (SELECT * FROM ev WHERE ts < TIMESTAMP '{B.EVENT_TRAIN_END}'),
te AS (SELECT * FROM ev WHERE NOT ts < TIMESTAMP '{B.EVENT_TRAIN_END}'),
mj AS (SELECT y AS majority FROM tr GROUP BY y ORDER BY count(*) DESC, y LIMIT 1),
pr AS (SELECT avg(CAST(y AS DOUBLE)) AS prior FROM tr),
m AS (SELECT count(*) AS n, count_if(y = 1 AND majority = 1) AS tp, count_if(y = 0 AND majority = 1) AS fp,
             count_if(y = 1 AND majority = 0) AS fn, count_if(y = 0 AND majority = 0) AS tn FROM te, mj)
SELECT CAST(majority AS INTEGER) AS majority, prior, CAST(n AS BIGINT) AS n, (tp + tn) / n AS accuracy,
  CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
  CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1
FROM mj, pr, m""", ["prior", "accuracy", "precision", "recall", "f1"]))
def majority_baseline(spark, sf_dir):
    """A13 + M20: majority class learned on the early period, scored on the late period."""
    s = B.event_scores(spark, sf_dir)
    cut = F.lit(B.EVENT_TRAIN_END).cast("timestamp_ntz")
    return M.majority_baseline(s.where(F.col("ts") < cut), s.where(~(F.col("ts") < cut)), "y")


# ----------------------------------------------------------------- multi-class (lineitem)

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]


def line_classes(spark, sf_dir, with_nation: bool = False, with_previous: bool = True):
    """Truth = rule class of the line; prediction = class of the previous line of the order (0 for the first).

    The supplier → nation join is added only for reports by nation, the
    prediction's window (``with_previous``) only for those that use it.
    """
    from chronoframe.config import FeatureSpec
    base = B.lineitem_panel(spark, sf_dir) if with_nation else B.lineitem_labels(spark, sf_dir)
    df = B.line_probabilities(base).withColumn("actual", F.col("target_disaster"))
    if not with_previous:
        return df
    df = df.withColumn("_line_tb", F.struct(*LINE_ORDER[1:]))
    spec = PanelSpec("l_orderkey", LINE_ORDER[0], "_line_tb")
    lag = FeatureSpec(variables=("target_disaster",), lags=(1,), windows={}, lag_suffix="")
    df = P.panel_features(df, spec, lag, layout="entity")
    return df.withColumn("predicted", F.coalesce(F.col("target_disaster_lag_1"), F.lit(0)).cast("int")) \
             .drop("_line_tb", "target_disaster_lag_1")


_PROB = " + ".join(f"{c} / {s!r}" for c, s in zip(B.LINE_PROB_COLS, B.LINE_PROB_SCALE))
_LINE_CLASSES_BODY = f"""
lc AS (SELECT *, target_disaster AS actual,
  CAST(coalesce(lag(target_disaster) OVER (PARTITION BY l_orderkey ORDER BY {", ".join(LINE_ORDER)}), 0) AS INTEGER) AS predicted,
  {", ".join(f"({c} / {s!r}) / ({_PROB}) AS p{i}" for i, (c, s) in enumerate(zip(B.LINE_PROB_COLS, B.LINE_PROB_SCALE)))}
  FROM lab),
cells AS (SELECT actual, predicted, count(*) AS c FROM lc GROUP BY actual, predicted),
pc AS (SELECT label, sum(tp) AS tp, sum(sup) AS support, sum(prd) AS predicted FROM (
    SELECT actual AS label, CASE WHEN actual = predicted THEN c ELSE 0 END AS tp, c AS sup, 0 AS prd FROM cells
    UNION ALL SELECT predicted AS label, 0 AS tp, 0 AS sup, c AS prd FROM cells) GROUP BY label),
prf AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
  CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall,
  CASE WHEN support + predicted > 0 THEN 2 * tp / (support + predicted) ELSE 0.0 END AS f1 FROM pc)"""
LINE_CLASSES_CTE = f"""{LINEITEM_LABELS},{_LINE_CLASSES_BODY}"""
LINE_CLASSES_NATION_CTE = f"""{LINEITEM_PANEL},{_LINE_CLASSES_BODY}"""


@register("multiclass_metrics", rsig(f"""
WITH {LINE_CLASSES_CTE}
SELECT CAST(sum(support) AS BIGINT) AS n, sum(tp) / sum(support) AS accuracy,
  sum(f1 * support) / sum(support) AS weighted_f1, avg(f1) AS macro_f1 FROM prf""",
    ["accuracy", "weighted_f1", "macro_f1"]))
def multiclass_metrics(spark, sf_dir):
    """Accuracy, weighted and macro F1."""
    return M.multiclass_metrics(line_classes(spark, sf_dir), "actual", "predicted")


@register("confusion_multiclass", f"""
WITH {LINE_CLASSES_CTE}
SELECT CAST(a.k AS INTEGER) AS actual, CAST(b.k AS INTEGER) AS predicted, CAST(coalesce(c, 0) AS BIGINT) AS count
FROM range(4) a(k) CROSS JOIN range(4) b(k) LEFT JOIN cells ON cells.actual = a.k AND cells.predicted = b.k""")
def confusion_multiclass(spark, sf_dir):
    """4×4 confusion matrix with all labels."""
    return M.confusion_matrix(line_classes(spark, sf_dir), "actual", "predicted", [0, 1, 2, 3])


@register("classification_report", rsig(f"""
WITH {LINE_CLASSES_CTE}
SELECT CAST(label AS VARCHAR) AS row, precision, recall, f1, CAST(support AS BIGINT) AS support FROM prf
UNION ALL SELECT 'accuracy', NULL, NULL, sum(tp) / sum(support), CAST(sum(support) AS BIGINT) FROM prf
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM prf
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
  sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM prf""", ["precision", "recall", "f1"]))
def classification_report(spark, sf_dir):
    """Per-class precision / recall / F1 / support and the three summary rows."""
    return M.classification_report(line_classes(spark, sf_dir), "actual", "predicted")


@register("ovr_auc", rsig(f"""
WITH {LINE_CLASSES_CTE},
l AS ({" UNION ALL ".join(f"SELECT {k} AS cls, p{k} AS p, CAST(target_disaster = {k} AS INTEGER) AS y FROM lc"
                          for k in range(4))}),
{_auc_sql("l", "cls")}
SELECT CAST(cls AS INTEGER) AS cls, auc FROM a""", ["auc"]))
def ovr_auc(spark, sf_dir):
    """M14 (+F21): one-vs-rest AUC per class from the probability vector."""
    return M.one_vs_rest_auc(line_classes(spark, sf_dir, with_previous=False), "actual", "prob", 4)


def _argmax_sql() -> str:
    return ("CASE WHEN p0 >= p1 AND p0 >= p2 AND p0 >= p3 THEN 0 WHEN p1 >= p2 AND p1 >= p3 THEN 1 "
            "WHEN p2 >= p3 THEN 2 ELSE 3 END")


@register("entropy_report", rsig(f"""
WITH {LINE_CLASSES_CTE},
e AS (SELECT -((((0.0 + p0 * log2(p0 + 1e-10)) + p1 * log2(p1 + 1e-10)) + p2 * log2(p2 + 1e-10)) + p3 * log2(p3 + 1e-10)) AS h,
             {_argmax_sql()} AS arg, actual FROM lc)
SELECT avg(h) AS mean_entropy, avg(1.0 - h / 2.0) AS mean_confidence,
  avg(CASE WHEN arg = actual THEN 1.0 - h / 2.0 END) AS confidence_when_correct,
  avg(CASE WHEN arg <> actual THEN 1.0 - h / 2.0 END) AS confidence_when_wrong,
  CAST(count_if(arg = actual) AS BIGINT) AS correct, count(*) AS n FROM e""",
    ["mean_entropy", "mean_confidence", "confidence_when_correct", "confidence_when_wrong"]))
def entropy_report(spark, sf_dir):
    """F17 + F18 + M22 (+A30): entropy / confidence of the class probabilities, split by correctness."""
    df = line_classes(spark, sf_dir, with_previous=False)
    h = entropy_bits(F.col("prob"))
    df = df.withColumn("entropy", h).withColumn("confidence", confidence_from_entropy(F.col("entropy"), 4)) \
           .withColumn("arg", array_argmax(F.col("prob")))
    return M.entropy_report(df, "entropy", "confidence", F.col("arg") == F.col("actual"))


@register("multiclass_by_entity", rsig(f"""
WITH {LINE_CLASSES_NATION_CTE},
cells2 AS (SELECT n_name, actual, predicted, count(*) AS c FROM lc GROUP BY n_name, actual, predicted),
pc2 AS (SELECT n_name, label, sum(tp) AS tp, sum(sup) AS support, sum(prd) AS predicted FROM (
    SELECT n_name, actual AS label, CASE WHEN actual = predicted THEN c ELSE 0 END AS tp, c AS sup, 0 AS prd FROM cells2
    UNION ALL SELECT n_name, predicted AS label, 0 AS tp, 0 AS sup, c AS prd FROM cells2) GROUP BY n_name, label),
f2 AS (SELECT *, CASE WHEN support + predicted > 0 THEN 2 * tp / (support + predicted) ELSE 0.0 END AS f1 FROM pc2),
m AS (SELECT n_name, sum(support) AS n, sum(tp) / sum(support) AS accuracy, sum(f1 * support) / sum(support) AS wf1
      FROM f2 GROUP BY n_name)
SELECT n_name, CAST(n AS BIGINT) AS rows, round_even(wf1, 4) AS weighted_f1, round_even(accuracy, 4) AS accuracy
FROM m WHERE n >= 10""", ["weighted_f1", "accuracy"]))
def multiclass_by_entity(spark, sf_dir):
    """M19 (multi-class): per-entity weighted F1 and accuracy, groups ≥ 10 rows."""
    m = M.multiclass_metrics(line_classes(spark, sf_dir, with_nation=True), "actual", "predicted", ["n_name"])
    return m.where(F.col("n") >= 10).select("n_name", F.col("n").alias("rows"),
                                            F.bround("weighted_f1", 4).alias("weighted_f1"),
                                            F.bround("accuracy", 4).alias("accuracy"))


@register("alert_levels", f"""
WITH {LINE_CLASSES_CTE},
a AS (SELECT CASE WHEN {_argmax_sql()} = 3 OR p2 > 0.8 THEN 'RED'
                  WHEN {_argmax_sql()} = 1 OR p1 > 0.7 OR l_quantity > 42 THEN 'ORANGE'
                  WHEN {_argmax_sql()} = 2 OR p2 > 0.5 THEN 'YELLOW' ELSE 'GREEN' END AS alert FROM lc)
SELECT alert, count(*) AS count FROM a GROUP BY alert""")
def alert_levels(spark, sf_dir):
    """F14 (+F17): alert level per row from value, class probabilities and arg-max class."""
    df = line_classes(spark, sf_dir, with_previous=False).withColumn("arg", array_argmax(F.col("prob")))
    lvl = alert_level(F.col("l_quantity"), F.element_at("prob", 3), F.element_at("prob", 2), F.col("arg"))
    return df.groupBy(lvl.alias("alert")).agg(F.count(F.lit(1)).alias("count"))


@register("residual_histogram", rsig(f"""
WITH {ORDER_PRED_CTE},
t AS (SELECT y - pred AS resid FROM pr WHERE {_TEST}),
r AS (SELECT min(resid) AS lo, max(resid) AS hi, (max(resid) - min(resid)) / 30 AS w FROM t),
b AS (SELECT CAST(CASE WHEN w > 0 THEN least(floor((resid - lo) / w), 29) ELSE 0 END AS INTEGER) AS bin FROM t, r),
cnt AS (SELECT bin, count(*) AS c FROM b GROUP BY bin)
SELECT CAST(g.bin AS INTEGER) AS bin, lo + g.bin * w AS bin_lo, lo + (g.bin + 1) * w AS bin_hi,
  CAST(coalesce(c, 0) AS BIGINT) AS count, coalesce(c, 0) / (sum(coalesce(c, 0)) OVER () * w) AS density
FROM range(30) g(bin) CROSS JOIN r LEFT JOIN cnt ON cnt.bin = g.bin""", ["bin_lo", "bin_hi", "density"]))
def residual_histogram(spark, sf_dir):
    """P12 + A28: residual distribution of the test-period forecast (30 equal-width bins)."""
    from chronoframe.operators.profile import histogram
    t = _test(order_predictions(spark, sf_dir, ["test"])).withColumn("resid", F.col("y") - F.col("pred"))
    return histogram(t, "resid", 30)
