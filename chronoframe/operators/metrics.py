"""Distributed evaluation metrics.

Every metric takes ``(df, truth, prediction|probability, group_cols=())``
and returns a DataFrame, so overall, per-entity and per-season tables share
one code path (a ``groupBy`` instead of a Python loop over masks).
Rank-based metrics (AUC, ROC, Wilcoxon) collapse to distinct scores first
and use :mod:`chronoframe.operators.ordered` for their prefix sums, so no
group is ever sorted in a single task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoframe.config import INTERVAL_TARGET_COVERAGE, MIN_GROUP_ROWS
from chronoframe.operators.ordered import ranked_ties, running_sum
from chronoframe.operators.scalars import join_null_safe, with_scalars

__all__ = [
    "erfc", "regression_metrics", "grouped_regression_table", "improvement", "interval_metrics",
    "wilcoxon_signed_rank", "binary_counts", "binary_metrics", "roc_auc", "roc_curve",
    "calibration_curve", "calibration_edges", "confusion_matrix", "multiclass_metrics",
    "one_vs_rest_auc", "classification_report", "mcnemar", "majority_baseline",
    "per_group_classification", "champion", "entropy_report", "probability_columns",
]


def erfc(x: Column) -> Column:
    """Complementary error function as a Spark expression (Spark has no ``erfc``), to double precision.

    Up to 2 the series ``erf(z) = 2 z exp(-z²) / √π · Σ (2z²)ⁿ / (2n+1)!!``,
    beyond it the continued fraction of the tail (relative error stays small
    where ``1 - erf`` would cancel). Meant for one-row results: p-values.
    """
    z = F.abs(x).cast("double")
    t = 2 * z * z
    series = F.aggregate(F.sequence(F.lit(45), F.lit(1), F.lit(-1)), F.lit(1.0).cast("double"),
                         lambda acc, n: 1.0 + t / (2 * n + 1) * acc)
    near = 1.0 - 2.0 / math.sqrt(math.pi) * z * F.exp(-z * z) * series
    wide = F.greatest(t, F.lit(1e-300))
    fraction = F.aggregate(F.sequence(F.lit(90), F.lit(1), F.lit(-1)), F.lit(1.0).cast("double"),
                           lambda acc, n: 1.0 + n / wide / acc)
    far = F.exp(-z * z) / (F.greatest(z, F.lit(1e-300)) * math.sqrt(math.pi) * fraction)
    tail = F.when(z <= 2.0, near).otherwise(far)
    return F.when(x >= 0, tail).otherwise(F.lit(2.0) - tail)


# ---------------------------------------------------------------- regression

def regression_metrics(df: DataFrame, y: str, pred: str, group_cols: Sequence[str] = (),
                       mape_min_abs: float = 1.0) -> DataFrame:
    """M1 + M2: n, RMSE, MAE, R² (NULL when SST = 0), MAPE % over ``|y| > mape_min_abs``."""
    e = F.col(pred) - F.col(y)
    g = df.where(F.col(y).isNotNull() & F.col(pred).isNotNull())
    mask = F.abs(F.col(y)) > F.lit(mape_min_abs)
    aggs = [F.count(F.lit(1)).cast("long").alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"),
            F.avg(F.abs(e)).alias("mae"), F.sum(e * e).alias("_sse"), F.var_pop(F.col(y)).alias("_vy"),
            (F.avg(F.when(mask, F.abs(e / F.col(y)))) * 100).alias("mape_pct")]
    a = g.groupBy(*group_cols).agg(*aggs) if group_cols else g.agg(*aggs)
    sst = F.col("n") * F.col("_vy")
    return a.withColumn("r2", F.when(sst > 0, F.lit(1.0) - F.col("_sse") / sst)).drop("_sse", "_vy") \
            .select(*group_cols, "n", "rmse", "mae", "r2", "mape_pct")


def grouped_regression_table(df: DataFrame, y: str, pred: str, group_col: str,
                             min_rows: int = MIN_GROUP_ROWS, rows_name: str = "test_rows") -> DataFrame:
    """M3 / M4 (+P13, O2): per-group RMSE / MAE (3 digits) and R² (4 digits), groups ≥ ``min_rows``."""
    m = regression_metrics(df, y, pred, [group_col]).where(F.col("n") >= min_rows)
    return m.select(group_col, F.col("n").alias(rows_name), F.bround("rmse", 3).alias("rmse"),
                    F.bround("mae", 3).alias("mae"), F.bround("r2", 4).alias("r2"))


def improvement(model: DataFrame, baseline: DataFrame, metrics: Sequence[str] = ("rmse", "mae")) -> DataFrame:
    """M5: ``(baseline - model) / baseline * 100`` for one-row metric frames."""
    m = model.select(*[F.col(c).alias(f"model_{c}") for c in metrics])
    b = baseline.select(*[F.col(c).alias(f"baseline_{c}") for c in metrics])
    j = with_scalars(m, b)
    return j.select("*", *[((F.col(f"baseline_{c}") - F.col(f"model_{c}")) / F.col(f"baseline_{c}") * 100)
                           .alias(f"{c}_improvement_pct") for c in metrics])


def improvement_of(df: DataFrame, y: str, model: str, baseline: str) -> DataFrame:
    """M5 from rows that carry both predictions: one aggregation for both sides."""
    both = F.col(y).isNotNull()
    aggs = []
    for side, p in (("model", model), ("baseline", baseline)):
        e = F.when(both, F.col(p) - F.col(y))
        aggs += [F.sqrt(F.avg(e * e)).alias(f"{side}_rmse"), F.avg(F.abs(e)).alias(f"{side}_mae")]
    one = df.agg(*aggs)
    return one.select("*", *[((F.col(f"baseline_{c}") - F.col(f"model_{c}")) / F.col(f"baseline_{c}") * 100).alias(f"{c}_improvement_pct")
                             for c in ("rmse", "mae")])


def interval_metrics(df: DataFrame, y: str, lo: str, hi: str, lo_alpha: float = 0.10, hi_alpha: float = 0.90,
                     target: float = INTERVAL_TARGET_COVERAGE, group_cols: Sequence[str] = ()) -> DataFrame:
    """M6 + M7: inclusive coverage, gap to target, mean width, pinball loss at both quantiles."""
    def pinball(q: str, a: float) -> Column:
        d = F.col(y) - F.col(q)
        return F.avg(F.greatest(F.lit(a) * d, F.lit(a - 1) * d))

    cov = F.avg(((F.col(y) >= F.col(lo)) & (F.col(y) <= F.col(hi))).cast("double"))
    aggs = [F.count(F.lit(1)).cast("long").alias("n"), cov.alias("coverage"),
            F.avg(F.col(hi) - F.col(lo)).alias("avg_width"),
            pinball(lo, lo_alpha).alias("pinball_lo"), pinball(hi, hi_alpha).alias("pinball_hi")]
    a = df.groupBy(*group_cols).agg(*aggs) if group_cols else df.agg(*aggs)
    return a.withColumn("target_coverage", F.lit(float(target))) \
            .withColumn("coverage_gap", F.col("coverage") - F.lit(float(target)))


#: Up to so many pairs the signed-rank distribution is counted out (2**50 subsets are exact in a double).
EXACT_PAIRS = 50


def signed_rank_cdf(n: Column, statistic: Column) -> Column:
    """P(W <= statistic) when each of the ranks 1..n counts with probability one half.

    Rank-sum counting by dynamic programming: ``counts[s]`` is the number of
    subsets of the first k ranks with sum s; rank k + 1 adds the same counts
    moved by k + 1. One array of n(n + 1)/2 + 1 numbers per row.
    """
    def taken(counts: Column, k: Column) -> Column:
        none = F.array_repeat(F.lit(0.0), k)
        return F.zip_with(F.concat(counts, none), F.concat(none, counts), lambda x, y: x + y)

    counts = F.aggregate(F.sequence(F.lit(1), n.cast("int")), F.array(F.lit(1.0)), taken)
    below = F.slice(counts, F.lit(1), F.floor(statistic).cast("int") + 1)
    return F.aggregate(below, F.lit(0.0), lambda acc, x: acc + x) / F.pow(F.lit(2.0), n)


def wilcoxon_signed_rank(df: DataFrame, a: str, b: str, group_cols: Sequence[str] = (), exact_pairs: int = EXACT_PAIRS) -> DataFrame:
    """M8: Wilcoxon signed-rank of ``a - b`` (zeros dropped, average ranks for ties).

    Returns n (non-zero pairs), w_plus, w_minus, statistic = min(W+, W-),
    the tie-corrected normal z, the two-sided p-value, and ``exact``: whether
    that comes from the exact distribution (at most ``exact_pairs`` pairs, none
    of them zero, no two of one size) or from the normal approximation. A group
    with zeros alone has n 0 and no p-value.
    """
    if exact_pairs > EXACT_PAIRS:
        raise ValueError(f"at most {EXACT_PAIRS} pairs are counted exactly")
    group_cols = list(group_cols)
    d = F.col(a) - F.col(b)
    x = df.where(d.isNotNull() & ~F.isnan(d.cast("double"))).select(
        *group_cols, F.abs(d).alias("_absd"), (d > 0).cast("long").alias("_pos"), (d < 0).cast("long").alias("_neg"))
    # zeros are ranked below all others and their number taken off again
    r = ranked_ties(x, "_absd", ["_pos", "_neg"], group_cols)
    size, some = F.col("n").cast("double"), F.col("_absd") != 0

    def total(c: str) -> Column:
        return F.sum(F.when(some, F.col(c).cast("double") * F.col("avg_rank")).otherwise(0.0))

    aggs = [F.sum(F.when(some, F.col("n")).otherwise(0)).alias("n"), F.sum(F.when(some, 0).otherwise(F.col("n"))).alias("_zeros"),
            F.sum("_pos").alias("_np"), F.sum("_neg").alias("_nn"), total("_pos").alias("_wp"), total("_neg").alias("_wm"),
            F.sum(F.when(some, F.pow(size, 3) - size).otherwise(0.0)).alias("_ties")]
    s = r.groupBy(*group_cols).agg(*aggs) if group_cols else r.agg(*aggs)
    s = s.withColumn("w_plus", F.col("_wp") - F.col("_zeros") * F.col("_np")).withColumn("w_minus", F.col("_wm") - F.col("_zeros") * F.col("_nn"))
    n = F.col("n").cast("double")
    mean = n * (n + 1) / 4
    var = n * (n + 1) * (2 * n + 1) / 24 - F.col("_ties") / 48
    stat = F.least(F.col("w_plus"), F.col("w_minus"))
    z = F.when(var > 0, (stat - mean) / F.sqrt(var))
    exact = (n > 0) & (n <= exact_pairs) & (F.col("_zeros") == 0) & (F.col("_ties") == 0)
    p = F.when(exact, 2 * signed_rank_cdf(F.when(exact, F.col("n")), stat)).otherwise(erfc(F.abs(z) / F.lit(math.sqrt(2.0))))
    return s.select(*group_cols, F.col("n").cast("long").alias("n"), "w_plus", "w_minus",
                    stat.alias("statistic"), z.alias("z"), F.when(p > 1, F.lit(1.0)).otherwise(p).alias("p_value"), F.coalesce(exact, F.lit(False)).alias("exact"))


# ---------------------------------------------------------------- binary

def binary_counts(df: DataFrame, y: str, pred: Column | str, group_cols: Sequence[str] = (),
                  extra: Sequence[Column] = ()) -> DataFrame:
    """tp / fp / fn / tn (and ``extra`` aggregates) per group in one conditional aggregation."""
    p = F.col(pred) if isinstance(pred, str) else pred
    t = F.col(y)
    aggs = [F.count(F.lit(1)).cast("long").alias("n"),
            F.count_if((t == 1) & (p == 1)).cast("long").alias("tp"),
            F.count_if((t == 0) & (p == 1)).cast("long").alias("fp"),
            F.count_if((t == 1) & (p == 0)).cast("long").alias("fn"),
            F.count_if((t == 0) & (p == 0)).cast("long").alias("tn"), *extra]
    return df.groupBy(*group_cols).agg(*aggs) if group_cols else df.agg(*aggs)


def _prf(c: DataFrame) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    f1 = F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(F.lit(0.0))
    return c.withColumn("accuracy", (tp + F.col("tn")) / F.col("n")).withColumn("precision", prec) \
            .withColumn("recall", rec).withColumn("f1", f1)


def roc_auc(df: DataFrame, y: str, score: str, group_cols: Sequence[str] = (), out: str = "auc") -> DataFrame:
    """Tie-aware ROC-AUC (Mann–Whitney) per group; NULL when a class is absent.

    ``AUC = Σ_s pos(s) · (neg_below(s) + neg(s)/2) / (P · N)`` over distinct scores.
    """
    group_cols = list(group_cols)
    x = df.where(F.col(score).isNotNull() & F.col(y).isNotNull()).select(
        *group_cols, F.col(score).cast("double").alias("_s"),
        (F.col(y) == 1).cast("long").alias("_p"), (F.col(y) != 1).cast("long").alias("_q"))
    c = x.groupBy(*group_cols, "_s").agg(F.sum("_p").alias("_p"), F.sum("_q").alias("_q"))
    r = running_sum(c, ["_s"], ["_q"], group_cols)
    contrib = F.col("_p").cast("double") * (F.col("cum__q") - F.col("_q") + F.col("_q") / F.lit(2.0))
    aggs = [F.sum(contrib).alias("_num"), F.sum("_p").alias("_tot_pos"), F.sum("_q").alias("_tot_neg")]
    s = r.groupBy(*group_cols).agg(*aggs) if group_cols else r.agg(*aggs)
    return s.select(*group_cols, F.when((F.col("_tot_pos") > 0) & (F.col("_tot_neg") > 0),
                                        F.col("_num") / F.col("_tot_pos").cast("double") / F.col("_tot_neg")).alias(out))


def binary_metrics(df: DataFrame, y: str, prob: str, pred: str | None = None, threshold: float = 0.5,
                   group_cols: Sequence[str] = (), eps: float = 2.220446049250313e-16) -> DataFrame:
    """M9 + M10 + M11: accuracy, precision, recall, F1, ROC-AUC, Brier, log-loss."""
    group_cols = list(group_cols)
    p = F.col(pred) if pred else (F.col(prob) > F.lit(threshold)).cast("int")
    pc = F.least(F.greatest(F.col(prob), F.lit(eps)), F.lit(1 - eps))
    ll = -F.avg(F.when(F.col(y) == 1, F.log(pc)).otherwise(F.log(F.lit(1.0) - pc)))
    scores = [F.avg((F.col(prob) - F.col(y)) ** 2).alias("brier"), ll.alias("log_loss")]
    c = _prf(binary_counts(df, y, p, group_cols, scores))
    auc = roc_auc(df, y, prob, group_cols)
    c = c.select(*[x for x in c.columns if x not in ("brier", "log_loss")], "brier", "log_loss")
    return join_null_safe(c, auc, group_cols, "left") if group_cols else with_scalars(c, auc)


def roc_curve(df: DataFrame, y: str, score: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """One point per distinct score (threshold ``score >= s``): fpr, tpr."""
    group_cols = list(group_cols)
    x = df.where(F.col(score).isNotNull()).select(
        *group_cols, F.col(score).cast("double").alias("threshold"),
        (F.col(y) == 1).cast("long").alias("_p"), (F.col(y) != 1).cast("long").alias("_q"))
    c = x.groupBy(*group_cols, "threshold").agg(F.sum("_p").alias("_p"), F.sum("_q").alias("_q"))
    r = running_sum(c, ["threshold"], ["_p", "_q"], group_cols, totals=True)
    j = r.withColumnsRenamed({"tot__p": "_tot_pos", "tot__q": "_tot_neg"})
    tp = F.col("_tot_pos") - F.col("cum__p") + F.col("_p")
    fp = F.col("_tot_neg") - F.col("cum__q") + F.col("_q")
    return j.select(*group_cols, "threshold", tp.cast("long").alias("tp"), fp.cast("long").alias("fp"),
                    F.when(F.col("_tot_neg") > 0, fp / F.col("_tot_neg")).alias("fpr"),
                    F.when(F.col("_tot_pos") > 0, tp / F.col("_tot_pos")).alias("tpr"))


def calibration_edges(n_bins: int) -> list[float]:
    """Inner bin edges exactly as ``numpy.linspace(0, 1, n_bins + 1)[1:-1]`` computes them."""
    step = 1.0 / n_bins
    return [i * step for i in range(1, n_bins)]


def calibration_curve(df: DataFrame, y: str, prob: str, n_bins: int = 10,
                      group_cols: Sequence[str] = ()) -> DataFrame:
    """Uniform bins; bin = number of inner edges strictly below p (edge → lower bin);
    empty bins are absent; mean predicted probability and positive fraction per bin."""
    p = F.col(prob)
    b = F.lit(0)
    for e in calibration_edges(n_bins):
        b = b + (F.lit(e) < p).cast("int")
    return df.where(p.isNotNull()).groupBy(*group_cols, b.alias("bin")).agg(
        F.count(F.lit(1)).cast("long").alias("n"), F.avg(p).alias("mean_predicted"),
        F.avg(F.col(y).cast("double")).alias("fraction_positive"))


# ---------------------------------------------------------------- multi-class

def confusion_matrix(df: DataFrame, y: str, pred: str, labels: Sequence[int],
                     group_cols: Sequence[str] = ()) -> DataFrame:
    """Full ``labels × labels`` grid with zero cells kept."""
    group_cols = list(group_cols)
    counts = df.groupBy(*group_cols, F.col(y).alias("actual"), F.col(pred).alias("predicted")) \
               .agg(F.count(F.lit(1)).alias("count"))
    lab = F.array(*[F.lit(int(k)) for k in labels])
    grid = df.select(*group_cols).distinct() if group_cols else df.sparkSession.range(1).select()
    grid = grid.withColumn("actual", F.explode(lab)).withColumn("predicted", F.explode(lab))
    return join_null_safe(grid, counts, [*group_cols, "actual", "predicted"], "left") \
               .withColumn("count", F.coalesce(F.col("count"), F.lit(0)).cast("long"))


def _per_class(df: DataFrame, y: str, pred: str, group_cols: Sequence[str]) -> DataFrame:
    """Per (group, class) tp, fp, fn, support over labels present in truth ∪ prediction."""
    group_cols = list(group_cols)
    cells = df.groupBy(*group_cols, F.col(y).alias("_a"), F.col(pred).alias("_p")).agg(F.count(F.lit(1)).alias("_c"))
    side = cells.select(*group_cols, F.explode(F.array(
        F.struct(F.col("_a").alias("label"), (F.col("_a") == F.col("_p")).cast("long").alias("k"),
                 F.lit(1).alias("is_true"), F.col("_c").alias("c")),
        F.struct(F.col("_p").alias("label"), (F.col("_a") == F.col("_p")).cast("long").alias("k"),
                 F.lit(0).alias("is_true"), F.col("_c").alias("c")))).alias("s")).select(*group_cols, "s.*")
    return side.groupBy(*group_cols, "label").agg(
        F.sum(F.when((F.col("is_true") == 1) & (F.col("k") == 1), F.col("c")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("is_true") == 1, F.col("c")).otherwise(0)).alias("support"),
        F.sum(F.when(F.col("is_true") == 0, F.col("c")).otherwise(0)).alias("predicted"))


def _class_prf(pc: DataFrame) -> DataFrame:
    tp, sup, prd = F.col("tp"), F.col("support"), F.col("predicted")
    return pc.withColumn("precision", F.when(prd > 0, tp / prd).otherwise(0.0)) \
             .withColumn("recall", F.when(sup > 0, tp / sup).otherwise(0.0)) \
             .withColumn("f1", F.when(sup + prd > 0, 2 * tp / (sup + prd)).otherwise(0.0))


def multiclass_metrics(df: DataFrame, y: str, pred: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Accuracy, weighted F1 (support-weighted) and macro F1 (labels in truth ∪ prediction)."""
    group_cols = list(group_cols)
    pc = _class_prf(_per_class(df, y, pred, group_cols))
    aggs = [F.sum("support").cast("long").alias("n"), (F.sum("tp") / F.sum("support")).alias("accuracy"),
            (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"),
            F.avg("f1").alias("macro_f1")]
    return pc.groupBy(*group_cols).agg(*aggs) if group_cols else pc.agg(*aggs)


def classification_report(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Precision / recall / F1 / support per class plus accuracy, macro and weighted rows."""
    pc = _class_prf(_per_class(df, y, pred, []))
    per = pc.select(F.col("label").cast("string").alias("row"), "precision", "recall", "f1",
                    F.col("support").cast("long").alias("support"))
    tot = F.sum("support")
    acc = pc.agg(F.lit("accuracy").alias("row"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), (F.sum("tp") / tot).alias("f1"),
                 tot.cast("long").alias("support"))
    mac = pc.agg(F.lit("macro avg").alias("row"), F.avg("precision").alias("precision"),
                 F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), tot.cast("long").alias("support"))
    wt = pc.agg(F.lit("weighted avg").alias("row"),
                *[(F.sum(F.col(m) * F.col("support")) / tot).alias(m) for m in ("precision", "recall", "f1")],
                tot.cast("long").alias("support"))
    return per.unionByName(acc).unionByName(mac).unionByName(wt)


def probability_columns(prob_array: str, k: int, prefix: str = "p") -> dict[str, Column]:
    """Split an ``array<double>`` of class probabilities into ``p0..p{k-1}``."""
    return {f"{prefix}{i}": F.element_at(F.col(prob_array), i + 1) for i in range(k)}


def one_vs_rest_auc(df: DataFrame, y: str, prob_array: str, k: int) -> DataFrame:
    """M14 (+F21): per-class one-vs-rest AUC, all classes in one grouped AUC."""
    long_df = df.select(F.posexplode(F.col(prob_array)).alias("cls", "_score"), F.col(y)) \
                .where(F.col("cls") < k) \
                .select(F.col("cls").cast("int").alias("cls"), "_score",
                        (F.col(y) == F.col("cls")).cast("int").alias("_y"))
    return roc_auc(long_df, "_y", "_score", ["cls"])


def mcnemar(df: DataFrame, y: str, pred_model: str, pred_base: str) -> DataFrame:
    """Continuity-corrected McNemar χ² (1 df); χ² 0 and p 1 without discordant pairs."""
    ok_m = F.col(pred_model) == F.col(y)
    ok_b = F.col(pred_base) == F.col(y)
    c = df.agg(F.count_if(ok_m & ok_b).cast("long").alias("n11"), F.count_if(ok_m & ~ok_b).cast("long").alias("n01"),
               F.count_if(~ok_m & ok_b).cast("long").alias("n10"), F.count_if(~ok_m & ~ok_b).cast("long").alias("n00"))
    disc = F.col("n01") + F.col("n10")
    chi2 = F.when(disc > 0, (F.abs(F.col("n01") - F.col("n10")) - 1) ** 2 / disc).otherwise(F.lit(0.0))
    return c.withColumn("chi2", chi2).withColumn(
        "p_value", F.when(disc > 0, erfc(F.sqrt(F.col("chi2") / 2))).otherwise(F.lit(1.0))) \
        .withColumn("significant_at_0_01", F.col("p_value") < 0.01)


def majority_baseline(train: DataFrame, test: DataFrame, y: str) -> DataFrame:
    """A13 + M20: majority class learned on ``train`` (ties → smallest), its metrics on ``test``."""
    counts = train.groupBy(y).agg(F.count(F.lit(1)).alias("_n"))
    maj = counts.agg(F.max_by(F.col(y), F.struct(F.col("_n"), -F.col(y))).alias("majority"))
    prior = train.agg(F.avg(F.col(y).cast("double")).alias("prior"))
    t = with_scalars(test, maj)
    m = _prf(binary_counts(t, y, F.col("majority")))
    return with_scalars(with_scalars(maj, prior), m.select("n", "accuracy", "precision", "recall", "f1"))


def per_group_classification(df: DataFrame, y: str, prob: str, group_col: str, pred: str | None = None,
                             min_rows: int = MIN_GROUP_ROWS, require_positive: bool = True,
                             threshold: float = 0.5) -> DataFrame:
    """M19 (+P13, P16): per-group positive %, F1, recall, AUC for groups ≥ ``min_rows``.

    With ``require_positive`` groups without positives are dropped (rain
    report); without it they are kept with a NULL AUC (heatwave report).
    """
    m = binary_metrics(df, y, prob, pred, threshold, [group_col])
    m = m.withColumn("pos_pct", F.bround((F.col("tp") + F.col("fn")) / F.col("n") * 100, 2))
    keep = F.col("n") >= min_rows
    if require_positive:
        keep = keep & ((F.col("tp") + F.col("fn")) > 0)
    return m.where(keep).select(group_col, F.col("n").alias("test_rows"), "pos_pct",
                                F.bround("f1", 4).alias("f1"), F.bround("auc", 4).alias("auc"),
                                F.bround("recall", 4).alias("recall"))


def champion(results: DataFrame, metric: str, config_col: str = "config", minimize: bool = True) -> DataFrame:
    """Best row of a result grid; ties → lowest config id (first wins)."""
    key = F.struct(F.col(metric) if minimize else -F.col(metric), F.col(config_col))
    return results.agg(F.min_by(F.struct(*[F.col(c) for c in results.columns]), key).alias("best")).select("best.*")


def entropy_report(df: DataFrame, entropy: str, confidence: str, correct: Column) -> DataFrame:
    """Mean entropy / confidence, and confidence when correct / wrong (NULL if none)."""
    return df.agg(F.avg(entropy).alias("mean_entropy"), F.avg(confidence).alias("mean_confidence"),
                  F.avg(F.when(correct, F.col(confidence))).alias("confidence_when_correct"),
                  F.avg(F.when(~correct, F.col(confidence))).alias("confidence_when_wrong"),
                  F.count_if(correct).cast("long").alias("correct"), F.count(F.lit(1)).cast("long").alias("n"))
