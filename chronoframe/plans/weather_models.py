"""The four model pipelines on the labelled weather table: search, fit, score, evaluate, one metrics document each.

Every pipeline materialises its features once and its test predictions once;
all metrics are read from the stored predictions. The library's estimators
stand in for the surveyed ones (see :mod:`chronoframe.operators.ml`); column
sampling and least gain have no counterpart and are left out of the grids.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoframe.config import CLASS_NAMES, CV_FOLDS, GRID_CLASSES, GRID_TEMPERATURE, INTERVAL_TARGET_COVERAGE
from chronoframe.functions.scalar import confidence_from_entropy, entropy_bits
from chronoframe.operators import metrics as M
from chronoframe.operators import ml as ML
from chronoframe.operators import panel as P
from chronoframe.operators import rollups as R
from chronoframe.operators import splits as S
from chronoframe.operators.encode import feature_columns
from chronoframe.operators.scalars import with_scalars
from chronoframe.config import WEATHER_PANEL

TARGET_NEXT = "target_temperature_next"
_NUMERIC = ("int", "bigint", "smallint", "tinyint", "double", "float")


def grid(rows: Sequence[tuple]) -> list[dict]:
    """Grid rows as estimator arguments."""
    return [dict(max_iter=r[0], max_depth=r[1], step=r[2], subsample=r[3], min_instances=r[5]) for r in rows]


def inputs(df: DataFrame) -> list[str]:
    """Numeric columns outside the exclude list (targets, metadata, next-hour value)."""
    kind = dict(df.dtypes)
    return [c for c in feature_columns(df) if kind[c] in _NUMERIC and c != "split"]


def with_next_hour(table: DataFrame) -> DataFrame:
    """Next hour's temperature of the same city and split."""
    return P.next_value_target(table, WEATHER_PANEL, "temperature_2m", TARGET_NEXT, extra_partition=["split"])


def _splits(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(df.where(F.col("split") == s) for s in ("train", "val", "test"))


def _document(spark, **parts: DataFrame | dict) -> DataFrame:
    """One row of nested structs from one-row frames and plain values."""
    out = spark.range(1).select()
    for name, part in parts.items():
        if isinstance(part, DataFrame):
            one = part.select(F.struct(*part.columns).alias(name))
            out = with_scalars(out, one)
        else:
            out = out.withColumn(name, F.struct(*[F.lit(v).alias(k) for k, v in part.items()]))
    return out


def cross_validate(df: DataFrame, features: list[str], label: str, config: dict, k: int = CV_FOLDS) -> DataFrame:
    """The champion over expanding folds by position (city, time); mean and population deviation."""
    folds = S.assign_cv_folds(ML.training_rows(df, features, label), ["city", "datetime"], k).checkpoint()
    results = ML.cv_evaluate(folds, features, label, k=k, **config)
    return with_scalars(R.fold_summary(results, "rmse").select("rmse_mean", "rmse_std"), R.fold_summary(results, "mae").select("mae_mean"))


def _best(train: DataFrame, val: DataFrame, features: list[str], label: str, configs: list[dict], kind: str, metric: str, minimize: bool,
          weight: str | None = None) -> dict:
    found = ML.grid_search(train, val, features, label, configs, kind, weight)
    return configs[M.champion(found, metric, minimize=minimize).first()["config"] - 1]


def temperature(table: DataFrame, configs: list[dict] | None = None, folds: int = CV_FOLDS) -> tuple[DataFrame, DataFrame]:
    """Pipeline A: next-hour temperature. Returns (test predictions, metrics document)."""
    configs = configs or grid(GRID_TEMPERATURE)
    df = with_next_hour(table).where(F.col(TARGET_NEXT).isNotNull()).checkpoint()
    features = inputs(df)
    train, val, test = _splits(df)
    best = _best(train, val, features, TARGET_NEXT, configs, "gbt_regressor", "val_rmse", True)
    both = df.where(F.col("split").isin("train", "val")).withColumn("_val", F.col("split") == "val")
    model = ML.fit_gbt_regressor(both, features, TARGET_NEXT, "_val", **best)
    scored = ML.conformal_interval(ML.score(model, val, prob=None), ML.score(model, test, prob=None), TARGET_NEXT, "prediction")
    scored = scored.select("city", "datetime", "season", F.col(TARGET_NEXT).alias("y"), "prediction",
                           F.col("temperature_2m").alias("persistence"), "pred_q10", "pred_q90").checkpoint()
    errors = scored.withColumn("e_model", F.abs(F.col("prediction") - F.col("y"))).withColumn("e_base", F.abs(F.col("persistence") - F.col("y")))
    test_of = M.wilcoxon_signed_rank(errors, "e_model", "e_base").select("statistic", "p_value", (F.col("z") < 0).alias("differs"))
    doc = _document(
        table.sparkSession, pipeline={"name": "A", "task": "temperature_forecasting"}, best_hyperparameters=best,
        cross_validation=cross_validate(df.where(F.col("split").isin("train", "val")), features, TARGET_NEXT, best, folds),
        test_metrics=M.regression_metrics(scored, "y", "prediction"),
        persistence_baseline=M.regression_metrics(scored, "y", "persistence").select("rmse", "mae", "r2"),
        improvement_over_baseline_pct=M.improvement_of(scored, "y", "prediction", "persistence").select(
            F.col("rmse_improvement_pct").alias("rmse"), F.col("mae_improvement_pct").alias("mae")),
        statistical_significance=test_of,
        uncertainty_metrics=M.interval_metrics(scored, "y", "pred_q10", "pred_q90", target=INTERVAL_TARGET_COVERAGE))
    return scored, doc


def event(table: DataFrame, target: str, name: str, task: str, configs: list[dict] | None = None) -> tuple[DataFrame, DataFrame]:
    """Pipelines B (rain) and C (heatwave): a weighted classifier against the majority class."""
    configs = configs or grid(GRID_CLASSES)
    df = table.checkpoint()
    features = inputs(df)
    train, val, test = _splits(df)
    balance = R.class_balance(train, target)
    weighted = with_scalars(train, balance, ["scale_pos_weight"]).withColumn(
        "w", F.when(F.col(target) == 1, F.col("scale_pos_weight")).otherwise(1.0)).drop("scale_pos_weight")
    best = _best(weighted, val, features, target, configs, "gbt_classifier", "val_f1", False, "w")
    model = ML.fit_gbt_classifier(weighted, features, target, "w", **best)
    scored = ML.score(model, test, positive_prob="p").select("city", "datetime", F.col(target).alias("y"), "p", F.col("prediction").cast("int")).checkpoint()
    baseline = M.majority_baseline(train, test, target).select("majority", "accuracy", "f1")
    compared = M.mcnemar(with_scalars(scored, baseline, ["majority"]), "y", "prediction", "majority").select("chi2", "p_value")
    doc = _document(table.sparkSession, pipeline={"name": name, "task": task, "target": target}, class_balance=balance, best_params=best,
                    test_metrics=M.binary_metrics(scored, "y", "p", "prediction"), baseline=baseline, statistical_significance=compared)
    return scored, doc


def disaster(table: DataFrame, num_trees: int = 200, max_depth: int = 8) -> tuple[DataFrame, DataFrame]:
    """Pipeline D: four classes with balanced weights, probabilities, entropy."""
    target = "target_disaster"
    df = table.checkpoint()
    features = inputs(df)
    train, _, test = _splits(df)
    weights = R.balanced_class_weights(train, target).checkpoint()
    model = ML.fit_rf_classifier(R.apply_class_weights(train, target, weights), features, target, "weight", num_trees, max_depth)
    scored = ML.score(model, test).select("city", "datetime", F.col(target).alias("y"), "prob", F.col("prediction").cast("int"))
    entropy = entropy_bits(F.col("prob"))
    scored = scored.withColumn("entropy", entropy).withColumn("confidence", confidence_from_entropy(F.col("entropy"), len(CLASS_NAMES))).checkpoint()
    doc = _document(table.sparkSession, pipeline={"name": "D", "task": "disaster_classification", "target": target},
                    test_metrics=M.multiclass_metrics(scored, "y", "prediction"),
                    baseline=M.multiclass_metrics(scored.withColumn("zero", F.lit(0)), "y", "zero").select("accuracy", "weighted_f1"),
                    entropy_uncertainty=M.entropy_report(scored, "entropy", "confidence", F.col("prediction") == F.col("y")))
    return scored, doc
