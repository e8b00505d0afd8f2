"""Sinks (S5, S7, S9–S12, S14). Partitioned, idempotent writes; small reports only are coalesced."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoframe.config import CLASS_NAMES, TEST_YEARS, TRAIN_YEARS, VAL_YEAR, LabelRules
from chronoframe.operators.encode import columns_matching

__all__ = ["write_cache", "write_master", "write_splits", "feature_manifest", "write_report", "write_metrics_json",
           "export_rows", "write_dimension_json", "write_per_entity", "manifest_document"]


def write_cache(df: DataFrame, path: str, entity: str = "city", ts: str = "datetime") -> None:
    """Idempotent per-(entity, year) chunks — dynamic partition overwrite replaces only the
    partitions present in ``df`` (re-running a chunk never duplicates it)."""
    spark = df.sparkSession
    prev = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        df.withColumn("year", F.year(ts)).write.mode("overwrite").partitionBy(entity, "year").parquet(path)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)


def write_master(df: DataFrame, path: str, entity: str = "city", ts: str = "datetime",
                 num_partitions: int | None = None) -> None:
    """S7 + O1: master table range-partitioned on (entity, time) and sorted within files
    (``sortWithinPartitions``, no global sort); a hot entity is split over several files by
    the sampled range bounds. Everywhere else the (entity, time) order is the window's own
    ordering, never a separate ``orderBy``."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(n, entity, ts).sortWithinPartitions(entity, ts).write.mode("overwrite").parquet(path)


def write_splits(df: DataFrame, path: str, ts: str = "datetime") -> None:
    """One dataset partitioned by (split, year) → readers prune by split."""
    df.withColumn("year", F.year(ts)).write.mode("overwrite").partitionBy("split", "year").parquet(path)


def feature_manifest(spark: SparkSession, df: DataFrame, exclude: Sequence[str]) -> DataFrame:
    """Feature groups derived from column names (lag / rolling / target / other)."""
    lag = set(columns_matching(df, contains="_lag_"))
    roll = set(columns_matching(df, contains="_roll_"))
    tgt = set(columns_matching(df, prefix="target_"))
    rows = []
    for c in df.columns:
        group = "lag" if c in lag else "rolling" if c in roll else "target" if c in tgt else \
            "excluded" if c in exclude else "input"
        rows.append((c, group))
    return spark.createDataFrame(rows, "column string, grp string")


def manifest_document(df: DataFrame, rules: LabelRules, exclude: Sequence[str] = (), calendar: Sequence[str] = (), codes: Sequence[str] = (),
                      place: Sequence[str] = (), raw: Sequence[str] = (), classes: Sequence[str] = tuple(CLASS_NAMES),
                      train: tuple[int, int] = TRAIN_YEARS, val: int = VAL_YEAR, test: tuple[int, int] = TEST_YEARS) -> DataFrame:
    """The whole manifest of a feature table as one nested row (for :func:`write_metrics_json`).

    Row and column counts, feature groups by column name, targets with the
    class map, the model inputs (all columns but targets and ``exclude``), the
    thresholds of the labelling rules and the split years. One count over the
    table; the rest are literals.
    """
    targets = columns_matching(df, prefix="target_")
    inputs = [c for c in df.columns if c not in {*targets, *exclude}]

    def names(cols: Sequence[str]):
        return F.array(*[F.lit(c) for c in cols if c in df.columns]).cast("array<string>")

    groups = {"raw": raw, "lag": columns_matching(df, contains="_lag_"), "rolling": columns_matching(df, contains="_roll_"),
              "calendar": calendar, "codes": codes, "place": place}
    class_map = F.create_map(*[F.lit(x) for i, c in enumerate(classes) for x in (str(i), c)])
    thresholds = {"rain": rules.rain_gt, "heat": rules.heat_default, "heat_special": rules.heat_special, "storm_a": rules.storm_a_ge, "storm_b": rules.storm_b_ge}
    return df.agg(F.count(F.lit(1)).alias("total_rows")).select(
        "total_rows", F.lit(len(df.columns)).alias("total_features"),
        F.struct(*[names(v).alias(k) for k, v in groups.items()]).alias("feature_groups"),
        F.struct(names([c for c in targets if c != "target_disaster"]).alias("binary"), F.lit("target_disaster").alias("multiclass"), class_map.alias("classes")).alias("targets"),
        names(inputs).alias("model_inputs"),
        F.struct(*[F.lit(float(v)).alias(k) for k, v in thresholds.items()],
                 F.array_sort(F.array(*[F.lit(str(m)) for m in rules.heat_special_members])).alias("heat_special_members")).alias("thresholds"),
        F.struct(F.lit(f"{train[0]}-{train[1]}").alias("train"), F.lit(str(val)).alias("validation"), F.lit(f"{test[0]}-{test[1]}").alias("test")).alias("split"))


def write_per_entity(df: DataFrame, path: str, entity: str = "city", ts: str = "datetime", num_partitions: int | None = None) -> None:
    """One folder of CSV files per entity, rows in time order inside each file.

    Range partitions on (entity, time) split a hot entity over several files;
    a file's rows all come before the next one's.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(n, entity, ts).sortWithinPartitions(entity, ts).write.mode("overwrite").partitionBy(entity).option("header", True).csv(path)


def write_report(df: DataFrame, path: str, single_file: bool = False) -> None:
    """A report as CSV, whole whatever its size.

    ``single_file`` asks for one file (for reports that are known to be small): rows are dealt to one writer after the
    plan has run in parallel (a shuffle, so the work above keeps its tasks).
    """
    out = df.repartition(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def write_metrics_json(df: DataFrame, path: str) -> None:
    """One-row nested metrics frame → JSON."""
    df.coalesce(1).write.mode("overwrite").json(path)


def export_rows(df: DataFrame, path: str, order: Sequence[str], limit: int | None = None) -> None:
    """Export in an explicit order: all rows, or the first ``limit`` where the caller asks for a limit."""
    out = df.orderBy(*order)
    if limit is not None:
        out = out.limit(limit)
    out.write.mode("overwrite").option("header", True).csv(path)


def write_dimension_json(dim: DataFrame, path: str, key: str = "city") -> None:
    """S8 sink: ``{name: {attributes}}`` documents, one line for each row; the reader joins any number of them.

    No document holds the whole dimension, so its size is no limit.
    """
    attrs = [c for c in dim.columns if c != key]
    dim.select(F.to_json(F.create_map(F.col(key), F.struct(*attrs))).alias("value")).write.mode("overwrite").text(path)
