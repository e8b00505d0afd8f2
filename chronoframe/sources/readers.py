"""Sources (S1–S4, S8, S12, S13). Explicit schemas, partition pruning, no driver loops."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chronoframe.config import HOURLY_VARIABLES
from chronoframe.schemas import API_PAYLOAD_SCHEMA, CITY_DIMENSION_DOC, MASTER_SCHEMA

__all__ = ["read_master_csv", "read_splits", "read_scored", "parse_api_payload", "read_dimension_json",
           "read_metrics_json", "read_report_csv"]


def read_master_csv(spark: SparkSession, path: str, schema: StructType = MASTER_SCHEMA,
                    ts_col: str = "datetime", drop: tuple[str, ...] = ("visibility",)) -> DataFrame:
    """S1 (+F1, P1, P2): CSV scan with an explicit schema, UTC timestamp parse, drop unused columns;
    renames / reorders are plain ``select`` / ``withColumnRenamed`` projections."""
    df = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)
    return df.withColumn(ts_col, F.to_timestamp(F.col(ts_col))).drop(*drop)


def read_splits(spark: SparkSession, path: str, *splits: str) -> DataFrame:
    """One Parquet dataset partitioned by (split, year); the split filter prunes partitions."""
    df = spark.read.parquet(path)
    return df.where(F.col("split").isin(list(splits))) if splits else df


def read_scored(spark: SparkSession, path: str, schema: StructType, ts_col: str = "datetime") -> DataFrame:
    """S3: CSV (gzip or plain, decided by Spark's codec detection) with year / month derived."""
    df = spark.read.schema(schema).option("header", True).csv(path)
    return df.withColumn("year", F.year(ts_col)).withColumn("month", F.month(ts_col))


def parse_api_payload(spark: SparkSession, path: str, entity_from_file: bool = True,
                      variables: tuple[str, ...] = tuple(HOURLY_VARIABLES)) -> DataFrame:
    """Struct-of-parallel-arrays JSON documents → one row per timestamp.

    ``arrays_zip`` + ``explode`` per document (the arrays of one payload are
    bounded by the request window). An empty payload yields no rows. With
    ``entity_from_file`` the file stem becomes the ``city`` column.
    """
    raw = spark.read.schema(API_PAYLOAD_SCHEMA).option("multiLine", True).json(path)
    if entity_from_file:
        raw = raw.withColumn("city", F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:_\d{4})?\.json$", 1))
    h = F.col("hourly")
    n = F.size(h["time"])
    # a variable missing from the payload becomes a NULL column, not a dropped document
    cols = [F.coalesce(h[v], F.array_repeat(F.lit(None).cast("double"), n)).alias(v) for v in variables]
    zipped = F.arrays_zip(h["time"].alias("time"), *cols)
    rows = raw.select(*(["city"] if entity_from_file else []), F.explode(zipped).alias("r"))
    out = rows.select(*(["city"] if entity_from_file else []),
                      F.to_timestamp(F.col("r.time"), "yyyy-MM-dd'T'HH:mm").alias("datetime"),
                      *[F.col(f"r.{v}").alias(v) for v in variables])
    return out


def read_dimension_json(spark: SparkSession, path: str, key: str = "city") -> DataFrame:
    """``{name: {attributes}}`` JSON, one document for all names or one on each line → one dimension row per name."""
    doc = spark.read.text(path, wholetext=True)
    lines = F.split("value", r"(?<=\}\})\s*\n\s*(?=\{)")
    doc = doc.select(F.explode(lines).alias("value"))
    m = F.from_json(F.col("value"), CITY_DIMENSION_DOC)
    return doc.select(F.explode(m).alias(key, "a")).select(key, "a.*") \
              .withColumn("coastal", F.col("coastal").cast("int"))


def read_metrics_json(spark: SparkSession, path: str) -> DataFrame:
    """Nested metrics document (one row)."""
    return spark.read.option("multiLine", True).json(path)


def read_report_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Report table with an explicit schema."""
    return spark.read.schema(schema).option("header", True).csv(path)
