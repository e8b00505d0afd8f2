"""S5 + S16 resumable ingest, S1 + S4 bad-record channel.

*Ingest.* A chunk is one (entity, year). Its data is written first, replacing
what the chunk's folder held; then the manifest gets a row for it. The work
list is anti-joined with the manifest, and readers see chunks of the manifest
only: a run that dies in between leaves data that no one sees and that the next
run replaces, so no row is lost or doubled.

*Bad records.* Lines that do not parse, and rows whose time does not, go to a
quarantine with file and reason instead of turning into NULLs; good and bad
rows add up to what was read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from chronoframe.sources.writers import write_cache

__all__ = ["ChunkStore", "read_csv_checked", "read_payload_checked"]

_BAD = "_corrupt_record"


class ChunkStore:
    """Chunks by (entity, year) under ``path``: ``data`` and ``manifest``."""

    def __init__(self, spark: SparkSession, path: str, entity: str = "city", ts: str = "datetime"):
        self.spark, self.path, self.entity, self.ts = spark, path, entity, ts

    def _there(self, name: str) -> bool:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder)

    def manifest(self, like: DataFrame) -> DataFrame:
        """``(entity, year, rows, run)`` of every committed chunk; a chunk taken twice counts once."""
        schema = StructType([like.schema[self.entity], *self.spark.range(0).select(F.lit(0).alias("year"), F.lit(0).cast("long").alias("rows"), F.lit("").alias("run")).schema])
        if not self._there("manifest"):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.parquet(f"{self.path}/manifest").withColumn(self.entity, F.col(self.entity).cast(schema[self.entity].dataType))
        return rows.groupBy(self.entity, "year").agg(F.max(F.struct("rows", "run")).alias("_m")).select(self.entity, "year", "_m.*")

    def pending(self, worklist: DataFrame) -> DataFrame:
        """Work items (entity, year) that no run has committed."""
        done = self.manifest(worklist).select(self.entity, "year")
        return worklist.select(self.entity, "year").distinct().join(done, [self.entity, "year"], "left_anti")

    def write(self, pending: DataFrame, load: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Load and write the chunks; returns the manifest rows still to be committed (chunks without rows have 0)."""
        rows = load(pending)
        write_cache(rows, f"{self.path}/data", self.entity, self.ts)
        year = F.year(self.ts).alias("year")
        counts = rows.groupBy(self.entity, year).agg(F.count(F.lit(1)).alias("rows"))
        return pending.join(counts, [self.entity, "year"], "left").withColumn("rows", F.coalesce("rows", F.lit(0)).cast("long"))

    def commit(self, written: DataFrame) -> None:
        run = uuid.uuid4().hex[:12]
        written.withColumn("run", F.lit(run)).write.mode("append").parquet(f"{self.path}/manifest")

    def run(self, worklist: DataFrame, load: Callable[[DataFrame], DataFrame]) -> int:
        """One run over what is left; the number of chunks taken."""
        pending = self.pending(worklist).checkpoint()
        taken = pending.count()
        if taken:
            self.commit(self.write(pending, load))
        return taken

    def read(self, schema: StructType) -> DataFrame:
        """Rows of committed chunks."""
        if not self._there("data"):
            return self.spark.createDataFrame([], schema)
        stored = StructType([*[f for f in schema if f.name != self.entity], schema[self.entity]])
        rows = self.spark.read.schema(StructType([*stored, *self.spark.range(0).select(F.lit(0).alias("year")).schema])).parquet(f"{self.path}/data")
        done = self.manifest(self.spark.createDataFrame([], schema)).where("rows > 0").select(self.entity, "year")
        return rows.join(F.broadcast(done), [self.entity, "year"], "left_semi").select(*schema.names)


def read_csv_checked(spark: SparkSession, path: str, schema: StructType, ts_col: str | None = "datetime", required: Sequence[str] = (), header: bool = True) -> tuple[DataFrame, DataFrame]:
    """S1 with a bad-record channel: ``(good, quarantine)``.

    A line is bad if its fields do not fit the schema (``malformed``), if its
    time does not parse (``bad time``) or if a required field is missing
    (``missing <column>``). The quarantine has ``file``, ``reason`` and the
    line as ``record``.
    """
    fields = [StructField(f.name, StringType()) if f.name == ts_col else f for f in schema]
    raw = spark.read.schema(StructType([*fields, StructField(_BAD, StringType())])).option("header", header).option("mode", "PERMISSIVE") \
        .option("columnNameOfCorruptRecord", _BAD).csv(path).withColumn("_file", F.input_file_name())
    time = F.try_to_timestamp(ts_col) if ts_col else F.lit(None)
    reason = F.when(F.col(_BAD).isNotNull(), "malformed")
    if ts_col:
        reason = reason.when(F.col(ts_col).isNotNull() & time.isNull(), "bad time")
    for c in required:
        reason = reason.when(F.col(c).isNull(), f"missing {c}")
    # a line is judged as a whole: this is always true, and asks for every column, which the scan would not parse otherwise
    judged = raw.where(F.xxhash64(*[F.col(f"`{f.name}`") for f in schema]) <= 2**63 - 1).withColumn("_reason", reason)
    good = judged.where("_reason is null").select(*[(time if f.name == ts_col else F.col(f"`{f.name}`")).cast(f.dataType).alias(f.name) for f in schema])
    line = F.coalesce(F.col(_BAD), F.to_csv(F.struct(*[F.col(f"`{f.name}`") for f in schema])))
    return good, judged.where("_reason is not null").select(F.col("_file").alias("file"), F.col("_reason").alias("reason"), line.alias("record"))


def read_payload_checked(spark: SparkSession, path: str, schema: StructType, arrays: Sequence[str], root: str = "hourly") -> tuple[DataFrame, DataFrame]:
    """S4 with a bad-record channel: documents of parallel arrays, one per file; ``(good, quarantine)``.

    A document is bad if it is no JSON of the schema (``malformed``) or if an
    array of ``arrays`` that it has is not as long as the first (``ragged <name>``).
    """
    raw = spark.read.schema(StructType([*schema, StructField(_BAD, StringType())])).option("multiLine", True).option("mode", "PERMISSIVE") \
        .option("columnNameOfCorruptRecord", _BAD).json(path).withColumn("_file", F.input_file_name())
    reason = F.when(F.col(_BAD).isNotNull(), "malformed")
    size = F.coalesce(F.size(F.col(root)[arrays[0]]), F.lit(0))
    for a in arrays[1:]:
        reason = reason.when(F.col(root)[a].isNotNull() & (F.size(F.col(root)[a]) != size), f"ragged {a}")
    judged = raw.withColumn("_reason", reason)
    record = F.coalesce(F.col(_BAD), F.to_json(F.struct(*[F.col(f.name) for f in schema])))
    return (judged.where("_reason is null").select(*[f.name for f in schema], F.col("_file").alias("file")),
            judged.where("_reason is not null").select(F.col("_file").alias("file"), F.col("_reason").alias("reason"), record.alias("record")))
