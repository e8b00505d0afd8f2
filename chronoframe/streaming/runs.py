"""Running a stream to its end over files: an idempotent sink, arrivals in order, and a driver of both.

``BatchFolders`` writes each micro-batch to a folder named by its id, in place
of what a broken attempt may have left there. Spark's checkpoint fixes which
input a batch id stands for, so a batch that is run again after a failure
writes the same rows to the same folder: none is lost, none is doubled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chronoframe.streaming.stateful import stateful_store

__all__ = ["BatchFolders", "arrival_slices", "run_to_end", "stream_files"]

_BATCH = "_cf_batch"


class BatchFolders:
    """A ``foreachBatch`` sink: one folder for each batch id."""

    def __init__(self, path: str):
        self.path = path

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{_BATCH}={batch_id}")

    def read(self, spark: SparkSession, schema: StructType) -> DataFrame:
        """All batches; ``schema`` is the stream's (an input without rows may have left no batch)."""
        folder = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(self.path).select(*schema.names)


def run_to_end(rows: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Process all input there is, from where ``checkpoint`` stands, and stop."""
    with stateful_store(rows.sparkSession):
        query = rows.writeStream.foreachBatch(sink).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def arrival_slices(df: DataFrame, ts: str, key: Column, delay_seconds: int, slices: int) -> Iterable[DataFrame]:
    """``df`` as it might arrive: every row up to ``delay_seconds`` after its time (by a hash of ``key``), cut into ``slices`` periods.

    Rows of one slice are out of order, and a slice has rows older than some of
    the slice before, but none is behind a watermark of ``delay_seconds``.
    """
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    span = df.agg(F.min(us).alias("a"), F.max(us).alias("b")).first()
    if span["a"] is None:
        yield df
        return
    width = (span["b"] - span["a"]) // slices + 1
    arrival = us + F.pmod(F.xxhash64(key), F.lit(delay_seconds * 1_000_000))
    number = F.least(F.floor((arrival - span["a"]) / width), F.lit(slices - 1))
    for k in range(slices):
        yield df.where(number == k)


def stream_files(spark: SparkSession, slices: Iterable[DataFrame], schema: StructType, make: Callable[[DataFrame], DataFrame], folder: str, mode: str = "append") -> DataFrame:
    """Land each slice as files and run the stream over what is new; every run goes on from the checkpoint of the one before.

    ``make`` turns the input stream into the stream of results. Returns all
    rows the sink holds in the end.
    """
    source, sink = f"{folder}/in", BatchFolders(f"{folder}/out")
    for part in slices:
        part.write.mode("append").parquet(source)
        rows = make(spark.readStream.schema(schema).parquet(source))
        run_to_end(rows, sink, f"{folder}/checkpoint", mode)
    return sink.read(spark, rows.schema)
