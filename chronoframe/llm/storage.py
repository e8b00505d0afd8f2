"""Reliable checkpoints that leave no shuffle files behind, and Arrow batches sized for documents."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Spark removes an execution's shuffle files when it ends, not when the driver next collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder; the shuffles that made it are dropped, nothing reads them again."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return df.select("*").checkpoint()
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def document_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """Lets the session hand documents to Python by at most ``rows``: Spark's 10,000 are meant for narrow rows.

    A smaller number that the user has set stays. Returns ``df``.
    """
    conf = df.sparkSession.conf
    if int(conf.get(BATCH_ROWS, "10000")) > rows:
        conf.set(BATCH_ROWS, str(rows))
    return df
