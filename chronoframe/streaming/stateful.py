"""T4: lag and rolling features of a panel stream, as a stateful processor with list state and event-time timers.

A row waits until the watermark has passed it, so rows may arrive in any order
within the delay; rows behind the watermark are dropped. An entity's state is
two lists: rows that wait, and the last ``halo`` rows that were sent (168 with
the weather sizes). One timer per entity stands at its earliest waiting row, or
at the end of its idle time. Spark's own TTL counts processing time only; idle
entities go by event time here, so a replay gives the same rows: a gap longer
than ``idle`` starts the entity anew, whether or not its state was still held.

Results equal W3–W5 of the batch operators over the rows the watermark has
passed.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DoubleType, LongType, StructField, StructType, TimestampNTZType, TimestampType

from chronoframe.config import FeatureSpec, PanelSpec
from chronoframe.operators.panel import feature_names

__all__ = ["event_time", "stateful_store", "stream_panel_features", "trailing_features"]

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def stateful_store(spark: SparkSession):
    """Queries started inside use the RocksDB state store, which list state and timers need."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def event_time(stream: DataFrame, ts: str) -> DataFrame:
    """Watermarks need TIMESTAMP; a TIMESTAMP_NTZ column is read as UTC (session time zone)."""
    if isinstance(stream.schema[ts].dataType, TimestampNTZType):
        return stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return stream


def trailing_features(values: np.ndarray, start: np.ndarray, first: int, fs: FeatureSpec) -> dict[str, np.ndarray]:
    """W3–W5 of rows ``first``.. of one entity: ``values`` has a column per variable (NaN: missing),
    ``start`` the first row of the segment that each row belongs to."""
    out: dict[str, np.ndarray] = {}
    rows = np.arange(first, len(values))
    for i, v in enumerate(fs.variables):
        x = values[:, i]
        for k in fs.lags:
            at = rows - k
            ok = at >= start[rows]
            out[f"{v}_lag_{k}{fs.lag_suffix}"] = np.where(ok, x[np.maximum(at, 0)], np.nan)
        for name, n in fs.windows.items():
            mean, std = np.full(len(rows), np.nan), np.full(len(rows), np.nan)
            for a in range(0, len(rows), 8192):                 # a block of rows by the window's width at a time
                r = rows[a:a + 8192]
                at = r[:, None] - np.arange(n)[::-1]
                w = np.where(at >= start[r][:, None], x[np.maximum(at, 0)], np.nan)
                there = ~np.isnan(w)
                count = there.sum(1)
                with np.errstate(invalid="ignore", divide="ignore"):
                    m = np.where(there, w, 0.0).sum(1) / count
                    s = np.sqrt(np.where(there, (w - m[:, None]) ** 2, 0.0).sum(1) / (count - 1))
                mean[a:a + 8192], std[a:a + 8192] = m, np.where(count > 1, s, np.nan)
            out[f"{v}_roll_{name}_mean"], out[f"{v}_roll_{name}_std"] = mean, std
    return out


class PanelFeatures(StatefulProcessor):
    """Keeps waiting and sent rows of one entity; see the module."""

    def __init__(self, spec: PanelSpec, fs: FeatureSpec, rows: StructType, idle_us: int | None):
        self.spec, self.fs, self.rows, self.idle = spec, fs, rows, idle_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.rows)
        self.sent = handle.getListState("sent", self.rows)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        new = []
        for part in rows:
            us = part[self.spec.order].astype("datetime64[us]").astype("int64")
            part = part[us > watermark]                         # late rows go, as in every stateful operator
            us = us[us > watermark]
            columns = [us.tolist()] + [[x.item() if hasattr(x, "item") else x for x in part[c]] for c in self._more()]
            new += list(zip(*columns))
        if new:
            self.waiting.appendList([tuple(None if isinstance(x, float) and np.isnan(x) else x for x in r) for r in new])
        yield from self._step(key, watermark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._step(key, timerValues.getCurrentWatermarkInMs() * 1000)

    def close(self) -> None:
        pass

    def _more(self) -> list[str]:
        """Columns of a state row after its time."""
        return [*([self.spec.tiebreak] if self.spec.tiebreak else []), *self.fs.variables]

    def _step(self, key, watermark: int) -> Iterator[pd.DataFrame]:
        """Send what the watermark has passed, forget an idle entity, set the next timer."""
        order = (lambda r: (r[0], r[1])) if self.spec.tiebreak else (lambda r: r[0])
        waiting = sorted(self.waiting.get(), key=order) if self.waiting.exists() else []
        ready = [r for r in waiting if r[0] <= watermark]
        left = waiting[len(ready):]
        sent = list(self.sent.get()) if self.sent.exists() else []
        if ready:
            yield self._frame(key, sent, ready)
            sent = (sent + ready)[-max(self.fs.halo, 1):]
            self.sent.put(sent)
            self.waiting.put(left) if left else self.waiting.clear()
        if sent and self.idle is not None and watermark > sent[-1][0] + self.idle:
            self.sent.clear()
            sent = []
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        due = [left[0][0]] if left else [sent[-1][0] + self.idle + 1] if sent and self.idle is not None else []
        if due:                                                 # whole milliseconds, and not after the row's own time
            self.handle.registerTimer(max((due[0] + 999) // 1000, watermark // 1000 + 1))

    def _frame(self, key, sent: list, ready: list) -> pd.DataFrame:
        rows = sent + ready
        us = np.array([r[0] for r in rows], dtype=np.int64)
        at = 2 if self.spec.tiebreak else 1
        values = np.array([[np.nan if x is None else x for x in r[at:]] for r in rows], dtype=float).reshape(len(rows), -1)
        start = np.zeros(len(rows), dtype=np.int64)
        if self.idle is not None:
            anew = np.concatenate(([False], np.diff(us) > self.idle))
            start = np.maximum.accumulate(np.where(anew, np.arange(len(rows)), 0))
        out = {self.spec.entity: [key[0]] * len(ready), self.spec.order: us[len(sent):].astype("datetime64[us]")}
        if self.spec.tiebreak:
            out[self.spec.tiebreak] = [r[1] for r in ready]
        out |= {v: values[len(sent):, i] for i, v in enumerate(self.fs.variables)}
        return pd.DataFrame(out | trailing_features(values, start, len(sent), self.fs))


def stream_panel_features(stream: DataFrame, spec: PanelSpec, fs: FeatureSpec, delay: str = "6 hours", idle_seconds: float | None = None) -> DataFrame:
    """T4 over ``stream``: the panel's key, time, tie-break and variables with lags, rolling means and sample deviations.

    Rows come out once the watermark (latest time seen less ``delay``) has
    passed them. ``idle_seconds``: how long an entity without rows is
    remembered (None: for ever). Rows without a time are left out. Start the
    query inside :func:`stateful_store`.
    """
    s = event_time(stream, spec.order).where(F.col(spec.order).isNotNull())
    s = s.select(spec.entity, F.col(spec.order).cast("timestamp").alias(spec.order), *([spec.tiebreak] if spec.tiebreak else []),
                 *[F.col(v).cast("double").alias(v) for v in fs.variables]).withWatermark(spec.order, delay)
    keys = [StructField(c, s.schema[c].dataType) for c in ([spec.tiebreak] if spec.tiebreak else [])]
    values = [StructField(v, DoubleType()) for v in fs.variables]
    state = StructType([StructField("us", LongType()), *keys, *values])
    out = StructType([s.schema[spec.entity], StructField(spec.order, TimestampType()), *keys, *values, *[StructField(n, DoubleType()) for n in feature_names(fs)]])
    processor = PanelFeatures(spec, fs, state, None if idle_seconds is None else int(idle_seconds * 1e6))
    return s.groupBy(spec.entity).transformWithStateInPandas(processor, out, "append", "eventTime")
