"""Structured Streaming twins of batch operators.

The surveyed system has no streams; these are the streaming forms of its
batch operators, each with a batch twin used in the tests:

* T1 ``stream_dedup`` — W1 under a watermark;
* T2 ``stream_daily_rollup`` — A26 without gap rows (tumbling windows);
* T3 ``stream_labels`` — F9–F13 (stateless);
* T4 :func:`chronoframe.streaming.stateful.stream_panel_features` — W3–W5 behind a
  watermark; ``stream_lag_features`` here answers at once, without one (state: as
  many rows per entity as the largest lag or window, never dropped).
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from chronoframe.config import LabelRules
from chronoframe.plans.bindings import add_labels
from chronoframe.streaming.stateful import event_time

__all__ = ["stream_dedup", "stream_daily_rollup", "stream_labels", "stream_lag_features"]


def stream_dedup(stream: DataFrame, keys: list[str], ts: str, delay: str = "1 hour") -> DataFrame:
    """Drop repeated (entity, time) keys that arrive within the watermark delay."""
    return event_time(stream, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def stream_daily_rollup(stream: DataFrame, entity: str, ts: str, value: str, delay: str = "1 day",
                        width: str = "1 day") -> DataFrame:
    """Tumbling-window mean / count per entity, emitted once the watermark passes."""
    return event_time(stream, ts).withWatermark(ts, delay).groupBy(entity, F.window(ts, width).alias("w")).agg(
        F.avg(value).alias(value), F.count(F.lit(1)).alias("rows")) \
        .select(entity, F.col("w.start").alias("window_start"), value, "rows")


def stream_labels(stream: DataFrame, rules: LabelRules) -> DataFrame:
    """Rule labels on a stream (no state)."""
    return add_labels(stream, rules)


def stream_lag_features(stream: DataFrame, entity: str, ts: str, tiebreak: str, value: str,
                        lags: tuple[int, ...] = (1, 2), window: int = 3) -> DataFrame:
    """T4 without a watermark: positional lags and a trailing mean per entity across micro-batches.

    Each entity keeps as many of its last (ts, tiebreak, value) rows as the
    largest lag or window needs; new rows of a micro-batch are merged with them
    in (ts, tiebreak) order and get their features from what comes before. A
    row later than the buffer reaches sees the buffered rows that precede it;
    rows already emitted are not sent again.
    """
    history = max(max(lags), window - 1)
    kind = {c: stream.schema[c].dataType.simpleString() for c in (entity, tiebreak)}
    lag_cols = [f"{value}_lag_{k}" for k in lags]
    out_schema = (f"{entity} {kind[entity]}, {tiebreak} {kind[tiebreak]}, {value} double, "
                  + ", ".join(f"{c} double" for c in lag_cols) + f", {value}_mean_{window} double")
    state_schema = "buf string"

    def step(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        prev = json.loads(state.get[0]) if state.exists else []
        new = pd.concat(list(batches), ignore_index=True).sort_values([ts, tiebreak])
        old = pd.DataFrame({ts: pd.to_datetime([p[0] for p in prev]).astype(new[ts].dtype), tiebreak: [p[1] for p in prev],
                            value: [p[2] for p in prev], "_new": False})
        both = pd.concat([old, new[[ts, tiebreak, value]].assign(_new=True)], ignore_index=True) if prev else new[[ts, tiebreak, value]].assign(_new=True)
        both = both.sort_values([ts, tiebreak], kind="stable", ignore_index=True)
        s = both[value].astype(float)
        out = pd.DataFrame({entity: [new[entity].iloc[0]] * len(both), tiebreak: both[tiebreak], value: s})
        for k, c in zip(lags, lag_cols):
            out[c] = s.shift(k)
        out[f"{value}_mean_{window}"] = s.rolling(window, min_periods=1).mean()
        out = out[both["_new"].to_numpy(dtype=bool)]
        last = both.tail(history)
        state.update((json.dumps([[str(a), b.item() if hasattr(b, "item") else b, float(c)] for a, b, c in zip(last[ts], last[tiebreak], last[value])]),))
        yield out

    return stream.groupBy(entity).applyInPandasWithState(step, out_schema, state_schema, "append",
                                                         GroupStateTimeout.NoTimeout)
