"""Registered streams over ``events``: T1–T4, each run to its end over files that arrive in slices.

Every query lands the whole table in :data:`SLICES` slices, with rows up to six
hours late, and runs its stream after each from the checkpoint of the run
before. The oracles are batch SQL; where append mode holds rows back until the
watermark has passed them, they stop at the last watermark.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from chronoframe.config import LabelRules
from chronoframe.functions.rules import alert_level
from chronoframe.plans import bindings as B
from chronoframe.plans.catalog import register, rounded
from chronoframe.plans.q_panel import TIE_DIGITS
from chronoframe.plans.sqlgen import rsig, window_features_sql
from chronoframe.session import ensure_checkpoint_dir
from chronoframe.streaming import runs as R
from chronoframe.streaming import twins as T
from chronoframe.streaming.stateful import stream_panel_features

SLICES = 4
DELAY_SECONDS = 6 * 3600
DELAY = f"{DELAY_SECONDS} seconds"
#: The last watermark, to the millisecond.
WATERMARK_SQL = f"(SELECT date_trunc('milliseconds', max(ts)) - INTERVAL {DELAY_SECONDS} SECOND FROM events)"
EVENT_RULES = LabelRules(rain_col="value", rain_gt=40.0, heat_col="value", heat_default=60.0, heat_special=30.0, heat_special_col="event_type",
                         heat_special_members=("purchase", "error"), storm_a_col="value", storm_a_ge=50.0, storm_b_col="hour", storm_b_ge=18)


def _folder(spark, name: str) -> str:
    """A fresh folder of the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/stream-{name}-{uuid.uuid4().hex[:12]}"


def _streamed(spark, events, name, make, slices=None):
    return R.stream_files(spark, slices or R.arrival_slices(events, "ts", F.col("event_id"), DELAY_SECONDS, SLICES), events.schema, make, _folder(spark, name))


@register("stream_dedup", """
SELECT DISTINCT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events""")
def stream_dedup(spark, sf_dir):
    """A third of the events arrive twice, at other times; one row per (user, time) comes out."""
    ev = B.table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    both = ev.withColumn("copy", F.lit(0)).unionByName(ev.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0).withColumn("copy", F.lit(1)))
    slices = R.arrival_slices(both, "ts", F.struct("event_id", "copy"), DELAY_SECONDS, SLICES)
    out = _streamed(spark, both, "dedup", lambda s: T.stream_dedup(s, ["user_id", "ts"], "ts", DELAY), slices)
    return out.select("user_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"))


@register("stream_daily_rollup", f"""
SELECT user_id, strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, avg(value) AS value, count(*) AS rows
FROM events GROUP BY user_id, date_trunc('day', ts) HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= {WATERMARK_SQL}""")
def stream_daily_rollup(spark, sf_dir):
    """Daily mean and count per user of the days the watermark has passed."""
    ev = B.table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    out = _streamed(spark, ev, "rollup", lambda s: T.stream_daily_rollup(s, "user_id", "ts", "value", DELAY))
    return out.select("user_id", F.date_format("window_start", "yyyy-MM-dd").alias("day"), "value", "rows")


@register("stream_labels", """
WITH t AS (SELECT event_id, event_type, value, hour(ts) AS hour,
             CASE WHEN event_type IN ('purchase', 'error') THEN 30.0::DOUBLE ELSE 60.0::DOUBLE END AS heatwave_threshold FROM events),
l AS (SELECT *, CAST(coalesce(value > 40, false) AS INTEGER) AS target_rain, CAST(coalesce(value >= heatwave_threshold, false) AS INTEGER) AS target_heatwave,
        CAST(coalesce(value >= 50 AND hour >= 18, false) AS INTEGER) AS target_storm FROM t),
c AS (SELECT *, CAST(CASE WHEN target_storm = 1 THEN 3 WHEN target_rain = 1 THEN 2 WHEN target_heatwave = 1 THEN 1 ELSE 0 END AS INTEGER) AS target_disaster FROM l)
SELECT event_id, heatwave_threshold, target_rain, target_heatwave, target_storm, target_disaster,
  CASE WHEN target_disaster = 3 OR value / 100 > 0.8 THEN 'RED' WHEN target_disaster = 1 OR value / 80 > 0.7 OR value > 42 THEN 'ORANGE'
       WHEN target_disaster = 2 OR value / 100 > 0.5 THEN 'YELLOW' ELSE 'GREEN' END AS alert
FROM c""")
def stream_labels(spark, sf_dir):
    """Rule labels and alert levels (F9–F14) of every event as it arrives."""
    ev = B.table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")

    def make(s):
        labelled = T.stream_labels(s.withColumn("hour", F.hour("ts")), EVENT_RULES)
        return labelled.withColumn("alert", alert_level(F.col("value"), F.col("value") / 100, F.col("value") / 80, F.col("target_disaster")))

    out = _streamed(spark, ev, "labels", make)
    return out.select("event_id", "heatwave_threshold", "target_rain", "target_heatwave", "target_storm", "target_disaster", "alert")


_deep_items, _deep_names = window_features_sql("value", "event_type", "ts, event_id", B.DEEP_FEATURES.lags, B.DEEP_FEATURES.windows, "h")


@register("stream_features", rsig(f"""
SELECT * EXCLUDE (ts) FROM (SELECT event_id, event_type, ts, value, {_deep_items} FROM events) WHERE ts <= {WATERMARK_SQL}""", ["value", *_deep_names], TIE_DIGITS))
def stream_features(spark, sf_dir):
    """T4: lags 24/48/72 and 24- and 168-row statistics per event type, from list state, of the rows the watermark has passed."""
    ev = B.table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    out = _streamed(spark, ev, "features", lambda s: stream_panel_features(s, B.TYPE_PANEL, B.DEEP_FEATURES, DELAY))
    return rounded(out.drop("ts"), TIE_DIGITS)
