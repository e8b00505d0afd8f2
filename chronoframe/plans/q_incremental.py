"""Registered queries of the incremental paths: features by appends, resumed ingest, quarantine of bad lines; the manifest and the small helpers."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampType

from chronoframe.functions.calendar import parse_utc
from chronoframe.functions.rules import two_way_label
from chronoframe.functions.scalar import fallback_interval, snake_lower
from chronoframe.operators import extension as X
from chronoframe.operators import splits as S
from chronoframe.operators.clean import drop_if_present
from chronoframe.operators.encode import columns_matching, feature_columns, pinned_features
from chronoframe.plans import bindings as B
from chronoframe.plans import q_panel as Q
from chronoframe.plans.catalog import register
from chronoframe.plans.sqlgen import rsig, window_features_sql
from chronoframe.session import ensure_checkpoint_dir
from chronoframe.sources import ingest as I
from chronoframe.sources import writers as W

APPENDS = ("2024-01-15", "2024-01-25")
LATE_ROWS = 168

_items, _names = window_features_sql("value", "user_id", "ts, event_id", B.USER_FEATURES.lags, B.USER_FEATURES.windows)


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@register("feature_extension", rsig(f"""
WITH e AS (SELECT event_id, user_id, ts, CASE WHEN event_id % 50 = 7 AND ts >= TIMESTAMP '2024-01-20' AND ts < TIMESTAMP '2024-01-25' THEN value + 1
                                              WHEN event_id % 11 <> 0 THEN value END AS value FROM events),
f AS (SELECT * REPLACE (coalesce(last_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                                 first_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS value) FROM e)
SELECT event_id, user_id, value, {_items} FROM f""", ["value", *_names]))
def feature_extension(spark, sf_dir):
    """W2–W5 by three appends of ``events``, the last with corrections of days the second brought: equal to one run over the corrected table."""
    ev = B.table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    first = ev.withColumn("value", F.when(F.col("event_id") % 11 != 0, F.col("value")))
    ts = F.col("ts")
    a, b = (F.lit(x).cast("timestamp_ntz") for x in APPENDS)
    fixed = ev.where((F.col("event_id") % 50 == 7) & (ts >= F.lit("2024-01-20").cast("timestamp_ntz")) & (ts < b)).withColumn("value", F.col("value") + 1)
    tail, parts = X.empty_tail(first, ["value"]), []
    for part in (first.where(ts < a), first.where((ts >= a) & (ts < b)), first.where(ts >= b).unionByName(fixed)):
        step = X.extend_panel(tail, part, B.USER_PANEL, B.USER_FEATURES, ["value"], LATE_ROWS)
        parts.append(step.features.checkpoint())
        tail = step.tail.checkpoint()
    return X.merge_upserts(parts, ["user_id", "ts", "event_id"]).drop("ts")


@register("ingest_resumed", """
SELECT o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS rows, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1, 2""")
def ingest_resumed(spark, sf_dir):
    """S5 + S16: chunks by (priority, year); one run commits the early years, one dies after its write, one takes what is left."""
    orders = B.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice")
    work = S.chunk_worklist(orders, "o_orderpriority", 1995, 2001)
    store = I.ChunkStore(spark, _folder(spark, "ingest"), "o_orderpriority", "o_orderdate")

    def load(pending):
        p = pending.select(F.col("o_orderpriority").alias("_p"), F.col("year").alias("_y"))
        return orders.join(F.broadcast(p), (orders["o_orderpriority"] == p["_p"]) & (F.year("o_orderdate") == p["_y"]), "left_semi")

    store.commit(store.write(store.pending(work).where("year < 1998").checkpoint(), load))
    store.write(store.pending(work).where("year < 2000").checkpoint(), load)        # stopped here: written, not committed
    store.run(work, load)
    return store.read(orders.schema).groupBy("o_orderpriority", F.year("o_orderdate").alias("year")).agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("o_totalprice"), 2).alias("total"))


EVENT_CSV = StructType([StructField("event_id", LongType()), StructField("ts", TimestampType()), StructField("event_type", StringType()), StructField("value", DoubleType())])


@register("csv_quarantine", """
SELECT CASE WHEN event_id % 97 = 0 THEN 'malformed' WHEN event_id % 89 = 0 THEN 'malformed' WHEN event_id % 83 = 0 THEN 'bad time' WHEN event_id % 79 = 0 THEN 'missing event_type' ELSE 'good' END AS reason,
  count(*) AS rows, CAST(count(DISTINCT event_id) AS BIGINT) AS ids FROM events GROUP BY 1""")
def csv_quarantine(spark, sf_dir):
    """S1 with the bad-record channel: events as CSV lines, some cut short, some with text for a number, a wrong time or no type."""
    e = F.col("event_id")
    ts = F.when(e % 83 == 0, "yesterday").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    line = F.concat_ws(",", e.cast("string"), ts, F.when(e % 79 == 0, "").otherwise(F.col("event_type")), F.when(e % 89 == 0, "n/a").otherwise(F.coalesce(F.col("value").cast("string"), F.lit(""))))
    path = _folder(spark, "lines")
    B.table(spark, sf_dir, "events").select(F.when(e % 97 == 0, F.substring_index(line, ",", 2)).otherwise(line).alias("value")).write.text(path)
    good, bad = I.read_csv_checked(spark, path, EVENT_CSV, "ts", ["event_type"], header=False)
    rows = good.select(F.lit("good").alias("reason"), "event_id").unionByName(bad.select("reason", F.substring_index("record", ",", 1).cast("long").alias("event_id")))
    return rows.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("event_id").alias("ids"))


@register("feature_manifest", f"""
SELECT count(*) AS total_rows, 49 AS total_features, 4 AS n_raw, 12 AS n_lag, 16 AS n_rolling, 8 AS n_calendar, 2 AS n_codes, 3 AS n_binary, 4 AS n_classes, 44 AS n_inputs,
  0.05::DOUBLE AS rain, 90000.0::DOUBLE AS heat, 95000.0::DOUBLE AS heat_special, 'R' AS heat_member, 40.0::DOUBLE AS storm_a, 0.07::DOUBLE AS storm_b,
  '1995-1998' AS train, '1999' AS validation, '2000-2001' AS test FROM ({Q._stage_sql()})""")
def feature_manifest(spark, sf_dir):
    """The manifest of the feature stage, written as JSON and read back."""
    stage = Q.feature_stage_frame(spark, sf_dir).select(*Q.WIDE_COLS)
    doc = W.manifest_document(stage, B.LINEITEM_RULES, ["heatwave_threshold"], ["hour", "day", "day_of_week", "month", "year", "day_of_year", "is_weekend", "season"],
                              ["nation_id", "region_id"], (), Q.STAGE_VARS, train=B.SPLIT_TRAIN, val=B.SPLIT_VAL, test=B.SPLIT_TEST)
    path = _folder(spark, "manifest")
    W.write_metrics_json(doc, path)
    d = spark.read.schema(doc.schema).json(path)
    g, t = "feature_groups", "thresholds"
    return d.select("total_rows", "total_features", *[F.size(f"{g}.{k}").alias(f"n_{k}") for k in ("raw", "lag", "rolling", "calendar", "codes")],
                    F.size("targets.binary").alias("n_binary"), F.size("targets.classes").alias("n_classes"), F.size("model_inputs").alias("n_inputs"),
                    *[F.col(f"{t}.{k}").alias(k) for k in ("rain", "heat", "heat_special")], F.col(f"{t}.heat_special_members")[0].alias("heat_member"),
                    F.col(f"{t}.storm_a").alias("storm_a"), F.col(f"{t}.storm_b").alias("storm_b"), "split.train", "split.validation", "split.test")


@register("helper_columns", rsig("""
WITH o AS (SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M') AS text, o_totalprice, o_orderpriority, o_orderstatus, 'live' AS part FROM orders WHERE o_orderstatus = 'F'
           UNION ALL SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M'), o_totalprice, o_orderpriority, o_orderstatus, 'rest' FROM orders WHERE o_orderstatus <> 'F')
SELECT o_orderkey, part, strftime(strptime(text, '%Y-%m-%dT%H:%M'), '%Y-%m-%d %H:%M:%S') AS parsed, o_totalprice - 2 AS low, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice * 1.1 ELSE o_totalprice + 2 END AS high,
  replace(lower(o_orderpriority), ' ', '_') AS snake, CASE WHEN o_totalprice >= 200000 THEN 'Heatwave' ELSE 'Normal' END AS two_way,
  'o_custkey,o_orderkey,o_orderpriority,part,text' AS inputs, 'text,o_custkey' AS pinned, 'o_custkey,o_orderkey,o_orderpriority,o_orderstatus' AS keys FROM o""", ["low", "high"]))
def helper_columns(spark, sf_dir):
    """F1, F20, F23, F24, P1, P4, P5, P6, P15, U1, U2 over all orders: one status filtered out and put back, text parsed, intervals with a fallback."""
    o = B.table(spark, sf_dir, "orders")
    o = o.withColumn("text", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm"))
    live = o.where(F.col("o_orderstatus") == "F").withColumn("part", F.lit("live"))
    both = live.unionByName(o.where(F.col("o_orderstatus") != "F").withColumn("part", F.lit("rest")))
    both = drop_if_present(both, "o_orderdate", "visibility")
    inputs = feature_columns(both, ["o_totalprice", "o_orderstatus"])
    pinned = pinned_features(both, ["text", "no_such_column", "o_custkey"])
    quantile = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice") * 1.1)
    return both.select("o_orderkey", "part", F.date_format(parse_utc("text", "yyyy-MM-dd'T'HH:mm"), "yyyy-MM-dd HH:mm:ss").alias("parsed"),
                       fallback_interval(F.col("o_totalprice"), None, -1).alias("low"), fallback_interval(F.col("o_totalprice"), quantile, 1).alias("high"),
                       snake_lower(F.col("o_orderpriority")).alias("snake"), two_way_label(F.col("o_totalprice"), F.lit(200000)).alias("two_way"),
                       F.lit(",".join(sorted(inputs))).alias("inputs"), F.lit(",".join(pinned)).alias("pinned"), F.lit(",".join(sorted(set(columns_matching(both, prefix="o_")) - {"o_totalprice"}))).alias("keys"))
