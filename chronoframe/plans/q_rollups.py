"""Dashboard roll-ups (A14–A23, P16, W13, O3–O5, S4 payload parsing)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from chronoframe.functions.scalar import array_argmax
from chronoframe.operators import panel as P
from chronoframe.operators import rollups as R
from chronoframe.operators.ordered import exact_quantiles
from chronoframe.operators.scalars import with_scalars
from chronoframe.plans import bindings as B
from chronoframe.plans.catalog import register, rounded
from chronoframe.plans.q_metrics import (LINE_CLASSES_CTE, LINE_CLASSES_NATION_CTE, LINE_ORDER, ORDER_PRED_CTE, _argmax_sql, _grouped_sql,
                                         _test, line_classes, order_predictions)
from chronoframe.plans.sqlgen import CLASS_NAMES_SQL, MONTH_NAMES_SQL, rsig

_TS = "'%Y-%m-%d %H:%M:%S'"


@register("monthly_stats", rsig(f"""
SELECT strftime(date_trunc('month', o_orderdate), {_TS}) AS period, avg(o_totalprice) AS mean,
  min(o_totalprice) AS min, max(o_totalprice) AS max FROM orders GROUP BY 1""", ["mean", "min", "max"]))
def monthly_stats(spark, sf_dir):
    """A14 (+F7): monthly mean / min / max."""
    return R.period_stats(B.table(spark, sf_dir, "orders"), "o_orderdate",
                          {"mean": F.avg("o_totalprice"), "min": F.min("o_totalprice"), "max": F.max("o_totalprice")})


@register("monthly_totals", rsig(f"""
SELECT CAST(month(l_shipdate) AS INTEGER) AS month, sum(l_quantity) AS l_quantity,
  {MONTH_NAMES_SQL}[month(l_shipdate)] AS month_name FROM lineitem GROUP BY 1, 3""", ["l_quantity"]))
def monthly_totals(spark, sf_dir):
    """A16 (+F8): totals by calendar month across years with month names."""
    return R.sum_by_month_of_year(B.table(spark, sf_dir, "lineitem"), "l_shipdate", "l_quantity")


@register("diurnal_profile", rsig("""
SELECT CAST(hour(ts) AS INTEGER) AS hour, avg(value) AS value FROM events GROUP BY 1""", ["value"]))
def diurnal_profile(spark, sf_dir):
    """Mean by hour of day."""
    return R.mean_by_hour(B.table(spark, sf_dir, "events"), "ts", "value")


@register("monthly_actual_vs_predicted", rsig(f"""
WITH {ORDER_PRED_CTE},
q AS (SELECT quantile_cont(y - pred, 0.1) AS q10, quantile_cont(y - pred, 0.9) AS q90 FROM pr
      WHERE split = 'val' AND y IS NOT NULL),
t AS (SELECT o_orderdate, y, pred, least(pred + q10, pred + q90) AS lo, greatest(pred + q10, pred + q90) AS hi
      FROM pr, q WHERE split = 'test' AND y IS NOT NULL)
SELECT strftime(date_trunc('month', o_orderdate), {_TS}) AS period, avg(y) AS actual, avg(pred) AS pred,
  avg(lo) AS q10, avg(hi) AS q90 FROM t GROUP BY 1""", ["actual", "pred", "q10", "q90"]))
def monthly_actual_vs_predicted(spark, sf_dir):
    """A18 (+L7a, F20): monthly mean of actual, point prediction and interval bounds."""
    pr = order_predictions(spark, sf_dir, ["val", "test"])
    val = pr.where((F.col("split") == "val") & F.col("y").isNotNull()).withColumn("resid", F.col("y") - F.col("pred"))
    q = exact_quantiles(val, "resid", [0.1, 0.9], names=["rq10", "rq90"])
    t = with_scalars(_test(pr), q)
    lo = F.least(F.col("pred") + F.col("rq10"), F.col("pred") + F.col("rq90"))
    hi = F.greatest(F.col("pred") + F.col("rq10"), F.col("pred") + F.col("rq90"))
    t = t.withColumn("lo", lo).withColumn("hi", hi)
    return R.period_stats(t, "o_orderdate", {"actual": F.avg("y"), "pred": F.avg("pred"), "q10": F.avg("lo"),
                                             "q90": F.avg("hi")})


@register("events_actual_vs_predicted", f"""
WITH {LINE_CLASSES_CTE}
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(sum(target_heatwave) AS BIGINT) AS heat_actual,
  CAST(count_if(p1 > 0.5) AS BIGINT) AS heat_predicted, CAST(sum(target_rain) AS BIGINT) AS rain_actual,
  CAST(count_if(p2 > 0.5) AS BIGINT) AS rain_predicted
FROM lc GROUP BY 1""")
def events_actual_vs_predicted(spark, sf_dir):
    """A19 + J3: actual vs predicted positives per year for two labels, one pass, no join."""
    df = line_classes(spark, sf_dir, with_previous=False).withColumn("p_heat", F.element_at("prob", 2)) \
        .withColumn("p_rain", F.element_at("prob", 3))
    return R.actual_vs_predicted_events(df, F.year("l_shipdate"),
                                        [("heat", "target_heatwave", "p_heat"), ("rain", "target_rain", "p_rain")])


@register("class_by_year", f"""
WITH {LINE_CLASSES_CTE}
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST({_argmax_sql()} AS INTEGER) AS arg, count(*) AS count,
  {CLASS_NAMES_SQL}[{_argmax_sql()} + 1] AS class_name
FROM lc GROUP BY 1, 2, 4""")
def class_by_year(spark, sf_dir):
    """A20 (+J4, F17): predicted class counts by year with class names."""
    df = line_classes(spark, sf_dir, with_previous=False).withColumn("arg", array_argmax(F.col("prob")))
    return R.count_by_class(df, F.year("l_shipdate"), "arg")


_YEARLY_SQL = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, c_nationkey, avg(o_totalprice) AS mean_price
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2"""


def _yearly(spark, sf_dir):
    o = B.table(spark, sf_dir, "orders")
    c = B.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    df = o.join(c, o.o_custkey == c.c_custkey)
    return R.mean_by(df, [F.year("o_orderdate").alias("year"), F.col("c_nationkey")], "o_totalprice", "mean_price")


@register("yearly_mean_by_entity", rsig(_YEARLY_SQL, ["mean_price"]))
def yearly_mean_by_entity(spark, sf_dir):
    """Mean by (year, entity)."""
    return _yearly(spark, sf_dir)


@register("trend_projection", rsig(f"""
WITH y AS ({_YEARLY_SQL}),
f AS (SELECT c_nationkey, regr_slope(mean_price, year) AS slope, regr_intercept(mean_price, year) AS intercept,
             max(year) AS xmax FROM y GROUP BY 1)
SELECT c_nationkey, CAST(xmax + h AS INTEGER) AS year, slope, intercept, intercept + slope * (xmax + h) AS projected,
  intercept + slope * (xmax + h) - 1.5 AS projected_lo, intercept + slope * (xmax + h) + 1.5 AS projected_hi
FROM f, range(2) t(h)""", ["slope", "intercept", "projected", "projected_lo", "projected_hi"], 4))
def trend_projection(spark, sf_dir):
    """Per-entity linear trend over yearly means, projected to the last and next year ± 1.5."""
    return rounded(R.linear_trend_projection(_yearly(spark, sf_dir), "c_nationkey", "year", "mean_price"), 4)


# ------------------------------------------------------------ attribution ranking

FEATURES_FOR_RANKING = ["value", "value_lag_1", "value_lag_2", "value_lag_3", "value_roll_3r_mean",
                        "value_roll_3r_std", "value_roll_24r_mean", "value_roll_24r_std", "hour", "day",
                        "day_of_week", "day_of_year", "is_weekend"]


def _ranking_table(spark, sf_dir):
    """Mean absolute linear attribution per feature: |slope(y ~ x)| · mean|x − mean(x)|.

    y = next value of the same user. Two passes of one aggregation each; the
    long (feature, importance) table is derived without touching rows again.
    """
    from chronoframe.plans.q_panel import feature_table
    ft = feature_table(spark, sf_dir)
    ft = B.table(spark, sf_dir, "events").select("event_id", "ts").join(ft, "event_id")
    ft = P.next_value_target(ft, B.USER_PANEL, "value", "y", layout="entity")
    # two passes (means, then slopes / deviations) over an expensive derived table:
    # materialise it once in the shared checkpoint folder instead of recomputing it
    ft = ft.where(F.col("y").isNotNull()).select("y", *FEATURES_FOR_RANKING).checkpoint(eager=True)
    feats = FEATURES_FOR_RANKING
    means = ft.agg(*[F.avg(F.col(f).cast("double")).alias(f"m_{f}") for f in feats])
    j = with_scalars(ft, means)
    aggs = []
    for f in feats:
        x = F.col(f).cast("double")
        aggs += [F.regr_slope(F.col("y"), x).alias(f"s_{f}"), F.avg(F.abs(x - F.col(f"m_{f}"))).alias(f"d_{f}")]
    one = j.agg(*aggs)
    items = [F.struct(F.lit(f).alias("feature"),
                      F.coalesce(F.abs(F.col(f"s_{f}")) * F.col(f"d_{f}"), F.lit(0.0)).alias("importance"))
             for f in feats]
    return one.select(F.explode(F.array(*items)).alias("r")).select("r.*")


def _ranking_sql() -> str:
    from chronoframe.plans.q_panel import FEATURE_TABLE_SQL
    feats = FEATURES_FOR_RANKING
    return f"""
WITH ft0 AS ({FEATURE_TABLE_SQL}),
ft1 AS (SELECT ft0.*, e.ts FROM ft0 JOIN events e ON ft0.event_id = e.event_id),
ft AS (SELECT *, lead(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS y FROM ft1),
g AS (SELECT * FROM ft WHERE y IS NOT NULL),
m AS (SELECT {", ".join(f"avg(CAST({f} AS DOUBLE)) AS m_{f}" for f in feats)} FROM g),
a AS (SELECT {", ".join(f"regr_slope(y, CAST({f} AS DOUBLE)) AS s_{f}, avg(abs(CAST({f} AS DOUBLE) - m_{f})) AS d_{f}"
                        for f in feats)} FROM g, m),
imp AS ({" UNION ALL ".join(f"SELECT '{f}' AS feature, coalesce(abs(s_{f}) * d_{f}, 0.0) AS importance FROM a"
                            for f in feats)})"""


def _category_sql(col: str) -> str:
    return (f"CASE WHEN {col} LIKE '%lag_24%' OR {col} LIKE '%lag_48%' OR {col} LIKE '%lag_72%' THEN 'Lag Features' "
            f"WHEN {col} LIKE '%roll%' THEN 'Rolling Features' "
            f"WHEN {col} IN ('hour', 'day', 'month', 'year', 'season', 'is_weekend', 'day_of_week', 'day_of_year') "
            f"THEN 'Time Features' "
            f"WHEN {col} IN ('latitude', 'longitude', 'coastal', 'city_id', 'continent_id', 'climate_zone_id') "
            f"THEN 'Geographic' ELSE 'Raw Weather' END")


@register("top_features", rsig(f"""{_ranking_sql()}
SELECT feature, round_even(importance, 4) AS importance, category FROM (
  SELECT *, {_category_sql("feature")} AS category FROM imp ORDER BY importance DESC, feature LIMIT 10)""",
    ["importance"]))
def top_features(spark, sf_dir):
    """L9 + O3 + F15: top-10 features by mean absolute attribution with their category."""
    from chronoframe.functions.scalar import feature_category
    imp = _ranking_table(spark, sf_dir)
    top = imp.orderBy(F.col("importance").desc(), F.col("feature")).limit(10)  # top-k is the feature
    return top.select("feature", F.bround("importance", 4).alias("importance"),
                      feature_category(F.col("feature")).alias("category"))


@register("importance_by_category", rsig(f"""{_ranking_sql()}
SELECT {_category_sql("feature")} AS category, sum(importance) AS importance FROM imp GROUP BY 1""", ["importance"]))
def importance_by_category(spark, sf_dir):
    """Importance summed by feature category."""
    return R.importance_by_category(_ranking_table(spark, sf_dir))


_RANK_SQL = _grouped_sql("c_nationkey", "c_nationkey", "test_rows", "JOIN customer ON pr.o_custkey = c_custkey")


@register("rank_report", f"""
SELECT *, row_number() OVER (ORDER BY rmse, c_nationkey) AS rank FROM ({_RANK_SQL}) AS rr""")
def rank_report(spark, sf_dir):
    """W13 + O2: rank column 1..n on the per-entity report sorted by RMSE.

    The report has one row per entity, so the rank uses the distributed row
    index rather than a single-task ``Window.orderBy``.
    """
    from chronoframe.operators.ordered import global_row_index
    from chronoframe.plans.q_metrics import regression_by_entity
    rep = regression_by_entity(spark, sf_dir)
    return global_row_index(rep, ["rmse", "c_nationkey"], out="rank").withColumn("rank", F.col("rank") + 1)


@register("event_presence", f"""
WITH {LINE_CLASSES_NATION_CTE},
r AS (SELECT n_name, avg(CAST(target_heatwave AS DOUBLE)) * 100 AS pct FROM lc GROUP BY n_name)
SELECT CAST(count_if(pct > 0) AS BIGINT) AS with_events, CAST(count_if(pct = 0) AS BIGINT) AS without_events FROM r""")
def event_presence(spark, sf_dir):
    """Entities with and without positive events in a per-entity report."""
    parts = R.label_partials(B.lineitem_labels(spark, sf_dir), "l_suppkey", [("heat", "target_heatwave")],
                             "target_disaster", [])  # per supplier first, then the dimension join
    dims = B.supplier_nation(spark, sf_dir)
    j = parts.join(dims, parts.l_suppkey == dims.s_suppkey)
    r = j.groupBy("n_name").agg((F.sum("_l_heat") / F.sum("_n") * 100).alias("pct"))
    return r.agg(F.count_if(F.col("pct") > 0).alias("with_events"), F.count_if(F.col("pct") == 0).alias("without_events"))


@register("preview_head", rsig(f"""
SELECT l_orderkey, {", ".join(c for c in LINE_ORDER if c != "l_shipdate")},
  strftime(l_shipdate, {_TS}) AS l_shipdate, l_discount FROM lineitem
ORDER BY l_orderkey, {", ".join(LINE_ORDER)} LIMIT 500""", ["l_quantity", "l_extendedprice", "l_discount"]))
def preview_head(spark, sf_dir):
    """A 500-row preview in an explicit order (the limit is the feature); timestamps as text."""
    li = B.table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_ORDER, "l_discount")
    top = li.orderBy("l_orderkey", *LINE_ORDER).limit(500)
    return top.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))


@register("seeded_sample", """
SELECT event_id, user_id, event_type, value FROM events
ORDER BY md5(concat('42-', CAST(event_id AS VARCHAR))), event_id LIMIT 2000""")
def seeded_sample(spark, sf_dir):
    """Exact-n deterministic sample (n = 2000, seed 42) — the rows of least keyed md5."""
    ev = B.table(spark, sf_dir, "events")
    key = F.md5(F.concat(F.lit("42-"), F.col("event_id").cast("string")))
    return ev.orderBy(key, F.col("event_id")).limit(2000).select("event_id", "user_id", "event_type", "value")


_PAYLOAD = "hourly struct<time: array<string>, event_id: array<bigint>, value: array<double>>"


@register("payload_arrays", """
SELECT user_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS time, event_id, value FROM events""")
def payload_arrays(spark, sf_dir):
    """Documents of parallel arrays (one per user and day, as JSON text) parsed back to one row per time:
    ``from_json`` with an explicit schema, ``arrays_zip``, ``explode``."""
    ev = B.table(spark, sf_dir, "events")
    one = F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("time"), "event_id", "value")
    docs = ev.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.sort_array(F.collect_list(one)).alias("r"))
    arrays = F.struct(*[F.col(f"r.{c}").alias(c) for c in ("time", "event_id", "value")])
    text = docs.select("user_id", F.to_json(F.struct(arrays.alias("hourly"))).alias("payload"))
    h = text.select("user_id", F.from_json("payload", _PAYLOAD)["hourly"].alias("h"))
    rows = h.select("user_id", F.explode(F.arrays_zip(F.col("h.time"), F.col("h.event_id"), F.col("h.value"))).alias("r"))
    return rows.select("user_id", "r.time", "r.event_id", "r.value")


_PROPS = StructType([StructField("k", IntegerType())])


@register("json_payload", rsig("""
SELECT event_type, count(*) AS events, CAST(sum(CAST(json_extract(props, '$.k') AS INTEGER)) AS BIGINT) AS k_sum,
  avg(CAST(json_extract(props, '$.k') AS INTEGER)) AS k_mean FROM events GROUP BY event_type""", ["k_mean"]))
def json_payload(spark, sf_dir):
    """JSON payload column parsed with an explicit schema (no inference) and aggregated."""
    ev = B.table(spark, sf_dir, "events").withColumn("p", F.from_json("props", _PROPS))
    return ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"), F.sum("p.k").alias("k_sum"),
                                        F.avg("p.k").alias("k_mean"))
