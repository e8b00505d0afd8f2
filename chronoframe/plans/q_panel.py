"""Panel queries: cleaning + features, calendar, splits, folds, encodings, per-entity windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoframe.config import FeatureSpec, PanelSpec
from chronoframe.functions.calendar import calendar_columns, month_name, season_name
from chronoframe.operators import clean as C
from chronoframe.operators import panel as P
from chronoframe.operators import rollups as R
from chronoframe.operators import splits as S
from chronoframe.operators.encode import encode_columns, fit_encoders, lookup_with_default
from chronoframe.operators.profile import correlation_matrix
from chronoframe.plans import bindings as B
from chronoframe.plans.catalog import register, rounded
from chronoframe.plans.sqlgen import (LINEITEM_PANEL, MONTH_NAMES_SQL, SEASON_NAMES_SQL, SPLIT_EXPR, calendar_sql, rsig,
                                      season_sql,
                                      window_features_sql)

TIE_DIGITS = 9   # of registered feature tables: sums of two-decimal inputs end in exact ties


def _dedup_fill_sql(part: str, order: str, v: str, extra_cols: str) -> str:
    return f"""
d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {part}, ts ORDER BY event_id) AS _rn FROM events)
      WHERE _rn = 1),
f AS (SELECT {extra_cols}, ts,
  coalesce(last_value({v} IGNORE NULLS) OVER (PARTITION BY {part} ORDER BY {order}
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           first_value({v} IGNORE NULLS) OVER (PARTITION BY {part} ORDER BY {order}
                                               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {v}
  FROM d)"""


_uf_items, _uf_names = window_features_sql("value", "user_id", "ts, event_id", B.USER_FEATURES.lags,
                                           B.USER_FEATURES.windows)
FEATURE_TABLE_SQL = rsig(f"""
WITH {_dedup_fill_sql("user_id", "ts, event_id", "value", "event_id, user_id, event_type")}
SELECT event_id, user_id, event_type, value, {_uf_items}, {calendar_sql("ts")},
  {season_sql("month(ts)")} AS season
FROM f""", ["value"] + _uf_names)


@register("feature_table", FEATURE_TABLE_SQL)
def feature_table(spark, sf_dir, layout="entity", chunk_rows=B.PANEL_CHUNK_ROWS, keep_ts=False):
    """W1–W5 + F2–F4: dedup, fill, lags, rolling mean/std and calendar features (users are small: one window task each)."""
    ev = B.table(spark, sf_dir, "events").drop("props")
    ev = C.nan_to_null(ev, ["value"])
    f = P.panel_features(ev, B.USER_PANEL, B.USER_FEATURES, fill_cols=["value"], dedup_ordinal="event_id",
                         layout=layout, chunk_rows=chunk_rows, rolling=B.ROLLING_METHOD)
    f = f.withColumns(calendar_columns("ts"))
    return f if keep_ts else f.drop("ts")


@register("feature_table_chunked", FEATURE_TABLE_SQL)
def feature_table_chunked(spark, sf_dir):
    """The same answer from the layout for hot entities, in small chunks."""
    return feature_table(spark, sf_dir, "chunked", B.SMALL_CHUNK_ROWS)


_df_items, _df_names = window_features_sql("value", "event_type", "ts, event_id", B.DEEP_FEATURES.lags,
                                           B.DEEP_FEATURES.windows, "h")


FEATURE_TABLE_DEEP_SQL = rsig(f"""
WITH {_dedup_fill_sql("event_type", "ts, event_id", "value", "event_id, event_type")}
SELECT event_id, event_type, value, {_df_items} FROM f""", ["value"] + _df_names, TIE_DIGITS)


@register("feature_table_deep", FEATURE_TABLE_DEEP_SQL)
def feature_table_deep(spark, sf_dir, chunk_rows=B.PANEL_CHUNK_ROWS):
    """W3–W5 with the weather sizes (lags 24/48/72 h, windows 24 / 168 rows) on deep entities.

    Chunked layout: each entity is cut into chunks with a 167-row halo, so even
    five huge entities spread over many tasks.
    """
    ev = B.table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    f = P.panel_features(ev, B.TYPE_PANEL, B.DEEP_FEATURES, fill_cols=["value"], dedup_ordinal="event_id",
                         layout="chunked", chunk_rows=chunk_rows, rolling=B.ROLLING_METHOD)
    return rounded(f.drop("ts"), TIE_DIGITS)


@register("feature_table_deep_chunked", FEATURE_TABLE_DEEP_SQL)
def feature_table_deep_chunked(spark, sf_dir):
    """The same answer in small chunks."""
    return feature_table_deep(spark, sf_dir, B.SMALL_CHUNK_ROWS)


@register("calendar_features", f"""
SELECT o_orderkey, {calendar_sql("o_orderdate")},
  CASE WHEN c_nationkey < {B.SOUTH_NATION_BELOW} THEN CAST(({season_sql("month(o_orderdate)")} + 2) % 4 AS INTEGER)
       ELSE {season_sql("month(o_orderdate)")} END AS season,
  {SEASON_NAMES_SQL}[{season_sql("month(o_orderdate)")} + 1] AS season_name,
  {MONTH_NAMES_SQL}[month(o_orderdate)] AS month_name,
  strftime(date_trunc('month', o_orderdate), '%Y-%m-%d %H:%M:%S') AS month_start
FROM orders JOIN customer ON o_custkey = c_custkey""")
def calendar_features(spark, sf_dir):
    """F2–F8: calendar features with the hemisphere flip, season / month names, month bucket."""
    o = B.table(spark, sf_dir, "orders")
    c = B.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    df = o.join(c, o.o_custkey == c.c_custkey)
    cols = calendar_columns("o_orderdate", southern=F.col("c_nationkey") < B.SOUTH_NATION_BELOW)
    m = F.month("o_orderdate")
    cols.update({"season_name": season_name(m), "month_name": month_name(m),
                 "month_start": F.date_format(F.date_trunc("month", "o_orderdate"), "yyyy-MM-dd HH:mm:ss")})
    return df.select("o_orderkey", *[c.alias(n) for n, c in cols.items()])


@register("split_counts", f"""
SELECT {SPLIT_EXPR.format(c="l_shipdate")} AS split, count(*) AS rows,
  CAST(min(year(l_shipdate)) AS INTEGER) AS first_year, CAST(max(year(l_shipdate)) AS INTEGER) AS last_year
FROM lineitem GROUP BY 1""")
def split_counts(spark, sf_dir):
    """W12 + P8: chronological split label and the size of each split."""
    li = S.with_split(B.table(spark, sf_dir, "lineitem"), "l_shipdate", train=B.SPLIT_TRAIN, val=B.SPLIT_VAL,
                      test=B.SPLIT_TEST)
    return li.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.min(F.year("l_shipdate")).alias("first_year"),
                                   F.max(F.year("l_shipdate")).alias("last_year"))


@register("cv_folds", """
WITH i AS (SELECT row_number() OVER (ORDER BY o_custkey, o_orderdate, o_orderkey) - 1 AS row_idx,
                  count(*) OVER () AS n FROM orders),
s AS (SELECT row_idx, floor(n / 6) AS test, n - 5 * floor(n / 6) AS first FROM i),
g AS (SELECT row_idx, CAST(CASE WHEN row_idx < first THEN -1 ELSE floor((row_idx - first) / test) END AS INTEGER) AS test_fold,
             test, first FROM s)
SELECT test_fold, count(*) AS rows, CAST(min(row_idx) AS BIGINT) AS first_row, CAST(max(row_idx) AS BIGINT) AS last_row,
  CAST(min(first + test_fold * test) AS BIGINT) AS train_end
FROM g GROUP BY test_fold""")
def cv_folds(spark, sf_dir):
    """Expanding-window folds over the positional order (entity, time) of the surveyed system."""
    o = B.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    f = S.assign_cv_folds(o, ["o_custkey", "o_orderdate", "o_orderkey"], k=5)
    return f.groupBy("test_fold").agg(F.count(F.lit(1)).alias("rows"), F.min("row_idx").alias("first_row"),
                                      F.max("row_idx").alias("last_row"), F.min("train_end").alias("train_end"))


@register("category_codes", """
WITH c AS (SELECT c_custkey, c_mktsegment, n_name, r_name FROM customer
           JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
a AS (SELECT n_name, CAST(dense_rank() OVER (ORDER BY n_name) - 1 AS INTEGER) AS nation_id FROM (SELECT DISTINCT n_name FROM c)),
b AS (SELECT r_name, CAST(dense_rank() OVER (ORDER BY r_name) - 1 AS INTEGER) AS region_id FROM (SELECT DISTINCT r_name FROM c)),
s AS (SELECT c_mktsegment, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS segment_id
      FROM (SELECT DISTINCT c_mktsegment FROM c))
SELECT c_custkey, nation_id, region_id, segment_id FROM c JOIN a USING (n_name) JOIN b USING (r_name)
  JOIN s USING (c_mktsegment)""")
def category_codes(spark, sf_dir):
    """Alphabetical codes for three categorical columns."""
    c = B.table(spark, sf_dir, "customer").join(F.broadcast(B.nation_dim(spark, sf_dir)),
                                                F.col("c_nationkey") == F.col("n_nationkey"))
    e = encode_columns(c, {"n_name": "nation_id", "r_name": "region_id", "c_mktsegment": "segment_id"})
    return e.select("c_custkey", "nation_id", "region_id", "segment_id")


@register("dimension_lookup", rsig("""
SELECT o_orderkey, CAST(coalesce(c_nationkey, -1) AS INTEGER) AS c_nationkey,
  coalesce(c_mktsegment, 'UNKNOWN') AS c_mktsegment, coalesce(c_acctbal, 0.0) AS c_acctbal
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""", ["c_acctbal"]))
def dimension_lookup(spark, sf_dir):
    """Dictionary lookup with defaults for unknown keys."""
    o = B.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    dim = B.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    out = lookup_with_default(o, dim, "c_custkey", {"c_nationkey": -1, "c_mktsegment": "UNKNOWN", "c_acctbal": 0.0})
    return out.select("o_orderkey", "c_nationkey", "c_mktsegment", "c_acctbal")


@register("latest_per_entity", rsig("""
SELECT o_custkey, o_orderkey, o_totalprice, o_orderstatus FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1""", ["o_totalprice"]))
def latest_per_entity(spark, sf_dir):
    """Latest row of every entity."""
    o = B.table(spark, sf_dir, "orders")
    return P.latest_per_entity(o, B.ORDER_PANEL).select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")


@register("last_n_per_entity", """
SELECT o_custkey, o_orderkey, CAST(6 - rd AS INTEGER) AS rn FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rd FROM orders)
WHERE rd <= 5""")
def last_n_per_entity(spark, sf_dir):
    """The last 5 rows of every entity in time order."""
    o = B.table(spark, sf_dir, "orders")
    return P.last_n_per_entity(o, B.ORDER_PANEL, 5).select("o_custkey", "o_orderkey", "rn")


@register("first_n_per_entity", """
SELECT o_custkey, o_orderkey, CAST(rn AS INTEGER) AS rn FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
WHERE rn <= 3""")
def first_n_per_entity(spark, sf_dir):
    """The first 3 rows of every entity."""
    o = B.table(spark, sf_dir, "orders")
    return P.first_n_per_entity(o, B.ORDER_PANEL, 3).select("o_custkey", "o_orderkey", F.col("rn").cast("int"))


@register("daily_resample", rsig("""
WITH d AS (SELECT user_id, date_trunc('day', ts) AS dd, avg(value) AS value, count(*) AS rows FROM events GROUP BY 1, 2),
span AS (SELECT user_id, min(dd) AS a, max(dd) AS b FROM d GROUP BY 1),
cal AS (SELECT user_id, unnest(generate_series(a, b, INTERVAL 1 DAY)) AS dd FROM span)
SELECT cal.user_id, strftime(cal.dd, '%Y-%m-%d') AS day, d.value, CAST(coalesce(d.rows, 0) AS BIGINT) AS rows
FROM cal LEFT JOIN d ON cal.user_id = d.user_id AND cal.dd = d.dd""", ["value"]))
def daily_resample(spark, sf_dir):
    """Daily means per entity including empty days."""
    return R.daily_resample(B.table(spark, sf_dir, "events"), "user_id", "ts", "value")


@register("worklist_missing", """
WITH w AS (SELECT c_custkey, CAST(y AS INTEGER) AS year FROM customer, range(1995, 2002) t(y)),
p AS (SELECT DISTINCT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders)
SELECT c_custkey, year FROM w WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.o_custkey = w.c_custkey AND p.year = w.year)""")
def worklist_missing(spark, sf_dir):
    """(entity, year) chunks of the work list that have no data."""
    wl = S.chunk_worklist(B.table(spark, sf_dir, "customer"), "c_custkey", 1995, 2001)
    facts = B.table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return S.missing_chunks(wl, facts, "c_custkey", "o_orderdate")


@register("cache_keys", """
SELECT o_custkey, md5(concat_ws('_', o_custkey, min(year(o_orderdate)), max(year(o_orderdate)), 'o_shippriority,o_totalprice')) AS cache_key
FROM orders GROUP BY o_custkey""")
def cache_keys(spark, sf_dir):
    """md5 cache key of (entity, first year, last year, sorted list of the variables)."""
    variables = ",".join(sorted(["o_totalprice", "o_shippriority"]))
    o = B.table(spark, sf_dir, "orders")
    g = o.groupBy("o_custkey").agg(F.min(F.year("o_orderdate")).alias("a"), F.max(F.year("o_orderdate")).alias("b"))
    return g.select("o_custkey", F.md5(F.concat_ws("_", F.col("o_custkey").cast("string"), F.col("a").cast("string"),
                                                   F.col("b").cast("string"), F.lit(variables))).alias("cache_key"))


@register("sorted_distinct", """
SELECT DISTINCT n_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
ORDER BY n_name""")
def sorted_distinct(spark, sf_dir):
    """O6 + A7: sorted distinct entities present in the facts."""
    return B.lineitem_panel(spark, sf_dir, with_labels=False).select("n_name").distinct().orderBy("n_name")


_TRAIN_SPLIT_SQL = ("CASE WHEN ts < TIMESTAMP '2024-01-20' THEN 'train' WHEN ts < TIMESTAMP '2024-01-25' "
                    "THEN 'val' ELSE 'test' END")


@register("training_rows", f"""
WITH f AS ({FEATURE_TABLE_SQL}),
g AS (SELECT f.*, e.ts FROM f JOIN events e ON f.event_id = e.event_id
      WHERE value_lag_1 IS NOT NULL AND value_lag_2 IS NOT NULL AND value_lag_3 IS NOT NULL)
SELECT {_TRAIN_SPLIT_SQL} AS split, count(*) AS rows, CAST(count(DISTINCT user_id) AS BIGINT) AS entities
FROM g GROUP BY 1""")
def training_rows(spark, sf_dir):
    """P9 + W12: warm-up trim (rows whose lags are not yet defined are dropped), then rows per split."""
    ft = feature_table(spark, sf_dir, keep_ts=True)
    lags = [f"value_lag_{k}" for k in B.USER_FEATURES.lags]
    trimmed = C.drop_null_rows(ft, lags)
    ts = F.col("ts")
    split = F.when(ts < F.lit("2024-01-20").cast("timestamp_ntz"), "train") \
             .when(ts < F.lit("2024-01-25").cast("timestamp_ntz"), "val").otherwise("test")
    return trimmed.groupBy(split.alias("split")).agg(F.count(F.lit(1)).alias("rows"),
                                                     F.count_distinct("user_id").alias("entities"))


# ----------------------------------------------------------------------------- full feature stage
STAGE_VARS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
STAGE_FEATURES = FeatureSpec(variables=STAGE_VARS)  # weather sizes: lags 24/48/72, windows 24 / 168 rows
STAGE_TIEBREAK = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"]


def feature_stage_frame(spark, sf_dir, layout="entity", chunk_rows=B.PANEL_CHUNK_ROWS):
    """The surveyed preprocessing step end to end on ``lineitem`` (entity = supplier):
    fill → lags 24/48/72 and 24/168-row rolling mean/std of four measures → calendar with
    hemisphere flip → rule labels → category codes → split → warm-up trim (P9)."""
    df = B.lineitem_panel(spark, sf_dir)
    codes = {"n_name": "nation_id", "r_name": "region_id"}
    # fitted on the dimension rows that have facts (at most 25): the facts are read for their supplier keys alone
    present = B.supplier_nation(spark, sf_dir).join(B.table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("s_suppkey")).distinct(),
                                                    "s_suppkey", "left_semi").select(*codes).distinct()
    encoders = {c: F.broadcast(e) for c, e in fit_encoders(present, codes).items()}
    # labels and codes stand in for the texts they come from, so that the shuffle carries numbers alone
    df = encode_columns(df, codes, encoders).drop("l_returnflag", "l_linestatus", *codes)
    if layout == "entity":      # its windows sort again after the fill: by the values as they were
        df, tiebreak = df.withColumn("_tb", F.struct(*STAGE_TIEBREAK)), "_tb"
    else:
        tiebreak = tuple(STAGE_TIEBREAK)
    spec = PanelSpec("l_suppkey", "l_shipdate", tiebreak)
    f = P.panel_features(df, spec, STAGE_FEATURES, fill_cols=list(STAGE_VARS), layout=layout, chunk_rows=chunk_rows,
                         rolling=B.ROLLING_METHOD)
    f = f.withColumns(calendar_columns("l_shipdate", southern=F.col("s_nationkey") < B.SOUTH_NATION_BELOW))
    f = S.with_split(f, "l_shipdate", train=B.SPLIT_TRAIN, val=B.SPLIT_VAL, test=B.SPLIT_TEST)
    f = C.drop_null_rows(f, [f"{v}_lag_72h" for v in STAGE_VARS])
    last = [*codes.values(), "split"]
    return f.select(*[c for c in f.columns if c not in ("_tb", "l_shipdate", "s_nationkey", *last)], *last)


def _stage_sql() -> str:
    part, order = "l_suppkey", "l_shipdate, " + ", ".join(STAGE_TIEBREAK)
    fills = ", ".join(
        f"coalesce(last_value({v} IGNORE NULLS) OVER (PARTITION BY {part} ORDER BY {order} "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value({v} IGNORE NULLS) OVER "
        f"(PARTITION BY {part} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS f_{v}"
        for v in STAGE_VARS)
    items, names = [], []
    for v in STAGE_VARS:
        it, nm = window_features_sql(f"f_{v}", part, order, STAGE_FEATURES.lags, {}, "h")
        items.append(it.replace(f"f_{v}_lag", f"{v}_lag"))
        names += [n.replace(f"f_{v}_lag", f"{v}_lag") for n in nm]
    for v in STAGE_VARS:
        it, nm = window_features_sql(f"f_{v}", part, order, (), STAGE_FEATURES.windows, "h")
        items.append(it.replace(f"f_{v}_roll", f"{v}_roll"))
        names += [n.replace(f"f_{v}_roll", f"{v}_roll") for n in nm]
    season = season_sql("month(l_shipdate)")
    sql = f"""
WITH {LINEITEM_PANEL},
f0 AS (SELECT *, {fills} FROM lab),
f1 AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, s_nationkey, n_name, r_name,
  {", ".join(f"f_{v} AS {v}" for v in STAGE_VARS)}, f_l_discount, f_l_tax, f_l_quantity, f_l_extendedprice,
  heatwave_threshold, target_rain, target_heatwave, target_storm, target_disaster, {", ".join(items)}
  FROM f0),
a AS (SELECT n_name, CAST(dense_rank() OVER (ORDER BY n_name) - 1 AS INTEGER) AS nation_id FROM (SELECT DISTINCT n_name FROM f1)),
b AS (SELECT r_name, CAST(dense_rank() OVER (ORDER BY r_name) - 1 AS INTEGER) AS region_id FROM (SELECT DISTINCT r_name FROM f1))
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {", ".join(STAGE_VARS)}, heatwave_threshold,
  target_rain, target_heatwave, target_storm, target_disaster, {", ".join(names)}, {calendar_sql("l_shipdate")},
  CASE WHEN s_nationkey < {B.SOUTH_NATION_BELOW} THEN CAST(({season} + 2) % 4 AS INTEGER) ELSE {season} END AS season,
  nation_id, region_id, {SPLIT_EXPR.format(c="l_shipdate")} AS split
FROM f1 JOIN a USING (n_name) JOIN b USING (r_name)
WHERE {" AND ".join(f"{v}_lag_72h IS NOT NULL" for v in STAGE_VARS)}"""
    return rsig(sql, list(STAGE_VARS) + ["heatwave_threshold"] + names, TIE_DIGITS)


@register("feature_stage", _stage_sql())
def feature_stage(spark, sf_dir):
    """The whole preprocessing stage (W2–W5, F2–F5, F9–F13, W7, W12, P9) as one plan."""
    return rounded(feature_stage_frame(spark, sf_dir), TIE_DIGITS)


@register("feature_stage_chunked", _stage_sql())
def feature_stage_chunked(spark, sf_dir):
    """The same stage in the layout for hot entities, in small chunks."""
    return rounded(feature_stage_frame(spark, sf_dir, "chunked", B.SMALL_CHUNK_ROWS), TIE_DIGITS)


#: Model inputs of the stage: 49 columns, as many as the surveyed feature table has.
WIDE_COLS = (*STAGE_VARS, *[f"{v}_lag_{k}h" for v in STAGE_VARS for k in STAGE_FEATURES.lags],
             *[f"{v}_roll_{w}_{s}" for v in STAGE_VARS for w in STAGE_FEATURES.windows for s in ("mean", "std")],
             "hour", "day", "day_of_week", "month", "year", "day_of_year", "is_weekend", "season", "nation_id", "region_id",
             "heatwave_threshold", "target_rain", "target_heatwave", "target_storm", "target_disaster", "l_linenumber", "l_partkey")


def _wide_sql() -> str:
    n = len(WIDE_COLS)
    pair = {(i, j): f"c{i}_{j}" for i in range(n) for j in range(i + 1, n)}
    items = [f"CASE WHEN stddev_pop({WIDE_COLS[i]}) > 1e-9 AND stddev_pop({WIDE_COLS[j]}) > 1e-9 THEN corr({WIDE_COLS[i]}, {WIDE_COLS[j]}) END AS {k}" for (i, j), k in pair.items()]
    items += [f"CASE WHEN stddev_pop({c}) > 1e-9 THEN 1.0::DOUBLE END AS d{i}" for i, c in enumerate(WIDE_COLS)]
    cells = [f"{{a: '{WIDE_COLS[i]}', b: '{WIDE_COLS[j]}', c: {pair[min(i, j), max(i, j)] if i != j else f'd{i}'}}}" for i in range(n) for j in range(n)]
    return (f"WITH stage AS MATERIALIZED ({_stage_sql()}), one AS (SELECT {', '.join(items)} FROM stage) "
            f"SELECT r.a AS col_a, r.b AS col_b, round(r.c, 6) AS corr FROM (SELECT unnest([{', '.join(cells)}]) AS r FROM one)")


@register("correlation_wide", _wide_sql())
def correlation_wide(spark, sf_dir):
    """A25 over the 49 inputs of the feature stage: 1,176 pairs from one aggregation (six digits: both sides sum in their own order)."""
    stage = feature_stage(spark, sf_dir).select(*WIDE_COLS).checkpoint()       # read twice below: for the means, and for the products
    out = correlation_matrix(stage, WIDE_COLS)
    return out.withColumn("corr", F.round("corr", 6))
