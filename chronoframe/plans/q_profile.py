"""Profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoframe.functions.calendar import season_name
from chronoframe.operators import profile as PR
from chronoframe.operators import rollups as R
from chronoframe.plans import bindings as B
from chronoframe.plans.catalog import register
from chronoframe.plans.sqlgen import SEASON_NAMES_SQL, rsig, season_sql

QVARS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
EXPECTED_ROWS = int(7 * 365.25)  # 7 years of one row per day — the binding's "expected" coverage
_TS = "'%Y-%m-%d %H:%M:%S'"

_LP = """lp AS (SELECT l.*, n_name, r_name FROM lineitem l JOIN supplier ON l_suppkey = s_suppkey
             JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def _fence(v: str) -> str:
    return (f"{v} < q1_{v} - CAST(1.5 AS DOUBLE) * (q3_{v} - q1_{v}) OR "
            f"{v} > q3_{v} + CAST(1.5 AS DOUBLE) * (q3_{v} - q1_{v})")


QUALITY_REPORT_CTE = f"""{_LP},
base AS (SELECT n_name, min(r_name) AS r_name, count(*) AS total_rows, min(l_shipdate) AS t0, max(l_shipdate) AS t1,
  {", ".join(f"count_if({v} IS NULL) AS m_{v}" for v in QVARS)},
  avg(l_extendedprice) AS s_mean, min(l_extendedprice) AS s_min, max(l_extendedprice) AS s_max,
  stddev_samp(l_extendedprice) AS s_std
  FROM lp GROUP BY n_name),
q AS (SELECT n_name, {", ".join(f"quantile_cont({v}, 0.25) AS q1_{v}, quantile_cont({v}, 0.75) AS q3_{v}" for v in QVARS)}
      FROM lp GROUP BY n_name),
o AS (SELECT lp.n_name, {", ".join(f"count_if({_fence(v)}) AS o_{v}" for v in QVARS)}
      FROM lp JOIN q ON lp.n_name = q.n_name GROUP BY lp.n_name),
rep0 AS (SELECT b.n_name, b.r_name, CAST(total_rows AS BIGINT) AS total_rows, CAST({EXPECTED_ROWS} AS BIGINT) AS expected_rows,
  round_even(total_rows / CAST({EXPECTED_ROWS} AS DOUBLE) * 100, 2) AS coverage_pct,
  strftime(t0, {_TS}) AS date_start, strftime(t1, {_TS}) AS date_end,
  {", ".join(f"CAST(m_{v} AS BIGINT) AS missing_{v}, round_even(m_{v} / total_rows * 100, 4) AS missing_{v}_pct"
             for v in QVARS)},
  {", ".join(f"CAST(coalesce(o_{v}, 0) AS BIGINT) AS outliers_{v}" for v in QVARS)},
  round_even(s_mean, 2) AS price_mean, round_even(s_min, 2) AS price_min, round_even(s_max, 2) AS price_max,
  round_even(s_std, 2) AS price_std, 'OK' AS status
  FROM base b LEFT JOIN o ON b.n_name = o.n_name),
rep AS (SELECT * FROM rep0 UNION ALL BY NAME
        SELECT n_name, r_name, CAST(0 AS BIGINT) AS total_rows, 'FAILED' AS status
        FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_name NOT IN (SELECT n_name FROM rep0))"""

_rep_doubles = ["coverage_pct"] + [f"missing_{v}_pct" for v in QVARS] + ["price_mean", "price_min", "price_max",
                                                                       "price_std"]


def _quality_report(spark, sf_dir):
    df = B.lineitem_panel(spark, sf_dir, with_labels=False)
    return PR.quality_report(df, "n_name", "l_shipdate", QVARS, EXPECTED_ROWS, attrs=["r_name"],
                             dimension=B.nation_dim(spark, sf_dir), stats_col="l_extendedprice", stats_prefix="price")


@register("quality_report", rsig(f"WITH {QUALITY_REPORT_CTE} SELECT * FROM rep", _rep_doubles))
def quality_report(spark, sf_dir):
    """A1–A4 + P14: coverage, missing values, IQR outliers and statistics per entity."""
    return _quality_report(spark, sf_dir)


def _first_by(val: str, agg: str) -> str:
    return f"first(n_name ORDER BY {val} {agg}, n_name) FILTER (WHERE status = 'OK')"


@register("quality_summary", rsig(f"""
WITH {QUALITY_REPORT_CTE}
SELECT CAST(count(*) AS BIGINT) AS entities, CAST(count_if(status = 'OK') AS BIGINT) AS ok,
  CAST(count_if(status = 'FAILED') AS BIGINT) AS failed, CAST(sum(total_rows) AS BIGINT) AS total_rows,
  avg(coverage_pct) FILTER (WHERE status = 'OK') AS avg_coverage_pct,
  min(coverage_pct) FILTER (WHERE status = 'OK') AS min_coverage_pct,
  {", ".join(f"avg(missing_{v}_pct) FILTER (WHERE status = 'OK') AS avg_missing_{v}_pct" for v in QVARS)},
  {_first_by("price_mean", "ASC")} AS coldest, min(price_mean) FILTER (WHERE status = 'OK') AS coldest_mean,
  first(n_name ORDER BY price_mean DESC, n_name DESC) FILTER (WHERE status = 'OK') AS hottest,
  max(price_mean) FILTER (WHERE status = 'OK') AS hottest_mean,
  {_first_by("price_min", "ASC")} AS abs_min_entity, min(price_min) FILTER (WHERE status = 'OK') AS abs_min,
  first(n_name ORDER BY price_max DESC, n_name DESC) FILTER (WHERE status = 'OK') AS abs_max_entity,
  max(price_max) FILTER (WHERE status = 'OK') AS abs_max
FROM rep""", ["avg_coverage_pct", "min_coverage_pct"] + [f"avg_missing_{v}_pct" for v in QVARS]
    + ["coldest_mean", "hottest_mean", "abs_min", "abs_max"]))
def quality_summary(spark, sf_dir):
    """A5 + A6: roll-up of the quality report with arg-min / arg-max entities."""
    return PR.quality_summary(_quality_report(spark, sf_dir), "n_name", QVARS, stats_prefix="price")


@register("describe", rsig(" UNION ALL ".join(f"""
SELECT '{v}' AS column_name, count({v}) AS count, avg({v}) AS mean, stddev_samp({v}) AS std, min({v}) AS min,
  quantile_cont({v}, 0.25) AS q25, quantile_cont({v}, 0.5) AS q50, quantile_cont({v}, 0.75) AS q75, max({v}) AS max
FROM lineitem""" for v in QVARS), ["mean", "std", "min", "q25", "q50", "q75", "max"]))
def describe(spark, sf_dir):
    """describe() with exact quantiles."""
    return PR.describe_exact(B.table(spark, sf_dir, "lineitem"), QVARS)


_pairs = [(a, b) for i, a in enumerate(QVARS) for b in QVARS[i + 1:]]


@register("correlation_matrix", rsig(" UNION ALL ".join(
    [f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({a}, {b}) AS corr FROM lineitem" for a, b in _pairs]
    + [f"SELECT '{b}' AS col_a, '{a}' AS col_b, corr({a}, {b}) AS corr FROM lineitem" for a, b in _pairs]
    + [f"SELECT '{a}' AS col_a, '{a}' AS col_b, CASE WHEN stddev_pop({a}) > 0 THEN 1.0::DOUBLE END AS corr "
       f"FROM lineitem" for a in QVARS]), ["corr"]))
def correlation_matrix(spark, sf_dir):
    """Pairwise Pearson correlations, long form."""
    return PR.correlation_matrix(B.table(spark, sf_dir, "lineitem"), QVARS)


@register("histogram", rsig("""
WITH r AS (SELECT min(value) AS lo, max(value) AS hi, (max(value) - min(value)) / 20 AS w FROM events),
b AS (SELECT event_type, CAST(CASE WHEN w > 0 THEN least(floor((value - lo) / w), 19) ELSE 0 END AS INTEGER) AS bin
      FROM events, r WHERE value IS NOT NULL),
cnt AS (SELECT event_type, bin, count(*) AS c FROM b GROUP BY event_type, bin),
grid AS (SELECT event_type, CAST(t.bin AS INTEGER) AS bin, lo, w
         FROM (SELECT DISTINCT event_type FROM events WHERE value IS NOT NULL), range(20) t(bin), r)
SELECT g.event_type, g.bin, lo + g.bin * w AS bin_lo, lo + (g.bin + 1) * w AS bin_hi,
  CAST(coalesce(c, 0) AS BIGINT) AS count,
  coalesce(c, 0) / (sum(coalesce(c, 0)) OVER (PARTITION BY g.event_type) * w) AS density
FROM grid g LEFT JOIN cnt ON g.event_type = cnt.event_type AND g.bin = cnt.bin""", ["bin_lo", "bin_hi", "density"]))
def histogram(spark, sf_dir):
    """Equal-width histogram (20 bins, last bin closed) split by class, with density."""
    return PR.histogram(B.table(spark, sf_dir, "events"), "value", 20, by="event_type")


def _box_sql(src: str, group_expr: str, group_name: str, v: str) -> str:
    return rsig(f"""
WITH s AS (SELECT {group_expr} AS {group_name}, {v} AS v FROM {src} WHERE {v} IS NOT NULL),
q AS (SELECT {group_name}, count(*) AS n, min(v) AS min, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
             quantile_cont(v, 0.75) AS q3, max(v) AS max FROM s GROUP BY {group_name}),
f AS (SELECT *, q1 - CAST(1.5 AS DOUBLE) * (q3 - q1) AS lf, q3 + CAST(1.5 AS DOUBLE) * (q3 - q1) AS uf FROM q)
SELECT f.{group_name}, CAST(f.n AS BIGINT) AS n, f.min, f.q1, f.median, f.q3, f.max,
  min(s.v) FILTER (WHERE s.v >= lf AND s.v <= uf) AS whisker_lo, max(s.v) FILTER (WHERE s.v >= lf AND s.v <= uf) AS whisker_hi,
  CAST(count_if(s.v < lf OR s.v > uf) AS BIGINT) AS outliers
FROM f JOIN s ON f.{group_name} = s.{group_name}
GROUP BY f.{group_name}, f.n, f.min, f.q1, f.median, f.q3, f.max""",
                ["min", "q1", "median", "q3", "max", "whisker_lo", "whisker_hi"])


@register("box_by_season", _box_sql("orders", f"{SEASON_NAMES_SQL}[{season_sql('month(o_orderdate)')} + 1]",
                                    "season_name", "o_totalprice"))
def box_by_season(spark, sf_dir):
    """Box summary by (unflipped) season."""
    o = B.table(spark, sf_dir, "orders").withColumn("season_name", season_name(F.month("o_orderdate")))
    return PR.box_summary(o, "o_totalprice", ["season_name"])


@register("box_by_entity", _box_sql(f"(WITH {_LP} SELECT * FROM lp)", "n_name", "n_name", "l_extendedprice"))
def box_by_entity(spark, sf_dir):
    """Box summary by entity."""
    return PR.box_summary(B.lineitem_panel(spark, sf_dir, with_labels=False), "l_extendedprice", ["n_name"])


@register("headline_counts", f"""
WITH {_LP} SELECT count(*) AS rows, CAST(count(DISTINCT n_name) AS BIGINT) AS entities, CAST(13 AS BIGINT) AS columns FROM lp""")
def headline_counts(spark, sf_dir):
    """Rows, entities and columns of the entity-annotated fact table."""
    df = B.lineitem_panel(spark, sf_dir, with_labels=False).drop("s_nationkey")
    return R.headline_counts(df, "n_name")


@register("minmax_normalise", rsig(f"""
WITH {_LP}, m AS (SELECT n_name, avg(l_extendedprice) AS mean_price FROM lp GROUP BY n_name)
SELECT n_name, mean_price, (mean_price - min(mean_price) OVER ()) / (max(mean_price) OVER () - min(mean_price) OVER () + 1e-10)
  AS mean_price_norm FROM m""", ["mean_price", "mean_price_norm"]))
def minmax_normalise(spark, sf_dir):
    """min–max normalisation of a per-entity measure."""
    m = B.lineitem_panel(spark, sf_dir, with_labels=False).groupBy("n_name").agg(
        F.avg("l_extendedprice").alias("mean_price"))
    return R.minmax_normalise(m, "mean_price")


@register("distinct_entities", "SELECT CAST(count(DISTINCT o_custkey) AS BIGINT) AS n_o_custkey FROM orders")
def distinct_entities(spark, sf_dir):
    """Distinct entity count."""
    return PR.distinct_count(B.table(spark, sf_dir, "orders"), "o_custkey")
