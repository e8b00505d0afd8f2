"""Label queries on the ``lineitem`` binding."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoframe.config import CLASS_NAMES
from chronoframe.operators import rollups as R
from chronoframe.operators.splits import split_label, split_predicate
from chronoframe.plans import bindings as B
from chronoframe.plans.catalog import register
from chronoframe.plans.sqlgen import CLASS_NAMES_SQL, LINEITEM_LABELS, LINEITEM_PANEL, SPLIT_EXPR, rsig

LABELS = [("rain", "target_rain"), ("heatwave", "target_heatwave"), ("storm", "target_storm")]
CLASSES = [(0, "normal"), (1, "heatwave"), (2, "rain"), (3, "storm")]


def _split(df):
    return df.withColumn("split", split_label(F.year("l_shipdate"), B.SPLIT_TRAIN, B.SPLIT_VAL, B.SPLIT_TEST))


def _train(spark, sf_dir):
    """Training-split lines; the date range reaches the Parquet scan (PushedFilters)."""
    df = B.lineitem_labels(spark, sf_dir)
    return _split(df.where(split_predicate(df, "l_shipdate", ["train"], B.SPLIT_TRAIN, B.SPLIT_VAL, B.SPLIT_TEST)))


_pct_cols = [f"{n}_pct" for n, _ in LABELS] + [f"disaster_{c}_pct" for _, c in CLASSES]
LABEL_DISTRIBUTION_SQL = rsig(f"""
WITH {LINEITEM_PANEL}
SELECT n_name, min(r_name) AS r_name, min(heatwave_threshold) AS heatwave_threshold_C,
  count(*) AS total_hours,
  {", ".join(f"CAST(sum({c}) AS BIGINT) AS {n}_hours, round_even(avg(CAST({c} AS DOUBLE)) * 100, 2) AS {n}_pct"
             for n, c in LABELS)},
  {", ".join(f"round_even(avg(CAST(target_disaster = {k} AS DOUBLE)) * 100, 2) AS disaster_{c}_pct"
             for k, c in CLASSES)}
FROM lab GROUP BY n_name""", ["heatwave_threshold_C"] + _pct_cols)


@register("label_distribution", LABEL_DISTRIBUTION_SQL)
def label_distribution(spark, sf_dir):
    """A10: per-entity label counts / percentages and class shares.

    The facts are pre-aggregated per supplier (decomposable sums) before the
    supplier → nation join, so the join and the final shuffle carry one row
    per supplier, not one per line.
    """
    parts = R.label_partials(B.lineitem_labels(spark, sf_dir), "l_suppkey", LABELS, "target_disaster", CLASSES,
                             threshold_col="heatwave_threshold")
    dims = B.supplier_nation(spark, sf_dir)
    j = parts.join(dims, parts.l_suppkey == dims.s_suppkey)
    return R.label_distribution_from_partials(j, "n_name", LABELS, CLASSES, attrs=["r_name"])


@register("label_totals", rsig(f"""
WITH {LINEITEM_LABELS}
{" UNION ALL ".join(f"SELECT '{n}' AS label, CAST(sum({c}) AS BIGINT) AS positives, "
                    f"CAST(sum({c}) AS DOUBLE) / count(*) * 100 AS positive_pct FROM lab" for n, c in LABELS)}
""", ["positive_pct"]))
def label_totals(spark, sf_dir):
    """Positives and rate per label."""
    return R.label_totals(B.lineitem_labels(spark, sf_dir), LABELS)


@register("class_frequency", rsig(f"""
WITH {LINEITEM_LABELS},
s AS (SELECT *, {SPLIT_EXPR.format(c="l_shipdate")} AS split FROM lab),
g AS (SELECT DISTINCT split FROM s),
c AS (SELECT CAST(range AS INTEGER) AS target_disaster FROM range(4)),
cnt AS (SELECT split, target_disaster, count(*) AS n FROM s GROUP BY split, target_disaster)
SELECT g.split, c.target_disaster, {CLASS_NAMES_SQL}[c.target_disaster + 1] AS class_name,
  CAST(coalesce(cnt.n, 0) AS BIGINT) AS count,
  coalesce(cnt.n, 0) / sum(coalesce(cnt.n, 0)) OVER (PARTITION BY g.split) * 100 AS share_pct
FROM g CROSS JOIN c LEFT JOIN cnt ON cnt.split = g.split AND cnt.target_disaster = c.target_disaster
""", ["share_pct"]))
def class_frequency(spark, sf_dir):
    """Zero-filled class counts and shares per split."""
    return R.class_frequency(_split(B.lineitem_labels(spark, sf_dir)), "target_disaster", 4, CLASS_NAMES, ["split"])


@register("class_balance", rsig(f"""
WITH {LINEITEM_LABELS},
s AS (SELECT * FROM lab WHERE {SPLIT_EXPR.format(c="l_shipdate")} = 'train')
SELECT CAST(count_if(target_rain = 0) AS BIGINT) AS negatives, CAST(count_if(target_rain = 1) AS BIGINT) AS positives,
  count_if(target_rain = 0) / greatest(count_if(target_rain = 1), 1) AS scale_pos_weight FROM s
""", ["scale_pos_weight"]))
def class_balance(spark, sf_dir):
    """Class balance and positive weight on the training split."""
    return R.class_balance(_train(spark, sf_dir), "target_rain")


@register("class_weights", rsig(f"""
WITH {LINEITEM_LABELS},
s AS (SELECT * FROM lab WHERE {SPLIT_EXPR.format(c="l_shipdate")} = 'train'),
c AS (SELECT target_disaster, count(*) AS cnt FROM s GROUP BY target_disaster),
w AS (SELECT target_disaster, cnt, sum(cnt) OVER () / (count(*) OVER () * cnt) AS weight FROM c)
SELECT w.target_disaster, CAST(w.cnt AS BIGINT) AS count, w.weight, sum(w.weight) AS weight_sum
FROM s JOIN w ON s.target_disaster = w.target_disaster GROUP BY w.target_disaster, w.cnt, w.weight
""", ["weight", "weight_sum"]))
def class_weights(spark, sf_dir):
    """A12 + J5: balanced class weights, applied back to the rows."""
    train = _train(spark, sf_dir)
    w = R.balanced_class_weights(train, "target_disaster")
    rows = R.apply_class_weights(train, "target_disaster", w)
    return rows.groupBy("target_disaster").agg(F.sum("weight").alias("weight_sum")) \
               .join(w, "target_disaster").select("target_disaster", "count", "weight", "weight_sum")


@register("positives_by_entity", f"""
WITH {LINEITEM_PANEL}
SELECT n_name, count(*) AS count FROM lab WHERE target_heatwave = 1 GROUP BY n_name""")
def positives_by_entity(spark, sf_dir):
    """Heat positives per entity (per-supplier counts first, then the dimension join)."""
    per_supp = R.positives_by_entity(B.lineitem_labels(spark, sf_dir), "l_suppkey", "target_heatwave")
    dims = B.supplier_nation(spark, sf_dir)
    j = per_supp.join(dims, per_supp.l_suppkey == dims.s_suppkey)
    return j.groupBy("n_name").agg(F.sum("count").cast("long").alias("count"))


@register("exceedance_by_year", f"""
WITH {LINEITEM_LABELS}
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(sum(CAST(l_extendedprice >= heatwave_threshold AS INTEGER)) AS BIGINT) AS hours
FROM lab GROUP BY 1""")
def exceedance_by_year(spark, sf_dir):
    """Threshold exceedances per year."""
    df = B.lineitem_labels(spark, sf_dir)
    return R.exceedance_by_period(df, "l_extendedprice", F.col("heatwave_threshold"), F.year("l_shipdate"))
