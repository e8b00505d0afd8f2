"""The same queries over whole tables with faults put in by rule: NULLs, NaN, repeated keys, unmatched keys, an empty entity.

``DirtyDir`` marks a table folder; :func:`chronoframe.plans.bindings.table`
passes its tables through :func:`soil`. The SQL side puts the same faults in
with CTEs of the tables' names in front of the unchanged oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoframe.plans.bindings import DirtyDir
from chronoframe.plans.catalog import ORACLE, QUERIES, register

COPY_OFFSET = 1_000_000_000
_NULLS = {"l_quantity": (7, 0), "l_extendedprice": (11, 3), "l_discount": (13, 5), "l_tax": (17, 2)}


def soil(df: DataFrame, name: str) -> DataFrame:
    """The table with its faults; other tables come back as they are."""
    if name == "lineitem":        # NULL measures
        return df.withColumns({c: F.when(F.col("l_orderkey") % m != r, F.col(c)) for c, (m, r) in _NULLS.items()})
    if name == "supplier":        # nation 3 loses its suppliers: an entity without rows
        return df.withColumn("s_nationkey", F.when(F.col("s_nationkey") == 3, F.lit(4).cast(df.schema["s_nationkey"].dataType)).otherwise(F.col("s_nationkey")))
    if name == "customer":        # orders without a customer
        return df.where(F.col("c_custkey") % 19 != 0)
    if name == "events":          # NULL and NaN values, repeated (user, time) keys with a later ordinal
        v = F.when(F.col("event_id") % 29 == 0, F.lit(float("nan"))).when(F.col("event_id") % 17 != 0, F.col("value"))
        copies = df.where(F.col("event_id") % 13 == 0).withColumns({"event_id": F.col("event_id") + COPY_OFFSET, "value": F.col("value") + 1})
        return df.withColumn("value", v).unionByName(copies)
    return df


_CTES = f"""WITH lineitem AS (SELECT * REPLACE ({", ".join(f"CASE WHEN l_orderkey % {m} <> {r} THEN {c} END AS {c}" for c, (m, r) in _NULLS.items())})
  FROM main.lineitem),
supplier AS (SELECT * REPLACE (CASE WHEN s_nationkey = 3 THEN 4 ELSE s_nationkey END AS s_nationkey) FROM main.supplier),
customer AS (SELECT * FROM main.customer WHERE c_custkey % 19 <> 0),
events AS (SELECT * REPLACE (CASE WHEN event_id % 29 <> 0 AND event_id % 17 <> 0 THEN value END AS value) FROM main.events
  UNION ALL SELECT * REPLACE (event_id + {COPY_OFFSET} AS event_id, value + 1 AS value) FROM main.events WHERE event_id % 13 = 0)
"""


def _register(name: str, as_double: tuple = ()) -> None:
    """``as_double``: counts that are NULL for an empty entity, given as doubles on both sides (a NULL has no place in numpy's integers)."""
    clean = QUERIES[name]

    def run(spark, sf_dir):
        out = clean(spark, DirtyDir(sf_dir))
        return out.withColumns({c: F.col(c).cast("double") for c in as_double})
    run.__name__, run.__doc__ = f"{name}_dirty", f"{clean.__doc__} Over tables with faults."
    columns = "*" + (f" REPLACE ({', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in as_double)})" if as_double else "")
    register(f"{name}_dirty", f"{_CTES} SELECT {columns} FROM ({ORACLE[name]}) AS q")(run)


_register("quality_report", ("expected_rows", *(f"{kind}_{v}" for kind in ("missing", "outliers") for v in _NULLS)))
for _name in ("feature_table", "feature_table_chunked", "quality_summary", "label_distribution", "label_totals",
              "class_frequency", "dimension_lookup"):
    _register(_name)
