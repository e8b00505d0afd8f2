"""Helpers that write the DuckDB oracle SQL (ANSI SQL text, no Spark)."""

from __future__ import annotations

from collections.abc import Sequence


def rsig(inner: str, double_cols: Sequence[str], digits: int | None = None) -> str:
    """The query as it is (``double_cols`` names its double columns); with ``digits`` these are rounded."""
    if digits is None:
        return inner
    return f"SELECT * REPLACE ({', '.join(f'round({c}, {digits}) AS {c}' for c in double_cols)}) FROM ({inner}) AS q"


LINEITEM_PANEL = """
lp AS (
  SELECT l.*, s.s_nationkey, n.n_name, r.r_name
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey),
lab0 AS (
  SELECT *, CAST(CASE WHEN l_returnflag IN ('R') THEN 95000.0 ELSE 90000.0 END AS DOUBLE) AS heatwave_threshold
  FROM lp),
lab1 AS (
  SELECT *,
    CAST(coalesce(l_discount > 0.05, false) AS INTEGER) AS target_rain,
    CAST(coalesce(l_extendedprice >= heatwave_threshold, false) AS INTEGER) AS target_heatwave,
    CAST(coalesce(l_quantity >= 40.0 AND l_tax >= 0.07, false) AS INTEGER) AS target_storm
  FROM lab0),
lab AS (
  SELECT *, CAST(CASE WHEN target_storm = 1 THEN 3 WHEN target_rain = 1 THEN 2
                      WHEN target_heatwave = 1 THEN 1 ELSE 0 END AS INTEGER) AS target_disaster
  FROM lab1)"""

# the same labels over lineitem alone (queries that do not report by nation)
LINEITEM_LABELS = LINEITEM_PANEL.replace("""
  SELECT l.*, s.s_nationkey, n.n_name, r.r_name
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)""", """
  SELECT l.* FROM lineitem l)""")
assert LINEITEM_LABELS != LINEITEM_PANEL

SPLIT_EXPR = """CASE WHEN year({c}) BETWEEN 1995 AND 1998 THEN 'train' WHEN year({c}) = 1999 THEN 'val'
  WHEN year({c}) BETWEEN 2000 AND 2001 THEN 'test' ELSE 'reserved' END"""

CLASS_NAMES_SQL = "['Normal', 'Heatwave', 'Heavy Rain', 'Storm']"
MONTH_NAMES_SQL = "['Jan', 'Feb', 'Mar', 'Apr', 'May', 'Jun', 'Jul', 'Aug', 'Sep', 'Oct', 'Nov', 'Dec']"
SEASON_NAMES_SQL = "['Winter', 'Spring', 'Summer', 'Autumn']"


def calendar_sql(ts: str) -> str:
    return (f"CAST(hour({ts}) AS INTEGER) AS hour, CAST(day({ts}) AS INTEGER) AS day, "
            f"CAST(isodow({ts}) - 1 AS INTEGER) AS day_of_week, CAST(month({ts}) AS INTEGER) AS month, "
            f"CAST(year({ts}) AS INTEGER) AS year, CAST(dayofyear({ts}) AS INTEGER) AS day_of_year, "
            f"CAST(isodow({ts}) - 1 >= 5 AS INTEGER) AS is_weekend")


def season_sql(month: str) -> str:
    return f"CAST(floor(({month} % 12) / 3) AS INTEGER)"


def window_features_sql(v: str, part: str, order: str, lags: Sequence[int], windows: dict,
                        lag_suffix: str = "") -> tuple[str, list[str]]:
    """Lag / rolling mean / rolling std select items and the double column names."""
    items, names = [], []
    w = f"PARTITION BY {part} ORDER BY {order}"
    for k in lags:
        n = f"{v}_lag_{k}{lag_suffix}"
        items.append(f"lag({v}, {k}) OVER ({w}) AS {n}")
        names.append(n)
    for wn, size in windows.items():
        fr = f"({w} ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW)"
        items.append(f"avg({v}) OVER {fr} AS {v}_roll_{wn}_mean")
        items.append(f"stddev_samp({v}) OVER {fr} AS {v}_roll_{wn}_std")
        names += [f"{v}_roll_{wn}_mean", f"{v}_roll_{wn}_std"]
    return ", ".join(items), names
