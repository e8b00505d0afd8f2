"""Calendar expressions (F1–F8). All are built-in Spark functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronoframe.config import MONTH_NAMES, SEASON_NAMES

__all__ = [
    "parse_utc", "hour_of", "day_of_month", "month_of", "year_of", "day_of_year",
    "day_of_week_mon0", "is_weekend", "season_north", "season_hemisphere",
    "season_name", "month_bucket", "month_name", "calendar_columns",
]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_utc(c, fmt: str | None = None) -> Column:
    """parse text as a UTC timestamp (session time zone is UTC)."""
    return F.to_timestamp(_c(c), fmt) if fmt else F.to_timestamp(_c(c))


def hour_of(c) -> Column:
    return F.hour(_c(c))


def day_of_month(c) -> Column:
    return F.dayofmonth(_c(c))


def month_of(c) -> Column:
    return F.month(_c(c))


def year_of(c) -> Column:
    return F.year(_c(c))


def day_of_year(c) -> Column:
    return F.dayofyear(_c(c))


def day_of_week_mon0(c) -> Column:
    """Monday = 0 … Sunday = 6 (``weekday``, not ``dayofweek``)."""
    return F.weekday(_c(c))


def is_weekend(c) -> Column:
    return (F.weekday(_c(c)) >= 5).cast("int")


def season_north(month: Column) -> Column:
    """meteorological season from month: DJF 0, MAM 1, JJA 2, SON 3."""
    return F.floor((month % 12) / 3).cast("int")


def season_hemisphere(month: Column, southern: Column) -> Column:
    """season shifted by two for the southern hemisphere."""
    s = season_north(month)
    return F.when(F.coalesce(southern, F.lit(False)), ((s + 2) % 4).cast("int")).otherwise(s)


def season_name(month: Column) -> Column:
    """unflipped season name."""
    names = F.array(*[F.lit(n) for n in SEASON_NAMES])
    return F.element_at(names, season_north(month) + 1)


def month_bucket(c) -> Column:
    """first instant of the month."""
    return F.date_trunc("month", _c(c))


def month_name(month: Column) -> Column:
    """F8: three-letter month name from 1..12."""
    names = F.array(*[F.lit(n) for n in MONTH_NAMES])
    return F.element_at(names, month)


def calendar_columns(ts: str, southern: Column | None = None) -> dict[str, Column]:
    """The eight calendar features of the feature table."""
    t = F.col(ts)
    cols = {
        "hour": F.hour(t),
        "day": F.dayofmonth(t),
        "day_of_week": F.weekday(t),
        "month": F.month(t),
        "year": F.year(t),
        "day_of_year": F.dayofyear(t),
        "is_weekend": is_weekend(t),
    }
    cols["season"] = (season_hemisphere(F.month(t), southern) if southern is not None
                      else season_north(F.month(t)))
    return cols
