"""The weather preset end to end: the surveyed pipeline's stages on its own schema.

Inputs are the master observation table (``schemas.MASTER_SCHEMA``, e.g. from
:func:`chronoframe.sources.readers.read_master_csv` or the parsed API payloads)
and optionally the city dimension. Each function returns a lazy DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoframe.config import (DAYS_PER_YEAR, EXPECTED_YEARS, HOURLY_VARIABLES, WEATHER_FEATURES,
                                WEATHER_FEATURES_SPEC, WEATHER_PANEL, WEATHER_RULES)
from chronoframe.functions.calendar import calendar_columns
from chronoframe.operators import clean as C
from chronoframe.operators import panel as P
from chronoframe.operators import profile as PR
from chronoframe.operators import rollups as R
from chronoframe.operators import splits as S
from chronoframe.operators.encode import encode_columns
from chronoframe.plans.bindings import add_labels

__all__ = ["quality_report", "feature_table", "target_distribution_report", "ingest_ordinal"]

CLASSES = [(0, "normal"), (1, "heatwave"), (2, "rain"), (3, "storm")]
LABELS = [("rain", "target_rain"), ("heatwave", "target_heatwave"), ("storm", "target_storm")]


def ingest_ordinal(df: DataFrame, *cols: str) -> DataFrame:
    """A deterministic tie-break for ``keep='first'``.

    Pass the columns that carry ingest order (e.g. a load ordinal). Without
    them the tie-break is the row content itself, so among duplicate keys the
    smallest payload wins — the same row on every run and every retry.
    """
    return df.withColumn("_ordinal", F.struct(*(cols or df.columns)))


def quality_report(master: DataFrame, dimension: DataFrame | None = None) -> DataFrame:
    """Data-quality report per city (A1–A4, P14) with the surveyed expected-rows formula (Q4)."""
    variables = [v for v in HOURLY_VARIABLES if v in master.columns]
    expected = int(EXPECTED_YEARS * DAYS_PER_YEAR * 24)
    return PR.quality_report(master, "city", "datetime", variables, expected,
                             attrs=["country", "continent", "coastal"], dimension=dimension,
                             stats_col="temperature_2m", stats_prefix="temp")


def labelled_table(master: DataFrame, layout: str = "entity", chunk_rows: int = 1_000_000) -> DataFrame:
    """Clean → calendar → lags / rolling → labels → codes → split, every hour kept: what the label reports count."""
    df = C.nan_to_null(C.drop_if_present(master, "visibility"), WEATHER_FEATURES)
    if "_ordinal" not in df.columns:
        df = ingest_ordinal(df)
    spec = WEATHER_PANEL
    df = P.panel_features(df, spec, WEATHER_FEATURES_SPEC, fill_cols=WEATHER_FEATURES, dedup_ordinal="_ordinal",
                          layout=layout, chunk_rows=chunk_rows)
    df = df.withColumns(calendar_columns("datetime", southern=F.col("latitude") < 0))
    df = add_labels(df, WEATHER_RULES)
    df = encode_columns(df, {"city": "city_id", "continent": "continent_id", "climate_zone": "climate_zone_id"})
    return S.with_split(df, "datetime").drop("_ordinal")


def feature_table(master: DataFrame, layout: str = "entity", chunk_rows: int = 1_000_000) -> DataFrame:
    """The labelled table without its warm-up rows (the preprocessing step)."""
    df = labelled_table(master, layout, chunk_rows)
    lag72 = [f"{v}_lag_72h" for v in WEATHER_FEATURES_SPEC.variables]
    return C.drop_null_rows(df, lag72)


def target_distribution_report(labelled: DataFrame) -> DataFrame:
    """Per-city label distribution (A10) — computed before the warm-up trim in the surveyed order."""
    return R.label_distribution(labelled, "city", LABELS, "target_disaster", CLASSES,
                                attrs=["country", "continent", "coastal"], threshold_col="heatwave_threshold")
