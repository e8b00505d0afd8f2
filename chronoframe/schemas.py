"""Explicit schemas (never ``inferSchema``)."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, IntegerType, MapType, StringType, StructField,
                               StructType, TimestampType)

from chronoframe.config import HOURLY_VARIABLES

MASTER_SCHEMA = StructType(
    [StructField("datetime", StringType())]
    + [StructField(v, DoubleType()) for v in HOURLY_VARIABLES]
    + [StructField("city", StringType()), StructField("country", StringType()),
       StructField("continent", StringType()), StructField("latitude", DoubleType()),
       StructField("longitude", DoubleType()), StructField("coastal", IntegerType()),
       StructField("climate_zone", StringType())])

CITY_INFO = StructType([
    StructField("country", StringType()), StructField("continent", StringType()),
    StructField("latitude", DoubleType()), StructField("longitude", DoubleType()),
    StructField("coastal", BooleanType()), StructField("climate_zone", StringType()),
    StructField("note", StringType())])
CITY_DIMENSION_DOC = MapType(StringType(), CITY_INFO)

API_PAYLOAD_SCHEMA = StructType([StructField("hourly", StructType(
    [StructField("time", ArrayType(StringType()))]
    + [StructField(v, ArrayType(DoubleType())) for v in HOURLY_VARIABLES]))])

PREDICTION_SCHEMA = StructType([
    StructField("datetime", TimestampType()), StructField("city", StringType()),
    StructField("temperature_2m", DoubleType()), StructField("pred_temperature", DoubleType()),
    StructField("pred_temp_q10", DoubleType()), StructField("pred_temp_q90", DoubleType()),
    StructField("target_heatwave", IntegerType()), StructField("target_rain", IntegerType()),
    StructField("pred_heat_prob", DoubleType()), StructField("pred_rain_prob", DoubleType()),
    StructField("pred_disaster", IntegerType())])
