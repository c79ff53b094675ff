"""Silver derivations: one narrow projection, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions.columns import (
    as_double,
    as_timestamp,
    composite_id,
    composite_id_strict,
    half_hour_slot,
    per_device,
)

TS = "data_collection_log_timestamp"
CONSUMPTION = "total_consumption_active_import"
DEVICES = "aggregated_device_count_active"
SUBSTATION = "secondary_substation_unique_id"
FEEDER = "lv_feeder_unique_id"

DERIVED_COLUMNS = [
    "hour_of_day",
    "minute_of_hour",
    "half_hour_slot",
    "day_of_week",
    "is_weekend",
    "composite_feeder_id",
    "consumption_per_active_device",
]


def build_silver(df: DataFrame) -> DataFrame:
    """Bronze rows -> Silver rows (same row count).

    Consumption becomes DOUBLE, the reading time TIMESTAMP (unparsable -> NULL),
    and time, calendar and feeder columns are derived. An incoming
    ``collection_date`` column is replaced by the reading's date.
    """
    ts = as_timestamp(df, TS)
    consumption = as_double(df, CONSUMPTION)
    hour = F.hour(ts)
    minute = F.minute(ts)
    passthrough = [
        (consumption.alias(CONSUMPTION) if c == CONSUMPTION else ts.alias(TS) if c == TS else F.col(c))
        for c in df.columns
        if c not in DERIVED_COLUMNS and c != "collection_date"
    ]
    return df.select(
        *passthrough,
        hour.alias("hour_of_day"),
        minute.alias("minute_of_hour"),
        half_hour_slot(hour, minute).alias("half_hour_slot"),
        F.date_format(ts, "E").alias("day_of_week"),
        F.dayofweek(ts).isin(1, 7).alias("is_weekend"),
        composite_id(SUBSTATION, FEEDER).alias("composite_feeder_id"),
        per_device(consumption, DEVICES).alias("consumption_per_active_device"),
        F.to_date(ts).alias("collection_date"),
    )


def calendar_columns(df: DataFrame) -> DataFrame:
    """Year, month, day of month and hour of the reading time."""
    ts = as_timestamp(df, TS)
    return df.withColumns(
        {"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts), "hour": F.hour(ts)}
    )


def geometry_xy(df: DataFrame) -> DataFrame:
    """Point coordinates out of the ``geometry`` struct."""
    return df.withColumns({"geometry_x": F.col("geometry.x"), "geometry_y": F.col("geometry.y")})


def with_strict_composite_id(df: DataFrame) -> DataFrame:
    """``substation-feeder`` that is NULL when a part is NULL (compare ``composite_feeder_id``)."""
    return df.withColumn("composite_id_strict", composite_id_strict(SUBSTATION, FEEDER))
