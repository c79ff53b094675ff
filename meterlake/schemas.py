"""Explicit table schemas (Bronze, Silver, two Gold tables, run log)."""

from __future__ import annotations

from pyspark.sql import types as T

GEOMETRY = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
BBOX = T.StructType(
    [
        T.StructField("xmin", T.DoubleType()),
        T.StructField("ymin", T.DoubleType()),
        T.StructField("xmax", T.DoubleType()),
        T.StructField("ymax", T.DoubleType()),
    ]
)

# Raw readings as delivered; one row per (feeder, half-hour).
BRONZE = T.StructType(
    [
        T.StructField("dataset_id", T.StringType()),
        T.StructField("dno_alias", T.StringType()),
        T.StructField("aggregated_device_count_active", T.LongType()),
        T.StructField("total_consumption_active_import", T.LongType()),
        T.StructField("data_collection_log_timestamp", T.TimestampType()),
        T.StructField("geometry", GEOMETRY),
        T.StructField("secondary_substation_unique_id", T.StringType()),
        T.StructField("lv_feeder_unique_id", T.StringType()),
        T.StructField("bbox", BBOX),
    ]
)

DERIVED = T.StructType(
    [
        T.StructField("hour_of_day", T.IntegerType()),
        T.StructField("minute_of_hour", T.IntegerType()),
        T.StructField("half_hour_slot", T.IntegerType()),
        T.StructField("day_of_week", T.StringType()),
        T.StructField("is_weekend", T.BooleanType()),
        T.StructField("composite_feeder_id", T.StringType()),
        T.StructField("consumption_per_active_device", T.DoubleType()),
    ]
)

QUALITY = T.StructType(
    [
        T.StructField("zscore_mean", T.DoubleType()),
        T.StructField("zscore_stddev", T.DoubleType()),
        T.StructField("zscore_history_count", T.LongType()),
        T.StructField("consumption_zscore", T.DoubleType()),
        T.StructField("dq_action", T.StringType()),
        T.StructField("data_quality_flag", T.StringType()),
        T.StructField("dq_reason", T.StringType()),
        T.StructField("adjusted_total_consumption_active_import", T.DoubleType()),
    ]
)

# Silver keeps every row of the day, DROP rows included.
SILVER = T.StructType(
    [
        *[T.StructField(f.name, T.DoubleType()) if f.name == "total_consumption_active_import" else f for f in BRONZE],
        *DERIVED,
        *QUALITY,
        T.StructField("collection_date", T.DateType()),
    ]
)

GOLD_PEAK_COLUMNS = [
    "consumption_date",
    "dno_alias",
    "secondary_substation_unique_id",
    "peak_consumption",
    "peak_timestamp",
    "daily_total_consumption",
    "avg_half_hour_consumption",
    "avg_active_devices",
    "feeder_count",
    "reading_count",
]

GOLD_PROFILE_COLUMNS = [
    "consumption_date",
    "hour_of_day",
    "minute_of_hour",
    "half_hour_slot",
    "avg_consumption",
    "total_consumption",
    "reading_count",
    "substation_count",
    "feeder_count",
    "avg_consumption_per_active_device",
]

_KINDS = {
    "consumption_date": T.DateType(),
    "dno_alias": T.StringType(),
    "secondary_substation_unique_id": T.StringType(),
    "peak_timestamp": T.TimestampType(),
    "feeder_count": T.LongType(),
    "reading_count": T.LongType(),
    "substation_count": T.LongType(),
    "hour_of_day": T.IntegerType(),
    "minute_of_hour": T.IntegerType(),
    "half_hour_slot": T.IntegerType(),
}
GOLD_PEAK = T.StructType([T.StructField(c, _KINDS.get(c, T.DoubleType())) for c in GOLD_PEAK_COLUMNS])
GOLD_PROFILE = T.StructType([T.StructField(c, _KINDS.get(c, T.DoubleType())) for c in GOLD_PROFILE_COLUMNS])

# Exact summary of a version of a Bronze file by feeder; partition batch.
MOMENTS = T.StructType(
    [
        T.StructField("version", T.StringType()),
        T.StructField("composite_feeder_id", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("total", T.DecimalType(38, 0)),
        T.StructField("squares", T.DecimalType(38, 0)),
        T.StructField("batch", T.StringType()),
    ]
)

# The versions of Bronze files whose moments are stored, and in which batch.
FILE_LEDGER = T.StructType(
    [
        T.StructField("version", T.StringType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("file_size", T.LongType()),
        T.StructField("file_modification_time", T.TimestampType()),
        T.StructField("batch", T.StringType()),
    ]
)

RUN_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("pipeline_name", T.StringType()),
        T.StructField("started_at", T.StringType()),
        T.StructField("finished_at", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("input_row_count", T.LongType()),
        T.StructField("silver_row_count", T.LongType()),
        T.StructField("peak_table_row_count", T.LongType()),
        T.StructField("load_profile_row_count", T.LongType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("code_version", T.StringType()),
        T.StructField("metadata", T.StringType()),
        T.StructField("run_date", T.DateType()),
    ]
)
