"""Exploration aggregates over Bronze readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions.columns import as_timestamp, composite_id_strict

TS = "data_collection_log_timestamp"
SUB = "secondary_substation_unique_id"
FEEDER = "lv_feeder_unique_id"
CONSUMPTION = "total_consumption_active_import"
DEVICES = "aggregated_device_count_active"


def hourly_summary(bronze: DataFrame) -> DataFrame:
    """Consumption and device statistics per (year, month, day, hour).

    ``aggregated_device_count`` is the device count of the group's earliest
    reading (ties on time broken by ``dataset_id``), a deterministic "first".
    """
    ts = as_timestamp(bronze, TS)
    first_key = F.struct(ts, F.col("dataset_id"))
    return bronze.groupBy(
        F.year(ts).alias("year"), F.month(ts).alias("month"), F.dayofmonth(ts).alias("day"), F.hour(ts).alias("hour")
    ).agg(
        F.sum(CONSUMPTION).alias("total_consumption"),
        F.min_by(DEVICES, first_key).alias("aggregated_device_count"),
        F.avg(DEVICES).alias("mean_aggregated_device_count"),
        F.sum(DEVICES).alias("total_devices_measured"),
        F.max(CONSUMPTION).alias("max_consumption"),
        F.min(CONSUMPTION).alias("min_consumption"),
        F.avg(CONSUMPTION).alias("mean_consumption"),
    )


def distinct_counts(bronze: DataFrame) -> DataFrame:
    """Distinct substations, feeders, geometries and id pairs (NULLs ignored)."""
    sub, feeder, geom = F.col(SUB), F.col(FEEDER), F.col("geometry")
    return bronze.agg(
        F.count_distinct(sub).alias("substations"),
        F.count_distinct(feeder).alias("feeders"),
        F.count_distinct(geom).alias("geometries"),
        F.count_distinct(composite_id_strict(sub, feeder)).alias("substation_feeder_pairs"),
        F.count_distinct(sub, geom).alias("substation_geometry_pairs"),
        F.count_distinct(feeder, geom).alias("feeder_geometry_pairs"),
    )


def feeders_per_site(bronze: DataFrame) -> DataFrame:
    """Distinct feeders per (substation, geometry); rows with a NULL key are left out."""
    return (
        bronze.filter(F.col(SUB).isNotNull() & F.col("geometry").isNotNull())
        .groupBy(SUB, "geometry")
        .agg(F.count_distinct(FEEDER).alias("feeder_count"))
    )
