"""Bronze scans, date slices and profiles.

Every slice is written as a half-open timestamp range so that it reaches the
parquet scan as ``PushedFilters`` (row-group skipping) regardless of how the
optimizer treats ``to_date``.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.functions.columns import as_timestamp, day_bounds
from meterlake.schemas import BRONZE
from meterlake.session import ensure_utc

TS = "data_collection_log_timestamp"


def read_bronze(spark: SparkSession, uri: str | list[str], schema: T.StructType = BRONZE) -> DataFrame:
    """Bronze scan of a folder, or of the files listed, with a declared schema (no footer inference)."""
    ensure_utc(spark)
    return spark.read.schema(schema).parquet(*([uri] if isinstance(uri, str) else uri))


def _ts(df: DataFrame) -> Column:
    return as_timestamp(df, TS)


def run_date_slice(df: DataFrame, run_date: date | str) -> DataFrame:
    """Rows whose reading time falls on ``run_date`` (UTC); NULL times drop out."""
    lo, hi = day_bounds(run_date)
    ts = _ts(df)
    return df.filter((ts >= lo) & (ts < hi))


def date_range_slice(df: DataFrame, start: date | str, end: date | str) -> DataFrame:
    """Rows of the inclusive day range [start, end]."""
    if str(end) < str(start):
        raise ValueError("end date must be on or after start date")
    lo, _ = day_bounds(start)
    _, hi = day_bounds(end)
    ts = _ts(df)
    return df.filter((ts >= lo) & (ts < hi))


def readings_at_instant(df: DataFrame, instant: str) -> DataFrame:
    """Readings taken at exactly one instant (``YYYY-MM-DD HH:MM:SS`` UTC)."""
    return df.filter(_ts(df) == F.lit(instant).cast("timestamp"))


def source_date_profile(df: DataFrame, run_date: date | str) -> DataFrame:
    """One row: the run date and how many source rows fall on it."""
    return run_date_slice(df, run_date).agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(str(run_date)).alias("run_date"), "row_count"
    )


def parquet_profile(df: DataFrame) -> DataFrame:
    """Rows and the reading-time range of a Bronze table, in one pass."""
    ts = _ts(df)
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(ts).alias("min_timestamp"),
        F.max(ts).alias("max_timestamp"),
    ).select(
        "row_count",
        F.to_date("min_timestamp").alias("min_date"),
        F.to_date("max_timestamp").alias("max_date"),
        "min_timestamp",
        "max_timestamp",
    )


def silver_profile(silver: DataFrame) -> DataFrame:
    """Rows, collection-date range and reading-time range of a Silver table.

    Reading times that are not valid timestamps count as NULL.
    """
    ts = _ts(silver)
    return silver.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("collection_date").alias("min_collection_date"),
        F.max("collection_date").alias("max_collection_date"),
        F.min(ts).alias("min_timestamp"),
        F.max(ts).alias("max_timestamp"),
    )


def preview(df: DataFrame, columns: list[str] | None = None, n: int = 20, order_by: str | None = None) -> DataFrame:
    """First ``n`` rows of a projection (the limit is the feature); in the order of a column if one is named."""
    rows = df.orderBy(order_by) if order_by else df
    return (rows.select(*columns) if columns else rows).limit(n)

