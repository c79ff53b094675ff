"""Reusable Column expressions. All are built-in Spark functions (JVM-side, codegen)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_timestamp(df: DataFrame, name: str) -> Column:
    """The column as a session-time-zone TIMESTAMP.

    Text that does not parse becomes NULL (``try_to_timestamp``) instead of
    failing the job, as a lenient (non-ANSI) reader would.
    """
    dtype = df.schema[name].dataType
    col = F.col(name)
    if isinstance(dtype, T.TimestampType):
        return col
    if isinstance(dtype, T.StringType):
        return F.try_to_timestamp(col)
    return col.try_cast("timestamp")


def as_double(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    col = F.col(name)
    if isinstance(dtype, T.DoubleType):
        return col
    if isinstance(dtype, T.StringType):
        return col.try_cast("double")
    return col.cast("double")


def half_hour_slot(hour: Column | str, minute: Column | str) -> Column:
    """Zero-based half-hour index 0..47: hour * 2 + trunc(minute / 30)."""
    return _c(hour) * F.lit(2) + (_c(minute) / F.lit(30)).cast("int")


def slot_to_hhmm(slot: Column | str) -> Column:
    """Slot index -> zero-padded ``HH:MM`` text (slot 35 -> ``17:30``)."""
    s = _c(slot)
    return F.when(s.isNotNull(), F.format_string("%02d:%02d", F.floor(s / 2), (s % 2) * 30))


def day_type(d: Column | str) -> Column:
    """``weekend`` for Saturday/Sunday (ISO days 6, 7), else ``weekday`` (NULL -> weekday)."""
    return F.when(F.dayofweek(_c(d)).isin(1, 7), F.lit("weekend")).otherwise(F.lit("weekday"))


def composite_id(substation: Column | str, feeder: Column | str) -> Column:
    """``substation-feeder``; NULL parts are skipped, so the result is never NULL."""
    return F.concat_ws("-", _c(substation), _c(feeder))


def composite_id_strict(substation: Column | str, feeder: Column | str) -> Column:
    """``substation-feeder``; NULL when either part is NULL."""
    return F.concat(_c(substation), F.lit("-"), _c(feeder))


def per_device(consumption: Column | str, devices: Column | str) -> Column:
    """Consumption per active device; NULL unless the device count is positive."""
    return F.when(_c(devices) > F.lit(0), _c(consumption) / _c(devices))


def safe_double(col: Column | str) -> Column:
    """NULL or empty text -> 0.0; anything else must be numeric."""
    c = _c(col)
    return F.coalesce(F.nullif(c.cast("string"), F.lit("")).cast("double"), F.lit(0.0))


def try_double(col: Column | str) -> Column:
    """Numeric value or NULL for text that is not a number."""
    return _c(col).try_cast("double")


def coerce_numeric(df: DataFrame, names: list[str]) -> DataFrame:
    """The named columns as numbers (NULL for text that is not one); names that df lacks are passed over."""
    return df.withColumns({n: try_double(n) for n in names if n in df.columns})


def day_range(start: date | str, end: date | str) -> Column:
    """Inclusive array of days between two dates."""
    return F.sequence(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))


def day_bounds(day: date | str) -> tuple[Column, Column]:
    """[start, next day) of a UTC day as TIMESTAMP literals (prunable range)."""
    d = F.lit(str(day)).cast("date")
    return d.cast("timestamp"), F.date_add(d, 1).cast("timestamp")
