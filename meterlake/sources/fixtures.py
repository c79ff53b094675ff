"""Adapter from the driver's ``events`` test table to Bronze readings.

Mapping (also in FIXTURES.md §2)::

    sub        = floor(user_id / 3)
    dataset_id = event_id as text
    dno_alias  = 'DNO_' || sub % 5
    devices    = k + 1                  (k = props.$.k)
    consumption= round(value * 100)     (bigint, like the Bronze contract)
    timestamp  = ts floored to 30 minutes
    geometry   = (sub % 180, sub % 90), bbox = the point's box
    substation = 'SS' || sub,  feeder = 'F' || user_id % 3

``dirty`` injects every invalid case of the quality rules; ``offgrid`` keeps
the raw (unfloored) timestamps; ``skewed`` has one substation in ten of its DNO
use 5000 times as much; ``texttime`` has times as text, some of them no times. The rules below pick rows to corrupt; they
never remove rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterlake.session import ensure_utc

VARIANTS = ("clean", "dirty", "offgrid", "skewed", "texttime")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def _exprs(variant: str) -> list[str]:
    """The mapping as SQL expressions (parsed once on the JVM side)."""
    sub = "CAST(floor(user_id / 3) AS BIGINT)"
    k = "CAST(get_json_object(props, '$.k') AS BIGINT)"
    c = "CAST(round(value * 100) AS BIGINT)"
    secs = "unix_seconds(CAST(ts AS TIMESTAMP))"
    dno = f"concat('DNO_', CAST({sub} % 5 AS STRING))"
    devices = f"{k} + 1"
    consumption = c
    ts = "CAST(ts AS TIMESTAMP)" if variant == "offgrid" else f"timestamp_seconds({secs} - {secs} % 1800)"
    substation = f"concat('SS', CAST({sub} AS STRING))"
    if variant == "dirty":
        dno = f"CASE WHEN {sub} % 10 != 7 THEN {dno} END"
        devices = k
        consumption = f"CASE WHEN event_id % 97 = 0 THEN -{c} WHEN event_id % 83 = 0 THEN NULL ELSE {c} END"
        ts = f"CASE WHEN event_id % 79 != 0 THEN {ts} END"
        substation = f"CASE WHEN event_id % 89 = 0 THEN '' WHEN event_id % 101 = 0 THEN NULL ELSE {substation} END"
    if variant == "skewed":
        consumption = f"CASE WHEN {sub} = 3 THEN 5000 * {c} ELSE {c} END"
    if variant == "texttime":
        ts = f"CASE WHEN event_id % 61 = 0 THEN 'no time' ELSE CAST({ts} AS STRING) END"
    x = f"CAST({sub} % 180 AS DOUBLE)"
    y = f"CAST({sub} % 90 AS DOUBLE)"
    return [
        "CAST(event_id AS STRING) AS dataset_id",
        f"{dno} AS dno_alias",
        f"CAST({devices} AS BIGINT) AS aggregated_device_count_active",
        f"CAST({consumption} AS BIGINT) AS total_consumption_active_import",
        f"{ts} AS data_collection_log_timestamp",
        f"named_struct('x', {x}, 'y', {y}) AS geometry",
        f"CAST({substation} AS STRING) AS secondary_substation_unique_id",
        "concat('F', CAST(user_id % 3 AS STRING)) AS lv_feeder_unique_id",
        f"named_struct('xmin', {x}, 'ymin', {y}, 'xmax', {x}, 'ymax', {y}) AS bbox",
    ]


def readings(spark: SparkSession, sf_dir: str, variant: str = "clean") -> DataFrame:
    """Bronze-shaped readings (explicit column types) derived from ``events``."""
    if variant not in VARIANTS:
        raise ValueError(f"unknown variant {variant!r}; expected one of {VARIANTS}")
    ensure_utc(spark)
    return events(spark, sf_dir).selectExpr(*_exprs(variant))
