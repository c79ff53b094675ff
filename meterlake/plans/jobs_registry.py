"""Registered queries backed by the jobs: they write, then return what they read back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.config import load_config
from meterlake.plans import insights as I
from meterlake.plans.jobs import backfill_range, build_moments, daily_transform, run_with_log
from meterlake.registry import (
    DQ_FLAT,
    DQ_NOISY,
    FLAT_BRONZE,
    FULL_END,
    FULL_START,
    PEAK_NOISY,
    PROFILE_NOISY,
    RUN_DATE,
    _bronze,
    f32,
    f32_all,
)
from meterlake.plans.layers import build_layers, stored_insights
from meterlake.session import scratch_path
from meterlake.sinks.writers import export_json, partition_path, register_tables, remove_folder, run_sql, table_catalog
from meterlake.sources.footers import file_profile
from meterlake.schemas import GOLD_PEAK_COLUMNS, GOLD_PROFILE_COLUMNS


def _cfg(spark: SparkSession, run_date: str = RUN_DATE):
    return load_config(warehouse_uri=scratch_path(spark, "warehouse"), source_uri="fixture", run_date=run_date)


def _daily(spark, sf):
    cfg = _cfg(spark)
    daily_transform(spark, cfg, bronze=_bronze(spark, sf))
    return cfg


def _range(spark, sf):
    cfg = _cfg(spark)
    backfill_range(spark, cfg, FULL_START, FULL_END, bronze=_bronze(spark, sf))
    return cfg


def _read_day(spark: SparkSession, base: str, key: str) -> DataFrame:
    return spark.read.parquet(partition_path(base, key, RUN_DATE)).withColumn(key, F.lit(RUN_DATE).cast("date"))


def q_daily_transform(spark, sf):
    cfg = _daily(spark, sf)
    parts = [
        _read_day(spark, cfg.silver_uri, "collection_date").agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit("silver").alias("table_name"), "row_count"),
        _read_day(spark, cfg.gold_peak_uri, "consumption_date").agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit("gold_peak").alias("table_name"), "row_count"),
        _read_day(spark, cfg.gold_profile_uri, "consumption_date").agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit("gold_profile").alias("table_name"), "row_count"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_write_silver(spark, sf):
    cfg = _daily(spark, sf)
    return f32(_read_day(spark, cfg.silver_uri, "collection_date").select(*DQ_FLAT), DQ_NOISY)


def _stored_bronze(spark, sf, variant: str = "clean"):
    """Bronze written as files of its own, several of them, and a configuration that reads it."""
    cfg = load_config(warehouse_uri=scratch_path(spark, "warehouse"), source_uri=scratch_path(spark, "bronze"), run_date=RUN_DATE,
                      baseline_mode="moments")
    return _bronze(spark, sf, variant), cfg


def q_write_silver_moments(spark, sf):
    """The daily job with the stored-moments baseline: same Silver rows as the full scan."""
    bronze, cfg = _stored_bronze(spark, sf)
    bronze.repartition(4, "lv_feeder_unique_id").write.parquet(cfg.source_uri)
    build_moments(spark, cfg)
    daily_transform(spark, cfg)
    return f32(_read_day(spark, cfg.silver_uri, "collection_date").select(*DQ_FLAT), DQ_NOISY)


def q_write_silver_moments_late(spark, sf):
    """Moments stored before some readings of the run's day and all readings without a time came: same rows as the full scan."""
    bronze, cfg = _stored_bronze(spark, sf, "dirty")
    day = F.to_date("data_collection_log_timestamp") == F.lit(RUN_DATE).cast("date")
    late = F.coalesce(day & (F.col("dataset_id").cast("long") % 3 == 0), F.lit(True))
    bronze.where(~late).write.parquet(cfg.source_uri)
    build_moments(spark, cfg)
    bronze.where(late).write.mode("append").parquet(cfg.source_uri)
    daily_transform(spark, cfg)
    return f32(_read_day(spark, cfg.silver_uri, "collection_date").select(*DQ_FLAT), DQ_NOISY)


def q_write_silver_moments_changed(spark, sf):
    """After the moments were stored, a file of other days got other values in as many rows, and another file went: same rows as the full scan."""
    bronze, cfg = _stored_bronze(spark, sf)
    part = F.dayofmonth("data_collection_log_timestamp") % 2
    even, odd = f"{cfg.source_uri}/part=even", f"{cfg.source_uri}/part=odd"
    wrong = F.col("total_consumption_active_import") * 1000
    bronze.where(part == 0).write.parquet(even)
    bronze.where(part == 1).withColumn("total_consumption_active_import", wrong).write.parquet(odd)
    bronze.where(part == 1).write.parquet(f"{cfg.source_uri}/part=twice")
    build_moments(spark, cfg)
    bronze.where(part == 1).write.mode("overwrite").parquet(odd)
    remove_folder(spark, f"{cfg.source_uri}/part=twice")
    daily_transform(spark, cfg)
    return f32(_read_day(spark, cfg.silver_uri, "collection_date").select(*DQ_FLAT), DQ_NOISY)


def q_parquet_profile_files(spark, sf):
    """Rows from the footers of stored Bronze files."""
    bronze, cfg = _stored_bronze(spark, sf, "dirty")
    bronze.repartition(3).write.parquet(cfg.source_uri)
    return file_profile(spark, cfg.source_uri).drop("bytes")


def q_write_gold_peak(spark, sf):
    cfg = _daily(spark, sf)
    return f32(_read_day(spark, cfg.gold_peak_uri, "consumption_date").select(*GOLD_PEAK_COLUMNS), PEAK_NOISY)


def q_write_gold_profile(spark, sf):
    cfg = _daily(spark, sf)
    return f32(_read_day(spark, cfg.gold_profile_uri, "consumption_date").select(*GOLD_PROFILE_COLUMNS), PROFILE_NOISY)


def q_backfill_range(spark, sf):
    cfg = _range(spark, sf)
    silver = spark.read.parquet(cfg.silver_uri)
    return silver.groupBy("collection_date", "dq_action").agg(F.count(F.lit(1)).alias("row_count"))


def q_backfill_range_gold(spark, sf):
    cfg = _range(spark, sf)
    return f32(spark.read.parquet(cfg.gold_peak_uri).select(*GOLD_PEAK_COLUMNS), PEAK_NOISY)


def q_backfill_range_profile(spark, sf):
    cfg = _range(spark, sf)
    return f32(spark.read.parquet(cfg.gold_profile_uri).select(*GOLD_PROFILE_COLUMNS), PROFILE_NOISY)


def q_backfill_run_log(spark, sf):
    """A range run logs each of its days with the day's own counts."""
    cfg = _range(spark, sf)
    return spark.read.parquet(cfg.run_log_uri).select(
        "run_date", "status", "input_row_count", "silver_row_count", "peak_table_row_count", "load_profile_row_count"
    )


def q_run_log_metadata(spark, sf):
    """The parts of a log row that differ from run to run, by their form; the metadata as JSON."""
    cfg = _cfg(spark)
    run_with_log(spark, cfg, bronze=_bronze(spark, sf))
    return spark.read.parquet(cfg.run_log_uri).select(
        F.get_json_object("metadata", "$.zscore_threshold").alias("zscore_threshold"),
        F.get_json_object("metadata", "$.warehouse").endswith(cfg.warehouse_uri).alias("has_warehouse"),
        F.col("run_id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$").alias("is_uuid"),
        (F.to_timestamp("started_at") <= F.to_timestamp("finished_at")).alias("in_order"),
        F.col("finished_at").endswith("+00:00").alias("is_utc"),
    )


def q_run_log(spark, sf):
    cfg = _cfg(spark)
    run_with_log(spark, cfg, bronze=_bronze(spark, sf))
    return spark.read.parquet(cfg.run_log_uri).select(
        "run_date", "pipeline_name", "status", "input_row_count", "silver_row_count", "peak_table_row_count",
        "load_profile_row_count", "error_message", "code_version",
    )


def _registered(spark, sf):
    """All five tables stored and registered; Bronze is written as a table of its own."""
    cfg = load_config(warehouse_uri=scratch_path(spark, "warehouse"), source_uri=scratch_path(spark, "bronze"), run_date=RUN_DATE)
    _bronze(spark, sf).write.parquet(cfg.source_uri)
    backfill_range(spark, cfg, FULL_START, FULL_END)
    return cfg, register_tables(spark, table_catalog(cfg))


def q_register_tables(spark, sf):
    _, names = _registered(spark, sf)
    out = None
    for n in names:
        part = spark.table(n).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
        out = part if out is None else out.unionByName(part)
    return out


def _registered_table(name: str, columns: list[str], noisy: list[str]):
    def run(spark, sf):
        _registered(spark, sf)
        return f32(spark.table(name).select(*columns), noisy)

    return run


def q_projected_partitions(spark, sf):
    _registered(spark, sf)
    return spark.table("silver_half_hourly_clean").groupBy("collection_date").agg(F.count(F.lit(1)).alias("row_count"))


def q_run_sql(spark, sf):
    _registered(spark, sf)
    text = (
        "SELECT dno_alias, count(*) AS substation_days, sum(reading_count) AS readings "
        "FROM gold_peak_demand_substation_day WHERE consumption_date <= :last_day "
        "GROUP BY dno_alias ORDER BY dno_alias"
    )
    return run_sql(spark, text, args={"last_day": date.fromisoformat(FULL_END)})


def q_run_sql_all(spark, sf):
    """A result of more than 100 rows comes back whole."""
    _registered(spark, sf)
    return run_sql(spark, "SELECT consumption_date, dno_alias, secondary_substation_unique_id, reading_count FROM gold_peak_demand_substation_day")


def q_export_json(spark, sf):
    L = build_layers(_bronze(spark, sf))
    df = I.dno_share(L.peak)
    path = export_json(df, scratch_path(spark, "export"))
    return f32_all(spark.read.schema(df.schema).json(path))


def q_export_json_nulls(spark, sf):
    """A saved result has all rows, and all columns in each row, NULL or not."""
    df = build_layers(_bronze(spark, sf, "dirty")).peak.select("consumption_date", "dno_alias", "secondary_substation_unique_id", "reading_count")
    path = export_json(df, scratch_path(spark, "export"))
    fields = F.size(F.json_object_keys("value")).alias("fields")
    parsed = F.from_json("value", df.schema).alias("r")
    return spark.read.text(path).select(parsed, fields).select("r.*", "fields")


#: Columns of each insight: those shown as text, those compared as numbers.
INSIGHT_COLUMNS = {
    "insight_date_coverage": (["table_name", "min_date", "max_date", "populated_days", "row_count"], []),
    "insight_top_substations": (
        ["dno_alias", "secondary_substation_unique_id", "active_days"],
        ["avg_daily_total_consumption", "max_observed_peak", "avg_peak_consumption"],
    ),
    "insight_system_peak_day": (["consumption_date", "dno_alias", "active_substations"], ["system_daily_total", "max_substation_peak"]),
    "insight_load_shape": (
        ["hour_of_day", "minute_of_hour", "half_hour_slot", "total_readings"], ["mean_slot_consumption", "mean_slot_total_consumption"],
    ),
    "insight_weekday_weekend_profile": (["day_type", "half_hour_slot", "contributing_day_slots"], ["mean_avg_consumption"]),
    "insight_substation_concentration": (
        ["rn", "secondary_substation_unique_id"], ["total_consumption", "fleet_total_consumption", "share_of_total"],
    ),
    "insight_peak_window": (["evening_peak_events", "overnight_peak_events", "total_events"], ["evening_peak_share", "overnight_peak_share"]),
    "insight_volatility": (["days"], ["mean_day_total", "stddev_day_total", "cv_day_total"]),
    "insight_evening_ramp": (["day_type"], ["evening_avg", "night_avg", "evening_to_night_ratio"]),
    "insight_dno_outlier_screen": (["dno_alias"], ["dno_mean", "dno_median", "mean_to_median_ratio"]),
    "insight_dno_share": (["dno_alias"], ["total_consumption", "share_of_total"]),
    "insight_peak_hour_distribution": (["peak_hour", "substation_days"], []),
}


def _run_insights(variant: str):
    def run(spark, sf):
        """All rows of all insights, each with its texts joined and its numbers."""
        found = stored_insights(build_layers(_bronze(spark, sf, variant)))
        out = None
        for name, (texts, numbers) in INSIGHT_COLUMNS.items():
            item = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in texts])
            values = [F.col(c).cast("float").cast("double") for c in numbers] + [F.lit(None).cast("double")] * (3 - len(numbers))
            part = found[name].select(F.lit(name).alias("insight"), item.alias("item"), *[v.alias(f"value_{i}") for i, v in enumerate(values, start=1)])
            out = part if out is None else out.unionByName(part)
        return out

    return run


JOBS = {
    "daily_transform": q_daily_transform,
    "write_silver": q_write_silver,
    "write_silver_moments": q_write_silver_moments,
    "write_silver_moments_late": q_write_silver_moments_late,
    "write_silver_moments_changed": q_write_silver_moments_changed,
    "parquet_profile_files": q_parquet_profile_files,
    "write_gold_peak": q_write_gold_peak,
    "write_gold_profile": q_write_gold_profile,
    "backfill_range": q_backfill_range,
    "backfill_range_gold": q_backfill_range_gold,
    "backfill_range_profile": q_backfill_range_profile,
    "backfill_run_log": q_backfill_run_log,
    "run_log": q_run_log,
    "run_log_metadata": q_run_log_metadata,
    "register_tables": q_register_tables,
    "projected_partitions": q_projected_partitions,
    "table_bronze": _registered_table("bronze_readings", FLAT_BRONZE, []),
    "table_silver": _registered_table("silver_half_hourly_clean", DQ_FLAT, DQ_NOISY),
    "table_gold_peak": _registered_table("gold_peak_demand_substation_day", GOLD_PEAK_COLUMNS, PEAK_NOISY),
    "table_gold_profile": _registered_table("gold_avg_load_profile_day", GOLD_PROFILE_COLUMNS, PROFILE_NOISY),
    "table_run_log": _registered_table("pipeline_run_log", ["run_date", "status", "silver_row_count"], []),
    "run_sql": q_run_sql,
    "run_sql_all": q_run_sql_all,
    "export_json": q_export_json,
    "export_json_nulls": q_export_json_nulls,
    "run_insights": _run_insights("clean"),
    "run_insights_dirty": _run_insights("dirty"),
}
