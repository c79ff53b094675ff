"""Sinks: partition overwrite, range writes, run log, JSON export, table registration."""

from __future__ import annotations

import json
import uuid
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.config import PipelineConfig
from meterlake.schemas import BRONZE, GOLD_PEAK, GOLD_PROFILE, RUN_LOG, SILVER


def partition_path(base: str, key: str, value) -> str:
    """``base/key=value``, the folder layout partition discovery reads back."""
    return f"{base.rstrip('/')}/{key}={value}"


def overwrite_partition(df: DataFrame, base: str, key: str, value) -> str:
    """Replace one partition folder with ``df`` (the key column is not stored in the files).

    Writing an explicit partition path in overwrite mode also clears the
    folder when ``df`` is empty, so re-running a day that lost its rows
    leaves no stale data. A REBALANCE lets AQE merge the rows of many scan
    tasks into advisory-size files (a day spread over a large Bronze would
    else give one small file per task) and split a very large day.
    """
    path = partition_path(base, key, value)
    out = df.drop(key) if key in df.columns else df
    out.hint("rebalance").write.mode("overwrite").parquet(path)
    return path


def overwrite_partitions(df: DataFrame, base: str, key: str, days: list[date]) -> None:
    """Write many day partitions in one job (dynamic partition overwrite).

    Only partitions that receive rows are replaced; the folders of ``days``
    that received none are removed, one file-system call each.
    A REBALANCE hint on the key lets AQE cut each day into advisory-size
    tasks (a huge day is split, small days are merged), so files stay large
    without funnelling a whole day through one task.
    """
    written = F.collect_set(F.col(key).cast("string")).alias("days")  # bounded by the days written
    obs = Observation(f"written_{key}_{uuid.uuid4().hex[:8]}")
    (
        df.observe(obs, written)
        .hint("rebalance", key)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(key)
        .parquet(base)
    )
    seen = set(obs.get.get("days") or [])
    for d in days:
        if str(d) not in seen:
            remove_folder(df.sparkSession, partition_path(base, key, d))


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def folder_exists(spark: SparkSession, path: str) -> bool:
    files, folder = _folder(spark, path)
    return files.exists(folder)


def remove_folder(spark: SparkSession, path: str) -> None:
    files, folder = _folder(spark, path)
    files.delete(folder, True)


def partition_days(spark: SparkSession, base: str, key: str) -> list[str]:
    """The days that have a partition folder, in order, from the folder names alone."""
    files, folder = _folder(spark, base)
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    days = [n.split("=", 1)[1] for n in names if n.startswith(f"{key}=")]
    return sorted(d for d in days if not d.startswith("__"))


def write_run_log(spark: SparkSession, uri: str, record: dict) -> str:
    """Append one run-log row under ``run_date=...`` (snappy parquet, one file)."""
    write_run_logs(spark, uri, [record])
    return partition_path(uri, "run_date", record["run_date"])


def write_run_logs(spark: SparkSession, uri: str, records: list[dict]) -> None:
    """Append run-log rows, in one job."""
    rows = []
    for record in records:
        row = {f.name: record.get(f.name) for f in RUN_LOG.fields}
        if isinstance(row["metadata"], dict):
            row["metadata"] = json.dumps(row["metadata"], sort_keys=True, default=str)
        if isinstance(row["run_date"], str):
            row["run_date"] = date.fromisoformat(row["run_date"])
        rows.append(row)
    df = spark.createDataFrame(rows, RUN_LOG)
    df.coalesce(1).write.mode("append").option("compression", "snappy").partitionBy("run_date").parquet(uri)


def export_json(df: DataFrame, path: str) -> str:
    """Write a whole result as JSON lines (one object per row; NULL fields are kept)."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def table_catalog(cfg: PipelineConfig) -> dict[str, tuple[str, str | None, T.StructType]]:
    """The five queryable tables: ``name -> (folder, partition column, declared schema)``."""
    return {
        "bronze_readings": (cfg.source_uri, None, BRONZE),
        "silver_half_hourly_clean": (cfg.silver_uri, "collection_date", SILVER),
        "gold_peak_demand_substation_day": (cfg.gold_peak_uri, "consumption_date", GOLD_PEAK),
        "gold_avg_load_profile_day": (cfg.gold_profile_uri, "consumption_date", GOLD_PROFILE),
        "pipeline_run_log": (cfg.run_log_uri, "run_date", RUN_LOG),
    }


def register_tables(
    spark: SparkSession,
    tables: dict[str, tuple[str, str | None, T.StructType]],
    first_day: str = "2024-01-01",
) -> list[str]:
    """Temp views over parquet folders: ``name -> (folder, partition column or None, schema)``.

    Schemas are declared, so no file is opened for them, and a folder that is not
    there yet is an empty table. The partitions of a view are those from ``first_day`` up
    to today: their paths are computed from the day names at the top of the table, and
    only these folders are listed. A filter on the partition column prunes them further
    before any file is opened. Days that are written later come in when the view is registered again.
    """
    today = str(datetime.now(timezone.utc).date())
    for name, (path, key, schema) in tables.items():
        paths = [path] if folder_exists(spark, path) else []
        if key:
            paths = [partition_path(path, key, d) for d in partition_days(spark, path, key) if first_day <= d <= today]
        df = spark.read.schema(schema).option("basePath", path).parquet(*paths) if paths else spark.createDataFrame([], schema)
        df.createOrReplaceTempView(name)
    return list(tables)


def run_sql(spark: SparkSession, text: str, args: dict | None = None, max_rows: int | None = None) -> DataFrame:
    """Ad-hoc SQL with named parameters (``:run_date``): the whole result, or its first ``max_rows`` rows if asked for."""
    df = spark.sql(text, args=args or None)
    return df if max_rows is None else df.limit(max_rows)
