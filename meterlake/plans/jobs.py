"""Batch jobs: daily transform, date-range backfill, insights run, run log.

Daily transform, plan and failure model:

1. Silver (slice + derivations + quality) is written to its day folder.
2. Gold is built from the *written* Silver day (column-pruned read), not from
   a cached frame: the lineage is cut at a durable table on shared storage, so
   a lost executor costs a re-read of files, not a re-run of the baseline.
3. Row counts come from ``observe`` on the writes (no extra count jobs).
4. Every write overwrites whole day folders, so a failed or repeated run is
   simply run again.

The range backfill does the same for many days in one job: one baseline
aggregate, one Silver write partitioned by date, one Gold build.
"""

from __future__ import annotations

import traceback
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meterlake.config import PipelineConfig, date_span, parse_run_date
from meterlake.operators.gold import build_gold_load_profile, build_gold_peak
from meterlake.operators.quality import feeder_baseline, gold_input
from meterlake.plans.layers import silver_with_quality
from meterlake.plans.ledger import rebuild_moments, stored_baseline
from meterlake.session import ensure_utc
from meterlake.sinks.writers import (
    overwrite_partition,
    overwrite_partitions,
    partition_days,
    partition_path,
    write_run_log,
    write_run_logs,
)
from meterlake.sources.bronze import date_range_slice, read_bronze, run_date_slice
from meterlake.sources.footers import rows_by_day


@dataclass(frozen=True)
class TransformCounts:
    raw_count: int
    silver_count: int
    peak_count: int
    load_profile_count: int


def _observed_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(f"{name}_{uuid.uuid4().hex[:8]}")
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def _rows(obs: Observation) -> int:
    return int(obs.get.get("rows") or 0)


def build_moments(spark: SparkSession, cfg: PipelineConfig, bronze: DataFrame | None = None) -> None:
    """Store the moments of all Bronze files anew (see :mod:`meterlake.plans.ledger`)."""
    ensure_utc(spark)
    rebuild_moments(spark, cfg, bronze)


@contextmanager
def _baseline(spark: SparkSession, cfg: PipelineConfig, bronze: DataFrame | None) -> Iterator[DataFrame | None]:
    """``None`` -> aggregate all of Bronze; else the merged moments of the files that Bronze has now."""
    if cfg.baseline_mode != "moments":
        yield None
        return
    with stored_baseline(spark, cfg, bronze) as baseline:
        yield baseline


def daily_transform(spark: SparkSession, cfg: PipelineConfig, bronze: DataFrame | None = None) -> TransformCounts:
    """Silver + two Gold partitions for ``cfg.run_date``; returns the row counts."""
    ensure_utc(spark)
    day = parse_run_date(cfg.run_date)
    with _baseline(spark, cfg, bronze) as baseline:
        bronze = bronze if bronze is not None else read_bronze(spark, cfg.source_uri)
        # the slice is counted before the baseline join, so a join that changed its rows would show
        raw_df, raw_obs = _observed_rows(run_date_slice(bronze, day), "raw")
        silver = silver_with_quality(
            raw_df, threshold=cfg.zscore_threshold, min_history_rows=cfg.zscore_min_history_rows,
            baseline=baseline if baseline is not None else feeder_baseline(bronze),
        )
        silver_obs_df, silver_obs = _observed_rows(silver, "silver")
        silver_path = overwrite_partition(silver_obs_df, cfg.silver_uri, "collection_date", day)

    written = spark.read.schema(silver.drop("collection_date").schema).parquet(silver_path).withColumn(
        "collection_date", F.lit(str(day)).cast("date")
    )
    gin = gold_input(written)
    peak_df, peak_obs = _observed_rows(build_gold_peak(gin), "peak")
    overwrite_partition(peak_df, cfg.gold_peak_uri, "consumption_date", day)
    profile_df, profile_obs = _observed_rows(build_gold_load_profile(gin), "profile")
    overwrite_partition(profile_df, cfg.gold_profile_uri, "consumption_date", day)

    return TransformCounts(_rows(raw_obs), _rows(silver_obs), _rows(peak_obs), _rows(profile_obs))


def backfill_range(
    spark: SparkSession,
    cfg: PipelineConfig,
    start: date | str,
    end: date | str,
    *,
    bronze: DataFrame | None = None,
    per_day: bool = False,
    continue_on_failure: bool = False,
) -> list[dict]:
    """Process every day of [start, end].

    Default: one job for the whole range (same rows as the daily runs, since
    the baseline does not depend on the run date). ``per_day=True`` runs the
    daily job day by day and stops at the first failure unless
    ``continue_on_failure``; a failure is raised at the end. Either way each
    day gets a run-log row with its own counts.
    """
    ensure_utc(spark)
    days = date_span(parse_run_date(str(start)), parse_run_date(str(end)))

    if per_day:
        # one job per day, like separately scheduled runs (each pays its own baseline)
        results, failed = [], []
        for d in days:
            day_cfg = PipelineConfig(**{**asdict(cfg), "run_date": d})
            try:
                record = run_with_log(spark, day_cfg, bronze)
                results.append({"run_date": str(d), "status": "SUCCEEDED", **{c: record[k] for c, k in COUNT_COLUMNS.items()}})
            except Exception as exc:  # noqa: BLE001 - reported per day, like a scheduler would
                failed.append(str(d))
                results.append({"run_date": str(d), "status": "FAILED", "error_message": str(exc)})
                if not continue_on_failure:
                    break
        if failed:
            raise RuntimeError(f"backfill failed for {failed}: {results}")
        return results

    started = _now()
    try:
        counted = _range_job(spark, cfg, bronze, days)
    except Exception:
        error = traceback.format_exc(limit=3)
        write_run_logs(spark, cfg.run_log_uri, [_record(cfg, d, started, status="FAILED", error=error) for d in days])
        raise
    results = []
    records = []
    for d in days:
        counts = TransformCounts(**{c: by.get(d, 0) for c, by in counted.items()})
        records.append(_record(cfg, d, started, status="SUCCESS", counts=counts))
        results.append({"run_date": str(d), "status": "SUCCEEDED", **asdict(counts)})
    write_run_logs(spark, cfg.run_log_uri, records)
    return results


def _range_job(spark: SparkSession, cfg: PipelineConfig, bronze: DataFrame | None, days: list[date]) -> dict[str, dict[date, int]]:
    """Write Silver and both Gold tables for the days; rows of each day by table, counted from the footers of the files.

    Raw rows are observed in total before the baseline join. Where the total
    equals Silver's, the join kept each row once and a day's raw rows are its
    Silver rows; a join that changed them is an error.
    """
    with _baseline(spark, cfg, bronze) as baseline:
        bronze = bronze if bronze is not None else read_bronze(spark, cfg.source_uri)
        raw, raw_obs = _observed_rows(date_range_slice(bronze, days[0], days[-1]), "raw")
        silver = silver_with_quality(
            raw, threshold=cfg.zscore_threshold, min_history_rows=cfg.zscore_min_history_rows,
            baseline=baseline if baseline is not None else feeder_baseline(bronze),
        )
        overwrite_partitions(silver, cfg.silver_uri, "collection_date", days)
    in_range = F.col("collection_date").between(F.lit(str(days[0])).cast("date"), F.lit(str(days[-1])).cast("date"))
    gin = gold_input(spark.read.schema(silver.schema).parquet(cfg.silver_uri).filter(in_range))
    overwrite_partitions(build_gold_peak(gin), cfg.gold_peak_uri, "consumption_date", days)
    overwrite_partitions(build_gold_load_profile(gin), cfg.gold_profile_uri, "consumption_date", days)
    silver_rows = rows_by_day(spark, cfg.silver_uri, "collection_date", days)
    if sum(silver_rows.values()) != _rows(raw_obs):
        raise RuntimeError(f"{_rows(raw_obs)} readings became {sum(silver_rows.values())} Silver rows")
    return {
        "raw_count": silver_rows,
        "silver_count": silver_rows,
        "peak_count": rows_by_day(spark, cfg.gold_peak_uri, "consumption_date", days),
        "load_profile_count": rows_by_day(spark, cfg.gold_profile_uri, "consumption_date", days),
    }


COUNT_COLUMNS = {
    "raw_count": "input_row_count",
    "silver_count": "silver_row_count",
    "peak_count": "peak_table_row_count",
    "load_profile_count": "load_profile_row_count",
}


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


def _record(
    cfg: PipelineConfig, day: date, started: str, status: str, counts: TransformCounts | None = None, error: str = ""
) -> dict:
    """One run-log row; without counts they are 0."""
    found = asdict(counts) if counts else {c: 0 for c in COUNT_COLUMNS}
    return {
        "run_id": str(uuid.uuid4()),
        "pipeline_name": cfg.pipeline_name,
        "run_date": day,
        "started_at": started,
        "finished_at": _now(),
        "status": status,
        "code_version": cfg.code_version,
        "metadata": {"warehouse": cfg.warehouse_uri, "zscore_threshold": cfg.zscore_threshold},
        "error_message": error,
        **{k: found[c] for c, k in COUNT_COLUMNS.items()},
    }


def log_run(spark: SparkSession, cfg: PipelineConfig, status: str, error: str = "") -> dict:
    """Write one run-log row for ``cfg.run_date`` by itself, with the counts of its stored partitions."""
    day = parse_run_date(cfg.run_date)
    tables = ((cfg.silver_uri, "collection_date"), (cfg.gold_peak_uri, "consumption_date"), (cfg.gold_profile_uri, "consumption_date"))
    found = [
        spark.read.parquet(partition_path(base, key, day)).count() if str(day) in partition_days(spark, base, key) else 0
        for base, key in tables
    ]
    record = _record(cfg, day, _now(), status, TransformCounts(found[0], *found), error)
    write_run_log(spark, cfg.run_log_uri, record)
    return record


def run_with_log(spark: SparkSession, cfg: PipelineConfig, bronze: DataFrame | None = None) -> dict:
    """Daily transform followed by one run-log row (SUCCESS or FAILED with the error text)."""
    started = _now()
    day = parse_run_date(cfg.run_date)
    try:
        record = _record(cfg, day, started, "SUCCESS", daily_transform(spark, cfg, bronze))
    except Exception:  # noqa: BLE001 - the failure is logged, then re-raised
        write_run_log(spark, cfg.run_log_uri, _record(cfg, day, started, "FAILED", error=traceback.format_exc(limit=3)))
        raise
    write_run_log(spark, cfg.run_log_uri, record)
    return record


def registered_jobs():
    """Job-backed query keys; each writes into a fresh folder under the shared directory."""
    from meterlake.plans import jobs_registry

    return jobs_registry.JOBS


__all__ = [
    "TransformCounts",
    "backfill_range",
    "daily_transform",
    "log_run",
    "partition_path",
    "registered_jobs",
    "run_with_log",
]
