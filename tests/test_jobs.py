"""Writes, overwrites, empty days, range backfill and run log."""

from __future__ import annotations

import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from meterlake.config import load_config
from meterlake.plans.jobs import backfill_range, daily_transform, run_with_log
from meterlake.plans.layers import build_layers
from meterlake.sinks.writers import overwrite_partition, overwrite_partitions, partition_path
from meterlake.sources.bronze import read_bronze
from meterlake.sources.fixtures import readings

from tests.conftest import SF_SMALL


def _local(path: str) -> str:
    return path.replace("file:", "", 1)


def test_daily_transform_counts_match_written_tables(spark, tmp_warehouse):
    cfg = load_config(warehouse_uri=tmp_warehouse, run_date="2024-01-12")
    counts = daily_transform(spark, cfg, bronze=readings(spark, SF_SMALL))
    silver = spark.read.parquet(partition_path(cfg.silver_uri, "collection_date", "2024-01-12"))
    peak = spark.read.parquet(partition_path(cfg.gold_peak_uri, "consumption_date", "2024-01-12"))
    profile = spark.read.parquet(partition_path(cfg.gold_profile_uri, "consumption_date", "2024-01-12"))
    assert counts.raw_count == counts.silver_count == silver.count() > 0
    assert counts.peak_count == peak.count() > 0
    assert counts.load_profile_count == profile.count() > 0
    # the partition value lives in the folder name only
    assert "collection_date" not in silver.columns
    files = [f for f in os.listdir(_local(partition_path(cfg.silver_uri, "collection_date", "2024-01-12")))
             if f.endswith(".parquet")]
    assert "collection_date" not in pq.read_schema(
        os.path.join(_local(partition_path(cfg.silver_uri, "collection_date", "2024-01-12")), files[0])
    ).names


def test_rerun_of_an_emptied_day_clears_the_partition(spark, tmp_warehouse):
    base = f"{tmp_warehouse}/t"
    df = spark.range(5).withColumn("d", F.lit("2024-01-05").cast("date"))
    overwrite_partition(df, base, "d", "2024-01-05")
    assert spark.read.parquet(base).count() == 5
    overwrite_partition(df.limit(0), base, "d", "2024-01-05")
    assert spark.read.schema("id long, d date").parquet(base).count() == 0


def test_range_write_clears_days_without_rows(spark, tmp_warehouse):
    from datetime import date

    base = f"{tmp_warehouse}/r"
    days = [date(2024, 1, 1), date(2024, 1, 2)]
    two = spark.range(4).withColumn("d", F.when(F.col("id") < 2, F.lit("2024-01-01")).otherwise("2024-01-02").cast("date"))
    overwrite_partitions(two, base, "d", days)
    assert spark.read.parquet(base).count() == 4
    one = two.filter("d = DATE'2024-01-01'")
    overwrite_partitions(one, base, "d", days)
    got = spark.read.schema("id long, d date").parquet(base)
    assert got.count() == 2 and got.filter("d = DATE'2024-01-02'").count() == 0


def test_range_backfill_equals_daily_runs(spark, tmp_warehouse):
    bronze = readings(spark, SF_SMALL, "dirty")
    ranged = load_config(warehouse_uri=f"{tmp_warehouse}/range", run_date="2024-01-12")
    daily = load_config(warehouse_uri=f"{tmp_warehouse}/daily", run_date="2024-01-12")
    backfill_range(spark, ranged, "2024-01-10", "2024-01-12", bronze=bronze)
    out = backfill_range(spark, daily, "2024-01-10", "2024-01-12", bronze=bronze, per_day=True)
    assert [r["status"] for r in out] == ["SUCCEEDED"] * 3

    def silver_actions(cfg):
        return sorted(spark.read.parquet(cfg.silver_uri).groupBy("collection_date", "dq_action").count().collect())

    def peak_rows(cfg):
        df = spark.read.parquet(cfg.gold_peak_uri)
        cols = ["consumption_date", "dno_alias", "secondary_substation_unique_id", "reading_count", "peak_timestamp"]
        return sorted(df.select(*cols, F.round("daily_total_consumption", 6).alias("t")).collect())

    assert silver_actions(ranged) == silver_actions(daily)
    assert peak_rows(ranged) == peak_rows(daily)
    expected = build_layers(bronze, start="2024-01-10", end="2024-01-12").silver.count()
    assert spark.read.parquet(ranged.silver_uri).count() == expected


def test_backfill_rejects_reversed_range(spark, tmp_warehouse):
    import pytest

    cfg = load_config(warehouse_uri=tmp_warehouse, run_date="2024-01-12")
    with pytest.raises(ValueError):
        backfill_range(spark, cfg, "2024-01-12", "2024-01-10", bronze=readings(spark, SF_SMALL))


def test_run_log_appends_one_row_per_run(spark, tmp_warehouse):
    cfg = load_config(warehouse_uri=tmp_warehouse, run_date="2024-01-12")
    bronze = readings(spark, SF_SMALL)
    first = run_with_log(spark, cfg, bronze=bronze)
    run_with_log(spark, cfg, bronze=bronze)
    log = spark.read.parquet(cfg.run_log_uri)
    assert log.count() == 2
    r = log.filter(F.col("run_id") == first["run_id"]).collect()[0]
    assert r.status == "SUCCESS" and r.input_row_count == first["input_row_count"] > 0
    assert str(r.run_date) == "2024-01-12"


def test_incremental_stream_reruns_touched_days(spark, tmp_warehouse):
    from meterlake.streaming import start_incremental_transform

    bronze_dir = f"{tmp_warehouse}/bronze"
    src = readings(spark, SF_SMALL)
    day = F.to_date("data_collection_log_timestamp")
    src.filter(day == F.lit("2024-01-05").cast("date")).write.parquet(bronze_dir)
    cfg = load_config(warehouse_uri=f"{tmp_warehouse}/lake", source_uri=bronze_dir, run_date="2024-01-05")
    q = start_incremental_transform(spark, cfg, checkpoint_uri=f"{tmp_warehouse}/ckpt")
    q.awaitTermination(120)
    silver = spark.read.parquet(cfg.silver_uri)
    assert [str(r.collection_date) for r in silver.select("collection_date").distinct().collect()] == ["2024-01-05"]
    # a late file for another day: the next trigger processes only that day
    src.filter(day == F.lit("2024-01-06").cast("date")).write.mode("append").parquet(bronze_dir)
    q = start_incremental_transform(spark, cfg, checkpoint_uri=f"{tmp_warehouse}/ckpt")
    q.awaitTermination(120)
    days = sorted(str(r.collection_date) for r in spark.read.parquet(cfg.silver_uri).select("collection_date").distinct().collect())
    assert days == ["2024-01-05", "2024-01-06"]


def test_moments_baseline_gives_the_same_silver(spark, tmp_warehouse):
    from meterlake.plans.jobs import build_moments

    readings(spark, SF_SMALL, "dirty").repartition(5).write.parquet(f"{tmp_warehouse}/bronze")
    bronze = read_bronze(spark, f"{tmp_warehouse}/bronze")
    full = load_config(warehouse_uri=f"{tmp_warehouse}/full", run_date="2024-01-12")
    mom = load_config(warehouse_uri=f"{tmp_warehouse}/mom", run_date="2024-01-12", baseline_mode="moments")
    daily_transform(spark, full, bronze=bronze)
    build_moments(spark, mom, bronze)
    daily_transform(spark, mom, bronze=bronze)

    def rows(cfg):
        df = spark.read.parquet(cfg.silver_uri)  # equal to the last bit
        return sorted(df.select("dataset_id", "dq_action", "zscore_history_count", "zscore_mean", "zscore_stddev", "consumption_zscore").collect(), key=str)

    assert rows(full) == rows(mom)


def test_per_day_backfill_stops_at_first_failure_unless_told(spark, tmp_warehouse, monkeypatch):
    import pytest

    from meterlake.plans import jobs

    calls = []
    real = jobs.daily_transform

    def flaky(spark_, cfg, bronze=None):
        calls.append(str(cfg.run_date))
        if str(cfg.run_date) == "2024-01-11":
            raise RuntimeError("boom")
        return real(spark_, cfg, bronze=bronze)

    monkeypatch.setattr(jobs, "daily_transform", flaky)
    cfg = load_config(warehouse_uri=tmp_warehouse, run_date="2024-01-12")
    bronze = readings(spark, SF_SMALL)
    with pytest.raises(RuntimeError):
        jobs.backfill_range(spark, cfg, "2024-01-10", "2024-01-12", bronze=bronze, per_day=True)
    assert calls == ["2024-01-10", "2024-01-11"]
    calls.clear()
    with pytest.raises(RuntimeError):
        jobs.backfill_range(spark, cfg, "2024-01-10", "2024-01-12", bronze=bronze, per_day=True,
                            continue_on_failure=True)
    assert calls == ["2024-01-10", "2024-01-11", "2024-01-12"]


def test_touched_days_are_folded_into_contiguous_spans(spark):
    from datetime import date, datetime

    from meterlake.streaming import touched_days

    ts = [datetime(2024, 1, d, 3, 0) for d in (2, 3, 3, 4, 9, 20, 21)] + [None]
    batch = spark.createDataFrame([(t,) for t in ts], "data_collection_log_timestamp timestamp")
    assert touched_days(batch) == [
        (date(2024, 1, 2), date(2024, 1, 4)),
        (date(2024, 1, 9), date(2024, 1, 9)),
        (date(2024, 1, 20), date(2024, 1, 21)),
    ]


def test_registered_views_hide_days_outside_the_projected_range(spark, tmp_warehouse):
    from meterlake.sinks.writers import register_tables

    base = f"{tmp_warehouse}/proj"
    days = ["2023-12-31", "2024-01-02", "2999-01-01"]
    df = spark.createDataFrame([(1, d) for d in days], "x int, d string").withColumn("d", F.col("d").cast("date"))
    df.write.partitionBy("d").parquet(base)
    register_tables(spark, {"proj_view": (base, "d", df.schema), "absent_view": (f"{base}-none", "d", df.schema)})
    assert spark.table("absent_view").count() == 0
    assert [str(r.d) for r in spark.table("proj_view").collect()] == ["2024-01-02"]
    # the folders of other days are not even listed
    assert [f.split("/")[-2] for f in spark.table("proj_view").inputFiles()] == ["d=2024-01-02"]
    register_tables(spark, {"none_view": (base, "d", df.schema)}, first_day="2024-02-01")
    assert spark.table("none_view").count() == 0


def _moments_config(spark, tmp_warehouse, files: int = 4):
    source = f"{tmp_warehouse}/bronze"
    readings(spark, SF_SMALL, "dirty").repartition(files).write.parquet(source)
    cfg = load_config(warehouse_uri=f"{tmp_warehouse}/m", source_uri=source, run_date="2024-01-12", baseline_mode="moments")
    return cfg, source.removeprefix("file:")


def _silver_rows(spark, cfg):
    df = spark.read.parquet(cfg.silver_uri)
    return sorted(df.select("dataset_id", "zscore_mean", "zscore_stddev", "zscore_history_count", "dq_action").collect(), key=str)


def test_changed_new_and_deleted_files_are_taken_back(spark, tmp_warehouse):
    import glob

    from meterlake.plans.jobs import build_moments

    cfg, folder = _moments_config(spark, tmp_warehouse)
    full = load_config(warehouse_uri=f"{tmp_warehouse}/f", source_uri=cfg.source_uri, run_date="2024-01-12")

    def same_as_full():
        daily_transform(spark, cfg)
        daily_transform(spark, full)
        assert _silver_rows(spark, cfg) == _silver_rows(spark, full)
        return [spark.read.parquet(cfg.ledger_uri).count(), spark.read.parquet(cfg.moments_uri).select("batch").distinct().count()]

    assert same_as_full() == [4, 1]  # no build was needed before
    assert same_as_full() == [4, 1]  # and nothing is stored again
    first, second, third, _ = sorted(glob.glob(f"{folder}/*.parquet"))
    # other values in as many rows
    table = spark.read.parquet(first)
    rows = table.withColumn("total_consumption_active_import", F.col("total_consumption_active_import") * 1000).collect()
    pq_rows = spark.createDataFrame(rows, table.schema)
    pq_rows.coalesce(1).write.parquet(f"{folder}-new")
    os.replace(glob.glob(f"{folder}-new/*.parquet")[0], first)
    os.remove(f"{folder}/.{os.path.basename(first)}.crc")
    assert same_as_full() == [5, 2]
    os.remove(second)
    assert same_as_full() == [5, 2]
    spark.read.parquet(third).limit(9).write.mode("append").parquet(folder)
    assert same_as_full() == [6, 3]
    build_moments(spark, cfg)
    assert same_as_full() == [4, 1]


def test_what_a_failed_run_stored_is_never_merged(spark, tmp_warehouse):
    from meterlake.plans.ledger import stored_baseline
    from meterlake.sinks.writers import partition_path

    cfg, _ = _moments_config(spark, tmp_warehouse)
    with stored_baseline(spark, cfg) as baseline:
        want = sorted(baseline.collect(), key=str)
    stray = spark.read.parquet(cfg.moments_uri).drop("batch")
    stray.write.parquet(partition_path(cfg.moments_uri, "batch", "stray"))
    with stored_baseline(spark, cfg) as baseline:
        assert sorted(baseline.collect(), key=str) == want


def test_only_new_files_are_read_for_the_moments(spark, tmp_warehouse, monkeypatch):
    from meterlake.plans import ledger

    cfg, _ = _moments_config(spark, tmp_warehouse)
    with ledger.stored_baseline(spark, cfg):
        pass
    asked = []
    real = ledger.read_bronze
    monkeypatch.setattr(ledger, "read_bronze", lambda s, uri: asked.append(uri) or real(s, uri))
    with ledger.stored_baseline(spark, cfg):
        pass
    assert asked == [cfg.source_uri]  # listed, not read
    readings(spark, SF_SMALL).limit(50).coalesce(1).write.mode("append").parquet(cfg.source_uri)
    with ledger.stored_baseline(spark, cfg):
        pass
    assert len(asked) == 3 and len(asked[2]) == 1
    # beyond the number of paths, the rows of the new files are kept by a join
    monkeypatch.setattr(ledger, "MOST_PATHS", 0)
    readings(spark, SF_SMALL).limit(70).coalesce(1).write.mode("append").parquet(cfg.source_uri)
    full = load_config(warehouse_uri=f"{tmp_warehouse}/f", source_uri=cfg.source_uri, run_date="2024-01-12")
    daily_transform(spark, cfg)
    daily_transform(spark, full)
    assert _silver_rows(spark, cfg) == _silver_rows(spark, full)


def test_moments_need_files_of_whole_numbers(spark, tmp_warehouse):
    from meterlake.operators.quality import feeder_moments
    from meterlake.plans.ledger import stored_baseline

    cfg = load_config(warehouse_uri=tmp_warehouse, source_uri="x", run_date="2024-01-12", baseline_mode="moments")
    bronze = readings(spark, SF_SMALL)
    rows = spark.createDataFrame(bronze.limit(3).collect(), bronze.schema)
    with pytest.raises(ValueError, match="read from files"), stored_baseline(spark, cfg, rows):
        pass
    with pytest.raises(ValueError, match="whole numbers"):
        feeder_moments(bronze.withColumn("total_consumption_active_import", F.lit(0.5)))


def test_the_baseline_is_exact_and_equal_on_every_run(spark):
    import math
    from fractions import Fraction

    from meterlake.operators.quality import feeder_baseline

    values = {"a": [10**15 + i for i in range(40)], "b": [7], "c": [None, None], "d": [-(2**62), 2**62, 1], "e": [5, None, 5]}
    rows = [("s", f, v) for f, vs in values.items() for v in vs]
    df = spark.createDataFrame(rows, "secondary_substation_unique_id string, lv_feeder_unique_id string, total_consumption_active_import long")
    runs = [sorted(feeder_baseline(df.repartition(n)).collect(), key=str) for n in (1, 3, 7)]
    assert runs[0] == runs[1] == runs[2]
    for r in runs[0]:
        vs = values[r.composite_feeder_id[-1]]
        own = [v for v in vs if v is not None]
        assert r.zscore_history_count == len(vs)
        if not own:
            assert r.zscore_mean is None and r.zscore_stddev is None
            continue
        mean = Fraction(sum(own), len(own))
        assert r.zscore_mean == pytest.approx(float(mean), rel=1e-15)
        assert r.zscore_stddev == pytest.approx(math.sqrt(sum((v - mean) ** 2 for v in own) / len(own)), rel=1e-14)


def test_every_failed_range_run_is_logged(spark, tmp_warehouse, monkeypatch):
    from meterlake.plans import jobs

    def broken(*_):
        raise ValueError("no baseline")

    monkeypatch.setattr(jobs, "stored_baseline", broken)
    cfg = load_config(warehouse_uri=tmp_warehouse, source_uri="x", run_date="2024-01-12", baseline_mode="moments")
    with pytest.raises(ValueError, match="no baseline"):
        backfill_range(spark, cfg, "2024-01-10", "2024-01-12", bronze=readings(spark, SF_SMALL))
    log = spark.read.parquet(cfg.run_log_uri)
    assert [(str(r.run_date), r.status) for r in log.orderBy("run_date").collect()] == [(f"2024-01-{d}", "FAILED") for d in (10, 11, 12)]
    assert log.where("error_message LIKE '%no baseline%'").count() == 3


def test_counts_come_from_footers(spark, tmp_warehouse):
    from datetime import date

    from meterlake.sources.footers import counted_rows, file_profile, row_count

    base = f"{tmp_warehouse}/days"
    df = spark.range(90).withColumn("d", F.expr("date'2024-01-01' + cast(id % 3 as int)"))
    df.write.partitionBy("d").parquet(base)
    counted = counted_rows(spark, base, "d", [date(2024, 1, 2), date(2024, 1, 9)])
    plan = counted._jdf.queryExecution().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and "PushedGroupBy: [d]" in plan
    assert sorted(tuple(r) for r in counted.collect()) == [(date(2024, 1, 2), 30), (date(2024, 1, 3), 30)]
    assert row_count(spark, base) == 90
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the caller's session is as it was
    readings(spark, SF_SMALL, "dirty").repartition(3).write.parquet(f"{tmp_warehouse}/b")
    got = file_profile(spark, f"{tmp_warehouse}/b").first()
    assert got.row_count == readings(spark, SF_SMALL, "dirty").count() and got.files == 3 and got.bytes > 0
    assert str(got.min_date) == "2024-01-01"


def test_a_day_spread_over_many_files_is_written_as_few(spark, tmp_warehouse):
    import glob

    from meterlake.plans.jobs import build_moments, daily_transform

    source = f"{tmp_warehouse}/many"
    readings(spark, SF_SMALL).repartition(40).write.parquet(source)
    cfg = load_config(warehouse_uri=f"{tmp_warehouse}/w", source_uri=source, run_date="2024-01-12")
    daily_transform(spark, cfg)
    build_moments(spark, cfg)
    root = tmp_warehouse.removeprefix("file:")
    assert 1 <= len(glob.glob(f"{root}/w/silver/**/*.parquet", recursive=True)) <= 2
    batches = glob.glob(f"{root}/w/meta/feeder_file_moments/batch=*")
    assert len(batches) == 1 and len(glob.glob(f"{batches[0]}/*.parquet")) <= 2


def test_the_stream_goes_on_after_a_restart(spark, tmp_warehouse):
    from meterlake.streaming.incremental import start_incremental_transform

    source = f"{tmp_warehouse}/stream"
    day = readings(spark, SF_SMALL).where("to_date(data_collection_log_timestamp) <= '2024-01-03'")
    day.write.parquet(source)
    cfg = load_config(warehouse_uri=f"{tmp_warehouse}/lake", source_uri=source, run_date="2024-01-03")
    first = start_incremental_transform(spark, cfg)
    first.awaitTermination()
    again = start_incremental_transform(spark, cfg)
    again.awaitTermination()
    assert first.lastProgress is not None and (again.lastProgress is None or again.lastProgress["numInputRows"] == 0)


def test_a_failing_check_leaves_the_others_their_status(spark):
    from meterlake.plans import qa
    from meterlake.plans.layers import build_layers

    L = build_layers(readings(spark, SF_SMALL))
    checks = qa.run_checks(L.silver, L.peak, L.profile, "2024-01-12")
    checks["qa_nulls"] = spark.range(1).selectExpr("raise_error('no such table') AS null_check_status")
    got = {r["check_name"]: r for r in qa.check_statuses(checks)}
    assert got["qa_nulls"]["status"] == "ERROR" and "no such table" in got["qa_nulls"]["reason"]
    assert got["qa_freshness"]["status"] == "PASS" and len(got) == 5


def test_a_previous_day_from_the_folders(spark, tmp_warehouse):
    from meterlake.plans.layers import build_layers
    from meterlake.plans.qa import previous_day
    from meterlake.sinks.writers import partition_days

    L = build_layers(readings(spark, SF_SMALL))
    L.silver.write.partitionBy("collection_date").parquet(f"{tmp_warehouse}/s")
    silver = spark.read.parquet(f"{tmp_warehouse}/s")
    days = partition_days(spark, f"{tmp_warehouse}/s", "collection_date")
    assert days[0] == "2024-01-01"
    assert previous_day(silver, "2024-01-12", days).collect() == previous_day(silver, "2024-01-12").collect()
    assert previous_day(silver, "2024-01-01", days).count() == 0
