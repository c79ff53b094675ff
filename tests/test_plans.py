"""Plan-shape assertions: pushdown, pruning, shuffle structure."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import functions as F

from meterlake.operators import build_gold_peak, feeder_baseline
from meterlake.plans import insights as I
from meterlake.plans import qa as Q
from meterlake.plans.layers import build_layers
from meterlake.schemas import BRONZE
from meterlake.sources.bronze import read_bronze, run_date_slice
from meterlake.sources.fixtures import readings

from tests.conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _bronze_files(spark, path):
    readings(spark, SF_SMALL).write.mode("overwrite").parquet(path)
    return read_bronze(spark, path)


def test_bronze_scan_uses_declared_schema(spark, tmp_warehouse):
    bronze = _bronze_files(spark, f"{tmp_warehouse}/bronze")
    assert bronze.schema == BRONZE


def test_run_date_slice_is_pushed_to_the_scan(spark, tmp_warehouse):
    bronze = _bronze_files(spark, f"{tmp_warehouse}/bronze")
    p = plan(run_date_slice(bronze, "2024-01-12"))
    pushed = [line for line in p.splitlines() if "PushedFilters" in line][0]
    assert "GreaterThanOrEqual(data_collection_log_timestamp" in pushed
    assert "LessThan(data_collection_log_timestamp" in pushed


def test_baseline_reads_three_columns(spark, tmp_warehouse):
    bronze = _bronze_files(spark, f"{tmp_warehouse}/bronze")
    p = plan(feeder_baseline(bronze))
    schema = [line for line in p.splitlines() if "ReadSchema" in line][0]
    assert schema.split("struct<", 1)[1].count(":") == 3
    for c in ("total_consumption_active_import", "secondary_substation_unique_id", "lv_feeder_unique_id"):
        assert c in schema


def test_gold_peak_is_one_grouping_without_window_or_self_join(spark):
    L = build_layers(readings(spark, SF_SMALL))
    tree = plan(build_gold_peak(L.gold_in)).split("\n\n")[0]
    assert "Window" not in tree
    # the only join is the feeder baseline attachment
    assert tree.count("Join") == 1 and "Join LeftOuter" in tree


def test_totals_are_scalar_subqueries_not_cross_joins(spark):
    L = build_layers(readings(spark, SF_SMALL))
    for df in (
        I.substation_concentration(L.peak),
        I.dno_share(L.peak),
        I.chart_concentration(L.peak),
        Q.qa_business_rules(L.silver, L.peak, "2024-01-12"),
        Q.qa_completeness(L.silver, L.profile, "2024-01-12"),
        Q.qa_uniqueness(L.peak, L.profile, "2024-01-12"),
    ):
        p = plan(df)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
        assert "Subquery" in p


def test_unpartitioned_windows_only_after_a_limit(spark):
    L = build_layers(readings(spark, SF_SMALL))
    p = plan(I.substation_concentration(L.peak))
    assert "TakeOrderedAndProject" in p or "Limit" in p


def test_qa_prunes_to_one_partition_of_written_tables(spark, tmp_warehouse):
    L = build_layers(readings(spark, SF_SMALL))
    base = f"{tmp_warehouse}/silver"
    L.silver.write.mode("overwrite").partitionBy("collection_date").parquet(base)
    silver = spark.read.parquet(base)
    p = plan(Q.qa_nulls(silver, "2024-01-12"))
    part = [line for line in p.splitlines() if "PartitionFilters" in line][0]
    assert "collection_date" in part and "2024-01-12" in part
    # previous-day lookup: the latest earlier date is a scalar subquery used as a partition filter
    p2 = plan(Q.previous_day(silver, "2024-01-12"))
    assert "PartitionFilters: [isnotnull(collection_date" in p2 and "Subquery" in p2
    assert Q.previous_day(silver, "2024-01-12").collect()[0].collection_date.isoformat() == "2024-01-11"


def test_quality_join_is_left_outer_equi_join(spark):
    L = build_layers(readings(spark, SF_SMALL))
    p = plan(L.silver)
    assert "LeftOuter" in p and "CartesianProduct" not in p


def test_gold_from_written_silver_reads_only_needed_columns(spark, tmp_warehouse):
    from meterlake.operators import build_gold_load_profile, gold_input

    L = build_layers(readings(spark, SF_SMALL))
    path = f"{tmp_warehouse}/silver_day"
    L.silver.write.parquet(path)
    gin = gold_input(spark.read.parquet(path))
    for df in (build_gold_peak(gin), build_gold_load_profile(gin)):
        schema = [line for line in plan(df).splitlines() if "ReadSchema" in line][0]
        for unused in ("geometry", "bbox", "zscore_mean", "consumption_zscore", "dataset_id"):
            assert unused not in schema
        assert "adjusted_total_consumption_active_import" in schema
        pushed = [line for line in plan(df).splitlines() if "PushedFilters" in line][0]
        assert "dq_action" in pushed  # the DROP filter reaches the scan


def test_the_suite_reads_each_table_once(spark, tmp_warehouse):
    from meterlake.sinks.writers import partition_days

    L = build_layers(readings(spark, SF_SMALL))
    base = f"{tmp_warehouse}/suite"
    L.silver.write.partitionBy("collection_date").parquet(f"{base}/silver")
    L.peak.write.partitionBy("consumption_date").parquet(f"{base}/peak")
    L.profile.write.partitionBy("consumption_date").parquet(f"{base}/profile")
    tables = [spark.read.parquet(f"{base}/{t}") for t in ("silver", "peak", "profile")]
    days = partition_days(spark, f"{base}/silver", "collection_date")
    for day in ("2024-01-12", "2024-01-01", "2024-03-01"):
        suite = Q.qa_suite(*tables, day, days)
        p = suite._jdf.queryExecution().executedPlan().toString()
        assert p.count("FileScan parquet") == 3
        checks = Q.run_checks(*tables, day, days)
        want = [checks[n].first()[Q.STATUS_COLUMNS[n]] for n in Q.CHECKS]
        assert [r.status for r in suite.collect()] == want
        measures = Q.suite_measures(*tables, day, days).first().asDict()
        for name in ("qa_completeness", "qa_uniqueness", "qa_nulls"):
            row = checks[name].first().asDict()
            assert {k: measures[k] for k in row if k in measures} == {k: v for k, v in row.items() if k in measures}


def test_insights_from_groupings_equal_the_single_ones(spark):
    from meterlake.registry import f32_all

    for variant, where in (("dirty", "true"), ("clean", "false")):
        L = build_layers(readings(spark, SF_SMALL, variant))
        peak, profile = L.peak.where(where), L.profile.where(where)
        grouped = I.grouped_insights(I.peak_groupings(peak), I.profile_groupings(profile))
        for name, df in I.all_insights(peak, profile).items():
            got = grouped[name]
            assert got.dtypes == df.dtypes, name
            assert sorted(map(str, f32_all(got).collect())) == sorted(map(str, f32_all(df).collect())), name
    tree = I.peak_groupings(L.peak)._jdf.queryExecution().executedPlan().toString()
    assert tree.count("Expand [") == 1
