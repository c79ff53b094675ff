"""One test per behaviour the engine must hold (quirks included)."""

from __future__ import annotations

import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from meterlake.config import load_config, parse_run_date
from meterlake.operators import (
    apply_zscore_quality_flag,
    build_gold_load_profile,
    build_gold_peak,
    build_gold_peak_ranked,
    build_silver,
    gold_input,
)
from meterlake.plans import insights as I
from meterlake.plans import qa as Q
from meterlake.plans.layers import build_layers
from meterlake.sources.fixtures import readings

from tests.conftest import SF_SMALL
from tests.test_reference_cases import SCHEMA, _df, _history, _row


def test_low_outlier_is_raised_to_the_upper_cap(spark):
    # two-sided detection, one-sided cap
    current = build_silver(_df(spark, [_row(1.0)]))
    history = build_silver(_history(spark, [100.0, 110.0, 90.0]))
    r = apply_zscore_quality_flag(current, history, threshold=3.0, min_history_rows=3).collect()[0]
    assert r.dq_action == "CLIP"
    assert r.adjusted_total_consumption_active_import > 100.0


def test_low_clip_on_fixture(spark):
    L = build_layers(readings(spark, SF_SMALL), threshold=0.9)
    low = L.silver.filter(
        (F.col("dq_action") == "CLIP") & (F.col("total_consumption_active_import") < F.col("zscore_mean"))
    )
    raised = low.filter(F.col("adjusted_total_consumption_active_import") > F.col("total_consumption_active_import"))
    assert low.count() > 0 and low.count() == raised.count()


def test_null_key_group_keeps_stats_but_not_peak(spark):
    rows = [_row(100.0), _row(150.0, ts=datetime(2024, 2, 12, 0, 30))]
    df = _df(spark, rows).withColumn("dno_alias", F.lit(None).cast("string"))
    silver = build_silver(df)
    for peak in (build_gold_peak(silver), build_gold_peak_ranked(silver)):
        r = peak.collect()[0]
        assert r.peak_consumption is None and r.peak_timestamp is None
        assert r.daily_total_consumption == 250.0 and r.reading_count == 2


def test_peak_ties_take_the_earliest_time(spark):
    rows = [
        _row(150.0, ts=datetime(2024, 2, 12, 5, 0), feeder="F1"),
        _row(150.0, ts=datetime(2024, 2, 12, 1, 0), feeder="F2"),
        _row(90.0, ts=datetime(2024, 2, 12, 0, 0), feeder="F3"),
    ]
    silver = build_silver(_df(spark, rows))
    r = build_gold_peak(silver).collect()[0]
    assert r.peak_consumption == 150.0
    assert r.peak_timestamp == datetime(2024, 2, 12, 1, 0)
    assert r.feeder_count == 3
    assert sorted(build_gold_peak(silver).collect()) == sorted(build_gold_peak_ranked(silver).collect())


def test_null_consumption_is_never_the_peak(spark):
    rows = [_row(None, ts=datetime(2024, 2, 12, 0, 0)), _row(80.0, ts=datetime(2024, 2, 12, 3, 0))]
    silver = build_silver(_df(spark, rows))
    r = build_gold_peak(silver).collect()[0]
    assert r.peak_consumption == 80.0 and r.peak_timestamp == datetime(2024, 2, 12, 3, 0)


def test_offgrid_minutes_fail_profile_uniqueness(spark):
    L = build_layers(readings(spark, SF_SMALL, "offgrid"))
    r = Q.qa_uniqueness(L.peak, L.profile, "2024-01-12").collect()[0]
    assert r.profile_duplicate_key_count > 0 and r.uniqueness_status == "FAIL"
    clean = build_layers(readings(spark, SF_SMALL))
    assert Q.qa_uniqueness(clean.peak, clean.profile, "2024-01-12").collect()[0].profile_duplicate_key_count == 0


def test_malformed_text_becomes_null_not_an_error(spark):
    schema = SCHEMA.replace("total_consumption_active_import double", "total_consumption_active_import string")
    schema = schema.replace("data_collection_log_timestamp timestamp", "data_collection_log_timestamp string")
    rows = [_row("12.5", ts="2024-02-12 00:30:00"), _row("n/a", ts="not a time")]
    silver = build_silver(_df(spark, rows, schema)).orderBy("total_consumption_active_import").collect()
    assert silver[0].total_consumption_active_import is None and silver[0].data_collection_log_timestamp is None
    assert silver[1].total_consumption_active_import == 12.5
    assert silver[1].half_hour_slot == 1 and silver[1].collection_date == date(2024, 2, 12)


def test_composite_id_skips_nulls_and_strict_form_does_not(spark):
    from meterlake.operators import with_strict_composite_id

    df = build_silver(_df(spark, [_row(1.0, sub=None, feeder="F9")]))
    r = with_strict_composite_id(df).collect()[0]
    assert r.composite_feeder_id == "F9" and r.composite_id_strict is None


def test_blank_means_spaces_only(spark):
    rows = [_row(1.0, sub="   "), _row(1.0, sub="\t")]
    out = apply_zscore_quality_flag(build_silver(_df(spark, rows)), build_silver(_history(spark, [1.0])),
                                    threshold=3.0, min_history_rows=1)
    actions = {r.secondary_substation_unique_id: r.dq_action for r in out.collect()}
    assert actions["   "] == "DROP" and actions["\t"] == "KEEP"


def test_null_time_is_dropped_when_called_directly(spark):
    silver = build_silver(_df(spark, [_row(5.0, ts=None)]))
    r = apply_zscore_quality_flag(silver, silver, threshold=3.0, min_history_rows=1).collect()[0]
    assert r.dq_action == "DROP"


def test_nan_consumption_passes_validity_and_is_clipped(spark):
    current = build_silver(_df(spark, [_row(float("nan"))]))
    history = build_silver(_history(spark, [100.0, 110.0, 90.0]))
    r = apply_zscore_quality_flag(current, history, threshold=3.0, min_history_rows=3).collect()[0]
    assert r.dq_action == "CLIP"
    assert not math.isnan(r.adjusted_total_consumption_active_import)


def test_weekend_flags_and_day_names(spark):
    rows = [_row(1.0, ts=datetime(2024, 1, 13, 10, 0)), _row(1.0, ts=datetime(2024, 1, 15, 10, 0))]
    out = {r.day_of_week: r.is_weekend for r in build_silver(_df(spark, rows)).collect()}
    assert out == {"Sat": True, "Mon": False}


def test_empty_day_sums_are_null_and_fail(spark):
    L = build_layers(readings(spark, SF_SMALL))
    nulls = Q.qa_nulls(L.silver, "2024-03-01").collect()[0]
    assert nulls.null_substation_id is None and nulls.null_check_status == "FAIL"
    rules = Q.qa_business_rules(L.silver, L.peak, "2024-03-01").collect()[0]
    assert rules.bad_active_devices is None and rules.business_rule_status == "FAIL"
    assert rules.current_row_count == 0 and rules.previous_row_count is not None
    fresh = Q.qa_freshness(L.silver, "2024-03-01").collect()[0]
    assert fresh.row_count == 0 and fresh.freshness_status == "FAIL"


def test_first_day_has_no_previous_day_and_passes_drift(spark):
    L = build_layers(readings(spark, SF_SMALL))
    r = Q.qa_business_rules(L.silver, L.peak, "2024-01-01").collect()[0]
    assert r.previous_row_count is None and r.row_count_change_ratio is None
    assert r.business_rule_status == "PASS"


def test_zero_previous_average_fails_without_error(spark):
    rows = [
        _row(0.0, ts=datetime(2024, 1, 1, 0, 0)),
        _row(5.0, ts=datetime(2024, 1, 2, 0, 0)),
    ]
    L = build_layers(_df(spark, rows), threshold=3.0, min_history_rows=1)
    r = Q.qa_business_rules(L.silver, L.peak, "2024-01-02").collect()[0]
    assert r.previous_avg_consumption == 0.0
    assert r.avg_consumption_change_ratio is None
    assert r.business_rule_status == "FAIL"


def test_dirty_day_fails_business_rules_on_drop_rows(spark):
    L = build_layers(readings(spark, SF_SMALL, "dirty"))
    days = [r.collection_date for r in L.silver.filter("dq_action = 'DROP'").select("collection_date").distinct().collect()]
    d = str(days[0])
    r = Q.qa_business_rules(L.silver, L.peak, d).collect()[0]
    assert r.business_rule_status == "FAIL"


def test_zero_total_share_is_null(spark):
    rows = [_row(0.0)]
    L = build_layers(_df(spark, rows), min_history_rows=1)
    r = I.dno_share(L.peak).collect()[0]
    assert r.total_consumption == 0.0 and r.share_of_total is None
    c = I.substation_concentration(L.peak).collect()[0]
    assert c.share_of_total is None


def test_config_keeps_explicit_zero():
    cfg = load_config(zscore_threshold=0.0, zscore_min_history_rows=0, run_date="2024-01-12")
    assert cfg.zscore_threshold == 0.0 and cfg.zscore_min_history_rows == 0
    assert parse_run_date("2024-01-12") == date(2024, 1, 12)
    assert parse_run_date("AUTO") == parse_run_date(None)


def test_slot_labels(spark):
    from meterlake.functions import slot_to_hhmm

    df = spark.range(48).select(F.col("id").cast("int").alias("slot"))
    labels = [r.l for r in df.select(slot_to_hhmm("slot").alias("l")).orderBy("slot").collect()]
    assert labels[0] == "00:00" and labels[1] == "00:30" and labels[35] == "17:30" and labels[47] == "23:30"


def test_profile_groups_on_hour_minute_and_slot(spark):
    rows = [_row(1.0, ts=datetime(2024, 2, 12, 0, 10)), _row(3.0, ts=datetime(2024, 2, 12, 0, 20))]
    prof = build_gold_load_profile(gold_input(apply_zscore_quality_flag(
        build_silver(_df(spark, rows)), build_silver(_df(spark, rows)), threshold=3.0, min_history_rows=1)))
    assert prof.count() == 2 and {r.half_hour_slot for r in prof.collect()} == {0}


def test_summary_has_the_findings(spark):
    L = build_layers(readings(spark, SF_SMALL))
    rows = I.insight_summary(L.peak, L.profile).collect()
    names = [r.finding for r in rows]
    assert names[:8] == [
        "top_substation", "highest_demand_day", "load_shape_peak_trough", "weekday_weekend_delta",
        "demand_concentration", "peak_timing", "volatility", "evening_ramp",
    ]
    text = {r.finding: r.line for r in I.findings_text(I.insight_summary(L.peak, L.profile)).collect()}
    assert list(text) == names and all(text.values())
    assert f"{rows[0].value_1:,.2f} on average" in text["top_substation"]
    assert f"{rows[4].value_1:.2f}% of all demand" in text["demand_concentration"]


def test_rank_of_a_hot_group_split_across_partitions(spark):
    from meterlake.operators import peak_rank

    rows = [
        (date(2024, 1, 1), "A", "HOT", f"HOT-F{i % 7}", float(i % 50), datetime(2024, 1, 1, (i * 7) % 24, 0), 1)
        for i in range(400)
    ] + [(date(2024, 1, 1), "A", "COLD", "COLD-F1", 3.0, datetime(2024, 1, 1, 1, 0), 1)] + [
        (date(2024, 1, 1), "A", "COPY", "COPY-F1", 7.0, datetime(2024, 1, 1, 2, 0), 1)
    ] * 300
    schema = (
        "collection_date date, dno_alias string, secondary_substation_unique_id string, composite_feeder_id string, "
        "total_consumption_active_import double, data_collection_log_timestamp timestamp, "
        "aggregated_device_count_active bigint"
    )
    df = spark.createDataFrame(rows, schema).repartition(8)
    ranked = peak_rank(df, hot_rows=50)
    hot = sorted((r.peak_rank, r.total_consumption_active_import, r.data_collection_log_timestamp)
                 for r in ranked.filter("secondary_substation_unique_id = 'HOT'").collect())
    assert [h[0] for h in hot] == list(range(1, 401))
    expected = sorted(((r[4], r[5]) for r in rows[:400]), key=lambda v: (-v[0], v[1]))
    assert [(h[1], h[2]) for h in hot] == expected
    assert ranked.filter("secondary_substation_unique_id = 'COLD'").collect()[0].peak_rank == 1
    copies = sorted(r.peak_rank for r in ranked.filter("secondary_substation_unique_id = 'COPY'").collect())
    assert copies == list(range(1, 301))


@pytest.mark.parametrize("hot_rows", [0, 30, 10**6])
def test_ranks_are_the_same_however_groups_are_cut(spark, hot_rows):
    import random

    from meterlake.operators import peak_rank

    rng = random.Random(hot_rows)
    values = [None, float("nan"), float("inf"), float("-inf"), 0.0, -3.5, 7.0, 7.0, 7.0] + [rng.uniform(-5, 50) for _ in range(40)]
    times = [None] + [datetime(2024, 1, 1, h, m, s) for h in (0, 3, 23) for m in (0, 29, 30) for s in (0, 5)]
    keys = [(date(2024, 1, 1), "A", "BIG"), (date(2024, 1, 1), None, "BIG"), (date(2024, 1, 2), "B", None), (None, None, "x"), (date(2024, 1, 3), "B", "few")]
    rows = []
    for i, key in enumerate(keys):
        for k in range(3 if key[2] == "few" else 260):
            v = 7.0 if i == 1 and k % 4 else rng.choice(values)
            rows.append((*key, f"f{k % 5}", v, rng.choice(times), k))
    schema = (
        "collection_date date, dno_alias string, secondary_substation_unique_id string, composite_feeder_id string, "
        "total_consumption_active_import double, data_collection_log_timestamp timestamp, n bigint"
    )
    ranked = peak_rank(spark.createDataFrame(rows, schema).repartition(6), hot_rows)
    got = {}
    for r in ranked.collect():
        got.setdefault(tuple(r)[:3], []).append((r.peak_rank, r.total_consumption_active_import, r.data_collection_log_timestamp))

    def order(value, time):
        size = (2, 0.0) if value is None else (0, 0.0) if value != value else (1, -value)
        return (*size, time is not None, time or datetime(1970, 1, 1))

    for key in keys:
        want = sorted(((r[4], r[5]) for r in rows if r[:3] == key), key=lambda x: order(*x))
        mine = sorted(got[key], key=lambda x: x[0])
        assert [m[0] for m in mine] == list(range(1, len(want) + 1))
        assert [order(*m[1:]) for m in mine] == [order(*w) for w in want]


def test_peak_rank_is_lazy_and_reads_what_is_asked_for(spark, tmp_warehouse):
    from meterlake.operators import peak_rank
    from meterlake.plans.layers import build_layers

    path = f"{tmp_warehouse}/gold_in"
    build_layers(readings(spark, SF_SMALL)).gold_in.write.parquet(path)
    df = peak_rank(spark.read.parquet(path)).select("secondary_substation_unique_id", "peak_rank", "total_consumption_active_import")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan and "rangepartitioning" not in plan
    main = [line for line in plan.splitlines() if "ReadSchema" in line and "geometry" in line]
    assert not main
