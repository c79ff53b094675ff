"""Property tests: Spark operators against a plain-Python brute force on random small inputs."""

from __future__ import annotations

import math
from datetime import date, datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from meterlake.operators import apply_zscore_quality_flag, build_gold_peak, build_gold_peak_ranked

PEAK_SCHEMA = (
    "collection_date date, dno_alias string, secondary_substation_unique_id string, composite_feeder_id string, "
    "total_consumption_active_import double, data_collection_log_timestamp timestamp, "
    "aggregated_device_count_active bigint"
)

reading = st.tuples(
    st.sampled_from([date(2024, 1, 1), date(2024, 1, 2)]),
    st.sampled_from(["A", "B", None]),
    st.sampled_from(["S1", "S2"]),
    st.sampled_from(["F1", "F2", "F3"]),
    st.sampled_from([None, 0.0, 1.0, 2.0, 2.0, 5.5]),
    st.sampled_from([None, datetime(2024, 1, 1, 0, 0), datetime(2024, 1, 1, 0, 30), datetime(2024, 1, 1, 5, 0)]),
    st.integers(min_value=1, max_value=4),
)


def _brute_peak(rows):
    groups: dict = {}
    for r in rows:
        groups.setdefault((r[0], r[1], r[2]), []).append(r)
    out = {}
    for key, rs in groups.items():
        values = [r[4] for r in rs if r[4] is not None]
        best = sorted(
            rs,
            key=lambda r: (r[4] is None, -(r[4] or 0.0), r[5] is not None, r[5] or datetime.min),
        )[0]
        keyed = all(k is not None for k in key)
        out[key] = (
            best[4] if keyed else None,
            best[5] if keyed else None,
            sum(values) if values else None,
            len({f"{r[2]}-{r[3]}" for r in rs}),
            len(rs),
        )
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(reading, min_size=1, max_size=12))
def test_peak_matches_brute_force(spark, rows):
    data = [(d, dno, s, f"{s}-{f}", c, ts, n) for d, dno, s, f, c, ts, n in rows]
    df = spark.createDataFrame(data, PEAK_SCHEMA)
    want = _brute_peak([(d, dno, s, f, c, ts, n) for d, dno, s, f, c, ts, n in rows])
    for impl in (build_gold_peak, build_gold_peak_ranked):
        got = {
            (r.consumption_date, r.dno_alias, r.secondary_substation_unique_id): (
                r.peak_consumption, r.peak_timestamp, r.daily_total_consumption, r.feeder_count, r.reading_count
            )
            for r in impl(df).collect()
        }
        assert got == want, impl.__name__


DQ_SCHEMA = (
    "dataset_id string, composite_feeder_id string, secondary_substation_unique_id string, "
    "total_consumption_active_import double, data_collection_log_timestamp timestamp, "
    "aggregated_device_count_active bigint"
)

history_value = st.one_of(st.none(), st.integers(min_value=0, max_value=50).map(float))
current_value = st.one_of(st.none(), st.integers(min_value=-5, max_value=200).map(float))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from(["F1", "F2"]), history_value), min_size=0, max_size=15),
    st.lists(st.tuples(st.sampled_from(["F1", "F2", "F3"]), current_value, st.integers(-1, 3)), min_size=1, max_size=8),
    st.sampled_from([0.5, 1.0, 3.0]),
    st.integers(min_value=1, max_value=4),
)
def test_zscore_policy_matches_brute_force(spark, history, current, threshold, min_rows):
    ts = datetime(2024, 1, 1)
    hist = spark.createDataFrame(
        [(f"h{i}", f, "S", v, ts, 1) for i, (f, v) in enumerate(history)] or [("h", "none", "S", 1.0, ts, 1)],
        DQ_SCHEMA,
    )
    cur = spark.createDataFrame(
        [(f"c{i}", f, "S", v, ts, n) for i, (f, v, n) in enumerate(current)], DQ_SCHEMA
    )
    got = {r.dataset_id: r for r in apply_zscore_quality_flag(cur, hist, threshold=threshold,
                                                              min_history_rows=min_rows).collect()}
    hist_rows = history or [("none", 1.0)]
    for i, (f, v, n) in enumerate(current):
        vals = [x for g, x in hist_rows if g == f and x is not None]
        count = sum(1 for g, _ in hist_rows if g == f)
        mean = sum(vals) / len(vals) if vals else None
        std = math.sqrt(sum((x - mean) ** 2 for x in vals) / len(vals)) if vals else None
        invalid = v is None or v < 0 or n <= 0
        scored = count >= min_rows and std is not None and std > 0
        z = abs((v - mean) / std) if scored and v is not None else None
        outlier = scored and z is not None and z > threshold
        action = "DROP" if invalid else "CLIP" if outlier else "KEEP"
        r = got[f"c{i}"]
        assert r.dq_action == action
        assert r.zscore_history_count == (count or None)
        if action == "CLIP":
            assert math.isclose(r.adjusted_total_consumption_active_import, mean + threshold * std, rel_tol=1e-9)
        else:
            assert r.adjusted_total_consumption_active_import == v


QA_SILVER = (
    "collection_date date, aggregated_device_count_active bigint, total_consumption_active_import double, "
    "consumption_per_active_device double"
)
QA_PEAK = "consumption_date date, peak_consumption double, daily_total_consumption double"
qa_row = st.tuples(
    st.sampled_from([date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)]),
    st.one_of(st.none(), st.integers(-1, 3)),
    st.one_of(st.none(), st.integers(-2, 6).map(float)),
    st.one_of(st.none(), st.integers(-1, 2).map(float)),
)
peak_row = st.tuples(
    st.sampled_from([date(2024, 1, 2), date(2024, 1, 3)]),
    st.one_of(st.none(), st.integers(0, 9).map(float)),
    st.one_of(st.none(), st.integers(0, 9).map(float)),
)


def _brute_rules(rows, peaks, day):
    cur = [r for r in rows if r[0] == day]

    def flag(idx, bad):
        return sum(1 for r in cur if r[idx] is not None and bad(r[idx])) if cur else None

    bad_dev, bad_c, bad_pd = flag(1, lambda v: v <= 0), flag(2, lambda v: v < 0), flag(3, lambda v: v < 0)
    bad_peak = sum(1 for p in peaks if p[0] == day and p[1] is not None and p[2] is not None and p[1] > p[2])
    earlier = [r[0] for r in rows if r[0] < day]
    prev = [r for r in rows if earlier and r[0] == max(earlier)]

    def mean(rs):
        vals = [r[2] for r in rs if r[2] is not None]
        return sum(vals) / len(vals) if vals else None

    cur_n, cur_avg = len(cur), mean(cur)
    prev_n = len(prev) if prev else None
    prev_avg = mean(prev) if prev else None
    row_ratio = abs((cur_n - prev_n) / float(prev_n)) if prev_n else None
    avg_ratio = abs((cur_avg - prev_avg) / prev_avg) if prev_avg not in (None, 0.0) and cur_avg is not None else None
    ok = (
        bad_dev == 0 and bad_c == 0 and bad_pd == 0 and bad_peak == 0
        and (prev_n is None or (row_ratio is not None and row_ratio <= 0.2))
        and (prev_avg is None or (avg_ratio is not None and avg_ratio <= 0.3))
    )
    return (bad_dev, bad_c, bad_pd, bad_peak, cur_n, prev_n, row_ratio, avg_ratio, "PASS" if ok else "FAIL")


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(qa_row, min_size=0, max_size=14), st.lists(peak_row, min_size=0, max_size=4))
def test_business_rules_match_brute_force(spark, rows, peaks):
    from meterlake.plans.qa import qa_business_rules

    day = date(2024, 1, 3)
    silver = spark.createDataFrame(rows, QA_SILVER)
    peak = spark.createDataFrame(peaks, QA_PEAK)
    r = qa_business_rules(silver, peak, day).collect()[0]
    got = (r.bad_active_devices, r.bad_consumption, r.bad_consumption_per_device, r.bad_peak_rows,
           r.current_row_count, r.previous_row_count, r.row_count_change_ratio, r.avg_consumption_change_ratio,
           r.business_rule_status)
    assert got == _brute_rules(rows, peaks, day)
