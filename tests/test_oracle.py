"""Spark results equal the independent DuckDB SQL (a representative subset, on sf0.001).

``python tests/oracle_check.py /root/testdata/sf0.01`` runs every key at the
driver's scale.
"""

from __future__ import annotations

import pytest

from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck

KEYS = [
    "silver_build",
    "dq_zscore_dirty",
    "dq_zscore_low_clip",
    "gold_peak",
    "gold_peak_dirty",
    "gold_profile",
    "hourly_summary",
    "distinct_counts",
    "missing_slots",
    "qa_completeness",
    "qa_business_rules",
    "qa_business_rules_first_day",
    "insight_substation_concentration",
    "insight_dno_outlier_screen",
    "insight_peak_window",
    "chart_concentration",
    "backfill_range",
    "backfill_run_log",
    "write_silver_moments_late",
    "table_run_log",
    "export_json_nulls",
    "silver_text_time",
    "insight_text",
]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_matches_duckdb(spark, con, key):
    r = compare(spark, SF_SMALL, key, con)
    assert r["ok"], r


def test_every_key_is_registered_with_sql_or_listed_rows_only():
    import __spark_entry__ as E

    from meterlake.registry import queries

    assert set(queries()) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())
