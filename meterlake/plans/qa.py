"""Data-quality checks for one run date (freshness, completeness, uniqueness, nulls, business rules).

Each check is one small DataFrame with one row. Filters on
``collection_date`` / ``consumption_date`` prune to the day's partition when
the tables are partitioned parquet. Values from other tables are scalar
subqueries (``DataFrame.scalar()``), never joins.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.config import AVG_DRIFT_LIMIT, ROW_DRIFT_LIMIT, SLOTS_PER_DAY

TS = "data_collection_log_timestamp"
SUB = "secondary_substation_unique_id"
CONSUMPTION = "total_consumption_active_import"


def _day(d: date | str) -> Column:
    return F.lit(str(d)).cast("date")


def _status(ok: Column) -> Column:
    """PASS only when the condition is TRUE (NULL -> FAIL)."""
    return F.when(ok, F.lit("PASS")).otherwise(F.lit("FAIL"))


def _flag_sum(cond: Column) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END): NULL on an empty day."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def silver_day(silver: DataFrame, run_date) -> DataFrame:
    return silver.filter(F.col("collection_date") == _day(run_date))


def gold_day(gold: DataFrame, run_date) -> DataFrame:
    return gold.filter(F.col("consumption_date") == _day(run_date))


def qa_freshness(silver: DataFrame, run_date) -> DataFrame:
    return silver_day(silver, run_date).agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(str(run_date)).alias("run_date"),
        "row_count",
        _status(F.col("row_count") > 0).alias("freshness_status"),
    )


def missing_slots(profile: DataFrame, run_date=None) -> DataFrame:
    """Expected slots 0..47 with no load-profile row (per date, or for one date).

    The expected grid is generated from the distinct dates present (one
    ``explode`` per date), then anti-joined on (date, slot).
    """
    if run_date is None:
        grid_src = profile
        dates = profile.select("consumption_date").distinct()
    else:
        # the run date is expected even when it has no profile rows at all
        grid_src = gold_day(profile, run_date)
        dates = profile.sparkSession.range(1).select(_day(run_date).alias("consumption_date"))
    expected = dates.select("consumption_date", F.explode(F.sequence(F.lit(0), F.lit(SLOTS_PER_DAY - 1))).alias("half_hour_slot"))
    present = grid_src.select("consumption_date", "half_hour_slot")
    return expected.join(present, on=["consumption_date", "half_hour_slot"], how="left_anti")


def qa_completeness(silver: DataFrame, profile: DataFrame, run_date) -> DataFrame:
    slot = F.col("half_hour_slot")
    distinct_times = silver_day(silver, run_date).agg(F.count_distinct(F.date_format(TS, "HH:mm"))).scalar()
    agg = gold_day(profile, run_date).agg(
        F.count(F.lit(1)).alias("slot_rows"),
        F.count_distinct(_present_slots(slot)).alias("present"),
    )
    # each scalar subquery is projected once; later expressions use the column
    measured = agg.select(
        F.lit(str(run_date)).alias("run_date"),
        "slot_rows",
        (F.lit(SLOTS_PER_DAY) - F.col("present")).cast("bigint").alias("missing_slot_count"),
        distinct_times.alias("distinct_timestamp_count"),
    )
    return measured.withColumn("completeness_status", _status(_complete()))


def _complete() -> Column:
    return (F.col("missing_slot_count") == 0) & (F.col("distinct_timestamp_count") == SLOTS_PER_DAY)


def _unique() -> Column:
    return (F.col("peak_duplicate_key_count") == 0) & (F.col("profile_duplicate_key_count") == 0)


def _no_nulls() -> Column:
    return (F.col("null_substation_id") == 0) & (F.col("null_timestamp") == 0) & (F.col("null_consumption") == 0)


def _present_slots(slot: Column) -> Column:
    return F.when(slot.between(0, SLOTS_PER_DAY - 1), slot)


def _duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > 1)


def qa_uniqueness(peak: DataFrame, profile: DataFrame, run_date) -> DataFrame:
    """Duplicate (date, substation) peak keys and (date, slot) profile keys."""
    profile_dupes = _duplicate_keys(gold_day(profile, run_date), ["consumption_date", "half_hour_slot"])
    profile_count = profile_dupes.agg(F.count(F.lit(1))).scalar()
    peak_dupes = _duplicate_keys(gold_day(peak, run_date), ["consumption_date", SUB])
    measured = peak_dupes.agg(F.count(F.lit(1)).alias("peak_duplicate_key_count")).select(
        F.lit(str(run_date)).alias("run_date"),
        "peak_duplicate_key_count",
        profile_count.alias("profile_duplicate_key_count"),
    )
    return measured.withColumn("uniqueness_status", _status(_unique()))


def qa_nulls(silver: DataFrame, run_date) -> DataFrame:
    return silver_day(silver, run_date).agg(*_null_counts()).select(
        F.lit(str(run_date)).alias("run_date"),
        "null_substation_id",
        "null_timestamp",
        "null_consumption",
        _status(_no_nulls()).alias("null_check_status"),
    )


def _null_counts() -> list[Column]:
    columns = {"null_substation_id": SUB, "null_timestamp": TS, "null_consumption": CONSUMPTION}
    return [_flag_sum(F.col(c).isNull()).alias(name) for name, c in columns.items()]


def _value_counts() -> list[Column]:
    """The day's broken value rules, its rows and its average."""
    return [
        _flag_sum(F.col("aggregated_device_count_active") <= 0).alias("bad_active_devices"),
        _flag_sum(F.col(CONSUMPTION) < 0).alias("bad_consumption"),
        _flag_sum(F.col("consumption_per_active_device") < 0).alias("bad_consumption_per_device"),
        F.count(F.lit(1)).alias("current_row_count"),
        F.avg(CONSUMPTION).alias("current_avg_consumption"),
    ]


def previous_day(silver: DataFrame, run_date, days: list[str] | None = None) -> DataFrame:
    """Row count and average of the latest Silver day before ``run_date`` (0 or 1 row).

    ``days`` are the days that Silver's folders have (``partition_days``): the day
    before is then taken from that list and only its folder is read. Without them
    it is a scalar subquery over Silver's own dates.
    """
    return (
        silver.filter(F.col("collection_date") == _day_before(silver, run_date, days))
        .groupBy("collection_date")
        .agg(F.count(F.lit(1)).alias("row_count"), F.avg(CONSUMPTION).alias("avg_consumption"))
    )


def _day_before(silver: DataFrame, run_date, days: list[str] | None) -> Column:
    if days is None:
        return silver.filter(F.col("collection_date") < _day(run_date)).agg(F.max("collection_date")).scalar()
    earlier = [d for d in days if d < str(run_date)]
    return _day(max(earlier)) if earlier else F.lit(None).cast("date")


def qa_business_rules(silver: DataFrame, peak: DataFrame, run_date, days: list[str] | None = None) -> DataFrame:
    """Value rules on the day plus row-count and average drift against the previous day."""
    prev = previous_day(silver, run_date, days).agg(
        F.struct(F.max("row_count").alias("n"), F.max("avg_consumption").alias("a"))
    ).scalar()
    bad_peak = gold_day(peak, run_date).agg(
        F.count_if(F.col("peak_consumption") > F.col("daily_total_consumption"))
    ).scalar()

    # scalar subqueries are projected once into columns; the drift logic below
    # refers to those columns, so each subquery appears (and runs) once
    measured = silver_day(silver, run_date).agg(*_value_counts()).select(
        "*", bad_peak.cast("bigint").alias("bad_peak_rows"), prev.alias("previous")
    )
    return _judged(measured, run_date)


def _judged(measured: DataFrame, run_date, keep: list[str] | None = None) -> DataFrame:
    """Drift ratios and status from the day's counts, ``bad_peak_rows`` and ``previous`` (struct n, a); ``keep`` names columns to pass on."""
    cur_n, cur_avg = F.col("current_row_count"), F.col("current_avg_consumption")
    prev_n, prev_avg = F.col("previous.n"), F.col("previous.a")
    row_ratio = F.abs(F.try_divide((cur_n - prev_n).cast("double"), prev_n.cast("double")))
    avg_ratio = F.abs(F.try_divide(cur_avg - prev_avg, prev_avg))
    with_drift = measured.select(
        F.lit(str(run_date)).alias("run_date"),
        "bad_active_devices",
        "bad_consumption",
        "bad_consumption_per_device",
        "bad_peak_rows",
        "current_row_count",
        prev_n.cast("bigint").alias("previous_row_count"),
        F.when(prev_n.isNotNull() & (prev_n != 0), row_ratio).alias("row_count_change_ratio"),
        "current_avg_consumption",
        prev_avg.alias("previous_avg_consumption"),
        F.when(prev_avg.isNotNull() & (prev_avg != 0), avg_ratio).alias("avg_consumption_change_ratio"),
        *(keep or []),
    )
    ok = (
        (F.col("bad_active_devices") == 0)
        & (F.col("bad_consumption") == 0)
        & (F.col("bad_consumption_per_device") == 0)
        & (F.col("bad_peak_rows") == 0)
        & (F.col("previous_row_count").isNull() | (F.col("row_count_change_ratio") <= F.lit(ROW_DRIFT_LIMIT)))
        # a zero previous average leaves the ratio NULL, which fails the check
        & (F.col("previous_avg_consumption").isNull() | (F.col("avg_consumption_change_ratio") <= F.lit(AVG_DRIFT_LIMIT)))
    )
    return with_drift.withColumn("business_rule_status", _status(ok))


CHECKS = ["qa_freshness", "qa_completeness", "qa_uniqueness", "qa_nulls", "qa_business_rules"]


STATUS_COLUMNS = {
    "qa_freshness": "freshness_status",
    "qa_completeness": "completeness_status",
    "qa_uniqueness": "uniqueness_status",
    "qa_nulls": "null_check_status",
    "qa_business_rules": "business_rule_status",
}


def run_checks(
    silver: DataFrame, peak: DataFrame, profile: DataFrame, run_date, days: list[str] | None = None
) -> dict[str, DataFrame]:
    return {
        "qa_freshness": qa_freshness(silver, run_date),
        "qa_completeness": qa_completeness(silver, profile, run_date),
        "qa_uniqueness": qa_uniqueness(peak, profile, run_date),
        "qa_nulls": qa_nulls(silver, run_date),
        "qa_business_rules": qa_business_rules(silver, peak, run_date, days),
    }


def suite_measures(silver: DataFrame, peak: DataFrame, profile: DataFrame, run_date, days: list[str] | None = None) -> DataFrame:
    """One row with the numbers of all checks: one aggregate over each table.

    Silver is read once for the run date and the day before, each counter by its day;
    a Gold table is grouped once by its key, and the groups are counted. ``days`` are the days
    of Silver's folders (:func:`partition_days`); without them the day before is a scalar subquery.
    """
    before = _day_before(silver, run_date, days)
    both = silver.filter((F.col("collection_date") == _day(run_date)) | (F.col("collection_date") == before))
    times = F.count_distinct(F.date_format(TS, "HH:mm")).alias("distinct_timestamp_count")
    by_day = both.groupBy("collection_date").agg(*_null_counts(), *_value_counts(), times)
    today = F.col("collection_date") == _day(run_date)
    names = [c for c in by_day.columns if c != "collection_date"]
    silver_row = by_day.agg(
        *[F.max(F.when(today, F.col(c))).alias(c) for c in names],
        F.max(F.when(~today, F.col("current_row_count"))).alias("n"),
        F.max(F.when(~today, F.col("current_avg_consumption"))).alias("a"),
    )
    above = F.count_if(F.col("peak_consumption") > F.col("daily_total_consumption")).alias("above")
    peak_row = gold_day(peak, run_date).groupBy(SUB).agg(F.count(F.lit(1)).alias("c"), above).agg(
        F.count_if(F.col("c") > 1).alias("dupes"), F.coalesce(F.sum("above"), F.lit(0)).alias("above")
    )
    slot = F.col("half_hour_slot")
    profile_row = gold_day(profile, run_date).groupBy("half_hour_slot").agg(F.count(F.lit(1)).alias("c")).agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("rows"), F.count(_present_slots(slot)).alias("present"), F.count_if(F.col("c") > 1).alias("dupes")
    )
    one = silver_row.select(
        *names,
        F.struct("n", "a").alias("previous"),
        peak_row.select(F.struct("*")).scalar().alias("p"),
        profile_row.select(F.struct("*")).scalar().alias("s"),
    )
    zero = F.lit(0).cast("bigint")
    return one.withColumns(
        {
            "distinct_timestamp_count": F.coalesce("distinct_timestamp_count", zero),
            "current_row_count": F.coalesce("current_row_count", zero),
            "slot_rows": F.col("s.rows"),
            "missing_slot_count": (F.lit(SLOTS_PER_DAY) - F.col("s.present")).cast("bigint"),
            "peak_duplicate_key_count": F.col("p.dupes"),
            "profile_duplicate_key_count": F.col("s.dupes"),
            "bad_peak_rows": F.col("p.above"),
        }
    ).drop("p", "s")


def qa_suite(silver: DataFrame, peak: DataFrame, profile: DataFrame, run_date, days: list[str] | None = None) -> DataFrame:
    """One status row per check, in fixed order, from one aggregate over each table."""
    measured = suite_measures(silver, peak, profile, run_date, days)
    statuses = {
        "qa_freshness": _status(F.col("current_row_count") > 0),
        "qa_completeness": _status(_complete()),
        "qa_uniqueness": _status(_unique()),
        "qa_nulls": _status(_no_nulls()),
    }
    judged = _judged(measured.withColumns({STATUS_COLUMNS[n]: s for n, s in statuses.items()}), run_date, list(STATUS_COLUMNS.values())[:-1])
    rows = [F.struct(F.lit(i).alias("o"), F.lit(n).alias("n"), F.col(STATUS_COLUMNS[n]).alias("s")) for i, n in enumerate(CHECKS, start=1)]
    out = judged.select("run_date", F.explode(F.array(*rows)).alias("x"))
    return out.select(
        F.col("x.o").alias("check_order"), F.col("x.n").alias("check_name"), "run_date", F.col("x.s").alias("status")
    ).orderBy("check_order")


def check_statuses(checks: dict[str, DataFrame]) -> list[dict]:
    """Run each check by itself: its row, its status, or ERROR with the reason when its query fails."""
    out = []
    for name, df in checks.items():
        try:
            row = df.first().asDict(recursive=True)
            out.append({"check_name": name, "status": row[STATUS_COLUMNS[name]], "reason": "", "row": row})
        except Exception as exc:  # noqa: BLE001 - reported for this check; the others still run
            out.append({"check_name": name, "status": "ERROR", "reason": str(exc).splitlines()[0], "row": None})
    return out


def assert_all_pass(statuses) -> None:
    """Strict mode: raise when any check does not report PASS (rows with check_name and status)."""
    failed = [r["check_name"] for r in statuses if r["status"] != "PASS"]
    if failed:
        raise RuntimeError(f"QA checks failed: {', '.join(failed)}")
