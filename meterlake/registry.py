"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query starts from the test-data adapter over the whole ``events``
table (no row subsets) and then uses the library functions. Floating-point
columns whose value depends on summation order (anything built on clipped
values, stddevs, z-scores) are compared at single precision: they are cast
to FLOAT and back to DOUBLE here and in the oracle SQL, which is an exact
IEEE rounding in both engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.functions.columns import coerce_numeric, day_range, safe_double, slot_to_hhmm
from meterlake.operators.explore import distinct_counts, feeders_per_site, hourly_summary
from meterlake.operators.gold import build_gold_peak_ranked, peak_rank
from meterlake.operators.quality import baseline_from_moments, feeder_baseline, feeder_moments, gold_input
from meterlake.operators.silver import build_silver, calendar_columns, geometry_xy, with_strict_composite_id
from meterlake.plans import insights as I
from meterlake.plans import qa as Q
from meterlake.plans.layers import Layers, build_layers, stored_insights
from meterlake.session import ensure_utc
from meterlake.sources import bronze as B
from meterlake.sources.fixtures import readings

# Fixed parameters of the registered checks.
RUN_DATE = "2024-01-12"
FIRST_DATE = "2024-01-01"
EMPTY_DATE = "2024-03-01"
RANGE_START, RANGE_END = "2024-01-10", "2024-01-12"
FULL_START, FULL_END = "2024-01-01", "2024-01-30"
INSTANT = "2024-01-12 19:00:00"
LOW_CLIP_THRESHOLD = 0.9

FLAT_BRONZE = [
    "dataset_id",
    "dno_alias",
    "aggregated_device_count_active",
    "total_consumption_active_import",
    "data_collection_log_timestamp",
    "secondary_substation_unique_id",
    "lv_feeder_unique_id",
]
SILVER_FLAT = FLAT_BRONZE + [
    "hour_of_day",
    "minute_of_hour",
    "half_hour_slot",
    "day_of_week",
    "is_weekend",
    "composite_feeder_id",
    "consumption_per_active_device",
    "collection_date",
]
DQ_FLAT = [
    "dataset_id",
    "composite_feeder_id",
    "collection_date",
    "total_consumption_active_import",
    "zscore_mean",
    "zscore_stddev",
    "zscore_history_count",
    "consumption_zscore",
    "dq_action",
    "data_quality_flag",
    "dq_reason",
    "adjusted_total_consumption_active_import",
]
DQ_NOISY: list[str] = []  # the baseline is exact, and so is what follows from it
PEAK_NOISY = ["peak_consumption", "daily_total_consumption", "avg_half_hour_consumption"]
PROFILE_NOISY = ["avg_consumption", "total_consumption", "avg_consumption_per_active_device"]


def f32(df: DataFrame, cols: list[str]) -> DataFrame:
    """Round the listed DOUBLE columns to single precision (order-noise-free comparison)."""
    return df.withColumns({c: F.col(c).cast("float").cast("double") for c in cols})


def f32_all(df: DataFrame) -> DataFrame:
    return f32(df, [f.name for f in df.schema.fields if f.dataType.typeName() == "double"])


def _bronze(spark: SparkSession, sf: str, variant: str = "clean") -> DataFrame:
    ensure_utc(spark)
    return readings(spark, sf, variant)


def _layers(spark: SparkSession, sf: str, variant: str = "clean", **kw) -> Layers:
    return build_layers(_bronze(spark, sf, variant), **kw)


# ---------------------------------------------------------------- sources / filters


def q_bronze_scan(spark, sf):
    return _bronze(spark, sf).select(*FLAT_BRONZE)


def q_readings_at_instant(spark, sf):
    return B.readings_at_instant(_bronze(spark, sf), INSTANT).select(*FLAT_BRONZE)


def q_run_date_slice(spark, sf):
    return B.run_date_slice(_bronze(spark, sf, "dirty"), RUN_DATE).select(*FLAT_BRONZE)


def q_date_range_slice(spark, sf):
    return B.date_range_slice(_bronze(spark, sf), RANGE_START, RANGE_END).select(*FLAT_BRONZE)


def q_source_date_profile(spark, sf):
    return B.source_date_profile(_bronze(spark, sf), RUN_DATE)


def q_parquet_profile(spark, sf):
    return B.parquet_profile(_bronze(spark, sf, "dirty"))


def q_silver_profile(spark, sf):
    return B.silver_profile(_layers(spark, sf).silver)


def q_preview(spark, sf):
    return B.preview(_bronze(spark, sf), ["dataset_id", "aggregated_device_count_active"], 20, order_by="dataset_id")


# ---------------------------------------------------------------- projections


def q_silver_build(spark, sf):
    return build_silver(_bronze(spark, sf, "dirty")).select(*SILVER_FLAT)


def q_calendar_columns(spark, sf):
    return calendar_columns(_bronze(spark, sf)).select("dataset_id", "year", "month", "day", "hour")


def q_geometry_xy(spark, sf):
    return geometry_xy(_bronze(spark, sf)).select("dataset_id", "geometry_x", "geometry_y")


def q_composite_id_strict(spark, sf):
    return with_strict_composite_id(build_silver(_bronze(spark, sf, "dirty"))).select(
        "dataset_id", "composite_feeder_id", "composite_id_strict"
    )


def q_slot_to_hhmm(spark, sf):
    return build_silver(_bronze(spark, sf, "offgrid")).select(
        "dataset_id", "half_hour_slot", slot_to_hhmm("half_hour_slot").alias("slot_hhmm")
    )


def q_coerce_numeric(spark, sf):
    numbers = coerce_numeric(_bronze(spark, sf), ["dataset_id", "dno_alias", "no_such_column"])
    return numbers.select(F.col("dataset_id").alias("dataset_id_value"), F.col("dno_alias").alias("dno_alias_value"))


def q_safe_double(spark, sf):
    """Blank substations and missing numbers of the dirty readings as 0."""
    df = _bronze(spark, sf, "dirty")
    digits = F.regexp_replace("secondary_substation_unique_id", "SS", "")
    return df.select(
        "dataset_id", safe_double(digits).alias("substation_number"), safe_double("total_consumption_active_import").alias("consumption")
    )


def q_silver_text_time(spark, sf):
    """Times as text: what is no time becomes NULL and the row stays."""
    return build_silver(_bronze(spark, sf, "texttime")).select(
        "dataset_id", "data_collection_log_timestamp", "half_hour_slot", "day_of_week", "collection_date"
    )


def q_silver_profile_text_time(spark, sf):
    return B.silver_profile(build_silver(_bronze(spark, sf, "texttime")))


def q_day_sequence(spark, sf):
    """Readings of each day of an inclusive range, days without readings too."""
    days = spark.range(1).select(F.explode(day_range("2023-12-30", "2024-02-02")).alias("day"))
    counts = _bronze(spark, sf).groupBy(F.to_date("data_collection_log_timestamp").alias("d")).count()
    return days.join(counts, F.col("day") == F.col("d"), "left").select("day", F.coalesce("count", F.lit(0)).alias("readings"))


# ---------------------------------------------------------------- quality


def q_feeder_baseline(spark, sf):
    return feeder_baseline(_bronze(spark, sf, "dirty"))


def q_feeder_baseline_moments(spark, sf):
    """Merged from moments by day."""
    day = F.to_date("data_collection_log_timestamp").alias("reading_date")
    return baseline_from_moments(feeder_moments(_bronze(spark, sf, "dirty"), day))


def _dq(spark, sf, variant="clean", **kw):
    return f32(_layers(spark, sf, variant, **kw).silver.select(*DQ_FLAT), DQ_NOISY)


def q_dq_zscore(spark, sf):
    return _dq(spark, sf)


def q_dq_zscore_dirty(spark, sf):
    return _dq(spark, sf, "dirty")


def q_dq_zscore_low_clip(spark, sf):
    return _dq(spark, sf, threshold=LOW_CLIP_THRESHOLD)


def q_gold_input(spark, sf):
    gin = gold_input(_layers(spark, sf).silver)
    return f32(
        gin.select("dataset_id", "dq_action", "total_consumption_active_import", "consumption_per_active_device"),
        ["total_consumption_active_import", "consumption_per_active_device"],
    )


# ---------------------------------------------------------------- gold


def q_peak_rank(spark, sf):
    ranked = peak_rank(_layers(spark, sf).gold_in)
    return f32(
        ranked.select(
            "collection_date",
            "dno_alias",
            "secondary_substation_unique_id",
            "peak_rank",
            "total_consumption_active_import",
            "data_collection_log_timestamp",
        ),
        ["total_consumption_active_import"],
    )


def q_gold_peak(spark, sf):
    return f32(_layers(spark, sf).peak, PEAK_NOISY)


def q_gold_peak_dirty(spark, sf):
    return f32(_layers(spark, sf, "dirty").peak, PEAK_NOISY)


def q_gold_peak_ranked(spark, sf):
    return f32(build_gold_peak_ranked(_layers(spark, sf).gold_in), PEAK_NOISY)


def q_gold_profile(spark, sf):
    return f32(_layers(spark, sf).profile, PROFILE_NOISY)


def q_gold_profile_offgrid(spark, sf):
    return f32(_layers(spark, sf, "offgrid").profile, PROFILE_NOISY)


# ---------------------------------------------------------------- exploration


def q_hourly_summary(spark, sf):
    return hourly_summary(_bronze(spark, sf, "dirty"))


def q_distinct_counts(spark, sf):
    return distinct_counts(_bronze(spark, sf, "dirty"))


def q_feeders_per_site(spark, sf):
    return feeders_per_site(_bronze(spark, sf, "dirty")).select(
        "secondary_substation_unique_id",
        F.col("geometry.x").alias("geometry_x"),
        F.col("geometry.y").alias("geometry_y"),
        "feeder_count",
    )


def q_transform_counts(spark, sf):
    L = _layers(spark, sf, run_date=RUN_DATE)
    peak_n = L.peak.agg(F.count(F.lit(1))).scalar()
    profile_n = L.profile.agg(F.count(F.lit(1))).scalar()
    raw = B.run_date_slice(L.bronze, RUN_DATE)
    return raw.agg(F.count(F.lit(1)).alias("raw_count")).select(
        F.lit(RUN_DATE).alias("run_date"),
        "raw_count",
        L.silver.agg(F.count(F.lit(1))).scalar().alias("silver_count"),
        peak_n.alias("peak_count"),
        profile_n.alias("load_profile_count"),
    )


# ---------------------------------------------------------------- QA


def q_missing_slots(spark, sf):
    return Q.missing_slots(_layers(spark, sf).profile)


def q_previous_day(spark, sf):
    return Q.previous_day(_layers(spark, sf).silver, RUN_DATE)


def _qa(name: str, variant: str = "clean", run_date: str = RUN_DATE):
    def run(spark, sf):
        L = _layers(spark, sf, variant)
        fn = {
            "qa_freshness": lambda: Q.qa_freshness(L.silver, run_date),
            "qa_completeness": lambda: Q.qa_completeness(L.silver, L.profile, run_date),
            "qa_uniqueness": lambda: Q.qa_uniqueness(L.peak, L.profile, run_date),
            "qa_nulls": lambda: Q.qa_nulls(L.silver, run_date),
            "qa_business_rules": lambda: f32(
                Q.qa_business_rules(L.silver, L.peak, run_date),
                ["current_avg_consumption", "previous_avg_consumption", "row_count_change_ratio",
                 "avg_consumption_change_ratio"],
            ),
        }[name]
        return fn()

    return run


def q_qa_suite(spark, sf):
    L = _layers(spark, sf)
    return Q.qa_suite(L.silver, L.peak, L.profile, RUN_DATE)


def _suite(variant: str, run_date: str):
    def run(spark, sf):
        L = _layers(spark, sf, variant)
        return Q.qa_suite(L.silver, L.peak, L.profile, run_date)

    return run


# ---------------------------------------------------------------- insights and charts


def _gold(spark, sf, variant: str = "clean"):
    L = _layers(spark, sf, variant)
    return L.peak, L.profile


def q_insight_summary(spark, sf, variant: str = "clean"):
    return f32_all(I.summary_of(stored_insights(_layers(spark, sf, variant))))


def q_insight_text(spark, sf):
    return I.findings_text(I.summary_of(stored_insights(_layers(spark, sf, "skewed"))))


def _insight(fn, uses: str, variant: str = "clean"):
    def run(spark, sf):
        peak, profile = _gold(spark, sf, variant)
        if uses == "peak":
            df = fn(peak)
        elif uses == "profile":
            df = fn(profile)
        else:
            df = fn(peak, profile)
        return f32_all(df)

    return run


INSIGHTS = {
    "insight_date_coverage": (I.date_coverage, "both"),
    "insight_top_substations": (I.top_substations, "peak"),
    "insight_system_peak_day": (I.system_peak_day, "peak"),
    "insight_load_shape": (I.load_shape, "profile"),
    "insight_weekday_weekend_profile": (I.weekday_weekend_profile, "profile"),
    "insight_substation_concentration": (I.substation_concentration, "peak"),
    "insight_peak_window": (I.peak_window, "peak"),
    "insight_volatility": (I.day_total_volatility, "peak"),
    "insight_evening_ramp": (I.evening_ramp, "profile"),
    "insight_dno_outlier_screen": (I.dno_outlier_screen, "peak"),
    "insight_dno_share": (I.dno_share, "peak"),
    "insight_peak_hour_distribution": (I.peak_hour_distribution, "peak"),
}

# ---------------------------------------------------------------- registry


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from meterlake.plans import jobs as J

    reg: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "bronze_scan": q_bronze_scan,
        "readings_at_instant": q_readings_at_instant,
        "run_date_slice": q_run_date_slice,
        "date_range_slice": q_date_range_slice,
        "source_date_profile": q_source_date_profile,
        "parquet_profile": q_parquet_profile,
        "silver_profile": q_silver_profile,
        "preview": q_preview,
        "silver_build": q_silver_build,
        "calendar_columns": q_calendar_columns,
        "geometry_xy": q_geometry_xy,
        "composite_id_strict": q_composite_id_strict,
        "slot_to_hhmm": q_slot_to_hhmm,
        "coerce_numeric": q_coerce_numeric,
        "safe_double": q_safe_double,
        "silver_text_time": q_silver_text_time,
        "silver_profile_text_time": q_silver_profile_text_time,
        "day_sequence": q_day_sequence,
        "feeder_baseline": q_feeder_baseline,
        "feeder_baseline_moments": q_feeder_baseline_moments,
        "dq_zscore": q_dq_zscore,
        "dq_zscore_dirty": q_dq_zscore_dirty,
        "dq_zscore_low_clip": q_dq_zscore_low_clip,
        "gold_input": q_gold_input,
        "peak_rank": q_peak_rank,
        "gold_peak": q_gold_peak,
        "gold_peak_dirty": q_gold_peak_dirty,
        "gold_peak_ranked": q_gold_peak_ranked,
        "gold_profile": q_gold_profile,
        "gold_profile_offgrid": q_gold_profile_offgrid,
        "hourly_summary": q_hourly_summary,
        "distinct_counts": q_distinct_counts,
        "feeders_per_site": q_feeders_per_site,
        "transform_counts": q_transform_counts,
        "missing_slots": q_missing_slots,
        "previous_day": q_previous_day,
        "qa_freshness": _qa("qa_freshness"),
        "qa_freshness_empty_day": _qa("qa_freshness", run_date=EMPTY_DATE),
        "qa_completeness": _qa("qa_completeness"),
        "qa_uniqueness": _qa("qa_uniqueness"),
        "qa_uniqueness_offgrid": _qa("qa_uniqueness", "offgrid"),
        "qa_nulls": _qa("qa_nulls"),
        "qa_nulls_empty_day": _qa("qa_nulls", run_date=EMPTY_DATE),
        "qa_business_rules": _qa("qa_business_rules"),
        "qa_business_rules_dirty": _qa("qa_business_rules", "dirty"),
        "qa_business_rules_first_day": _qa("qa_business_rules", run_date=FIRST_DATE),
        "qa_suite": q_qa_suite,
        "qa_suite_dirty": _suite("dirty", RUN_DATE),
        "qa_suite_first_day": _suite("clean", FIRST_DATE),
        "qa_suite_empty_day": _suite("clean", EMPTY_DATE),
        **{name: _insight(fn, uses) for name, (fn, uses) in INSIGHTS.items()},
        "insight_summary": q_insight_summary,
        "insight_summary_skewed": lambda spark, sf: q_insight_summary(spark, sf, "skewed"),
        "insight_text": q_insight_text,
        "chart_dno_share": _insight(I.chart_dno_share, "peak"),
        "chart_load_shape": _insight(I.chart_load_shape, "profile"),
        "chart_peak_hour": _insight(I.chart_peak_hour, "peak"),
        "chart_concentration": _insight(I.chart_concentration, "peak"),
        "chart_weekday_weekend": _insight(I.chart_weekday_weekend, "profile"),
        "chart_dno_outlier": _insight(I.chart_dno_outlier, "peak"),
    }
    for name, (fn, uses) in INSIGHTS.items():
        reg[f"{name}_dirty"] = _insight(fn, uses, "dirty")
    reg.update(J.registered_jobs())
    return reg
