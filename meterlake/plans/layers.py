"""Lazy Bronze -> Silver -> Gold composition (nothing is executed here).

The jobs in :mod:`meterlake.plans.jobs` write these frames; queries and tests
use them directly.
"""

from __future__ import annotations

from functools import cached_property, reduce
from datetime import date

from pyspark.sql import DataFrame

from meterlake.config import DEFAULT_MIN_HISTORY_ROWS, DEFAULT_ZSCORE_THRESHOLD
from meterlake.operators.gold import build_gold_load_profile, build_gold_peak
from meterlake.operators.quality import apply_zscore_quality_flag, feeder_baseline, gold_input, hard_rules
from meterlake.operators.silver import build_silver
from meterlake.plans.insights import grouped_insights, peak_groupings, profile_groupings
from meterlake.session import scratch_path
from meterlake.sources.bronze import date_range_slice, run_date_slice


class Layers:
    """Bronze and the frames derived from it; each is built on first access."""

    def __init__(self, bronze: DataFrame, **kwargs):
        self.bronze = bronze
        self._kwargs = kwargs

    @cached_property
    def silver(self) -> DataFrame:
        return silver_with_quality(self.bronze, **self._kwargs)

    @cached_property
    def gold_in(self) -> DataFrame:
        # DROP depends only on a reading's own columns, so invalid readings are
        # filtered before the baseline join (the baseline itself still uses all Bronze)
        return gold_input(silver_with_quality(self.bronze, valid_only=True, **self._kwargs))

    @cached_property
    def peak(self) -> DataFrame:
        return build_gold_peak(self.gold_in)

    @cached_property
    def profile(self) -> DataFrame:
        return build_gold_load_profile(self.gold_in)


def stored_insights(layers: Layers) -> dict[str, DataFrame]:
    """The twelve insights, each from the groupings of the two Gold tables, which are aggregated once and stored under the shared folder."""
    spark = layers.bronze.sparkSession

    def stored(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return grouped_insights(
        stored(peak_groupings(layers.peak), "peak-groupings"), stored(profile_groupings(layers.profile), "profile-groupings")
    )


def current_rows(bronze: DataFrame, run_date: date | str | None = None, start=None, end=None) -> DataFrame:
    """Rows a run processes: one day, a day range, or all (readings without a time too: the quality rules drop them)."""
    if run_date is not None:
        return run_date_slice(bronze, run_date)
    if start is not None or end is not None:
        return date_range_slice(bronze, start, end)
    return bronze


def silver_with_quality(
    bronze: DataFrame,
    *,
    run_date: date | str | None = None,
    start=None,
    end=None,
    threshold: float = DEFAULT_ZSCORE_THRESHOLD,
    min_history_rows: int = DEFAULT_MIN_HISTORY_ROWS,
    baseline: DataFrame | None = None,
    valid_only: bool = False,
) -> DataFrame:
    """Silver rows of the run with quality columns.

    The baseline population is all of Bronze (every date, invalid rows too),
    so it does not depend on the run date and a range run equals the union of
    its daily runs.
    """
    stats = baseline if baseline is not None else feeder_baseline(bronze)
    current = build_silver(current_rows(bronze, run_date, start, end))
    if valid_only:
        current = current.filter(~reduce(lambda a, b: a | b, hard_rules().values()))
    return apply_zscore_quality_flag(current, stats, threshold=threshold, min_history_rows=min_history_rows)


def build_layers(bronze: DataFrame, **kwargs) -> Layers:
    """Lazy Silver/Gold frames over ``bronze`` (keyword arguments as :func:`silver_with_quality`)."""
    return Layers(bronze, **kwargs)
