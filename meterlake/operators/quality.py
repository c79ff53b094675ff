"""Z-score quality policy: drop hard-invalid readings, clip outliers, keep the rest.

Plan shape: the feeder baseline is a ``groupBy`` with map-side partial
aggregation (a hot feeder collapses to one partial row per map task before the
shuffle). The left join to it is left to AQE: when the measured baseline stage
is below the broadcast threshold the join becomes a broadcast hash join,
otherwise a sort-merge join whose skewed reading partitions AQE splits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.config import DEFAULT_MIN_HISTORY_ROWS, DEFAULT_ZSCORE_THRESHOLD
from meterlake.functions.columns import as_double, composite_id, per_device
from meterlake.operators.silver import CONSUMPTION, DEVICES, FEEDER, SUBSTATION, TS

BASELINE_COLUMNS = ["zscore_mean", "zscore_stddev", "zscore_history_count"]
QUALITY_COLUMNS = [
    "zscore_mean",
    "zscore_stddev",
    "zscore_history_count",
    "consumption_zscore",
    "dq_action",
    "data_quality_flag",
    "dq_reason",
    "adjusted_total_consumption_active_import",
]


_WHOLE = ("byte", "short", "integer", "long")


def _feeder(history: DataFrame) -> Column:
    known = "composite_feeder_id" in history.columns
    return (F.col("composite_feeder_id") if known else composite_id(SUBSTATION, FEEDER)).alias("composite_feeder_id")


def _moments(history: DataFrame) -> list[Column]:
    """Row count, value count, sum and sum of squares of a whole-number consumption, in decimals: exact in any order."""
    value = F.col(CONSUMPTION).cast("decimal(19,0)")
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count(value).alias("n"),
        F.sum(value).cast("decimal(38,0)").alias("total"),
        F.sum((value * value).cast("decimal(38,0)")).alias("squares"),
    ]


def _statistics(summed: DataFrame) -> DataFrame:
    """Mean and population stddev from exact moments: n * squares - total^2 is a whole number, rounded once.

    Where that product has more than 38 digits the variance is squares / n - mean^2 in doubles, still the same on each run.
    """
    n, mean = F.col("n").cast("double"), F.col("total").cast("double") / F.col("n").cast("double")
    spread = F.try_multiply(F.col("n").cast("decimal(19,0)"), F.col("squares")) - F.try_multiply("total", "total")
    large = F.greatest(F.col("squares").cast("double") / n - mean * mean, F.lit(0.0))
    return summed.select(
        "composite_feeder_id",
        F.when(F.col("n") > 0, mean).alias("zscore_mean"),
        F.when(F.col("n") > 0, F.sqrt(F.coalesce(spread.cast("double") / (n * n), large))).alias("zscore_stddev"),
        F.col("rows").alias("zscore_history_count"),
    )


def feeder_baseline(history: DataFrame) -> DataFrame:
    """Per composite feeder: mean, population stddev and row count of consumption.

    ``history`` may be Bronze or Silver rows. The count includes rows whose
    consumption is NULL; mean and stddev ignore them. Only three source
    columns are read. Whole numbers (as Bronze has them) are summed exactly, so
    every run gives the same baseline; sums that 38 digits cannot hold are an error.
    """
    if history.schema[CONSUMPTION].dataType.typeName() in _WHOLE:
        return _statistics(history.groupBy(_feeder(history)).agg(*_moments(history)))
    consumption = as_double(history, CONSUMPTION)
    return history.groupBy(_feeder(history)).agg(
        F.avg(consumption).alias("zscore_mean"),
        F.stddev_pop(consumption).alias("zscore_stddev"),
        F.count(F.lit(1)).alias("zscore_history_count"),
    )


def feeder_moments(history: DataFrame, *by: Column) -> DataFrame:
    """Per composite feeder, and by the given columns: row count, value count, sum and sum of squares.

    An exact summary of Bronze that merges by addition in any order
    (:func:`baseline_from_moments`). Consumption must be a whole number.
    """
    kind = history.schema[CONSUMPTION].dataType.typeName()
    if kind not in _WHOLE:
        raise ValueError(f"moments are exact sums of whole numbers; {CONSUMPTION} is {kind}")
    return history.groupBy(*by, _feeder(history)).agg(*_moments(history))


def baseline_from_moments(moments: DataFrame) -> DataFrame:
    """The feeder baseline of the rows that the moments summarise; equals :func:`feeder_baseline` of those rows to the last bit."""
    summed = moments.groupBy("composite_feeder_id").agg(*[F.sum(c).alias(c) for c in ("rows", "n", "total", "squares")])
    return _statistics(summed)


def hard_rules() -> dict[str, Column]:
    """Named validity rules; a reading that breaks any of them is dropped from Gold."""
    substation = F.col(SUBSTATION)
    value = F.col(CONSUMPTION)
    devices = F.col(DEVICES)
    return {
        "substation_missing_or_blank": substation.isNull() | (F.trim(substation) == F.lit("")),
        "time_missing": F.col(TS).isNull(),
        "consumption_missing_or_negative": value.isNull() | (value < F.lit(0.0)),
        "devices_missing_or_not_positive": devices.isNull() | (devices <= F.lit(0)),
    }


def apply_zscore_quality_flag(
    current: DataFrame,
    baseline: DataFrame,
    *,
    threshold: float = DEFAULT_ZSCORE_THRESHOLD,
    min_history_rows: int = DEFAULT_MIN_HISTORY_ROWS,
) -> DataFrame:
    """Attach the feeder baseline and the quality decision to Silver rows.

    ``baseline`` is either history rows (aggregated here) or the output of
    :func:`feeder_baseline` / :func:`baseline_from_moments`. Decision, first match wins:

    * DROP / INVALID_RULE / FAIL when a rule of :func:`hard_rules` is broken;
    * CLIP / ZSCORE_CLIPPED when the feeder has ``min_history_rows`` rows, a
      positive stddev and ``|x - mean| / stddev > threshold``; the value becomes
      ``mean + threshold * stddev`` (one cap, used for low outliers too);
    * KEEP otherwise.
    """
    stats = baseline if set(BASELINE_COLUMNS) <= set(baseline.columns) else feeder_baseline(baseline)
    with_stats = current.join(stats.select("composite_feeder_id", *BASELINE_COLUMNS), "composite_feeder_id", "left")

    t = F.lit(float(threshold))
    mu, sigma, rows = F.col("zscore_mean"), F.col("zscore_stddev"), F.col("zscore_history_count")
    comparable = (rows >= F.lit(min_history_rows)) & sigma.isNotNull() & (sigma > F.lit(0.0))
    z = F.when(comparable, F.abs((F.col(CONSUMPTION) - mu) / sigma))
    broken = reduce(lambda a, b: a | b, hard_rules().values())
    verdict = F.when(broken, F.lit("DROP")).when(comparable & (z > t), F.lit("CLIP")).otherwise(F.lit("KEEP"))
    reasons = {"DROP": "INVALID_RULE", "CLIP": "ZSCORE_CLIPPED"}

    keep = [c for c in current.columns if c != "collection_date"]
    tail = ["collection_date"] if "collection_date" in current.columns else []
    decided = with_stats.select(*keep, *BASELINE_COLUMNS, z.alias("consumption_zscore"), verdict.alias("dq_action"), *tail)
    action = F.col("dq_action")
    return decided.select(
        *keep,
        *BASELINE_COLUMNS,
        "consumption_zscore",
        "dq_action",
        F.when(action == "DROP", F.lit("FAIL")).otherwise(F.lit("PASS")).alias("data_quality_flag"),
        F.when(action == "DROP", F.lit(reasons["DROP"])).when(action == "CLIP", F.lit(reasons["CLIP"])).alias("dq_reason"),
        F.when(action == "CLIP", mu + sigma * t).otherwise(F.col(CONSUMPTION))
        .alias("adjusted_total_consumption_active_import"),
        *tail,
    )


def gold_input(silver: DataFrame) -> DataFrame:
    """Rows that feed Gold: DROP rows removed, consumption replaced by the adjusted value."""
    adjusted = F.col("adjusted_total_consumption_active_import")
    return silver.filter(F.col("dq_action") != F.lit("DROP")).withColumns(
        {
            CONSUMPTION: adjusted,
            "consumption_per_active_device": per_device(adjusted, DEVICES),
        }
    )
