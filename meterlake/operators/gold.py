"""Gold daily aggregates: peak demand per substation and the half-hour load profile.

The peak table is one ``groupBy``: the peak reading is picked with ``max_by``
over an ordering struct, so no window, no second scan and no self-join are
needed (the partial aggregate also combines a hot substation map-side).
:func:`build_gold_peak_ranked` keeps the window + join formulation for
comparison and benchmarking.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.operators.silver import CONSUMPTION, DEVICES, SUBSTATION, TS
from meterlake.schemas import GOLD_PROFILE_COLUMNS

PEAK_KEYS = ["collection_date", "dno_alias", SUBSTATION]
PROFILE_KEYS = ["collection_date", "hour_of_day", "minute_of_hour", "half_hour_slot"]


def _peak_order():
    """Largest consumption (NULL last); on ties a NULL time first, then the earliest time."""
    ts = F.col(TS)
    return F.struct(F.col(CONSUMPTION), ts.isNull(), -F.unix_micros(ts))


def _daily_stats():
    return [
        F.sum(CONSUMPTION).alias("daily_total_consumption"),
        F.avg(CONSUMPTION).alias("avg_half_hour_consumption"),
        F.avg(DEVICES).alias("avg_active_devices"),
        F.count_distinct("composite_feeder_id").alias("feeder_count"),
        F.count(F.lit(1)).alias("reading_count"),
    ]


def build_gold_peak(df: DataFrame) -> DataFrame:
    """Daily peak and summary statistics per (date, DNO, substation).

    A group with a NULL key keeps its statistics but gets NULL peak columns
    (the peak is matched on plain key equality, which NULL never satisfies).
    """
    peak = F.max_by(F.struct(F.col(CONSUMPTION).alias("v"), F.col(TS).alias("t")), _peak_order())
    agg = df.groupBy(*PEAK_KEYS).agg(peak.alias("peak"), *_daily_stats())
    keys_present = ~reduce(lambda a, b: a | b, [F.col(k).isNull() for k in PEAK_KEYS])
    return agg.select(
        F.col("collection_date").alias("consumption_date"),
        "dno_alias",
        SUBSTATION,
        F.when(keys_present, F.col("peak.v")).alias("peak_consumption"),
        F.when(keys_present, F.col("peak.t")).alias("peak_timestamp"),
        "daily_total_consumption",
        "avg_half_hour_consumption",
        "avg_active_devices",
        "feeder_count",
        "reading_count",
    )


def _rank_order():
    return [F.col(CONSUMPTION).desc_nulls_last(), F.col(TS).asc_nulls_first()]


#: Groups of more rows than this are cut into pieces that are ranked apart.
HOT_ROWS = 1_000_000
#: Pieces of a hot group by value, and of its exact ties.
PIECES, TIE_PIECES = 64, 16
_SLOT = 30 * 60 * 1_000_000


def peak_rank(df: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``peak_rank``: row number within (date, DNO, substation), consumption desc, time asc.

    A window by the keys alone would sort a hot substation-day in one task. So a
    group of more than ``hot_rows`` readings is cut along its order, and a rank is the
    number of rows in earlier pieces plus the row number within the own piece:

    1. a count finds the hot groups, and for them alone an equi-depth histogram of the consumption (``percentile_approx``,
       merged map-side) gives the cuts; a value that is a cut itself is a piece of its own;
    2. such a piece, and the one of NULLs, holds a single value, so it is cut further by
       half-hour, and readings at one instant, whose ranks are interchangeable, by a hash;
    3. a count by piece, summed along the pieces of a group, gives the offsets; both
       small tables are joined to the readings.

    Cuts are a balance, not a bound on correctness: pieces follow the order whatever they
    are. Nothing runs before the result is asked for, only columns that are asked for
    travel, and groups that are not hot see one window.
    """
    value, time = F.col(CONSUMPTION), F.col(TS)
    code = F.when(F.isnan(value), F.lit(float("-inf"))).otherwise(-value.cast("double"))
    large = df.groupBy(*PEAK_KEYS).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    within = df.join(_renamed(large.drop("_n"), "_hot"), _same_keys("_hot"), "left_semi")
    cuts = F.percentile_approx(code, [i / PIECES for i in range(1, PIECES)], 1000).alias("_cuts")
    hot = _renamed(within.groupBy(*PEAK_KEYS).agg(cuts), "_hot").withColumn("_is_hot", F.lit(True))
    scalars = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("struct", "array", "map")]

    cut = F.array_contains("_cuts", code) & ~code.isin(float("-inf"), float("inf"))
    single = F.coalesce(value.isNull() | cut, F.lit(False))
    micros = F.unix_micros(time)
    start = micros - F.pmod(micros, F.lit(_SLOT))
    apart = F.coalesce(F.col("_is_hot"), F.lit(False))
    pieces = {
        "_piece": F.when(value.isNull(), 2 * PIECES).otherwise(2 * F.size(F.filter("_cuts", lambda c: c < code)) + single.cast("int")),
        "_slot": F.when(single, F.coalesce(start, F.lit(-(2**62)))),
        "_late": F.when(single, F.coalesce(micros > start, F.lit(False)).cast("int")),
        "_tie": F.when(single & F.coalesce(micros == start, F.lit(True)), F.pmod(F.xxhash64(*scalars), F.lit(TIE_PIECES)).cast("int")),
    }
    placed = df.join(hot, _same_keys("_hot"), "left")
    placed = placed.withColumns({c: F.when(apart, F.coalesce(e.cast("bigint"), F.lit(0))).otherwise(0) for c, e in pieces.items()})

    names = list(pieces)
    counts = placed.where("_is_hot").groupBy(*PEAK_KEYS, *names).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*PEAK_KEYS).orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)  # a row a piece
    offsets = _renamed(counts.withColumn("_offset", F.sum("_n").over(before)).drop("_n"), "_at")
    offsets = offsets.withColumnsRenamed({c: f"_at{c}" for c in names})
    ranked = placed.join(offsets, [*_same_keys("_at"), *[F.col(c) == F.col(f"_at{c}") for c in names]], "left")
    own = F.row_number().over(Window.partitionBy(*PEAK_KEYS, *names).orderBy(*_rank_order()))
    return ranked.select(*df.columns, (own + F.coalesce("_offset", F.lit(0))).cast("int").alias("peak_rank"))


def _renamed(df: DataFrame, prefix: str) -> DataFrame:
    return df.withColumnsRenamed({k: f"{prefix}_{k}" for k in PEAK_KEYS})


def _same_keys(prefix: str) -> list:
    return [F.col(k).eqNullSafe(F.col(f"{prefix}_{k}")) for k in PEAK_KEYS]


def peak_rows(df: DataFrame) -> DataFrame:
    """Rank-1 rows per group. The window limit runs before the shuffle
    (WindowGroupLimit), so a hot group sends one row per map task."""
    w = Window.partitionBy(*PEAK_KEYS).orderBy(*_rank_order())
    return df.withColumn("peak_rank", F.row_number().over(w)).filter(F.col("peak_rank") == 1)


def build_gold_peak_ranked(df: DataFrame) -> DataFrame:
    """Same table via rank-1 rows joined back to the statistics (two shuffles more)."""
    top = peak_rows(df).select(
        *PEAK_KEYS, F.col(CONSUMPTION).alias("peak_consumption"), F.col(TS).alias("peak_timestamp")
    )
    stats = df.groupBy(*PEAK_KEYS).agg(*_daily_stats())
    cond = [stats[k] == top[k] for k in PEAK_KEYS]
    joined = stats.join(top, on=cond, how="left")
    return joined.select(
        stats["collection_date"].alias("consumption_date"),
        stats["dno_alias"],
        stats[SUBSTATION],
        "peak_consumption",
        "peak_timestamp",
        "daily_total_consumption",
        "avg_half_hour_consumption",
        "avg_active_devices",
        "feeder_count",
        "reading_count",
    )


def build_gold_load_profile(df: DataFrame) -> DataFrame:
    """Average demand shape per (date, hour, minute, slot)."""
    agg = df.groupBy(*PROFILE_KEYS).agg(
        F.avg(CONSUMPTION).alias("avg_consumption"),
        F.sum(CONSUMPTION).alias("total_consumption"),
        F.count(F.lit(1)).alias("reading_count"),
        F.count_distinct(SUBSTATION).alias("substation_count"),
        F.count_distinct("composite_feeder_id").alias("feeder_count"),
        F.avg("consumption_per_active_device").alias("avg_consumption_per_active_device"),
    )
    return agg.withColumnRenamed("collection_date", "consumption_date").select(*GOLD_PROFILE_COLUMNS)

