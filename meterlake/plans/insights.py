"""Portfolio insights over the two Gold tables, chart datasets and a summary.

Plan notes:

* Top-k queries use ``orderBy(...).limit(k)`` (TakeOrderedAndProject: each
  task keeps k rows, no full sort). Ties are broken on the key columns so the
  result is deterministic.
* Grand totals are scalar subqueries (``DataFrame.scalar()``): one small
  aggregate job, then a literal in the projection. There is no
  unpartitioned window over all rows and no cross join.
* Windows only run on the <= k rows left after a limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions.columns import day_type, safe_double, slot_to_hhmm

SUB = "secondary_substation_unique_id"
DATE = "consumption_date"


def _share(part: Column, total: Column) -> Column:
    """part / total; NULL instead of an error when the total is 0 or NULL."""
    return F.try_divide(part.cast("double"), F.nullif(total.cast("double"), F.lit(0.0)))


# ---------------------------------------------------------------- I01 - I12


def date_coverage(peak: DataFrame, profile: DataFrame) -> DataFrame:
    def one(df: DataFrame, name: str) -> DataFrame:
        return df.agg(
            F.min(DATE).alias("min_date"),
            F.max(DATE).alias("max_date"),
            F.count_distinct(DATE).alias("populated_days"),
            F.count(F.lit(1)).alias("row_count"),
        ).select(F.lit(name).alias("table_name"), "min_date", "max_date", "populated_days", "row_count")

    return one(peak, "gold_peak_demand_substation_day").unionByName(one(profile, "gold_avg_load_profile_day"))


def top_substations(peak: DataFrame, n: int = 15) -> DataFrame:
    return (
        peak.groupBy("dno_alias", SUB)
        .agg(
            F.count(F.lit(1)).alias("active_days"),
            F.avg("daily_total_consumption").alias("avg_daily_total_consumption"),
            F.max("peak_consumption").alias("max_observed_peak"),
            F.avg("peak_consumption").alias("avg_peak_consumption"),
        )
        .orderBy(F.desc_nulls_last("avg_daily_total_consumption"), F.asc_nulls_first("dno_alias"), F.asc_nulls_first(SUB))
        .limit(n)
    )


def system_peak_day(peak: DataFrame, n: int = 20) -> DataFrame:
    """Highest daily totals per (date, DNO)."""
    return (
        peak.groupBy(DATE, "dno_alias")
        .agg(
            F.sum("daily_total_consumption").alias("system_daily_total"),
            F.max("peak_consumption").alias("max_substation_peak"),
            F.count_distinct(SUB).alias("active_substations"),
        )
        .orderBy(F.desc_nulls_last("system_daily_total"), F.asc_nulls_first(DATE), F.asc_nulls_first("dno_alias"))
        .limit(n)
    )


def load_shape(profile: DataFrame) -> DataFrame:
    """Unweighted mean of the daily slot averages, busiest slot first."""
    return (
        profile.groupBy("hour_of_day", "minute_of_hour", "half_hour_slot")
        .agg(
            F.avg("avg_consumption").alias("mean_slot_consumption"),
            F.avg("total_consumption").alias("mean_slot_total_consumption"),
            F.sum("reading_count").alias("total_readings"),
        )
        .orderBy(F.desc_nulls_last("mean_slot_consumption"), F.asc_nulls_first("half_hour_slot"),
                 F.asc_nulls_first("minute_of_hour"))
    )


def weekday_weekend_profile(profile: DataFrame) -> DataFrame:
    return (
        profile.select(day_type(DATE).alias("day_type"), "half_hour_slot", "avg_consumption")
        .groupBy("day_type", "half_hour_slot")
        .agg(F.avg("avg_consumption").alias("mean_avg_consumption"), F.count(F.lit(1)).alias("contributing_day_slots"))
        .orderBy("day_type", "half_hour_slot")
    )


def _substation_totals(peak: DataFrame) -> DataFrame:
    return peak.groupBy(SUB).agg(F.sum("daily_total_consumption").alias("total_consumption"))


def _fleet_total(peak: DataFrame) -> Column:
    return peak.agg(F.sum("daily_total_consumption")).scalar()


def _top_ranked(peak: DataFrame, n: int) -> DataFrame:
    order = [F.desc_nulls_last("total_consumption"), F.asc_nulls_first(SUB)]
    top = _substation_totals(peak).orderBy(*order).limit(n)
    return top.withColumn("rn", F.row_number().over(Window.orderBy(*order)))


def substation_concentration(peak: DataFrame, n: int = 20) -> DataFrame:
    """Top-n substations by total (DNO ignored), with the fleet total and each share."""
    fleet = _fleet_total(peak)
    return _top_ranked(peak, n).select(
        "rn",
        SUB,
        "total_consumption",
        fleet.alias("fleet_total_consumption"),
        _share(F.col("total_consumption"), fleet).alias("share_of_total"),
    ).orderBy("rn")


def peak_window(peak: DataFrame) -> DataFrame:
    """Evening (17:00-20:59) and overnight (00:00-05:59) shares of daily peak events."""
    h = F.hour("peak_timestamp")
    evening = F.sum(F.when(h.between(17, 20), F.lit(1)).otherwise(F.lit(0))).cast("bigint")
    overnight = F.sum(F.when(h.between(0, 5), F.lit(1)).otherwise(F.lit(0))).cast("bigint")
    total = F.sum(F.lit(1)).cast("bigint")
    return peak.agg(
        evening.alias("evening_peak_events"),
        overnight.alias("overnight_peak_events"),
        total.alias("total_events"),
    ).select(
        "evening_peak_events",
        _share(F.col("evening_peak_events"), F.col("total_events")).alias("evening_peak_share"),
        "overnight_peak_events",
        _share(F.col("overnight_peak_events"), F.col("total_events")).alias("overnight_peak_share"),
        "total_events",
    )


def day_total_volatility(peak: DataFrame) -> DataFrame:
    days = peak.groupBy(DATE).agg(F.sum("daily_total_consumption").alias("day_total"))
    return days.agg(
        F.count(F.lit(1)).alias("days"),
        F.avg("day_total").alias("mean_day_total"),
        F.stddev_pop("day_total").alias("stddev_day_total"),
    ).withColumn("cv_day_total", _share(F.col("stddev_day_total"), F.col("mean_day_total")))


def evening_ramp(profile: DataFrame) -> DataFrame:
    """Evening (slots 34-41) vs night (slots 4-11) mean demand per day type."""
    slot = F.col("half_hour_slot")
    return (
        profile.select(day_type(DATE).alias("day_type"), "half_hour_slot", "avg_consumption")
        .groupBy("day_type")
        .agg(
            F.avg(F.when(slot.between(34, 41), F.col("avg_consumption"))).alias("evening_avg"),
            F.avg(F.when(slot.between(4, 11), F.col("avg_consumption"))).alias("night_avg"),
        )
        .withColumn("evening_to_night_ratio", _share(F.col("evening_avg"), F.col("night_avg")))
    )


def dno_outlier_screen(peak: DataFrame) -> DataFrame:
    """Per DNO: mean vs approximate median of substation mean daily totals."""
    per_sub = peak.groupBy("dno_alias", SUB).agg(F.avg("daily_total_consumption").alias("mean_daily_total"))
    return (
        per_sub.groupBy("dno_alias")
        .agg(
            F.avg("mean_daily_total").alias("dno_mean"),
            F.percentile_approx("mean_daily_total", 0.5).alias("dno_median"),
        )
        .withColumn("mean_to_median_ratio", _share(F.col("dno_mean"), F.col("dno_median")))
        .orderBy(F.desc_nulls_last("mean_to_median_ratio"), F.asc_nulls_first("dno_alias"))
    )


def dno_share(peak: DataFrame) -> DataFrame:
    fleet = _fleet_total(peak)
    return (
        peak.groupBy("dno_alias")
        .agg(F.sum("daily_total_consumption").alias("total_consumption"))
        .withColumn("share_of_total", _share(F.col("total_consumption"), fleet))
        .orderBy(F.desc_nulls_last("total_consumption"), F.asc_nulls_first("dno_alias"))
    )


def peak_hour_distribution(peak: DataFrame) -> DataFrame:
    """Daily peaks per hour of day; a NULL peak time is its own group."""
    return (
        peak.groupBy(F.hour("peak_timestamp").alias("peak_hour"))
        .agg(F.count(F.lit(1)).alias("substation_days"))
        .orderBy(F.asc_nulls_first("peak_hour"))
    )


# ---------------------------------------------------------------- chart datasets


def chart_dno_share(peak: DataFrame) -> DataFrame:
    return (
        dno_share(peak)
        .withColumn("share_pct", F.col("share_of_total") * F.lit(100.0))
        .orderBy(F.desc_nulls_last("share_of_total"), F.asc_nulls_first("dno_alias"))
    )


def chart_load_shape(profile: DataFrame) -> DataFrame:
    return (
        profile.groupBy("half_hour_slot")
        .agg(F.avg("avg_consumption").alias("mean_slot_consumption"))
        .orderBy("half_hour_slot")
    )


def chart_peak_hour(peak: DataFrame) -> DataFrame:
    return peak_hour_distribution(peak)


def chart_concentration(peak: DataFrame, n: int = 10) -> DataFrame:
    """Rank, total and share of the top-n substations plus the running share in percent."""
    fleet = _fleet_total(peak)
    ranked = _top_ranked(peak, n).select(
        "rn", "total_consumption", _share(F.col("total_consumption"), fleet).alias("share_of_total")
    )
    running = Window.orderBy("rn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ranked.select(
        "rn",
        "total_consumption",
        "share_of_total",
        (F.col("share_of_total") * F.lit(100.0)).alias("share_pct"),
        (F.sum("share_of_total").over(running) * F.lit(100.0)).alias("cum_share_pct"),
    ).orderBy("rn")


def chart_weekday_weekend(profile: DataFrame) -> DataFrame:
    return evening_ramp(profile).orderBy("day_type")


def chart_dno_outlier(peak: DataFrame) -> DataFrame:
    return dno_outlier_screen(peak)


# ---------------------------------------------------------------- summary

SUMMARY_COLUMNS = ["finding_order", "finding", "subject", "value_1", "value_2", "value_3"]


def _finding(df: DataFrame, order: int, name: str, subject: Column, v1, v2=None, v3=None) -> DataFrame:
    def val(v):
        return (v if isinstance(v, Column) else F.lit(v)).cast("double")

    return df.select(
        F.lit(order).alias("finding_order"),
        F.lit(name).alias("finding"),
        subject.cast("string").alias("subject"),
        val(v1).alias("value_1"),
        val(v2).alias("value_2"),
        val(v3).alias("value_3"),
    )


_zero_if_null = safe_double


def insight_summary(peak: DataFrame, profile: DataFrame) -> DataFrame:
    """The nine portfolio findings as rows (numbers only; see :func:`findings_text`)."""
    return summary_of(all_insights(peak, profile))


def summary_of(found: dict[str, DataFrame]) -> DataFrame:
    """The findings from the insights (:func:`all_insights` or :func:`grouped_insights`).

    A finding whose inputs are empty is left out; the skew alert appears only
    when the top mean/median ratio is above 10.
    """
    parts: list[DataFrame] = []

    top = found["insight_top_substations"].limit(1)
    parts.append(
        _finding(top, 1, "top_substation",
                 F.concat_ws(" ", F.col(SUB), F.concat(F.lit("("), F.col("dno_alias"), F.lit(")"))),
                 _zero_if_null("avg_daily_total_consumption"), _zero_if_null("max_observed_peak"))
    )

    day = found["insight_system_peak_day"].limit(1)
    parts.append(
        _finding(day, 2, "highest_demand_day",
                 F.concat_ws(" ", F.col(DATE).cast("string"), F.concat(F.lit("("), F.col("dno_alias"), F.lit(")"))),
                 _zero_if_null("system_daily_total"), F.col("active_substations"))
    )

    shape = found["insight_load_shape"].agg(
        F.max_by("half_hour_slot", F.struct(F.col("mean_slot_consumption"), -F.col("half_hour_slot"))).alias("hi"),
        F.min_by("half_hour_slot", F.struct(F.col("mean_slot_consumption"), -F.col("half_hour_slot"))).alias("lo"),
        F.max("mean_slot_consumption").alias("hi_v"),
        F.min("mean_slot_consumption").alias("lo_v"),
        F.count(F.lit(1)).alias("n"),
    ).filter(F.col("n") > 0)
    parts.append(
        _finding(shape, 3, "load_shape_peak_trough",
                 F.concat_ws("/", slot_to_hhmm("hi"), slot_to_hhmm("lo")),
                 _zero_if_null("hi_v"), _zero_if_null("lo_v"))
    )

    ww = found["insight_weekday_weekend_profile"]
    means = ww.agg(
        F.avg(F.when(F.col("day_type") == "weekday", _zero_if_null("mean_avg_consumption"))).alias("wd"),
        F.avg(F.when(F.col("day_type") == "weekend", _zero_if_null("mean_avg_consumption"))).alias("we"),
    ).filter(F.col("wd").isNotNull() & F.col("we").isNotNull())
    delta = F.when(F.col("wd") != 0, (F.col("we") - F.col("wd")) / F.col("wd") * F.lit(100.0)).otherwise(F.lit(0.0))
    parts.append(_finding(means, 4, "weekday_weekend_delta", F.lit("weekend vs weekday"), F.col("wd"), F.col("we"), delta))

    conc = found["insight_substation_concentration"].where("rn <= 10").agg(
        (F.sum(F.when(F.col("rn") <= 5, _zero_if_null("share_of_total"))) * F.lit(100.0)).alias("top5"),
        (F.sum(_zero_if_null("share_of_total")) * F.lit(100.0)).alias("top10"),
        F.count(F.lit(1)).alias("n"),
    ).filter(F.col("n") > 0)
    parts.append(_finding(conc, 5, "demand_concentration", F.lit("top 5 / top 10 substations"),
                          F.col("top5"), F.col("top10")))

    win = found["insight_peak_window"]  # a global aggregate: always one row
    parts.append(_finding(win, 6, "peak_timing", F.lit("evening 17-20 / overnight 0-5"),
                          _zero_if_null("evening_peak_share") * F.lit(100.0),
                          _zero_if_null("overnight_peak_share") * F.lit(100.0)))

    vol = found["insight_volatility"]  # a global aggregate: always one row
    parts.append(_finding(vol, 7, "volatility", F.lit("daily system total"),
                          _zero_if_null("cv_day_total"), _zero_if_null("stddev_day_total"),
                          _zero_if_null("mean_day_total")))

    ramp = found["insight_evening_ramp"].agg(
        F.max(F.when(F.col("day_type") == "weekday", _zero_if_null("evening_to_night_ratio"))).alias("wd"),
        F.max(F.when(F.col("day_type") == "weekend", _zero_if_null("evening_to_night_ratio"))).alias("we"),
        F.count_if(F.col("day_type") == "weekday").alias("n_wd"),
        F.count_if(F.col("day_type") == "weekend").alias("n_we"),
    ).filter((F.col("n_wd") > 0) & (F.col("n_we") > 0))
    parts.append(_finding(ramp, 8, "evening_ramp", F.lit("weekday / weekend"), F.col("wd"), F.col("we")))

    skew = found["insight_dno_outlier_screen"].limit(1).filter(_zero_if_null("mean_to_median_ratio") > 10)
    parts.append(_finding(skew, 9, "skew_alert", F.col("dno_alias"), _zero_if_null("mean_to_median_ratio")))

    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("finding_order")


def findings_text(summary: DataFrame) -> DataFrame:
    """``finding_order``, ``finding`` and a line of text for each row of :func:`insight_summary`."""
    who = F.col("subject")
    values = {k: F.coalesce(F.col(f"value_{i}"), F.lit(0.0)) for i, k in enumerate("abc", start=1)}
    grouped = {k: F.format_number(v, 2) for k, v in values.items()}
    two = {k: F.format_string("%.2f", v) for k, v in values.items()}
    three = {k: F.format_string("%.3f", v) for k, v in values.items()}
    lines = {
        "top_substation": [who, " uses most per day: ", grouped["a"], " on average, ", grouped["b"], " at its highest half-hour"],
        "highest_demand_day": [who, " was the busiest day: ", grouped["a"], " from ", F.format_number(values["b"], 0), " sites"],
        "load_shape_peak_trough": ["the day is highest/lowest at ", who, ": ", grouped["a"], " against ", grouped["b"], " per slot"],
        "weekday_weekend_delta": [
            "a slot averages ", grouped["a"], " from Monday to Friday and ", grouped["b"], " otherwise, ",
            F.format_string("%+.2f", values["c"]), "%",
        ],
        "demand_concentration": [two["a"], "% of all demand comes from five sites, ", two["b"], "% from ten"],
        "peak_timing": [two["a"], "% of peaks fall in the evening (17 to 20 h) and ", two["b"], "% in the night (0 to 5 h)"],
        "volatility": ["daily totals spread by ", three["a"], " of their mean (", grouped["b"], " around ", grouped["c"], ")"],
        "evening_ramp": ["evening demand over night demand is ", three["a"], " on weekdays and ", three["b"], " at weekends"],
        "skew_alert": ["ALERT ", who, ": its mean is ", grouped["a"], " times its median"],
    }
    line = None
    for name, parts in lines.items():
        text = F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
        line = F.when(F.col("finding") == name, text) if line is None else line.when(F.col("finding") == name, text)
    return summary.select("finding_order", "finding", line.alias("line"))


def all_insights(peak: DataFrame, profile: DataFrame) -> dict[str, DataFrame]:
    return {
        "insight_date_coverage": date_coverage(peak, profile),
        "insight_top_substations": top_substations(peak),
        "insight_system_peak_day": system_peak_day(peak),
        "insight_load_shape": load_shape(profile),
        "insight_weekday_weekend_profile": weekday_weekend_profile(profile),
        "insight_substation_concentration": substation_concentration(peak),
        "insight_peak_window": peak_window(peak),
        "insight_volatility": day_total_volatility(peak),
        "insight_evening_ramp": evening_ramp(profile),
        "insight_dno_outlier_screen": dno_outlier_screen(peak),
        "insight_dno_share": dno_share(peak),
        "insight_peak_hour_distribution": peak_hour_distribution(peak),
    }


# ---------------------------------------------------------------- all insights from one aggregation a table

_PEAK_KEYS = [DATE, "dno_alias", SUB, "peak_hour"]
PEAK_SETS = {"site": ["dno_alias", SUB], "dno_day": [DATE, "dno_alias"], "substation": [SUB], "day": [DATE],
             "dno": ["dno_alias"], "hour": ["peak_hour"], "all": []}
_PROFILE_KEYS = [DATE, "hour_of_day", "minute_of_hour", "half_hour_slot", "day_type"]
PROFILE_SETS = {"slot": ["hour_of_day", "minute_of_hour", "half_hour_slot"], "type_slot": ["day_type", "half_hour_slot"],
                "type": ["day_type"], "day": [DATE]}


def _grouped(df: DataFrame, keys: list[str], sets: dict[str, list[str]], *aggregates: Column) -> DataFrame:
    """One aggregation over all grouping sets; ``of`` names the set of a row."""
    rows = df.groupingSets([[F.col(k) for k in s] for s in sets.values()], *keys).agg(F.grouping_id().alias("id"), *aggregates)
    ids = {sum(1 << i for i, k in enumerate(reversed(keys)) if k not in s): n for n, s in sets.items()}
    name = F.create_map(*[F.lit(x) for pair in ids.items() for x in pair])
    return rows.withColumn("of", F.get(F.map_values(F.map_filter(name, lambda k, _: k == F.col("id"))), F.lit(0))).drop("id")


def peak_groupings(peak: DataFrame) -> DataFrame:
    """What the insights need of the peak table, for all its groupings: one scan, one Expand."""
    hour = F.hour("peak_timestamp")

    def events(first: int, last: int) -> Column:
        return F.sum(F.when(hour.between(first, last), F.lit(1)).otherwise(F.lit(0))).cast("bigint")

    return _grouped(
        peak.withColumn("peak_hour", hour), _PEAK_KEYS, PEAK_SETS,
        F.count(F.lit(1)).alias("n"),
        F.sum("daily_total_consumption").alias("total"),
        F.avg("daily_total_consumption").alias("mean_total"),
        F.max("peak_consumption").alias("max_peak"),
        F.avg("peak_consumption").alias("mean_peak"),
        F.count_distinct(SUB).alias("sites"),
        events(17, 20).alias("evening"),
        events(0, 5).alias("overnight"),
    )


def profile_groupings(profile: DataFrame) -> DataFrame:
    """Likewise of the load-profile table."""
    slot = F.col("half_hour_slot")
    return _grouped(
        profile.withColumn("day_type", day_type(DATE)), _PROFILE_KEYS, PROFILE_SETS,
        F.count(F.lit(1)).alias("n"),
        F.avg("avg_consumption").alias("mean"),
        F.avg("total_consumption").alias("mean_total"),
        F.sum("reading_count").alias("readings"),
        F.avg(F.when(slot.between(34, 41), F.col("avg_consumption"))).alias("evening"),
        F.avg(F.when(slot.between(4, 11), F.col("avg_consumption"))).alias("night"),
    )


def grouped_insights(peaks: DataFrame, profiles: DataFrame) -> dict[str, DataFrame]:
    """The insights of :func:`all_insights` from :func:`peak_groupings` and :func:`profile_groupings` (stored, best)."""

    def peak(name: str) -> DataFrame:
        return peaks.where(F.col("of") == name)

    def prof(name: str) -> DataFrame:
        return profiles.where(F.col("of") == name)

    def coverage(days: DataFrame, table: str) -> DataFrame:
        return days.agg(
            F.min(DATE).alias("min_date"), F.max(DATE).alias("max_date"), F.count(DATE).alias("populated_days"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        ).select(F.lit(table).alias("table_name"), "min_date", "max_date", "populated_days", "row_count")

    fleet = peak("all").agg(F.max("total")).scalar()
    whole = peak("all").agg(*[F.max(c).alias(c) for c in ("evening", "overnight", "n")])
    means = peak("site").select("dno_alias", SUB, F.col("n").alias("active_days"), F.col("mean_total").alias("avg_daily_total_consumption"),
                                F.col("max_peak").alias("max_observed_peak"), F.col("mean_peak").alias("avg_peak_consumption"))
    dno_days = peak("dno_day").select(DATE, "dno_alias", F.col("total").alias("system_daily_total"),
                                      F.col("max_peak").alias("max_substation_peak"), F.col("sites").alias("active_substations"))
    by_total = [F.desc_nulls_last("total_consumption"), F.asc_nulls_first(SUB)]
    top = peak("substation").select(SUB, F.col("total").alias("total_consumption")).orderBy(*by_total).limit(20)
    screen = peak("site").groupBy("dno_alias").agg(F.avg("mean_total").alias("dno_mean"), F.percentile_approx("mean_total", 0.5).alias("dno_median"))
    shares = peak("dno").select("dno_alias", F.col("total").alias("total_consumption"))
    spread = peak("day").agg(F.count(F.lit(1)).alias("days"), F.avg("total").alias("mean_day_total"), F.stddev_pop("total").alias("stddev_day_total"))
    nulls_first = F.asc_nulls_first
    return {
        "insight_date_coverage": coverage(peak("day"), "gold_peak_demand_substation_day").unionByName(
            coverage(prof("day"), "gold_avg_load_profile_day")
        ),
        "insight_top_substations": means.orderBy(F.desc_nulls_last("avg_daily_total_consumption"), nulls_first("dno_alias"), nulls_first(SUB)).limit(15),
        "insight_system_peak_day": dno_days.orderBy(F.desc_nulls_last("system_daily_total"), nulls_first(DATE), nulls_first("dno_alias")).limit(20),
        "insight_load_shape": prof("slot").select(
            "hour_of_day", "minute_of_hour", "half_hour_slot", F.col("mean").alias("mean_slot_consumption"),
            F.col("mean_total").alias("mean_slot_total_consumption"), F.col("readings").alias("total_readings"),
        ).orderBy(F.desc_nulls_last("mean_slot_consumption"), nulls_first("half_hour_slot"), nulls_first("minute_of_hour")),
        "insight_weekday_weekend_profile": prof("type_slot").select(
            "day_type", "half_hour_slot", F.col("mean").alias("mean_avg_consumption"), F.col("n").alias("contributing_day_slots")
        ).orderBy("day_type", "half_hour_slot"),
        "insight_substation_concentration": top.withColumn("rn", F.row_number().over(Window.orderBy(*by_total))).select(
            "rn", SUB, "total_consumption", fleet.alias("fleet_total_consumption"), _share(F.col("total_consumption"), fleet).alias("share_of_total")
        ).orderBy("rn"),
        "insight_peak_window": whole.select(
            F.col("evening").alias("evening_peak_events"), _share(F.col("evening"), F.col("n")).alias("evening_peak_share"),
            F.col("overnight").alias("overnight_peak_events"), _share(F.col("overnight"), F.col("n")).alias("overnight_peak_share"),
            F.when(F.col("n") > 0, F.col("n")).alias("total_events"),
        ),
        "insight_volatility": spread.withColumn("cv_day_total", _share(F.col("stddev_day_total"), F.col("mean_day_total"))),
        "insight_evening_ramp": prof("type").select(
            "day_type", F.col("evening").alias("evening_avg"), F.col("night").alias("night_avg"),
            _share(F.col("evening"), F.col("night")).alias("evening_to_night_ratio"),
        ),
        "insight_dno_outlier_screen": screen.withColumn("mean_to_median_ratio", _share(F.col("dno_mean"), F.col("dno_median"))).orderBy(
            F.desc_nulls_last("mean_to_median_ratio"), nulls_first("dno_alias")
        ),
        "insight_dno_share": shares.withColumn("share_of_total", _share(F.col("total_consumption"), fleet)).orderBy(
            F.desc_nulls_last("total_consumption"), nulls_first("dno_alias")
        ),
        "insight_peak_hour_distribution": peak("hour").select("peak_hour", F.col("n").alias("substation_days")).orderBy(nulls_first("peak_hour")),
    }
