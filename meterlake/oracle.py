"""Independent DuckDB SQL for every registered query that SQL can express.

Each statement re-derives Bronze from ``events`` with the FIXTURES.md mapping
and then follows the reference's SQL formulation (window + self-join for the
peak, LEFT JOIN ... IS NULL for missing slots, CROSS JOIN / scalar subqueries
in QA), so it does not share a plan with the Spark side.
"""

from __future__ import annotations

from meterlake.registry import (
    EMPTY_DATE,
    FIRST_DATE,
    INSTANT,
    LOW_CLIP_THRESHOLD,
    RANGE_END,
    RANGE_START,
    RUN_DATE,
)

FLAT_BRONZE = (
    "dataset_id, dno_alias, aggregated_device_count_active, total_consumption_active_import, "
    "data_collection_log_timestamp, secondary_substation_unique_id, lv_feeder_unique_id"
)


def f32(expr: str, alias: str | None = None) -> str:
    return f"CAST(CAST({expr} AS FLOAT) AS DOUBLE) AS {alias or expr}"


def _bronze_cte(variant: str) -> str:
    dno = "'DNO_' || CAST(sub % 5 AS VARCHAR)"
    devices = "k + 1"
    consumption = "c"
    ts = "time_bucket(INTERVAL 30 MINUTE, ts)"
    substation = "'SS' || CAST(sub AS VARCHAR)"
    if variant == "offgrid":
        ts = "CAST(ts AS TIMESTAMP)"
    if variant == "dirty":
        dno = f"CASE WHEN sub % 10 <> 7 THEN {dno} END"
        devices = "k"
        consumption = "CASE WHEN event_id % 97 = 0 THEN -c WHEN event_id % 83 = 0 THEN NULL ELSE c END"
        ts = f"CASE WHEN event_id % 79 <> 0 THEN {ts} END"
        substation = f"CASE WHEN event_id % 89 = 0 THEN '' WHEN event_id % 101 = 0 THEN NULL ELSE {substation} END"
    if variant == "skewed":
        consumption = "CASE WHEN sub = 3 THEN 5000 * c ELSE c END"
    if variant == "texttime":
        ts = f"CASE WHEN event_id % 61 <> 0 THEN {ts} END"
    return f"""ev AS (
  SELECT event_id, ts, user_id,
         CAST(floor(user_id / 3) AS BIGINT) AS sub,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CAST(round(value * 100) AS BIGINT) AS c
  FROM events
),
bronze AS (
  SELECT CAST(event_id AS VARCHAR) AS dataset_id,
         {dno} AS dno_alias,
         CAST({devices} AS BIGINT) AS aggregated_device_count_active,
         CAST({consumption} AS BIGINT) AS total_consumption_active_import,
         {ts} AS data_collection_log_timestamp,
         CAST(sub % 180 AS DOUBLE) AS geometry_x,
         CAST(sub % 90 AS DOUBLE) AS geometry_y,
         {substation} AS secondary_substation_unique_id,
         'F' || CAST(user_id % 3 AS VARCHAR) AS lv_feeder_unique_id
  FROM ev
)"""


def _day_pred(col: str, day: str) -> str:
    return f"{col} >= TIMESTAMP '{day} 00:00:00' AND {col} < TIMESTAMP '{day} 00:00:00' + INTERVAL 1 DAY"


def _silver_cte(name: str, src_where: str) -> str:
    return f"""{name} AS (
  SELECT dataset_id, dno_alias, aggregated_device_count_active,
         CAST(total_consumption_active_import AS DOUBLE) AS total_consumption_active_import,
         data_collection_log_timestamp, secondary_substation_unique_id, lv_feeder_unique_id,
         CAST(hour(data_collection_log_timestamp) AS INTEGER) AS hour_of_day,
         CAST(minute(data_collection_log_timestamp) AS INTEGER) AS minute_of_hour,
         CAST(hour(data_collection_log_timestamp) * 2 + minute(data_collection_log_timestamp) // 30 AS INTEGER)
           AS half_hour_slot,
         strftime(data_collection_log_timestamp, '%a') AS day_of_week,
         dayofweek(data_collection_log_timestamp) IN (0, 6) AS is_weekend,
         concat_ws('-', secondary_substation_unique_id, lv_feeder_unique_id) AS composite_feeder_id,
         CASE WHEN aggregated_device_count_active > 0
              THEN CAST(total_consumption_active_import AS DOUBLE) / aggregated_device_count_active END
           AS consumption_per_active_device,
         CAST(data_collection_log_timestamp AS DATE) AS collection_date,
         geometry_x, geometry_y
  FROM bronze
  WHERE {src_where}
)"""


def _dq_ctes(threshold: float, min_rows: int) -> str:
    t = f"CAST({threshold!r} AS DOUBLE)"
    z = "abs((total_consumption_active_import - zscore_mean) / zscore_stddev)"
    return f"""baseline AS (
  SELECT concat_ws('-', secondary_substation_unique_id, lv_feeder_unique_id) AS composite_feeder_id,
         avg(CAST(total_consumption_active_import AS DOUBLE)) AS zscore_mean,
         -- population stddev over whole numbers, rounded once
         sqrt(CAST(count(total_consumption_active_import) * sum(CAST(total_consumption_active_import AS HUGEINT) * total_consumption_active_import)
                   - sum(total_consumption_active_import) * sum(total_consumption_active_import) AS DOUBLE)
              / (CAST(nullif(count(total_consumption_active_import), 0) AS DOUBLE) * count(total_consumption_active_import))) AS zscore_stddev,
         count(*) AS zscore_history_count
  FROM bronze
  GROUP BY 1
),
scored AS (
  SELECT s.*, b.zscore_mean, b.zscore_stddev, b.zscore_history_count,
         (b.zscore_history_count >= {min_rows} AND b.zscore_stddev IS NOT NULL AND b.zscore_stddev > 0) AS has_base,
         (s.secondary_substation_unique_id IS NULL OR trim(s.secondary_substation_unique_id) = ''
          OR s.data_collection_log_timestamp IS NULL
          OR s.total_consumption_active_import IS NULL OR s.total_consumption_active_import < 0
          OR s.aggregated_device_count_active IS NULL OR s.aggregated_device_count_active <= 0) AS invalid
  FROM silver s LEFT JOIN baseline b ON s.composite_feeder_id = b.composite_feeder_id
),
dq AS (
  SELECT *,
         CASE WHEN has_base THEN {z} END AS consumption_zscore,
         CASE WHEN invalid THEN 'DROP' WHEN has_base AND {z} > {t} THEN 'CLIP' ELSE 'KEEP' END AS dq_action,
         CASE WHEN invalid THEN 'FAIL' ELSE 'PASS' END AS data_quality_flag,
         CASE WHEN invalid THEN 'INVALID_RULE' WHEN has_base AND {z} > {t} THEN 'ZSCORE_CLIPPED' END AS dq_reason,
         CASE WHEN NOT invalid AND has_base AND {z} > {t} THEN zscore_mean + zscore_stddev * {t}
              ELSE total_consumption_active_import END AS adjusted_total_consumption_active_import
  FROM scored
)"""


GOLD_CTES = """gin AS (
  SELECT * REPLACE (
           adjusted_total_consumption_active_import AS total_consumption_active_import,
           CASE WHEN aggregated_device_count_active > 0
                THEN adjusted_total_consumption_active_import / aggregated_device_count_active END
             AS consumption_per_active_device)
  FROM dq
  WHERE dq_action <> 'DROP'
),
group_first AS (
  SELECT collection_date, dno_alias, secondary_substation_unique_id,
         total_consumption_active_import AS pc, data_collection_log_timestamp AS pt,
         row_number() OVER (PARTITION BY collection_date, dno_alias, secondary_substation_unique_id
                            ORDER BY total_consumption_active_import DESC NULLS LAST,
                                     data_collection_log_timestamp ASC NULLS FIRST) AS rn
  FROM gin
),
group_stats AS (
  SELECT collection_date, dno_alias, secondary_substation_unique_id,
         sum(total_consumption_active_import) AS daily_total_consumption,
         avg(total_consumption_active_import) AS avg_half_hour_consumption,
         avg(aggregated_device_count_active) AS avg_active_devices,
         count(DISTINCT composite_feeder_id) AS feeder_count,
         count(*) AS reading_count
  FROM gin
  GROUP BY 1, 2, 3
),
peak AS (
  SELECT s.collection_date AS consumption_date, s.dno_alias, s.secondary_substation_unique_id,
         r.pc AS peak_consumption, r.pt AS peak_timestamp,
         s.daily_total_consumption, s.avg_half_hour_consumption, s.avg_active_devices,
         s.feeder_count, s.reading_count
  FROM group_stats s
  LEFT JOIN group_first r
    ON r.rn = 1 AND s.collection_date = r.collection_date AND s.dno_alias = r.dno_alias
   AND s.secondary_substation_unique_id = r.secondary_substation_unique_id
),
profile AS (
  SELECT collection_date AS consumption_date, hour_of_day, minute_of_hour, half_hour_slot,
         avg(total_consumption_active_import) AS avg_consumption,
         sum(total_consumption_active_import) AS total_consumption,
         count(*) AS reading_count,
         count(DISTINCT secondary_substation_unique_id) AS substation_count,
         count(DISTINCT composite_feeder_id) AS feeder_count,
         avg(consumption_per_active_device) AS avg_consumption_per_active_device
  FROM gin
  GROUP BY 1, 2, 3, 4
)"""


def with_layers(
    variant: str = "clean",
    *,
    where: str = "TRUE",
    upto: str = "gold",
    threshold: float = 3.0,
    min_rows: int = 7,
) -> str:
    parts = [_bronze_cte(variant)]
    if upto in ("silver", "dq", "gold"):
        parts.append(_silver_cte("silver", where))
    if upto in ("dq", "gold"):
        parts.append(_dq_ctes(threshold, min_rows))
    if upto == "gold":
        parts.append(GOLD_CTES)
    return "WITH " + ",\n".join(parts) + "\n"


DQ_SELECT = (
    "dataset_id, composite_feeder_id, collection_date, total_consumption_active_import, zscore_mean, zscore_stddev, "
    "zscore_history_count, consumption_zscore, dq_action, data_quality_flag, dq_reason, adjusted_total_consumption_active_import"
)
PEAK_SELECT = (
    "consumption_date, dno_alias, secondary_substation_unique_id, " + f32("peak_consumption")
    + ", peak_timestamp, " + f32("daily_total_consumption") + ", " + f32("avg_half_hour_consumption")
    + ", avg_active_devices, feeder_count, reading_count"
)
PROFILE_SELECT = (
    "consumption_date, hour_of_day, minute_of_hour, half_hour_slot, " + f32("avg_consumption") + ", "
    + f32("total_consumption") + ", reading_count, substation_count, feeder_count, "
    + f32("avg_consumption_per_active_device")
)
SILVER_SELECT = (
    FLAT_BRONZE + ", hour_of_day, minute_of_hour, half_hour_slot, day_of_week, is_weekend, composite_feeder_id, "
    "consumption_per_active_device, collection_date"
)


def _qa_freshness(day: str, variant: str = "clean") -> str:
    return with_layers(variant) + f"""
SELECT '{day}' AS run_date, n AS row_count, IF(n > 0, 'PASS', 'FAIL') AS freshness_status
FROM (SELECT count(*) AS n FROM dq WHERE collection_date = DATE '{day}') day_rows"""


def _qa_completeness(day: str, variant: str = "clean") -> str:
    return with_layers(variant) + f""",
day_profile AS (SELECT half_hour_slot FROM profile WHERE consumption_date = DATE '{day}'),
slot_grid AS (SELECT CAST(range AS INTEGER) AS slot FROM range(48)),
measures AS (
  SELECT (SELECT count(*) FROM day_profile) AS profile_rows,
         (SELECT count(*) FROM slot_grid g
           WHERE NOT EXISTS (SELECT 1 FROM day_profile p WHERE p.half_hour_slot = g.slot)) AS gaps,
         (SELECT count(DISTINCT strftime(data_collection_log_timestamp, '%H:%M'))
            FROM dq WHERE collection_date = DATE '{day}') AS clock_times
)
SELECT '{day}' AS run_date, profile_rows AS slot_rows, gaps AS missing_slot_count,
       clock_times AS distinct_timestamp_count,
       IF(gaps = 0 AND clock_times = 48, 'PASS', 'FAIL') AS completeness_status
FROM measures"""


def _qa_uniqueness(day: str, variant: str = "clean") -> str:
    return with_layers(variant) + f""",
key_sizes AS (
  SELECT 'peak' AS tbl, count(*) AS c FROM peak WHERE consumption_date = DATE '{day}'
  GROUP BY consumption_date, secondary_substation_unique_id
  UNION ALL
  SELECT 'profile' AS tbl, count(*) AS c FROM profile WHERE consumption_date = DATE '{day}'
  GROUP BY consumption_date, half_hour_slot
)
SELECT '{day}' AS run_date,
       count(*) FILTER (WHERE tbl = 'peak' AND c > 1) AS peak_duplicate_key_count,
       count(*) FILTER (WHERE tbl = 'profile' AND c > 1) AS profile_duplicate_key_count,
       IF(count(*) FILTER (WHERE c > 1) = 0, 'PASS', 'FAIL') AS uniqueness_status
FROM key_sizes"""


def _flag(cond: str) -> str:
    """1/0 per row summed: NULL over no rows, 0 when the condition is never TRUE."""
    return f"CAST(sum(IF({cond}, 1, 0)) AS BIGINT)"


def _qa_nulls(day: str, variant: str = "clean") -> str:
    return with_layers(variant) + f"""
SELECT '{day}' AS run_date, a AS null_substation_id, b AS null_timestamp, c AS null_consumption,
       IF(a + b + c = 0, 'PASS', 'FAIL') AS null_check_status
FROM (
  SELECT {_flag("secondary_substation_unique_id IS NULL")} AS a,
         {_flag("data_collection_log_timestamp IS NULL")} AS b,
         {_flag("total_consumption_active_import IS NULL")} AS c
  FROM dq WHERE collection_date = DATE '{day}'
) sums"""


def _qa_business_rules(day: str, variant: str = "clean") -> str:
    return with_layers(variant) + f""",
today AS (
  SELECT count(*) AS n, avg(total_consumption_active_import) AS mean_c,
         {_flag("aggregated_device_count_active <= 0")} AS bad_dev,
         {_flag("total_consumption_active_import < 0")} AS bad_c,
         {_flag("consumption_per_active_device < 0")} AS bad_pd
  FROM dq WHERE collection_date = DATE '{day}'
),
earlier AS (
  SELECT count(*) AS n, avg(total_consumption_active_import) AS mean_c
  FROM dq
  WHERE collection_date = (SELECT max(collection_date) FROM dq WHERE collection_date < DATE '{day}')
  HAVING count(*) > 0
),
drift AS (
  SELECT t.*, e.n AS prev_n, e.mean_c AS prev_mean,
         (SELECT count(*) FROM peak WHERE consumption_date = DATE '{day}'
             AND peak_consumption > daily_total_consumption) AS bad_peak,
         abs((t.n - e.n) / NULLIF(CAST(e.n AS DOUBLE), 0)) AS row_drift,
         abs((t.mean_c - e.mean_c) / NULLIF(e.mean_c, 0)) AS mean_drift
  FROM today t LEFT JOIN earlier e ON e.n IS NOT NULL
)
SELECT '{day}' AS run_date, bad_dev AS bad_active_devices, bad_c AS bad_consumption,
       bad_pd AS bad_consumption_per_device, bad_peak AS bad_peak_rows,
       n AS current_row_count, prev_n AS previous_row_count, {f32("row_drift", "row_count_change_ratio")},
       {f32("mean_c", "current_avg_consumption")}, {f32("prev_mean", "previous_avg_consumption")},
       {f32("mean_drift", "avg_consumption_change_ratio")},
       CASE WHEN bad_dev = 0 AND bad_c = 0 AND bad_pd = 0 AND bad_peak = 0
                 AND (prev_n IS NULL OR row_drift <= 0.2) AND (prev_mean IS NULL OR mean_drift <= 0.3)
            THEN 'PASS' ELSE 'FAIL' END AS business_rule_status
FROM drift"""


def _insights(variant: str = "clean") -> dict[str, str]:
    L = with_layers(variant)
    kind = "IF(isodow(consumption_date) >= 6, 'weekend', 'weekday')"
    fleet = "(SELECT sum(daily_total_consumption) FROM peak)"
    ramp = f"""
SELECT {kind} AS day_type,
       {f32("avg(avg_consumption) FILTER (WHERE half_hour_slot BETWEEN 34 AND 41)", "evening_avg")},
       {f32("avg(avg_consumption) FILTER (WHERE half_hour_slot BETWEEN 4 AND 11)", "night_avg")},
       {f32("avg(avg_consumption) FILTER (WHERE half_hour_slot BETWEEN 34 AND 41)"
            " / NULLIF(avg(avg_consumption) FILTER (WHERE half_hour_slot BETWEEN 4 AND 11), 0)",
            "evening_to_night_ratio")}
FROM profile GROUP BY 1"""
    outlier = f""",
site_means AS (
  SELECT dno_alias AS dno, secondary_substation_unique_id, avg(daily_total_consumption) AS site_mean
  FROM peak GROUP BY 1, 2
)
SELECT dno AS dno_alias, {f32("avg(site_mean)", "dno_mean")}, {f32("quantile_disc(site_mean, 0.5)", "dno_median")},
       {f32("avg(site_mean) / NULLIF(quantile_disc(site_mean, 0.5), 0)", "mean_to_median_ratio")}
FROM site_means GROUP BY dno"""
    site_totals = """,
site_totals AS (
  SELECT secondary_substation_unique_id AS site, sum(daily_total_consumption) AS site_total FROM peak GROUP BY 1
),
ordered AS (
  SELECT site, site_total,
         row_number() OVER (ORDER BY site_total DESC NULLS LAST, site ASC NULLS FIRST) AS pos
  FROM site_totals
)"""
    hour_counts = """
SELECT CAST(hour(peak_timestamp) AS INTEGER) AS peak_hour, count(*) AS substation_days FROM peak GROUP BY 1"""
    share = f"""
SELECT dno_alias, {f32("sum(daily_total_consumption)", "total_consumption")},
       {f32(f"sum(daily_total_consumption) / NULLIF({fleet}, 0)", "share_of_total")}{{extra}}
FROM peak GROUP BY 1"""
    return {
        "insight_date_coverage": L + """
SELECT tbl AS table_name, min(d) AS min_date, max(d) AS max_date, count(DISTINCT d) AS populated_days,
       count(*) AS row_count
FROM (SELECT 'gold_peak_demand_substation_day' AS tbl, consumption_date AS d FROM peak
      UNION ALL SELECT 'gold_avg_load_profile_day', consumption_date FROM profile) both_tables
GROUP BY tbl""",
        "insight_top_substations": L + f"""
SELECT dno_alias, secondary_substation_unique_id, count(*) AS active_days,
       {f32("avg(daily_total_consumption)", "avg_daily_total_consumption")},
       {f32("max(peak_consumption)", "max_observed_peak")},
       {f32("avg(peak_consumption)", "avg_peak_consumption")}
FROM peak GROUP BY 1, 2
ORDER BY avg(daily_total_consumption) DESC NULLS LAST, 1 ASC NULLS FIRST, 2 ASC NULLS FIRST
LIMIT 15""",
        "insight_system_peak_day": L + f"""
SELECT consumption_date, dno_alias, {f32("sum(daily_total_consumption)", "system_daily_total")},
       {f32("max(peak_consumption)", "max_substation_peak")},
       count(DISTINCT secondary_substation_unique_id) AS active_substations
FROM peak GROUP BY 1, 2
ORDER BY sum(daily_total_consumption) DESC NULLS LAST, 1 ASC NULLS FIRST, 2 ASC NULLS FIRST
LIMIT 20""",
        "insight_load_shape": L + f"""
SELECT hour_of_day, minute_of_hour, half_hour_slot,
       {f32("avg(avg_consumption)", "mean_slot_consumption")},
       {f32("avg(total_consumption)", "mean_slot_total_consumption")},
       CAST(sum(reading_count) AS BIGINT) AS total_readings
FROM profile GROUP BY 1, 2, 3""",
        "insight_weekday_weekend_profile": L + f"""
SELECT {kind} AS day_type, half_hour_slot, {f32("avg(avg_consumption)", "mean_avg_consumption")},
       count(*) AS contributing_day_slots
FROM profile GROUP BY 1, 2""",
        "insight_substation_concentration": L + site_totals + f"""
SELECT CAST(pos AS INTEGER) AS rn, site AS secondary_substation_unique_id, {f32("site_total", "total_consumption")},
       {f32(fleet, "fleet_total_consumption")},
       {f32(f"site_total / NULLIF({fleet}, 0)", "share_of_total")}
FROM ordered WHERE pos <= 20""",
        "insight_peak_window": L + f"""
SELECT IF(n > 0, evening, NULL) AS evening_peak_events, {f32("evening / CAST(n AS DOUBLE)", "evening_peak_share")},
       IF(n > 0, overnight, NULL) AS overnight_peak_events,
       {f32("overnight / CAST(n AS DOUBLE)", "overnight_peak_share")}, IF(n > 0, n, NULL) AS total_events
FROM (
  SELECT count(*) AS n,
         count(*) FILTER (WHERE hour(peak_timestamp) BETWEEN 17 AND 20) AS evening,
         count(*) FILTER (WHERE hour(peak_timestamp) BETWEEN 0 AND 5) AS overnight
  FROM peak
) hours""",
        "insight_volatility": L + f"""
SELECT count(*) AS days, {f32("avg(t)", "mean_day_total")}, {f32("stddev_pop(t)", "stddev_day_total")},
       {f32("stddev_pop(t) / NULLIF(avg(t), 0)", "cv_day_total")}
FROM (SELECT consumption_date, sum(daily_total_consumption) AS t FROM peak GROUP BY 1) per_day""",
        "insight_evening_ramp": L + ramp,
        "insight_dno_outlier_screen": L + outlier,
        "insight_dno_share": L + share.format(extra=""),
        "insight_peak_hour_distribution": L + hour_counts,
        "chart_dno_share": L + share.format(
            extra=",\n       " + f32(f"sum(daily_total_consumption) / NULLIF({fleet}, 0) * 100", "share_pct")
        ),
        "chart_load_shape": L + f"""
SELECT half_hour_slot, {f32("avg(avg_consumption)", "mean_slot_consumption")} FROM profile GROUP BY 1""",
        "chart_peak_hour": L + hour_counts,
        "chart_concentration": L + site_totals + f""",
top10 AS (SELECT pos, site_total, site_total / NULLIF({fleet}, 0) AS s FROM ordered WHERE pos <= 10)
SELECT CAST(pos AS INTEGER) AS rn, {f32("site_total", "total_consumption")}, {f32("s", "share_of_total")},
       {f32("s * 100", "share_pct")},
       {f32("(SELECT sum(s) FROM top10 earlier WHERE earlier.pos <= top10.pos) * 100", "cum_share_pct")}
FROM top10""",
        "chart_weekday_weekend": L + ramp,
        "chart_dno_outlier": L + outlier,
    }


def oracle_sql() -> dict[str, str]:
    day = RUN_DATE
    sql: dict[str, str] = {
        "bronze_scan": with_layers(upto="bronze") + f"SELECT {FLAT_BRONZE} FROM bronze",
        "readings_at_instant": with_layers(upto="bronze")
        + f"SELECT {FLAT_BRONZE} FROM bronze WHERE data_collection_log_timestamp = TIMESTAMP '{INSTANT}'",
        "run_date_slice": with_layers("dirty", upto="bronze")
        + f"SELECT {FLAT_BRONZE} FROM bronze WHERE {_day_pred('data_collection_log_timestamp', day)}",
        "date_range_slice": with_layers(upto="bronze")
        + f"SELECT {FLAT_BRONZE} FROM bronze WHERE data_collection_log_timestamp >= TIMESTAMP '{RANGE_START} 00:00:00'"
        f" AND data_collection_log_timestamp < TIMESTAMP '{RANGE_END} 00:00:00' + INTERVAL 1 DAY",
        "source_date_profile": with_layers(upto="bronze")
        + f"SELECT '{day}' AS run_date, count(*) AS row_count FROM bronze"
        f" WHERE CAST(data_collection_log_timestamp AS DATE) = DATE '{day}'",
        "parquet_profile_files": with_layers("dirty", upto="bronze")
        + """SELECT count(*) AS row_count, 3::BIGINT AS files,
       CAST(min(data_collection_log_timestamp) AS DATE) AS min_date,
       CAST(max(data_collection_log_timestamp) AS DATE) AS max_date,
       min(data_collection_log_timestamp) AS min_timestamp, max(data_collection_log_timestamp) AS max_timestamp
FROM bronze""",
        "parquet_profile": with_layers("dirty", upto="bronze")
        + """SELECT count(*) AS row_count,
       CAST(min(data_collection_log_timestamp) AS DATE) AS min_date,
       CAST(max(data_collection_log_timestamp) AS DATE) AS max_date,
       min(data_collection_log_timestamp) AS min_timestamp, max(data_collection_log_timestamp) AS max_timestamp
FROM bronze""",
        "silver_profile": with_layers(upto="dq")
        + """SELECT count(*) AS row_count, min(collection_date) AS min_collection_date,
       max(collection_date) AS max_collection_date,
       min(data_collection_log_timestamp) AS min_timestamp, max(data_collection_log_timestamp) AS max_timestamp
FROM dq""",
        "silver_build": with_layers("dirty", where="TRUE", upto="silver") + f"SELECT {SILVER_SELECT} FROM silver",
        "calendar_columns": with_layers(upto="bronze")
        + """SELECT dataset_id,
       CAST(year(data_collection_log_timestamp) AS INTEGER) AS year,
       CAST(month(data_collection_log_timestamp) AS INTEGER) AS month,
       CAST(day(data_collection_log_timestamp) AS INTEGER) AS day,
       CAST(hour(data_collection_log_timestamp) AS INTEGER) AS hour
FROM bronze""",
        "geometry_xy": with_layers(upto="bronze") + "SELECT dataset_id, geometry_x, geometry_y FROM bronze",
        "composite_id_strict": with_layers("dirty", upto="bronze")
        + """SELECT dataset_id,
       concat_ws('-', secondary_substation_unique_id, lv_feeder_unique_id) AS composite_feeder_id,
       secondary_substation_unique_id || '-' || lv_feeder_unique_id AS composite_id_strict
FROM bronze""",
        "slot_to_hhmm": with_layers("offgrid", where="TRUE", upto="silver")
        + """SELECT dataset_id, half_hour_slot,
       lpad(CAST(half_hour_slot // 2 AS VARCHAR), 2, '0') || ':' ||
       CASE WHEN half_hour_slot % 2 = 1 THEN '30' ELSE '00' END AS slot_hhmm
FROM silver""",
        "coerce_numeric": with_layers(upto="bronze")
        + """SELECT TRY_CAST(dataset_id AS DOUBLE) AS dataset_id_value,
       TRY_CAST(dno_alias AS DOUBLE) AS dno_alias_value
FROM bronze""",
        "preview": with_layers(upto="bronze")
        + "SELECT dataset_id, aggregated_device_count_active FROM bronze ORDER BY dataset_id LIMIT 20",
        "safe_double": with_layers("dirty", upto="bronze")
        + """SELECT dataset_id,
       coalesce(CAST(NULLIF(replace(secondary_substation_unique_id, 'SS', ''), '') AS DOUBLE), 0) AS substation_number,
       coalesce(CAST(total_consumption_active_import AS DOUBLE), 0) AS consumption
FROM bronze""",
        "silver_text_time": with_layers("texttime", upto="silver")
        + "SELECT dataset_id, data_collection_log_timestamp, half_hour_slot, day_of_week, collection_date FROM silver",
        "silver_profile_text_time": with_layers("texttime", upto="silver")
        + """SELECT count(*) AS row_count, min(collection_date) AS min_collection_date,
       max(collection_date) AS max_collection_date,
       min(data_collection_log_timestamp) AS min_timestamp, max(data_collection_log_timestamp) AS max_timestamp
FROM silver""",
        "day_sequence": with_layers(upto="bronze")
        + """, days AS (SELECT CAST(unnest(generate_series(DATE '2023-12-30', DATE '2024-02-02', INTERVAL 1 DAY)) AS DATE) AS day)
SELECT day, count(dataset_id) AS readings
FROM days LEFT JOIN bronze ON CAST(data_collection_log_timestamp AS DATE) = day GROUP BY 1""",
        "feeder_baseline": with_layers("dirty", upto="dq")
        + "SELECT composite_feeder_id, zscore_mean, zscore_stddev, zscore_history_count FROM baseline",
        "feeder_baseline_moments": with_layers("dirty", upto="dq")
        + "SELECT composite_feeder_id, zscore_mean, zscore_stddev, zscore_history_count FROM baseline",
        "dq_zscore": with_layers(upto="dq") + f"SELECT {DQ_SELECT} FROM dq",
        "dq_zscore_dirty": with_layers("dirty", upto="dq") + f"SELECT {DQ_SELECT} FROM dq",
        "dq_zscore_low_clip": with_layers(upto="dq", threshold=LOW_CLIP_THRESHOLD) + f"SELECT {DQ_SELECT} FROM dq",
        "gold_input": with_layers()
        + f"SELECT dataset_id, dq_action, {f32('total_consumption_active_import')},"
        f" {f32('consumption_per_active_device')} FROM gin",
        "peak_rank": with_layers()
        + f"""SELECT collection_date, dno_alias, secondary_substation_unique_id,
       CAST(row_number() OVER (PARTITION BY collection_date, dno_alias, secondary_substation_unique_id
                               ORDER BY total_consumption_active_import DESC NULLS LAST,
                                        data_collection_log_timestamp ASC NULLS FIRST) AS INTEGER) AS peak_rank,
       {f32('total_consumption_active_import')}, data_collection_log_timestamp
FROM gin""",
        "gold_peak": with_layers() + f"SELECT {PEAK_SELECT} FROM peak",
        "gold_peak_dirty": with_layers("dirty") + f"SELECT {PEAK_SELECT} FROM peak",
        "gold_peak_ranked": with_layers() + f"SELECT {PEAK_SELECT} FROM peak",
        "gold_profile": with_layers() + f"SELECT {PROFILE_SELECT} FROM profile",
        "gold_profile_offgrid": with_layers("offgrid") + f"SELECT {PROFILE_SELECT} FROM profile",
        "hourly_summary": with_layers("dirty", upto="bronze")
        + """, firsts AS (
  SELECT *, row_number() OVER (
           PARTITION BY year(data_collection_log_timestamp), month(data_collection_log_timestamp),
                        day(data_collection_log_timestamp), hour(data_collection_log_timestamp)
           ORDER BY data_collection_log_timestamp ASC NULLS FIRST, dataset_id ASC NULLS FIRST) AS pos
  FROM bronze
)
SELECT CAST(year(data_collection_log_timestamp) AS INTEGER) AS year,
       CAST(month(data_collection_log_timestamp) AS INTEGER) AS month,
       CAST(day(data_collection_log_timestamp) AS INTEGER) AS day,
       CAST(hour(data_collection_log_timestamp) AS INTEGER) AS hour,
       CAST(sum(total_consumption_active_import) AS BIGINT) AS total_consumption,
       max(CASE WHEN pos = 1 THEN aggregated_device_count_active END) AS aggregated_device_count,
       avg(aggregated_device_count_active) AS mean_aggregated_device_count,
       CAST(sum(aggregated_device_count_active) AS BIGINT) AS total_devices_measured,
       max(total_consumption_active_import) AS max_consumption,
       min(total_consumption_active_import) AS min_consumption,
       avg(total_consumption_active_import) AS mean_consumption
FROM firsts GROUP BY 1, 2, 3, 4""",
        "distinct_counts": with_layers("dirty", upto="bronze")
        + """SELECT count(DISTINCT secondary_substation_unique_id) AS substations,
       count(DISTINCT lv_feeder_unique_id) AS feeders,
       count(DISTINCT (geometry_x, geometry_y)) AS geometries,
       count(DISTINCT secondary_substation_unique_id || '-' || lv_feeder_unique_id) AS substation_feeder_pairs,
       count(DISTINCT CASE WHEN secondary_substation_unique_id IS NOT NULL
                           THEN (secondary_substation_unique_id, geometry_x, geometry_y) END) AS substation_geometry_pairs,
       count(DISTINCT CASE WHEN lv_feeder_unique_id IS NOT NULL
                           THEN (lv_feeder_unique_id, geometry_x, geometry_y) END) AS feeder_geometry_pairs
FROM bronze""",
        "feeders_per_site": with_layers("dirty", upto="bronze")
        + """SELECT secondary_substation_unique_id, geometry_x, geometry_y,
       count(DISTINCT lv_feeder_unique_id) AS feeder_count
FROM bronze WHERE secondary_substation_unique_id IS NOT NULL GROUP BY 1, 2, 3""",
        "transform_counts": with_layers(where=_day_pred("data_collection_log_timestamp", day))
        + f"""SELECT '{day}' AS run_date,
       (SELECT count(*) FROM bronze WHERE {_day_pred('data_collection_log_timestamp', day)}) AS raw_count,
       (SELECT count(*) FROM dq) AS silver_count,
       (SELECT count(*) FROM peak) AS peak_count,
       (SELECT count(*) FROM profile) AS load_profile_count""",
        "missing_slots": with_layers()
        + """
SELECT d.consumption_date, CAST(g.range AS INTEGER) AS half_hour_slot
FROM (SELECT DISTINCT consumption_date FROM profile) d, range(48) g
WHERE NOT EXISTS (
  SELECT 1 FROM profile p WHERE p.consumption_date = d.consumption_date AND p.half_hour_slot = g.range
)""",
        "previous_day": with_layers(upto="dq")
        + f"""SELECT collection_date, count(*) AS row_count, avg(total_consumption_active_import) AS avg_consumption
FROM dq WHERE collection_date = (SELECT max(collection_date) FROM dq WHERE collection_date < DATE '{day}')
GROUP BY collection_date""",
        "qa_freshness": _qa_freshness(day),
        "qa_freshness_empty_day": _qa_freshness(EMPTY_DATE),
        "qa_completeness": _qa_completeness(day),
        "qa_uniqueness": _qa_uniqueness(day),
        "qa_uniqueness_offgrid": _qa_uniqueness(day, "offgrid"),
        "qa_nulls": _qa_nulls(day),
        "qa_nulls_empty_day": _qa_nulls(EMPTY_DATE),
        "qa_business_rules": _qa_business_rules(day),
        "qa_business_rules_dirty": _qa_business_rules(day, "dirty"),
        "qa_business_rules_first_day": _qa_business_rules(FIRST_DATE),
    }
    sql.update(_insights())
    sql.update({f"{name}_dirty": text for name, text in _insights("dirty").items() if name.startswith("insight_")})
    sql.update(_jobs())
    sql.update(_composites(sql))
    return sql


def _jobs() -> dict[str, str]:
    from meterlake.registry import FULL_END, FULL_START

    ts = "data_collection_log_timestamp"
    day = with_layers(where=_day_pred(ts, RUN_DATE))
    full = with_layers(
        where=f"{ts} >= TIMESTAMP '{FULL_START} 00:00:00' AND {ts} < TIMESTAMP '{FULL_END} 00:00:00' + INTERVAL 1 DAY"
    )
    counts = """
SELECT 'silver' AS table_name, count(*) AS row_count FROM dq
UNION ALL SELECT 'gold_peak', count(*) FROM peak
UNION ALL SELECT 'gold_profile', count(*) FROM profile"""
    return {
        "daily_transform": day + counts,
        "run_log": day
        + f"""
SELECT DATE '{RUN_DATE}' AS run_date, 'meter-daily-pipeline' AS pipeline_name, 'SUCCESS' AS status,
       (SELECT count(*) FROM bronze WHERE {_day_pred(ts, RUN_DATE)}) AS input_row_count,
       (SELECT count(*) FROM dq) AS silver_row_count,
       (SELECT count(*) FROM peak) AS peak_table_row_count, (SELECT count(*) FROM profile) AS load_profile_row_count,
       '' AS error_message, 'dev' AS code_version""",
        "write_silver": day + f"SELECT {DQ_SELECT} FROM dq",
        "write_silver_moments": day + f"SELECT {DQ_SELECT} FROM dq",
        "write_silver_moments_changed": day + f"SELECT {DQ_SELECT} FROM dq",
        "write_silver_moments_late": with_layers("dirty", where=_day_pred(ts, RUN_DATE)) + f"SELECT {DQ_SELECT} FROM dq",
        "write_gold_peak": day + f"SELECT {PEAK_SELECT} FROM peak",
        "write_gold_profile": day + f"SELECT {PROFILE_SELECT} FROM profile",
        "backfill_range": full + "SELECT collection_date, dq_action, count(*) AS row_count FROM dq GROUP BY 1, 2",
        "backfill_range_gold": full + f"SELECT {PEAK_SELECT} FROM peak",
        "backfill_range_profile": full + f"SELECT {PROFILE_SELECT} FROM profile",
        "backfill_run_log": full
        + f"""
SELECT CAST(d AS DATE) AS run_date, 'SUCCESS' AS status,
       (SELECT count(*) FROM bronze WHERE CAST({ts} AS DATE) = d) AS input_row_count,
       (SELECT count(*) FROM dq WHERE collection_date = d) AS silver_row_count,
       (SELECT count(*) FROM peak WHERE consumption_date = d) AS peak_table_row_count,
       (SELECT count(*) FROM profile WHERE consumption_date = d) AS load_profile_row_count
FROM (SELECT CAST(unnest(generate_series(DATE '{FULL_START}', DATE '{FULL_END}', INTERVAL 1 DAY)) AS DATE) AS d) days""",
        "run_log_metadata": """
SELECT '3.0' AS zscore_threshold, TRUE AS has_warehouse, TRUE AS is_uuid, TRUE AS in_order, TRUE AS is_utc""",
        "register_tables": full
        + f"""
SELECT 'bronze_readings' AS table_name, count(*) AS row_count FROM bronze
UNION ALL SELECT 'silver_half_hourly_clean', count(*) FROM dq
UNION ALL SELECT 'gold_peak_demand_substation_day', count(*) FROM peak
UNION ALL SELECT 'gold_avg_load_profile_day', count(*) FROM profile
UNION ALL SELECT 'pipeline_run_log', date_diff('day', DATE '{FULL_START}', DATE '{FULL_END}') + 1""",
        "table_bronze": full + f"SELECT {FLAT_BRONZE} FROM bronze",
        "table_silver": full + f"SELECT {DQ_SELECT} FROM dq",
        "table_gold_peak": full + f"SELECT {PEAK_SELECT} FROM peak",
        "table_gold_profile": full + f"SELECT {PROFILE_SELECT} FROM profile",
        "table_run_log": full
        + f"""
SELECT d AS run_date, 'SUCCESS' AS status, (SELECT count(*) FROM dq WHERE collection_date = d) AS silver_row_count
FROM (SELECT CAST(unnest(generate_series(DATE '{FULL_START}', DATE '{FULL_END}', INTERVAL 1 DAY)) AS DATE) AS d) days""",
        "projected_partitions": full + "SELECT collection_date, count(*) AS row_count FROM dq GROUP BY 1",
        "run_sql": full
        + f"""
SELECT dno_alias, count(*) AS substation_days, CAST(sum(reading_count) AS BIGINT) AS readings
FROM peak WHERE consumption_date <= DATE '{FULL_END}' GROUP BY dno_alias""",
        "run_sql_all": full + "SELECT consumption_date, dno_alias, secondary_substation_unique_id, reading_count FROM peak",
        "export_json_nulls": with_layers("dirty")
        + "SELECT consumption_date, dno_alias, secondary_substation_unique_id, reading_count, 4 AS fields FROM peak",
        "export_json": with_layers()
        + f"""
SELECT dno_alias, {f32("sum(daily_total_consumption)", "total_consumption")},
       {f32("sum(daily_total_consumption) / sum(sum(daily_total_consumption)) OVER ()", "share_of_total")}
FROM peak GROUP BY 1""",
    }


def _hhmm(slot: str) -> str:
    return f"lpad(CAST({slot} // 2 AS VARCHAR), 2, '0') || ':' || CASE WHEN {slot} % 2 = 1 THEN '30' ELSE '00' END"


def _text() -> str:
    n = lambda v: f"format('{{:,.2f}}', {v})"
    r = lambda v, k: f"printf('%.{k}f', {v})"
    return f"""
SELECT finding_order, finding, CASE finding
  WHEN 'top_substation' THEN subject || ' uses most per day: ' || {n("a")} || ' on average, ' || {n("b")} || ' at its highest half-hour'
  WHEN 'highest_demand_day' THEN subject || ' was the busiest day: ' || {n("a")} || ' from ' || format('{{:,.0f}}', b) || ' sites'
  WHEN 'load_shape_peak_trough' THEN 'the day is highest/lowest at ' || subject || ': ' || {n("a")} || ' against ' || {n("b")} || ' per slot'
  WHEN 'weekday_weekend_delta' THEN 'a slot averages ' || {n("a")} || ' from Monday to Friday and ' || {n("b")} || ' otherwise, '
       || printf('%+.2f', c) || '%'
  WHEN 'demand_concentration' THEN {r("a", 2)} || '% of all demand comes from five sites, ' || {r("b", 2)} || '% from ten'
  WHEN 'peak_timing' THEN {r("a", 2)} || '% of peaks fall in the evening (17 to 20 h) and ' || {r("b", 2)} || '% in the night (0 to 5 h)'
  WHEN 'volatility' THEN 'daily totals spread by ' || {r("a", 3)} || ' of their mean (' || {n("b")} || ' around ' || {n("c")} || ')'
  WHEN 'evening_ramp' THEN 'evening demand over night demand is ' || {r("a", 3)} || ' on weekdays and ' || {r("b", 3)} || ' at weekends'
  WHEN 'skew_alert' THEN 'ALERT ' || subject || ': its mean is ' || {n("a")} || ' times its median' END AS line
FROM (SELECT *, coalesce(raw_1, 0) AS a, coalesce(raw_2, 0) AS b, coalesce(raw_3, 0) AS c FROM ({_summary("skewed", raw=True)}) s) t"""


def _summary(variant: str = "clean", raw: bool = False) -> str:
    day_type = "CASE WHEN isodow(consumption_date) IN (6, 7) THEN 'weekend' ELSE 'weekday' END"
    v = "CAST(NULL AS DOUBLE)"
    return with_layers(variant) + f""",
top AS (
  SELECT dno_alias, secondary_substation_unique_id AS sub, avg(daily_total_consumption) AS a,
         max(peak_consumption) AS m
  FROM peak GROUP BY 1, 2
  ORDER BY a DESC NULLS LAST, dno_alias ASC NULLS FIRST, sub ASC NULLS FIRST LIMIT 1
),
daily AS (
  SELECT consumption_date, dno_alias, sum(daily_total_consumption) AS t,
         count(DISTINCT secondary_substation_unique_id) AS n
  FROM peak GROUP BY 1, 2
  ORDER BY t DESC NULLS LAST, consumption_date ASC NULLS FIRST, dno_alias ASC NULLS FIRST LIMIT 1
),
shape AS (
  SELECT half_hour_slot AS slot, avg(avg_consumption) AS m FROM profile GROUP BY hour_of_day, minute_of_hour, half_hour_slot
),
shape_hi AS (SELECT slot, m FROM shape ORDER BY m DESC NULLS LAST, slot ASC LIMIT 1),
shape_lo AS (SELECT slot, m FROM shape ORDER BY m ASC NULLS FIRST, slot DESC LIMIT 1),
ww AS (
  SELECT {day_type} AS day_type, half_hour_slot, avg(avg_consumption) AS mean_avg
  FROM profile GROUP BY 1, 2
),
ww_means AS (
  SELECT avg(CASE WHEN day_type = 'weekday' THEN coalesce(mean_avg, 0) END) AS wd,
         avg(CASE WHEN day_type = 'weekend' THEN coalesce(mean_avg, 0) END) AS we
  FROM ww
),
sub_totals AS (
  SELECT secondary_substation_unique_id AS sub, sum(daily_total_consumption) AS total FROM peak GROUP BY 1
),
fleet AS (SELECT sum(daily_total_consumption) AS f FROM peak),
top10 AS (
  SELECT row_number() OVER (ORDER BY total DESC NULLS LAST, sub ASC NULLS FIRST) AS rn,
         total / NULLIF((SELECT f FROM fleet), 0) AS share
  FROM sub_totals
),
conc AS (
  SELECT sum(CASE WHEN rn <= 5 THEN coalesce(share, 0) END) * 100 AS top5,
         sum(CASE WHEN rn <= 10 THEN coalesce(share, 0) END) * 100 AS top10,
         count(*) FILTER (WHERE rn <= 10) AS n
  FROM top10
),
win AS (
  SELECT sum(CASE WHEN hour(peak_timestamp) BETWEEN 17 AND 20 THEN 1 ELSE 0 END) / CAST(count(*) AS DOUBLE) AS ev,
         sum(CASE WHEN hour(peak_timestamp) BETWEEN 0 AND 5 THEN 1 ELSE 0 END) / CAST(count(*) AS DOUBLE) AS ov
  FROM peak
),
vol_d AS (SELECT consumption_date, sum(daily_total_consumption) AS t FROM peak GROUP BY 1),
vol AS (
  SELECT stddev_pop(t) / NULLIF(avg(t), 0) AS cv, stddev_pop(t) AS sd, avg(t) AS mean FROM vol_d
),
ramp_l AS (SELECT {day_type} AS day_type, half_hour_slot, avg_consumption FROM profile),
ramp AS (
  SELECT day_type,
         avg(CASE WHEN half_hour_slot BETWEEN 34 AND 41 THEN avg_consumption END)
           / NULLIF(avg(CASE WHEN half_hour_slot BETWEEN 4 AND 11 THEN avg_consumption END), 0) AS ratio
  FROM ramp_l GROUP BY 1
),
ramp_w AS (
  SELECT max(CASE WHEN day_type = 'weekday' THEN coalesce(ratio, 0) END) AS wd,
         max(CASE WHEN day_type = 'weekend' THEN coalesce(ratio, 0) END) AS we,
         count(*) FILTER (WHERE day_type = 'weekday') AS n_wd,
         count(*) FILTER (WHERE day_type = 'weekend') AS n_we
  FROM ramp
),
skew_s AS (
  SELECT dno_alias, secondary_substation_unique_id, avg(daily_total_consumption) AS mdt FROM peak GROUP BY 1, 2
),
skew AS (
  SELECT dno_alias, avg(mdt) / NULLIF(quantile_disc(mdt, 0.5), 0) AS ratio FROM skew_s GROUP BY 1
  ORDER BY ratio DESC NULLS LAST, dno_alias ASC NULLS FIRST LIMIT 1
),
findings AS (
  SELECT 1 AS finding_order, 'top_substation' AS finding,
         concat_ws(' ', sub, '(' || dno_alias || ')') AS subject,
         coalesce(a, 0) AS value_1, coalesce(m, 0) AS value_2, {v} AS value_3 FROM top
  UNION ALL
  SELECT 2, 'highest_demand_day', concat_ws(' ', CAST(consumption_date AS VARCHAR), '(' || dno_alias || ')'),
         coalesce(t, 0), CAST(n AS DOUBLE), {v} FROM daily
  UNION ALL
  SELECT 3, 'load_shape_peak_trough', {_hhmm("h.slot")} || '/' || {_hhmm("l.slot")},
         coalesce(h.m, 0), coalesce(l.m, 0), {v} FROM shape_hi h, shape_lo l
  UNION ALL
  SELECT 4, 'weekday_weekend_delta', 'weekend vs weekday', wd, we,
         CASE WHEN wd <> 0 THEN (we - wd) / wd * 100 ELSE 0 END FROM ww_means
  WHERE wd IS NOT NULL AND we IS NOT NULL
  UNION ALL
  SELECT 5, 'demand_concentration', 'top 5 / top 10 substations', top5, top10, {v} FROM conc WHERE n > 0
  UNION ALL
  SELECT 6, 'peak_timing', 'evening 17-20 / overnight 0-5', coalesce(ev, 0) * 100, coalesce(ov, 0) * 100, {v}
  FROM win
  UNION ALL
  SELECT 7, 'volatility', 'daily system total', coalesce(cv, 0), coalesce(sd, 0), coalesce(mean, 0) FROM vol
  UNION ALL
  SELECT 8, 'evening_ramp', 'weekday / weekend', wd, we, {v} FROM ramp_w WHERE n_wd > 0 AND n_we > 0
  UNION ALL
  SELECT 9, 'skew_alert', dno_alias, coalesce(ratio, 0), {v}, {v} FROM skew WHERE coalesce(ratio, 0) > 10
)
SELECT CAST(finding_order AS INTEGER) AS finding_order, finding, subject,
       {f32("value_1")}, {f32("value_2")}, {f32("value_3")}{", value_1 AS raw_1, value_2 AS raw_2, value_3 AS raw_3" if raw else ""}
FROM findings"""


def _composites(sql: dict[str, str]) -> dict[str, str]:
    checks = [
        ("qa_freshness", "freshness_status"),
        ("qa_completeness", "completeness_status"),
        ("qa_uniqueness", "uniqueness_status"),
        ("qa_nulls", "null_check_status"),
        ("qa_business_rules", "business_rule_status"),
    ]
    def suite(day: str, variant: str = "clean") -> str:
        built = [f(day, variant) for f in (_qa_freshness, _qa_completeness, _qa_uniqueness, _qa_nulls, _qa_business_rules)]
        return "\nUNION ALL\n".join(
            f"SELECT {i} AS check_order, '{name}' AS check_name, run_date, {col} AS status FROM ({q}) q{i}"
            for i, ((name, col), q) in enumerate(zip(checks, built), start=1)
        )

    def contents(suffix: str) -> str:
        from meterlake.plans.jobs_registry import INSIGHT_COLUMNS

        parts = []
        for i, (name, (texts, numbers)) in enumerate(INSIGHT_COLUMNS.items()):
            item = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in texts)
            values = [f"CAST(CAST({c} AS FLOAT) AS DOUBLE)" for c in numbers] + ["CAST(NULL AS DOUBLE)"] * (3 - len(numbers))
            shown = ", ".join(f"{v} AS value_{k}" for k, v in enumerate(values, start=1))
            parts.append(f"SELECT '{name}' AS insight, {item} AS item, {shown} FROM ({sql[name + suffix]}) q{i}")
        return "\nUNION ALL\n".join(parts)

    return {"qa_suite": suite(RUN_DATE), "qa_suite_dirty": suite(RUN_DATE, "dirty"), "qa_suite_first_day": suite(FIRST_DATE),
            "qa_suite_empty_day": suite(EMPTY_DATE), "run_insights": contents(""), "run_insights_dirty": contents("_dirty"),
            "insight_summary": _summary(),
            "insight_summary_skewed": _summary("skewed"), "insight_text": _text()}
