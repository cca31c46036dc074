"""DuckDB SQL for the queries, written independently of the Spark plans."""

from __future__ import annotations


def r2(x: str) -> str:
    return f"round_even(({x})*100,0)/100"


def exact(x: str) -> str:
    return f"sum(({x})::DECIMAL(28,9))::DOUBLE"


def total2(x: str) -> str:
    """Rounded sum, in exact arithmetic."""
    return r2(exact(x))


def mean(x: str) -> str:
    return f"{exact(x)}/nullif(count({x}),0)"


def mean2(x: str) -> str:
    return r2(mean(x))


def day(x: str) -> str:
    return f"strftime({x},'%Y-%m-%d')"


def week(x: str) -> str:
    number = f"((day({x})-1)//7+1)::VARCHAR"
    return f"'week_'||{number}||'_'||lower(strftime({x},'%B'))||'_'||year({x})::VARCHAR"


def clock(x: str) -> str:
    """What New York's clocks did with a local time of 2024."""
    return f"""CASE WHEN {x} >= TIMESTAMP '2024-03-10 02:00' AND {x} < TIMESTAMP '2024-03-10 03:00'
    THEN 'skipped' WHEN {x} >= TIMESTAMP '2024-11-03 01:00' AND {x} < TIMESTAMP '2024-11-03 02:00'
    THEN 'repeated' ELSE 'regular' END"""


def first_offset(x: str) -> str:
    """New York's distance from UTC, that of summer in the repeated hour."""
    return f"""CASE WHEN {x} >= TIMESTAMP '2024-03-10 03:00'
    AND {x} < TIMESTAMP '2024-11-03 02:00' THEN INTERVAL 4 HOUR ELSE INTERVAL 5 HOUR END"""


EV = """ev AS (
  SELECT event_id AS "VendorID", ts AS pickup_datetime,
    ts + to_minutes(CAST(1 + event_id % 60 AS INTEGER)) AS dropoff_datetime,
    CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 9 = 0 THEN 0::DOUBLE
         WHEN event_id % 11 = 0 THEN 7::DOUBLE
         ELSE (1 + event_id % 2)::DOUBLE END AS passenger_count,
    value / 10::DOUBLE - 0.05::DOUBLE AS trip_distance,
    value * 0.8::DOUBLE AS fare_amount,
    value - 0.5::DOUBLE AS total_amount,
    CASE WHEN event_type IN ('click','error') THEN 'Green' ELSE 'Yellow' END AS taxi_type
  FROM events)"""

LI = """li AS (
  SELECT l_orderkey AS "VendorID", o_orderdate AS pickup_datetime,
    l_shipdate AS dropoff_datetime, l_linenumber::DOUBLE AS passenger_count,
    l_quantity AS trip_distance, l_extendedprice * (1 - l_discount) AS fare_amount,
    l_extendedprice * (1 - l_discount) * (1 + l_tax) AS total_amount,
    l_returnflag AS taxi_type
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

MINUTES = r2(
    "(epoch_us(dropoff_datetime)-epoch_us(pickup_datetime))/1000000::DOUBLE/60::DOUBLE"
)


def cleaned(source: str) -> str:
    """Source CTE plus `t`, its cleaned trips with a duration."""
    base = {"ev": EV, "li": LI}[source]
    return f"""{base}, t AS (
  SELECT *, {MINUTES} AS trip_duration_minutes FROM {source}
  WHERE trip_distance > 0 AND total_amount > 0 AND passenger_count > 0)"""


EV_T, LI_T = cleaned("ev"), cleaned("li")

TRIPS_TABLE = f"""SELECT {day('pickup_datetime')} AS date, taxi_type, count(*) AS total_trips
  FROM t GROUP BY 1, 2"""

REVENUE_TABLE = f"""SELECT {day('pickup_datetime')} AS date, taxi_type,
    {total2('total_amount')} AS total_revenue_per_day
  FROM t GROUP BY 1, 2"""

HOURLY_TABLE = f"""SELECT {day('pickup_datetime')} AS date, taxi_type,
    hour(pickup_datetime)::INTEGER AS pickup_hour, count(*) AS trips_per_hour
  FROM t GROUP BY 1, 2, 3"""

AVERAGES_TABLE = f"""SELECT {day('pickup_datetime')} AS date, taxi_type,
    {mean2('trip_distance')} AS avg_trip_distance,
    {mean2('fare_amount')} AS avg_fare_amount,
    {mean2('total_amount')} AS avg_total_amount,
    {mean2('passenger_count')} AS avg_passenger_count,
    {mean2('trip_duration_minutes')} AS avg_trip_duration_minutes
  FROM t GROUP BY 1, 2"""


def scored(std: str = "1.5", drop: str = "pct_change_trips", by_week: bool = False) -> str:
    """CTEs from `t` to `flagged`, one row per day and type."""
    part = "week_name, taxi_type" if by_week else "taxi_type"

    def change(x: str) -> str:
        previous = f"lag({x}) OVER (PARTITION BY {part} ORDER BY date)"
        pct = r2(f"({x}-{previous})::DOUBLE/{previous}::DOUBLE*100::DOUBLE")
        return f"CASE WHEN {previous} > 0 THEN {pct} END"

    return f"""days AS (
  SELECT {day('pickup_datetime')} AS date, {week('any_value(pickup_datetime)')} AS week_name,
    taxi_type, count(*) AS daily_trips,
    {total2('total_amount')} AS total_revenue_per_day,
    {mean2('passenger_count')} AS avg_passenger_count
  FROM t GROUP BY 1, 3),
stats AS (
  SELECT *, avg(daily_trips) OVER (PARTITION BY {part}) AS avg_trips,
    stddev_samp(daily_trips) OVER (PARTITION BY {part}) AS stddev_trips,
    {change('daily_trips')} AS pct_change_trips,
    {change('total_revenue_per_day')} AS pct_change_revenue
  FROM days),
flagged AS (
  SELECT *, coalesce(daily_trips > avg_trips + {std} * stddev_trips, false)
    OR coalesce(daily_trips < avg_trips - {std} * stddev_trips, false)
    OR coalesce({drop} < -20, false)
    OR coalesce(avg_passenger_count > 2, false) AS is_anomaly
  FROM stats)"""


def anomaly_table(extra: str = "") -> str:
    return f"""SELECT date, taxi_type, daily_trips, total_revenue_per_day, avg_passenger_count,
    round(avg_trips,6) AS avg_trips, round(stddev_trips,6) AS stddev_trips,
    pct_change_trips, {extra} is_anomaly FROM flagged"""


def count_where(cte: str, source: str, where: str) -> str:
    counts = f"SELECT taxi_type, count(*) AS trip_count FROM {source} WHERE {where} GROUP BY 1"
    return f"WITH {cte} {counts}"


STRICT = (
    "fare_amount > 0 AND total_amount > 0 AND trip_distance > 0 "
    "AND passenger_count BETWEEN 1 AND 6 AND pickup_datetime < dropoff_datetime"
)
CLEANED_COLUMNS = '"VendorID", pickup_datetime, passenger_count, trip_distance, taxi_type'
WEEK_OF_DATE = week("date::DATE")

KPIS = f"""WITH {EV_T}, {scored(by_week=True)},
trips_w AS (SELECT week_name, sum(daily_trips)::BIGINT AS total_trips,
    count(DISTINCT date) AS num_days, count_if(is_anomaly)::BIGINT AS anomaly_count
  FROM flagged GROUP BY 1),
by_date AS (SELECT week_name, date, sum(total_revenue_per_day) AS revenue FROM days GROUP BY 1, 2),
money_w AS (SELECT week_name, sum(revenue) AS total_revenue, max(revenue) AS best_day_revenue,
    min(revenue) AS worst_day_revenue FROM by_date GROUP BY 1),
best AS (SELECT week_name, date AS best_day FROM by_date
  QUALIFY row_number() OVER (PARTITION BY week_name ORDER BY revenue DESC, date) = 1),
worst AS (SELECT week_name, date AS worst_day FROM by_date
  QUALIFY row_number() OVER (PARTITION BY week_name ORDER BY revenue, date) = 1),
averages AS ({AVERAGES_TABLE}),
avg_w AS (SELECT {WEEK_OF_DATE} AS week_name, {mean('avg_total_amount')} AS avg_rev_trip
  FROM averages GROUP BY 1),
hours AS (SELECT {week('pickup_datetime')} AS week_name, hour(pickup_datetime) AS h, count(*) AS n
  FROM t GROUP BY 1, 2),
busy AS (SELECT week_name, string_agg(h::VARCHAR || ':00', ', ' ORDER BY n DESC, h) AS busiest_hours
  FROM (SELECT * FROM hours
        QUALIFY row_number() OVER (PARTITION BY week_name ORDER BY n DESC, h) <= 3) GROUP BY 1)
SELECT week_name,
  'Week ' || split_part(week_name,'_',2) || ', ' || upper(split_part(week_name,'_',3)[1])
    || split_part(week_name,'_',3)[2:] || ' ' || split_part(week_name,'_',4) AS week_title,
  total_trips, round(total_revenue,6) AS total_revenue, num_days,
  round(total_trips/num_days::DOUBLE,6) AS daily_avg_trips,
  round(total_revenue/num_days,6) AS daily_avg_revenue,
  round(avg_rev_trip,6) AS avg_rev_trip, anomaly_count,
  best_day, round(best_day_revenue,6) AS best_day_revenue,
  worst_day, round(worst_day_revenue,6) AS worst_day_revenue, busiest_hours
FROM trips_w JOIN money_w USING (week_name) JOIN best USING (week_name)
  JOIN worst USING (week_name) JOIN avg_w USING (week_name) JOIN busy USING (week_name)"""

WEEK_TOTALS = f"""{EV_T}, days AS ({REVENUE_TABLE}), n AS ({TRIPS_TABLE}),
w AS (SELECT {WEEK_OF_DATE} AS week_name, sum(total_trips)::BIGINT AS total_trips,
    sum(total_revenue_per_day) AS total_revenue, count(DISTINCT date) AS num_days
  FROM n JOIN days USING (date, taxi_type) GROUP BY 1)"""

CLEANING = f"""WITH {EV}, c AS (SELECT count(*) AS initial_rows,
    count(*) FILTER (trip_distance > 0 AND total_amount > 0 AND passenger_count > 0) AS final_rows
  FROM ev)
SELECT initial_rows, final_rows, initial_rows - final_rows AS removed_rows,
  round((initial_rows - final_rows)/initial_rows::DOUBLE*100,6) AS removed_pct FROM c"""

SUMMARY_FIELDS = f"""count(*) AS total_trips, {total2('total_amount')} AS total_revenue,
    {mean2('trip_distance')} AS avg_trip_distance, {mean2('fare_amount')} AS avg_fare_amount"""


def executive(cte: str) -> str:
    return f"""WITH {cte} SELECT taxi_type, {SUMMARY_FIELDS} FROM t GROUP BY taxi_type
UNION ALL SELECT 'Total', {SUMMARY_FIELDS} FROM t"""


def preview(prefix: str, taxi_type: str) -> str:
    return f"""WITH {EV} SELECT "VendorID", pickup_datetime AS {prefix}_pickup_datetime,
  dropoff_datetime AS {prefix}_dropoff_datetime, passenger_count, trip_distance, fare_amount,
  total_amount FROM ev WHERE taxi_type = '{taxi_type}'
ORDER BY pickup_datetime, "VendorID" LIMIT 5"""


EV_COLUMNS = (
    "VendorID",
    "pickup_datetime",
    "dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "total_amount",
    "taxi_type",
)

SPARK_TYPES = """CASE k WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double'
  WHEN 'VARCHAR' THEN 'string' ELSE 'timestamp_ntz' END"""

NULLS = "\nUNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) FILTER ("{c}" IS NULL) AS null_count FROM ev"""
    for c in EV_COLUMNS
)

SCHEMA = "\nUNION ALL ".join(
    f"""SELECT {i}::INTEGER AS position, '{c}' AS column_name, any_value(typeof("{c}")) AS k,
  count(*) AS total_rows FROM ev"""
    for i, c in enumerate(EV_COLUMNS)
)

NUMERIC = "\nUNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS value_count, round(avg({c}),6) AS mean,
  round(stddev_samp({c}),6) AS stddev, round(min({c}),6) AS min,
  round(quantile_disc({c}, 0.25),6) AS q25, round(quantile_disc({c}, 0.5),6) AS q50,
  round(quantile_disc({c}, 0.75),6) AS q75, round(max({c}),6) AS max FROM t"""
    for c in (*EV_COLUMNS[3:7], "trip_duration_minutes")
)

NO_TIME = "(pickup_datetime IS NULL OR dropoff_datetime IS NULL)"
MIDDLE = f"""trip_distance > 0 AND fare_amount > 0 AND total_amount > 0 AND passenger_count > 0
  AND {MINUTES} > 0 AND NOT {NO_TIME}"""

REASONS = "\nUNION ALL ".join(
    f"""SELECT '{name}' AS metric, count(*) FILTER ({test}) AS before,
  count(*) FILTER (({test}) AND ok) AS after,
  count(*) FILTER ({test}) - count(*) FILTER (({test}) AND ok) AS removed FROM m"""
    for name, test in (
        ("total_records", "true"),
        ("invalid_distance", "NOT coalesce(trip_distance > 0, false)"),
        ("invalid_fare", "NOT coalesce(fare_amount > 0, false)"),
        ("null_timestamps", NO_TIME),
    )
)

HEATMAP = ",\n  ".join(
    f"nullif(count(*) FILTER (hour(pickup_datetime) = {h}), 0) AS h{h:02d}" for h in range(24)
)

RANGE_STATUS = f"""{EV}, wanted AS (SELECT unnest(generate_series(DATE '2024-01-28',
    DATE '2024-02-06', INTERVAL 1 DAY))::DATE AS d),
n AS (SELECT pickup_datetime::DATE AS d, count(*) AS trips FROM ev GROUP BY 1),
s AS (SELECT {day('d')} AS date, coalesce(trips, 0) AS trips,
    CASE WHEN trips > 0 THEN 'processed' ELSE 'skipped' END AS status
  FROM wanted LEFT JOIN n USING (d))"""

LI_WEEKS = f"{LI}, w AS (SELECT DISTINCT {week('pickup_datetime')} AS week_name FROM li)"
WEEK_PATTERN = r"^week_(\d+)_(\w+)_(\d{4})"
MONTH_NUMBER = "month(strptime(split_part(week_name,'_',3) || ' 2000', '%B %Y'))"

DAY_RATIOS = f"""{EV_T}, a AS ({AVERAGES_TABLE}), m AS (SELECT taxi_type,
    {mean('avg_trip_distance')} AS dist, {mean('avg_fare_amount')} AS fare,
    {mean('avg_total_amount')} AS total, {mean('avg_trip_duration_minutes')} AS minutes
  FROM a GROUP BY 1)"""

WINDOWS = f"""WITH {EV}, w AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, pickup_datetime, TIMESTAMP '2000-01-01') AS window_start,
    taxi_type, count(*) AS trips, {total2('total_amount')} AS revenue FROM ev GROUP BY 1, 2)
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, taxi_type, trips, revenue
FROM w"""

ORACLE: dict[str, str] = {
    "trips_per_day": f"WITH {EV_T} {TRIPS_TABLE}",
    "trips_per_day_lines": f"WITH {LI_T} {TRIPS_TABLE}",
    "revenue_per_day": f"WITH {EV_T} {REVENUE_TABLE}",
    "revenue_per_day_lines": f"WITH {LI_T} {REVENUE_TABLE}",
    "hourly_trips": f"WITH {EV_T} {HOURLY_TABLE}",
    "hourly_trips_lines": f"WITH {LI_T} {HOURLY_TABLE}",
    "daily_avg_metrics": f"WITH {EV_T} {AVERAGES_TABLE}",
    "daily_avg_metrics_lines": f"WITH {LI_T} {AVERAGES_TABLE}",
    "anomaly_monitoring": f"WITH {EV_T}, {scored()} {anomaly_table()}",
    "anomaly_kept_current": f"WITH {EV_T}, {scored()} {anomaly_table()}",
    "anomaly_monitoring_lines": f"WITH {LI_T}, {scored()} {anomaly_table()}",
    "anomaly_by_week": f"WITH {EV_T}, {scored(by_week=True)} {anomaly_table()}",
    "anomaly_doc_variant": f"""WITH {EV_T}, {scored('2', 'pct_change_revenue')}
{anomaly_table('pct_change_revenue,')}""",
    "anomaly_details": f"""WITH {EV_T}, {scored('2', 'pct_change_revenue')},
shares AS (SELECT taxi_type, {r2('count_if(is_anomaly)/count(*)::DOUBLE*100')} AS anomaly_share_pct
  FROM flagged GROUP BY 1)
SELECT date, taxi_type, daily_trips, pct_change_trips, total_revenue_per_day,
  pct_change_revenue, anomaly_share_pct
FROM flagged JOIN shares USING (taxi_type) WHERE is_anomaly""",
    "peak_hour_per_day": f"""WITH {EV_T}, h AS ({HOURLY_TABLE})
SELECT date, taxi_type, pickup_hour AS peak_hour, trips_per_hour AS peak_trips FROM h
QUALIFY row_number() OVER (PARTITION BY date, taxi_type
  ORDER BY trips_per_hour DESC, pickup_hour) = 1""",
    "hour_heatmap": f"""WITH {EV_T} SELECT {day('pickup_datetime')} AS date,
  {HEATMAP} FROM t GROUP BY 1""",
    "enabled_metrics": f"""WITH {EV_T}, a AS ({TRIPS_TABLE}), b AS ({REVENUE_TABLE})
SELECT 'Trips Per Day' AS metric, date, taxi_type, total_trips::DOUBLE AS amount FROM a
UNION ALL SELECT 'Revenue Per Day', date, taxi_type, total_revenue_per_day FROM b""",
    "metric_preview": f"WITH {EV_T} {TRIPS_TABLE} ORDER BY date, taxi_type LIMIT 10",
    "cleaned_trips": f"WITH {EV_T} SELECT * FROM t",
    "cleaned_trips_strict": count_where(LI, "li", STRICT),
    "cleaned_trips_middle": count_where(LI, "li", MIDDLE),
    "cleaning_metrics": CLEANING,
    "cleaning_from_job": CLEANING,
    "cleaning_by_week": f"""WITH {EV}, c AS (SELECT {week('pickup_datetime')} AS week_name,
    count(*) AS initial_rows,
    count(*) FILTER (trip_distance > 0 AND total_amount > 0 AND passenger_count > 0) AS final_rows
  FROM ev GROUP BY 1)
SELECT week_name, initial_rows, final_rows, initial_rows - final_rows AS removed_rows,
  round((initial_rows - final_rows)/initial_rows::DOUBLE*100,6) AS removed_pct FROM c""",
    "invalid_by_reason": f"""WITH {EV}, m AS (SELECT *, coalesce({MIDDLE}, false) AS ok FROM ev)
{REASONS}""",
    "trip_durations": f"""WITH {LI} SELECT "VendorID", passenger_count,
  {MINUTES} AS trip_duration_minutes FROM li""",
    "null_counts": f"WITH {EV} {NULLS}",
    "numeric_summary": f"WITH {EV_T} {NUMERIC}",
    "pickup_range": f"""WITH {EV} SELECT min(pickup_datetime) AS first_pickup,
  max(pickup_datetime) AS last_pickup FROM ev""",
    "schema_listing": f"""WITH {EV}, s AS ({SCHEMA}) SELECT position, column_name,
  {SPARK_TYPES} AS data_type, total_rows, 8::INTEGER AS total_columns FROM s""",
    "preview_green": preview("lpep", "Green"),
    "preview_yellow": preview("tpep", "Yellow"),
    "summary_sample": f"""WITH {EV} SELECT taxi_type, pickup_datetime, trip_distance, fare_amount,
  total_amount FROM ev ORDER BY pickup_datetime, total_amount LIMIT 3""",
    "normalized_union": f"""WITH {EV} SELECT "VendorID", dropoff_datetime, fare_amount,
  passenger_count, pickup_datetime, taxi_type, total_amount, trip_distance FROM ev""",
    "pickup_only_union": f"""WITH {EV} SELECT "VendorID", fare_amount, passenger_count,
  pickup_datetime, lower(taxi_type) AS taxi_type, total_amount, trip_distance FROM ev""",
    "multi_city_union": f"""WITH {EV}, z AS (SELECT
    CASE taxi_type WHEN 'Green' THEN 'east' ELSE 'west' END AS taxi_type,
    pickup_datetime + CASE taxi_type WHEN 'Green' THEN INTERVAL 5 HOUR ELSE INTERVAL 6 HOUR END AS p
  FROM ev)
SELECT {day('p')} AS date, taxi_type, count(*) AS trips FROM z GROUP BY 1, 2""",
    "clock_changes": f"""WITH {EV}, g AS (
  SELECT pickup_datetime + to_days(d) AS p, dropoff_datetime + to_days(d) AS q
  FROM ev, (VALUES (60), (298)) AS moved(d) WHERE taxi_type = 'Green'),
k AS (SELECT p, q, {clock('p')} AS pickup_clock, {clock('q')} AS dropoff_clock FROM g),
u AS (SELECT *, p + {first_offset('p')} AS pickup, q + {first_offset('q')} AS early FROM k),
t AS (SELECT *, CASE WHEN early < pickup AND dropoff_clock = 'repeated'
  AND early + INTERVAL 1 HOUR >= pickup THEN early + INTERVAL 1 HOUR ELSE early END AS dropoff
  FROM u)
SELECT {day('pickup')} AS date, pickup_clock, dropoff_clock, count(*) AS trips,
  min(pickup) AS first_pickup, max(dropoff) AS last_dropoff FROM t GROUP BY 1, 2, 3""",
    "schema_versions": f"""WITH {EV} SELECT {day('pickup_datetime')} AS date, count(*) AS trips,
  count(*) FILTER (pickup_datetime >= TIMESTAMP '2024-01-16') AS with_surcharge
FROM ev GROUP BY 1""",
    "trips_on_date": f"""WITH {EV} SELECT * FROM ev
WHERE pickup_datetime::DATE = DATE '2024-01-10'""",
    "sample_of_date": f"""WITH {EV} SELECT * FROM ev WHERE pickup_datetime::DATE = DATE '2024-01-10'
ORDER BY pickup_datetime, "VendorID" LIMIT 10""",
    "iso_week_trips": f"""WITH {EV} SELECT * FROM ev
WHERE isoyear(pickup_datetime) = 2024 AND weekofyear(pickup_datetime) = 2""",
    "date_range_status": f"WITH {RANGE_STATUS} SELECT * FROM s",
    "date_range_totals": f"""WITH {RANGE_STATUS} SELECT count(*) AS days_requested,
  count(*) FILTER (status = 'processed') AS days_processed,
  count(*) FILTER (status = 'skipped') AS days_skipped FROM s""",
    "week_assignment": f"""WITH {EV} SELECT {day('d')} AS date,
  ((day(d)-1)//7+1)::INTEGER AS week_of_month, {week('d')} AS week_name, trips
FROM (SELECT pickup_datetime::DATE AS d, count(*) AS trips FROM ev GROUP BY 1)""",
    "week_list": f"WITH {LI_WEEKS} SELECT week_name FROM w",
    "week_file_prefixes": f"""WITH {LI_WEEKS} SELECT week_name,
  regexp_extract(week_name, '{WEEK_PATTERN}', 3) || '_'
    || lpad({MONTH_NUMBER}::VARCHAR, 2, '0') || '_week'
    || regexp_extract(week_name, '{WEEK_PATTERN}', 1) AS file_prefix FROM w""",
    "week_name_parts": f"""WITH {LI_WEEKS} SELECT week_name,
  split_part(week_name,'_',2) AS week_num,
  upper(split_part(week_name,'_',3)[1]) || split_part(week_name,'_',3)[2:] AS month,
  split_part(week_name,'_',4) AS year FROM w""",
    "week_over_week": f"""WITH {EV} SELECT {week('pickup_datetime')} AS week_name,
  count(*) AS total_trips FROM ev GROUP BY 1""",
    "compare_weeks": f"""WITH {EV}
SELECT 'Week 1' AS week, count(*) AS total_trips FROM ev
  WHERE {week('pickup_datetime')} = 'week_1_january_2024'
UNION ALL SELECT 'Week 2', count(*) FROM ev
  WHERE {week('pickup_datetime')} = 'week_2_january_2024'""",
    "row_count": f"WITH {EV} SELECT count(*) AS rows FROM ev",
    "count_by_type": f"WITH {EV} SELECT taxi_type, count(*) AS trip_count FROM ev GROUP BY 1",
    "count_by_day": f"""WITH {EV} SELECT {day('pickup_datetime')} AS date, count(*) AS trips
FROM ev GROUP BY 1""",
    "count_by_day_and_type": f"""WITH {EV} SELECT {day('pickup_datetime')} AS date, taxi_type,
  count(*) AS trips FROM ev GROUP BY 1, 2""",
    "weekly_by_type": f"""WITH {EV_T}, w AS (
  SELECT {week('pickup_datetime')} AS week_name, taxi_type, count(*) AS n, sum(total_amount) AS s
  FROM t GROUP BY 1, 2)
SELECT week_name, taxi_type, n AS total_trips, {r2('s')} AS total_revenue,
  {r2('s/n')} AS avg_revenue_per_trip,
  {r2('n/(sum(n) OVER (PARTITION BY week_name))::DOUBLE*100')} AS share_pct FROM w""",
    "type_ratios": f"""WITH {DAY_RATIOS} SELECT taxi_type, {r2('dist')} AS avg_trip_distance,
  {r2('fare')} AS avg_fare_amount, {r2('total')} AS avg_total_amount,
  {r2('dist/nullif(minutes/60,0)')} AS speed_mph, {r2('fare/nullif(dist,0)')} AS fare_per_mile,
  {r2('(total/nullif(fare,0)-1)*100')} AS markup_pct FROM m""",
    "weekday_weekend": f"""WITH {EV_T}, d AS (SELECT pickup_datetime::DATE AS d, count(*) AS n,
    {total2('total_amount')} AS revenue FROM t GROUP BY 1)
SELECT CASE WHEN isodow(d) >= 6 THEN 'weekend' ELSE 'weekday' END AS day_kind,
  count(*) AS num_days, {mean2('n')} AS avg_daily_trips, {mean2('revenue')} AS avg_daily_revenue
FROM d GROUP BY 1""",
    "executive_summary": executive(EV_T),
    "executive_summary_lines": executive(LI_T),
    "weekly_totals": f"""WITH {WEEK_TOTALS} SELECT week_name, total_trips,
  round(total_revenue,6) AS total_revenue, num_days,
  round(total_trips/num_days::DOUBLE,6) AS daily_avg_trips,
  round(total_revenue/num_days,6) AS daily_avg_revenue FROM w""",
    "report_from_old_csv": f"""WITH {WEEK_TOTALS} SELECT week_name, total_trips,
  round(total_revenue,6) AS total_revenue, num_days,
  round(total_trips/num_days::DOUBLE,6) AS daily_avg_trips,
  round(total_revenue/num_days,6) AS daily_avg_revenue FROM w""",
    "weekly_kpis": KPIS,
    "report_totals_text": f"""WITH {WEEK_TOTALS} SELECT week_name,
  format('{{:,}}', total_trips) AS total_trips,
  '$' || format('{{:,.2f}}', round(total_revenue,6)) AS total_revenue,
  format('{{:,}}', trunc(total_trips/num_days::DOUBLE)::BIGINT) AS daily_avg_trips FROM w""",
    "daily_breakdown": f"""WITH {EV_T}, n AS ({TRIPS_TABLE}),
a AS (SELECT date, sum(total_trips)::BIGINT AS trips FROM n GROUP BY 1),
r AS ({REVENUE_TABLE}),
b AS (SELECT date, sum(total_revenue_per_day) AS revenue FROM r GROUP BY 1)
SELECT date, trips, round(coalesce(revenue, 0),6) AS revenue FROM a LEFT JOIN b USING (date)""",
    "trips_by_hour": f"""WITH {EV_T} SELECT hour(pickup_datetime)::INTEGER AS pickup_hour,
  count(*) AS trips FROM t GROUP BY 1""",
    "top_hours": f"""WITH {EV_T} SELECT hour(pickup_datetime)::INTEGER AS pickup_hour,
  count(*) AS trips FROM t GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3""",
    "ranked_hours": f"""WITH {EV_T}, h AS (SELECT {week('pickup_datetime')} AS week_name,
    hour(pickup_datetime)::INTEGER AS pickup_hour, count(*) AS trips FROM t GROUP BY 1, 2)
SELECT week_name, (row_number() OVER (PARTITION BY week_name
  ORDER BY trips DESC, pickup_hour))::INTEGER AS rank, pickup_hour, trips
FROM h QUALIFY rank <= 5""",
    "best_worst_day": f"""WITH {EV_T}, r AS ({REVENUE_TABLE}),
d AS (SELECT date, {WEEK_OF_DATE} AS week_name, sum(total_revenue_per_day) AS revenue
  FROM r GROUP BY 1, 2)
SELECT week_name, first(date ORDER BY revenue DESC, date) AS best_day,
  round(max(revenue),6) AS best_day_revenue,
  first(date ORDER BY revenue, date) AS worst_day,
  round(min(revenue),6) AS worst_day_revenue FROM d GROUP BY 1""",
    "anomaly_count": f"""WITH {EV_T}, {scored(by_week=True)}
SELECT week_name, count(*) FILTER (is_anomaly) AS anomaly_count FROM flagged GROUP BY 1""",
    "weekly_alerts": f"""WITH {EV_T}, {scored(by_week=True)},
q AS (SELECT {week('pickup_datetime')} AS week_name,
    100 - count(*) FILTER (NOT coalesce(trip_distance > 0 AND total_amount > 0
      AND passenger_count > 0, false))/count(*)::DOUBLE*100 AS valid_pct FROM ev GROUP BY 1),
a AS (SELECT week_name, count(*) FILTER (is_anomaly) AS anomaly_count FROM flagged GROUP BY 1)
SELECT week_name, round(valid_pct,6) AS valid_pct, coalesce(anomaly_count,0) AS anomaly_count,
  valid_pct < 95 AS quality_alert, coalesce(anomaly_count,0) > 3 AS anomaly_alert
FROM q LEFT JOIN a USING (week_name)""",
    "daily_store_roundtrip": f"""WITH {EV} SELECT {day('pickup_datetime')} AS date,
  count(*) AS trips, count(passenger_count) AS passengers_known FROM ev GROUP BY 1""",
    "raw_days_roundtrip": f"""WITH {EV}, s AS (
  SELECT min(pickup_datetime)::DATE AS first, max(pickup_datetime)::DATE AS last FROM ev)
SELECT {day('pickup_datetime')} AS date, taxi_type, count(*) AS trips,
  count(passenger_count) AS n_passenger_count,
  count(*) FILTER (pickup_datetime::DATE - first >= (last - first + 1) // 2)
    AS n_congestion_surcharge,
  sum("VendorID")::BIGINT AS vendor_sum
FROM ev, s GROUP BY 1, 2""",
    "raw_unknown_versions": f"""WITH {EV}
SELECT {day('pickup_datetime')} AS date, taxi_type, count(*) AS trips,
  count(passenger_count) AS n_passenger_count,
  count(*) FILTER ("VendorID" % 3 = 1) AS n_tip_amount, sum("VendorID")::BIGINT AS vendor_sum
FROM ev GROUP BY 1, 2""",
    "weekly_job_reports": KPIS,
    "anomaly_other_thresholds": f"""WITH {EV}, t AS (SELECT * FROM ev
  WHERE trip_distance > 5 AND total_amount > 20 AND passenger_count > 1),
{scored(std='1.0')} {anomaly_table()}""",
    "strict_trips": f"""WITH {LI} SELECT {CLEANED_COLUMNS} FROM li WHERE {STRICT}""",
    "middle_trips": f"""WITH {LI} SELECT {CLEANED_COLUMNS} FROM li WHERE {MIDDLE}""",
    "stored_day_weeks": f"""WITH {EV} SELECT DISTINCT {day('pickup_datetime')} AS date,
  {week('pickup_datetime')} AS week_name FROM ev""",
    "first_stored_week": f"""WITH {EV}, f AS (SELECT min(pickup_datetime) AS p FROM ev)
SELECT {week('p')} AS week_name FROM f""",
    "weekly_store_roundtrip": f"""WITH {EV} SELECT {week('pickup_datetime')} AS week_name,
  count(*) AS trips FROM ev GROUP BY 1""",
    "weeks_kept_current": f"""WITH {EV} SELECT {week('pickup_datetime')} AS week_name,
  count(*) AS trips, min("VendorID") AS first_vendor FROM ev
WHERE pickup_datetime::DATE <> DATE '2024-01-20'
  AND NOT (pickup_datetime::DATE = DATE '2024-01-03' AND "VendorID" % 2 <> 0) GROUP BY 1""",
    "week_table_roundtrip": f"""WITH {EV} SELECT {week('pickup_datetime')} AS week_name, taxi_type,
  count(*) AS trips FROM ev GROUP BY 1, 2""",
    "csv_roundtrip": f"""WITH {EV_T}, {scored(by_week=True)}, f AS ({anomaly_table()})
SELECT *, {WEEK_OF_DATE} AS week_name FROM f""",
    "report_from_csv": KPIS,
    "stream_window_counts": WINDOWS,
    "json_window_counts": WINDOWS,
    "json_lines_set_apart": """WITH c AS (SELECT
    count(*) FILTER (event_id % 50 = 0) + count(*) FILTER (event_id % 70 = 0) AS broken,
    count(*) FILTER (event_id % 90 = 0) AS incomplete FROM events)
SELECT 'broken' AS problem, broken AS lines FROM c WHERE broken > 0
UNION ALL SELECT 'incomplete', incomplete FROM c WHERE incomplete > 0""",
}
