"""DuckDB SQL for every registered query: the independent correctness oracle.

The SQL repeats, as CTEs, the events -> raw trips derivation and the cleaning
rules, written directly from their definitions (plain ``LEAD`` window,
``row_number`` de-duplication, sequential filters), then states each query
the way an analyst would. Computed columns carry the same names and types as
the Spark results. Nothing here is executed by the library itself.
"""

from __future__ import annotations

# Same parameters as the registered Spark queries (test-scale thresholds).
MIN_ACTIVITY = 150
COMMUTER_MIN_MEMBER_PCT = 66.0

_DAYPART = """CASE WHEN hour({ts}) BETWEEN 6 AND 9 THEN 'Morning Peak (6-9)'
         WHEN hour({ts}) BETWEEN 10 AND 15 THEN 'Midday (10-15)'
         WHEN hour({ts}) BETWEEN 16 AND 19 THEN 'Evening Peak (16-19)'
         WHEN hour({ts}) BETWEEN 20 AND 23 THEN 'Evening (20-23)'
         ELSE 'Overnight (0-5)' END"""



def _half_up(num: str, den: str, scale: int) -> str:
    """num / den of whole numbers, half away from zero to ``scale`` digits, in integers."""
    p = 10**scale
    return (f"CAST(sign({num}) * ((2 * {p} * abs({num}) + NULLIF({den}, 0)) // (2 * NULLIF({den}, 0))) AS DOUBLE) / CAST({p} AS DOUBLE)")


_AVG_MIN = _half_up("SUM(CAST(ROUND(trip_duration_min * 60) AS BIGINT))", "(60 * COUNT(trip_duration_min))", 2)
_AVG_KM = _half_up("SUM(CAST(ROUND(trip_distance_km * 1000) AS BIGINT))", "(1000 * COUNT(trip_distance_km))", 2)


def _pct(part: str, whole: str, scale: int) -> str:
    return _half_up(f"(100 * ({part}))", whole, scale)


PREFIX = f"""
WITH ev AS (
  SELECT event_id, ts, user_id, event_type,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
),
seq AS (
  SELECT *,
         LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id NULLS FIRST) AS ts2,
         LEAD(k) OVER (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id NULLS FIRST) AS k2,
         to_days(CAST((user_id * 2) % 360 AS INTEGER)) AS shift
  FROM ev
),
copied AS (
  SELECT *, UNNEST(CASE WHEN event_id % 50 = 0 THEN [0, 1] ELSE [0] END) AS copy_no,
    (k * k + 40 * (event_id % 3)) // 97 AS s0, (k2 * k2 + 40 * (event_id % 3)) // 97 AS e0
  FROM seq
),
placed AS (
  SELECT *, CASE WHEN s0 IN (88, 89) THEN s0 - 50 ELSE s0 END AS s, CASE WHEN e0 >= 90 THEN e0 - 60 ELSE e0 END AS e
  FROM copied
),
raw AS (
  SELECT
    CAST(event_id AS VARCHAR) AS ride_id,
    CASE WHEN event_type IN ('click', 'view') THEN ' Classic_Bike'
         WHEN event_type = 'signup' THEN 'electric_scooter'
         ELSE 'electric_bike ' END AS rideable_type,
    CAST(CASE WHEN copy_no = 1 AND event_id % 100 <> 0 THEN ts + shift - INTERVAL 30 SECOND ELSE ts + shift END AS VARCHAR) AS started_at,
    CAST(ts2 + shift AS VARCHAR) AS ended_at,
    CASE WHEN k >= 97 THEN NULL ELSE 'Station ' || CAST(s AS VARCHAR) END AS start_station_name,
    CAST(NULL AS VARCHAR) AS start_station_id,
    CASE WHEN k2 >= 97 THEN NULL ELSE 'Station ' || CAST(e AS VARCHAR) END AS end_station_name,
    CAST(NULL AS VARCHAR) AS end_station_id,
    CASE WHEN event_id % 211 = 0 THEN CAST('NaN' AS DOUBLE)
         WHEN k = 0 THEN CAST(0.0 AS DOUBLE)
         ELSE CAST(41.65 AS DOUBLE) + CAST(0.004 AS DOUBLE) * s
              + CAST(0.000137 AS DOUBLE) * (event_id % 97)
              - CASE WHEN copy_no = 1 AND event_id % 100 = 0 THEN CAST(0.001 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END END AS start_lat,
    CAST(-87.90 AS DOUBLE) + CAST(0.003 AS DOUBLE) * ((s * 7) % 97) AS start_lng,
    CASE WHEN copy_no = 1 AND event_id % 150 = 0 THEN CAST('NaN' AS DOUBLE)
         ELSE CAST(41.65 AS DOUBLE) + CAST(0.004 AS DOUBLE) * e END AS end_lat,
    CAST(-87.90 AS DOUBLE) + CAST(0.003 AS DOUBLE) * ((e * 7) % 97) AS end_lng,
    CASE WHEN user_id % 3 = 0 THEN 'casual ' ELSE 'Member' END AS member_casual
  FROM placed
),
parsed AS (
  SELECT * REPLACE (
      try_strptime(substr(started_at, 1, 19), '%Y-%m-%d %H:%M:%S') AS started_at,
      try_strptime(substr(ended_at, 1, 19), '%Y-%m-%d %H:%M:%S') AS ended_at)
  FROM raw
),
timed AS (
  SELECT *, CAST(date_diff('second', started_at, ended_at) AS DOUBLE) / 60.0 AS trip_duration_min
  FROM parsed
),
present AS (
  SELECT * FROM timed
  WHERE ride_id IS NOT NULL AND started_at IS NOT NULL AND ended_at IS NOT NULL
    AND start_station_name IS NOT NULL AND end_station_name IS NOT NULL
    AND start_lat IS NOT NULL AND start_lng IS NOT NULL
    AND end_lat IS NOT NULL AND end_lng IS NOT NULL
    AND NOT isnan(start_lat) AND NOT isnan(start_lng) AND NOT isnan(end_lat) AND NOT isnan(end_lng)
    AND member_casual IS NOT NULL AND rideable_type IS NOT NULL
),
uniq AS (
  SELECT * FROM present
  QUALIFY row_number() OVER (PARTITION BY ride_id ORDER BY started_at, ended_at, start_lat, start_lng, end_lat, end_lng) = 1
),
kept AS (
  SELECT * FROM uniq
  WHERE trip_duration_min > 1 AND trip_duration_min < 1440
    AND start_lat BETWEEN 41.60 AND 42.10 AND end_lat BETWEEN 41.60 AND 42.10
    AND start_lng BETWEEN -87.95 AND -87.50 AND end_lng BETWEEN -87.95 AND -87.50
),
trips AS (
  SELECT
    ride_id,
    lower(trim(rideable_type)) AS rideable_type,
    started_at,
    ended_at,
    trim(start_station_name) AS start_station_name,
    start_station_id,
    trim(end_station_name) AS end_station_name,
    end_station_id,
    start_lat, start_lng, end_lat, end_lng,
    lower(trim(member_casual)) AS member_casual,
    trip_duration_min,
    CAST(started_at AS DATE) AS trip_date,
    strftime(started_at, '%Y-%m') AS trip_month,
    CAST(year(started_at) AS INTEGER) AS trip_year,
    CAST(hour(started_at) AS INTEGER) AS hour,
    dayname(started_at) AS day_of_week,
    dayofweek(started_at) IN (0, 6) AS is_weekend,
    CASE WHEN month(started_at) IN (12, 1, 2) THEN 'Winter'
         WHEN month(started_at) IN (3, 4, 5) THEN 'Spring'
         WHEN month(started_at) IN (6, 7, 8) THEN 'Summer'
         ELSE 'Fall' END AS season,
    {_DAYPART.format(ts="started_at")} AS time_of_day,
    round(CAST(12742.0 AS DOUBLE) * asin(sqrt(
        pow(sin(radians(end_lat - start_lat) / 2), 2)
        + cos(radians(start_lat)) * cos(radians(end_lat)) * pow(sin(radians(end_lng - start_lng) / 2), 2)
    )), 3) AS trip_distance_km,
    concat_ws(' -> ', trim(start_station_name), trim(end_station_name)) AS route,
    trim(start_station_name) = trim(end_station_name) AS is_round_trip
  FROM kept
),
endpoints AS (
  SELECT start_station_name AS station, 1 AS is_departure FROM trips
  UNION ALL
  SELECT end_station_name AS station, 0 AS is_departure FROM trips
),
flow AS (
  SELECT station,
    CAST(COUNT(*) FILTER (WHERE is_departure = 1) AS BIGINT) AS departures,
    CAST(COUNT(*) FILTER (WHERE is_departure = 0) AS BIGINT) AS arrivals
  FROM endpoints GROUP BY station
),
imbalance AS (
  SELECT station, departures, arrivals,
    departures - arrivals AS net_outflow,
    {_pct('departures - arrivals', '(departures + arrivals)', 1)} AS net_outflow_pct
  FROM flow
  WHERE departures + arrivals >= {MIN_ACTIVITY}
),
monthly AS (
  SELECT trip_month, COUNT(*) AS trips,
    COUNT(*) FILTER (WHERE member_casual = 'member') AS member_trips,
    COUNT(*) FILTER (WHERE member_casual = 'casual') AS casual_trips,
    {_AVG_MIN} AS avg_duration_min
  FROM trips GROUP BY trip_month
),
hourly AS (
  SELECT hour,
    COUNT(*) FILTER (WHERE NOT is_weekend) AS weekday_trips,
    COUNT(*) FILTER (WHERE is_weekend) AS weekend_trips,
    COUNT(*) AS total_trips
  FROM trips GROUP BY hour
),
seasonal AS (
  SELECT season, COUNT(*) AS trips,
    {_AVG_MIN} AS avg_duration_min,
    {_AVG_KM} AS avg_distance_km,
    {_pct("COUNT(*) FILTER (WHERE member_casual = 'casual')", 'COUNT(*)', 1)} AS casual_pct
  FROM trips GROUP BY season
),
segments AS (
  SELECT member_casual, COUNT(*) AS trips,
    {_pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()', 2)} AS pct_share,
    {_AVG_MIN} AS avg_duration_min,
    ROUND(quantile_disc(trip_duration_min, 0.5), 2) AS median_duration_min,
    {_AVG_KM} AS avg_distance_km,
    {_pct('COUNT(*) FILTER (WHERE is_round_trip)', 'COUNT(*)', 2)} AS round_trip_pct
  FROM trips GROUP BY member_casual
),
routes AS (
  SELECT route, start_station_name, end_station_name, COUNT(*) AS trips,
    {_AVG_MIN} AS avg_duration_min,
    {_AVG_KM} AS avg_distance_km,
    {_pct("COUNT(*) FILTER (WHERE member_casual = 'member')", 'COUNT(*)', 1)} AS member_pct
  FROM trips GROUP BY route, start_station_name, end_station_name
)
"""

_TOP_STATIONS = """
SELECT station, departures, arrivals, departures + arrivals AS total_activity
FROM flow ORDER BY total_activity DESC, station LIMIT {k}
"""

_DRAINING = f"""
SELECT station, departures - arrivals AS net_outflow
FROM flow
WHERE departures > 0 AND arrivals > 0 AND departures + arrivals >= {MIN_ACTIVITY}
ORDER BY net_outflow DESC, station
LIMIT 5
"""

_IMBALANCE = "SELECT * FROM imbalance ORDER BY net_outflow DESC, station"

QUERIES: dict[str, str] = {
    "monthly_volume": "SELECT * FROM monthly ORDER BY trip_month",
    "usage_by_bike_type": f"""
SELECT rideable_type, member_casual, COUNT(*) AS trips,
  {_pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()', 2)} AS pct_of_all_trips,
  {_AVG_MIN} AS avg_duration_min,
  {_AVG_KM} AS avg_distance_km
FROM trips GROUP BY rideable_type, member_casual
ORDER BY trips DESC, rideable_type, member_casual
""",
    "member_vs_casual": "SELECT * FROM segments ORDER BY trips DESC, member_casual",
    # quantile_disc is the definition that percentile_approx meets exactly at this accuracy.
    "member_vs_casual_approx": "SELECT * FROM segments ORDER BY trips DESC, member_casual",
    "trip_patterns_by_dow": f"""
SELECT day_of_week, is_weekend, COUNT(*) AS trips,
  {_AVG_MIN} AS avg_duration_min,
  {_AVG_KM} AS avg_distance_km
FROM trips GROUP BY day_of_week, is_weekend
ORDER BY MIN(isodow(started_at))
""",
    "hourly_demand": "SELECT * FROM hourly ORDER BY hour",
    "time_of_day_demand": f"""
SELECT time_of_day, member_casual, COUNT(*) AS trips, {_AVG_MIN} AS avg_duration_min
FROM trips GROUP BY time_of_day, member_casual
ORDER BY MIN(hour(started_at)), member_casual
""",
    "top_routes": """
SELECT * FROM routes ORDER BY trips DESC, route, start_station_name, end_station_name LIMIT 25
""",
    "top_stations": _TOP_STATIONS.format(k=25),
    "station_imbalance": _IMBALANCE,
    "seasonal_demand": "SELECT * FROM seasonal ORDER BY (SELECT MIN(month(started_at)) FROM trips t WHERE t.season = seasonal.season), season",
    "monthly_trips": "SELECT trip_month, COUNT(*) AS trips FROM trips GROUP BY trip_month ORDER BY trip_month",
    "top_draining_stations": _DRAINING,
    "station_imbalance_by_join": _IMBALANCE,
    "draining_by_join": _DRAINING,
    "monthly_stack": """
SELECT trip_month, member_trips, casual_trips, member_trips AS casual_bottom, trips AS stack_top
FROM monthly ORDER BY trip_month
""",
    "hourly_lines": "SELECT hour, weekday_trips, weekend_trips FROM hourly ORDER BY hour",
    "season_bars": """
SELECT season, trips, casual_pct,
  CAST(CAST(ROUND(casual_pct, 0) AS INTEGER) AS VARCHAR) || '% casual' AS bar_label
FROM seasonal ORDER BY (SELECT MIN(month(started_at)) FROM trips t WHERE t.season = seasonal.season), season
""",
    "segment_comparison": """
SELECT metric,
  MAX(CASE WHEN member_casual = 'member' THEN value END) AS member,
  MAX(CASE WHEN member_casual = 'casual' THEN value END) AS casual
FROM (
  SELECT member_casual, 'avg_duration_min' AS metric, avg_duration_min AS value FROM segments
  UNION ALL SELECT member_casual, 'median_duration_min', median_duration_min FROM segments
  UNION ALL SELECT member_casual, 'avg_distance_km', avg_distance_km FROM segments
  UNION ALL SELECT member_casual, 'round_trip_pct', round_trip_pct FROM segments
) GROUP BY metric
""",
    "top_stations_chart": """
SELECT station, total_activity FROM (
""" + _TOP_STATIONS.format(k=15) + """
) ORDER BY total_activity, station DESC
""",
    "imbalance_extremes": """
SELECT station, net_outflow, 'top' AS side,
  CASE WHEN net_outflow > 0 THEN 'source' ELSE 'sink' END AS direction
FROM (SELECT * FROM imbalance ORDER BY net_outflow DESC, station LIMIT 10)
UNION ALL
SELECT station, net_outflow, 'bottom' AS side,
  CASE WHEN net_outflow > 0 THEN 'source' ELSE 'sink' END AS direction
FROM (SELECT * FROM imbalance ORDER BY net_outflow ASC, station DESC LIMIT 10)
""",
    "demand_ratios": f"""
, m AS (SELECT trip_month, COUNT(*) AS trips FROM trips GROUP BY trip_month),
s AS (
  SELECT
    CAST(SUM(CASE WHEN CAST(substr(trip_month, 6, 2) AS INTEGER) IN (6, 7, 8) THEN trips ELSE 0 END) AS BIGINT) AS summer_trips,
    CAST(SUM(CASE WHEN CAST(substr(trip_month, 6, 2) AS INTEGER) IN (12, 1, 2) THEN trips ELSE 0 END) AS BIGINT) AS winter_trips
  FROM m
),
p AS (SELECT trip_month AS peak_month, trips AS peak_trips FROM m ORDER BY trips DESC, trip_month LIMIT 1),
t AS (SELECT trip_month AS trough_month, trips AS trough_trips FROM m ORDER BY trips ASC, trip_month LIMIT 1)
SELECT summer_trips, winter_trips,
  {_half_up('summer_trips', 'winter_trips', 1)} AS summer_winter_ratio,
  (SELECT peak_month FROM p) AS peak_month, (SELECT peak_trips FROM p) AS peak_trips,
  (SELECT trough_month FROM t) AS trough_month, (SELECT trough_trips FROM t) AS trough_trips,
  {_half_up('(SELECT peak_trips FROM p)', '(SELECT trough_trips FROM t)', 1)} AS peak_trough_ratio
FROM s
""",
    "station_concentration": f"""
, r AS (
  SELECT departures + arrivals AS activity,
    row_number() OVER (ORDER BY departures + arrivals DESC, station) AS rk
  FROM flow
)
SELECT 15 AS top_k, COUNT(*) AS stations,
  CAST(SUM(CASE WHEN rk <= 15 THEN activity ELSE 0 END) AS BIGINT) AS top_activity,
  CAST(SUM(activity) AS BIGINT) AS total_activity,
  {_pct('SUM(CASE WHEN rk <= 15 THEN activity ELSE 0 END)', 'SUM(activity)', 1)} AS top_share_pct
FROM r
""",
    "intraday_imbalance": f"""
, ends AS (
  SELECT start_station_name AS station, {_DAYPART.format(ts="started_at")} AS time_of_day, 1 AS departures, 0 AS arrivals FROM trips
  UNION ALL
  SELECT end_station_name AS station, {_DAYPART.format(ts="ended_at")} AS time_of_day, 0 AS departures, 1 AS arrivals FROM trips
)
SELECT station, time_of_day,
  CAST(SUM(departures) AS BIGINT) AS departures,
  CAST(SUM(arrivals) AS BIGINT) AS arrivals,
  CAST(SUM(departures) - SUM(arrivals) AS BIGINT) AS net_outflow,
  {_pct('SUM(departures) - SUM(arrivals)', '(SUM(departures) + SUM(arrivals))', 1)} AS net_outflow_pct
FROM ends GROUP BY station, time_of_day
ORDER BY station, time_of_day
""",
    "rebalancing_pairs": """
, sinks AS (
  SELECT CAST(row_number() OVER (ORDER BY net_outflow, station) AS INTEGER) AS pair_rank,
    station AS from_station, -net_outflow AS from_surplus
  FROM imbalance WHERE net_outflow < 0
),
sources AS (
  SELECT CAST(row_number() OVER (ORDER BY net_outflow DESC, station) AS INTEGER) AS pair_rank,
    station AS to_station, net_outflow AS to_deficit
  FROM imbalance WHERE net_outflow > 0
)
SELECT s.pair_rank, from_station, from_surplus, to_station, to_deficit,
  LEAST(from_surplus, to_deficit) AS bikes_to_move
FROM sinks s JOIN sources o ON s.pair_rank = o.pair_rank
ORDER BY s.pair_rank
""",
    "commuter_routes": f"""
SELECT * FROM routes WHERE member_pct > {COMMUTER_MIN_MEMBER_PCT}
ORDER BY trips DESC, route LIMIT 25
""",
    "summer_weekend_casual": f"""
SELECT start_station_name AS station, COUNT(*) AS trips, {_AVG_MIN} AS avg_duration_min
FROM trips WHERE season = 'Summer' AND is_weekend AND member_casual = 'casual'
GROUP BY start_station_name ORDER BY trips DESC, station
""",
    "clean_trips": """
SELECT ride_id, rideable_type, started_at, ended_at, start_station_name, start_station_id,
  end_station_name, end_station_id, start_lat, start_lng, end_lat, end_lng, member_casual,
  trip_duration_min, trip_date, trip_month, trip_year, hour, day_of_week, is_weekend, season,
  time_of_day, trip_distance_km, route, is_round_trip
FROM trips
""",
    "quality_funnel": f"""
, steps AS (
  SELECT 0 AS step_no, 'all rows' AS step, (SELECT COUNT(*) FROM raw) AS n_rows
  UNION ALL SELECT 1, 'required fields present', (SELECT COUNT(*) FROM present)
  UNION ALL SELECT 2, 'one row per ride', (SELECT COUNT(*) FROM uniq)
  UNION ALL SELECT 3, 'duration in range',
    (SELECT COUNT(*) FROM uniq WHERE trip_duration_min > 1 AND trip_duration_min < 1440)
  UNION ALL SELECT 4, 'both ends in the service area', (SELECT COUNT(*) FROM kept)
)
SELECT CAST(step_no AS INTEGER) AS step_no, step, n_rows AS "rows",
  (SELECT COUNT(*) FROM raw) - n_rows AS removed_so_far,
  {_pct('n_rows', '(SELECT COUNT(*) FROM raw)', 1)} AS pct_of_raw
FROM steps ORDER BY step_no
""",
    "virtual_zones": """
, dockless AS (
  SELECT * FROM timed
  WHERE start_station_name IS NULL AND ride_id IS NOT NULL AND started_at IS NOT NULL
    AND start_lat BETWEEN 41.60 AND 42.10 AND start_lng BETWEEN -87.95 AND -87.50
  QUALIFY row_number() OVER (PARTITION BY ride_id ORDER BY started_at, start_lat, start_lng) = 1
)
SELECT CAST(floor(start_lat / CAST(0.01 AS DOUBLE)) AS BIGINT) AS zone_lat,
  CAST(floor(start_lng / CAST(0.01 AS DOUBLE)) AS BIGINT) AS zone_lng,
  COUNT(*) AS trips,
  CAST(SUM(CASE WHEN lower(trim(member_casual)) = 'casual' THEN 1 ELSE 0 END) AS BIGINT) AS casual_trips
FROM dockless GROUP BY 1, 2
ORDER BY trips DESC, zone_lat, zone_lng
""",
}


QUERIES |= {
    # The same rows by another way: through files, archives, landing, an observation, a SQL catalog.
    "landed_trips": QUERIES["clean_trips"],
    "archived_trips": QUERIES["clean_trips"],
    "observed_funnel": QUERIES["quality_funnel"],
    "sql_station_imbalance": _IMBALANCE,
    "quarantined_rows": """
SELECT ride_id, CASE WHEN CAST(ride_id AS BIGINT) % 61 = 0 THEN 'too few fields' WHEN CAST(ride_id AS BIGINT) % 67 = 0 THEN 'too many fields'
  ELSE 'not a number: end_lat' END AS reason
FROM raw WHERE CAST(ride_id AS BIGINT) % 61 = 0 OR CAST(ride_id AS BIGINT) % 67 = 0 OR CAST(ride_id AS BIGINT) % 71 = 0
""",
    "accepted_trips": QUERIES["clean_trips"].rstrip() + """
WHERE CAST(ride_id AS BIGINT) % 61 <> 0 AND CAST(ride_id AS BIGINT) % 67 <> 0 AND CAST(ride_id AS BIGINT) % 71 <> 0
""",
    "published_months": """
, ends AS (SELECT MIN(trip_month) AS a, MAX(trip_month) AS z FROM trips)
SELECT trip_month, COUNT(*) FILTER (WHERE trip_month <> a OR member_casual = 'member') AS trips,
  CASE trip_month WHEN z THEN 'new' WHEN a THEN 'changed' ELSE 'same' END AS action
FROM trips, ends GROUP BY trip_month, a, z
""",
    "selected_months": """
SELECT trip_month, COUNT(*) AS trips, COUNT(*) FILTER (WHERE member_casual = 'member') AS member_trips
FROM trips WHERE trip_month >= '2024-03' GROUP BY trip_month HAVING COUNT(*) >= 20
""",
    "median_from_sketches": "SELECT member_casual, COUNT(*) AS trips, true AS within_rank_error FROM trips GROUP BY member_casual",
    # Central time: six hours behind until the spring gap ends, then five until the second 02:00 of the autumn night.
    "zoned_durations": """
, walls AS (
  SELECT CAST(event_id AS VARCHAR) AS ride_id, night, TIMESTAMP '1970-01-01' + to_seconds(epoch(begin_at)::BIGINT + (event_id * 37) % 12600) AS s, 60 + (event_id * 53) % 9000 AS n
  FROM events, (VALUES ('spring', TIMESTAMP '2024-03-10 00:30:00'), ('autumn', TIMESTAMP '2024-11-03 00:10:00')) AS v(night, begin_at)
),
both_ends AS (SELECT ride_id, night, s AS started_at, s + to_seconds(n) AS ended_at FROM walls),
zoned AS (
  SELECT *, CASE WHEN started_at >= TIMESTAMP '2024-03-10 03:00:00' AND started_at < TIMESTAMP '2024-11-03 02:00:00' THEN 5 ELSE 6 END AS so,
    CASE WHEN ended_at >= TIMESTAMP '2024-03-10 03:00:00' AND ended_at < TIMESTAMP '2024-11-03 02:00:00' THEN 5 ELSE 6 END AS eo
  FROM both_ends
)
SELECT ride_id, night, started_at, ended_at, CAST(date_diff('second', started_at, ended_at) + 3600 * (eo - so) AS DOUBLE) / 60.0 AS elapsed_min,
  CAST(date_diff('second', started_at, ended_at) AS DOUBLE) / 60.0 AS wall_min
FROM zoned
""",
}


def sql_for(name: str) -> str:
    """Full statement for ``name``: shared CTE prefix + query.

    Query texts starting with ``,`` extend the CTE list before their SELECT.
    """
    return PREFIX + QUERIES[name].strip()


def all_sql() -> dict[str, str]:
    return {name: sql_for(name) for name in QUERIES}
