"""SQL oracles (DuckDB dialect) for the registered queries.

Each string runs on the driver's pre-registered views and repeats the stand-in
mapping of ``stratus.plans.standins`` as CTEs and states all fixed values itself; nothing is
imported from the engine.
"""

from __future__ import annotations

# -- shared CTE bodies -------------------------------------------------------

K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

STAGE = f"""
stage AS (
  SELECT 'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS location_name,
         CAST(NULL AS VARCHAR) AS country,
         CAST(({K} - 50) * 1.5 AS DOUBLE) AS latitude,
         value - 180 AS longitude,
         CAST({K} * 10.0 AS DOUBLE) AS elevation_m,
         'UTC' AS timezone,
         ts AS measured_at,
         value / 10 - 10 AS temperature_2m,
         CAST({K} AS DOUBLE) AS relative_humidity_2m,
         value / 10 - 12 AS apparent_temperature,
         CASE WHEN event_type = 'error' THEN value / 100 ELSE CAST(0.0 AS DOUBLE) END AS precipitation,
         CASE WHEN event_type = 'error' THEN value / 200 ELSE CAST(0.0 AS DOUBLE) END AS rain,
         CASE WHEN event_type = 'signup' THEN value / 1000 ELSE CAST(0.0 AS DOUBLE) END AS snowfall,
         value / 10 + 1000 AS pressure_msl,
         CAST({K} AS DOUBLE) AS cloud_cover,
         value / 5 AS wind_speed_10m,
         value AS wind_direction_10m,
         value * CAST(0.75 AS DOUBLE) AS wind_direction_100m,
         value / 4 AS wind_gusts_10m,
         value AS shortwave_radiation,
         value * 10 AS sunshine_duration,
         CAST({K} AS SMALLINT) AS weather_code,
         value / 10 - 13 AS wet_bulb_temperature_2m,
         hour(ts) BETWEEN 6 AND 17 AS is_day,
         ts AS loaded_at,
         event_id
  FROM events
)"""

CITIES = """
cities AS (SELECT c_custkey AS id, c_name AS city_name FROM customer)"""


def r2(expr: str) -> str:
    """ROUND(x::NUMERIC, 2)::FLOAT via DECIMAL(38,12), as on the Spark side."""
    return f"CAST(round(TRY_CAST({expr} AS DECIMAL(38,12)), 2) AS DOUBLE)"


DAILY_AGGS = f"""
         {r2('avg(temperature_2m)')} AS temp_avg,
         min(temperature_2m) AS temp_min,
         max(temperature_2m) AS temp_max,
         {r2('avg(apparent_temperature)')} AS apparent_temp_avg,
         min(apparent_temperature) AS apparent_temp_min,
         max(apparent_temperature) AS apparent_temp_max,
         {r2('avg(wet_bulb_temperature_2m)')} AS wet_bulb_temp_avg,
         {r2('sum(precipitation)')} AS precipitation_sum,
         {r2('sum(rain)')} AS rain_sum,
         {r2('sum(snowfall)')} AS snowfall_sum,
         {r2('sum(sunshine_duration) / 3600.0')} AS sunshine_duration_hours,
         {r2('avg(shortwave_radiation)')} AS shortwave_radiation_avg,
         {r2('avg(wind_speed_10m)')} AS avg_wind_speed_10m,
         max(wind_speed_10m) AS max_wind_speed_10m,
         max(wind_gusts_10m) AS max_wind_gusts,
         {r2('avg(cloud_cover)')} AS avg_cloud_cover,
         {r2('avg(relative_humidity_2m)')} AS avg_relative_humidity,
         {r2('avg(pressure_msl)')} AS avg_pressure_msl,
         min(temperature_2m) < 0 AS is_frost_day,
         max(temperature_2m) >= 30 AS is_hot_day,
         sum(precipitation) >= 1 AS is_rainy_day,
         sum(snowfall) > 0 AS is_snowy_day"""

DAILY_COLS = ("temp_avg, temp_min, temp_max, apparent_temp_avg, apparent_temp_min, apparent_temp_max, "
              "wet_bulb_temp_avg, precipitation_sum, rain_sum, snowfall_sum, sunshine_duration_hours, "
              "shortwave_radiation_avg, avg_wind_speed_10m, max_wind_speed_10m, max_wind_gusts, "
              "avg_cloud_cover, avg_relative_humidity, avg_pressure_msl, "
              "is_frost_day, is_hot_day, is_rainy_day, is_snowy_day")


def daily_fact_cte(name: str = "fact", where: str = "TRUE", stage: str = "stage", cities: str = "cities") -> str:
    """Daily fact CTE over ``stage`` (mode via count + row_number, smallest code on ties)."""
    return f"""
{name}_agg AS (
  SELECT CAST(measured_at AS DATE) AS d, location_name AS loc,{DAILY_AGGS}
  FROM {stage} WHERE {where} GROUP BY 1, 2
),
{name}_mode AS (
  SELECT d, loc, code FROM (
    SELECT CAST(measured_at AS DATE) AS d, location_name AS loc, weather_code AS code,
           row_number() OVER (PARTITION BY CAST(measured_at AS DATE), location_name
                              ORDER BY count(*) DESC, weather_code) AS rn
    FROM {stage} WHERE ({where}) AND weather_code IS NOT NULL GROUP BY 1, 2, 3) t
  WHERE rn = 1
),
{name} AS (
  SELECT CAST(strftime(a.d, '%Y%m%d') AS INTEGER) AS date_id, c.id AS city_id,
         CAST(m.code AS SMALLINT) AS dominant_weather_code_id, {", ".join("a." + x.strip() for x in DAILY_COLS.split(","))}
  FROM {name}_agg a JOIN {cities} c ON c.city_name = a.loc
  LEFT JOIN {name}_mode m ON m.d = a.d AND m.loc = a.loc
)"""


ORACLE: dict[str, str] = {}

ORACLE["daily_rollup"] = f"""
WITH {STAGE},{CITIES},{daily_fact_cte()}
SELECT * FROM fact"""

ORACLE["daily_rollup_window"] = f"""
WITH {STAGE},{CITIES},{daily_fact_cte(where="CAST(measured_at AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'")}
SELECT * FROM fact"""


# -- literal relations --------------------------------------------------------
# The values below are stated here once more, so that an error in the engine's own list shows.
# FIXED VALUES — compass bands: (id, degree_from, degree_to, short, full).
WIND_BANDS = [
    (1, 0, 11, 'N', 'North'),
    (2, 12, 33, 'NNE', 'North-Northeast'),
    (3, 34, 56, 'NE', 'Northeast'),
    (4, 57, 78, 'ENE', 'East-Northeast'),
    (5, 79, 101, 'E', 'East'),
    (6, 102, 123, 'ESE', 'East-Southeast'),
    (7, 124, 146, 'SE', 'Southeast'),
    (8, 147, 168, 'SSE', 'South-Southeast'),
    (9, 169, 191, 'S', 'South'),
    (10, 192, 213, 'SSW', 'South-Southwest'),
    (11, 214, 236, 'SW', 'Southwest'),
    (12, 237, 258, 'WSW', 'West-Southwest'),
    (13, 259, 281, 'W', 'West'),
    (14, 282, 303, 'WNW', 'West-Northwest'),
    (15, 304, 326, 'NW', 'Northwest'),
    (16, 327, 360, 'NNW', 'North-Northwest'),
]

# FIXED VALUES — weather codes: (id, description, severity, precipitation_type).
WMO_CODES = [
    (0, 'Clear sky', 'None', None),
    (1, 'Mainly clear', 'None', None),
    (2, 'Partly cloudy', 'None', None),
    (3, 'Overcast', 'None', None),
    (45, 'Fog', 'Low', None),
    (48, 'Depositing rime fog', 'Low', None),
    (51, 'Drizzle: light', 'Low', 'Rain'),
    (53, 'Drizzle: moderate', 'Low', 'Rain'),
    (55, 'Drizzle: dense', 'Low', 'Rain'),
    (56, 'Freezing drizzle: light', 'Medium', 'Mixed'),
    (57, 'Freezing drizzle: dense', 'Medium', 'Mixed'),
    (61, 'Rain: slight', 'Low', 'Rain'),
    (63, 'Rain: moderate', 'Medium', 'Rain'),
    (65, 'Rain: heavy', 'High', 'Rain'),
    (66, 'Freezing rain: light', 'Medium', 'Mixed'),
    (67, 'Freezing rain: heavy', 'High', 'Mixed'),
    (71, 'Snowfall: slight', 'Low', 'Snow'),
    (73, 'Snowfall: moderate', 'Medium', 'Snow'),
    (75, 'Snowfall: heavy', 'High', 'Snow'),
    (77, 'Snow grains', 'Low', 'Snow'),
    (80, 'Rain showers: slight', 'Low', 'Rain'),
    (81, 'Rain showers: moderate', 'Medium', 'Rain'),
    (82, 'Rain showers: violent', 'High', 'Rain'),
    (85, 'Snow showers: slight', 'Low', 'Snow'),
    (86, 'Snow showers: heavy', 'High', 'Snow'),
    (95, 'Thunderstorm: slight or moderate', 'High', 'Rain'),
    (96, 'Thunderstorm with slight hail', 'High', 'Mixed'),
    (99, 'Thunderstorm with heavy hail', 'High', 'Mixed'),
]

# FIXED VALUES — climate code → group.
CLIMATE_GROUPS = {
    'ET': 'Polar',
    'DFC': 'Subarctic',
    'DFA': 'Continental',
    'DFB': 'Continental',
    'CFA': 'Temperate',
    'CFB': 'Temperate',
    'CSA': 'Mediterranean',
    'CSB': 'Mediterranean',
    'BSK': 'Arid',
    'BWH': 'Arid',
}


def _sql_lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


BANDS = "bands(id, degree_from, degree_to) AS (VALUES " + ", ".join(
    f"({i}, {a}, {b})" for i, a, b, _, _ in WIND_BANDS) + ")"
SEED = "seed(id, description, severity, precipitation_type) AS (SELECT CAST(c0 AS SMALLINT), c1, c2, c3 FROM (VALUES " + \
    ", ".join("(" + ", ".join(_sql_lit(x) for x in r) + ")" for r in WMO_CODES) + ") t(c0, c1, c2, c3))"

CONFIG = """
cfg AS (
  SELECT c.c_name AS name, c.c_acctbal / 100 AS lat, c.c_acctbal / 50 AS lon, 'UTC' AS tz,
         n.n_name AS country, 'N' || CAST(c.c_nationkey AS VARCHAR) AS country_iso2,
         'NAT' || CAST(c.c_nationkey AS VARCHAR) AS country_iso3, r.r_name AS continent,
         c.c_mktsegment AS region, c.c_acctbal > 5000 AS is_capital,
         CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'Cfb' WHEN 'BUILDING' THEN 'Dfb' WHEN 'FURNITURE' THEN 'Csa'
                             WHEN 'HOUSEHOLD' THEN 'Bsk' WHEN 'MACHINERY' THEN 'ET' END AS climate_zone,
         c.c_acctbal > 0 AS active, c.c_custkey AS pos
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
                  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
countries AS (
  SELECT country AS country_name, country_iso2 AS iso_code_2, country_iso3 AS iso_code_3, continent, region
  FROM (SELECT *, row_number() OVER (PARTITION BY country ORDER BY pos) AS rn FROM cfg) t WHERE rn = 1
),
countries_id AS (
  SELECT k.*, n.n_nationkey AS id FROM countries k JOIN nation n ON n.n_name = k.country_name
)"""


def city_dim_cte(name: str, where: str = "TRUE") -> str:
    """Latest stage geo per place (NULL load time first, then highest event id) + config."""
    return f"""
{name}_latest AS (
  SELECT location_name, latitude, longitude, elevation_m, timezone FROM (
    SELECT *, row_number() OVER (PARTITION BY location_name
                                 ORDER BY loaded_at DESC NULLS FIRST, event_id DESC) AS rn
    FROM stage WHERE {where}) t WHERE rn = 1
),
{name} AS (
  SELECT l.location_name AS city_name, l.latitude, l.longitude, l.elevation_m, l.timezone,
         f.is_capital, f.climate_zone, k.id AS country_id
  FROM {name}_latest l LEFT JOIN cfg f ON f.name = l.location_name
  LEFT JOIN countries_id k ON k.country_name = f.country
)"""


ORACLE["hourly_fact"] = f"""
WITH {STAGE},{CITIES}, {BANDS}
SELECT CAST(strftime(s.measured_at, '%Y%m%d') AS INTEGER) AS date_id,
       CAST(hour(s.measured_at) * 100 + minute(s.measured_at) AS INTEGER) AS time_id,
       c.id AS city_id, CAST(s.weather_code AS SMALLINT) AS weather_code_id,
       CAST(b10.id AS SMALLINT) AS wind_dir_10m_id, CAST(b100.id AS SMALLINT) AS wind_dir_100m_id,
       s.temperature_2m, s.relative_humidity_2m, s.apparent_temperature, s.precipitation, s.rain,
       s.snowfall, s.pressure_msl, s.cloud_cover, s.wind_speed_10m, s.wind_gusts_10m,
       s.shortwave_radiation, s.sunshine_duration, s.wet_bulb_temperature_2m, s.is_day
FROM stage s JOIN cities c ON c.city_name = s.location_name
LEFT JOIN bands b10 ON s.wind_direction_10m BETWEEN b10.degree_from AND b10.degree_to
LEFT JOIN bands b100 ON s.wind_direction_100m BETWEEN b100.degree_from AND b100.degree_to"""

ORACLE["wind_band_join"] = f"""
WITH {STAGE}, {BANDS}
SELECT s.event_id, s.wind_direction_10m, CAST(b.id AS SMALLINT) AS wind_dir_id
FROM stage s LEFT JOIN bands b ON s.wind_direction_10m BETWEEN b.degree_from AND b.degree_to"""

ORACLE["wind_band_lookup"] = ORACLE["wind_band_join"]

ORACLE["compass16"] = f"""
WITH {STAGE}
SELECT event_id, wind_direction_10m,
       CAST(((CAST(floor((wind_direction_10m + 11.25) / 22.5) AS BIGINT) % 16 + 16) % 16) + 1 AS SMALLINT) AS compass_id
FROM stage"""

CAL_COLS = """
       CAST(strftime(d, '%Y%m%d') AS INTEGER) AS id, CAST(d AS DATE) AS date,
       CAST(year(d) AS SMALLINT) AS year, CAST(quarter(d) AS SMALLINT) AS quarter,
       CAST(month(d) AS SMALLINT) AS month, monthname(d) AS month_name,
       CAST(weekofyear(d) AS SMALLINT) AS week_of_year, CAST(day(d) AS SMALLINT) AS day,
       CAST(isodow(d) AS SMALLINT) AS day_of_week, dayname(d) AS day_name,
       isodow(d) IN (6, 7) AS is_weekend,
       (year(d) % 4 = 0 AND (year(d) % 100 <> 0 OR year(d) % 400 = 0)) AS is_leap_year"""

ORACLE["dim_calendar"] = f"""
WITH span AS (SELECT min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS b FROM orders),
days AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM span)
SELECT {CAL_COLS} FROM days"""

ORACLE["time_of_day"] = """
SELECT event_id,
       CAST(hour(ts) * 100 + minute(ts) AS INTEGER) AS id,
       strftime(ts, '%H:%M:%S') AS time_value,
       CAST(hour(ts) AS SMALLINT) AS hour_24h,
       CAST(CASE WHEN hour(ts) = 0 THEN 12 WHEN hour(ts) <= 12 THEN hour(ts) ELSE hour(ts) - 12 END AS SMALLINT) AS hour_12h,
       CAST(minute(ts) AS SMALLINT) AS minute,
       CASE WHEN hour(ts) < 12 THEN 'AM' ELSE 'PM' END AS am_pm,
       strftime(ts, '%H:%M') AS time_24h,
       strftime(ts, '%-I:%M%p') AS time_12h,
       CASE WHEN hour(ts) BETWEEN 6 AND 11 THEN 'Morning' WHEN hour(ts) BETWEEN 12 AND 17 THEN 'Afternoon'
            WHEN hour(ts) BETWEEN 18 AND 23 THEN 'Evening' ELSE 'Night' END AS part_of_day
FROM events"""

ORACLE["dim_weather_code"] = f"""
WITH {STAGE}, {SEED}
SELECT * FROM seed
UNION ALL
SELECT DISTINCT CAST(weather_code AS SMALLINT), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR)
FROM stage WHERE weather_code IS NOT NULL AND weather_code NOT IN (SELECT id FROM seed)"""

ORACLE["dim_country_first"] = f"""
WITH {CONFIG.strip()}
SELECT * FROM countries"""

ORACLE["dim_city_latest"] = f"""
WITH {STAGE},{CONFIG},{city_dim_cte("dc")}
SELECT * FROM dc"""

ORACLE["scd1_merge"] = f"""
WITH {STAGE},{CONFIG},
{city_dim_cte("t", "measured_at < TIMESTAMP '2024-01-16 00:00:00'").strip()},
{city_dim_cte("s", "measured_at >= TIMESTAMP '2024-01-16 00:00:00'").strip()}
SELECT coalesce(s.city_name, t.city_name) AS city_name,
       CASE WHEN s.city_name IS NOT NULL THEN s.latitude ELSE t.latitude END AS latitude,
       CASE WHEN s.city_name IS NOT NULL THEN s.longitude ELSE t.longitude END AS longitude,
       CASE WHEN s.city_name IS NOT NULL THEN s.elevation_m ELSE t.elevation_m END AS elevation_m,
       CASE WHEN s.city_name IS NOT NULL THEN s.timezone ELSE t.timezone END AS timezone,
       CASE WHEN s.city_name IS NOT NULL THEN s.is_capital ELSE t.is_capital END AS is_capital,
       CASE WHEN s.city_name IS NOT NULL THEN s.climate_zone ELSE t.climate_zone END AS climate_zone,
       CASE WHEN s.city_name IS NOT NULL THEN s.country_id ELSE t.country_id END AS country_id,
       CASE WHEN t.city_name IS NOT NULL THEN TIMESTAMP '2024-01-15 08:00:00' ELSE TIMESTAMP '2024-01-31 08:00:00' END AS loaded_at,
       CASE WHEN s.city_name IS NOT NULL THEN TIMESTAMP '2024-01-31 08:00:00' ELSE TIMESTAMP '2024-01-15 08:00:00' END AS updated_at
FROM t FULL OUTER JOIN s ON s.city_name = t.city_name"""

ORACLE["insert_absent"] = """
WITH target AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
new AS (SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
        FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01')
SELECT * FROM target
UNION ALL
SELECT * FROM new n WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.o_orderkey = n.o_orderkey)"""

ORACLE["replace_range"] = f"""
WITH {STAGE},{CITIES},
partial_stage AS (SELECT s.* FROM stage s JOIN events e ON e.event_id = s.event_id WHERE e.event_type <> 'error'),
{daily_fact_cte("part", stage="partial_stage").strip()},
{daily_fact_cte("fresh", where="CAST(measured_at AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'").strip()}
SELECT * FROM part WHERE date_id NOT BETWEEN 20240110 AND 20240120
UNION ALL
SELECT * FROM fresh"""

ORACLE["assign_ids"] = f"""
WITH {STAGE},
old AS (SELECT city_name, row_number() OVER (ORDER BY city_name) AS id
        FROM (SELECT DISTINCT location_name AS city_name FROM stage WHERE measured_at < TIMESTAMP '2024-01-02') t),
new AS (SELECT DISTINCT location_name AS city_name FROM stage WHERE measured_at >= TIMESTAMP '2024-01-02'
        AND location_name NOT IN (SELECT city_name FROM old))
SELECT city_name, CAST((SELECT coalesce(max(id), 0) FROM old) + row_number() OVER (ORDER BY city_name) AS INTEGER) AS id
FROM new"""

MART_SELECT = """
SELECT cal.d AS date, f.city_id, sd.description AS weather_description,
       f.temp_avg, f.temp_min, f.temp_max, f.apparent_temp_avg, f.precipitation_sum, f.snowfall_sum,
       f.sunshine_duration_hours AS sunshine_hours, f.avg_wind_speed_10m AS wind_speed_avg,
       f.max_wind_gusts AS wind_gusts_max, f.avg_relative_humidity AS humidity_avg,
       f.avg_pressure_msl AS pressure_avg, f.is_frost_day, f.is_hot_day, f.is_rainy_day, f.is_snowy_day
FROM fact f
JOIN (SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS cid, d FROM cal_days) cal ON cal.cid = f.date_id
LEFT JOIN seed sd ON sd.id = f.dominant_weather_code_id"""

CAL_DAYS = """
cal_days AS (
  SELECT CAST(unnest(generate_series(min(CAST(measured_at AS DATE)), max(CAST(measured_at AS DATE)), INTERVAL 1 DAY)) AS DATE) AS d
  FROM stage
)"""

ORACLE["daily_mart"] = f"""
WITH {STAGE},{CITIES},{daily_fact_cte()}, {SEED},{CAL_DAYS},
mart AS ({MART_SELECT})
SELECT * FROM mart"""

ORACLE["daily_mart_wide"] = f"""
WITH {STAGE},{CITIES},{daily_fact_cte()}, {SEED},{CAL_DAYS},{CONFIG},{city_dim_cte("dc")},
mart AS ({MART_SELECT})
SELECT m.*, dc.city_name, dc.is_capital, dc.climate_zone, dc.latitude, dc.longitude,
       k.country_name, k.region
FROM mart m
LEFT JOIN (SELECT dc.*, c.id FROM dc JOIN cities c ON c.city_name = dc.city_name) dc ON dc.id = m.city_id
LEFT JOIN countries_id k ON k.id = dc.country_id"""

LOG = f"""
log AS (
  SELECT CAST(ts AS DATE) AS run_date, 'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS city_name,
         CASE WHEN event_type IN ('view', 'click') THEN 'core' ELSE 'stage' END AS layer,
         CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
         CASE WHEN event_type = 'error' THEN CAST(NULL AS INTEGER) ELSE 20 + {K} % 6 END AS rows_loaded,
         24 AS expected_rows, ts AS executed_at,
         CASE WHEN event_type = 'error' THEN 'HTTP error ' || CAST({K} AS VARCHAR) END AS error_msg,
         event_id AS id
  FROM events
)"""

GAPS = f"""
{LOG},
gap_cities AS (SELECT c_name AS city_name FROM customer),
gaps AS (
  SELECT CAST(d AS DATE) AS missing_date, c.city_name, l.layer
  FROM (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY)) AS d) days
  CROSS JOIN gap_cities c CROSS JOIN (VALUES ('stage'), ('core')) l(layer)
  WHERE NOT EXISTS (SELECT 1 FROM log o WHERE o.status = 'success' AND o.run_date = CAST(days.d AS DATE)
                    AND o.city_name = c.city_name AND o.layer = l.layer)
)"""

ORACLE["date_gaps"] = f"WITH {GAPS.strip()}\nSELECT * FROM gaps"

ORACLE["missing_days"] = f"""WITH {GAPS.strip()}
SELECT city_name, count(*) AS missing_days FROM gaps WHERE layer = 'stage' GROUP BY city_name"""

ORACLE["top_gaps"] = f"""WITH {GAPS.strip()}
SELECT * FROM gaps ORDER BY missing_date, city_name, layer LIMIT 20"""

ORACLE["coverage"] = """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(DISTINCT o_custkey) AS cities
FROM orders GROUP BY 1"""

ORACLE["pending_chunks"] = f"""
WITH {CONFIG.strip()}, {LOG.strip()},
months AS (SELECT CAST(unnest(generate_series(DATE '2023-01-01', DATE '2024-01-01', INTERVAL 1 MONTH)) AS DATE) AS m),
chunks AS (SELECT f.name AS city_name, m AS chunk_start, least(last_day(m), DATE '2024-01-30') AS chunk_end
           FROM cfg f CROSS JOIN months WHERE coalesce(f.active, false)),
ok AS (SELECT DISTINCT city_name, run_date FROM log WHERE layer = 'stage' AND status = 'success')
SELECT c.city_name, c.chunk_start, c.chunk_end FROM chunks c
WHERE (SELECT count(*) FROM ok WHERE ok.city_name = c.city_name AND ok.run_date BETWEEN c.chunk_start AND c.chunk_end)
      < date_diff('day', c.chunk_start, c.chunk_end) + 1"""

ORDERS_DAILY = """
SELECT o_custkey, CAST(o_orderdate AS DATE) AS order_date, count(*) AS n_orders,
       CAST(round(TRY_CAST(sum(o_totalprice) AS DECIMAL(38,12)), 2) AS DOUBLE) AS total_price
FROM {src} GROUP BY 1, 2"""

GAP_MONTHS = f"""
partial AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01' OR o_orderstatus = 'F'),
down AS ({ORDERS_DAILY.format(src="partial")}),
gm AS (
  SELECT DISTINCT CAST(date_trunc('month', d) AS DATE) AS start_date,
         least(last_day(d), DATE '2001-07-31') AS end_date
  FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders
        EXCEPT SELECT o_custkey, order_date FROM down) x
)"""

ORACLE["gap_months"] = f"WITH {GAP_MONTHS.strip()}\nSELECT * FROM gm"

ORACLE["fill_gaps"] = f"""
WITH {GAP_MONTHS.strip()},
fresh_src AS (SELECT o.* FROM orders o WHERE EXISTS (
  SELECT 1 FROM gm WHERE gm.start_date <= gm.end_date AND CAST(o.o_orderdate AS DATE) BETWEEN gm.start_date AND gm.end_date)),
fresh AS ({ORDERS_DAILY.format(src="fresh_src")})
SELECT * FROM down d WHERE NOT EXISTS (
  SELECT 1 FROM gm WHERE gm.start_date <= gm.end_date AND d.order_date BETWEEN gm.start_date AND gm.end_date)
UNION ALL SELECT * FROM fresh"""

ORACLE["load_status"] = f"""
WITH {LOG.strip()}
SELECT run_date, city_name, layer,
       CASE WHEN bool_or(status = 'success') THEN 'success' ELSE 'failed' END AS status,
       count(*) AS attempts,
       arg_max(error_msg, (executed_at, id)) AS last_error
FROM log GROUP BY 1, 2, 3"""

ORACLE["incomplete_days"] = f"""
WITH {LOG.strip()}
SELECT run_date, city_name, layer, rows_loaded, expected_rows FROM log
WHERE status = 'success' AND rows_loaded <> expected_rows"""

ORACLE["run_summary"] = f"""
WITH {LOG.strip()}
SELECT run_date, city_name, count(*) FILTER (WHERE status = 'success' AND layer = 'core') AS n_success,
       count(*) FILTER (WHERE status = 'failed') AS n_failed,
       NOT (count(*) FILTER (WHERE status = 'failed') > 0
            AND count(*) FILTER (WHERE status = 'success' AND layer = 'core') = 0) AS ok
FROM log GROUP BY 1, 2"""

ORACLE["constraint_checks"] = """
SELECT 'lineitem_pk' AS check_name, count(*) AS violations FROM (
  SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1) t
UNION ALL SELECT 'orders_pk', count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1) t
UNION ALL SELECT 'lineitem_not_null', count(*) FROM lineitem
  WHERE l_orderkey IS NULL OR l_linenumber IS NULL OR l_shipdate IS NULL
UNION ALL SELECT 'lineitem_fk_orders', count(*) FROM lineitem l
  WHERE l.l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)
UNION ALL SELECT 'orders_fk_customer', count(*) FROM orders o
  WHERE o.o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)
UNION ALL SELECT 'customer_fk_nation', count(*) FROM customer c
  WHERE c.c_nationkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM nation n WHERE n.n_nationkey = c.c_nationkey)
UNION ALL SELECT 'lineitem_returnflag_in', count(*) FROM lineitem WHERE l_returnflag NOT IN ('R', 'A', 'N')
UNION ALL SELECT 'orders_status_in', count(*) FROM orders WHERE o_orderstatus NOT IN ('F')"""


# -- forecast ----------------------------------------------------------------
# FIXED VALUES — forecast metrics, the 80 % interval, landed response bodies.
FORECAST_METRICS = ['temp_avg', 'temp_min', 'temp_max', 'precipitation_sum', 'sunshine_hours', 'humidity_avg', 'pressure_avg', 'wind_speed_avg']
INTERVAL_Z80 = 1.2815515655446004
RESPONSE_BODIES = {
    'error': '{"reason": "Daily API request limit exceeded"}',
    'signup': '{"error": true}',
    'purchase': 'Daily quota exceeded',
    'click': '{"reason": "Minutely API request limit exceeded"}',
    'view': 'daily limit reached',
}


def orders_stage(place_expr: str, joins: str = "") -> str:
    return f"""
SELECT 'Customer#' || lpad(CAST({place_expr} AS VARCHAR), 9, '0') AS location_name,
       o.o_orderdate AS measured_at,
       o.o_totalprice / 10000 - 15 AS temperature_2m,
       o.o_totalprice / 10000 - 17 AS apparent_temperature,
       o.o_totalprice / 10000 - 18 AS wet_bulb_temperature_2m,
       CASE WHEN o.o_orderstatus = 'F' THEN o.o_totalprice / 50000 ELSE CAST(0.0 AS DOUBLE) END AS precipitation,
       CASE WHEN o.o_orderstatus = 'F' THEN o.o_totalprice / 100000 ELSE CAST(0.0 AS DOUBLE) END AS rain,
       CASE WHEN o.o_orderstatus = 'P' THEN o.o_totalprice / 200000 ELSE CAST(0.0 AS DOUBLE) END AS snowfall,
       o.o_totalprice / 10 AS sunshine_duration,
       o.o_totalprice / 1000 AS shortwave_radiation,
       o.o_totalprice / 20000 AS wind_speed_10m,
       o.o_totalprice / 15000 AS wind_gusts_10m,
       o.o_totalprice / 5000 AS cloud_cover,
       o.o_totalprice / 5000 AS relative_humidity_2m,
       o.o_totalprice / 1000 + 900 AS pressure_msl,
       CAST(CASE WHEN o.o_orderstatus = 'F' THEN 61 WHEN o.o_orderstatus = 'P' THEN 71 ELSE 0 END AS SMALLINT) AS weather_code
FROM orders o {joins}"""


MART_OF = """
{name} AS (
  SELECT CAST(strptime(CAST(date_id AS VARCHAR), '%Y%m%d') AS DATE) AS date, city_id,
         temp_avg, temp_min, temp_max, apparent_temp_avg, precipitation_sum, snowfall_sum,
         sunshine_duration_hours AS sunshine_hours, avg_wind_speed_10m AS wind_speed_avg,
         max_wind_gusts AS wind_gusts_max, avg_relative_humidity AS humidity_avg,
         avg_pressure_msl AS pressure_avg, is_frost_day, is_hot_day, is_rainy_day, is_snowy_day
  FROM {src}
)"""

NATION_MART = f"""
nstage AS ({orders_stage("c.c_nationkey", "JOIN customer c ON o.o_custkey = c.c_custkey")}),
ncities AS (SELECT CAST(n_nationkey AS BIGINT) AS id, 'Customer#' || lpad(CAST(n_nationkey AS VARCHAR), 9, '0') AS city_name
            FROM nation),
{daily_fact_cte("nfact", stage="nstage", cities="ncities").strip()},
{MART_OF.format(name="nmart", src="nfact").strip()}"""

Z = f"CAST({INTERVAL_Z80!r} AS DOUBLE)"


def long_of(name: str, src: str, where: str) -> str:
    cols = ", ".join(FORECAST_METRICS)
    return f"""
{name} AS (
  SELECT city_id, date AS ds, metric, y FROM (
    SELECT * FROM (SELECT city_id, date, {cols} FROM {src} WHERE {where})
    UNPIVOT (y FOR metric IN ({cols}))) u
  WHERE y IS NOT NULL AND NOT isnan(y)
)"""


def linear_pred(name: str, long: str, run: str, last_obs: bool = False) -> str:
    first = "f.last_obs + CAST(h AS INTEGER)" if last_obs else f"DATE '{run}' + CAST(h AS INTEGER)"
    return f"""
{name}_fit AS (
  SELECT city_id, metric, count(*) AS n, max(ds) AS last_obs,
         regr_slope(y, x) AS b, regr_intercept(y, x) AS a,
         regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy, regr_sxy(y, x) AS sxy
  FROM (SELECT *, CAST(date_diff('day', DATE '{run}', ds) AS DOUBLE) AS x FROM {long}) t
  GROUP BY 1, 2 HAVING count(*) >= 60
),
{name}_raw AS (
  SELECT city_id, metric, target_date, CAST(hz AS SMALLINT) AS horizon_days,
         a + b * CAST(hz AS DOUBLE) AS y0, sigma
  FROM (SELECT f.city_id, f.metric, f.a, f.b, {first} AS target_date,
               date_diff('day', DATE '{run}', {first}) AS hz,
               sqrt(greatest(f.syy - f.sxy * f.sxy / f.sxx, 0.0) / (f.n - 2)) AS sigma
        FROM {name}_fit f, (SELECT unnest(range(1, 8)) AS h) hs) t
  WHERE hz BETWEEN 1 AND 7
),
{name} AS (
  SELECT city_id, metric, target_date, horizon_days,
         CASE WHEN metric IN ('precipitation_sum', 'sunshine_hours') THEN greatest(CAST(0.0 AS DOUBLE), y0) ELSE y0 END AS yhat,
         CASE WHEN metric = 'precipitation_sum' THEN greatest(CAST(0.0 AS DOUBLE), y0 - {Z} * sigma)
              WHEN metric = 'temp_avg' THEN y0 - {Z} * sigma END AS yhat_lower,
         CASE WHEN metric = 'precipitation_sum' THEN greatest(CAST(0.0 AS DOUBLE), y0 + {Z} * sigma)
              WHEN metric = 'temp_avg' THEN y0 + {Z} * sigma END AS yhat_upper
  FROM {name}_raw
)"""


def pivot_sql(pred: str, run: str) -> str:
    cols = ",\n       ".join(f"{r2(f'max(CASE WHEN metric = {chr(39)}{m}{chr(39)} THEN yhat END)')} AS {m}"
                            for m in FORECAST_METRICS)
    b = []
    for m in ("temp_avg", "precipitation_sum"):
        for side in ("lower", "upper"):
            b.append(f"{r2(f'max(CASE WHEN metric = {chr(39)}{m}{chr(39)} THEN yhat_{side} END)')} AS {m}_{side}")
    return f"""
SELECT DATE '{run}' AS forecast_run_date, target_date, city_id, horizon_days,
       {cols},
       {", ".join(b)}
FROM {pred} GROUP BY target_date, city_id, horizon_days"""


RUN = "2001-08-02"
HOLD = "2001-07-26"

ORACLE["forecast_linear"] = f"""
WITH {NATION_MART.strip()},
{long_of("long", "nmart", f"date >= DATE '{RUN}' - 730").strip()},
{linear_pred("pred", "long", RUN).strip()}
{pivot_sql("pred", RUN)}"""



def seasonal_pred(name: str, long: str, run: str) -> str:
    """The seasonal model in SQL: normal equations with the ridge on their diagonal, solved by
    Gauss-Jordan elimination (positive definite: no pivoting), all metrics as right-hand sides.

    The 47 columns are a constant, time, 25 hinges and 10 sine and cosine pairs of the year. It
    takes series without gaps between metrics: the days of a place are shared by its metrics.
    """
    metrics = "[" + ", ".join(f"'{m}'" for m in FORECAST_METRICS) + "]"
    feats = """list_concat([CAST(1.0 AS DOUBLE), t],
           list_transform(range(1, 26), lambda j: greatest(CAST(0.0 AS DOUBLE), t - j * (CAST(0.8 AS DOUBLE) / 26))),
           flatten(list_transform(range(1, 11), lambda k: [sin(2.0 * pi() * k * dn / CAST(365.25 AS DOUBLE)),
                                                           cos(2.0 * pi() * k * dn / CAST(365.25 AS DOUBLE))])))"""
    return f"""
{name}_s AS (
  SELECT city_id, metric, list_position({metrics}, metric) AS m, count(*) AS n, avg(y) AS mu,
         CASE WHEN stddev_pop(y) = 0 THEN CAST(1.0 AS DOUBLE) ELSE stddev_pop(y) END AS sd
  FROM {long} GROUP BY 1, 2 HAVING count(*) >= 60
),
{name}_span AS (
  SELECT city_id, min(ds) AS d0, CAST(greatest(date_diff('day', min(ds), max(ds)), 1) AS DOUBLE) AS w FROM {long} GROUP BY 1
),
{name}_x AS (
  SELECT city_id, ds, {feats} AS x, ys FROM (
    SELECT l.city_id, l.ds, CAST(date_diff('day', DATE '1970-01-01', l.ds) AS DOUBLE) AS dn,
           date_diff('day', any_value(p.d0), l.ds) / any_value(p.w) AS t, list((y - mu) / sd ORDER BY m) AS ys
    FROM {long} l JOIN {name}_s s ON s.city_id = l.city_id AND s.metric = l.metric JOIN {name}_span p ON p.city_id = l.city_id
    GROUP BY l.city_id, l.ds) q
),
{name}_a AS (
  SELECT city_id, i, list(v + CASE WHEN i <> j THEN 0 WHEN i <= 2 THEN 1e-8 ELSE 1 END ORDER BY j) AS a FROM (
    SELECT city_id, i, j, sum(x[i] * list_concat(x, ys)[j]) AS v
    FROM {name}_x, unnest(range(1, 48)) AS u(i), unnest(range(1, 56)) AS w(j) GROUP BY 1, 2, 3) e
  GROUP BY 1, 2
),
{name}_g AS (
  SELECT 0 AS step, city_id, i, a FROM {name}_a
  UNION ALL
  SELECT step + 1, city_id, i, CASE WHEN i = step + 1 THEN list_transform(a, lambda v: v / a[step + 1])
         ELSE list_transform(range(1, 56), lambda j: a[j] - a[step + 1] / p[step + 1] * p[j]) END
  FROM (SELECT *, any_value(CASE WHEN i = step + 1 THEN a END) OVER (PARTITION BY city_id) AS p FROM {name}_g) q
  WHERE step < 47
),
{name}_b AS (
  SELECT city_id, m, list(a[47 + m] ORDER BY i) AS beta
  FROM {name}_g, unnest(range(1, 9)) AS u(m) WHERE step = 47 GROUP BY 1, 2
),
{name}_fit AS (
  SELECT b.city_id, s.metric, any_value(b.beta) AS beta, any_value(s.mu) AS mu, any_value(s.sd) AS sd,
         sqrt(sum(pow(x.ys[b.m] - list_dot_product(x.x, b.beta), 2)) / greatest(any_value(s.n) - 2, 1)) * any_value(s.sd) AS sigma
  FROM {name}_b b JOIN {name}_s s ON s.city_id = b.city_id AND s.m = b.m JOIN {name}_x x ON x.city_id = b.city_id
  GROUP BY b.city_id, s.metric
),
{name}_raw AS (
  SELECT f.city_id, f.metric, q.target_date, CAST(q.h AS SMALLINT) AS horizon_days,
         list_dot_product(q.x, f.beta) * f.sd + f.mu AS y0, f.sigma
  FROM {name}_fit f JOIN (
    SELECT city_id, h, target_date, {feats} AS x FROM (
      SELECT city_id, h, DATE '{run}' + CAST(h AS INTEGER) AS target_date,
             CAST(date_diff('day', DATE '1970-01-01', DATE '{run}') + h AS DOUBLE) AS dn,
             (date_diff('day', d0, DATE '{run}') + h) / w AS t
      FROM {name}_span, unnest(range(1, 8)) AS u(h)) r) q ON q.city_id = f.city_id
),
{name} AS (
  SELECT city_id, metric, target_date, horizon_days,
         CASE WHEN metric IN ('precipitation_sum', 'sunshine_hours') THEN greatest(CAST(0.0 AS DOUBLE), y0) ELSE y0 END AS yhat,
         CASE WHEN metric = 'precipitation_sum' THEN greatest(CAST(0.0 AS DOUBLE), y0 - {Z} * sigma)
              WHEN metric = 'temp_avg' THEN y0 - {Z} * sigma END AS yhat_lower,
         CASE WHEN metric = 'precipitation_sum' THEN greatest(CAST(0.0 AS DOUBLE), y0 + {Z} * sigma)
              WHEN metric = 'temp_avg' THEN y0 + {Z} * sigma END AS yhat_upper
  FROM {name}_raw
)"""


ORACLE["forecast_seasonal"] = f"""
WITH RECURSIVE {NATION_MART.strip()},
{long_of("long", "nmart", f"date >= DATE '{RUN}' - 730").strip()},
{seasonal_pred("pred", "long", RUN).strip()}
{pivot_sql("pred", RUN)}"""

ORACLE["forecast_skips"] = f"""
WITH {NATION_MART.strip()},
{long_of("long", "nmart", f"date >= DATE '{RUN}' - 730").strip()},
ok AS (SELECT city_id FROM long GROUP BY city_id, metric HAVING count(*) >= 60),
days AS (SELECT o_custkey, count(DISTINCT CAST(o_orderdate AS DATE)) AS n FROM orders
         WHERE o_orderdate >= DATE '{RUN}' - 730 GROUP BY 1)
SELECT -1 - n_nationkey AS city_id, 0 AS fitted_metrics FROM nation WHERE n_nationkey NOT IN (SELECT city_id FROM ok)
UNION ALL
SELECT c_custkey, 0 FROM customer LEFT JOIN days ON o_custkey = c_custkey WHERE coalesce(n, 0) < 60"""


def r4(expr: str) -> str:
    return f"CAST(round(TRY_CAST({expr} AS DECIMAL(38,12)), 4) AS DOUBLE)"


ORACLE["forecast_accuracy"] = f"""
WITH {NATION_MART.strip()},
{long_of("hist", "nmart", f"date >= DATE '{HOLD}' - 730 AND date < DATE '{HOLD}'").strip()},
{long_of("actual", "nmart", f"date >= DATE '{HOLD}'").strip()},
{linear_pred("pred", "hist", HOLD).strip()}
SELECT p.metric, p.horizon_days, count(*) AS n,
       {r4("avg(abs(p.yhat - a.y))")} AS mae,
       {r4("avg(p.yhat - a.y)")} AS bias,
       {r4("sqrt(avg((p.yhat - a.y) * (p.yhat - a.y)))")} AS rmse,
       {r4("avg(CASE WHEN p.yhat_lower IS NOT NULL THEN CAST(a.y BETWEEN p.yhat_lower AND p.yhat_upper AS DOUBLE) END)")} AS coverage
FROM pred p JOIN actual a ON a.city_id = p.city_id AND a.metric = p.metric AND a.ds = p.target_date
GROUP BY 1, 2"""

ORACLE["forecast_accuracy_seasonal"] = f"""
WITH RECURSIVE {NATION_MART.strip()},
{long_of("hist", "nmart", f"date >= DATE '{HOLD}' - 730 AND date < DATE '{HOLD}'").strip()},
{long_of("actual", "nmart", f"date >= DATE '{HOLD}'").strip()},
{seasonal_pred("pred", "hist", HOLD).strip()}
SELECT p.metric, p.horizon_days, count(*) AS n,
       {r4("avg(abs(p.yhat - a.y))")} AS mae,
       {r4("avg(p.yhat - a.y)")} AS bias,
       {r4("sqrt(avg((p.yhat - a.y) * (p.yhat - a.y)))")} AS rmse,
       {r4("avg(CASE WHEN p.yhat_lower IS NOT NULL THEN CAST(a.y BETWEEN p.yhat_lower AND p.yhat_upper AS DOUBLE) END)")} AS coverage
FROM pred p JOIN actual a ON a.city_id = p.city_id AND a.metric = p.metric AND a.ds = p.target_date
GROUP BY 1, 2"""

ORACLE["latest_run"] = f"""
WITH {NATION_MART.strip()},
{long_of("long", "nmart", f"date >= DATE '{RUN}' - 730").strip()},
{linear_pred("pred", "long", RUN).strip()},
wide AS ({pivot_sql("pred", RUN)})
SELECT * FROM wide ORDER BY target_date, city_id LIMIT 30"""

# -- measures over the per-customer orders mart ---------------------------------
CUSTOMER_MART = f"""
cstage AS ({orders_stage("o.o_custkey")}),
{daily_fact_cte("cfact", stage="cstage", cities="cities").strip()},
{MART_OF.format(name="cmart", src="cfact").strip()}"""

WIDE = f"""
{CONFIG.strip()},
places AS (SELECT f.pos AS id, f.name AS city_name, f.is_capital, f.climate_zone, f.lat AS latitude,
                  f.lon AS longitude, k.id AS country_id
           FROM cfg f LEFT JOIN countries_id k ON k.country_name = f.country),
wide AS (SELECT m.*, p.city_name, p.is_capital, p.climate_zone, p.latitude, p.longitude, k.country_name, k.region
         FROM cmart m LEFT JOIN places p ON p.id = m.city_id LEFT JOIN countries_id k ON k.id = p.country_id)"""


def kpi_cols(prefix: str = "") -> str:
    return f"""
       {r2(f'avg({prefix}temp_avg)')} AS avg_temperature,
       {r2(f'sum({prefix}precipitation_sum)')} AS total_precipitation,
       {r2(f'avg({prefix}pressure_avg)')} AS avg_pressure,
       {r2(f'sum({prefix}sunshine_hours)')} AS sunshine_hours,
       CAST(count(*) FILTER (WHERE {prefix}is_rainy_day) AS BIGINT) AS rainy_days"""


ORACLE["kpi"] = f"""
WITH {CITIES.strip()},{CUSTOMER_MART}
SELECT CAST(year(date) AS INTEGER) AS year,{kpi_cols()}
FROM cmart GROUP BY 1"""

KPIS = ["avg_temperature", "total_precipitation", "avg_pressure", "sunshine_hours", "rainy_days"]
ORACLE["kpi_yoy"] = f"""
WITH {CITIES.strip()},{CUSTOMER_MART},
y AS (SELECT year(date) AS year,{kpi_cols()} FROM cmart GROUP BY 1),
spine AS (SELECT CAST(unnest(generate_series(min(year), max(year))) AS INTEGER) AS year FROM y),
f AS (SELECT s.year, {", ".join("y." + k for k in KPIS)} FROM spine s LEFT JOIN y ON y.year = s.year),
l AS (SELECT *, {", ".join(f"lag({k}) OVER (ORDER BY year) AS prev_{k}" for k in KPIS)} FROM f)
SELECT *, {", ".join((f"{r2(f'{k} - prev_{k}')} AS delta_{k}" if k != "rainy_days" else f"{k} - prev_{k} AS delta_{k}") for k in KPIS)}
FROM l"""

ORACLE["period_compare"] = f"""
WITH {CITIES.strip()},{CUSTOMER_MART},
p AS (SELECT CAST(date_trunc('quarter', date) AS DATE) AS period, {r2('avg(temp_avg)')} AS value FROM cmart GROUP BY 1),
spine AS (SELECT CAST(unnest(generate_series(min(period), max(period), INTERVAL 3 MONTH)) AS DATE) AS period FROM p),
f AS (SELECT s.period, p.value, lag(p.value) OVER (ORDER BY s.period) AS prev_value
      FROM spine s LEFT JOIN p ON p.period = s.period)
SELECT period, value, prev_value, {r2('value - prev_value')} AS delta FROM f"""

ORACLE["period_compare_by_city"] = f"""
WITH {CITIES.strip()},{CUSTOMER_MART},
p AS (SELECT city_id, CAST(date_trunc('year', date) AS DATE) AS period, {r2('sum(precipitation_sum)')} AS value
      FROM cmart GROUP BY 1, 2),
sp AS (SELECT city_id, min(period) AS a, max(period) AS b FROM p GROUP BY 1),
spine AS (SELECT city_id, CAST(unnest(generate_series(a, b, INTERVAL 1 YEAR)) AS DATE) AS period FROM sp),
f AS (SELECT s.city_id, s.period, p.value,
             lag(p.value) OVER (PARTITION BY s.city_id ORDER BY s.period) AS prev_value
      FROM spine s LEFT JOIN p ON p.city_id = s.city_id AND p.period = s.period)
SELECT city_id, period, value, prev_value, {r2('value - prev_value')} AS delta FROM f"""

PCT = lambda c: r2(f"100.0 * avg(CAST({c} AS DOUBLE))")
ORACLE["extreme_ranking"] = f"""
WITH {CITIES.strip()},{CUSTOMER_MART},{WIDE},
r AS (
  SELECT CASE grouping(region, country_name, city_name) WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 3 THEN 2 ELSE 3 END AS level,
         region, country_name, city_name,
         {PCT('is_hot_day')} AS hot_pct, {PCT('is_frost_day')} AS frost_pct, {PCT('is_rainy_day')} AS rainy_pct,
         max(temp_max) AS max_temp, min(temp_min) AS min_temp, max(wind_gusts_max) AS max_gusts
  FROM wide GROUP BY ROLLUP (region, country_name, city_name)
)
SELECT *, CAST(rank() OVER (PARTITION BY level ORDER BY hot_pct DESC NULLS LAST) AS INTEGER) AS rank FROM r"""

CLIMATE_CASE = ("CASE upper(trim(climate_zone)) " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in CLIMATE_GROUPS.items())
    + " END")

ORACLE["climate_scatter"] = f"""
WITH {CITIES.strip()},{CUSTOMER_MART},{WIDE}
SELECT city_name, climate_zone, {r2('avg(temp_avg)')} AS avg_temperature,
       {r2('sum(precipitation_sum)')} AS total_precipitation, {r2('avg(humidity_avg)')} AS avg_humidity,
       {CLIMATE_CASE} AS climate_group
FROM wide GROUP BY city_name, climate_zone"""

ORACLE["map_values"] = f"""
WITH {CITIES.strip()},{CUSTOMER_MART},{WIDE}
SELECT city_name, latitude, longitude, {r2('sum(precipitation_sum)')} AS value
FROM wide WHERE coalesce(is_capital, false) AND date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'
GROUP BY city_name, latitude, longitude"""

# -- payloads, responses, stream -------------------------------------------------
ORACLE["payload_explode"] = f"""
WITH {STAGE}
SELECT location_name, CAST(NULL AS VARCHAR) AS country,
       first_value(latitude) OVER w AS latitude, first_value(longitude) OVER w AS longitude,
       first_value(elevation_m) OVER w AS elevation_m, first_value(timezone) OVER w AS timezone,
       CAST(date_trunc('minute', measured_at) AS TIMESTAMP) AS measured_at,
       temperature_2m, relative_humidity_2m, precipitation, wind_direction_10m,
       CAST(weather_code AS SMALLINT) AS weather_code, is_day
FROM stage
WINDOW w AS (PARTITION BY location_name, date_trunc('week', measured_at) ORDER BY event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""

ORACLE["payload_failed"] = f"""
WITH {STAGE},
docs AS (SELECT location_name, min(event_id) % 5 AS kind FROM stage GROUP BY location_name, date_trunc('week', measured_at))
SELECT CASE WHEN kind IN (2, 4) THEN 'unknown' ELSE location_name END AS city_name,
       CASE kind WHEN 1 THEN 'arrays of unequal length' WHEN 2 THEN 'unreadable document' WHEN 3 THEN 'unreadable time'
                 ELSE 'no place name' END AS error,
       count(*) AS n_documents
FROM docs WHERE kind IN (1, 2, 3, 4) GROUP BY 1, 2"""

ORACLE["slice_latest_wins"] = f"""
WITH {STAGE}
SELECT location_name, measured_at,
       CASE WHEN CAST(right(location_name, 1) AS INTEGER) % 2 = 0 THEN temperature_2m + 10 ELSE temperature_2m END AS temperature_2m,
       precipitation, weather_code, event_id FROM stage"""

BODY_CASE = "CASE event_type " + " ".join(f"WHEN {_sql_lit(k)} THEN {_sql_lit(v)}" for k, v in RESPONSE_BODIES.items()) + " END"
ORACLE["daily_limit_filter"] = f"""
WITH r AS (SELECT event_id AS id, 400 + {K} AS status, {BODY_CASE} AS body FROM events),
t AS (SELECT *, lower(CASE WHEN ltrim(body) LIKE '{{%' AND json_valid(body)
                           THEN coalesce(json_extract_string(body, '$.reason'), '')
                           ELSE coalesce(body, '') END) AS txt FROM r)
SELECT id, status, body FROM t
WHERE status BETWEEN 400 AND 499 AND contains(txt, 'daily') AND (contains(txt, 'limit') OR contains(txt, 'exceeded'))"""

ORACLE["stream_ingest"] = f"""
WITH {STAGE}
SELECT location_name, measured_at, temperature_2m, precipitation, weather_code, event_id FROM stage"""

ORACLE["hours_per_day"] = f"""
WITH {STAGE}
SELECT location_name AS city_name, CAST(measured_at AS DATE) AS day, count(*) AS n_rows, 24 AS expected_rows
FROM stage GROUP BY 1, 2 HAVING count(*) <> 24"""

ORACLE["gap_view_sql"] = f"""WITH {GAPS.strip()}
SELECT missing_date, count(*) AS n_gaps, count(DISTINCT city_name) AS n_places
FROM gaps WHERE layer = 'core' GROUP BY missing_date"""

ORACLE["forecast_linear_last_obs"] = f"""
WITH {NATION_MART.strip()},
{long_of("long", "nmart", f"date >= DATE '{RUN}' - 730").strip()},
{linear_pred("pred", "long", RUN, last_obs=True).strip()}
{pivot_sql("pred", RUN)}"""

ORACLE["mart_window"] = f"""
WITH {STAGE},{CITIES},{daily_fact_cte()}, {SEED},{CAL_DAYS},
mart AS ({MART_SELECT})
SELECT * FROM mart WHERE date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'"""

ORACLE["active_places"] = """
SELECT c_name AS name, n_name AS country, c_custkey AS pos
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey WHERE c_acctbal > 0"""

ORACLE["kpi_period"] = f"""
WITH {CITIES.strip()},{CUSTOMER_MART},
a AS (SELECT {kpi_cols()} FROM cmart WHERE date BETWEEN DATE '2000-03-01' AND DATE '2000-08-31'),
b AS (SELECT {kpi_cols()} FROM cmart WHERE date BETWEEN DATE '1999-03-01' AND DATE '1999-08-31')
SELECT {", ".join(f"a.{k}, b.{k} AS prev_{k}" for k in KPIS)},
       {", ".join((f"{r2(f'a.{k} - b.{k}')} AS delta_{k}" if k != "rainy_days" else f"a.{k} - b.{k} AS delta_{k}") for k in KPIS)}
FROM a, b"""

ORACLE["months_fully_loaded"] = """
WITH d AS (SELECT DISTINCT o_orderstatus AS key, CAST(o_orderdate AS DATE) AS day FROM orders),
m AS (SELECT key, CAST(date_trunc('month', day) AS DATE) AS start, count(*) AS n FROM d GROUP BY 1, 2)
SELECT key, start, last_day(start) AS "end" FROM m WHERE n = day(last_day(start))"""

ORACLE["forecast_history"] = """
WITH d AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day,
                  CAST(round(sum(CAST(CASE WHEN o_orderstatus = 'F' THEN o_totalprice / 50000 ELSE 0.0 END AS DOUBLE)), 2) AS DOUBLE) AS rain
           FROM orders WHERE o_orderdate >= DATE '2000-01-01' GROUP BY 1, 2)
SELECT c_custkey AS city_id, c_name AS city_name, count(*) AS n_days, min(day) AS first_day, max(day) AS last_day,
       max(rain) AS most_rain
FROM d JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2"""

ORACLE["forecast_rerun"] = ORACLE["forecast_linear"]


# -- sparse trend changes: elimination, then coordinate descent, one coordinate a step -----------
def d(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def sparse_pred(name: str, long: str, run: str) -> str:
    """60 sweeps over 25 hinges (lasso 1), after constant, time and 10 yearly pairs (ridge 1) are eliminated.

    It takes series without gaps between metrics, as the seasonal model above.
    """
    feats = f"""list_concat([{d(1.0)}, t],
           list_transform(range(1, 26), lambda j: greatest({d(0.0)}, t - j * ({d(0.8)} / 26))),
           flatten(list_transform(range(1, 11), lambda k: [sin(2.0 * pi() * k * dn / {d(365.25)}),
                                                           cos(2.0 * pi() * k * dn / {d(365.25)})])))"""
    return f"""
{name}_s AS (
  SELECT city_id, metric, count(*) AS n, avg(y) AS mu,
         CASE WHEN stddev_pop(y) = 0 THEN {d(1.0)} ELSE stddev_pop(y) END AS sd
  FROM {long} GROUP BY 1, 2 HAVING count(*) >= 60
),
{name}_span AS (
  SELECT city_id, min(ds) AS d0, CAST(greatest(date_diff('day', min(ds), max(ds)), 1) AS DOUBLE) AS w FROM {long} GROUP BY 1
),
{name}_x AS MATERIALIZED (
  SELECT city_id, ds, {feats} AS x FROM (
    SELECT l.city_id, l.ds, CAST(date_diff('day', DATE '1970-01-01', l.ds) AS DOUBLE) AS dn,
           date_diff('day', p.d0, l.ds) / p.w AS t
    FROM (SELECT DISTINCT city_id, ds FROM {long}) l JOIN {name}_span p ON p.city_id = l.city_id) q
),
{name}_a AS (
  SELECT city_id, metric, i, list_append(g, c) AS a FROM (
    SELECT city_id, i, list(v + CASE WHEN i <> j OR i BETWEEN 3 AND 27 THEN {d(0.0)} WHEN i <= 2 THEN {d(1e-8)} ELSE {d(1.0)} END
                            ORDER BY j) AS g
    FROM (SELECT city_id, i, j, sum(x[i] * x[j]) AS v FROM {name}_x, unnest(range(1, 48)) AS u(i), unnest(range(1, 48)) AS w(j)
          GROUP BY 1, 2, 3) e GROUP BY 1, 2) m
  JOIN (SELECT x.city_id, s.metric, i, sum(x.x[i] * ((l.y - s.mu) / s.sd)) AS c
        FROM {name}_x x JOIN {long} l ON l.city_id = x.city_id AND l.ds = x.ds
        JOIN {name}_s s ON s.city_id = l.city_id AND s.metric = l.metric, unnest(range(1, 48)) AS u(i) GROUP BY 1, 2, 3) r
  USING (city_id, i)
),
{name}_g AS (
  SELECT 0 AS step, 1 AS p, city_id, metric, i, a FROM {name}_a
  UNION ALL
  SELECT step + 1, CASE WHEN p = 2 THEN 28 ELSE p + 1 END, city_id, metric, i,
         CASE WHEN i = p THEN list_transform(a, lambda v: v / a[p])
              ELSE list_transform(range(1, 49), lambda j: a[j] - a[p] / r[p] * r[j]) END
  FROM (SELECT *, any_value(CASE WHEN i = p THEN a END) OVER (PARTITION BY city_id, metric) AS r FROM {name}_g) q
  WHERE step < 22
),
{name}_e AS MATERIALIZED (SELECT city_id, metric, i, a[3:27] AS g, a[48] AS c FROM {name}_g WHERE step = 22),
{name}_cd AS (
  SELECT 0 AS step, city_id, metric, list_transform(range(1, 26), lambda k: {d(0.0)}) AS b FROM {name}_e WHERE i = 1
  UNION ALL
  SELECT step + 1, city_id, metric, list_concat(b[1:j - 1], [sign(r) * greatest(abs(r) - {d(1.0)}, {d(0.0)}) / gjj], b[j + 1:])
  FROM (SELECT a.step, a.city_id, a.metric, a.b, m.i - 2 AS j, m.g[m.i - 2] AS gjj,
               m.c - list_dot_product(m.g, a.b) + m.g[m.i - 2] * a.b[m.i - 2] AS r
        FROM {name}_cd a JOIN {name}_e m ON m.city_id = a.city_id AND m.metric = a.metric AND m.i = a.step % 25 + 3
        WHERE a.step < 25 * 60) q
),
{name}_b AS MATERIALIZED (
  SELECT e.city_id, e.metric, list(CASE WHEN i BETWEEN 3 AND 27 THEN b[i - 2] ELSE c - list_dot_product(g, b) END ORDER BY i) AS b
  FROM {name}_e e JOIN {name}_cd h ON h.city_id = e.city_id AND h.metric = e.metric AND step = 25 * 60 GROUP BY 1, 2
),
{name}_fit AS (
  SELECT b.city_id, b.metric, any_value(b.b) AS b, any_value(s.mu) AS mu, any_value(s.sd) AS sd,
         sqrt(sum(pow((l.y - s.mu) / s.sd - list_dot_product(x.x, b.b), 2)) / greatest(any_value(s.n) - 2, 1)) * any_value(s.sd) AS sigma
  FROM {name}_b b JOIN {name}_s s ON s.city_id = b.city_id AND s.metric = b.metric
  JOIN {long} l ON l.city_id = b.city_id AND l.metric = b.metric JOIN {name}_x x ON x.city_id = l.city_id AND x.ds = l.ds
  GROUP BY 1, 2
),
{name} AS (
  SELECT f.city_id, f.metric, q.target_date, CAST(q.h AS SMALLINT) AS horizon_days,
         CASE WHEN f.metric IN ('precipitation_sum', 'sunshine_hours')
              THEN greatest({d(0.0)}, list_dot_product(q.x, f.b) * f.sd + f.mu) ELSE list_dot_product(q.x, f.b) * f.sd + f.mu END AS yhat,
         f.sigma, CAST(len(list_filter(f.b[3:27], lambda v: v <> 0)) AS INTEGER) AS n_active,
         list_avg(list_transform(f.b[3:27], lambda v: abs(v))) * f.sd AS change_scale, q.w AS span
  FROM {name}_fit f JOIN (
    SELECT city_id, h, w, target_date, {feats} AS x FROM (
      SELECT city_id, h, w, DATE '{run}' + CAST(h AS INTEGER) AS target_date,
             CAST(date_diff('day', DATE '1970-01-01', DATE '{run}') + h AS DOUBLE) AS dn,
             (date_diff('day', d0, DATE '{run}') + h) / w AS t
      FROM {name}_span, unnest(range(1, 8)) AS u(h)) r) q ON q.city_id = f.city_id
)"""


ORACLE["forecast_sparse_trend"] = f"""
WITH RECURSIVE {NATION_MART.strip()},
{long_of("long", "nmart", f"date >= DATE '{RUN}' - 730").strip()},
{sparse_pred("pred", "long", RUN).strip()}
SELECT city_id, metric, target_date, horizon_days, {r2("yhat")} AS yhat, n_active, 'ok' AS status FROM pred"""


def simulated_sql(name: str, pred: str) -> str:
    """200 draws a series and day; the uniforms are 32-bit pieces of md5('place:metric:draw:day')."""
    def u(k: int, day: str) -> str:
        return (f"((('0x' || substr(md5(city_id || ':' || metric || ':' || s || ':' || {day}), {1 + 8 * k}, 8))::BIGINT)::DOUBLE + 0.5)"
                f" / {d(2.0 ** 32)}")

    clamp = "CASE WHEN metric = 'precipitation_sum' THEN greatest({z}, {v}) ELSE {v} END"
    return f"""
{name}_draws AS (
  SELECT p.*, s FROM {pred} p, unnest(range(1, 201)) AS v(s) WHERE metric IN ('temp_avg', 'precipitation_sum')
),
{name}_changes AS (
  SELECT city_id, metric, s, day, CASE WHEN {u(0, "day")} < {d(25 / 0.8)} / span
         THEN -change_scale * sign({u(1, "day")} - 0.5) * ln(1 - 2 * abs({u(1, "day")} - 0.5)) ELSE {d(0.0)} END AS change
  FROM {name}_draws, unnest(range(1, 8)) AS v(day) WHERE horizon_days = 7
),
{name}_y AS (
  SELECT p.city_id, p.metric, p.target_date, p.horizon_days, p.yhat, p.sigma, p.s,
         p.yhat + sum(c.change * (p.horizon_days - c.day + 1) / p.span)
         + any_value(p.sigma * sqrt(-2 * ln({u(2, "p.horizon_days").replace("city_id", "p.city_id").replace("metric", "p.metric").replace("|| s ||", "|| p.s ||")}))
                     * cos(2 * pi() * {u(3, "p.horizon_days").replace("city_id", "p.city_id").replace("metric", "p.metric").replace("|| s ||", "|| p.s ||")})) AS y
  FROM {name}_draws p JOIN {name}_changes c ON c.city_id = p.city_id AND c.metric = p.metric AND c.s = p.s AND c.day <= p.horizon_days
  GROUP BY 1, 2, 3, 4, 5, 6, 7, p.span
),
{name}_q AS (
  SELECT city_id, metric, target_date, horizon_days, yhat, sigma, quantile_cont(y, {d(0.1)}) AS q0, quantile_cont(y, {d(0.9)}) AS q1
  FROM {name}_y GROUP BY 1, 2, 3, 4, 5, 6
),
{name} AS (
  SELECT city_id, metric, target_date, horizon_days, yhat,
         {clamp.format(z=d(0.0), v="q0")} AS sim_lower, {clamp.format(z=d(0.0), v="q1")} AS sim_upper,
         {clamp.format(z=d(0.0), v=f"(yhat - {Z} * sigma)")} AS yhat_lower, {clamp.format(z=d(0.0), v=f"(yhat + {Z} * sigma)")} AS yhat_upper
  FROM {name}_q
)"""


_BAND = ("yhat", "sim_lower", "sim_upper", "yhat_lower", "yhat_upper")
ORACLE["forecast_simulated_band"] = f"""
WITH RECURSIVE {NATION_MART.strip()},
{long_of("all_long", "nmart", f"date >= DATE '{RUN}' - 730 AND date < DATE '{RUN}'").strip()},
long AS (SELECT * FROM all_long WHERE metric IN ('temp_avg', 'precipitation_sum')),
{sparse_pred("pred", "long", RUN).strip()},
{simulated_sql("band", "pred").strip()}
SELECT city_id, metric, target_date, horizon_days, {", ".join(f"{r2(c)} AS {c}" for c in _BAND)} FROM band"""

ORACLE["forecast_band_coverage"] = f"""
WITH RECURSIVE {NATION_MART.strip()},
{long_of("all_long", "nmart", f"date >= DATE '{HOLD}' - 730 AND date < DATE '{HOLD}'").strip()},
{long_of("actual", "nmart", f"date >= DATE '{HOLD}'").strip()},
long AS (SELECT * FROM all_long WHERE metric IN ('temp_avg', 'precipitation_sum')),
{sparse_pred("pred", "long", HOLD).strip()},
{simulated_sql("band", "pred").strip()}
SELECT b.metric, b.horizon_days, count(*) AS n,
       {r4("avg(CAST(a.y BETWEEN sim_lower AND sim_upper AS DOUBLE))")} AS sim_coverage,
       {r4("avg(CAST(a.y BETWEEN yhat_lower AND yhat_upper AS DOUBLE))")} AS yhat_coverage,
       {r4("avg(sim_upper - sim_lower)")} AS sim_width, {r4("avg(yhat_upper - yhat_lower)")} AS yhat_width
FROM band b JOIN actual a ON a.city_id = b.city_id AND a.metric = b.metric AND a.ds = b.target_date GROUP BY 1, 2"""

# every run of the back test is fitted on its own here
ORACLE["forecast_backtest"] = f"""
WITH {NATION_MART.strip()},
{long_of("long", "nmart", "true").strip()},
runs AS (SELECT CAST(unnest(generate_series(TIMESTAMP '2000-07-20', TIMESTAMP '{HOLD}', INTERVAL 7 DAY)) AS DATE) AS origin),
fits AS (
  SELECT city_id, metric, origin, count(*) AS n, regr_slope(y, x) AS b, regr_intercept(y, x) AS a,
         sqrt(greatest(regr_syy(y, x) - regr_sxy(y, x) * regr_sxy(y, x) / regr_sxx(y, x), 0.0) / (count(*) - 2)) AS sigma
  FROM (SELECT city_id, metric, origin, y, CAST(date_diff('day', DATE '{HOLD}', ds) AS DOUBLE) AS x
        FROM long JOIN runs ON ds >= origin - 730 AND ds < origin) t
  GROUP BY 1, 2, 3 HAVING count(*) >= 60
),
scored AS (
  SELECT l.metric, CAST(date_diff('day', origin, ds) AS SMALLINT) AS horizon_days, origin, y,
         a + b * CAST(date_diff('day', DATE '{HOLD}', ds) AS DOUBLE) AS line, sigma
  FROM long l JOIN fits f ON f.city_id = l.city_id AND f.metric = l.metric AND ds > origin AND ds <= origin + 7
),
p AS (
  SELECT *, CASE WHEN metric IN ('precipitation_sum', 'sunshine_hours') THEN greatest({d(0.0)}, line) ELSE line END AS yhat,
         CASE WHEN metric = 'precipitation_sum' THEN greatest({d(0.0)}, line - {Z} * sigma) ELSE line - {Z} * sigma END AS low,
         CASE WHEN metric = 'precipitation_sum' THEN greatest({d(0.0)}, line + {Z} * sigma) ELSE line + {Z} * sigma END AS high
  FROM scored
)
SELECT metric, horizon_days, count(*) AS n, count(DISTINCT origin) AS n_origins,
       {r4("avg(abs(yhat - y))")} AS mae, {r4("avg(yhat - y)")} AS bias, {r4("sqrt(avg((yhat - y) * (yhat - y)))")} AS rmse,
       {r4("avg(CASE WHEN metric IN ('temp_avg', 'precipitation_sum') THEN CAST(y BETWEEN low AND high AS DOUBLE) END)")} AS coverage
FROM p GROUP BY 1, 2"""

# -- day bitmaps, isolated repair, corrections ----------------------------------------------------
_PARTIAL = "(o_orderdate < TIMESTAMP '2000-01-01' OR o_orderstatus = 'F')"
ORACLE["layer_gap_bitmaps"] = f"""
WITH stage AS (SELECT CAST(o_custkey AS VARCHAR) AS place, CAST(o_orderdate AS DATE) AS missing_date FROM orders),
core AS (SELECT CAST(o_custkey AS VARCHAR) AS place, CAST(o_orderdate AS DATE) AS missing_date FROM orders WHERE {_PARTIAL}),
mart AS (SELECT * FROM core WHERE missing_date < DATE '2001-01-01')
SELECT 'core' AS step, * FROM (SELECT * FROM stage EXCEPT SELECT * FROM core)
UNION ALL SELECT 'mart' AS step, * FROM (SELECT * FROM core EXCEPT SELECT * FROM mart)"""

ORACLE["repair_report"] = f"""
WITH o AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, year(o_orderdate) * 100 + month(o_orderdate) AS ym, {_PARTIAL} AS held
           FROM orders),
gaps AS (SELECT DISTINCT CAST(year(day) * 100 + month(day) AS INTEGER) AS ym, CAST(date_trunc('month', day) AS DATE) AS start_date
         FROM (SELECT o_custkey, day FROM o EXCEPT SELECT o_custkey, day FROM o WHERE held)),
w AS (SELECT ym, start_date, least(last_day(start_date), DATE '2001-07-31') AS end_date FROM gaps),
after AS (SELECT w.ym, o_custkey, day, count(*) AS n FROM o JOIN w ON o.ym = w.ym
          WHERE CASE WHEN w.ym = 200005 OR day > w.end_date THEN held ELSE true END GROUP BY 1, 2, 3)
SELECT w.ym, w.start_date, w.end_date, CASE WHEN w.ym = 200005 THEN 'failed' ELSE 'repaired' END AS status,
       CASE WHEN w.ym = 200005 THEN 'ValueError: source not available' END AS error_msg,
       any_value(a.n_rows) AS n_rows, any_value(a.n_orders) AS n_orders
FROM w LEFT JOIN (SELECT ym, count(*) AS n_rows, CAST(sum(n) AS BIGINT) AS n_orders FROM after GROUP BY 1) a ON a.ym = w.ym
WHERE start_date <= end_date GROUP BY 1, 2, 3, 4, 5"""

# the newest version of a place's day: 3 for even numbers, 2 for odd multiples of three, else 1
ORACLE["stream_corrections"] = f"""
WITH v AS (SELECT * REPLACE (value + 10 * (version - 1) AS value) FROM (
  SELECT *, CAST(CASE WHEN user_id % 2 = 0 THEN 3 WHEN user_id % 3 = 0 THEN 2 ELSE 1 END AS BIGINT) AS version FROM events)),
{STAGE.replace("FROM events", "FROM v").replace("         event_id", "         event_id, version")}
SELECT location_name, measured_at, temperature_2m, precipitation, weather_code, event_id, version FROM stage"""

# -- general range join, checked writes ------------------------------------------------------------
ORACLE["range_join_binned"] = f"""
WITH b AS (SELECT s_suppkey, s_acctbal * 20 AS low, s_acctbal * 20 + pow({d(10.0)}, s_suppkey % 5) * 4 + 1 AS high FROM supplier)
SELECT s_suppkey, count(*) AS n_orders, {r2("sum(o_totalprice)")} AS total, min(o_orderkey) AS first_order
FROM orders JOIN b ON o_totalprice BETWEEN low AND high GROUP BY 1"""

ORACLE["checked_write"] = f"""
WITH l AS (SELECT l_quantity, coalesce(l_quantity > 45, false) AS a, coalesce(l_discount > {d(0.08)}, false) AS b,
                  l_returnflag IS NULL AS c, coalesce(l_returnflag NOT IN ('R', 'A'), false) AS e FROM lineitem),
n AS (SELECT *, a OR b OR c OR e AS bad FROM l)
SELECT 'rows' AS what, count(*) AS n_rows, CAST(NULL AS DOUBLE) AS quantity FROM n
UNION ALL SELECT 'quarantined', count(*) FILTER (WHERE bad), NULL FROM n
UNION ALL SELECT 'quantity_range', count(*) FILTER (WHERE a), NULL FROM n
UNION ALL SELECT 'discount_range', count(*) FILTER (WHERE b), NULL FROM n
UNION ALL SELECT 'flag_not_null', count(*) FILTER (WHERE c), NULL FROM n
UNION ALL SELECT 'flag_in', count(*) FILTER (WHERE e), NULL FROM n
UNION ALL SELECT 'sound rows', count(*), {r2("sum(l_quantity)")} FROM n WHERE NOT bad
UNION ALL SELECT 'quarantined rows', count(*), {r2("sum(l_quantity)")} FROM n WHERE bad"""

# -- dashboards from monthly states, slicers, bounded and bucketed tables, open payloads -----------
ORACLE["kpi_from_partials"] = ORACLE["kpi_yoy"]
ORACLE["map_from_partials"] = ORACLE["map_values"]
ORACLE["ranking_sliced"] = f"""
WITH {CITIES.strip()},{CUSTOMER_MART},{WIDE},
s AS (SELECT * FROM wide WHERE date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' AND region = 'AUTOMOBILE'
      AND {CLIMATE_CASE} = 'Temperate'),
r AS (
  SELECT CASE grouping(region, country_name, city_name) WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 3 THEN 2 ELSE 3 END AS level,
         region, country_name, city_name,
         {PCT('is_hot_day')} AS hot_pct, {PCT('is_frost_day')} AS frost_pct, {PCT('is_rainy_day')} AS rainy_pct,
         max(temp_max) AS max_temp, min(temp_min) AS min_temp, max(wind_gusts_max) AS max_gusts
  FROM s GROUP BY ROLLUP (region, country_name, city_name)
)
SELECT *, CAST(rank() OVER (PARTITION BY level ORDER BY frost_pct DESC NULLS LAST) AS INTEGER) AS rank FROM r"""

ORACLE["partition_report"] = f"""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, c_nationkey, count(*) AS n_rows, CAST(min(o_orderdate) AS DATE) AS first_day,
       CAST(max(o_orderdate) AS DATE) AS last_day, {r2("sum(o_totalprice)")} AS total
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2"""

ORACLE["payload_variant"] = """
SELECT 'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS location_name, CAST(ts AS DATE) AS day, count(*) AS n_hours,
       count(value) AS n_uv, max(value / 50) AS max_uv, min(value / 50) AS min_uv,
       count(event_type) FILTER (WHERE event_id % 2 = 0) AS n_notes, max(event_type) FILTER (WHERE event_id % 2 = 0) AS last_note
FROM events WHERE user_id % 7 <> 3 GROUP BY 1, 2"""
