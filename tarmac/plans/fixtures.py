"""Flight tables derived from the test tables, in SQL both engines read alike.

Only integer arithmetic is used, so Spark and the oracle engine build the same rows.
(`||` rather than `concat` where a part may be NULL: the engines differ on the latter.)
Placeholders: `{lineitem}` and the like for tables, `{date}` for the dialect's way of
adding days to a date.
"""

from __future__ import annotations

SPARK_DATE = "date_add(DATE '2023-01-01', day_off)"
DUCKDB_DATE = "DATE '2023-01-01' + day_off"
TABLES = ("lineitem", "orders", "supplier", "customer", "part")

FLIGHTS_BASE = """
  SELECT l_orderkey AS ok, l_linenumber AS ln, l_partkey AS pk, l_suppkey AS sk,
         CAST(s_nationkey % 9 AS INT) AS oi, CAST(c_nationkey % 9 AS INT) AS di,
         CAST((l_orderkey * 11 + l_linenumber * 3) % 365 AS INT) AS day_off,
         l_orderkey % 33 = 0 AS cancelled,
         l_orderkey % 97 = 1 AND l_orderkey % 33 <> 0 AS diverted,
         CAST((l_partkey * 37 + l_orderkey * 11) % 1440 AS INT) AS dm,
         CAST((l_partkey * 31 + l_orderkey * 7 + l_linenumber * 13) % 240 - 40 AS INT) AS d0
  FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
  JOIN {supplier} ON l_suppkey = s_suppkey JOIN {customer} ON o_custkey = c_custkey
  WHERE s_nationkey % 9 <> c_nationkey % 9
"""

FLIGHTS_TIMED = """timed AS (
  SELECT *, CASE WHEN cancelled OR diverted THEN NULL ELSE d0 END AS arr,
         (NOT cancelled AND NOT diverted AND d0 >= 15 AND ok % 10 <> 0) AS has_cause,
         CAST((dm + 150) % 1440 AS INT) AS am
  FROM base
)
SELECT ok * 1000000 + pk * 10 + ln AS id, {date} AS flight_date,
  CASE WHEN sk % 10 = 9 THEN 'ZZ'
       ELSE substr('AAASB6DLF9G4HANKUA', CAST(1 + 2 * (sk % 10) AS INT), 2) END AS airline_code,
  CAST(100 + pk % 900 AS STRING) AS flight_number,
  substr('ATLDFWJFKLAXORDDCADENBOSXXX', 1 + 3 * oi, 3) AS origin,
  substr('ATLDFWJFKLAXORDDCADENBOSXXX', 1 + 3 * di, 3) AS destination,
  CASE WHEN cancelled THEN NULL ELSE concat(
    lpad(CAST(CAST(floor(dm / 60) AS INT) AS STRING), 2, '0'), ':',
    lpad(CAST(dm % 60 AS STRING), 2, '0'), ':00') END AS dep_time,
  CASE WHEN cancelled THEN NULL ELSE CAST(d0 - 5 + ln AS INT) END AS dep_delay_min,
  CASE WHEN cancelled OR diverted THEN NULL ELSE concat(
    lpad(CAST(CAST(floor(am / 60) AS INT) AS STRING), 2, '0'), ':',
    lpad(CAST(am % 60 AS STRING), 2, '0'), ':00') END AS arr_time,
  arr AS arr_delay_min, cancelled, diverted,
  CASE WHEN ok % 41 = 0 THEN NULL
       ELSE CAST(100 + (oi * 211 + di * 211) % 2400 AS INT) END AS distance_miles,
  CASE WHEN has_cause THEN CAST(arr - arr % 5 - arr % 7 - arr % 11
       - CASE WHEN ln = 1 THEN 1 ELSE 0 END AS INT) END AS carrier_delay,
  CASE WHEN has_cause THEN CAST(arr % 5 AS INT) END AS weather_delay,
  CASE WHEN has_cause THEN CAST(arr % 7 AS INT) END AS nas_delay,
  CASE WHEN has_cause THEN CAST(CASE WHEN ln = 1 THEN 1 ELSE 0 END AS INT) END AS security_delay,
  CASE WHEN has_cause THEN CAST(arr % 11 AS INT) END AS late_aircraft_delay
FROM timed
"""

FLIGHTS = f"\nWITH base AS ({FLIGHTS_BASE}), {FLIGHTS_TIMED}"

# The joins of FLIGHTS_BASE in the order that moves the fewest rows: orders meet customers before
# the lines, which are then shuffled once at most beside the small suppliers.
JOINS = FLIGHTS_BASE[FLIGHTS_BASE.index("{lineitem} JOIN"):FLIGHTS_BASE.index("  WHERE")]
SPARK_JOINS = """{lineitem} JOIN {supplier} ON l_suppkey = s_suppkey JOIN (
    SELECT o_orderkey, c_nationkey FROM {orders} JOIN {customer} ON o_custkey = c_custkey
  ) ON l_orderkey = o_orderkey
"""

AIRPORTS = """
SELECT * FROM (VALUES
  ('ATL','Hartsfield Jackson Atlanta International','Atlanta','US',CAST(-84.4281 AS DOUBLE),CAST(33.6367 AS DOUBLE),1026),
  ('DFW','Dallas Fort Worth International','Dallas','US',CAST(-97.0380 AS DOUBLE),CAST(32.8968 AS DOUBLE),607),
  ('JFK','John F Kennedy International','New York','US',CAST(-73.7789 AS DOUBLE),CAST(40.6398 AS DOUBLE),13),
  ('LAX','Los Angeles International','Los Angeles','US',CAST(-118.4081 AS DOUBLE),CAST(33.9425 AS DOUBLE),125),
  ('ORD','Chicago O Hare International','Chicago','US',CAST(-87.9048 AS DOUBLE),CAST(41.9786 AS DOUBLE),672),
  ('DCA','Ronald Reagan Washington National',NULL,'US',CAST(-77.0377 AS DOUBLE),CAST(38.8521 AS DOUBLE),15),
  ('DEN','Denver International','Denver','US',CAST(NULL AS DOUBLE),CAST(NULL AS DOUBLE),5431),
  ('BOS','Logan International','Boston','US',CAST(-71.0052 AS DOUBLE),CAST(42.3643 AS DOUBLE),20),
  ('YYZ','Toronto Pearson International','Toronto','CA',CAST(-79.6306 AS DOUBLE),CAST(43.6772 AS DOUBLE),569)
) AS t(iata_code, name, city, country, lon, lat, elevation_ft)
"""

AIRLINES = """
SELECT * FROM (VALUES
  ('AA','American Airlines','US'),('AS','Alaska Airlines','US'),('B6','JetBlue Airways','US'),
  ('DL','Delta Air Lines','US'),('F9','Frontier Airlines','US'),('G4','Allegiant Air','US'),
  ('HA','Hawaiian Airlines','US'),('NK','Spirit Airlines','US'),('UA','United Airlines','US')
) AS t(iata_code, name, country)
"""

# Every row of `flights`, plus repeats of about one row in fifty and of rows with bad values.
DIRTY_FLIGHTS = """
SELECT * FROM flights
UNION ALL SELECT * FROM flights WHERE id % 51 = 0
UNION ALL
SELECT id, flight_date, airline_code, flight_number, origin, destination, dep_time,
       -200 AS dep_delay_min, arr_time, -200 AS arr_delay_min, cancelled, diverted,
       0 AS distance_miles, carrier_delay, weather_delay, nas_delay, security_delay,
       late_aircraft_delay
FROM flights WHERE id % 71 = 0
"""

# Raw text rows of a monthly file: several date styles, blanks, lower case, junk,
# missing-value marks, and a second copy of about one row in forty with another distance.
# `k` picks the odd rows: about one row in 499 for each kind of oddity.
RAW_FLIGHTS = """
WITH copies AS (
  SELECT *, 0 AS copy FROM flights
  UNION ALL SELECT *, 1 AS copy FROM flights WHERE id % 41 = 0
), parts AS (
  SELECT *, CAST(id % 499 AS INT) AS k, CAST(id % 11 AS INT) AS style,
         CAST(year(flight_date) AS STRING) AS yy, CAST(month(flight_date) AS STRING) AS mm,
         CAST(day(flight_date) AS STRING) AS dd,
         substr(dep_time, 1, 2) || substr(dep_time, 4, 2) AS dep_hhmm,
         CAST(CAST(substr(arr_time, 1, 2) || substr(arr_time, 4, 2) AS INT) AS STRING) AS arr_hhmm
  FROM copies
)
SELECT
  CASE WHEN k = 1 THEN 'junk' WHEN k = 2 THEN '2023-13-40' WHEN k = 3 THEN NULL
       WHEN k = 4 THEN '2/30/2023' WHEN k = 5 THEN 'NaN'
       WHEN style < 3 THEN mm || '/' || dd || '/' || yy
       WHEN style = 3 THEN ' ' || mm || '/' || dd || '/' || yy || ' 12:00:00 AM'
       ELSE yy || '-' || mm || '-' || dd END AS "FL_DATE",
  CASE WHEN k = 6 THEN airline_code || 'X' WHEN style = 4 THEN ' ' || lower(airline_code) || ' '
       ELSE airline_code END AS "OP_UNIQUE_CARRIER",
  CASE WHEN k = 7 THEN ' 1234567890' || flight_number WHEN k = 8 THEN NULL
       ELSE flight_number END AS "OP_CARRIER_FL_NUM",
  CASE WHEN k = 9 THEN substr(origin, 1, 2) WHEN k = 10 THEN NULL
       WHEN style = 5 THEN lower(origin) || ' ' ELSE origin END AS "ORIGIN",
  CASE WHEN k = 11 THEN origin ELSE destination END AS "DEST",
  CASE WHEN k = 12 THEN '2400' WHEN k = 13 THEN '1299' WHEN k = 14 THEN 'junk'
       WHEN k = 15 THEN 'N/A' ELSE dep_hhmm END AS "DEP_TIME",
  CASE WHEN k = 16 THEN '-121' ELSE CAST(dep_delay_min AS STRING) || '.9' END AS "DEP_DELAY",
  CASE WHEN k = 17 THEN '-30' ELSE arr_hhmm END AS "ARR_TIME",
  CASE WHEN k = 16 THEN '-120.9' WHEN k = 18 THEN 'nan'
       ELSE CAST(arr_delay_min AS STRING) || '.00' END AS "ARR_DELAY",
  CASE WHEN k = 19 THEN NULL WHEN cancelled THEN '1.00' ELSE '0.00' END AS "CANCELLED",
  CASE WHEN k = 20 THEN 'yes' WHEN diverted THEN '1' ELSE '0.00' END AS "DIVERTED",
  CASE WHEN k = 21 THEN '0' WHEN k = 22 THEN '-5.00' WHEN k = 23 THEN '12d' WHEN k = 24 THEN '1e20'
       ELSE CAST(distance_miles + copy AS STRING) END AS "DISTANCE",
  CASE WHEN k = 25 THEN '-1.00' ELSE CAST(carrier_delay AS STRING) END AS "CARRIER_DELAY",
  CAST(weather_delay AS STRING) AS "WEATHER_DELAY",
  CAST(nas_delay AS STRING) AS "NAS_DELAY",
  CAST(security_delay AS STRING) AS "SECURITY_DELAY",
  CAST(late_aircraft_delay AS STRING) || '.0' AS "LATE_AIRCRAFT_DELAY",
  yy || '_' || lpad(mm, 2, '0') || '.csv' AS source_file,
  CAST(0 AS BIGINT) AS source_block,
  id * 2 + copy AS source_row
FROM parts
"""

# An airport listing with repeated codes, several types, blanks, gaps and junk.
RAW_AIRPORTS = """
WITH coded AS (
  SELECT *, (substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', CAST(1 + p_partkey % 26 AS INT), 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', CAST(1 + (p_partkey * 7) % 25 AS INT), 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', CAST(1 + (p_partkey * 3) % 2 AS INT), 1)) AS full_code
  FROM {part}
)
SELECT
  CASE WHEN p_partkey % 97 = 0 THEN NULL WHEN p_partkey % 89 = 0 THEN 'ABCD'
       WHEN p_partkey % 83 = 0 THEN 'AB ' WHEN p_partkey % 13 = 0 THEN lower(full_code)
       ELSE full_code END AS iata_code,
  CASE p_partkey % 5 WHEN 0 THEN 'large_airport' WHEN 3 THEN 'small_airport'
       WHEN 4 THEN 'heliport' ELSE 'medium_airport' END AS type,
  CASE WHEN p_partkey % 71 = 0 THEN NULL
       WHEN p_partkey % 11 = 0 THEN ('São ' || p_name || '–Zürich') ELSE (' The ' || p_name || ' of ' || CAST(p_partkey AS STRING)) END AS name,
  CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 37 = 0 THEN ' ' ELSE p_brand END AS municipality,
  CASE WHEN p_partkey % 19 = 0 THEN NULL WHEN p_partkey % 23 = 0 THEN 'USA' ELSE 'CA' END AS iso_country,
  CASE WHEN p_partkey % 29 = 0 THEN 'junk' WHEN p_partkey % 31 = 0 THEN NULL
       ELSE (CAST(p_partkey * 37 % 170 - 85 AS STRING) || '.25') END AS latitude_deg,
  CASE WHEN p_partkey % 41 = 0 THEN 'NaN'
       ELSE (CAST(p_partkey * 53 % 358 - 179 AS STRING) || '.5') END AS longitude_deg,
  (CAST(p_size * 100 AS STRING) || '.7') AS elevation_ft,
  CASE WHEN p_partkey % 2 = 0 THEN ('Zone/' || p_type) END AS tzid,
  ('Alt/' || p_type) AS time_zone
FROM coded
"""

# Second copies out of the same scan.
COPIES = """SELECT *, 0 AS copy FROM flights
  UNION ALL SELECT *, 1 AS copy FROM flights WHERE id % 41 = 0
"""
SPARK_COPIES = "SELECT *, explode(if(id % 41 = 0, array(0, 1), array(0))) AS copy FROM flights\n"


def spark_sql(text: str, sf_dir: str) -> str:
    paths = {t: f"parquet.`{sf_dir.rstrip('/')}/{t}.parquet`" for t in TABLES}
    return text.format(date=SPARK_DATE, **paths)


def duckdb_sql(text: str) -> str:
    return text.format(date=DUCKDB_DATE, **{t: t for t in TABLES})
