"""DuckDB statements that state each query's result independently of the Spark code.

A statement is the fixture tables as CTEs followed by the metric definitions written
out in SQL. Rates are rounded half away from zero through DECIMAL(18,6).
"""

from __future__ import annotations

from tarmac.functions.parsing import NA_TOKENS
from tarmac.functions.text import STOP_WORDS
from tarmac.operators.ingest import KNOWN_AIRLINES, RAW_FLIGHT_COLUMNS
from tarmac.plans import fixtures

IN_YEAR = "flight_date BETWEEN DATE '2023-01-01' AND DATE '2023-12-31'"
MONTH = "CAST(date_trunc('month', flight_date) AS DATE)"
KEY = "flight_date, airline_code, flight_number, origin, destination, dep_time"
FLIGHT_FIELDS = (
    "flight_date, airline_code, flight_number, origin, destination, dep_time, arr_time, "
    "cancelled, diverted, distance_miles, carrier_delay, weather_delay, nas_delay, "
    "security_delay, late_aircraft_delay, dep_delay_min, arr_delay_min"
)


# ---------------------------------------------------------------- fragments


def n(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


def dec(x: str, digits: int = 2) -> str:
    return f"round(CAST({x} AS DECIMAL(18,6)), {digits})"


def dbl(x: str, digits: int = 2) -> str:
    return f"CAST({dec(x, digits)} AS DOUBLE)"


def share(part: str, whole: str) -> str:
    return f"100.0 * {part} / NULLIF({whole}, 0)"


FLOWN = n("NOT cancelled")
PUNCTUAL = n("NOT cancelled AND arr_delay_min <= 15")
SEVERE = n("NOT cancelled AND arr_delay_min > 60")
ARR = "avg(arr_delay_min) FILTER (WHERE NOT cancelled)"
DEP = "avg(dep_delay_min) FILTER (WHERE NOT cancelled)"
ON_TIME = share(PUNCTUAL, FLOWN)
CANCELLED = share(n("cancelled"), "count(*)")


def statement(body: str, *extra: str, flights: str = "SELECT * FROM derived") -> str:
    """A query over flights, airports, airlines and more CTEs given as `name AS (...)`; `flights` may change the derived ones."""
    parts = [
        f"derived AS ({fixtures.duckdb_sql(fixtures.FLIGHTS)})",
        f"flights AS ({flights})",
        f"airports AS ({fixtures.AIRPORTS})",
        f"airlines AS ({fixtures.AIRLINES})",
        *extra,
    ]
    return "WITH " + ",\n".join(parts) + "\n" + body


# ---------------------------------------------------------------- raw input and ingest

_NA = ", ".join(f"'{t}'" for t in NA_TOKENS)


def _na(column: str) -> str:
    return f'CASE WHEN "{column}" NOT IN ({_NA}) THEN "{column}" END AS "{column}"'


RAW_TEXT = f"raw_text AS ({fixtures.duckdb_sql(fixtures.RAW_FLIGHTS)})"
RAW = (
    "raw AS (SELECT "
    + ", ".join(_na(c) for c in RAW_FLIGHT_COLUMNS)
    + ", source_file, source_row FROM raw_text)"
)
_AIRPORT_TEXT_COLUMNS = (
    "iata_code", "type", "name", "municipality", "iso_country", "latitude_deg",
    "longitude_deg", "elevation_ft", "tzid", "time_zone",
)
AIRPORT_TEXT = f"airport_text AS ({fixtures.duckdb_sql(fixtures.RAW_AIRPORTS)})"
AIRPORT_RAW = (
    "airport_raw AS (SELECT " + ", ".join(_na(c) for c in _AIRPORT_TEXT_COLUMNS) + " FROM airport_text)"
)


def num(column: str) -> str:
    value = f'TRY_CAST(trim("{column}") AS DOUBLE)'
    return f"CASE WHEN isnan({value}) THEN NULL ELSE {value} END"


def whole(column: str) -> str:
    return f"TRY_CAST(trunc({num(column)}) AS INT)"


def clock(column: str) -> str:
    t = f"((({whole(column)}) % 2400 + 2400) % 2400)"
    return (
        f"CASE WHEN {t} % 100 < 60 THEN lpad(CAST({t} // 100 AS VARCHAR), 2, '0') || ':' || "
        f"lpad(CAST({t} % 100 AS VARCHAR), 2, '0') || ':00' END"
    )


_SLASH = "string_split(split_part(trim(\"FL_DATE\"), ' ', 1), '/')"
_DAY = (
    f"CASE WHEN contains(\"FL_DATE\", '/') THEN TRY_CAST(lpad({_SLASH}[3], 4, '0') || '-' || "
    f"lpad({_SLASH}[1], 2, '0') || '-' || lpad({_SLASH}[2], 2, '0') AS DATE) "
    "ELSE TRY_CAST(trim(\"FL_DATE\") AS DATE) END"
)


def _delay(column: str) -> str:
    return f"CASE WHEN {whole(column)} >= -120 THEN {whole(column)} END"


PARSED = f"""parsed_all AS (
  SELECT {_DAY} AS flight_date, upper(trim("OP_UNIQUE_CARRIER")) AS airline_code,
    NULLIF(left(trim("OP_CARRIER_FL_NUM"), 10), '') AS flight_number,
    upper(trim("ORIGIN")) AS origin, upper(trim("DEST")) AS destination,
    {clock("DEP_TIME")} AS dep_time, {clock("ARR_TIME")} AS arr_time,
    COALESCE({num("CANCELLED")} = 1, FALSE) AS cancelled,
    COALESCE({num("DIVERTED")} = 1, FALSE) AS diverted,
    {whole("DISTANCE")} AS distance_miles, {whole("CARRIER_DELAY")} AS carrier_delay,
    {whole("WEATHER_DELAY")} AS weather_delay, {whole("NAS_DELAY")} AS nas_delay,
    {whole("SECURITY_DELAY")} AS security_delay,
    {whole("LATE_AIRCRAFT_DELAY")} AS late_aircraft_delay,
    {_delay("DEP_DELAY")} AS dep_delay_min, {_delay("ARR_DELAY")} AS arr_delay_min,
    source_file, source_row
  FROM raw
), marked AS (
  SELECT *, flight_date IS NOT NULL AND COALESCE(length(airline_code) = 2, FALSE)
    AND COALESCE(length(origin) = 3, FALSE) AND COALESCE(length(destination) = 3, FALSE) AS is_valid
  FROM parsed_all
), parsed AS (SELECT * EXCLUDE (is_valid) FROM marked WHERE is_valid)"""

_SEED = ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in KNOWN_AIRLINES)
CARRIERS = f"""carriers AS (
  SELECT code AS iata_code, COALESCE(k.name, 'Airline ' || code) AS name,
         COALESCE(k.country, 'US') AS country
  FROM (SELECT DISTINCT upper(trim("OP_UNIQUE_CARRIER")) AS code FROM raw) s
  LEFT JOIN (VALUES {_SEED}) AS k(iata_code, name, country) ON k.iata_code = code
  WHERE length(code) = 2
)"""

_RULES = (
    ("same_origin_destination", "origin = destination"),
    ("distance_not_positive", "distance_miles <= 0"),
    ("dep_delay_too_early", "dep_delay_min < -120"),
    ("arr_delay_too_early", "arr_delay_min < -120"),
    (
        "negative_delay_cause",
        "least(carrier_delay, weather_delay, nas_delay, security_delay, late_aircraft_delay) < 0",
    ),
    ("unknown_airline", "airline_code NOT IN (SELECT iata_code FROM carriers)"),
    ("unknown_origin", "origin NOT IN (SELECT iata_code FROM airports)"),
    ("unknown_destination", "destination NOT IN (SELECT iata_code FROM airports)"),
)
CHECKED = (
    "checked AS (SELECT *, NULLIF(concat_ws(',', "
    + ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in _RULES)
    + "), '') AS reject_reason FROM marked)"
)
INSERTED = f"""numbered AS (
  SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY source_file, source_row) AS rn
  FROM checked WHERE is_valid AND reject_reason IS NULL
), inserted AS (
  SELECT * FROM numbered nb WHERE rn = 1 AND NOT EXISTS (
    SELECT 1 FROM flights f WHERE f.flight_date < DATE '2023-07-01'
      AND f.flight_date = nb.flight_date AND f.airline_code = nb.airline_code
      AND f.flight_number = nb.flight_number AND f.origin = nb.origin
      AND f.destination = nb.destination AND f.dep_time IS NOT DISTINCT FROM nb.dep_time)
)"""
INGEST = (RAW_TEXT, RAW, PARSED)
INSERT = (*INGEST, CARRIERS, CHECKED, INSERTED)

LISTED = f"""typed AS (
  SELECT iata_code AS raw_code,
    CASE type WHEN 'large_airport' THEN 1 WHEN 'medium_airport' THEN 2 ELSE 3 END AS type_rank,
    NULLIF(trim(name), '') AS name, NULLIF(trim(municipality), '') AS city,
    NULLIF(left(trim(iso_country), 2), '') AS country, {num("longitude_deg")} AS lon,
    {num("latitude_deg")} AS lat, {whole("elevation_ft")} AS elevation_ft,
    COALESCE(NULLIF(trim(tzid), ''), NULLIF(trim(time_zone), '')) AS timezone
  FROM airport_raw
  WHERE length(iata_code) = 3 AND type IN ('large_airport', 'medium_airport', 'small_airport')
), best AS (
  SELECT * FROM typed QUALIFY row_number() OVER (
    PARTITION BY raw_code ORDER BY type_rank, name NULLS FIRST, city NULLS FIRST) = 1
), listed AS (
  SELECT upper(trim(raw_code)) AS iata_code, name, city, country, lon, lat, elevation_ft, timezone
  FROM best
  WHERE name IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL AND length(trim(raw_code)) = 3
  QUALIFY row_number() OVER (
    PARTITION BY upper(trim(raw_code)) ORDER BY type_rank DESC, raw_code DESC) = 1
)"""
AIRPORT_INGEST = (AIRPORT_TEXT, AIRPORT_RAW, LISTED)

_STOP = ", ".join(f"'{w}'" for w in ("", *STOP_WORDS))


def tokens(text: str) -> str:
    split = f"regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}]+')"
    return f"list_sort(list_distinct(list_filter({split}, lambda w: w NOT IN ({_STOP}))))"


AIRPORT_TOKENS = tokens("concat_ws(' ', name, city, iata_code, country)")
CARRIER_TOKENS = tokens("concat_ws(' ', name, iata_code, country)")

# ---------------------------------------------------------------- distances


def metres(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    """Lambert's formula on WGS 84, written out once as a scalar expression."""
    a, f = "6378137.0", "(1 / 298.257223563)"
    b1 = f"atan((1 - {f}) * tan(radians({lat1})))"
    b2 = f"atan((1 - {f}) * tan(radians({lat2})))"
    dl = f"(radians({lon2}) - radians({lon1}))"
    hav = f"(pow(sin(({b2} - {b1}) / 2), 2) + cos({b1}) * cos({b2}) * pow(sin({dl} / 2), 2))"
    s = f"(2 * asin(sqrt({hav})))"
    p, q = f"(({b1} + {b2}) / 2)", f"(({b2} - {b1}) / 2)"
    x = f"({s} - sin({s})) * pow(sin({p}), 2) * pow(cos({q}), 2) / pow(cos({s} / 2), 2)"
    y = f"({s} + sin({s})) * pow(cos({p}), 2) * pow(sin({q}), 2) / pow(sin({s} / 2), 2)"
    line = f"{a} * ({s} - {f} / 2 * (({x}) + ({y})))"
    return f"CASE WHEN {lon1} = {lon2} AND {lat1} = {lat2} THEN 0.0 ELSE {line} END"


ENDS = "JOIN airports o ON o.iata_code = r.origin JOIN airports d ON d.iata_code = r.destination"
LOCATED = "o.lon IS NOT NULL AND o.lat IS NOT NULL AND d.lon IS NOT NULL AND d.lat IS NOT NULL"
ROUTE_M = metres("o.lon", "o.lat", "d.lon", "d.lat")

def _half(total: str, parts: str) -> str:
    """Whole quotient, half away from zero."""
    return f"(sign({total}) * ((2 * abs({total}) + {parts}) // (2 * {parts})))::HUGEINT"


def _decimal(units: str) -> str:
    """Text of a number given in ten-thousandths."""
    return (
        f"CASE WHEN {units} < 0 THEN '-' ELSE '' END || CAST(abs({units}) // 10000 AS VARCHAR) || '.' "
        f"|| lpad(CAST(abs({units}) % 10000 AS VARCHAR), 4, '0')"
    )


_APART = "list_transform(c, lambda k: (x - k.x) * (x - k.x) + (y - k.y) * (y - k.y))"
# k-means in whole hundred-millionths of a degree: a row per round, with the list of centres.
CLUSTERED = f"""ups AS (
  SELECT iata_code, city, lon, lat FROM listed UNION ALL
  SELECT iata_code, city, lon, lat FROM airports WHERE iata_code NOT IN (SELECT iata_code FROM listed)
), pts AS (
  SELECT iata_code, city, CAST(CAST(CAST(lon AS DECIMAL(13,8)) AS DECIMAL(38,8)) * 100000000 AS HUGEINT) AS x,
    CAST(CAST(CAST(lat AS DECIMAL(13,8)) AS DECIMAL(38,8)) * 100000000 AS HUGEINT) AS y
  FROM ups WHERE lon IS NOT NULL AND lat IS NOT NULL
), chosen AS (
  WITH RECURSIVE seeds AS (
    SELECT 0 AS step, [{{'x': {_half("sum(x)", "count(*)")}, 'y': {_half("sum(y)", "count(*)")}}}] AS c FROM pts
    UNION ALL
    SELECT step + 1, CASE WHEN step = 0 THEN [best] ELSE list_append(c, best) END FROM (
      SELECT step, any_value(c) AS c, arg_min({{'x': x, 'y': y}}, {{'d': -d, 'code': iata_code}}) AS best
      FROM (SELECT step, c, x, y, iata_code, list_min({_APART}) AS d FROM seeds, pts WHERE step < 6)
      GROUP BY step)
  ) SELECT c FROM seeds WHERE step = 6
), settled AS (
  WITH RECURSIVE lloyd AS (
    SELECT 0 AS step, c, FALSE AS done FROM chosen
    UNION ALL
    SELECT step + 1, moved, moved = c FROM (
      SELECT step, any_value(c) AS c, list({{'x': mx, 'y': my}} ORDER BY cid) AS moved FROM (
        SELECT step, any_value(c) AS c, cid, {_half("sum(x)", "count(*)")} AS mx, {_half("sum(y)", "count(*)")} AS my
        FROM (SELECT step, c, x, y, list_position({_APART}, list_min({_APART})) AS cid
              FROM lloyd, pts WHERE NOT done AND step < 200)
        GROUP BY step, cid)
      GROUP BY step)
  ) SELECT c FROM lloyd ORDER BY step DESC LIMIT 1
), clustered AS (
  SELECT iata_code, city, x // 100 AS x, y // 100 AS y,
    CAST(list_position({_APART}, list_min({_APART})) - 1 AS INT) AS cluster_id
  FROM pts, settled
)"""


# ---------------------------------------------------------------- shared report bodies

RANKING = f"""ranking AS (
  WITH k AS (
    SELECT airline_code, count(*) AS total_flights, {dec(ON_TIME)} AS ot, {dec(ARR)} AS ad,
           {dec(CANCELLED)} AS cr
    FROM flights WHERE {IN_YEAR} GROUP BY airline_code HAVING count(*) >= 100
  ), s AS (
    SELECT *, 0.50 * ot + 0.30 * greatest(0, 100 - COALESCE(ad, 0))
              + 0.20 * (100 - COALESCE(cr, 0)) AS score FROM k
  )
  SELECT CAST(rank() OVER (ORDER BY score DESC NULLS FIRST) AS INT) AS rank_position,
    s.airline_code, COALESCE(a.name, 'Unknown') AS airline_name, total_flights,
    CAST(ot AS DOUBLE) AS on_time_pct, CAST(ad AS DOUBLE) AS avg_arr_delay_min,
    CAST(cr AS DOUBLE) AS cancellation_rate, {dbl("score")} AS performance_score
  FROM s LEFT JOIN airlines a ON a.iata_code = s.airline_code
)"""

SCORE = f"""score AS (
  SELECT 'AA' AS airline_code, count(*) AS total_flights,
    CAST(sum(CASE WHEN NOT cancelled THEN 1 ELSE 0 END) AS BIGINT) AS completed_flights,
    CAST(sum(CASE WHEN NOT cancelled AND arr_delay_min <= 15 THEN 1 ELSE 0 END) AS BIGINT) AS on_time_flights,
    {dbl(ON_TIME)} AS on_time_pct, {dbl(ARR)} AS avg_arr_delay_min,
    {dbl(DEP)} AS avg_dep_delay_min, {dbl(CANCELLED)} AS cancellation_rate,
    {dbl(share(SEVERE, FLOWN))} AS severe_delay_pct,
    {dbl(f"0.5 * ({ON_TIME}) + 0.3 * greatest(0, 100 - COALESCE({ARR}, 0)) + 0.2 * (100 - COALESCE({CANCELLED}, 0))")}
      AS performance_score
  FROM flights WHERE airline_code = 'AA' AND {IN_YEAR}
)"""

TREND = f"""trend AS (
  WITH monthly AS (
    SELECT {MONTH} AS month, airline_code, {FLOWN} AS completed_flights,
           {dec(ON_TIME)} AS ot, {dbl(ARR)} AS avg_arr_delay
    FROM flights GROUP BY ALL
  )
  SELECT month, airline_code, completed_flights, CAST(ot AS DOUBLE) AS on_time_pct, avg_arr_delay,
    CAST(lag(ot) OVER h AS DOUBLE) AS prev_on_time_pct,
    CAST(ot - lag(ot) OVER h AS DOUBLE) AS mom_change_pct,
    rank() OVER (PARTITION BY month ORDER BY ot DESC NULLS LAST) AS rank_in_month
  FROM monthly WINDOW h AS (PARTITION BY airline_code ORDER BY month)
)"""

DAILY = f"""daily AS (
  SELECT flight_date, airline_code, count(*) AS total_flights, {FLOWN} AS completed_flights,
    {n("cancelled")} AS cancelled_flights, {dbl(ON_TIME)} AS on_time_pct,
    {dbl(ARR)} AS avg_arr_delay_min
  FROM flights GROUP BY flight_date, airline_code
)"""

RISK = f"""risk AS (
  SELECT origin, destination, count(*) AS total_flights, {dbl(ARR)} AS avg_arr_delay,
    {dbl(CANCELLED)} AS cancellation_rate,
    {dbl(f"0.7 * COALESCE({ARR}, 0) + 0.3 * ({CANCELLED})")} AS risk_score
  FROM flights GROUP BY origin, destination HAVING count(*) >= 50
)"""

AIRLINE_SUMMARY = f"""airline_summary AS (
  SELECT f.airline_code, COALESCE(a.name, 'Unknown') AS airline_name, count(*) AS total_flights,
    {FLOWN} AS completed_flights, {n("cancelled")} AS cancelled_flights,
    {dbl(ON_TIME)} AS on_time_pct, {dbl(ARR)} AS avg_arr_delay_min, {dbl(DEP)} AS avg_dep_delay_min,
    {dbl(CANCELLED)} AS cancellation_rate, {SEVERE} AS severe_delay_count,
    min(flight_date) AS data_from, max(flight_date) AS data_to
  FROM flights f LEFT JOIN airlines a ON a.iata_code = f.airline_code
  GROUP BY f.airline_code, a.name
)"""

HEATMAP = f"""heatmap AS (
  SELECT CAST(dayofweek(flight_date) AS INT) AS day_of_week,
    CAST(left(dep_time, 2) AS INT) AS hour_of_day, count(*) AS flight_count,
    {dbl("avg(arr_delay_min)")} AS avg_arr_delay, {dbl("avg(dep_delay_min)")} AS avg_dep_delay,
    {dbl(share(n("arr_delay_min > 15"), "count(*)"))} AS delay_rate_pct
  FROM flights WHERE NOT cancelled AND dep_time IS NOT NULL GROUP BY ALL
)"""

TOP_ROUTES = f"""routes AS (
  SELECT r.origin, r.destination, o.name AS origin_name, d.name AS dest_name,
    o.city AS origin_city, d.city AS dest_city, o.lon AS origin_lon, o.lat AS origin_lat,
    d.lon AS dest_lon, d.lat AS dest_lat, count(*) AS total_flights, {FLOWN} AS completed_flights,
    {dbl(ARR)} AS avg_arr_delay, {dbl("avg(distance_miles)", 1)} AS avg_distance_miles,
    {dbl(ON_TIME)} AS on_time_pct, {dbl(CANCELLED)} AS cancellation_rate
  FROM flights r {ENDS} WHERE {LOCATED} GROUP BY ALL HAVING count(*) >= 100
)"""

MONTHLY_TREND = f"""monthly_trend AS (
  SELECT {MONTH} AS month, f.airline_code, COALESCE(a.name, 'Unknown') AS airline_name,
    count(*) AS total_flights, {dbl(ARR)} AS avg_arr_delay, {dbl(ON_TIME)} AS on_time_pct,
    {dbl(CANCELLED)} AS cancellation_rate,
    CAST(sum(COALESCE(carrier_delay, 0)) AS BIGINT) AS total_carrier_delay_min,
    CAST(sum(COALESCE(weather_delay, 0)) AS BIGINT) AS total_weather_delay_min,
    CAST(sum(COALESCE(nas_delay, 0)) AS BIGINT) AS total_nas_delay_min,
    CAST(sum(COALESCE(late_aircraft_delay, 0)) AS BIGINT) AS total_late_aircraft_delay_min
  FROM flights f LEFT JOIN airlines a ON a.iata_code = f.airline_code
  GROUP BY {MONTH}, f.airline_code, a.name
)"""

ROUTE_PERFORMANCE = f"""route_performance AS (
  SELECT origin, destination, f.airline_code, COALESCE(a.name, 'Unknown') AS airline_name,
    count(*) AS total_flights, {dbl(ARR)} AS avg_arr_delay, {dbl(ON_TIME)} AS on_time_pct,
    {dbl(CANCELLED)} AS cancellation_rate
  FROM flights f LEFT JOIN airlines a ON a.iata_code = f.airline_code
  GROUP BY origin, destination, f.airline_code, a.name HAVING count(*) >= 20
)"""

QUALITY = f"""quality AS (
  WITH one_row AS (
    SELECT count(*) AS total_rows, {n("dep_time IS NULL")} AS null_dep_time,
      {n("arr_time IS NULL")} AS null_arr_time, {n("cancelled")} AS cancelled_rows,
      {n("distance_miles <= 0")} AS negative_distance,
      {n("NOT cancelled AND arr_delay_min > 15 AND COALESCE(carrier_delay, weather_delay, nas_delay, "
         "security_delay, late_aircraft_delay) IS NULL")} AS missing_delay_breakdown_on_delayed
    FROM flights WHERE {IN_YEAR}
  ), metrics AS (
    UNPIVOT one_row ON COLUMNS(*) INTO NAME metric_name VALUE metric_value
  )
  SELECT metric_name, metric_value,
    {dbl("100.0 * metric_value / NULLIF((SELECT total_rows FROM one_row), 0)", 3)} AS metric_percent
  FROM metrics
)"""

AUDIT = """audit AS (
  SELECT id AS flight_id, flight_date, airline_code, origin, destination,
    arr_delay_min AS delay_minutes,
    CASE WHEN arr_delay_min > 60 THEN 'severe' WHEN arr_delay_min > 15 THEN 'major'
         WHEN arr_delay_min > 0 THEN 'minor' ELSE 'on_time' END AS delay_category
  FROM flights WHERE NOT cancelled AND arr_delay_min IS NOT NULL
)"""

DIRTY = f"dirty AS ({fixtures.DIRTY_FLIGHTS})"
ROUTE_REPORT_COLUMNS = (
    "origin, destination, origin_city, dest_city, origin_lat, origin_lon, dest_lat, dest_lon, "
    "total_flights, avg_arr_delay"
)


def _range_counts(table: str) -> str:
    return (
        f"SELECT {n('dep_delay_min < -120')} AS bad_dep_delay_rows, "
        f"{n('arr_delay_min < -120')} AS bad_arr_delay_rows, "
        f"{n('distance_miles <= 0')} AS bad_distance_rows FROM {table}"
    )


def _duplicates(table: str) -> str:
    order = ", ".join(f"{k.strip()} ASC NULLS LAST" for k in KEY.split(","))
    return (
        f"SELECT {KEY}, count(*) AS cnt FROM {table} GROUP BY {KEY} HAVING count(*) > 1 "
        f"ORDER BY cnt DESC, {order} LIMIT 50"
    )


def _delay_causes() -> str:
    causes = (
        ("Carrier", "carrier_delay"), ("Weather", "weather_delay"), ("NAS", "nas_delay"),
        ("Security", "security_delay"), ("Late Aircraft", "late_aircraft_delay"),
    )
    all_minutes = " + ".join(f"COALESCE({c}, 0)" for _, c in causes)
    rows = " UNION ALL ".join(
        f"SELECT '{label}' AS delay_cause, {c} AS minutes FROM own WHERE {c} > 0"
        for label, c in causes
    )
    late = f"(SELECT sum({all_minutes}) FROM own WHERE arr_delay_min > 0)"
    return f"""
    , own AS (SELECT * FROM flights WHERE airline_code = 'AA' AND {IN_YEAR} AND NOT cancelled),
    minutes AS ({rows})
    SELECT delay_cause, CAST(sum(minutes) AS BIGINT) AS total_minutes,
      {dbl("avg(minutes)")} AS avg_minutes, count(*) AS flight_count,
      {dbl(share("sum(minutes)", late))} AS pct_of_total_delay
    FROM minutes GROUP BY delay_cause"""


#: Per summary: its CTE, its keys, its measures that are numbers and those that are not.
TALL = {
    "airline_summary": ("airline_summary", "airline_code", (
        "total_flights completed_flights cancelled_flights on_time_pct avg_arr_delay_min avg_dep_delay_min "
        "cancellation_rate severe_delay_count"), "airline_name data_from data_to"),
    "delay_heatmap": ("heatmap", "day_of_week, hour_of_day", "flight_count avg_arr_delay avg_dep_delay delay_rate_pct", ""),
    "top_routes": ("routes", "origin, destination", (
        "origin_lon origin_lat dest_lon dest_lat total_flights completed_flights avg_arr_delay avg_distance_miles "
        "on_time_pct cancellation_rate"), "origin_name dest_name origin_city dest_city"),
    "monthly_trend": ("monthly_trend", "month, airline_code", (
        "total_flights avg_arr_delay on_time_pct cancellation_rate total_carrier_delay_min total_weather_delay_min "
        "total_nas_delay_min total_late_aircraft_delay_min"), "airline_name"),
    "route_performance": ("route_performance", "origin, destination, airline_code", (
        "total_flights avg_arr_delay on_time_pct cancellation_rate"), "airline_name"),
}
SUMMARY_TABLES = (AIRLINE_SUMMARY, HEATMAP, TOP_ROUTES, MONTHLY_TREND, ROUTE_PERFORMANCE)


def _tall() -> str:
    """Every value of the five summaries: summary, key, measure and the value as a number or as text."""
    parts = []
    for name, (table, keys, numbers, texts) in TALL.items():
        values = [f"{{'m': '{c}', 'v': CAST({c} AS DOUBLE), 't': CAST(NULL AS VARCHAR)}}" for c in numbers.split()]
        values += [f"{{'m': '{c}', 'v': CAST(NULL AS DOUBLE), 't': CAST({c} AS VARCHAR)}}" for c in texts.split()]
        parts.append(f"""
          SELECT summary_name, key, u.m AS measure, u.v AS value, u.t AS text FROM (
            SELECT '{name}' AS summary_name, concat_ws('|', {keys}) AS key, unnest([{", ".join(values)}]) AS u FROM {table})""")
    return " UNION ALL ".join(parts)


def _search(matches: str, wanted: str = "") -> str:
    """Codes by the words that they answer, numbered by `matches`."""
    return f"""
        , postings AS (
          SELECT unnest({AIRPORT_TOKENS}) AS token, 'airport' AS entity, iata_code AS code FROM listed
          UNION ALL SELECT unnest({CARRIER_TOKENS}), 'airline', iata_code FROM carriers),
        answered AS (SELECT entity, code, unnest(list_filter([{matches}], lambda w: w IS NOT NULL)) AS word FROM postings)
        SELECT entity, code, CAST(count(DISTINCT word) AS INT) AS matched FROM answered GROUP BY entity, code {wanted}"""


#: Flights after the corrections of the stream's query.
CORRECTED = """
  SELECT * REPLACE (FALSE AS cancelled, CASE WHEN cancelled THEN 0 ELSE dep_delay_min END AS dep_delay_min,
    CASE WHEN cancelled THEN 0 ELSE arr_delay_min END AS arr_delay_min)
  FROM derived WHERE distance_miles IS NULL OR distance_miles <= 2000"""


def _build() -> dict[str, str]:
    q: dict[str, str] = {}
    cols = ", ".join(f'"{c}"' for c in RAW_FLIGHT_COLUMNS)

    q["read_flights_csv"] = statement(f"SELECT {cols} FROM raw", RAW_TEXT, RAW)
    q["read_airports_csv"] = statement("SELECT * FROM airport_raw", AIRPORT_TEXT, AIRPORT_RAW)
    shifted = "CAST(flight_date + INTERVAL 6 MONTH AS DATE)"
    q["write_flights"] = statement(f"""
        SELECT CASE WHEN year({shifted}) = 2023 THEN strftime({shifted}, '%Y-%m') ELSE 'default' END
            AS flight_month, count(*) AS row_count, min({shifted}) AS first_date,
            max({shifted}) AS last_date
        FROM flights GROUP BY 1""")
    q["replace_month"] = statement(f"""
        , known AS (SELECT iata_code FROM airports UNION SELECT iata_code FROM listed),
        short AS (SELECT * FROM flights WHERE month(flight_date) = 3 AND distance_miles < 1000
          AND distance_miles > 0 AND origin <> destination AND origin IN (FROM known)
          AND destination IN (FROM known) AND airline_code IN (SELECT iata_code FROM airlines)),
        march AS (SELECT * FROM short QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY id) = 1),
        moved AS (SELECT * REPLACE (id + 1000000000000 AS id, 'X' AS flight_number,
            CAST(flight_date + INTERVAL 1 MONTH AS DATE) AS flight_date) FROM short),
        added AS (SELECT * FROM moved QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY id) = 1),
        stored AS (SELECT * FROM flights WHERE month(flight_date) <> 3
          UNION ALL SELECT * FROM march UNION ALL SELECT * FROM added)
        SELECT *, CAST(CASE WHEN month(flight_date) IN (3, 4) AND NOT cancelled
            AND arr_delay_min IS NOT NULL THEN 1 ELSE 0 END AS BIGINT) AS audit_rows FROM stored""", *AIRPORT_INGEST)
    q["upsert_airports"] = statement("""
        SELECT iata_code, name, city, country, lon, lat, elevation_ft FROM listed UNION ALL
        SELECT * FROM airports WHERE iata_code NOT IN (SELECT iata_code FROM listed)""", *AIRPORT_INGEST)
    q["upsert_airlines"] = statement(f"""
        SELECT * FROM carriers UNION ALL
        SELECT iata_code, name || ' (old)', country
        FROM (VALUES {_SEED}) AS k(iata_code, name, country)
        WHERE iata_code NOT IN (SELECT iata_code FROM carriers)""", RAW_TEXT, RAW, CARRIERS)
    q["insert_flights"] = statement(
        f"SELECT {FLIGHT_FIELDS}, source_file, source_row FROM inserted", *INSERT
    )
    q["load_summary"] = statement("""
        SELECT 'airports' AS table_name, CAST(NULL AS VARCHAR) AS month, count(*) AS row_count FROM airports
        UNION ALL SELECT 'airlines', NULL, count(*) FROM airlines
        UNION ALL SELECT 'delay_audit_log', NULL, count(*) FROM audit
        UNION ALL SELECT 'flights', NULL, count(*) FROM flights
        UNION ALL SELECT 'flights', strftime(flight_date, '%Y-%m'), count(*) FROM flights GROUP BY 2""", AUDIT)
    q["file_stats"] = statement(f"""
        , added AS (SELECT source_file, count(*) AS inserted FROM inserted GROUP BY source_file)
        SELECT c.source_file, count(*) AS total_rows, COALESCE(any_value(inserted), 0) AS inserted,
          {n("NOT is_valid")} AS skipped, {n("is_valid AND reject_reason IS NOT NULL")} AS errors
        FROM checked c LEFT JOIN added a ON a.source_file = c.source_file GROUP BY c.source_file""", *INSERT)
    q["load_flights"] = statement(f"""
        , added AS (SELECT source_file, count(*) AS inserted FROM inserted GROUP BY source_file),
        per_file AS (
          SELECT c.source_file, count(*) AS total_rows, COALESCE(any_value(inserted), 0) AS inserted,
            {n("NOT is_valid")} AS skipped, {n("is_valid AND reject_reason IS NOT NULL")} AS errors
          FROM checked c LEFT JOIN added a ON a.source_file = c.source_file GROUP BY c.source_file),
        stored AS (SELECT flight_date, arr_delay_min, cancelled FROM inserted UNION ALL
          SELECT flight_date, arr_delay_min, cancelled FROM flights WHERE flight_date < DATE '2023-07-01'),
        months AS (
          SELECT strftime(flight_date, '%Y_%m') || '.csv' AS source_file, count(*) AS stored_flights,
            {n("NOT cancelled AND arr_delay_min IS NOT NULL")} AS audit_rows,
            CAST(sum(arr_delay_min) FILTER (WHERE NOT cancelled) AS BIGINT) AS audit_minutes
          FROM stored GROUP BY 1)
        SELECT * FROM per_file JOIN months USING (source_file)""", *INSERT)
    q["dry_run"] = statement(f"""
        SELECT source_file, count(*) AS total_rows, CAST(0 AS BIGINT) AS inserted,
          {n("NOT is_valid")} AS skipped, CAST(0 AS BIGINT) AS errors
        FROM marked GROUP BY source_file""", *INGEST)
    q["refresh_summaries"] = statement(_tall(), *SUMMARY_TABLES)
    q["partition_stats"] = statement("""
        , names AS (SELECT 'flights_2023_' || lpad(CAST(m AS VARCHAR), 2, '0') AS partition_name
          FROM range(1, 13) AS r(m) UNION ALL SELECT 'flights_default'),
        counted AS (SELECT 'flights_' || strftime(flight_date, '%Y_%m') AS partition_name, count(*) AS k
          FROM flights GROUP BY 1)
        SELECT partition_name, COALESCE(k, 0) AS row_count, COALESCE(k, 0) > 0 AS has_files
        FROM names LEFT JOIN counted USING (partition_name)""")
    q["summary_counts"] = statement("""
        SELECT 'airline_summary' AS summary_name, count(*) AS row_count FROM airline_summary
        UNION ALL SELECT 'delay_heatmap', count(*) FROM heatmap
        UNION ALL SELECT 'top_routes', count(*) FROM routes
        UNION ALL SELECT 'monthly_trend', count(*) FROM monthly_trend
        UNION ALL SELECT 'route_performance', count(*) FROM route_performance""",
        AIRLINE_SUMMARY, HEATMAP, TOP_ROUTES, MONTHLY_TREND, ROUTE_PERFORMANCE)
    numbers = ("dep_delay_min", "arr_delay_min", "distance_miles", "carrier_delay", "weather_delay", "nas_delay",
               "security_delay", "late_aircraft_delay")
    described = {c: c for c in numbers} | {"flight_date": "flight_date - DATE '1970-01-01'"} | dict.fromkeys(
        ("airline_code", "flight_number", "origin", "destination", "dep_time", "arr_time"))
    q["table_statistics"] = statement(" UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count,
          CAST(min({x or 'NULL'}) AS BIGINT) AS least, CAST(max({x or 'NULL'}) AS BIGINT) AS greatest FROM flights"""
        for c, x in described.items()))
    q["partition_for_date"] = statement(f"""
        , days AS (SELECT DISTINCT {shifted} AS flight_date FROM flights),
        named AS (SELECT *, 'flights_' || strftime(flight_date, '%Y_%m') AS own FROM days)
        SELECT flight_date, CASE WHEN year(flight_date) = 2023 THEN own ELSE
          'flights_default (no partition has been created for ' || own || ')' END AS partition_name
        FROM named""")

    q["ingest_flights"] = statement(f"SELECT {FLIGHT_FIELDS}, source_file, source_row FROM parsed", *INGEST)
    q["ingest_constraints"] = statement(f"""
        SELECT {FLIGHT_FIELDS}, source_file, source_row, reject_reason
        FROM checked WHERE is_valid""", *INGEST, CARRIERS, CHECKED)
    q["ingest_airports"] = statement("SELECT * FROM listed", *AIRPORT_INGEST)
    q["ingest_airlines"] = statement("SELECT * FROM carriers", RAW_TEXT, RAW, CARRIERS)
    q["search_tokens_airports"] = statement(
        f"SELECT iata_code, array_to_string({AIRPORT_TOKENS}, ' ') AS search_text FROM listed",
        *AIRPORT_INGEST)
    q["search_tokens_airlines"] = statement(
        f"SELECT iata_code, array_to_string({CARRIER_TOKENS}, ' ') AS search_text FROM carriers",
        RAW_TEXT, RAW, CARRIERS)
    q["search_index"] = statement(f"""
        SELECT unnest({AIRPORT_TOKENS}) AS token, 'airport' AS entity, iata_code AS code FROM listed
        UNION ALL SELECT unnest({CARRIER_TOKENS}), 'airline', iata_code FROM carriers""",
        *AIRPORT_INGEST, RAW_TEXT, RAW, CARRIERS)
    q["delete_airports"] = statement("""
        , codes AS (SELECT iata_code FROM airports UNION SELECT iata_code FROM listed)
        SELECT iata_code, NOT EXISTS (SELECT 1 FROM flights WHERE origin = iata_code
          OR destination = iata_code) AS deletable FROM codes""", *AIRPORT_INGEST)
    q["delay_audit"] = statement("SELECT * FROM audit", AUDIT)

    q["airline_score"] = statement("SELECT * FROM score", SCORE)
    q["airline_ranking"] = statement("SELECT * FROM ranking", RANKING)
    q["delay_breakdown"] = statement(_delay_causes())
    q["best_routes_between"] = statement(f"""
        SELECT f.airline_code, COALESCE(a.name, 'Unknown') AS airline_name, count(*) AS total_flights,
          {dbl(ON_TIME)} AS on_time_pct, {dbl(ARR)} AS avg_arr_delay_min,
          {dbl("avg(distance_miles)", 1)} AS avg_distance_miles, {dbl(CANCELLED)} AS cancellation_rate
        FROM flights f LEFT JOIN airlines a ON a.iata_code = f.airline_code
        WHERE origin = 'JFK' AND destination = 'LAX' AND {IN_YEAR}
        GROUP BY f.airline_code, a.name HAVING count(*) >= 10""")
    q["route_kpi"] = statement(f"""
        SELECT count(*) AS total_flights, {FLOWN} AS completed_flights,
          {n("cancelled")} AS cancelled_flights, {dbl(CANCELLED)} AS cancellation_rate,
          {dbl(ON_TIME)} AS on_time_pct, {dbl(ARR)} AS avg_arr_delay_min
        FROM flights WHERE origin = 'JFK' AND destination = 'LAX' AND {IN_YEAR}""")
    q["data_quality_summary"] = statement("SELECT * FROM quality", QUALITY)
    q["invalid_airport_references"] = statement("""
        SELECT 'origin' AS source_col, origin AS iata_code, count(*) AS affected_rows FROM flights
        WHERE NOT EXISTS (SELECT 1 FROM airports a WHERE a.iata_code = origin) GROUP BY origin
        UNION ALL
        SELECT 'destination', destination, count(*) FROM flights
        WHERE NOT EXISTS (SELECT 1 FROM airports a WHERE a.iata_code = destination)
        GROUP BY destination""")

    q["v_airline_monthly_trend"] = statement("SELECT * FROM trend", TREND)
    q["v_airline_daily_ops"] = statement("SELECT * FROM daily", DAILY)
    q["v_route_risk_score"] = statement("SELECT * FROM risk", RISK)
    q["mv_airline_summary"] = statement("SELECT * FROM airline_summary", AIRLINE_SUMMARY)
    q["mv_delay_heatmap"] = statement("SELECT * FROM heatmap", HEATMAP)
    q["mv_top_routes"] = statement("SELECT * FROM routes", TOP_ROUTES)
    q["mv_monthly_trend"] = statement("SELECT * FROM monthly_trend", MONTHLY_TREND)
    q["mv_route_performance"] = statement("SELECT * FROM route_performance", ROUTE_PERFORMANCE)

    q["w1_monthly_rank"] = statement(f"""
        SELECT {MONTH} AS month, airline_code, count(*) AS total_flights,
          {PUNCTUAL} AS on_time_flights, {dbl(ON_TIME)} AS on_time_pct, {dbl(ARR)} AS avg_delay_min,
          rank() OVER (PARTITION BY {MONTH}
            ORDER BY CAST({PUNCTUAL} AS DOUBLE) / NULLIF({FLOWN}, 0) DESC NULLS FIRST) AS rank_on_time,
          dense_rank() OVER (PARTITION BY {MONTH} ORDER BY {ARR} ASC NULLS LAST) AS dense_rank_by_delay
        FROM flights WHERE {IN_YEAR} GROUP BY {MONTH}, airline_code""")
    frame = "avg(a) OVER (PARTITION BY airline_code ORDER BY flight_date ROWS BETWEEN {} PRECEDING AND CURRENT ROW)"
    q["w2_moving_avg"] = statement(f"""
        , day_means AS (SELECT flight_date, airline_code, count(*) AS daily_flights, {dec(ARR)} AS a
          FROM flights WHERE NOT cancelled AND {IN_YEAR} GROUP BY flight_date, airline_code)
        SELECT flight_date, airline_code, daily_flights, CAST(a AS DOUBLE) AS daily_avg_delay,
          {dbl(frame.format(6))} AS moving_avg_7day, {dbl(frame.format(29))} AS moving_avg_30day,
          {dbl(frame.format("UNBOUNDED"))} AS cumulative_avg
        FROM day_means""")
    q["w3_delay_surge"] = statement(f"""
        , busy AS (SELECT {MONTH} AS month, origin, destination, count(*) AS flight_count, {dec(ARR)} AS a
          FROM flights WHERE {IN_YEAR} GROUP BY ALL HAVING count(*) >= 50),
        d AS (SELECT *, lag(a) OVER (PARTITION BY origin, destination ORDER BY month) AS p FROM busy)
        SELECT month, origin, destination, flight_count, CAST(a AS DOUBLE) AS current_avg_delay,
          CAST(p AS DOUBLE) AS prev_month_avg_delay, {dbl("100.0 * (a - p) / NULLIF(p, 0)")} AS pct_change,
          CASE WHEN a - p > 30 THEN 'surge' WHEN a - p > 10 THEN 'up'
               WHEN a - p < -10 THEN 'improved' ELSE 'stable' END AS trend
        FROM d ORDER BY abs(a - p) DESC NULLS LAST, month, origin, destination LIMIT 50""")
    q["w4_delay_distribution"] = statement(f"""
        , c AS (SELECT arr_delay_min, count(*) AS frequency FROM flights
          WHERE NOT cancelled AND arr_delay_min BETWEEN -60 AND 360 GROUP BY arr_delay_min)
        SELECT arr_delay_min, frequency, CAST(ntile(10) OVER o AS INT) AS decile,
          CAST(ntile(4) OVER o AS INT) AS quartile,
          CAST(round(CAST(percent_rank() OVER o AS DECIMAL(18,8)), 4) AS DOUBLE) AS percent_rank,
          CAST(round(CAST(cume_dist() OVER o AS DECIMAL(18,8)), 4) AS DOUBLE) AS cumulative_dist
        FROM c WINDOW o AS (ORDER BY arr_delay_min)""")
    q["w5_running_total"] = statement(f"""
        , days AS (SELECT flight_date, count(*) AS f, {n("cancelled")} AS c FROM flights
          WHERE {IN_YEAR} GROUP BY flight_date),
        sums AS (SELECT *, CAST(sum(f) OVER w AS BIGINT) AS cf, CAST(sum(c) OVER w AS BIGINT) AS cc
          FROM days WINDOW w AS (ORDER BY flight_date ROWS UNBOUNDED PRECEDING))
        SELECT flight_date, f AS flights_today, c AS cancelled_today, cf AS cumulative_flights,
          cc AS cumulative_cancelled, {dbl(share("cc", "cf"))} AS cumulative_cancel_rate FROM sums""")
    q["w6_vs_industry"] = statement(f"""
        , am AS (SELECT {MONTH} AS month, airline_code, {dec(ARR)} AS a FROM flights
          WHERE {IN_YEAR} GROUP BY ALL),
        ind AS (SELECT *, avg(a) OVER (PARTITION BY month) AS i FROM am)
        SELECT month, airline_code, CAST(a AS DOUBLE) AS airline_avg_delay, {dbl("i")} AS industry_avg_delay,
          {dbl("a - i")} AS diff_from_industry,
          CASE WHEN a < i - 5 THEN 'better than industry' WHEN a > i + 5 THEN 'worse than industry'
               ELSE 'same as industry' END AS vs_industry FROM ind""")

    hubs = "('JFK', 'LAX', 'ORD', 'ATL', 'DFW')"
    q["g1_airport_distances"] = statement(f"""
        , r AS (SELECT origin, destination, avg(distance_miles) AS miles FROM flights
          WHERE origin IN {hubs} AND destination IN {hubs} AND origin < destination GROUP BY ALL)
        SELECT r.origin, o.name AS origin_name, r.destination, d.name AS dest_name,
          {dbl(f"({ROUTE_M}) / 1000", 1)} AS distance_km, {dbl("miles * 1.60934", 1)} AS bts_distance_km
        FROM r {ENDS}""")
    geojson = """'{{"type":"Point","coordinates":[' || {0}.lon || ',' || {0}.lat || ']}}'"""
    q["g2_busiest_routes"] = statement(f"""
        , r AS (SELECT origin, destination, count(*) AS total_flights, {dbl(ARR)} AS avg_delay_min
          FROM flights WHERE NOT cancelled GROUP BY origin, destination)
        SELECT r.origin, r.destination, o.name AS origin_name, d.name AS dest_name,
          o.city AS origin_city, d.city AS dest_city, total_flights, avg_delay_min,
          o.lat AS origin_lat, o.lon AS origin_lon, d.lat AS dest_lat, d.lon AS dest_lon,
          {geojson.format("o")} AS origin_geojson, {geojson.format("d")} AS dest_geojson,
          {dbl(f"({ROUTE_M}) / 1000", 1)} AS distance_km
        FROM r {ENDS} WHERE {LOCATED} ORDER BY total_flights DESC, r.origin, r.destination LIMIT 20""")
    jfk = metres("lon", "lat", "(-73.7789)", "40.6398")
    q["g3_airports_within"] = statement(f"""
        , near AS (SELECT *, {jfk} AS m FROM airports WHERE lon IS NOT NULL AND lat IS NOT NULL)
        SELECT a.iata_code, a.name, a.city, {dbl("m / 1000", 1)} AS dist_from_jfk_km,
          count(f.id) AS total_departures, {dbl(ARR)} AS avg_arr_delay, {dbl(CANCELLED)} AS cancellation_rate
        FROM near a JOIN flights f ON f.origin = a.iata_code
        WHERE m <= 800000 AND a.iata_code <> 'JFK' AND {IN_YEAR}
        GROUP BY a.iata_code, a.name, a.city, m HAVING count(f.id) >= 1000
        ORDER BY avg_arr_delay DESC NULLS FIRST, a.iata_code LIMIT 15""")
    centre = [_decimal(_half(f"sum({axis} * w)", "(100 * sum(w))")) for axis in "xy"]
    q["g4_airport_clusters"] = statement(f"""
        , departures AS (SELECT origin, count(*) AS k, sum(arr_delay_min) FILTER (WHERE NOT cancelled) AS s,
            {n("NOT cancelled AND arr_delay_min IS NOT NULL")} AS m
          FROM flights WHERE {IN_YEAR} GROUP BY origin),
        weighed AS (SELECT c.*, COALESCE(k, 0) AS k, s, m, CAST(greatest(COALESCE(k, 0), 1) AS HUGEINT) AS w
          FROM clustered c LEFT JOIN departures ON origin = iata_code),
        cities AS (SELECT DISTINCT cluster_id, city FROM clustered WHERE city IS NOT NULL),
        named AS (SELECT cluster_id, string_agg(city, ', ' ORDER BY city) AS sample_cities FROM (
            SELECT * FROM cities QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY city) <= 5)
          GROUP BY cluster_id)
        SELECT cluster_id, count(*) AS airport_count, CAST(sum(k) AS BIGINT) AS total_flights,
          {dbl("sum(s) / NULLIF(sum(m), 0)")} AS avg_delay,
          'POINT(' || {centre[0]} || ' ' || {centre[1]} || ')' AS cluster_centroid,
          COALESCE(any_value(sample_cities), '') AS sample_cities
        FROM weighed LEFT JOIN named USING (cluster_id) GROUP BY cluster_id""", *AIRPORT_INGEST, CLUSTERED)
    q["g5_short_route_delay"] = statement(f"""
        , r AS (SELECT origin, destination, count(*) AS total_flights, {dbl(ARR)} AS avg_delay FROM flights
          WHERE NOT cancelled AND {IN_YEAR} GROUP BY origin, destination HAVING count(*) >= 500),
        k AS (SELECT r.origin, r.destination, o.name AS origin_name, d.name AS dest_name,
          {dbl(f"({ROUTE_M}) / 1000", 1)} AS distance_km, total_flights, avg_delay
          FROM r {ENDS} WHERE {LOCATED} AND ({ROUTE_M}) < 500000)
        SELECT *, avg_delay / NULLIF(distance_km, 0) AS delay_per_km FROM k
        ORDER BY delay_per_km DESC NULLS LAST, origin, destination LIMIT 20""")

    q["q1_out_of_range"] = statement(_range_counts("flights"))
    q["q1_out_of_range_dirty"] = statement(_range_counts("dirty"), DIRTY)
    q["q2_duplicate_keys"] = statement(_duplicates("flights"))
    q["q2_duplicate_keys_dirty"] = statement(_duplicates("dirty"), DIRTY)
    q["q3_month_distribution"] = statement(
        f"SELECT {MONTH} AS month, count(*) AS row_count FROM flights GROUP BY 1")
    q["q4_audit_coverage"] = statement(f"""
        SELECT {SEVERE} AS severe_flights,
          (SELECT count(*) FROM audit WHERE delay_category = 'severe') AS severe_logged FROM flights""", AUDIT)

    q["q4_audit_coverage_dirty"] = statement(f"""
        SELECT {SEVERE} AS severe_flights,
          (SELECT count(*) FROM audit WHERE delay_category = 'severe') AS severe_logged FROM dirty""", AUDIT, DIRTY)

    q["top_routes"] = statement(f"""
        SELECT {ROUTE_REPORT_COLUMNS} FROM routes
        ORDER BY total_flights DESC, origin, destination LIMIT 20""", TOP_ROUTES)
    live = (
        TOP_ROUTES.replace("o.city AS", "COALESCE(o.city, o.name) AS")
        .replace("d.city AS", "COALESCE(d.city, d.name) AS")
        .replace("count(*) >= 100", "count(*) >= 20")
    )
    q["top_routes_live"] = statement(f"""
        SELECT {ROUTE_REPORT_COLUMNS} FROM routes
        ORDER BY total_flights DESC, origin, destination LIMIT 50""", live)
    q["ranking_top20"] = statement("SELECT * FROM ranking ORDER BY rank_position, airline_code LIMIT 20", RANKING)
    q["trend_for"] = statement("""
        SELECT strftime(month, '%Y-%m') AS month, airline_code, on_time_pct, avg_arr_delay, mom_change_pct
        FROM trend WHERE airline_code = 'AA'""", TREND)
    q["trend_for_carriers"] = statement("SELECT * FROM trend WHERE airline_code IN ('AA', 'DL', 'UA')", TREND)
    q["riskiest_routes"] = statement("""
        SELECT * FROM risk ORDER BY risk_score DESC NULLS FIRST, origin, destination LIMIT 20""", RISK)
    q["recent_daily_ops"] = statement("""
        SELECT * FROM daily WHERE airline_code = 'AA' ORDER BY flight_date DESC LIMIT 30""", DAILY)
    q["kpi_bands"] = statement("""
        SELECT *, CASE WHEN on_time_pct >= 80 THEN 'good' ELSE 'warning' END AS on_time_band,
          CASE WHEN cancellation_rate < 3 THEN 'good' ELSE 'bad' END AS cancellation_band FROM score""", SCORE)
    q["quality_flags"] = statement("""
        SELECT *, metric_name <> 'total_rows' AND metric_value > 0 AS is_issue FROM quality""", QUALITY)
    q["b_count_year"] = statement(f"SELECT count(*) AS flight_count FROM flights WHERE {IN_YEAR}")
    q["b_monthly_direct"] = statement(f"""
        SELECT airline_code, {MONTH} AS month, avg(arr_delay_min) AS avg_arr_delay
        FROM flights WHERE NOT cancelled GROUP BY 1, 2""")
    q["b_monthly_slice"] = statement("SELECT * FROM monthly_trend WHERE airline_code = 'AA'", MONTHLY_TREND)

    q["stream_delay_audit"] = q["delay_audit"]
    q["stream_insert_flights"] = statement(f"""
        SELECT * FROM flights QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY id) = 1""")
    q["stream_refresh"] = q["refresh_summaries"]
    q["stream_refresh_corrected"] = statement(_tall(), *SUMMARY_TABLES, flights=CORRECTED)
    q["stream_insert_recent"] = statement(f"""
        , arrivals AS (SELECT *, CAST(floor((dayofyear(flight_date) + (id // 10) % 75 + again) / 80) AS INT) AS arrival
          FROM flights, (VALUES (0), (100)) AS v(again)),
        days AS (SELECT arrival, max(flight_date) AS latest FROM arrivals GROUP BY arrival),
        passed AS (SELECT arrival, max(latest) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 31 AS mark
          FROM days),
        firsts AS (SELECT * FROM arrivals QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY arrival, id) = 1)
        SELECT f.* EXCLUDE (again, arrival), coalesce(f.flight_date <= p.mark, FALSE) AS is_late
        FROM firsts AS f JOIN passed AS p USING (arrival)""")
    q["insert_flights_filtered"] = q["insert_flights"]
    q["partition_rows_footers"] = statement("""
        , names AS (SELECT 'flights_2023_' || lpad(CAST(m AS VARCHAR), 2, '0') AS partition_name
          FROM range(1, 13) AS r(m) UNION ALL SELECT 'flights_default'),
        counted AS (SELECT 'flights_' || strftime(flight_date, '%Y_%m') AS partition_name, count(*) AS k,
          min(flight_date) AS first_date, max(flight_date) AS last_date FROM flights GROUP BY 1)
        SELECT partition_name, COALESCE(k, 0) AS row_count, first_date, last_date
        FROM names LEFT JOIN counted USING (partition_name)""")
    q["month_distribution_footers"] = statement(
        "SELECT strftime(flight_date, '%Y-%m') AS month, count(*) AS row_count FROM flights GROUP BY 1")
    q["count_year_footers"] = q["b_count_year"]
    in_texts = (*AIRPORT_INGEST, RAW_TEXT, RAW, CARRIERS)
    q["search_all_words"] = statement(_search(
        "CASE WHEN token = 'blue' THEN 1 END, CASE WHEN token = 'brand' THEN 2 END",
        "HAVING count(DISTINCT word) = 2"), *in_texts)
    q["search_any_word"] = statement(_search(
        "CASE WHEN token = 'hot' THEN 1 END, CASE WHEN token = 'air' THEN 2 END, CASE WHEN token = 'lines' THEN 3 END"), *in_texts)
    q["search_prefix"] = statement(_search(
        "CASE WHEN token = 'brand' THEN 1 END, CASE WHEN token LIKE 'b%' THEN 2 END",
        "HAVING count(DISTINCT word) = 2"), *in_texts)
    stored = """ups AS (SELECT iata_code, name, city, country, lon, lat, elevation_ft FROM listed UNION ALL
          SELECT * FROM airports WHERE iata_code NOT IN (SELECT iata_code FROM listed))"""
    q["deleted_airports"] = statement("""
        SELECT *, TRUE AS refused FROM ups WHERE iata_code IN (SELECT origin FROM flights)
          OR iata_code IN (SELECT destination FROM flights)""", *AIRPORT_INGEST, stored)
    apart = metres("a.lon", "a.lat", "b.lon", "b.lat")
    q["g3_airports_around_each"] = statement(f"""
        , located AS (SELECT * FROM ups WHERE lon IS NOT NULL AND lat IS NOT NULL),
        near AS (SELECT a.iata_code, b.iata_code AS other, {apart} AS m
          FROM located a, located b WHERE a.iata_code <> b.iata_code AND {apart} <= 500000)
        SELECT iata_code, count(*) AS airports_near, arg_min(other, {{'m': m, 'o': other}}) AS nearest,
          round(min(m) / 1000, 1) AS nearest_km FROM near GROUP BY iata_code""", *AIRPORT_INGEST, stored)
    return q


def oracle_statements() -> dict[str, str]:
    """Statements by query name, for all queries."""
    return _build()
