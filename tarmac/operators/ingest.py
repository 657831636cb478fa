"""From raw text rows to typed, checked, de-duplicated tables.

Rows are judged one by one: an unparsable row is skipped, a row that breaks a table
rule is rejected with its reasons, and a row whose business key is already there is
ignored. Nothing is rejected because of its neighbours.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions import parsing as p
from tarmac.functions.measures import CAUSES
from tarmac.functions.text import search_tokens
from tarmac.operators.quality import BUSINESS_KEY, EARLIEST_DELAY

# Raw flight columns and the table columns they fill.
RAW_FLIGHT_COLUMNS = {
    "FL_DATE": "flight_date",
    "OP_UNIQUE_CARRIER": "airline_code",
    "OP_CARRIER_FL_NUM": "flight_number",
    "ORIGIN": "origin",
    "DEST": "destination",
    "DEP_TIME": "dep_time",
    "DEP_DELAY": "dep_delay_min",
    "ARR_TIME": "arr_time",
    "ARR_DELAY": "arr_delay_min",
    "CANCELLED": "cancelled",
    "DIVERTED": "diverted",
    "DISTANCE": "distance_miles",
    "CARRIER_DELAY": "carrier_delay",
    "WEATHER_DELAY": "weather_delay",
    "NAS_DELAY": "nas_delay",
    "SECURITY_DELAY": "security_delay",
    "LATE_AIRCRAFT_DELAY": "late_aircraft_delay",
}

# Position of a row in its source: file, block offset, row in the scan.
SOURCE_COLUMNS = ("source_file", "source_block", "source_row")

# Carriers with a known name.
KNOWN_AIRLINES = (
    ("AA", "American Airlines", "US"),
    ("AS", "Alaska Airlines", "US"),
    ("B6", "JetBlue Airways", "US"),
    ("DL", "Delta Air Lines", "US"),
    ("F9", "Frontier Airlines", "US"),
    ("G4", "Allegiant Air", "US"),
    ("HA", "Hawaiian Airlines", "US"),
    ("NK", "Spirit Airlines", "US"),
    ("OH", "PSA Airlines", "US"),
    ("OO", "SkyWest Airlines", "US"),
    ("QX", "Horizon Air", "US"),
    ("UA", "United Airlines", "US"),
    ("WN", "Southwest Airlines", "US"),
    ("WS", "WestJet", "CA"),
    ("MQ", "Envoy Air", "US"),
    ("YV", "Mesa Airlines", "US"),
    ("YX", "Republic Airways", "US"),
    ("9E", "Endeavor Air", "US"),
    ("ZW", "Air Wisconsin", "US"),
    ("CP", "Compass Airlines", "US"),
)

# Airport types kept, in order of preference.
AIRPORT_TYPES = ("large_airport", "medium_airport", "small_airport")

_TEXTS = ("flight_date", "airline_code", "flight_number", "origin", "destination")

# The business key in the order in which stored months are sorted: rows that are read in it need
# little sorting to be grouped.
SORTED_KEY = ("airline_code", *[c for c in BUSINESS_KEY if c != "airline_code"])


# ---------------------------------------------------------------- flights


def parse_flights(raw: DataFrame) -> DataFrame:
    """Typed columns plus `is_valid`; every raw row stays. Source columns pass through.

    The twelve numeric texts of a row are read into an array before anything is made of them:
    spelled out, the whole projection would outgrow what the JVM compiles, and run many times
    slower. Whether any of them has a letter to spoil is asked once a row.
    """
    kept = [c for c in raw.columns if c not in RAW_FLIGHT_COLUMNS]
    raw_name = {target: source for source, target in RAW_FLIGHT_COLUMNS.items()}
    numeric = [c for c in raw_name if c not in _TEXTS]
    texts = [f"{raw_name[c]} AS {c}" for c in _TEXTS]
    read = raw.selectExpr(*texts, f"{p.to_numbers([raw_name[c] for c in numeric])} AS _n", *kept)
    number = {c: f"_n[{i}]" for i, c in enumerate(numeric)}

    typed = {
        "flight_date": p.to_day("flight_date"),
        "airline_code": p.code("airline_code"),
        "flight_number": p.stripped_or_null("flight_number", 10),
        "origin": p.code("origin"),
        "destination": p.code("destination"),
        **{c: p.clock(number[c]) for c in ("dep_time", "arr_time")},
        **{c: p.flag(number[c]) for c in ("cancelled", "diverted")},
        **{c: p.whole(number[c]) for c in ("distance_miles", *[f"{c}_delay" for c in CAUSES])},
    }
    for name in ("dep_delay_min", "arr_delay_min"):
        minutes = p.whole(number[name])
        typed[name] = f"CASE WHEN {minutes} >= {EARLIEST_DELAY} THEN {minutes} END"
    parsed = read.selectExpr(*[f"{typed[c]} AS {c}" for c in raw_name], *kept)
    return parsed.selectExpr(
        "*",
        "flight_date IS NOT NULL AND coalesce(length(airline_code) = 2 AND length(origin) = 3"
        " AND length(destination) = 3, FALSE) AS is_valid",
    )


def ingest_flights(raw: DataFrame) -> DataFrame:
    """The parsable rows.

    Kept by unfolding an array of one mark or none: a filter would be pushed down to the texts, and
    dates and codes be parsed once for it and again for the rows.
    """
    kept = "explode(if(is_valid, array(0), array())) AS _kept"
    return parse_flights(raw).selectExpr("*", kept).drop("is_valid", "_kept")


def with_flight_id(flights: DataFrame) -> DataFrame:
    """A 64-bit id from the business key: the same row gets the same id on every load.

    A label, not the identity: among 10^12 flights a few ten thousand share one. What must
    tell flights apart (insert, audit look-ups) compares the business key.
    """
    key = ", ".join(f"coalesce(CAST({k} AS STRING), '\\0')" for k in BUSINESS_KEY)
    return flights.selectExpr(
        f"xxhash64({key}) AS id", *[f"`{c}`" for c in flights.columns if c != "id"]
    )


def check_constraints(flights: DataFrame, airlines: DataFrame, airports: DataFrame) -> DataFrame:
    """Add `reject_reason`: the broken rules joined by commas, NULL for a good row.

    A NULL value breaks no rule except the missing date. Codes are looked up with left
    joins on the key columns of the dimensions, which Spark broadcasts while small and
    otherwise shuffles with adaptive skew splitting.
    """

    def known(dim: DataFrame, key: str, mark: str) -> DataFrame:
        return dim.selectExpr(f"iata_code AS {key}", f"TRUE AS {mark}").distinct()

    marked = (
        flights.join(known(airlines, "airline_code", "_airline"), "airline_code", "left")
        .join(known(airports, "origin", "_origin"), "origin", "left")
        .join(known(airports, "destination", "_destination"), "destination", "left")
    )
    rules = {
        "missing_flight_date": "flight_date IS NULL",
        "same_origin_destination": "origin = destination",
        "distance_not_positive": "distance_miles <= 0",
        "dep_delay_too_early": f"dep_delay_min < {EARLIEST_DELAY}",
        "arr_delay_too_early": f"arr_delay_min < {EARLIEST_DELAY}",
        "negative_delay_cause": " OR ".join(f"{cause}_delay < 0" for cause in CAUSES),
        "unknown_airline": "airline_code IS NOT NULL AND _airline IS NULL",
        "unknown_origin": "origin IS NOT NULL AND _origin IS NULL",
        "unknown_destination": "destination IS NOT NULL AND _destination IS NULL",
    }
    reasons = ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in rules.items())
    return marked.selectExpr(
        *[f"`{c}`" for c in flights.columns],
        f"nullif(concat_ws(',', {reasons}), '') AS reject_reason",
    )


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter("reject_reason IS NULL").drop("reject_reason")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.filter("reject_reason IS NOT NULL")


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key (NULLs equal) in `order`, remaining columns as tie-break.

    An aggregation rather than a window: each map task sends on one row per key, so a
    key that fills a third of the input does not end up in one task.
    """
    rest = [c for c in rows.columns if c not in keys and c not in order]
    fields = ", ".join(f"`{c}`" for c in (*order, *rest))
    best = rows.groupBy(*keys).agg(F.expr(f"min(struct({fields})) AS _first"))
    return best.selectExpr(
        *[f"`{c}`" if c in keys else f"_first.`{c}` AS `{c}`" for c in rows.columns]
    )


def insert_flights(
    new: DataFrame, existing: DataFrame, order: Sequence[str] = SOURCE_COLUMNS
) -> DataFrame:
    """The rows of `new` to add: first per business key, and not yet in `existing`.

    Stored keys and new rows go through one grouping in which a stored key comes
    first, so a single shuffle settles both kinds of conflict, NULLs compare equal, and
    each map task sends on at most one row per key.
    """
    stored = existing.selectExpr(*SORTED_KEY, "0 AS _arrival")
    merged = new.selectExpr("*", "1 AS _arrival").unionByName(stored, allowMissingColumns=True)
    first = first_per_key(merged, SORTED_KEY, ["_arrival", *order])
    return first.filter("_arrival = 1").drop("_arrival")


def file_stats(checked: DataFrame, inserted: DataFrame) -> DataFrame:
    """Rows per source file: total, inserted, skipped (unparsable) and errors (rejected).

    `checked` holds every raw row with `is_valid` and `reject_reason`; `inserted` the
    rows that reached the table. What remains of the total are ignored duplicates.
    """
    seen = checked.groupBy("source_file").agg(
        F.expr("count(1) AS total_rows"),
        F.expr("count_if(NOT is_valid) AS skipped"),
        F.expr("count_if(is_valid AND reject_reason IS NOT NULL) AS errors"),
    )
    added = inserted.groupBy("source_file").agg(F.expr("count(1) AS _inserted"))
    return seen.join(added, "source_file", "left").selectExpr(
        "source_file", "total_rows", "coalesce(_inserted, 0) AS inserted", "skipped", "errors"
    )


def dry_run(
    raw: DataFrame, sample: int | None = None, order: Sequence[str] = SOURCE_COLUMNS
) -> DataFrame:
    """Parse every row and report the failures per source file; writes nothing.

    With `sample`, only that many first rows of each file are parsed.
    """
    parsed, counted = parse_flights(raw), "NOT is_valid"
    if sample is not None:
        by = ", ".join(c for c in order if c in raw.columns and c != "source_file")
        first = f"row_number() OVER (PARTITION BY source_file ORDER BY {by}) <= {int(sample)}"
        parsed, counted = parse_flights(raw.selectExpr("*", f"{first} AS _sampled")), "_sampled AND NOT is_valid"
    return parsed.groupBy("source_file").agg(
        F.expr("count(1) AS total_rows"),
        F.expr("0L AS inserted"),
        F.expr(f"count_if({counted}) AS skipped"),
        F.expr("0L AS errors"),
    )


# ---------------------------------------------------------------- dimensions


def ingest_airports(raw: DataFrame) -> DataFrame:
    """One typed row per airport code from an airport listing.

    A code listed several times keeps its largest type (then the first name); if that
    row lacks a name or a location the code is dropped. Codes that differ only in
    case meet after upper-casing, where the smaller type overwrites the larger one.
    """
    zones = [p.stripped_or_null(c) for c in ("tzid", "time_zone") if c in raw.columns]
    types = ", ".join(f"'{t}'" for t in AIRPORT_TYPES)
    listed = raw.filter(
        f"length(iata_code) = 3 AND {p.strip('iata_code')} <> '' AND type IN ({types})"
    ).selectExpr(
        "iata_code AS raw_code",
        f"array_position(array({types}), type) AS type_rank",
        f"{p.stripped_or_null('name')} AS name",
        f"{p.stripped_or_null('municipality')} AS city",
        f"{p.stripped_or_null('iso_country', 2)} AS country",
        f"{p.known(p.to_number('longitude_deg'))} AS lon",
        f"{p.known(p.to_number('latitude_deg'))} AS lat",
        f"{p.whole(p.to_number('elevation_ft'))} AS elevation_ft",
        f"coalesce({', '.join([*zones, 'CAST(NULL AS STRING)'])}) AS timezone",
    )
    best = first_per_key(listed, ["raw_code"], ["type_rank", "name"])
    complete = (
        best.filter("name IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL")
        .selectExpr("*", f"{p.code('raw_code')} AS iata_code")
        .filter("length(iata_code) = 3")
    )
    fields = ("name", "city", "country", "lon", "lat", "elevation_ft", "timezone")
    last = F.expr(f"max(struct(type_rank, raw_code, {', '.join(fields)})) AS _last")
    return complete.groupBy("iata_code").agg(last).selectExpr(
        "iata_code", *[f"_last.{c} AS {c}" for c in fields]
    )


def known_airlines(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{code}', '{name}', '{country}')" for code, name, country in KNOWN_AIRLINES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(iata_code, name, country)")


def ingest_airlines(raw: DataFrame) -> DataFrame:
    """One row per carrier code seen in the raw flights, named where it is known."""
    codes = raw.selectExpr(f"{p.code('OP_UNIQUE_CARRIER')} AS iata_code").distinct()
    known = known_airlines(raw.sparkSession)
    return codes.filter("length(iata_code) = 2").join(known, "iata_code", "left").selectExpr(
        "iata_code",
        "coalesce(name, concat('Airline ', iata_code)) AS name",
        "coalesce(country, 'US') AS country",
    )


def upsert(old: DataFrame, new: DataFrame, key: str = "iata_code") -> DataFrame:
    """`old` with the rows of `new` put in; on an equal key the new row replaces the old."""
    return new.unionByName(old.join(new.select(key), key, "left_anti"))


def airport_search_tokens(airports: DataFrame) -> DataFrame:
    tokens = search_tokens("name", "city", "iata_code", "country")
    return airports.selectExpr("*", f"{tokens} AS search_tokens")


def airline_search_tokens(airlines: DataFrame) -> DataFrame:
    tokens = search_tokens("name", "iata_code", "country")
    return airlines.selectExpr("*", f"{tokens} AS search_tokens")


def search_index(airports: DataFrame, airlines: DataFrame) -> DataFrame:
    """Word to codes, for both dimensions; one row per word and code.

    Kept as pairs rather than as a list per word: a common word may point at every
    airport, and a lookup by word reads the same rows either way.
    """

    def pairs(dim: DataFrame, entity: str) -> DataFrame:
        return dim.selectExpr(
            "explode(search_tokens) AS token", f"'{entity}' AS entity", "iata_code AS code"
        )

    return pairs(airport_search_tokens(airports), "airport").unionByName(
        pairs(airline_search_tokens(airlines), "airline")
    )


def delete_airports(candidates: DataFrame, flights: DataFrame) -> DataFrame:
    """Mark each candidate code `deletable`, which it is unless a flight uses it."""
    used = (
        flights.selectExpr("explode(array(origin, destination)) AS iata_code")
        .distinct()
        .selectExpr("iata_code", "TRUE AS _used")
    )
    return candidates.join(used, "iata_code", "left").selectExpr(
        *[f"`{c}`" for c in candidates.columns], "_used IS NULL AS deletable"
    )
