"""Spatial analytics.

Flights are first reduced to one row per route or per origin; coordinates, names and
distances come in afterwards, on the reduced rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions import geo
from tarmac.functions import measures as m
from tarmac.functions.dates import date_range
from tarmac.functions.numeric import decimals_to_double, ratio, round_double, rounded
from tarmac.operators.views import head, with_route_ends

# The hubs compared, and the report limits.
HUBS = ("JFK", "LAX", "ORD", "ATL", "DFW")
JFK_POINT = (-73.7789, 40.6398)
MIN_DEPARTURES = 1000
MIN_SHORT_ROUTE_FLIGHTS = 500
SHORT_ROUTE_M = 500_000
TOP_ROUTES = 20
TOP_NEARBY = 15
SAMPLE_CITIES = 5

_ROUTE_M = geo.distance_m("origin_lon", "origin_lat", "dest_lon", "dest_lat")


def _located(airports: DataFrame) -> DataFrame:
    return airports.filter("lon IS NOT NULL AND lat IS NOT NULL")


def _km(metres: str) -> str:
    return round_double(f"{metres} / 1000", 1)


def _with_metres(routes: DataFrame, airports: DataFrame, located_only: bool = True) -> DataFrame:
    ends = with_route_ends(routes, airports, located_only)
    return ends.selectExpr("*", f"{_ROUTE_M} AS _metres")


def hub_distances(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """Measured against reported distance for each pair of hubs, low code to high code.

    A hub without a location stays, with no measured distance.
    """
    between_hubs = flights.filter(
        F.col("origin").isin(*HUBS) & F.col("destination").isin(*HUBS) & F.expr("origin < destination")
    )
    pairs = m.measures(between_hubs, ["origin", "destination"])
    reported = rounded(f"{ratio('dist_sum', 'dist_n')} * {geo.KM_PER_MILE}", 1)
    return decimals_to_double(
        _with_metres(pairs, airports, located_only=False).selectExpr(
            "origin",
            "origin_name",
            "destination",
            "dest_name",
            f"{_km('_metres')} AS distance_km",
            f"{reported} AS bts_distance_km",
        )
    ).orderBy(F.expr("distance_km").desc_nulls_first(), "origin", "destination")


def busiest_routes(
    flights: DataFrame, airports: DataFrame, top: int | None = TOP_ROUTES
) -> DataFrame:
    """The flown routes with most flights, with coordinates and GeoJSON for a map."""
    routes = m.measures(flights.filter(m.COMPLETED), ["origin", "destination"])
    located = decimals_to_double(
        with_route_ends(routes, airports).selectExpr(
            "origin",
            "destination",
            "origin_name",
            "dest_name",
            "origin_city",
            "dest_city",
            "total_flights",
            f"{m.AVG_ARR_DELAY} AS avg_delay_min",
            "origin_lat",
            "origin_lon",
            "dest_lat",
            "dest_lon",
            f"{geo.point_geojson('origin_lon', 'origin_lat')} AS origin_geojson",
            f"{geo.point_geojson('dest_lon', 'dest_lat')} AS dest_geojson",
            f"{_km(f'({_ROUTE_M})')} AS distance_km",
        )
    )
    # order and limit last, so that the plan is a top-k
    return head(located.orderBy(F.desc("total_flights"), "origin", "destination"), top)


def airports_within(
    flights: DataFrame,
    airports: DataFrame,
    start: str,
    end: str,
    lon: float = JFK_POINT[0],
    lat: float = JFK_POINT[1],
    radius_m: float = 800_000,
    exclude: str = "JFK",
    top: int | None = TOP_NEARBY,
) -> DataFrame:
    """Busy airports near a point, the most delayed first."""
    metres = geo.distance_m("lon", "lat", f"{float(lon)}D", f"{float(lat)}D")
    near = (
        _located(airports)
        .filter(geo.in_latitude_band("lat", float(lat), radius_m))
        .selectExpr("*", f"{metres} AS _metres")
        .filter(f"_metres <= {float(radius_m)}D")
        .filter(F.col("iata_code") != exclude)
    )
    departures = (
        m.measures(date_range(flights, start, end), ["origin AS iata_code"])
        .filter(f"total_flights >= {MIN_DEPARTURES}")
        .join(near, "iata_code")
    )
    nearby = decimals_to_double(
        departures.selectExpr(
            "iata_code",
            "name",
            "city",
            f"{_km('_metres')} AS dist_from_jfk_km",
            "total_flights AS total_departures",
            f"{m.AVG_ARR_DELAY} AS avg_arr_delay",
            f"{m.CANCELLATION_RATE} AS cancellation_rate",
        )
    )
    return head(nearby.orderBy(F.expr("avg_arr_delay").desc_nulls_first(), "iata_code"), top)


#: Least and largest radius of a sphere that is used for bounds, in metres, and the slack put on them.
_POLE_RADIUS_M, _SLACK = 6_356_752.0, 1.01


def _grid_cells(lat: str, radius_m: float) -> str:
    """How many cells the latitude band of a point is cut into around the globe.

    A cell is as wide as two points of this band or the next ones can lie apart in longitude
    within the radius: by the haversine, the sine of half of it is that of half the angle of the
    radius over the cosine of the highest latitude. Around a pole one cell holds all.
    """
    height = radius_m / 110_000.0
    edge = f"(floor(({lat} + 90) / {height!r}D) * {height!r}D - 90)"
    highest = f"least(90D, greatest(abs({edge} - {height!r}D), abs({edge} + {2 * height!r}D)) + 0.3D)"
    share = f"({math.sin(min(math.pi / 2, _SLACK * radius_m / (2 * _POLE_RADIUS_M)))!r}D / greatest(1e-9D, cos(radians({highest}))))"
    width = f"degrees(2 * asin(least(1D, {share})))"
    return f"CAST(greatest(1D, floor(360D / {width})) AS INT)"


def pairs_within(centres: DataFrame, points: DataFrame, radius_m: float) -> DataFrame:
    """Pairs of a centre and a point (columns code, lon, lat) not farther apart than the radius: centre, point, metres.

    An equi-join on grid cells: a point lies in one cell, a centre asks for those around its own
    in three bands of latitude, over the antimeridian too; only pairs that meet in a cell are
    measured. Rows without a location pair with nothing.
    """
    height = radius_m / 110_000.0
    cell = "CAST(least(floor((lon + 180) / 360 * _cells), _cells - 1) AS INT)"
    located = "lon IS NOT NULL AND lat IS NOT NULL"
    band = f"CAST(floor((lat + 90) / {height!r}D) AS INT)"
    placed = points.filter(located).selectExpr(
        "code AS point", "lon AS point_lon", "lat AS point_lat", "lon", f"{band} AS band", f"{_grid_cells('lat', radius_m)} AS _cells"
    ).selectExpr("* EXCEPT (lon, _cells)", f"{cell} AS cell")
    asked = centres.filter(located).selectExpr("code AS centre", "lon", "lat", f"explode(sequence({band} - 1, {band} + 1)) AS band")
    # a latitude in the middle of the band that is asked
    asked = asked.selectExpr("*", f"{_grid_cells(f'((band + 0.5D) * {height!r}D - 90)', radius_m)} AS _cells").selectExpr(
        "centre", "lon", "lat", "band",
        f"explode(array_distinct(transform(array(-1, 0, 1), i -> pmod({cell} + i, _cells)))) AS cell")
    metres = geo.distance_m("lon", "lat", "point_lon", "point_lat")
    return asked.join(placed, ["band", "cell"]).selectExpr("centre", "point", f"{metres} AS metres").filter(
        f"metres <= {float(radius_m)!r}D")


def airports_around_each(airports: DataFrame, radius_m: float = SHORT_ROUTE_M) -> DataFrame:
    """Per located airport with another one in reach: how many there are, and the nearest (equals by code)."""
    places = _located(airports).selectExpr("iata_code AS code", "lon", "lat")
    near = pairs_within(places, places, radius_m).filter("centre <> point")
    return near.groupBy(F.col("centre").alias("iata_code")).agg(
        F.expr("count(1) AS airports_near"), F.expr("min(struct(metres, point)) AS _nearest")
    ).selectExpr("iata_code", "airports_near", "_nearest.point AS nearest", f"{_km('_nearest.metres')} AS nearest_km")


def short_route_delay(
    flights: DataFrame, airports: DataFrame, start: str, end: str, top: int | None = TOP_ROUTES
) -> DataFrame:
    """Delay per kilometre of busy routes shorter than 500 km."""
    flown = date_range(flights, start, end).filter(m.COMPLETED)
    routes = m.measures(flown, ["origin", "destination"]).filter(
        f"total_flights >= {MIN_SHORT_ROUTE_FLIGHTS}"
    )
    short = (
        _with_metres(routes, airports)
        .filter(f"_metres < {SHORT_ROUTE_M}D")
        .selectExpr(
            "origin",
            "destination",
            "origin_name",
            "dest_name",
            f"{_km('_metres')} AS distance_km",
            "total_flights",
            f"CAST({m.AVG_ARR_DELAY} AS DOUBLE) AS avg_delay",
        )
    )
    per_km = short.selectExpr("*", "avg_delay / nullif(distance_km, 0D) AS delay_per_km")
    return head(per_km.orderBy(F.expr("delay_per_km").desc_nulls_last(), "origin", "destination"), top)


# Squared distance of two points in degrees; products of these decimals are exact.
_POINT = "DECIMAL(13,8)"


def _squared(lon: str, lat: str) -> str:
    dx, dy = f"(lon_d - CAST({lon} AS {_POINT}))", f"(lat_d - CAST({lat} AS {_POINT}))"
    return f"({dx} * {dx} + {dy} * {dy})"


def _means(clustered: DataFrame) -> list[tuple]:
    """The centre of each cluster, rounded to the eighth digit; one row per cluster comes back."""
    by = clustered.groupBy("cluster_id").agg(
        F.expr(f"CAST(round(sum(lon_d) / count(1), 8) AS {_POINT}) AS lon"),
        F.expr(f"CAST(round(sum(lat_d) / count(1), 8) AS {_POINT}) AS lat"),
    )
    return [(r["lon"], r["lat"]) for r in sorted(by.collect(), key=lambda r: r["cluster_id"])]


def _assigned(points: DataFrame, centres: list[tuple]) -> DataFrame:
    """Each point with the index of the nearest centre, the first of equals."""
    each = ", ".join(f"struct({_squared(lon, lat)} AS d, {i} AS i)" for i, (lon, lat) in enumerate(centres))
    return points.selectExpr("* EXCEPT (cluster_id)", f"array_min(array({each})).i AS cluster_id")


def cluster_airports(
    airports: DataFrame, k: int = 6, country: str | None = "US", rounds: int = 200
) -> DataFrame:
    """Located airports of a country (None: all) with a `cluster_id` by k-means on longitude and latitude.

    The start is fixed: the airport farthest from the mean of all, then k - 1 times the one
    farthest from those chosen, equals by code. Rounds of assignment and means follow until no
    centre moves. All on exact decimals, so that the result does not depend on the order of
    summation; only the k centres come to the driver. The table is read in every round, so it had
    better be a stored one. Centres that still move after `rounds` raise an error. With fewer airports than k, each place is
    chosen once and the clusters are fewer.
    """
    located = _located(airports)
    if country is not None:
        located = located.filter(F.col("country") == country)
    points = located.selectExpr(
        "*", f"CAST(lon AS {_POINT}) AS lon_d", f"CAST(lat AS {_POINT}) AS lat_d", "0 AS cluster_id"
    )
    from_all, centres = _means(points), []
    for _ in range(k):
        near = ", ".join(_squared(lon, lat) for lon, lat in centres or from_all)
        nearest = f"array_min(array({near}))"
        far = points.selectExpr("lon_d", "lat_d", "iata_code", f"-{nearest} AS less")
        best = far.agg(F.expr("min(struct(less, iata_code, lon_d, lat_d)) AS best")).collect()[0]["best"]
        if best is None or (centres and best["less"] == 0):
            break
        centres.append((best["lon_d"], best["lat_d"]))
    if not centres:
        return points.drop("lon_d", "lat_d")
    for _ in range(rounds):
        moved = _means(_assigned(points, centres))
        if moved == centres:
            break
        centres = moved
    else:
        raise RuntimeError(f"the centres still move after {rounds} rounds")
    return _assigned(points, centres).drop("lon_d", "lat_d")


def _weighted(column: str, weight: str) -> str:
    """Weighted mean of exact decimals, with four digits."""
    total = f"sum(CAST({column} AS DECIMAL(10,6)) * CAST({weight} AS DECIMAL(12,0)))"
    return f"CAST(round({total} / sum({weight}), 4) AS DECIMAL(9,4))"


def airport_clusters(
    flights: DataFrame,
    airports: DataFrame,
    start: str,
    end: str,
    k: int = 6,
    country: str | None = "US",
    cities: int = SAMPLE_CITIES,
) -> DataFrame:
    """Traffic and delay per airport cluster.

    The centre weighs each airport by its flights (an airport without any counts once).
    The first city names by alphabet come from the airport table alone.
    """
    clustered = cluster_airports(airports, k, country)
    departures = m.measures(date_range(flights, start, end), ["origin AS iata_code"]).selectExpr(
        "iata_code", "total_flights", "arr_sum", "arr_n"
    )
    weight = "greatest(coalesce(total_flights, 0), 1)"
    per_cluster = (
        clustered.join(departures, "iata_code", "left")
        .groupBy("cluster_id")
        .agg(
            F.expr("count(1) AS airport_count"),
            F.expr("sum(coalesce(total_flights, 0)) AS total_flights"),
            F.expr("sum(arr_sum) AS arr_sum"),
            F.expr("sum(arr_n) AS arr_n"),
            F.expr(f"{_weighted('lon', weight)} AS _lon"),
            F.expr(f"{_weighted('lat', weight)} AS _lat"),
        )
    )
    # The row-number limit is applied in each task first, so few names per cluster travel.
    first_cities = (
        clustered.filter("city IS NOT NULL")
        .select("cluster_id", "city")
        .distinct()
        .selectExpr("*", "row_number() OVER (PARTITION BY cluster_id ORDER BY city) AS _place")
        .filter(f"_place <= {cities}")
        .groupBy("cluster_id")
        .agg(F.expr("array_join(sort_array(collect_list(city)), ', ') AS _cities"))
    )
    return decimals_to_double(
        per_cluster.join(first_cities, "cluster_id", "left").selectExpr(
            "cluster_id",
            "airport_count",
            "total_flights",
            f"{m.AVG_ARR_DELAY} AS avg_delay",
            "concat('POINT(', CAST(_lon AS STRING), ' ', CAST(_lat AS STRING), ')') AS cluster_centroid",
            "coalesce(_cities, '') AS sample_cities",
        )
    ).orderBy(F.expr("avg_delay").desc_nulls_first(), "cluster_id")
