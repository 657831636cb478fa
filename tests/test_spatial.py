import math

import pytest
from pyspark.sql import functions as F

from tarmac.functions import geo
from tarmac.operators import spatial


def metres(spark, *points):
    return spark.range(1).selectExpr(geo.distance_m(*[f"{float(x)}D" for x in points])).first()[0]


def test_known_distance(spark):
    assert metres(spark, -73.7789, 40.6398, -118.4081, 33.9425) == pytest.approx(3_982_949, abs=3)


def test_quarter_meridian(spark):
    assert metres(spark, 0, 0, 0, 90) == pytest.approx(10_001_966, abs=300)


def test_same_and_opposite_points(spark):
    assert metres(spark, 10, 20, 10, 20) == 0
    assert metres(spark, 0, 0, 180, 0) == pytest.approx(math.pi * geo.EQUATOR_RADIUS_M)


def test_unknown_coordinate(spark):
    sql = geo.distance_m("CAST(NULL AS DOUBLE)", "1D", "2D", "3D")
    assert spark.range(1).selectExpr(sql).first()[0] is None


def test_box_never_excludes_a_point_in_reach(spark):
    points = spark.range(-179, 180, 7).selectExpr(
        "CAST(id AS DOUBLE) AS lon",
        "explode(transform(sequence(-88, 88, 3), x -> CAST(x AS DOUBLE))) AS lat",
    )
    near = f"({geo.distance_m('lon', 'lat', '10D', '60D')}) <= 2000000"
    band = geo.in_latitude_band("lat", 60.0, 2_000_000)
    assert points.filter(f"{near} AND NOT {band}").count() == 0
    assert points.filter(near).count() > 0


def test_clusters(data, spark):
    clusters = spatial.cluster_airports(data.airports, k=3).collect()
    assert len(clusters) == 7 and len({r.cluster_id for r in clusters}) == 3
    # every airport is nearest to the centre of its own cluster
    centres = {}
    for c in {r.cluster_id for r in clusters}:
        own = [(r.lon, r.lat) for r in clusters if r.cluster_id == c]
        centres[c] = tuple(sum(x) / len(own) for x in zip(*own))
    for r in clusters:
        best = min(centres, key=lambda c: math.dist(centres[c], (r.lon, r.lat)))
        assert best == r.cluster_id
    again = spatial.cluster_airports(data.airports, k=3).collect()
    assert [(r.iata_code, r.cluster_id) for r in clusters] == [(r.iata_code, r.cluster_id) for r in again]


def test_cluster_report_covers_all_departures(data):
    report = spatial.airport_clusters(data.flights, data.airports, "2023-01-01", "2023-12-31", k=3).collect()
    located = [r.iata_code for r in data.airports.filter("country = 'US' AND lon IS NOT NULL").collect()]
    assert sum(r.airport_count for r in report) == len(located)
    assert sum(r.total_flights for r in report) == data.flights.filter(F.col("origin").isin(located)).count()
    assert all(r.cluster_centroid.startswith("POINT(") for r in report)
    assert sum(len(r.sample_cities.split(", ")) for r in report) == 6  # one airport has no city


def test_hub_without_location_keeps_its_row(data):
    lost = data.airports.selectExpr(
        "iata_code", "name", "city", "country", "if(iata_code = 'JFK', NULL, lon) AS lon", "lat")
    report = spatial.hub_distances(data.flights, lost).collect()
    missing = [r for r in report if "JFK" in (r.origin, r.destination)]
    assert missing and report[: len(missing)] == missing
    assert all(r.distance_km is None and r.bts_distance_km > 0 for r in missing)


def test_five_cities_at_most_in_order(data):
    more = data.airports.selectExpr("iata_code", "name", "name AS city", "'US' AS country", "lon", "lat", "elevation_ft")
    report = spatial.airport_clusters(data.flights, more, "2023-01-01", "2023-12-31", k=1).collect()
    names = sorted(r.name for r in more.filter("lon IS NOT NULL").collect())
    assert report[0].sample_cities == ", ".join(names[:5])


def test_grid_pairs_equal_all_pairs(spark):
    """Near the poles, over the antimeridian, on the edges of cells, and everywhere else."""
    import random

    rng = random.Random(3)
    places = [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(150)]
    places += [(rng.choice([-180, 180, 179.5, -179.9, 0, 90]), rng.choice([-90, 90, 89.5, -89.9, 0, 60, 71.3])) for _ in range(60)]
    places += [(rng.uniform(178, 182) % 360 - 360 * (rng.uniform(178, 182) % 360 > 180), rng.uniform(50, 52)) for _ in range(40)]
    places = [(max(-180.0, min(180.0, float(x))), float(y)) for x, y in places]
    rows = [(f"P{i:03d}", x, y) for i, (x, y) in enumerate(places)] + [("NONE", None, 1.0)]
    points = spark.createDataFrame(rows, "code string, lon double, lat double")
    for radius in (50_000.0, 800_000.0, 6_000_000.0):
        found = spatial.pairs_within(points, points, radius)
        other = points.selectExpr("code AS point", "lon AS point_lon", "lat AS point_lat")
        metres = geo.distance_m("lon", "lat", "point_lon", "point_lat")
        exact = points.join(other).selectExpr("code", "point", f"{metres} AS m").filter(f"m <= {radius}D")
        told = [(r["centre"], r["point"]) for r in found.collect()]
        assert len(told) == len(set(told)) and set(told) == {(r["code"], r["point"]) for r in exact.collect()}
    plan = spatial.airports_around_each(points.withColumnRenamed("code", "iata_code"))._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
