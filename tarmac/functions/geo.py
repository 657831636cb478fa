"""Distances on the WGS 84 spheroid, as SQL expression text."""

from __future__ import annotations

# WGS 84 semi-major axis in metres and flattening.
EQUATOR_RADIUS_M = 6378137.0
FLATTENING = 1 / 298.257223563
KM_PER_MILE = "1.60934"


def _sq(x: str) -> str:
    return f"power({x}, 2)"


def distance_m(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    """Metres between two points by Lambert's long-line formula.

    The formula corrects the central angle of the reduced latitudes; it is 0/0 for
    equal points (distance 0) and singular for opposite ones (spherical distance). An
    unknown coordinate gives NULL, which needs saying as `least` passes over NULLs.
    """
    squash = f"CAST({1 - FLATTENING!r} AS DOUBLE)"
    half_f = f"CAST({FLATTENING / 2!r} AS DOUBLE)"
    b1 = f"atan({squash} * tan(radians({lat1})))"
    b2 = f"atan({squash} * tan(radians({lat2})))"
    d_lon = f"(radians({lon2}) - radians({lon1}))"
    hav = f"({_sq(f'sin(({b2} - {b1}) / 2)')} + cos({b1}) * cos({b2}) * {_sq(f'sin({d_lon} / 2)')})"
    angle = f"(2 * asin(sqrt(least(1D, {hav}))))"
    p, q = f"(({b1} + {b2}) / 2)", f"(({b2} - {b1}) / 2)"
    x = f"({angle} - sin({angle})) * {_sq(f'sin({p})')} * {_sq(f'cos({q})')} / {_sq(f'cos({angle} / 2)')}"
    y = f"({angle} + sin({angle})) * {_sq(f'cos({p})')} * {_sq(f'sin({q})')} / {_sq(f'sin({angle} / 2)')}"
    radius = f"CAST({EQUATOR_RADIUS_M} AS DOUBLE)"
    return (
        f"CASE WHEN {hav} IS NULL THEN NULL "
        f"WHEN {lon1} = {lon2} AND {lat1} = {lat2} THEN 0D "
        f"WHEN {hav} > CAST({1 - 1e-12!r} AS DOUBLE) THEN {radius} * {angle} "
        f"ELSE {radius} * ({angle} - {half_f} * ({x} + {y})) END"
    )


def in_latitude_band(lat: str, lat0: float, radius_m: float) -> str:
    """Cheap necessary condition for lying within `radius_m` of a point.

    A degree of latitude is never shorter than 110 km; longitude is left to the exact
    test, as its degrees shrink towards the poles and wrap around.
    """
    return f"abs({lat} - {lat0}D) <= {radius_m / 110_000.0}D"


def point_geojson(lon: str, lat: str) -> str:
    return f"to_json(named_struct('type', 'Point', 'coordinates', array({lon}, {lat})))"
