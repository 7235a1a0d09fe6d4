"""Distances on the sphere, in kilometres, and the weight function of label smoothing.

Arguments are numbers, column names or SQL expressions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Mean earth radius of the great-circle distance.
GREAT_CIRCLE_RADIUS_KM = 6371.009
#: Rounded radius of the haversine distance.
HAVERSINE_RADIUS_KM = 6371.0


def _sql(value: str | float) -> str:
    return f"({value})" if isinstance(value, str) else f"{float(value)!r}D"


def great_circle_sql(lat1, lon1, lat2, lon2) -> str:
    """Great-circle distance, arc-tangent form (well conditioned for near and antipodal points)."""
    phi1, phi2 = f"radians({_sql(lat1)})", f"radians({_sql(lat2)})"
    delta = f"(radians({_sql(lon2)}) - radians({_sql(lon1)}))"
    across = f"(cos({phi2}) * sin({delta}))"
    ahead = f"(cos({phi1}) * sin({phi2}) - sin({phi1}) * cos({phi2}) * cos({delta}))"
    along = f"(sin({phi1}) * sin({phi2}) + cos({phi1}) * cos({phi2}) * cos({delta}))"
    return f"{GREAT_CIRCLE_RADIUS_KM}D * atan2(sqrt({across} * {across} + {ahead} * {ahead}), {along})"


def great_circle_parts_sql(lat, lon) -> dict[str, str]:
    """What the great-circle distance needs of one point: the sine and cosine of its latitude, and its longitude in radians."""
    return {"sin": f"sin(radians({_sql(lat)}))", "cos": f"cos(radians({_sql(lat)}))", "lon": f"radians({_sql(lon)})"}


def angle_cosine_of_parts_sql(sin1, cos1, lon1, sin2, cos2, lon2) -> str:
    """Cosine of the angle between two points."""
    return f"({sin1} * {sin2} + {cos1} * {cos2} * cos({lon2} - {lon1}))"


def great_circle_of_parts_sql(sin1, cos1, lon1, sin2, cos2, lon2) -> str:
    """:func:`great_circle_sql` of two points' parts, with the same roundings."""
    across = f"({cos2} * sin({lon2} - {lon1}))"
    ahead = f"({cos1} * {sin2} - {sin1} * {cos2} * cos({lon2} - {lon1}))"
    along = angle_cosine_of_parts_sql(sin1, cos1, lon1, sin2, cos2, lon2)
    return f"{GREAT_CIRCLE_RADIUS_KM}D * atan2(sqrt({across} * {across} + {ahead} * {ahead}), {along})"


def haversine_sql(lat1, lon1, lat2, lon2) -> str:
    phi1, phi2 = f"radians({_sql(lat1)})", f"radians({_sql(lat2)})"
    half_phi = f"sin(({phi2} - {phi1}) / 2)"
    half_lambda = f"sin((radians({_sql(lon2)}) - radians({_sql(lon1)})) / 2)"
    a = f"({half_phi} * {half_phi} + cos({phi1}) * cos({phi2}) * {half_lambda} * {half_lambda})"
    return f"{2 * HAVERSINE_RADIUS_KM}D * atan2(sqrt({a}), sqrt(1D - {a}))"


def great_circle_km(lat1, lon1, lat2, lon2) -> Column:
    return F.expr(great_circle_sql(lat1, lon1, lat2, lon2))


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    return F.expr(haversine_sql(lat1, lon1, lat2, lon2))


def distance_to_box_km(latitude, longitude, south="south", north="north", west="west", east="east") -> Column:
    """0 inside the closed box, else the distance to the nearest edge at the clamped coordinate. No wrap at 180."""
    lat, lon, south, north, west, east = (_sql(v) for v in (latitude, longitude, south, north, west, east))
    near_lat, near_lon = f"greatest({south}, least({lat}, {north}))", f"greatest({west}, least({lon}, {east}))"
    nearest = ", ".join(
        great_circle_sql(lat, lon, to_lat, to_lon)
        for to_lat, to_lon in ((south, near_lon), (north, near_lon), (near_lat, west), (near_lat, east))
    )
    return F.expr(f"case when {_inside(lat, lon, south, north, west, east)} then 0D else least({nearest}) end")


def distance_to_edge_lines_km(latitude, longitude, south="south", north="north", west="west", east="east") -> Column:
    """As :func:`distance_to_box_km` but to the unbounded edge lines, by haversine."""
    lat, lon, south, north, west, east = (_sql(v) for v in (latitude, longitude, south, north, west, east))
    nearest = ", ".join(
        haversine_sql(lat, lon, to_lat, to_lon)
        for to_lat, to_lon in ((south, lon), (north, lon), (lat, west), (lat, east))
    )
    return F.expr(f"case when {_inside(lat, lon, south, north, west, east)} then 0D else least({nearest}) end")


def _inside(lat, lon, south, north, west, east) -> str:
    return f"{lat} >= {south} and {lat} <= {north} and {lon} >= {west} and {lon} <= {east}"


def normal_pdf(x, mean: float = 0.0, std: float = 1.0) -> Column:
    scaled = f"(({_sql(x)} - {_sql(mean)}) / {_sql(std)})"
    return F.expr(f"exp(-0.5D * {scaled} * {scaled}) / {_sql(std * math.sqrt(2 * math.pi))}")
