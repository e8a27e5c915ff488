"""Distances and angles as column algebra (metres, feet, degrees)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0
FT = 3.28084
MILE_M = 1609.344
M_PER_DEG = math.pi * EARTH_M / 180


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half = lambda d: F.pow(F.sin(F.radians(d) / 2), F.lit(2.0))
    a = half(lat2 - lat1) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon2 - lon1)
    return F.asin(F.sqrt(F.least(F.lit(1.0), a))) * (2 * EARTH_M)


def haversine_ft(*p: Column) -> Column:
    return haversine_m(*p) * FT


def haversine_miles(*p: Column) -> Column:
    return haversine_m(*p) / MILE_M


def bearing(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Degrees from north, 0 to 360."""
    d = F.radians(lon2 - lon1)
    y = F.sin(d) * F.cos(F.radians(lat2))
    x = F.cos(F.radians(lat1)) * F.sin(F.radians(lat2)) - F.sin(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.cos(d)
    return F.pmod(F.degrees(F.atan2(y, x)) + 360, F.lit(360.0))


def angle_diff(a: Column, b: Column) -> Column:
    d = F.pmod(F.abs(a - b), F.lit(360.0))
    return F.least(d, 360 - d)


def to_unit_sphere(lat: Column, lon: Column) -> dict[str, Column]:
    return {"x": F.cos(F.radians(lat)) * F.cos(F.radians(lon)), "y": F.cos(F.radians(lat)) * F.sin(F.radians(lon)), "z": F.sin(F.radians(lat))}


def point_segment_ft(lat, lon, u_lat, u_lon, v_lat, v_lon) -> Column:
    """Distance of a point to a segment on the local plane, the foot held inside the segment."""
    kx = F.cos(F.radians(lat)) * M_PER_DEG
    ux, uy, vx, vy = (u_lon - lon) * kx, (u_lat - lat) * M_PER_DEG, (v_lon - lon) * kx, (v_lat - lat) * M_PER_DEG
    dx, dy = vx - ux, vy - uy
    long2 = dx * dx + dy * dy
    t = F.when(long2 > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), -(ux * dx + uy * dy) / long2))).otherwise(0.0)
    px, py = ux + t * dx, uy + t * dy
    return F.sqrt(px * px + py * py) * FT


def polyline_length_m(points: Column) -> Column:
    """Length of an array of (lon, lat) structs."""
    steps = F.zip_with(F.slice(points, F.lit(1), F.size(points) - 1), F.slice(points, F.lit(2), F.size(points) - 1), lambda a, b: haversine_m(a["lat"], a["lon"], b["lat"], b["lon"]))
    return F.aggregate(steps, F.lit(0.0), lambda s, x: s + x)


def point_polyline_ft(lat: Column, lon: Column, points: Column) -> Column:
    """Least distance to the parts of an array of (lon, lat) structs."""
    steps = F.zip_with(F.slice(points, F.lit(1), F.size(points) - 1), F.slice(points, F.lit(2), F.size(points) - 1), lambda a, b: point_segment_ft(lat, lon, a["lat"], a["lon"], b["lat"], b["lon"]))
    return F.array_min(steps)


def line_curvature(points: Column) -> Column:
    """The larger of length over straight distance, and 1 plus the turns in units of half a circle; 1 for short lines."""
    first, last = F.element_at(points, 1), F.element_at(points, -1)
    straight = haversine_m(first["lat"], first["lon"], last["lat"], last["lon"])
    headings = F.zip_with(F.slice(points, F.lit(1), F.size(points) - 1), F.slice(points, F.lit(2), F.size(points) - 1), lambda a, b: bearing(a["lat"], a["lon"], b["lat"], b["lon"]))
    turns = F.aggregate(F.zip_with(F.slice(headings, F.lit(1), F.size(headings) - 1), F.slice(headings, F.lit(2), F.size(headings) - 1), angle_diff), F.lit(0.0), lambda s, x: s + x)
    return F.when((F.size(points) < 3) | (straight < 1), 1.0).otherwise(F.greatest(polyline_length_m(points) / straight, 1 + turns / 180))


def local_curvature_class(lat: Column, lon: Column, points: Column, around: int = 5) -> Column:
    """Bend near a point: the largest change of heading within ``around`` vertices of the nearest one; over 25 sharp, over 15 curve."""
    near = F.transform(points, lambda p: haversine_m(lat, lon, p["lat"], p["lon"]))
    at = F.array_position(near, F.array_min(near)).cast("int")
    part = F.slice(points, F.greatest(F.lit(1), at - around), F.lit(2 * around + 1))
    headings = F.zip_with(F.slice(part, F.lit(1), F.size(part) - 1), F.slice(part, F.lit(2), F.size(part) - 1), lambda a, b: bearing(a["lat"], a["lon"], b["lat"], b["lon"]))
    bend = F.array_max(F.zip_with(F.slice(headings, F.lit(1), F.size(headings) - 1), F.slice(headings, F.lit(2), F.size(headings) - 1), angle_diff))
    return F.when(F.size(points) < 3, "straight").when(bend > 25, "sharp").when(bend > 15, "curve").otherwise("straight")


def rings_centroid(rings: Column) -> dict[str, Column]:
    """Mean and bounds of the vertices of an array of rings of (lon, lat)."""
    flat = F.flatten(rings)
    mean = lambda f: F.aggregate(flat, F.lit(0.0), lambda s, p: s + p[f]) / F.size(flat)
    of = lambda f, g: g(F.transform(flat, lambda p: p[f]))
    return {"lat": mean("lat"), "lon": mean("lon"), "lat_min": of("lat", F.array_min), "lat_max": of("lat", F.array_max), "lon_min": of("lon", F.array_min), "lon_max": of("lon", F.array_max)}


def confidence(ft: Column) -> Column:
    return F.when(ft <= 100, "high").when(ft <= 200, "medium").otherwise("low")


def gps_valid(lat: Column, lon: Column) -> Column:
    fine = lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)
    return F.coalesce(fine & (lat != 0) & (lon != 0) & (lat > 20) & (lat < 72) & (lon > -180) & (lon < -60), F.lit(False))


def sanitised(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Positions outside 17 to 72 north and 180 to 65 west become null."""
    ok = lat.between(17, 72) & lon.between(-180, -65)
    return F.when(ok, lat), F.when(ok, lon)


def in_bounds(lat: Column, lon: Column, box: tuple[float, float, float, float], share: float = 0.02) -> Column:
    """Inside (lat_min, lat_max, lon_min, lon_max) widened by a share of its spans."""
    a, b, c, d = box
    y, x = (b - a) * share, (d - c) * share
    return lat.between(a - y, b + y) & lon.between(c - x, d + x)
