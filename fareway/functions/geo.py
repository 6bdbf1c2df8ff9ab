"""Distances and polygon tests as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .scalars import col

EARTH_RADIUS_M = 6371000.0
EARTH_RADIUS_KM = 6371.0


def sphere_distance(lon1, lat1, lon2, lat2, radius: float = EARTH_RADIUS_M) -> Column:
    """Great-circle distance (haversine), in the unit of the radius."""
    a_lat, b_lat = F.radians(col(lat1)), F.radians(col(lat2))
    half_lat = F.sin((b_lat - a_lat) / 2)
    half_lon = F.sin(F.radians(col(lon2) - col(lon1)) / 2)
    h = half_lat * half_lat + F.cos(a_lat) * F.cos(b_lat) * half_lon * half_lon
    return F.lit(2 * radius) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def cosine_distance_km(lon1, lat1, lon2, lat2, radius: float = EARTH_RADIUS_KM) -> Column:
    """Distance by the law of cosines, clamped to the domain of acos at both ends."""
    a_lat, b_lat = F.radians(col(lat1)), F.radians(col(lat2))
    gap = F.radians(col(lon1)) - F.radians(col(lon2))
    c = F.cos(a_lat) * F.cos(b_lat) * F.cos(gap) + F.sin(a_lat) * F.sin(b_lat)
    # least/greatest skip NULL, so a missing coordinate must be kept apart
    return F.when(
        c.isNotNull(), F.lit(radius) * F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), c)))
    )


def ring_edges(ring) -> Column:
    """Array of edges `(x1, y1, x2, y2)` of a ring of `(lon, lat)`; the ring closes itself."""
    ring = col(ring)
    follow = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    return F.zip_with(
        ring, follow,
        lambda a, b: F.struct(
            a["lon"].alias("x1"), a["lat"].alias("y1"), b["lon"].alias("x2"), b["lat"].alias("y2")
        ),
    )


def ring_crossings(edges, lon, lat) -> Column:
    """How many edges a ray from the point to the east crosses. Edges are half-open in latitude."""
    lon, lat = col(lon), col(lat)
    return F.aggregate(
        col(edges), F.lit(0),
        lambda n, e: n + F.when(
            ((e["y1"] > lat) != (e["y2"] > lat))
            & (lon < (e["x2"] - e["x1"]) * (lat - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]),
            1,
        ).otherwise(0),
    )


def ring_contains(edges, lon, lat) -> Column:
    """Ray casting; a shared border belongs to one side."""
    return ring_crossings(edges, lon, lat) % 2 == 1


def ring_area(edges) -> Column:
    """Planar area by the shoelace formula."""
    twice = F.aggregate(
        col(edges), F.lit(0.0), lambda s, e: s + (e["x1"] * e["y2"] - e["x2"] * e["y1"])
    )
    return F.abs(twice) / 2


def ring_bounds(ring) -> tuple[Column, Column, Column, Column]:
    """(min lon, max lon, min lat, max lat)."""
    ring = col(ring)
    lons, lats = F.transform(ring, lambda p: p["lon"]), F.transform(ring, lambda p: p["lat"])
    return F.array_min(lons), F.array_max(lons), F.array_min(lats), F.array_max(lats)
