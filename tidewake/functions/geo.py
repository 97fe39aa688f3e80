"""Column functions on WGS-84 coordinates."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_NM = 3440.065


@dataclass(frozen=True)
class Box:
    min_lat: float
    max_lat: float
    min_lon: float
    max_lon: float


# The subscription area and the narrower study area.
SUBSCRIPTION_BOX = Box(50.0, 61.5, -5.0, 13.0)
STUDY_BOX = Box(51.0, 61.0, -4.0, 9.0)


def within_bbox(lat: Column, lon: Column, box: Box) -> Column:
    """Inclusive box test made of plain range predicates, so it reaches the Parquet scan."""
    return lat.between(box.min_lat, box.max_lat) & lon.between(box.min_lon, box.max_lon)


def valid_coordinates(lat: Column, lon: Column) -> Column:
    """True only for numeric coordinates on the globe."""
    return F.coalesce(as_number(lat).between(-90, 90) & as_number(lon).between(-180, 180), F.lit(False))


def as_number(value: Column) -> Column:
    """Lenient numeric parse: NULL for text that is no number and for NaN."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def haversine_nm(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in nautical miles."""
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    half_dlat = (phi2 - phi1) / 2
    half_dlon = (F.radians(lon2) - F.radians(lon1)) / 2
    a = F.pow(F.sin(half_dlat), F.lit(2.0)) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(half_dlon), F.lit(2.0))
    return F.lit(2 * EARTH_RADIUS_NM) * F.asin(F.sqrt(a))


def unit_vector(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """Position on the unit sphere; straight-line distance there grows with great-circle distance."""
    phi, lam = F.radians(lat), F.radians(lon)
    return F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi)


def unit_vector_of(lat: float, lon: float) -> tuple[float, float, float]:
    phi, lam = math.radians(lat), math.radians(lon)
    return math.cos(phi) * math.cos(lam), math.cos(phi) * math.sin(lam), math.sin(phi)


def grid_cell(value: Column, size: float) -> Column:
    return F.floor(value / F.lit(size)).cast("long")
