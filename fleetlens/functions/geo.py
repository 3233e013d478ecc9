"""Positions: distance and grid cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000.0
# About the edge length of a resolution-9 hexagon.
GRID_DEGREES = 0.002


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres; rounding never pushes the root above one."""
    half_dlat = F.sin(F.radians(lat2 - lat1) / 2)
    half_dlon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_dlat * half_dlat + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_dlon * half_dlon
    )
    return F.asin(F.least(F.lit(1.0), F.sqrt(chord))) * (2 * EARTH_RADIUS_M)


def grid_cell(lat: Column, lon: Column, degrees: float = GRID_DEGREES) -> Column:
    """Square cell id by flooring both coordinates. Not an H3 index."""
    row = F.floor(lat / F.lit(degrees)).cast("string")
    col = F.floor(lon / F.lit(degrees)).cast("string")
    return F.concat(F.lit("g"), row, F.lit("_"), col)


def cell_or_grid(
    cell: Column, lat: Column, lon: Column, degrees: float = GRID_DEGREES
) -> Column:
    """The given cell; a missing or empty one is derived from the position."""
    given = F.when(cell != "", cell)
    return F.coalesce(given, grid_cell(lat, lon, degrees))


def with_cell(df: DataFrame, degrees: float = GRID_DEGREES) -> DataFrame:
    """Fill h3_cell where it is missing or empty."""
    return df.withColumn(
        "h3_cell", cell_or_grid(F.col("h3_cell"), F.col("lat"), F.col("lon"), degrees)
    )
