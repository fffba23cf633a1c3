"""Stored areas of land use."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fleetspark.sinks.tables import append_dedup_renumber

# What tells stored land-use areas apart.
LAND_USE_KEYS = ["city", "landuse", "area"]


def add_land_use(found: DataFrame, path: str) -> DataFrame:
    """The stored table (id, city, landuse, area) with the areas of ``found`` it did not hold; ids are 1..n in key order."""
    return append_dedup_renumber(found, path, LAND_USE_KEYS)
