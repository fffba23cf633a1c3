"""Joins against dictionaries.

Dictionaries grow with the covered area, so none is broadcast unconditionally: Spark picks the
join from their size. Short configuration mappings are expressions, not joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetspark.functions.geo import milli


def with_location_id(
    df: DataFrame, locations: DataFrame, lat: str = "lat", lng: str = "lon",
    id_col: str = "location_id", how: str = "left",
) -> DataFrame:
    """Attach the id of the 3-decimal cell; the join runs on whole thousandths of a degree."""
    dim = locations.select(
        F.col("location_id").alias(id_col), milli(F.col("lat")).alias("_mlat"), milli(F.col("lng")).alias("_mlng")
    )
    keyed = df.withColumn("_mlat", milli(F.col(lat))).withColumn("_mlng", milli(F.col(lng)))
    return keyed.join(dim, ["_mlat", "_mlng"], how).drop("_mlat", "_mlng")


def map_locations(df: DataFrame, locations: DataFrame, lat: str = "lat", lng: str = "lng") -> DataFrame:
    """As with_location_id, but rows at unknown places are dropped."""
    return with_location_id(df, locations, lat, lng, how="inner")


def mapped(value: Column, mapping: dict) -> Column:
    """Configuration lookup (network name to code, zone to network); unknown values become null.

    The mapping is part of the expression, so the lookup stays in generated code without a join.
    """
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), value)


def with_station_name(df: DataFrame, stations: DataFrame, names: DataFrame) -> DataFrame:
    """station_id to its name (smallest when several), then the name to its id."""
    one_name = stations.groupBy("station_id").agg(F.min("station_name").alias("station_name"))
    named = df.join(one_name, "station_id", "left")
    return named.join(names.select("station_name", "station_name_id"), "station_name", "left")


def with_short_station_id(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """Replace station_id by its short number; unmapped ids become null."""
    return (
        df.join(mapping.select("station_id", "new_station_id"), "station_id", "left")
        .withColumn("station_id", F.col("new_station_id")).drop("new_station_id")
    )
