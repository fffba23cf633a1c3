"""Bike, place, city and country snapshots of a station network."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetspark.operators.keys import asc, keep_first


def station_network_snapshot(bikes: DataFrame, places: DataFrame, cities: DataFrame) -> DataFrame:
    """Every bike at a known place of a known city, with place coordinates and names.

    Places meet their cities first; the large bikes table then shuffles once.
    """
    sited = places.alias("p").join(
        cities.alias("c"),
        (F.col("p.city_uid") == F.col("c.uid")) & (F.col("p.snapshot_ts") == F.col("c.snapshot_ts")),
    ).select(
        F.col("p.uid").alias("place_uid"), F.col("p.snapshot_ts").alias("snapshot_ts"),
        F.col("p.lat").alias("lat"), F.col("p.lng").alias("lng"), F.col("p.name").alias("station_name"),
        F.col("c.name").alias("network_name"),
    )
    return bikes.select("number", "snapshot_ts", "place_uid").join(sited, ["place_uid", "snapshot_ts"])


def restrict_hierarchy(
    bikes: DataFrame, places: DataFrame, cities: DataFrame, countries: DataFrame,
    country_names: list[str] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(bikes, places, cities, countries) hanging below the chosen countries, one row per id and instant."""
    chosen = countries.where(F.col("name").isin(country_names)) if country_names else countries
    kept_countries = keep_first(chosen, ["name", "snapshot_ts"], asc("name"))
    in_country = cities.join(
        kept_countries.select(F.col("name").alias("parent_country_name"), "snapshot_ts"),
        ["parent_country_name", "snapshot_ts"], "left_semi")
    kept_cities = keep_first(in_country, ["uid", "snapshot_ts"], asc("name", "parent_country_name"))
    in_city = places.join(
        kept_cities.select(F.col("uid").alias("city_uid"), "snapshot_ts"), ["city_uid", "snapshot_ts"], "left_semi")
    kept_places = keep_first(in_city, ["uid", "snapshot_ts"], asc("name", "lat", "lng", "city_uid"))
    at_place = bikes.join(
        kept_places.select(F.col("uid").alias("place_uid"), "snapshot_ts"), ["place_uid", "snapshot_ts"], "left_semi")
    kept_bikes = keep_first(at_place, ["number", "snapshot_ts"], asc("place_uid"))
    return kept_bikes, kept_places, kept_cities, kept_countries
