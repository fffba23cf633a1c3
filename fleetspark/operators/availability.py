"""Vehicles standing at a place at an instant."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetspark.functions.geo import milli
from fleetspark.operators.lookup import mapped, with_location_id


def _place(df: DataFrame, network) -> DataFrame:
    return df.select(
        F.col("location_id").cast("int").alias("location_id"), "timestamp", network.alias("network_name"),
        F.col("station_name_id").cast("int").alias("station_name_id"),
        F.col("station_id").cast("string").alias("station_id"), "n_vehicles",
        F.to_date("timestamp").alias("availability_date"),
    )


def availability(
    snapshots: DataFrame, locations: DataFrame, networks: dict | None = None,
    *, stations: bool = False, station_names: DataFrame | None = None,
) -> DataFrame:
    """Distinct vehicles per (place, instant, network[, station]).

    Counting comes first, so the dictionaries are joined to the counts, not to the snapshots.
    """
    extra = []
    if stations:
        extra = ["station_id"] + (["station_name"] if station_names is not None else [])
    keys = ["lat", "lon", "timestamp", "network_name", *extra]
    seen = snapshots.withColumnRenamed("last_updated", "timestamp").select("vehicle_id", *keys).distinct()
    counts = seen.groupBy(*keys).agg(F.count("*").cast("smallint").alias("n_vehicles"))
    out = with_location_id(counts, locations)
    if station_names is not None and stations:
        out = out.join(station_names.select("station_name", "station_name_id"), "station_name", "left")
    for name, kind in (("station_name_id", "int"), ("station_id", "string")):
        if name not in out.columns:
            out = out.withColumn(name, F.lit(None).cast(kind))
    network = F.col("network_name")
    return _place(out, network if networks is None else mapped(network, networks))


def availability_zone(snapshots: DataFrame, locations: DataFrame, zones: dict | None = None) -> DataFrame:
    """Vehicles per (cell, instant, zone); coordinates are rounded, unknown cells dropped."""
    name = F.col("zone_id")
    counts = snapshots.groupBy(
        milli(F.col("lat")).alias("mlat"), milli(F.col("lng")).alias("mlng"),
        F.col("snapshot_ts").alias("timestamp"), "zone_id",
    ).agg(F.count("*").cast("smallint").alias("n_vehicles"))
    dim = locations.select("location_id", milli(F.col("lat")).alias("mlat"), milli(F.col("lng")).alias("mlng"))
    out = counts.join(dim, ["mlat", "mlng"]).withColumns({
        "station_name_id": F.lit(None).cast("int"), "station_id": F.lit(None).cast("string")})
    return _place(out, name if zones is None else mapped(name, zones))


def availability_station_network(
    snapshot: DataFrame, locations: DataFrame, networks: dict | None = None,
    station_names: DataFrame | None = None,
) -> DataFrame:
    """Bikes per (place, instant, station, station name, network) of the joined snapshot."""
    keys = ["lat", "lng", "snapshot_ts", "place_uid", "station_name", "network_name"]
    counts = snapshot.groupBy(*keys).agg(F.count("*").cast("smallint").alias("n_vehicles"))
    out = with_location_id(counts, locations, "lat", "lng")
    if station_names is not None:
        out = out.join(station_names.select("station_name", "station_name_id"), "station_name", "left")
    else:
        out = out.withColumn("station_name_id", F.lit(None).cast("int"))
    network = F.col("network_name")
    out = out.withColumnsRenamed({"snapshot_ts": "timestamp", "place_uid": "station_id"})
    return _place(out, network if networks is None else mapped(network, networks))


def row_counts(df: DataFrame, nullable: list[str]) -> DataFrame:
    """Number of rows, and of nulls per listed column: the guard numbers of a load."""
    return df.agg(F.count("*").alias("rows"), *(F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in nullable))
