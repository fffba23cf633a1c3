"""The stored facts of a free-floating fleet, brought up to date with new snapshots."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetspark.operators.availability import availability
from fleetspark.operators.clean import (
    assign_constant_network, battery_percent, drop_stale, filter_names, normalize_vehicle_id, round_location, whole_metres,
)
from fleetspark.operators.demand import demand_from_trips, trim_edge_timestamps
from fleetspark.operators.keys import assign_ids
from fleetspark.operators.trips import trips_free_floating
from fleetspark.sinks.tables import overwrite_table, stored_table, upsert_daily
from fleetspark.sources.snapshots import read_vehicle_status

PLACE_KEYS = ["location_id", "timestamp", "network_name", "station_name_id", "station_id"]


def update_locations(snapshots: DataFrame, path: str) -> DataFrame:
    """The stored location dictionary, extended by the cells it does not know yet."""
    known = stored_table(snapshots.sparkSession, path)
    cells = snapshots.select("lat", F.col("lon").alias("lng"))
    return overwrite_table(assign_ids(cells, ["lat", "lng"], "location_id", existing=known), path)


def landed_vehicles(
    spark: SparkSession, path: str, networks: dict | None = None, name_network: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The snapshots of a landed folder as ``update_facts`` takes them: without stale reports, battery in percent.

    network_name is the first of ``networks``, or what ``name_network`` adds (the nearest city, the boundary around).
    """
    seen = drop_stale(read_vehicle_status(spark, path))
    seen = seen.drop("timestamp")  # the facts are told by last_updated
    named = name_network(seen) if name_network else assign_constant_network(seen, networks)
    return named.withColumns({
        "battery": battery_percent(F.col("current_fuel_percent").cast("double")),
        "range_m": whole_metres(F.col("current_range_meters").cast("double")),
    })


def update_facts(
    snapshots: DataFrame, root: str, networks: dict | None = None, operator: str = "",
    stations: bool = False, network_names: list[str] | None = None,
) -> dict[str, DataFrame]:
    """Dictionary, trips, demand and availability below ``root``; running it again changes nothing.

    The snapshots are read once per fact, each time only the columns that fact needs. Demand is
    counted from the stored trips of all days, as a trip may end on a later day.
    """
    seen = round_location(normalize_vehicle_id(filter_names(snapshots, "network_name", network_names), operator))
    locations = update_locations(seen, f"{root}/location_coordinates")
    trips = upsert_daily(
        trips_free_floating(seen, locations, networks, stations=stations),
        f"{root}/trips", "trip_date", ["vehicle_id", "timestamp_lend"], ["vehicle_id", "timestamp_lend"])
    demand = upsert_daily(
        trim_edge_timestamps(demand_from_trips(trips)), f"{root}/demand", "demand_date", PLACE_KEYS, ["location_id", "timestamp"])
    available = upsert_daily(
        availability(seen, locations, networks, stations=stations),
        f"{root}/availability", "availability_date", PLACE_KEYS, ["location_id", "timestamp"])
    return {"locations": locations, "trips": trips, "demand": demand, "availability": available}
