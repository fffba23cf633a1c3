"""Trips: a vehicle seen at one place and next at another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetspark.functions.geo import milli
from fleetspark.operators.history import changes
from fleetspark.operators.lookup import mapped

TRIP_COLUMNS = {
    "vehicle_id": "string",
    "timestamp_lend": "timestamp",
    "timestamp_return": "timestamp",
    "station_id_lend": "string",
    "station_id_return": "string",
    "station_name_id_lend": "int",
    "station_name_id_return": "int",
    "network_name_lend": None,  # a code, or the name itself when no mapping is given
    "network_name_return": None,
    "location_id_lend": "int",
    "location_id_return": "int",
    "pedelec_battery_lend": "smallint",
    "pedelec_battery_return": "smallint",
    "current_range_meters_lend": "int",
    "current_range_meters_return": "int",
    "predicted": "boolean",
    "trip_date": "date",
}


def _moved(prev: Column, cur: Column) -> Column:
    known = prev.mlat.isNotNull() & prev.mlng.isNotNull() & cur.mlat.isNotNull() & cur.mlng.isNotNull()
    return known & ((prev.mlat != cur.mlat) | (prev.mlng != cur.mlng))


def _differs_or_unknown(prev: Column, cur: Column) -> Column:
    return prev.isNull() | cur.isNull() | (prev != cur)


def _with_cells(df: DataFrame, lat: str, lng: str) -> DataFrame:
    return df.withColumn("mlat", milli(F.col(lat))).withColumn("mlng", milli(F.col(lng)))


def _resolve(pairs: DataFrame, locations: DataFrame, networks: dict | None) -> DataFrame:
    """Attach location ids (and network codes) to both ends of each trip.

    Ids stand one-to-one for cells, so comparing cells first and joining only the trips gives the
    same rows as joining every observation; an end without an id is no trip.
    """
    dim = locations.select("location_id", milli(F.col("lat")).alias("mlat"), milli(F.col("lng")).alias("mlng"))
    out = pairs
    for end, side in (("lend", "prev"), ("return", "cur")):
        side_dim = dim.select(*(F.col(c).alias(f"{c}_{end}") for c in dim.columns))
        out = (
            out.withColumn(f"mlat_{end}", F.col(side).mlat).withColumn(f"mlng_{end}", F.col(side).mlng)
            .join(side_dim, [f"mlat_{end}", f"mlng_{end}"], "inner")
        )
        name = F.col(side).network_name
        out = out.withColumn(f"network_{end}", name if networks is None else mapped(name, networks))
    return out


def _shape(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """The fixed 16-column trip layout plus its date; absent columns are typed nulls."""
    def typed(name: str, kind: str | None) -> Column:
        value = columns.get(name, F.lit(None))
        return (value.cast(kind) if kind else value).alias(name)

    return df.select(*(typed(name, kind) for name, kind in TRIP_COLUMNS.items()))


def trips_free_floating(
    snapshots: DataFrame,
    locations: DataFrame,
    networks: dict | None = None,
    *,
    stations: bool = False,
    station_names: DataFrame | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Trips from (vehicle_id, last_updated, lat, lon, network_name, battery, range_m) snapshots.

    Kept when the place changed and neither battery nor range is known to be unchanged; with
    ``stations`` the station has to differ too, and stations on both ends have to be known.
    """
    carry = ["mlat", "mlng", "network_name", "battery", "range_m"]
    if stations:
        carry.append("station_id")
        if station_names is not None:
            carry.append("station_name")

    def keep(prev: Column, cur: Column) -> Column:
        rule = (
            _moved(prev, cur)
            & _differs_or_unknown(prev.battery, cur.battery)
            & _differs_or_unknown(prev.range_m, cur.range_m)
        )
        return rule & (prev.station_id != cur.station_id) if stations else rule

    pairs = changes(_with_cells(snapshots, "lat", "lon"), "vehicle_id", "last_updated", carry, keep, partitions)
    out = _resolve(pairs, locations, networks)
    columns = {
        "vehicle_id": F.col("vehicle_id"),
        "predicted": F.lit(False),
        "trip_date": F.to_date(F.col("prev").last_updated),
    }
    for end, side in (("lend", F.col("prev")), ("return", F.col("cur"))):
        columns |= {
            f"timestamp_{end}": side.last_updated,
            f"network_name_{end}": F.col(f"network_{end}"),
            f"location_id_{end}": F.col(f"location_id_{end}"),
            f"pedelec_battery_{end}": side.battery,
            f"current_range_meters_{end}": side.range_m,
        }
        if stations:
            columns[f"station_id_{end}"] = side.station_id
            if station_names is not None:
                names = station_names.select(
                    F.col("station_name").alias(f"station_name_{end}"),
                    F.col("station_name_id").alias(f"name_id_{end}"),
                )
                out = out.withColumn(f"station_name_{end}", side.station_name).join(
                    names, f"station_name_{end}", "left")
                columns[f"station_name_id_{end}"] = F.col(f"name_id_{end}")
    return _shape(out, columns)


def trips_zone(
    snapshots: DataFrame,
    locations: DataFrame,
    zones: dict | None = None,
    *,
    partitions: int | None = None,
) -> DataFrame:
    """Trips from zone snapshots: only an unchanged battery level rules a move out."""
    df = _with_cells(snapshots, "lat", "lng").select(
        F.col("license_plate").alias("vehicle_id"), F.col("snapshot_ts").alias("last_updated"),
        "mlat", "mlng", F.col("zone_id").alias("network_name"),
        F.col("battery_level").alias("battery"), "range_m",
    )
    pairs = changes(
        df, "vehicle_id", "last_updated", ["mlat", "mlng", "network_name", "battery", "range_m"],
        lambda p, c: _moved(p, c) & _differs_or_unknown(p.battery, c.battery), partitions,
    )
    out = _resolve(pairs, locations, zones)
    columns = {
        "vehicle_id": F.col("vehicle_id"),
        "predicted": F.lit(False),
        "trip_date": F.to_date(F.col("prev").last_updated),
    }
    for end, side in (("lend", F.col("prev")), ("return", F.col("cur"))):
        columns |= {
            f"timestamp_{end}": side.last_updated,
            f"network_name_{end}": F.col(f"network_{end}"),
            f"location_id_{end}": F.col(f"location_id_{end}"),
            f"pedelec_battery_{end}": side.battery,
            f"current_range_meters_{end}": side.range_m,
        }
    return _shape(out, columns)


def trips_station_network(
    snapshot: DataFrame,
    locations: DataFrame,
    networks: dict | None = None,
    station_names: DataFrame | None = None,
    *,
    partitions: int | None = None,
) -> DataFrame:
    """Trips from the joined station-network snapshot: place, station and station name all change."""
    df = _with_cells(snapshot, "lat", "lng").select(
        F.col("number").cast("string").alias("vehicle_id"), F.col("snapshot_ts").alias("last_updated"),
        "mlat", "mlng", "network_name", F.col("place_uid").alias("station_id"), "station_name",
    )
    pairs = changes(
        df, "vehicle_id", "last_updated",
        ["mlat", "mlng", "network_name", "station_id", "station_name"],
        lambda p, c: _moved(p, c) & (p.station_id != c.station_id) & (p.station_name != c.station_name),
        partitions,
    )
    out = _resolve(pairs, locations, networks)
    columns = {
        "vehicle_id": F.col("vehicle_id"),
        "predicted": F.lit(False),
        "trip_date": F.to_date(F.col("prev").last_updated),
    }
    for end, side in (("lend", F.col("prev")), ("return", F.col("cur"))):
        if station_names is not None:
            names = station_names.select(
                F.col("station_name").alias(f"station_name_{end}"),
                F.col("station_name_id").alias(f"name_id_{end}"),
            )
            # An id-less name counts as unknown, and unknown names make no trip.
            out = out.withColumn(f"station_name_{end}", side.station_name).join(
                names, f"station_name_{end}", "inner")
            columns[f"station_name_id_{end}"] = F.col(f"name_id_{end}")
        columns |= {
            f"timestamp_{end}": side.last_updated,
            f"network_name_{end}": F.col(f"network_{end}"),
            f"location_id_{end}": F.col(f"location_id_{end}"),
            f"station_id_{end}": side.station_id,
        }
    return _shape(out, columns)
