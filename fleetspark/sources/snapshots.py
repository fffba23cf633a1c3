"""Daily snapshot folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetspark.functions.numbers import decimals
from fleetspark.sources.schemas import read_landed

VEHICLE_COLUMNS = [
    "timestamp", "last_updated", "vehicle_id", "lat", "lon", "rental_uri_ios", "rental_uri_web", "last_reported",
    "current_range_meters", "current_fuel_percent", "station_id",
]
DAY = "[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9]"


def _landed(spark: SparkSession, path: str, required: list[str], instants: list[str] = ()) -> DataFrame:
    """All files of a glob, whatever their schemas, with the day of their folder."""
    day = F.to_date(F.regexp_extract(F.col("_metadata.file_path"), r".*/(\d{4}-\d{2}-\d{2})/", 1))
    return read_landed(spark, path, required, instants, {"_day": day})


def read_vehicle_status(spark: SparkSession, path: str) -> DataFrame:
    """All ``<day>/vehicle_status.parquet`` below ``path``: the needed columns, coordinates to 3 decimals, and the day."""
    instants = ["timestamp", "last_updated", "last_reported"]
    raw = _landed(spark, f"{path}/{DAY}/vehicle_status.parquet", ["timestamp", "lat", "lon"], instants)
    ids = [c for c in ("vehicle_id", "id") if c in raw.columns]
    if not ids:
        raise ValueError(f"{path} has no column vehicle_id or id")
    raw = raw.withColumn("vehicle_id", F.coalesce(*ids))
    columns = []
    for name in VEHICLE_COLUMNS:
        if name not in raw.columns:
            columns.append(F.lit(None).cast("string").alias(name))
        elif name in ("lat", "lon"):
            columns.append(decimals(F.col(name), 3).alias(name))
        else:
            columns.append(F.col(name))
    return raw.select(*columns, F.col("_day").alias("day"))


# Column names of zone snapshots and ours.
ZONE_COLUMNS = {
    "LicensePlate": "license_plate", "ZoneID": "zone_id", "BatteryLevel": "battery_level",
    "CurrentRangeMeters": "range_m", "MaxSpeed": "max_speed", "State": "state", "IsRentable": "is_rentable",
}


def read_zone_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """All ``<day>/<day>.parquet`` below ``path``, with the rounded coordinates next to the raw ones."""
    raw = _landed(spark, f"{path}/{DAY}/{DAY}.parquet", ["LicensePlate", "ZoneID", "Timestamp", "Lat", "Lng"])
    return raw.select(
        *(F.col(old).alias(new) for old, new in ZONE_COLUMNS.items() if old in raw.columns),
        F.timestamp_seconds(F.col("Timestamp").cast("bigint")).alias("snapshot_ts"),
        F.col("Lat").alias("lat"), F.col("Lng").alias("lng"),
        decimals(F.col("Lat"), 3).alias("lat_rounded"), decimals(F.col("Lng"), 3).alias("lng_rounded"), F.col("_day").alias("day"),
    )


def read_station_network(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The four tables of a station network below ``path/<day>``, distinct rows, coordinates to 3 decimals."""
    tables = {}
    for name in ("Bikes", "Places", "Cities", "Countries"):
        df = _landed(spark, f"{path}/{DAY}/{name}.parquet", ["timestamp"], ["timestamp"]).drop("_day").withColumnRenamed(
            "timestamp", "snapshot_ts")
        rounded = {c: decimals(F.col(c), 3) for c in ("lat", "lng") if c in df.columns}
        tables[name.lower()] = (df.withColumns(rounded) if rounded else df).distinct()
    return tables
