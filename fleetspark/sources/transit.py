"""Timetable tables and bicycle counter files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetspark.functions.numbers import decimals

# Timetable files and the columns used of each.
GTFS_COLUMNS = {
    "stops": ["stop_id", "stop_name", "stop_lat", "stop_lon"],
    "stop_times": ["trip_id", "stop_id", "arrival_time", "departure_time"],
    "trips": ["trip_id", "route_id", "service_id"],
    "routes": ["route_id", "route_long_name", "route_short_name", "route_type"],
    "calendar": ["service_id", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday", "start_date", "end_date"],
}
MALFORMED = "_corrupt"


def read_gtfs_tables(spark: SparkSession, path: str, suffix: str = ".txt") -> dict[str, DataFrame]:
    """The five tables; all values as text but the calendar flags and days.

    Short rows are filled with nulls; rows with too many fields are dropped.
    """
    tables = {}
    for name, used in GTFS_COLUMNS.items():
        source = f"{path}/{name}{suffix}"
        header = spark.read.option("header", True).csv(source).columns
        fields = ", ".join(f"`{c}` string" for c in header) + f", `{MALFORMED}` string"
        raw = (
            spark.read.option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False)
            .option("columnNameOfCorruptRecord", MALFORMED).schema(fields).csv(source)
        )
        missing = [c for c in used if c not in header]
        if missing:
            raise ValueError(f"{name} lacks the columns {', '.join(missing)}")
        # A short row is marked as corrupt too, so the number of separators tells a long one.
        extra = F.col(MALFORMED).isNotNull() & (F.size(F.split(MALFORMED, ",(?=(?:[^\"]*\"[^\"]*\")*[^\"]*$)")) > len(header))
        tables[name] = raw.where(~extra).select(*used)
    flags = {c: F.col(c).try_cast("int") for c in GTFS_COLUMNS["calendar"][1:8]}
    days = {c: F.try_to_date(F.col(c), "yyyyMMdd") for c in ("start_date", "end_date")}
    tables["calendar"] = tables["calendar"].withColumns({**flags, **days})
    return tables


COUNTER_SCHEMA = (
    "domain_name string, counter_site string, counter_site_id string, longitude double, latitude double, "
    "channels array<struct<iso_timestamp: string, direction: string, counts: bigint>>"
)


def read_bike_counters(spark: SparkSession, path: str, domains: list[str] | None = None) -> DataFrame:
    """One row per channel entry of the monthly (gzipped) site files, in file order (``pos``)."""
    sites = spark.read.schema(COUNTER_SCHEMA).option("multiLine", True).json(path)
    if domains:
        sites = sites.where(F.col("domain_name").isin(domains))
    return sites.select(
        F.col("counter_site_id").alias("counter_id"), F.col("counter_site").alias("counter_name"),
        decimals(F.col("latitude"), 3).alias("lat"), decimals(F.col("longitude"), 3).alias("lng"),
        F.posexplode("channels").alias("pos", "c"),
    ).select(
        "counter_id", "counter_name", "lat", "lng", "pos",
        F.col("c.iso_timestamp").cast("timestamp").alias("timestamp"), "c.direction", "c.counts")
