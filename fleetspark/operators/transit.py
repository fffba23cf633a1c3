"""Timetables and bicycle counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetspark.functions.clock import day_seconds
from fleetspark.operators.clean import valid_stop_times
from fleetspark.operators.keys import asc

WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]


def gtfs_join(
    stop_times: DataFrame, trips: DataFrame, routes: DataFrame, calendar: DataFrame, stops: DataFrame,
) -> DataFrame:
    """Well-formed stop times at the given (located) stops, with route names and service days.

    The two long tables meet first, by trip and on few columns; the short route and calendar tables
    are joined to the result where it stands. Stop ids are unique in ``stops``.
    """
    return (
        valid_stop_times(stop_times).join(stops.select("stop_id"), "stop_id", "left_semi")
        .join(trips.select("trip_id", "route_id", "service_id"), "trip_id")
        .join(routes, "route_id").join(calendar, "service_id")
        .select("route_long_name", "route_short_name", "route_type", "stop_id", "arrival_time", "departure_time",
                *WEEKDAYS, "start_date", "end_date")
    )


# Seconds and the first three bytes of a name share one bigint, as long as the year has no more than four digits.
NAME_BITS, LAST_SECOND = 24, 2**38


def expand_calendar(joined: DataFrame, tz: str = "UTC", ordered: bool = False) -> DataFrame:
    """One row per stop time and active day, with arrival and departure stamps.

    Hours from 24 on fall on the following days; rows with unreadable times are left out. Rows are
    dealt out by their values before they multiply, as a long file of one row group would expand in one task. Their number
    of partitions is set, because by bytes the narrow rows would be put together again. Local times of ``tz`` become UTC stamps.
    ``ordered`` sorts each partition by arrival_time and route_short_name, nearly always by comparing one number: many rows
    share an instant, and texts are compared only where the start of the name is the same as well.
    """
    # The active days as bits, tested after the explode: both stay in generated code.
    bits = sum((F.when(F.col(d).cast("int") != 0, 1 << i).otherwise(0) for i, d in enumerate(WEEKDAYS)), F.lit(0))
    parts = int(joined.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Days as plain numbers since 1970-01-01, a Thursday.
    first, last = (F.unix_date(F.col(c).cast("date")) for c in ("start_date", "end_date"))
    # Parsed and expanded after the shuffle; the conditions stay in the generator, a filter would parse once more.
    days = F.when(
        F.col("_a").isNotNull() & F.col("_d").isNotNull() & (first <= last) & (F.col("_bits") != 0), F.sequence(first, last))
    if ordered:
        start = F.rpad(F.hex(F.coalesce("route_short_name", F.lit(""))), NAME_BITS // 4, "0")
        joined = joined.withColumn("_name", F.conv(start, 16, 10).cast("bigint"))
    timed = (
        joined.repartition(parts, "stop_id", "arrival_time", "departure_time", "route_short_name")
        .withColumn("_a", day_seconds(F.col("arrival_time"))).withColumn("_d", day_seconds(F.col("departure_time")))
        .withColumn("_bits", bits).withColumn("_day", F.explode(days))
        .where(F.getbit("_bits", F.pmod(F.col("_day") + 3, F.lit(7))) == 1)
    )
    keep = [c for c in ("stop_id", "location_id") if c in joined.columns]

    def stamp(seconds: str):
        local = F.timestamp_seconds(F.col("_day").cast("bigint") * 86400 + F.col(seconds))
        return local if tz == "UTC" else F.to_utc_timestamp(local, tz)

    expanded = timed.select(
        *([F.col("_name")] if ordered else []),
        F.coalesce("route_long_name", F.lit("")).alias("route_long_name"),
        F.coalesce("route_short_name", F.lit("")).alias("route_short_name"),
        F.coalesce(F.col("route_type").cast("int"), F.lit(0)).alias("route_type"), *keep,
        stamp("_a").alias("arrival_time"), stamp("_d").alias("departure_time"))
    if not ordered:
        return expanded
    second = F.unix_seconds("arrival_time")
    order = F.when(second < -LAST_SECOND, -2**63).when(second >= LAST_SECOND, 2**63 - 1).otherwise(second * 2**NAME_BITS + F.col("_name"))
    return expanded.withColumn("_name", order).sortWithinPartitions(*asc("_name", "arrival_time", "route_short_name")).drop("_name")


def pivot_directions(
    counts: DataFrame, keys: list[str], position: str = "pos", direction: str = "direction", value: str = "counts",
) -> DataFrame:
    """in_count and out_count per counter and instant: the last entry of a direction wins, others are ignored."""
    pick = lambda name: F.max_by(value, F.when(F.col(direction) == name, F.col(position)))
    return counts.where(F.col(direction).isin("IN", "OUT")).groupBy(*keys).agg(
        pick("IN").alias("in_count"), pick("OUT").alias("out_count"))
