"""Lends and returns per place and instant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetspark.functions.clock import whole_seconds
from fleetspark.functions.geo import milli
from fleetspark.operators.keys import edge_values
from fleetspark.operators.lookup import mapped

PLACE = ["location_id", "timestamp", "network_name", "station_name_id", "station_id"]


def _count(value: Column) -> Column:
    return F.sum(value).cast("smallint")


def _ends(trips: DataFrame) -> DataFrame:
    """One row per trip end, tagged as lend or return; the trips are read once."""

    def end(name: str, lend: int) -> Column:
        return F.struct(
            F.col(f"location_id_{name}").alias("location_id"),
            F.col(f"timestamp_{name}").alias("timestamp"),
            F.col(f"network_name_{name}").alias("network_name"),
            F.col(f"station_name_id_{name}").alias("station_name_id"),
            F.col(f"station_id_{name}").alias("station_id"),
            F.lit(lend).alias("lend"),
        )

    return (
        trips.select(F.inline(F.array(end("lend", 1), end("return", 0))))
        .where(F.col("location_id").isNotNull() & F.col("timestamp").isNotNull())
    )


def _with_date(df: DataFrame) -> DataFrame:
    return df.withColumn("demand_date", F.to_date("timestamp"))


def demand_from_trips(trips: DataFrame) -> DataFrame:
    """n_lends and n_returns per place and instant; places without a station group together."""
    lend = F.col("lend")
    return _with_date(_ends(trips).groupBy(*PLACE).agg(
        _count(lend).alias("n_lends"), _count(1 - lend).alias("n_returns")))


def demand_zone(trips: DataFrame) -> DataFrame:
    """Demand of a fleet without stations."""
    bare = trips.withColumns({
        "station_name_id_lend": F.lit(None).cast("int"), "station_name_id_return": F.lit(None).cast("int"),
        "station_id_lend": F.lit(None).cast("string"), "station_id_return": F.lit(None).cast("string"),
    })
    return demand_from_trips(bare)


def demand_station_network(trips: DataFrame) -> DataFrame:
    """Demand of a station network: instants count in whole seconds."""
    second = lambda c: F.timestamp_seconds(whole_seconds(F.col(c)))
    whole = trips.withColumns({c: second(c) for c in ("timestamp_lend", "timestamp_return")})
    return demand_from_trips(whole)


def demand_full_outer(trips: DataFrame) -> DataFrame:
    """As demand_station_network, but lends and returns meet in an equi full outer join:
    rows with a null in any of the keys never meet and stay on separate rows."""
    ends = _ends(trips).withColumn("timestamp", F.timestamp_seconds(whole_seconds(F.col("timestamp"))))
    ends = _with_date(ends)
    keys = [*PLACE, "demand_date"]
    lends = ends.where("lend = 1").groupBy(*keys).agg(F.count("*").cast("smallint").alias("n_lends")).alias("l")
    returns = ends.where("lend = 0").groupBy(*keys).agg(F.count("*").cast("smallint").alias("n_returns")).alias("r")
    equal = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys]
    zero = F.lit(0).cast("smallint")
    return lends.join(returns, equal, "full_outer").select(
        *(F.coalesce(f"l.{k}", f"r.{k}").alias(k) for k in PLACE),
        F.coalesce("n_lends", zero).alias("n_lends"), F.coalesce("n_returns", zero).alias("n_returns"),
        F.coalesce("l.demand_date", "r.demand_date").alias("demand_date"),
    )


def first_last_sighting(
    sightings: DataFrame, order_by: str = "last_updated", payload: list[str] | None = None,
    entity: str = "vehicle_id",
) -> DataFrame:
    """(entity, first, last): the sightings with the smallest and largest ``order_by``.

    min/max of a struct aggregates before the shuffle, so an id with very many rows is no
    hot spot. Equal instants are decided by the payload values.
    """
    payload = payload or [c for c in sightings.columns if c not in (entity, order_by)]
    row = F.struct(order_by, *payload)
    known = F.col(order_by).isNotNull()
    return sightings.groupBy(entity).agg(
        F.min(F.when(known, row)).alias("first"), F.max(F.when(known, row)).alias("last"))


def demand_rotating(
    sightings: DataFrame, locations: DataFrame, networks: dict | None = None,
) -> DataFrame:
    """Demand of a fleet whose ids rotate: an id's first sighting is a return, its last a lend.

    The very first instant of the data brings no returns and the very last no lends.
    """
    bounds = edge_values(sightings, "last_updated")
    ends = first_last_sighting(sightings, "last_updated", ["lat", "lon", "network_name"])
    rows = (
        ends.select(F.inline(F.array(
            F.struct(F.col("first").alias("seen"), F.lit(0).alias("lend")),
            F.struct(F.col("last").alias("seen"), F.lit(1).alias("lend")),
        )))
        .withColumn("_bounds", bounds)
        .where(F.when(F.col("lend") == 0, F.col("seen.last_updated") > F.col("_bounds.lo"))
               .otherwise(F.col("seen.last_updated") < F.col("_bounds.hi")))
        .select("seen.*", "lend")
    )
    counts = rows.groupBy(
        milli(F.col("lat")).alias("mlat"), milli(F.col("lon")).alias("mlng"), "last_updated", "network_name",
    ).agg(_count(F.col("lend")).alias("n_lends"), _count(1 - F.col("lend")).alias("n_returns"))
    dim = locations.select("location_id", milli(F.col("lat")).alias("mlat"), milli(F.col("lng")).alias("mlng"))
    name = F.col("network_name")
    return _with_date(counts.join(dim, ["mlat", "mlng"], "left").select(
        "location_id", F.col("last_updated").alias("timestamp"),
        (name if networks is None else mapped(name, networks)).alias("network_name"),
        F.lit(None).cast("int").alias("station_name_id"), F.lit(None).cast("string").alias("station_id"),
        "n_lends", "n_returns",
    ))


def trim_edge_timestamps(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Drop the rows at the first and at the last instant of the frame."""
    return (
        df.withColumn("_bounds", edge_values(df, ts))
        .where((F.col(ts) != F.col("_bounds.lo")) & (F.col(ts) != F.col("_bounds.hi"))).drop("_bounds")
    )


