"""Weather measurements in one wide shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetspark.functions.numbers import decimals
from fleetspark.operators.clean import WEATHER_MEASURES


def merge_weather_types(
    long: DataFrame, keys: list[str], measure: str = "measure", value: str = "value", seq: str = "seq",
    integers: tuple[str, ...] = ("wind_direction",),
) -> DataFrame:
    """One row per place and instant with a column per measure; the last known value (by ``seq``) wins.

    Rows without any value still make a (place, instant) row. Whole-number measures are truncated.
    """

    def pick(name: str) -> Column:
        known = (F.col(measure) == name) & F.col(value).isNotNull()
        best = F.max_by(value, F.when(known, F.col(seq)))
        return (best.cast("int") if name in integers else best).alias(name)

    return long.groupBy(*keys).agg(*(pick(m) for m in WEATHER_MEASURES))


def coalesce_outer_merge(
    tables: list[DataFrame], keys: list[str], measures: list[str],
) -> DataFrame:
    """N-way outer merge on ``keys``: per measure the first known value in table order.

    Stacking the tables and aggregating by rank needs one shuffle instead of one join per table.
    Inside one table the smallest value of a repeated key is taken.
    """
    ranked = None
    for rank, df in enumerate(tables):
        part = df.select(*keys, *measures, F.lit(rank).alias("_rank"))
        ranked = part if ranked is None else ranked.unionByName(part)

    def pick(name: str) -> Column:
        return F.min(F.when(F.col(name).isNotNull(), F.struct("_rank", name))).getField(name).alias(name)

    return ranked.groupBy(*keys).agg(*(pick(m) for m in measures))


def attach_station(df: DataFrame, stations: DataFrame, on: list[str]) -> DataFrame:
    """Coordinates of the station a reading belongs to; readings of unknown stations are dropped."""
    dim = stations.select(*on, decimals(F.col("lat"), 3).alias("lat"), decimals(F.col("lng"), 3).alias("lng")).dropDuplicates(on)
    return df.join(dim, on)


def file_parts(df: DataFrame, names: list[str], file_name: Column | None = None) -> DataFrame:
    """Columns from the dash-separated parts of ``<a>-<b>-<c>.csv``; other file names are dropped."""
    name = F.col("_metadata.file_name") if file_name is None else file_name
    parts = F.split(F.regexp_replace(name, r"\.csv$", ""), "-")
    return df.where(F.size(parts) == len(names)).withColumns({n: F.get(parts, F.lit(i)) for i, n in enumerate(names)})


# Stations known by sheet name and their coordinates.
NAMED_STATIONS = {
    "S-Mitte_AfU_Halbstd.-Werte": (48.774, 9.186),
    "S-Bad-Cannstatt_Branddirektion_Halbstd.-Werte": (48.797, 9.219),
    "S-Mue-HKW": (48.847, 9.241),
    "S-Vai-Uni": (48.747, 9.107),
}


def attach_named_station(df: DataFrame, column: str, stations: dict[str, tuple[float, float]] = NAMED_STATIONS) -> DataFrame:
    """Coordinates by a literal name table; unknown names are dropped."""
    pairs = [part for name, (lat, lng) in stations.items()
             for part in (F.lit(name), F.struct(F.lit(lat).alias("lat"), F.lit(lng).alias("lng")))]
    spot = F.try_element_at(F.create_map(*pairs), F.col(column))
    return df.withColumn("_spot", spot).where(F.col("_spot").isNotNull()).select("*", "_spot.*").drop("_spot")
