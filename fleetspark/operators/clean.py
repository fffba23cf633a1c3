"""Filters and normalisation of raw observations."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, functions as F

from fleetspark.functions.geo import milli
from fleetspark.functions.numbers import decimals, half_even, measured, number_or_null
from fleetspark.session import stored

# Id prefixes some feeds put before the vehicle number.
ID_PREFIXES = {
    "dott": ["DOC:Vehicle:", "DOD:Vehicle:", "DOG:Vehicle:", "DOJ:Vehicle:"],
    "lime": ["LMG:Vehicle:"],
}
# Operator to (link column, links it applies to, part of the link naming the vehicle).
ID_LINKS = {
    "voi": ("rental_uri_ios", ["%scooter%2F%"], "scooter%2F([^&]+)"),
    "regioradstuttgart": (
        "rental_uri_ios",
        ["https://www.callabike.de/bike?number=%", "https://www.regioradstuttgart.de/bike?number=%"],
        "number=([0-9]+)",
    ),
    "callabike": ("rental_uri_ios", ["https://www.callabike.de/bike?number=%"], "number=([0-9]+)"),
    "zeus": ("rental_uri_web", ["https://zeus.city/api/v1/applinks?vehicle=%"], "vehicle=([0-9]+)"),
}
# What a zero time from Go turns into, and the oldest believable report.
GO_ZERO_TIME = datetime.datetime(1754, 8, 30, 22, 43, 41, 128654, tzinfo=datetime.timezone.utc)
OLDEST_REPORT = datetime.datetime(2023, 1, 1, tzinfo=datetime.timezone.utc)
GO_ZERO_MICROS = int((GO_ZERO_TIME - datetime.datetime(1970, 1, 1, tzinfo=datetime.timezone.utc))
                     / datetime.timedelta(microseconds=1))
OLDEST_MICROS = int(OLDEST_REPORT.timestamp()) * 1_000_000


def round_location(df: DataFrame, lat: str = "lat", lng: str = "lon") -> DataFrame:
    """Coordinates to 3 decimals, about 100 m."""
    return df.withColumns({lat: decimals(F.col(lat), 3), lng: decimals(F.col(lng), 3)})


def filter_names(df: DataFrame, column: str, names: list[str] | None) -> DataFrame:
    """Rows of the listed networks, zones or cities; no list keeps everything."""
    return df.where(F.col(column).isin(names)) if names else df


def drop_stale(df: DataFrame, reported: str = "last_reported", seen: str = "last_updated") -> DataFrame:
    """Rows reported since the day of the first snapshot; applied only when every row has a report."""
    facts = df.agg(F.struct(
        F.to_date(F.min(seen)).alias("first_day"), F.count_if(F.col(reported).isNull()).alias("unreported")
    )).scalar()
    return (
        df.withColumn("_facts", facts)
        .where((F.col("_facts.unreported") > 0) | (F.col(reported) >= F.col("_facts.first_day"))).drop("_facts")
    )


def canonical_vehicle_id(operator: str, vehicle_id: Column, links: dict[str, Column] | None = None) -> Column:
    """Vehicle id that stays the same over time for the operators that hide it in a prefix or link."""
    if operator in ID_PREFIXES:
        value = vehicle_id
        for prefix in ID_PREFIXES[operator]:
            value = F.when(value.startswith(prefix), F.replace(value, F.lit(prefix), F.lit(""))).otherwise(value)
        return value
    if operator in ID_LINKS:
        column, likes, pattern = ID_LINKS[operator]
        link = (links or {}).get(column, F.col(column))
        applies = F.lit(False)
        for like in likes:
            applies = applies | link.like(like)
        return F.when(applies, F.regexp_extract(link, pattern, 1)).otherwise(vehicle_id)
    return vehicle_id


def normalize_vehicle_id(df: DataFrame, operator: str, column: str = "vehicle_id") -> DataFrame:
    return df.withColumn(column, canonical_vehicle_id(operator, F.col(column)))


def assign_constant_network(df: DataFrame, networks: dict) -> DataFrame:
    """A fleet with one network: every row gets the first configured name."""
    return df.withColumn("network_name", F.lit(next(iter(networks))))


def battery_percent(fraction: Column) -> Column:
    """0..1 charge as whole percent."""
    return half_even(fraction * 100, "smallint")


def whole_metres(value: Column) -> Column:
    return half_even(value, "int")


def sanitize_reported(df: DataFrame, scope: list[str] | None = None) -> DataFrame:
    """Repair or drop impossible times, judged per ``scope`` group (one operator and day).

    If any last_updated lies before 2023, only rows updated from 2023 on stay (nulls go too). Of what is left, when
    every last_reported is the Go zero time they all become null; otherwise the same cut applies to last_reported.
    """
    reported, updated = (F.unix_micros(F.col(c)) for c in ("last_reported", "last_updated"))
    recent = updated >= OLDEST_MICROS
    of = lambda rows: F.struct(
        F.min(F.when(rows, reported)).alias("lo"), F.max(F.when(rows, reported)).alias("hi"),
        F.count_if(rows & reported.isNull()).alias("nulls"))
    numbers = F.struct(F.min(updated).alias("oldest"), of(F.lit(True)).alias("every"), of(F.coalesce(recent, F.lit(False))).alias("recent"))
    if scope:
        facts = stored(df.groupBy(*scope).agg(numbers.alias("_r")), "reports")
        judged = df.join(facts, scope)
    else:
        judged = df.withColumn("_r", df.agg(numbers).scalar())
    sure = lambda rule: F.coalesce(rule, F.lit(False))
    cut_updated = sure(F.col("_r.oldest") < OLDEST_MICROS)
    r = F.when(cut_updated, F.col("_r.recent")).otherwise(F.col("_r.every"))
    all_zero = sure((r.lo == GO_ZERO_MICROS) & (r.hi == GO_ZERO_MICROS) & (r.nulls == 0))
    cut_reported = ~all_zero & sure(r.lo < OLDEST_MICROS)
    kept = judged.where((~cut_updated | recent) & (~cut_reported | (reported >= OLDEST_MICROS)))
    return kept.withColumn("last_reported", F.when(~all_zero, F.col("last_reported"))).select(*df.columns)


def sentinel_to_null(df: DataFrame, columns: list[str], missing: str = "-999") -> DataFrame:
    return df.withColumns({c: measured(F.col(c), missing) for c in columns})


def valid_stops(stops: DataFrame) -> DataFrame:
    """Stops whose text coordinates are numbers on the globe, as doubles lat and lng."""
    return (
        stops.withColumn("lat", number_or_null(F.col("stop_lat"))).withColumn("lng", number_or_null(F.col("stop_lon")))
        .where(F.col("lat").between(-90, 90) & F.col("lng").between(-180, 180))
    )


def valid_stop_times(stop_times: DataFrame) -> DataFrame:
    """Rows whose arrival and departure look like hh:mm:ss."""
    ok = F.lit(True)
    for c in ("arrival_time", "departure_time"):
        ok = ok & F.col(c).isNotNull() & (F.length(c) >= 8) & F.col(c).like("%:%:%")
    return stop_times.where(ok)


# Measures of a street-level weather station and their types.
STREET_MEASURES = {
    "airHumidity": "double", "temperature": "double", "averageWindDirection": "bigint", "minWindSpeed": "double",
}


def align_weather_columns(df: DataFrame, time_column: str = "timestamps") -> DataFrame:
    """The fixed measures: first of duplicate columns, absent ones as nulls, directions as whole degrees."""
    # Names differing only in case or repeated would be ambiguous, so columns are picked by position.
    places: dict[str, int] = {}
    for i, name in enumerate(df.columns):
        places.setdefault(name, i)
    numbered = df.toDF(*(f"_{i}" for i in range(len(df.columns))))
    columns = [F.col(f"_{places[time_column]}").cast("timestamp").alias("timestamp")]
    for name, kind in STREET_MEASURES.items():
        if name not in places:
            value = F.lit(None).cast(kind)
        elif kind == "bigint":
            value = half_even(F.col(f"_{places[name]}").try_cast("double"), "bigint")
        else:
            value = F.col(f"_{places[name]}").cast(kind)
        columns.append(value.alias(name))
    used = set(places[n] for n in (*STREET_MEASURES, time_column) if n in places)
    rest = [F.col(f"_{i}").alias(n) for n, i in places.items() if i not in used]
    return numbered.select(*columns, *rest)


WEATHER_MEASURES = ["temperature", "humidity", "precipitation", "wind_speed", "wind_direction"]


def local_to_utc(
    df: DataFrame, column: str, start: Column, end: Column, zone: str = "Europe/Berlin",
    measures: list[str] = WEATHER_MEASURES,
) -> DataFrame:
    """Local wall-clock stamps to UTC, rows inside [start, end] with at least one measure."""
    return (
        df.withColumn(column, F.to_utc_timestamp(column, zone))
        .where(F.col(column).between(start, end)).dropna(how="all", subset=measures)
    )


def numeric_or_null(df: DataFrame, value: str, year: str | None = None) -> DataFrame:
    """Text values as doubles; a year becomes its first of January."""
    out = df.withColumn(value, number_or_null(F.col(value)))
    return out.withColumn(year, F.make_date(F.col(year).cast("int"), F.lit(1), F.lit(1))) if year else out


def prune_by_file_date(
    df: DataFrame, start: str, end: str | None = None, *, pattern: str = r"(\d{8})(?=\D*$)",
    file_name: Column | None = None,
) -> DataFrame:
    """Rows of files whose name carries a day (yyyymmdd) from ``start`` to ``end``; no day, no row."""
    name = F.col("_metadata.file_name") if file_name is None else file_name
    day = F.nullif(F.regexp_extract(name, pattern, 1), F.lit(""))
    keep = day >= F.lit(start)
    return df.where(keep & (day <= F.lit(end)) if end else keep)


def poi_clean(pois: DataFrame, max_chars: int = 200) -> DataFrame:
    """Points of interest with an id and real coordinates; -1 is unknown, texts end after ``max_chars`` characters."""
    unknown = lambda c: F.nullif(F.col(c).cast("double"), F.lit(-1.0)).alias(c)
    text = lambda c: F.substring(F.coalesce(F.col(c), F.lit("")), 1, max_chars).alias(c)
    real = lambda c: F.coalesce(F.col(c) != 0, F.lit(False))
    return pois.where(
        (F.coalesce("fsq_id", F.lit("")) != "") & real("latitude") & real("longitude")
    ).select(
        "fsq_id", text("name"), decimals(F.col("latitude"), 3).alias("lat"), decimals(F.col("longitude"), 3).alias("lng"),
        text("categories"), unknown("popularity"), unknown("rating"), unknown("price"), text("hours_display"),
    )


def cell_key(df: DataFrame, lat: str = "lat", lng: str = "lon") -> DataFrame:
    """Whole thousandths of a degree next to the coordinates."""
    return df.withColumns({"mlat": milli(F.col(lat)), "mlng": milli(F.col(lng))})
