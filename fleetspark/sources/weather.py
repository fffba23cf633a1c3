"""Weather station lists and readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fleetspark.functions.numbers import decimals
from fleetspark.sources.files import dated_files

# Field positions (first, length) of the station list.
STATION_SLICES = {
    "station_id": (1, 5, "int"), "valid_from": (6, 9, "date"), "valid_to": (15, 9, "date"), "elevation": (31, 9, "int"),
    "lat": (40, 11, "double"), "lng": (51, 10, "double"), "station_name": (61, 39, "string"),
}


def parse_fixed_width_stations(lines: DataFrame, line: str = "value") -> DataFrame:
    """Station list lines as columns; the two heading lines and blank lines fall out."""

    def part(name: str) -> Column:
        start, length, kind = STATION_SLICES[name]
        text = F.trim(F.substring(line, start, length))
        if kind == "date":
            return F.try_to_date(text, "yyyyMMdd").alias(name)
        return (text if kind == "string" else text.try_cast(kind)).alias(name)

    return lines.select(*(part(n) for n in STATION_SLICES)).dropna(subset=["station_id", "valid_from", "valid_to"])


def read_stations(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    return parse_fixed_width_stations(spark.read.option("encoding", encoding).text(path))


# File column to measure. Sunshine has no measure of its own, its rows stay without a value.
READING_COLUMNS = {
    "wind": {"FF_10": "wind_speed", "DD_10": "wind_direction"},
    "solar": {"SD_10": None},
    "precipitation": {"RWS_10": "precipitation"},
    "air_temperature": {"TM5_10": "temperature", "RF_10": "humidity"},
}


def read_station_observations(
    spark: SparkSession, path: str, kind: str, start: str, end: str, prune: bool = True,
) -> DataFrame:
    """Readings of one kind as (station_id, obs_ts, measure, raw_value) rows with start <= obs_ts <= end.

    Files are named ``.._<first day>_<last day>_<rest>``. Those of a period that ended before ``start``, and those without
    days, are never opened; ``prune=False`` reads all. Unreadable rows drop out.
    """
    columns = READING_COLUMNS[kind]
    files = dated_files(spark, path, start.replace("-", "")[:8], pattern=r"_(\d{8})_[^_]*$") if prune else [path]
    reader = spark.read.option("header", True).option("sep", ";").option("ignoreLeadingWhiteSpace", True)
    fields = ["STATIONS_ID", "MESS_DATUM", *columns]
    raw = reader.csv(files) if files else spark.createDataFrame([], ", ".join(f"{c} string" for c in fields))
    stamp = F.try_to_timestamp(F.trim("MESS_DATUM"), F.lit("yyyyMMddHHmm"))
    entries = F.array(*(
        F.struct(F.lit(measure).cast("string").alias("measure"), F.trim(column).alias("raw_value"))
        for column, measure in columns.items()))
    return (
        raw.select(F.trim("STATIONS_ID").try_cast("int").alias("station_id"), stamp.alias("obs_ts"), F.inline(entries))
        .where(F.col("station_id").isNotNull() & F.col("obs_ts").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))
    )


HOURLY_SCHEMA = (
    "latitude double, longitude double, start bigint, interval bigint, temperature array<double>, humidity array<double>, "
    "precipitation array<double>, wind_speed array<double>, wind_direction array<double>"
)
SERIES = ["temperature", "humidity", "precipitation", "wind_speed", "wind_direction"]


def hourly_rows(docs: DataFrame) -> DataFrame:
    """Parallel value arrays as rows; the instants follow from start and interval."""
    zipped = F.arrays_zip(*SERIES)
    return docs.select(
        decimals(F.col("latitude"), 3).alias("lat"), decimals(F.col("longitude"), 3).alias("lng"), "start", "interval",
        F.posexplode(zipped).alias("j", "v"),
    ).select(
        F.timestamp_seconds(F.col("start") + F.col("j") * F.col("interval")).alias("timestamp"), "lat", "lng",
        *(F.col(f"v.{s}").alias(s) for s in SERIES[:-1]),
        F.col("v.wind_direction").cast("int").alias("wind_direction"))


def read_hourly_arrays(spark: SparkSession, path: str) -> DataFrame:
    return hourly_rows(spark.read.schema(HOURLY_SCHEMA).json(path))


# Reading names in a station history.
HISTORY_FIELDS = {"t2m_med": "temperature", "rf_med": "humidity", "nied_med": "precipitation", "wg_med": "wind_speed", "wr_med": "wind_direction"}


def station_history_rows(docs: DataFrame, keep: list[str], text: str = "value") -> DataFrame:
    """``{"data": {instant: {readings}}}`` texts as rows; values to 2 decimals, whole directions (truncated)."""
    fields = ", ".join(f"{f}: string" for f in HISTORY_FIELDS)
    entries = F.from_json(text, f"data map<string, struct<{fields}>>").getField("data")
    number = lambda f: F.col(f"r.{f}").try_cast("double")
    values = [
        (decimals(number(f), 2) if m != "wind_direction" else number(f).cast("int")).alias(m) for f, m in HISTORY_FIELDS.items()]
    return docs.select(*keep, F.explode(entries).alias("k", "r")).select(
        *keep, F.try_to_timestamp("k", F.lit("yyyy-MM-dd'T'HH:mm:ssX")).alias("timestamp"), *values)


def read_station_history(spark: SparkSession, path: str) -> DataFrame:
    """``station_<id>.json`` files; the id comes from the file name."""
    docs = spark.read.option("wholetext", True).text(path).select(
        "value", F.regexp_extract(F.col("_metadata.file_name"), r"station_(\w+)\.json", 1).alias("station_id"))
    return station_history_rows(docs, ["station_id"])


def read_street_weather(spark: SparkSession, path: str) -> DataFrame:
    """Comma-separated street station files with their file name (``nr-id-id_add.csv``)."""
    return spark.read.option("header", True).csv(path).withColumn("file", F.col("_metadata.file_name"))
