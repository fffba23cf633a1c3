"""Calendars, values and grids of the context tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetspark.functions.numbers import number_or_null
from fleetspark.functions.subdivisions import normalize_subdivision

HOLIDAY_YEARS = ["2023", "2024", "2025"]


def explode_subdivisions(holidays: DataFrame) -> DataFrame:
    """One row per holiday and subdivision, or one with a null state where there is none.

    Takes (name, start_date, country_name, end_date, type, codes array<string>).
    """
    codes = F.when(F.size("codes") > 0, F.col("codes"))
    return holidays.select(
        "name", F.col("start_date").cast("date").alias("start_date"), "country_name",
        F.explode_outer(codes).alias("_code"), F.col("end_date").cast("date").alias("end_date"), "type",
    ).select("name", "start_date", "country_name", normalize_subdivision(F.col("_code")).alias("federal_state_name"), "end_date", "type")


def zip_values(df: DataFrame, values: str, features: str, keep: list[str]) -> DataFrame:
    """value[i] next to feature[i]; the longer array is cut."""
    n = F.least(F.size(values), F.size(features))
    both = F.arrays_zip(F.slice(F.col(values), 1, n).alias("value"), F.slice(F.col(features), 1, n).alias("area"))
    return df.where((F.size(values) > 0) & (F.size(features) > 0)).select(*keep, F.inline(both))


def demographics(areas: DataFrame, city: str = "MA", years: list[str] = HOLIDAY_YEARS) -> DataFrame:
    """(features, themes) of a geography as (topic, city, area, feature, year, value) rows."""
    flat = (
        areas.select(F.transform("features", lambda f: f["name"]).alias("names"), F.explode("themes").alias("t"))
        .select("names", F.col("t").getField("name").alias("topic"), F.explode(F.col("t").indicators).alias("i"))
        .where(F.col("i").date.isin(years))
        .select("names", "topic", F.col("i").getField("name").alias("feature"), F.col("i").date.alias("year"), F.col("i")["values"].alias("vals"))
    )
    rows = zip_values(flat, "vals", "names", ["topic", "feature", "year"])
    return rows.select(
        "topic", F.lit(city).alias("city"), "area", "feature",
        F.make_date(F.col("year").cast("int"), F.lit(1), F.lit(1)).cast("timestamp").alias("year"),
        number_or_null(F.col("value").cast("string")).alias("value"))


def month_range(start: Column, end: Column) -> Column:
    """First days of the months from ``start`` to ``end``."""
    first = lambda c: F.trunc(c, "month")
    return F.sequence(first(start), first(end), F.expr("interval 1 month"))


def day_range(start: Column, end: Column) -> Column:
    return F.sequence(start, end)
