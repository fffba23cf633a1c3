"""Number and text conversions whose rounding has to be spelled out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def half_even(value: Column, kind: str) -> Column:
    """Float to integer, ties to even (a plain Spark cast would truncate)."""
    return F.rint(value).cast(kind)


def decimals(value: Column, places: int) -> Column:
    """Double to so many decimals, halves away from zero, decided on the scaled binary value.

    Spark's ``round(x, n)`` decides on the printed number instead, which moves values such as 8.0095.
    """
    scale = float(10**places)
    return F.round(value * scale) / scale


def with_units(df: DataFrame, name: str, places: int, out: str) -> DataFrame:
    """Adds ``round(name, places)`` of a double in whole units of the last place; null near a half, for large values and no number.

    Spark's ``round`` prints a double and reads it again to decide its halves. Away from them a product decides the same.
    The steps are columns: an expression that names its parts again and again grows too long to be compiled.
    """
    # Below 1e9 the product is off by less than 1e-6, and so is the printed number.
    scaled, whole = F.col("_scaled"), F.col("_whole")
    sure = (scaled < 1e9) & (F.abs(F.abs(scaled - whole) - 0.5) > 1e-6)
    return (
        df.withColumn("_scaled", F.abs(F.col(name)) * float(10**places)).withColumn("_whole", F.rint("_scaled"))
        .withColumn(out, F.when(sure, F.when(F.col(name) < 0, 0.0 - whole).otherwise(whole))).drop("_scaled", "_whole")
    )


def with_rounded(df: DataFrame, name: str, value: Column, places: int) -> DataFrame:
    """Adds ``round(value, places)`` of a double, printed only where ``with_units`` leaves it open."""
    made = with_units(df.withColumn("_exact", value), "_exact", places, "_units")
    return made.withColumn(name, F.coalesce(F.col("_units") / float(10**places), F.round("_exact", places))).drop("_exact", "_units")


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def number_or_null(text: Column) -> Column:
    """Trimmed text as double; blank or non-numeric text becomes null."""
    return blank_to_null(text).try_cast("double")


def measured(text: Column, missing: str = "-999") -> Column:
    """Station reading as double: blank and the missing mark become null."""
    return F.nullif(blank_to_null(text), F.lit(missing)).try_cast("double")
