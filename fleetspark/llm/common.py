"""Words, keys and packing shared by the operators.

A word is a run of characters other than blank, tab, line feed, vertical tab, form feed and carriage return.
Columns that an operator adds replace input columns of the same name; names beginning with ``_llm_`` are its own.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BLANKS = " \t\n\x0b\f\r"
BREAK = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def full(col: Column | str) -> Column:
    """A text, with null as the empty text."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words(text: Column) -> Column:
    """The words of a text as an array; empty for a text without words."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed != "", F.split(trimmed, BREAK)).otherwise(F.array().cast("array<string>"))


def once(array: Column, made) -> Column:
    """``made(array)`` with the array as a bound variable: lambdas inside do not compute it again for every element,
    however the optimizer merges or pushes expressions."""
    return F.get(F.transform(F.array(array), made), F.lit(0))


def running_sums(numbers: Column) -> Column:
    """The sums of an array of longs up to and with each element.

    Sums are taken in runs of the square root of the size, and of the runs: appending to an array copies it, so one
    fold over all elements would take time in proportion to the square of their number.
    """
    nothing = F.array().cast("array<bigint>")
    start = F.struct(F.lit(0).cast("long").alias("sum"), nothing.alias("sums"))

    def sums(values):
        grown = lambda a, x: F.struct((a["sum"] + x).alias("sum"), F.concat(a["sums"], F.array(a["sum"] + x)).alias("sums"))
        return F.aggregate(values, start, grown, lambda a: a["sums"])

    def parts(values):
        width = F.ceil(F.sqrt(F.size(values))).cast("int")
        starts = F.sequence(F.lit(0), F.ceil(F.size(values) / width).cast("int") - 1)
        return F.transform(starts, lambda i: sums(F.slice(values, i * width + 1, width)))

    def joined(runs):
        before = once(F.transform(runs, lambda r: F.element_at(r, -1)), lambda totals: F.zip_with(
            sums(totals), totals, lambda s, t: s - t))
        return once(before, lambda b: F.flatten(F.transform(runs, lambda r, i: F.transform(r, lambda x: x + F.get(b, i)))))

    return once(numbers, lambda v: F.when(F.size(v) > 0, once(parts(v), joined)).otherwise(nothing))


def same(left: DataFrame, right: DataFrame, names: Iterable[tuple[str, str]]) -> Column:
    """Null-safe equality of pairs of columns."""
    on = F.lit(True)
    for a, b in names:
        on = on & left[a].eqNullSafe(right[b])
    return on


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 4 MB from now on: with 64 MB, the default, the buffers of the executor and of its Python
    workers take more memory than the work itself. A longer row is a batch of its own."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def splits(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, order: list[Column], name: str, prefix: str = "numbered") -> DataFrame:
    """Stored rows of ``df`` with their position 0, 1, .. in ``order``: ranges are sorted apart and shifted by the
    counts of the ranges before them, of which there are as many as shuffle partitions."""
    from pyspark.sql import Window

    from fleetspark.session import stored

    ranged = stored(df.repartitionByRange(*order).withColumn("_llm_range", F.spark_partition_id()), prefix)
    counts = ranged.groupBy("_llm_range").agg(F.count("*").alias("_llm_n"))
    before = Window.orderBy("_llm_range").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("_llm_range", F.coalesce(F.sum("_llm_n").over(before), F.lit(0)).alias("_llm_shift"))
    inside = F.row_number().over(Window.partitionBy("_llm_range").orderBy(*order)) - 1
    return ranged.join(F.broadcast(shift), "_llm_range").withColumn(
        name, (inside + F.col("_llm_shift")).cast("long")).drop("_llm_range", "_llm_shift")
