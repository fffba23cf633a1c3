"""Keep-one-per-key, unseen keys, and dense surrogate ids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetspark.session import stored


def asc(*names: str) -> list[Column]:
    """Ascending, nulls last: the order the stored results are written in."""
    return [F.col(n).asc_nulls_last() for n in names]


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    ``row_number() = 1`` lets Spark keep one row per key inside every map task before the
    shuffle, so a key with a huge number of copies never meets in one task.
    Without an order the rows of a key are taken to be equal.
    """
    if not order:
        return df.dropDuplicates(keys)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


def new_keys(candidates: DataFrame, dictionary: DataFrame | None, keys: list[str]) -> DataFrame:
    """Distinct candidates without a null key part that the dictionary does not hold yet."""
    found = candidates.select(*keys).dropna(subset=keys).distinct()
    if dictionary is None:
        return found
    return found.join(dictionary.select(*keys), keys, "left_anti")


def numbered(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Stored rows with their position 1, 2, .. in the order of ``keys``, nulls last.

    Ranges of rows are sorted apart and shifted by the counts of the ranges before them, of which there
    are no more than shuffle partitions. A key repeated in very many rows stays in one range.
    """
    ranged = stored(df.repartitionByRange(*asc(*keys)).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    shift = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    nth = F.row_number().over(Window.partitionBy("_range").orderBy(*asc(*keys)))
    # shift: at most one row per shuffle partition
    return ranged.join(F.broadcast(shift), "_range").withColumn(name, (nth + F.col("_shift")).cast("bigint")).drop("_range", "_shift")


def assign_ids(
    candidates: DataFrame,
    keys: list[str],
    id_col: str,
    existing: DataFrame | None = None,
    id_type: str = "int",
) -> DataFrame:
    """Dictionary with new keys numbered ``max(id) + 1 ..`` in key order; old ids never change."""
    base = F.lit(0) if existing is None else existing.agg(F.coalesce(F.max(id_col), F.lit(0))).scalar()
    added = numbered(new_keys(candidates, existing, keys), keys, "_nth").select(
        (F.col("_nth") + base).cast(id_type).alias(id_col), *keys)
    if existing is None:
        return added
    return existing.select(F.col(id_col).cast(id_type).alias(id_col), *keys).unionByName(added)


def edge_values(df: DataFrame, col: str) -> Column:
    """struct<lo, hi> of a column over the whole frame, as a scalar subquery."""
    return df.agg(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi"))).scalar()


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
