"""Stored tables: daily upserts, appends with running ids, warehouse loads.

A load writes beside the files of the table and counts from the moment its version is in place (``versions``), so a lost
executor or a failed job leaves the table as it was, all days of it. Read tables with ``stored_table``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from fleetspark.functions.geo import swap_wkt_axes
from fleetspark.operators.keys import asc, keep_first, numbered
from fleetspark.session import scratch_scope, stored
from fleetspark.sinks.versions import Load, version


def stored_table(spark: SparkSession, path: str, number: int | None = None) -> DataFrame | None:
    """The latest version of the table at ``path``, or that of a number; None when there is none yet.

    A folder of Parquet files without versions is read as it is.
    """
    held = version(spark, path, number)
    if held:
        return held.read(spark)
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _write_days(df: DataFrame, target: str, day: str, order: list[str]) -> None:
    """Sorted files per day. The range split lets several tasks share a large day."""
    (
        df.repartitionByRange(*asc(day, *order)).sortWithinPartitions(*asc(day, *order))
        .write.option("compression", "zstd").partitionBy(day).parquet(target)
    )


def upsert_daily(df: DataFrame, path: str, day: str, keys: list[str], order: list[str]) -> DataFrame:
    """Merge rows into the daily table at ``path`` and return the table.

    Rows without a day are left out. On days already stored one row per key stays, the stored row
    before the new one; other days are written as they are. Only the touched days are read, and written beside
    the stored ones; all of them count at once. The new rows are staged once, the merged ones once more, as the
    range split reads its input twice. ``day`` is a date.
    """
    spark = df.sparkSession
    if not isinstance(df.schema[day].dataType, T.DateType):
        raise ValueError(f"{day} has to be a date")
    load = Load(spark, path)
    load.check(df.schema)
    with scratch_scope(spark):
        new = staged = stored(df.where(F.col(day).isNotNull()), "incoming")
        held = {folder.rsplit("/", 1)[1]: folder for folder in load.held}
        # At most a row for each day.
        touched = [f"{day}={d}" for (d,) in new.select(F.col(day).cast("string")).distinct().collect()] if held else []
        known = [name.split("=", 1)[1] for name in touched if name in held]
        if known:
            old = load.base.read(spark, [held[f"{day}={d}"] for d in known])
            again = F.col(day).cast("string").isin(known)
            both = old.withColumn("_rank", F.lit(0)).unionByName(
                new.withColumn("_rank", F.when(again, 1).otherwise(2)), allowMissingColumns=True)
            rest = [c for c in both.columns if c not in (*keys, *order, "_rank")]
            merged = keep_first(both.where("_rank < 2"), keys, [F.col("_rank"), *asc(*order, *rest)])
            staged = stored(merged.unionByName(both.where("_rank = 2")).drop("_rank"), "staged")
        _write_days(staged, load.target, day, order)
        written = load.parts()
        kept = [folder for name, folder in held.items() if name not in written]
        return load.commit(staged.schema, sorted([*kept, *(f"{load.name}/{n}" for n in written)])).read(spark)


def overwrite_table(df: DataFrame, path: str, order: list[str] | None = None, load: Load | None = None) -> DataFrame:
    """Replace the table at ``path``; ``df`` may come from it, then ``load`` is what it was read by.

    Its earlier versions stay until they are dropped.
    """
    spark = df.sparkSession
    load = load or Load(spark, path)
    with scratch_scope(spark):
        out = df
        if order:  # staged, as the range split reads its input twice
            out = stored(df, "staged").repartitionByRange(*asc(*order)).sortWithinPartitions(*asc(*order))
        out.write.option("compression", "zstd").parquet(load.target)
    return load.commit(out.schema, [load.name], replace=True).read(spark)


def _append(df: DataFrame, load: Load) -> DataFrame:
    """Add rows to the table that ``load`` began with."""
    load.check(df.schema)
    df.write.option("compression", "zstd").parquet(load.target)
    return load.commit(df.schema, [*load.held, load.name]).read(df.sparkSession)


def _unseen(batch: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key the table does not hold; a null is a key like any other."""
    held = existing.select(*(F.col(k).alias(f"_{k}") for k in keys))
    on = F.lit(True)
    for k in keys:
        on = on & batch[k].eqNullSafe(held[f"_{k}"])
    return batch.join(held, on, "left_anti")


def append_with_ids(df: DataFrame, path: str, keys: list[str], id_col: str = "id", dedup: bool = False) -> DataFrame:
    """Append rows; their ids continue after the largest stored one, in the order of ``keys``, then the other columns.

    With ``dedup`` one row per key is appended, and none whose key is stored; without it every row is,
    and a repeated load appends again.
    """
    spark = df.sparkSession
    load = Load(spark, path)
    existing = load.base.read(spark) if load.base else None
    rest = [c for c in df.columns if c not in keys]
    with scratch_scope(spark):
        batch = keep_first(df, keys, asc(*rest)) if dedup else df
        if existing is not None and dedup:
            batch = _unseen(batch, existing, keys)
        base = F.lit(0) if existing is None else existing.agg(F.coalesce(F.max(id_col), F.lit(0))).scalar()
        rows = numbered(batch, [*keys, *rest], "_n").select((F.col("_n") + base).alias(id_col), *df.columns)
        return _append(rows, load)


def append_dedup_renumber(df: DataFrame, path: str, keys: list[str], id_col: str = "id") -> DataFrame:
    """existing ++ new, distinct on the keys (null is a key like any other), numbered 1..n in key order."""
    spark = df.sparkSession
    load = Load(spark, path)
    existing = load.base.read(spark) if load.base else None
    new = df.withColumn("_new", F.lit(1))
    both = new if existing is None else existing.select(*df.columns).withColumn("_new", F.lit(0)).unionByName(new)
    rest = [c for c in df.columns if c not in keys]
    with scratch_scope(spark):
        unique = keep_first(both, keys, [F.col("_new"), *asc(*rest)]).drop("_new")
        return overwrite_table(numbered(unique, keys, id_col).select(id_col, *df.columns), path, load=load)


def append_new_only(df: DataFrame, path: str, key: str, order: list[Column] | None = None) -> DataFrame:
    """Append the first row of each key the table does not hold yet; null is a key like any other."""
    spark = df.sparkSession
    load = Load(spark, path)
    existing = load.base.read(spark) if load.base else None
    batch = keep_first(df, [key], order or asc(*(c for c in df.columns if c != key)))
    if existing is not None:
        batch = _unseen(batch, existing, [key]).select(*df.columns)
    with scratch_scope(spark):
        return _append(batch, load)


# Data type to warehouse table, and the types whose table keeps its rows on a load.
WAREHOUSE_TABLES = {
    "trips": "trips", "demand": "demand", "availability": "availability", "weather": "weather", "osm": "osm",
    "osm_landuse": "osm_landuse", "foursquare": "foursquare", "holidays": "holidays", "gtfs": "gtfs", "wfs": "wfs",
    "demographics_MA": "demographics", "bike_count_stations": "bike_counting_stations",
}
KEPT_TYPES = ["gtfs", "demand", "availability", "trips"]


def load_warehouse(df: DataFrame, datatype: str, root: str | None = None, jdbc: dict | None = None) -> str:
    """Load one data type: facts and timetables append, everything else replaces the table.

    ``root`` is a folder of Parquet tables; ``jdbc`` holds the options of a database writer.
    """
    table = WAREHOUSE_TABLES[datatype]
    mode = "append" if datatype in KEPT_TYPES else "overwrite"
    if jdbc:
        df.write.format("jdbc").options(**jdbc, dbtable=table, truncate="true").mode(mode).save()
        return table
    if mode == "overwrite":
        overwrite_table(df, f"{root}/{table}")
    else:
        _append(df, Load(df.sparkSession, f"{root}/{table}"))
    return f"{root}/{table}"


def refresh_dimensions(geo: DataFrame, station_names: DataFrame, root: str, swap_axes: bool = False) -> None:
    """Replace the dimension tables before facts are loaded; ``swap_axes`` turns POINT(lat lng) round."""
    located = geo.withColumn("location", swap_wkt_axes(F.col("location"))) if swap_axes else geo
    overwrite_table(located, f"{root}/geo_information")
    overwrite_table(station_names, f"{root}/station_names")
