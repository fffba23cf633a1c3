"""Merging two recordings of the same fleet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetspark.operators.keys import asc, keep_first, union_all
from fleetspark.operators.upgrade import upgrade_free_bike_status
from fleetspark.session import stored


def align_schemas(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with ttl as long and last_reported as timestamp; anything else must agree."""

    def aligned(df: DataFrame) -> DataFrame:
        casts = {"ttl": "bigint", "last_reported": "timestamp"}
        return df.withColumns({c: F.col(c).cast(k) for c, k in casts.items() if c in df.columns})

    a, b = aligned(a), aligned(b)
    left = {f.name: f.dataType for f in a.schema.fields}
    right = {f.name: f.dataType for f in b.schema.fields}
    if left != right:
        differing = sorted(n for n in left.keys() | right.keys() if left.get(n) != right.get(n))
        raise ValueError(f"cannot merge, columns differ: {', '.join(differing)}")
    return a, b.select(*a.columns)


def _rest(df: DataFrame, keys: list[str]) -> list[Column]:
    simple = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    return asc(*(c for c in simple if c not in keys))


def merge_ranked(
    frames: list[DataFrame], ts: str = "last_updated", entity: str = "vehicle_id",
    scope: list[str] | None = None, order: list[Column] | None = None,
) -> DataFrame:
    """Recordings in order of precedence: every (scope, instant) is taken from the first that has it.

    Which recording owns an instant needs only the instants, aggregated before any shuffle and kept
    as a table; while that table is small Spark broadcasts it and the rows shuffle once, for keep-one.
    """
    scope = scope or []
    keys = [*scope, ts, entity]
    order = order or _rest(frames[0], keys)
    columns = frames[0].columns
    rows = union_all(*(df.withColumn("_rank", F.lit(i)) for i, df in enumerate(frames)))
    owners = stored(rows.where(F.col(ts).isNotNull()).groupBy(*scope, ts).agg(F.min("_rank").alias("_owner")), "owners")
    own = rows.join(owners, [*scope, ts], "left").where(F.col("_owner").isNull() | (F.col("_owner") == F.col("_rank")))
    return keep_first(own.select(*columns), keys, order)


def merge_snapshots(
    a: DataFrame, b: DataFrame, ts: str = "last_updated", entity: str = "vehicle_id",
    scope: list[str] | None = None, order: list[Column] | None = None,
) -> DataFrame:
    """Rows of ``a`` plus the rows of ``b`` at instants ``a`` does not know, one per (instant, entity).

    ``scope`` (operator, day) limits the comparison. A scope or instant only one side has is kept
    whole. ``order`` says which of equal keys wins; by default the smallest of the other columns.
    """
    return merge_ranked(list(align_schemas(a, b)), ts, entity, scope, order)


def merge_station_network(a: dict[str, DataFrame], b: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """merge_snapshots for the four tables of a station network."""
    # Table to its id column.
    entities = {"bikes": "number", "places": "uid", "cities": "uid", "countries": "name"}
    return {
        name: merge_snapshots(a[name], b[name], "snapshot_ts", entity)
        for name, entity in entities.items() if name in a and name in b
    }


def merge_counts(a: DataFrame, b: DataFrame, merged: DataFrame, ts: str, entity: str) -> DataFrame:
    """Guard numbers of a merge: rows kept from each side, rows written, and whether they agree."""
    pairs = lambda df: df.select(ts, entity).distinct()
    kept_a = pairs(a).agg(F.count("*")).scalar()
    added_b = pairs(b).join(a.select(ts).distinct(), ts, "left_anti").agg(F.count("*")).scalar()
    rows = merged.agg(F.count("*").alias("merged"))
    return rows.withColumns({"kept_a": kept_a, "added_b": added_b}).withColumn(
        "consistent", F.col("kept_a") + F.col("added_b") == F.col("merged"))


def checked_merge(a: DataFrame, b: DataFrame, merged: DataFrame, ts: str, entity: str) -> DataFrame:
    """``merged`` as a stored table; refuses a merge whose rows are not those kept from ``a`` and added from ``b``."""
    merged = stored(merged, "merged")
    counts = merge_counts(a, b, merged, ts, entity).first()
    if not counts.consistent:
        raise ValueError(f"merged {counts.merged} rows, {counts.kept_a} kept and {counts.added_b} added were expected")
    return merged


def merge_operator_feeds(
    native_a: DataFrame, legacy_a: DataFrame, native_b: DataFrame, legacy_b: DataFrame,
    scope: list[str] = ("operator", "date"), order: list[Column] | None = None,
) -> DataFrame:
    """Two recordings, each of old-version and new-version rows, as one new-version table.

    Old rows are upgraded; inside a recording they come first, then the native rows; then the first
    recording comes before the second. Operators and days found in one input pass through.
    """
    frames = [upgrade_free_bike_status(legacy_a), native_a, upgrade_free_bike_status(legacy_b), native_b]
    first = frames[0]
    aligned = [align_schemas(first, df) for df in frames]
    return merge_ranked([aligned[0][0], *(b for _, b in aligned[1:])], scope=list(scope), order=order)


def merge_documents(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """All documents of ``a``, and those of ``b`` under a name ``a`` does not have."""
    return a.unionByName(b.join(a.select(*keys).distinct(), keys, "left_anti").select(*b.columns))


def merge_distinct(existing: DataFrame | None, new: DataFrame, keys: list[str]) -> DataFrame:
    """existing ++ new, one row per key; stored rows win. (Holidays, weather, land use.)"""
    if existing is None:
        return keep_first(new, keys, _rest(new, keys) or asc(*keys))
    both = existing.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    return keep_first(both, keys, [F.col("_new"), *_rest(existing, keys)]).drop("_new")


HOLIDAY_KEYS = ["name", "start_date", "country_name", "federal_state_name", "end_date", "type"]


def merge_holidays(existing: DataFrame | None, new: DataFrame) -> DataFrame:
    """All distinct holidays, in the stored order."""
    both = new if existing is None else existing.unionByName(new)
    return both.select(*HOLIDAY_KEYS).distinct().sort(
        *asc("country_name", "federal_state_name", "start_date", "name"))


def upsert_weather(existing: DataFrame | None, new: DataFrame) -> DataFrame:
    return merge_distinct(existing, new, ["location_id", "timestamp"])
