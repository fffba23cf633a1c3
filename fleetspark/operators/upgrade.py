"""Feed documents of version 2.3 in the shape of version 3.0."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from fleetspark.functions.clock import rfc3339

NEW_VERSION = "3.0"


def localized(text: Column) -> Column:
    """Plain text as a one-entry list of translations; null stays null."""
    return F.when(text.isNotNull(), F.array(F.struct(text.alias("text"), F.lit("en").alias("language"))))


def _rewrite(
    item: Column, kind: T.StructType, localize: list[str], drop: list[str] = (), rename: dict[str, str] | None = None,
) -> Column:
    """Localise, drop and rename those of the named fields that the struct has."""
    have = set(kind.names)
    for name in localize:
        if name in have:
            item = item.withField(name, localized(item[name]))
    for old, new in (rename or {}).items():
        if old in have:
            item = item.withField(new, item[old]).dropFields(old)
    gone = [name for name in drop if name in have]
    return item.dropFields(*gone) if gone else item


def _document(df: DataFrame, data: Column) -> DataFrame:
    return df.withColumns({
        "data": data,
        "last_updated": rfc3339(F.col("last_updated")),
        "version": F.lit(NEW_VERSION),
    })


def _items(df: DataFrame, name: str, **rules) -> DataFrame:
    """Apply ``rules`` to every element of ``data.<name>``."""
    kind = df.schema["data"].dataType
    if name not in kind.names:
        return _document(df, F.col("data"))
    element = kind[name].dataType.elementType
    changed = F.transform(F.col("data")[name], lambda item: _rewrite(item, element, **rules))
    return _document(df, F.col("data").withField(name, changed))


def upgrade_free_bike_status(df: DataFrame) -> DataFrame:
    """Vehicle rows: bike_id becomes vehicle_id, epoch seconds become timestamps."""
    out = df.withColumnRenamed("bike_id", "vehicle_id").withColumns({
        c: F.timestamp_seconds(F.col(c).cast("bigint")) for c in ("last_reported", "last_updated")})
    return out.withColumn("version", F.lit(NEW_VERSION)) if "version" in df.columns else out


def upgrade_station_information(df: DataFrame) -> DataFrame:
    return _items(df, "stations", localize=["name", "short_name"], drop=["vehicle_type_capacity", "vehicle_capacity"])


def upgrade_pricing_plans(df: DataFrame) -> DataFrame:
    return _items(df, "plans", localize=["name", "description"])


def upgrade_vehicle_types(df: DataFrame) -> DataFrame:
    return _items(df, "vehicle_types", localize=["name", "make"], rename={"eco_label": "eco_labels"})


def upgrade_geofencing_zones(df: DataFrame) -> DataFrame:
    """Zone names are localised and an empty list of global rules is added where there is none."""
    data = F.col("data")
    kind = df.schema["data"].dataType
    rules = T.ArrayType(T.StringType())
    if "global_rules" in kind.names:
        rules = kind["global_rules"].dataType
    if "geofencing_zones" in kind.names and "features" in kind["geofencing_zones"].dataType.names:
        feature = kind["geofencing_zones"].dataType["features"].dataType.elementType
        if "properties" in feature.names and "name" in feature["properties"].dataType.names:
            named = F.transform(
                data["geofencing_zones"]["features"],
                lambda f: f.withField("properties", F.when(
                    f["properties"].isNotNull(),
                    f["properties"].withField("name", localized(f["properties"]["name"])))),
            )
            data = data.withField("geofencing_zones", F.when(
                data["geofencing_zones"].isNotNull(), data["geofencing_zones"].withField("features", named)))
    empty = F.array().cast(rules)
    existing = F.col("data")["global_rules"] if "global_rules" in kind.names else F.lit(None).cast(rules)
    return _document(df, data.withField("global_rules", F.coalesce(existing, empty)))


UPGRADES = {
    "station_information": upgrade_station_information,
    "system_pricing_plans": upgrade_pricing_plans,
    "vehicle_types": upgrade_vehicle_types,
    "geofencing_zones": upgrade_geofencing_zones,
}


def upgrade_documents(docs: DataFrame, feed: str, old_schema: str, new_schema: str, text: str = "json") -> DataFrame:
    """Document texts of either version as version-3.0 columns.

    Texts that already carry version 3.0 are only parsed; the others are parsed as 2.3 and upgraded.
    """
    is_new = F.coalesce(F.get_json_object(text, "$.version") == NEW_VERSION, F.lit(False))
    rest = [c for c in docs.columns if c != text]
    parsed = lambda part, schema: part.select(*rest, F.from_json(text, schema).alias("_d")).select(*rest, "_d.*")
    upgraded = UPGRADES[feed](parsed(docs.where(~is_new), old_schema))
    current = parsed(docs.where(is_new), new_schema)
    fields = {f.name: f.dataType for f in current.schema.fields}
    return current.unionByName(upgraded.select(*(F.col(n).cast(k).alias(n) for n, k in fields.items())))
