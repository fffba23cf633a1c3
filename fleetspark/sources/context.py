"""Holidays, points of interest, map nodes, polygon layers and demographics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fleetspark.functions.numbers import decimals
from fleetspark.functions.wkb import polygon_wkb
from fleetspark.operators.context import demographics, explode_subdivisions

HOLIDAY_SCHEMA = (
    "name array<struct<language: string, text: string>>, startDate string, endDate string, type string, "
    "subdivisions array<struct<code: string, shortName: string>>"
)


def read_holidays(spark: SparkSession, path: str, country: str) -> DataFrame:
    """Holiday documents of one country as rows per subdivision."""
    raw = spark.read.schema(HOLIDAY_SCHEMA).option("multiLine", True).json(path)
    return explode_subdivisions(raw.select(
        F.get("name", F.lit(0)).getField("text").alias("name"), F.col("startDate").alias("start_date"),
        F.lit(country).alias("country_name"), F.col("endDate").alias("end_date"), "type",
        F.transform("subdivisions", lambda s: s["code"]).alias("codes")))


POI_SCHEMA = (
    "results array<struct<fsq_id: string, name: string, geocodes: struct<main: struct<latitude: double, longitude: double>>, "
    "categories: array<struct<name: string>>, popularity: double, rating: double, price: double, hours: struct<display: string>>>"
)


def poi_rows(docs: DataFrame) -> DataFrame:
    """Search results as points of interest; absent numbers are -1, absent hours empty; one row per id."""
    p = F.col("p")
    number = lambda n: F.coalesce(p[n], F.lit(-1.0)).alias(n)
    rows = docs.select(F.explode("results").alias("p")).select(
        p.fsq_id.alias("fsq_id"), p["name"].alias("name"), p.geocodes.main.latitude.alias("latitude"),
        p.geocodes.main.longitude.alias("longitude"),
        F.array_join(F.transform(F.coalesce(p.categories, F.array()), lambda c: c["name"]), ", ").alias("categories"),
        number("popularity"), number("rating"), number("price"), F.coalesce(p.hours.display, F.lit("")).alias("hours_display"))
    return rows.where(F.coalesce("fsq_id", F.lit("")) != "")


def read_pois(spark: SparkSession, path: str) -> DataFrame:
    return poi_rows(spark.read.schema(POI_SCHEMA).json(path))


# Map entities as (name, tag key, tag value, tags kept).
_NAME, _HOURS, _FOOD = ["name"], ["name", "opening_hours"], ["name", "cuisine", "opening_hours"]
OSM_ENTITIES = [
    ("restaurant", "amenity", "restaurant", _FOOD), ("bar", "amenity", "bar", _HOURS), ("bakery", "amenity", "bakery", _HOURS),
    ("cafe", "amenity", "cafe", _HOURS), ("fast_food", "amenity", "fast_food", _FOOD), ("university", "amenity", "university", _NAME),
    ("college", "amenity", "college", _NAME), ("school", "amenity", "school", _NAME), ("kindergarten", "amenity", "kindergarten", _NAME),
    ("hospital", "amenity", "hospital", _HOURS), ("library", "amenity", "library", _HOURS),
    ("place_of_worship", "amenity", "place_of_worship", _NAME), ("marketplace", "amenity", "marketplace", _HOURS),
    ("bank", "amenity", "bank", _HOURS), ("doctors", "amenity", "doctors", _HOURS), ("pharmacy", "amenity", "pharmacy", _HOURS),
    ("dentist", "amenity", "dentist", _HOURS), ("chemist", "amenity", "chemist", _HOURS), ("cinema", "amenity", "cinema", _NAME),
    ("clothes", "shop", "clothes", _HOURS), ("department_store", "shop", "department_store", _HOURS),
    ("parcel_locker", "amenity", "parcel_locker", _HOURS), ("supermarket", "shop", "supermarket", _HOURS),
    ("theatre", "amenity", "theatre", _HOURS), ("townhall", "amenity", "townhall", _NAME),
    ("public_transport_platform", "public_transport", "platform", _NAME), ("tram_stop", "railway", "tram_stop", _NAME),
    ("station", "public_transport", "station", _NAME), ("bus_stop", "highway", "bus_stop", _NAME),
    ("attraction", "tourism", "attraction", _NAME), ("museum", "tourism", "museum", _NAME), ("park", "leisure", "park", _NAME),
]
OSM_SCHEMA = "id bigint, lat double, lon double, tags map<string, string>"
OSM_TAGS = ["name", "cuisine", "opening_hours"]


def osm_rows(nodes: DataFrame, year: int, entities: list[tuple] = OSM_ENTITIES) -> DataFrame:
    """Nodes as one row per entity they are; tags an entity does not keep or a node lacks are empty.

    The short entity list is part of the expression: every node is matched where it stands.
    """
    known = F.array(*(
        F.struct(F.lit(name).alias("entity_name"), F.lit(key).alias("k"), F.lit(value).alias("v"),
                 F.array(*(F.lit(t) for t in kept)).alias("kept"))
        for name, key, value, kept in entities))
    matches = F.filter(known, lambda e: F.try_element_at(F.col("tags"), e.k) == e.v)
    stamp = F.make_timestamp(F.lit(year), F.lit(1), F.lit(1), F.lit(12), F.lit(0), F.lit(0))
    tag = lambda t: F.when(F.array_contains("e.kept", t), F.coalesce(F.try_element_at("tags", F.lit(t)), F.lit(""))).otherwise("").alias(t)
    # Coordinates are kept to 4 decimals first and matched at 3, so they round twice.
    twice = lambda c: decimals(decimals(F.col(c), 4), 3)
    return nodes.select("id", "lat", "lon", "tags", F.explode(matches).alias("e")).select(
        F.col("id").alias("osm_id"), stamp.alias("timestamp"), twice("lat").alias("lat"), twice("lon").alias("lng"),
        F.col("e.entity_name").alias("entity_name"), *(tag(t) for t in OSM_TAGS))


def read_osm_nodes(spark: SparkSession, path: str, year: int) -> DataFrame:
    return osm_rows(spark.read.schema(OSM_SCHEMA).json(path), year)


FEATURE = "struct<properties: map<string, string>, geometry: struct<type: string, coordinates: string>>"


def polygon_rows(features: DataFrame, name: str, order: str = "pos", constants: dict[str, str] | None = None, extra: dict[str, str] | None = None) -> DataFrame:
    """(layer_order, name, rings, parts, multi[, ...]) of the polygons among feature structs; other geometries are left out.

    ``parts`` numbers the part of a multi-polygon (``multi``) each ring belongs to; parts may overlap.
    ``name`` is the property that becomes the name, ``extra`` maps further properties to columns and
    ``constants`` adds fixed columns.
    """
    kind, text = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    polygon = F.from_json(text, "array<array<array<double>>>")
    multi = F.from_json(text, "array<array<array<array<double>>>>")
    parts = F.when(kind == "Polygon", F.transform(polygon, lambda ring: F.lit(0))).otherwise(
        F.flatten(F.transform(multi, lambda rings, i: F.transform(rings, lambda ring: i))))
    rings = F.transform(
        F.when(kind == "Polygon", polygon).otherwise(F.flatten(multi)),
        lambda ring: F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    prop = lambda p: F.try_element_at(F.col("f.properties"), F.lit(p))
    return features.where(kind.isin("Polygon", "MultiPolygon")).select(
        F.col(order).cast("int").alias("layer_order"), prop(name).alias("name"), rings.alias("rings"), parts.alias("parts"),
        (kind == "MultiPolygon").alias("multi"),
        *(prop(p).alias(c) for p, c in (extra or {}).items()), *(F.lit(v).alias(c) for c, v in (constants or {}).items()))


def read_polygon_layer(
    spark: SparkSession, path: str, name: str, constants: dict[str, str] | None = None, extra: dict[str, str] | None = None,
) -> DataFrame:
    """A GeoJSON feature collection in WGS-84; the first feature has the lowest layer_order."""
    docs = spark.read.schema(f"features array<{FEATURE}>").option("multiLine", True).json(path)
    return polygon_rows(docs.select(F.posexplode("features").alias("pos", "f")), name, constants=constants, extra=extra)


def areas(polygons: DataFrame, *keep: str | Column) -> DataFrame:
    """Polygon rows as the ``keep`` columns and ``area``, the polygon as well-known binary."""
    return polygons.select(*keep, polygon_wkb(F.col("rings"), F.col("parts"), F.col("multi")).alias("area"))


def read_feature_areas(spark: SparkSession, path: str, city: str = "MA", name: str = "id_name") -> DataFrame:
    """(city, name, area) of a feature service's polygons."""
    return areas(read_polygon_layer(spark, path, name, constants={"city": city}), "city", "name")


def read_land_use(spark: SparkSession, path: str, city: str) -> DataFrame:
    """(city, landuse, area) of one city's land-use polygons."""
    return areas(read_polygon_layer(spark, path, "landuse", constants={"city": city}), "city", F.col("name").alias("landuse"))


DEMOGRAPHICS_SCHEMA = (
    "geographies array<struct<features: array<struct<name: string>>, themes: array<struct<name: string, "
    "indicators: array<struct<name: string, date: string, values: array<string>>>>>>>"
)


def read_demographics(spark: SparkSession, path: str, city: str = "MA") -> DataFrame:
    """The second geography of each document, its themes and indicators as rows."""
    docs = spark.read.schema(DEMOGRAPHICS_SCHEMA).option("multiLine", True).json(path)
    second = F.get("geographies", F.lit(1))
    return demographics(docs.select(second.features.alias("features"), second.themes.alias("themes")), city)
