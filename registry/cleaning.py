"""Filters, normalisation and feed upgrades."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetspark.functions.numbers import half_even
from fleetspark.operators import clean
from fleetspark.operators.upgrade import upgrade_documents, upgrade_free_bike_status
from registry.base import NETWORKS, Query, Source


def with_reports(t: Source, with_nulls: bool):
    """Snapshots with a report time up to three days before the snapshot."""
    null_every = F.lit(None).cast("timestamp")
    df = t("events").select(
        "event_id", F.col("ts").alias("last_updated"),
        (F.col("ts") - F.expr("make_dt_interval(cast(event_id % 4 AS int))")).alias("last_reported"))
    return df.withColumn("last_reported", F.when(F.col("event_id") != 5, F.col("last_reported")).otherwise(null_every)) if with_nulls else df


STALE_SQL = """
WITH r AS (SELECT event_id, ts AS last_updated, {reported} AS last_reported FROM {{events}})
SELECT * FROM r WHERE (SELECT count(*) FROM r WHERE last_reported IS NULL) > 0
   OR last_reported >= (SELECT cast(min(last_updated) AS date) FROM r)"""


def all_operator_ids(t: Source):
    operators = ["voi", "dott", "lime", "regioradstuttgart", "callabike", "zeus", "bolt"]
    return t("uris").select("event_id", *(
        clean.canonical_vehicle_id(o, F.col("vehicle_id")).alias(f"{o}_id") for o in operators))


IDS_SQL = """
SELECT event_id,
  CASE WHEN rental_uri_ios LIKE '%scooter%2F%' THEN regexp_extract(rental_uri_ios, 'scooter%2F([^&]+)', 1) ELSE vehicle_id END AS voi_id,
  regexp_replace(vehicle_id, '^DO[CDGJ]:Vehicle:', '') AS dott_id,
  regexp_replace(vehicle_id, '^LMG:Vehicle:', '') AS lime_id,
  CASE WHEN rental_uri_ios LIKE 'https://www.callabike.de/bike?number=%' OR rental_uri_ios LIKE 'https://www.regioradstuttgart.de/bike?number=%'
       THEN regexp_extract(rental_uri_ios, 'number=([0-9]+)', 1) ELSE vehicle_id END AS regioradstuttgart_id,
  CASE WHEN rental_uri_ios LIKE 'https://www.callabike.de/bike?number=%' THEN regexp_extract(rental_uri_ios, 'number=([0-9]+)', 1) ELSE vehicle_id END AS callabike_id,
  CASE WHEN rental_uri_web LIKE 'https://zeus.city/api/v1/applinks?vehicle=%' THEN regexp_extract(rental_uri_web, 'vehicle=([0-9]+)', 1) ELSE vehicle_id END AS zeus_id,
  vehicle_id AS bolt_id
FROM {uris}"""

SANITIZED_SQL = """
WITH h AS (SELECT operator, day, min(last_updated) AS oldest FROM {reports} GROUP BY operator, day),
one AS (SELECT r.* FROM {reports} r JOIN h ON r.operator = h.operator AND r.day = h.day
        WHERE h.oldest IS NULL OR h.oldest >= timestamp '2023-01-01' OR r.last_updated >= timestamp '2023-01-01'),
g AS (SELECT operator, day, min(last_reported) AS lo, max(last_reported) AS hi, count(*) FILTER (WHERE last_reported IS NULL) AS nulls
      FROM one GROUP BY operator, day),
z AS (SELECT *, coalesce(lo = timestamp '1754-08-30 22:43:41.128654' AND hi = lo AND nulls = 0, false) AS zero FROM g)
SELECT o.operator, o.day, o.vehicle_id, o.last_updated, o.event_id, CASE WHEN NOT zero THEN o.last_reported END AS last_reported
FROM one o JOIN z ON o.operator = z.operator AND o.day = z.day
WHERE zero OR lo IS NULL OR lo >= timestamp '2023-01-01' OR o.last_reported >= timestamp '2023-01-01'"""


def street_rows(t: Source):
    """One station delivers a repeated column, the other lacks two measures."""
    base = t("events").select(
        "event_id", F.col("ts").alias("timestamps"), F.col("value").alias("airHumidity"),
        (F.col("value") * 3 + 0.5).alias("averageWindDirection"), "value")
    full = base.select("event_id", "timestamps", "airHumidity", "averageWindDirection",
                       F.lit(-1.0).alias("x")).toDF("event_id", "timestamps", "airHumidity", "averageWindDirection", "airHumidity")
    bare = base.select("event_id", "timestamps", F.col("value").alias("temperature"))
    return clean.align_weather_columns(full).unionByName(clean.align_weather_columns(bare))


def local_rows(t: Source):
    measures = {m: F.when(F.col("event_id") % (i + 2) == 0, F.col("value")) for i, m in enumerate(clean.WEATHER_MEASURES)}
    df = t("events").select("event_id", "ts", *(c.alias(m) for m, c in measures.items()))
    return clean.local_to_utc(df, "ts", F.lit("2024-01-05 00:00:00").cast("timestamp"), F.lit("2024-01-25 00:00:00").cast("timestamp"))


def poi_rows(t: Source):
    return t("customer").select(
        F.when(F.col("c_custkey") % 29 != 0, F.concat(F.lit("f"), F.col("c_custkey").cast("string"))).alias("fsq_id"),
        F.repeat("c_name", 15).alias("name"),
        F.when(F.col("c_custkey") % 31 == 0, F.lit(0.0)).otherwise(49.4 + F.col("c_custkey") / 7919.0).alias("latitude"),
        F.when(F.col("c_custkey") % 37 != 0, 8.4 + F.col("c_custkey") / 6301.0).alias("longitude"),
        F.col("c_mktsegment").alias("categories"),
        F.when(F.col("c_custkey") % 3 == 0, F.lit(-1)).otherwise(F.col("c_custkey") % 10).alias("popularity"),
        F.col("c_acctbal").alias("rating"),
        F.when(F.col("c_custkey") % 5 == 0, F.lit(-1)).otherwise(F.lit(2)).alias("price"),
        F.lit(None).cast("string").alias("hours_display"),
    )


POI_SQL = """
SELECT concat('f', cast(c_custkey AS varchar)) AS fsq_id, substr(repeat(c_name, 15), 1, 200) AS name,
       round(49.4 + cast(c_custkey AS double) / 7919.0, 3) AS lat, round(8.4 + cast(c_custkey AS double) / 6301.0, 3) AS lng,
       c_mktsegment AS categories, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE cast(c_custkey % 10 AS double) END AS popularity,
       CASE WHEN c_acctbal = -1 THEN NULL ELSE c_acctbal END AS rating, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE cast(2 AS double) END AS price,
       '' AS hours_display
FROM {customer} WHERE c_custkey % 29 <> 0 AND c_custkey % 31 <> 0 AND c_custkey % 37 <> 0"""

# ---------------------------------------------------------------------------------- feed upgrades

IS_NEW_SQL = "event_id % 5 = 0"
TEXT_KIND = "array<struct<text: string, language: string>>"


def documents(t: Source, old_data, new_data):
    """One feed document per event, every fifth already of the new version."""
    epoch = F.unix_timestamp("ts")
    old = F.to_json(F.struct(epoch.alias("last_updated"), F.lit("2.3").alias("version"), old_data.alias("data")))
    new = F.to_json(F.struct(
        F.date_format(F.timestamp_seconds(epoch), "yyyy-MM-dd'T'HH:mm:ssxxx").alias("last_updated"),
        F.lit("3.0").alias("version"), new_data.alias("data")))
    return t("events").select("event_id", F.when(F.col("event_id") % 5 == 0, new).otherwise(old).alias("json"))


def text_list(value):
    return F.array(F.struct(value.alias("text"), F.lit("en").alias("language")))


def user(prefix: str):
    return F.concat(F.lit(prefix), F.col("user_id").cast("string"))


def station_documents(t: Source):
    def station(i: int, new: bool):
        name = user(f"Place {i} of ")
        short = F.when(F.col("event_id") % 3 == 0, user(f"p{i}-"))
        fields = [user(f"S{i}-").alias("station_id"), F.col("value").alias("lat"), F.lit(8.5).alias("lon")]
        if new:
            fields += [text_list(name).alias("name"), F.when(short.isNotNull(), text_list(short)).alias("short_name")]
        else:
            fields += [name.alias("name"), short.alias("short_name"), F.lit(7).alias("vehicle_capacity"),
                       F.create_map(F.lit("a"), F.lit(3)).alias("vehicle_type_capacity")]
        return F.struct(*fields)

    data = lambda new: F.struct(F.array(station(1, new), station(2, new)).alias("stations"))
    docs = documents(t, data(False), data(True))
    item = "station_id: string, lat: double, lon: double, name: {0}, short_name: {0}"
    old = ("last_updated bigint, version string, data struct<stations: array<struct<" + item.format("string")
           + ", vehicle_capacity: int, vehicle_type_capacity: map<string, int>>>>")
    new = "last_updated string, version string, data struct<stations: array<struct<" + item.format(TEXT_KIND) + ">>>"
    return upgrade_documents(docs, "station_information", old, new)


def flat_stations(t: Source):
    s = F.col("s")
    return station_documents(t).select("event_id", "last_updated", "version", F.explode("data.stations").alias("s")).select(
        "event_id", "last_updated", "version", s.station_id.alias("station_id"), s.lat.alias("lat"), s.lon.alias("lon"),
        s["name"][0]["text"].alias("name_text"), s["name"][0]["language"].alias("name_language"),
        s["short_name"][0]["text"].alias("short_text"), F.size(s["name"]).alias("names"))


STAMP_SQL = "strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S+00:00') AS last_updated, '3.0' AS version"
STATIONS_SQL = f"""
SELECT event_id, {STAMP_SQL}, concat('S', i, '-', user_id) AS station_id, value AS lat, cast(8.5 AS double) AS lon,
       concat('Place ', i, ' of ', user_id) AS name_text, 'en' AS name_language,
       CASE WHEN event_id % 3 = 0 THEN concat('p', i, '-', user_id) END AS short_text, 1 AS names
FROM {{events}}, (VALUES (1), (2)) v(i)"""


def plan_documents(t: Source):
    def data(new: bool):
        wrap = text_list if new else (lambda c: c)
        plan = F.struct(user("plan-").alias("plan_id"), wrap(user("Plan ")).alias("name"),
                        F.when(F.col("event_id") % 2 == 0, wrap(F.col("event_type"))).alias("description"), F.col("value").alias("price"))
        return F.struct(F.array(plan).alias("plans"))

    item = "plan_id: string, name: {0}, description: {0}, price: double"
    schema = "last_updated {1}, version string, data struct<plans: array<struct<" + item + ">>>"
    out = upgrade_documents(documents(t, data(False), data(True)), "system_pricing_plans",
                            schema.format("string", "bigint"), schema.format(TEXT_KIND, "string"))
    p = F.col("p")
    return out.select("event_id", "last_updated", "version", F.explode("data.plans").alias("p")).select(
        "event_id", "last_updated", "version", p.plan_id.alias("plan_id"), p["name"][0]["text"].alias("name_text"),
        p["description"][0]["text"].alias("description_text"), p.price.alias("price"))


PLANS_SQL = f"""
SELECT event_id, {STAMP_SQL}, concat('plan-', user_id) AS plan_id, concat('Plan ', user_id) AS name_text,
       CASE WHEN event_id % 2 = 0 THEN event_type END AS description_text, value AS price FROM {{events}}"""


def type_documents(t: Source):
    def data(new: bool):
        wrap = text_list if new else (lambda c: c)
        label = F.array(F.struct(F.lit("DE").alias("country_code"), F.col("event_type").alias("eco_sticker")))
        vtype = F.struct(user("type-").alias("vehicle_type_id"), wrap(user("Bike ")).alias("name"), wrap(F.lit("Maker")).alias("make"),
                         label.alias("eco_labels" if new else "eco_label"))
        return F.struct(F.array(vtype).alias("vehicle_types"))

    schema = ("last_updated {1}, version string, data struct<vehicle_types: array<struct<vehicle_type_id: string, name: {0}, make: {0}, "
              "{2}: array<struct<country_code: string, eco_sticker: string>>>>>")
    out = upgrade_documents(documents(t, data(False), data(True)), "vehicle_types",
                            schema.format("string", "bigint", "eco_label"), schema.format(TEXT_KIND, "string", "eco_labels"))
    v = F.col("v")
    return out.select("event_id", "last_updated", "version", F.explode("data.vehicle_types").alias("v")).select(
        "event_id", "last_updated", "version", v.vehicle_type_id.alias("vehicle_type_id"), v["name"][0]["text"].alias("name_text"),
        v["make"][0]["text"].alias("make_text"), v["eco_labels"][0]["eco_sticker"].alias("eco_sticker"))


TYPES_SQL = f"""
SELECT event_id, {STAMP_SQL}, concat('type-', user_id) AS vehicle_type_id, concat('Bike ', user_id) AS name_text,
       'Maker' AS make_text, event_type AS eco_sticker FROM {{events}}"""


def zone_documents(t: Source):
    def data(new: bool):
        wrap = text_list if new else (lambda c: c)
        feature = F.struct(F.lit("Feature").alias("type"), F.struct(
            F.when(F.col("event_id") % 4 != 0, wrap(user("Zone "))).alias("name"), F.col("value").alias("maximum_speed_kph")).alias("properties"))
        zones = F.struct(F.lit("FeatureCollection").alias("type"), F.array(feature).alias("features"))
        parts = [zones.alias("geofencing_zones")] + ([F.array(F.lit("r")).alias("global_rules")] if new else [])
        return F.struct(*parts)

    schema = ("last_updated {1}, version string, data struct<geofencing_zones: struct<type: string, features: array<struct<type: string, "
              "properties: struct<name: {0}, maximum_speed_kph: double>>>>{2}>")
    out = upgrade_documents(documents(t, data(False), data(True)), "geofencing_zones",
                            schema.format("string", "bigint", ""), schema.format(TEXT_KIND, "string", ", global_rules: array<string>"))
    z = F.col("z")
    return out.select("event_id", "last_updated", "version", F.size("data.global_rules").alias("rules"),
                      F.explode("data.geofencing_zones.features").alias("z")).select(
        "event_id", "last_updated", "version", "rules", z.properties["name"][0]["text"].alias("name_text"),
        z.properties["maximum_speed_kph"].alias("speed"))


ZONES_DOC_SQL = f"""
SELECT event_id, {STAMP_SQL}, CASE WHEN {IS_NEW_SQL} THEN 1 ELSE 0 END AS rules,
       CASE WHEN event_id % 4 <> 0 THEN concat('Zone ', user_id) END AS name_text, value AS speed FROM {{events}}"""


def free_bikes(t: Source):
    return upgrade_free_bike_status(t("events").select(
        user("b").alias("bike_id"), F.unix_timestamp("ts").alias("last_reported"), F.unix_timestamp("ts").cast("double").alias("last_updated"),
        F.lit("2.3").alias("version"), "event_id"))


QUERIES = [
    Query(
        "p1_round_location", lambda t: clean.cell_key(clean.round_location(t("zone_snap"), "lat", "lng"), "lat", "lng").select(
            "license_plate", "snapshot_ts", "lat", "lng", "mlat", "mlng"),
        """SELECT license_plate, snapshot_ts, round(lat, 3) AS lat, round(lng, 3) AS lng, cast(round(round(lat, 3) * 1000) AS integer) AS mlat,
                  cast(round(round(lng, 3) * 1000) AS integer) AS mlng FROM {zone_snap}""",
    ),
    Query(
        "p2_filter_networks", lambda t: clean.filter_names(t("snap"), "network_name", ["Mannheim", "Stuttgart"]),
        "SELECT * FROM {snap} WHERE network_name IN ('Mannheim', 'Stuttgart')",
    ),
    Query(
        "p3_drop_stale", lambda t: clean.drop_stale(with_reports(t, False)),
        STALE_SQL.format(reported="ts - to_days(cast(event_id % 4 AS integer))").replace("{{", "{").replace("}}", "}"),
    ),
    Query(
        "p3_drop_stale_with_nulls", lambda t: clean.drop_stale(with_reports(t, True)),
        STALE_SQL.format(reported="CASE WHEN event_id <> 5 THEN ts - to_days(cast(event_id % 4 AS integer)) END").replace("{{", "{").replace("}}", "}"),
    ),
    Query("p4_normalize_vehicle_id", all_operator_ids, IDS_SQL),
    Query(
        "p5_assign_constant_network", lambda t: clean.assign_constant_network(t("zone_snap").select("license_plate", "snapshot_ts"), NETWORKS),
        "SELECT license_plate, snapshot_ts, 'Mannheim' AS network_name FROM {zone_snap}",
    ),
    Query(
        "p6_battery_percent", lambda t: t("events").select(
            "event_id", clean.battery_percent(F.col("value") / 1000).alias("battery"), clean.whole_metres(F.col("value") * 10.5).alias("range_m"),
            half_even(F.col("event_id") + 0.5, "bigint").alias("half")),
        """SELECT event_id, cast(round_even(value / 1000 * 100, 0) AS smallint) AS battery, cast(round_even(value * 10.5, 0) AS integer) AS range_m,
                  cast(round_even(event_id + cast(0.5 AS double), 0) AS bigint) AS half FROM {events}""",
    ),
    Query("p7_sanitize_reported", lambda t: clean.sanitize_reported(t("reports"), ["operator", "day"]), SANITIZED_SQL),
    Query(
        "p8_sentinel_to_null", lambda t: clean.sentinel_to_null(t("weather_long"), ["raw_value"]),
        """SELECT station_id, obs_ts, seq, measure, try_cast(nullif(nullif(trim(raw_value), ''), '-999') AS double) AS raw_value FROM {weather_long}""",
    ),
    Query("p9_poi_clean", lambda t: clean.poi_clean(poi_rows(t)), POI_SQL),
    Query(
        "p11_valid_stops", lambda t: clean.valid_stops(t("stops")),
        """SELECT *, cast(stop_lat AS double) AS lat, cast(stop_lon AS double) AS lng FROM {stops}
           WHERE try_cast(stop_lat AS double) BETWEEN -90 AND 90 AND try_cast(stop_lon AS double) BETWEEN -180 AND 180""",
    ),
    Query(
        "p12_valid_stop_times", lambda t: clean.valid_stop_times(t("stop_times")),
        """SELECT * FROM {stop_times} WHERE arrival_time IS NOT NULL AND departure_time IS NOT NULL AND length(arrival_time) >= 8
           AND length(departure_time) >= 8 AND arrival_time LIKE '%:%:%' AND departure_time LIKE '%:%:%'""",
    ),
    Query(
        "p13_align_weather_columns", street_rows,
        """SELECT event_id, ts AS timestamp, value AS "airHumidity", cast(NULL AS double) AS temperature,
                  cast(round_even(value * 3 + 0.5, 0) AS bigint) AS "averageWindDirection", cast(NULL AS double) AS "minWindSpeed" FROM {events}
           UNION ALL SELECT event_id, ts, NULL, value, NULL, NULL FROM {events}""",
    ),
    Query(
        "p14_local_to_utc", local_rows,
        """WITH e AS (SELECT event_id, ts - interval 1 hour AS ts, CASE WHEN event_id % 2 = 0 THEN value END AS temperature,
                      CASE WHEN event_id % 3 = 0 THEN value END AS humidity, CASE WHEN event_id % 4 = 0 THEN value END AS precipitation,
                      CASE WHEN event_id % 5 = 0 THEN value END AS wind_speed, CASE WHEN event_id % 6 = 0 THEN value END AS wind_direction FROM {events})
           SELECT * FROM e WHERE ts BETWEEN timestamp '2024-01-05' AND timestamp '2024-01-25'
           AND coalesce(temperature, humidity, precipitation, wind_speed, wind_direction) IS NOT NULL""",
    ),
    Query(
        "p15_numeric_or_null",
        lambda t: clean.numeric_or_null(t("events").select("event_id", F.when(F.col("event_id") % 7 == 0, F.lit(" ")).when(
            F.col("event_id") % 5 == 0, F.lit("k. A.")).otherwise(F.concat(F.lit(" "), F.col("value").cast("string"))).alias("value"),
            F.year("ts").cast("string").alias("year")), "value", "year"),
        """SELECT event_id, CASE WHEN event_id % 7 = 0 OR event_id % 5 = 0 THEN NULL ELSE value END AS value,
                  make_date(cast(year(ts) AS integer), 1, 1) AS year FROM {events}""",
    ),
    Query(
        "p16_prune_by_file_date",
        lambda t: clean.prune_by_file_date(
            t("events").select("event_id", F.concat(F.lit("produkt_"), F.date_format("ts", "yyyyMMdd"), F.lit("_x.txt")).alias("file")),
            "20240110", "20240120", pattern=r"_(\d{8})_", file_name=F.col("file")),
        """SELECT event_id, concat('produkt_', strftime(ts, '%Y%m%d'), '_x.txt') AS file FROM {events}
           WHERE cast(ts AS date) BETWEEN date '2024-01-10' AND date '2024-01-20'""",
    ),
    Query(
        "u1_upgrade_free_bike_status", free_bikes,
        """SELECT concat('b', user_id) AS vehicle_id, date_trunc('second', ts) AS last_reported, date_trunc('second', ts) AS last_updated,
                  '3.0' AS version, event_id FROM {events}""",
    ),
    Query("u2_upgrade_station_information", flat_stations, STATIONS_SQL),
    Query("u3_upgrade_geofencing_zones", zone_documents, ZONES_DOC_SQL),
    Query("u4_upgrade_pricing_plans", plan_documents, PLANS_SQL),
    Query("u5_upgrade_vehicle_types", type_documents, TYPES_SQL),
]
