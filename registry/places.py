"""Dictionaries, lookups and spatial joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetspark.functions.geo import geodesic_m, haversine_km, inside
from fleetspark.operators import lookup, spatial
from fleetspark.operators.keys import assign_ids, new_keys
from registry.base import NETWORKS, NETWORKS_SQL, Query, Source
from registry.facts import locations


def layer(t: Source):
    """The polygon layer with rings, from the same centres and radii as the edges."""
    x, y, r = F.col("cx"), F.col("cy"), F.col("r")
    p = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    four = F.array(p(x - r, y), p(x, y - r), p(x + r, y), p(x, y + r))
    three = F.array(p(x - r, y), p(x + r, y - r / 2), p(x, y + r))
    return t("areas").select("layer_order", "name", F.array(F.when(F.col("corners") == 4, four).otherwise(three)).alias("rings"))


HITS_SQL = """SELECT s.lat, s.lng, e.layer_order, e.name FROM {spots} s JOIN {edges} e
  ON (e.y1 > s.lat) <> (e.y2 > s.lat) AND s.lng < (e.x2 - e.x1) * (s.lat - e.y1) / (e.y2 - e.y1) + e.x1
  GROUP BY s.lat, s.lng, e.layer_order, e.name HAVING count(*) % 2 = 1"""
FIRST_SQL = f"""SELECT lat, lng, arg_min(name, layer_order) AS name FROM ({HITS_SQL}) h GROUP BY lat, lng"""
KM_SQL = """round(2 * 6371.0 * asin(least(1, sqrt(pow(sin(radians({b}.lat - {a}.lat) / 2), 2)
  + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin(radians({b}.lng - {a}.lng) / 2), 2)))), 6)"""


def km_sql(a: str, b: str) -> str:
    return KM_SQL.replace("{a}", a).replace("{b}", b)


def states(t: Source):
    return layer(t).where("layer_order >= 1000000")


def split_zone(t: Source):
    return spatial.split_by_polygon(
        t("zone_snap"), layer(t).where("layer_order < 1000000"), "zone_id", "LUDWIGSHAFEN", "MANNHEIM", "lat", "lng",
        only=F.col("zone_id") == "MANNHEIM-LUDWIGSHAFEN")


def known_cities(t: Source):
    """City names for some cells: those of the customers' cells near the fleet."""
    key = F.col("c_custkey")
    return t("customer").select(
        F.round(49.39 + (key % 53) * 0.001, 3).alias("lat"), F.round(8.39 + (key % 31) * 0.001, 3).alias("lng"),
        F.col("c_mktsegment").alias("city"))


CITIES_SQL = """SELECT round(49.39 + (c_custkey % 53) * 0.001, 3) AS lat, round(8.39 + (c_custkey % 31) * 0.001, 3) AS lng, c_mktsegment AS city FROM {customer}"""


def heights(t: Source):
    key = F.col("c_custkey")
    return t("customer").groupBy(
        F.round(49.4 + (key % 25) * 0.001, 3).alias("lat"), F.round(8.4 + (key % 3) * 0.001, 3).alias("lng")
    ).agg(F.min(key % 900).alias("elevation"))


HEIGHTS_SQL = """SELECT round(49.4 + (c_custkey % 25) * 0.001, 3) AS lat, round(8.4 + (c_custkey % 3) * 0.001, 3) AS lng,
  min(c_custkey % 900) AS elevation FROM {customer} GROUP BY 1, 2"""
ALL_CELLS_SQL = "SELECT row_number() OVER (ORDER BY lat, lng) AS location_id, lat, lng FROM {spots}"


def spot_ids(t: Source):
    return assign_ids(t("spots"), ["lat", "lng"], "location_id")


def geo_rows(t: Source):
    postal = layer(t).where("layer_order < 1000000").withColumn("name", F.regexp_extract("name", "([0-9]+)", 1))
    wide = states(t)
    layers = {"continent_name": wide, "country_name": wide, "federal_state_name": layer(t), "postal_code": postal}
    return spatial.geo_information(spot_ids(t), layers, known_cities(t), heights(t)).withColumn("location", F.length("location") > 10)


def nearest_sql(sites: str, limit: str = "") -> str:
    return f"""SELECT p.point_id, p.lat, p.lng, arg_min(s.site, struct_pack(km := {km_sql('p', 's')}, site := s.site)) AS site,
       min({km_sql('p', 's')}) AS distance_km
FROM {{points}} p, ({sites}) s {limit} GROUP BY p.point_id, p.lat, p.lng"""


def by_geodesic(t: Source):
    """Vehicle cells against each point's neighbour cell, on the ellipsoid and on the sphere."""
    df = t("snap").select("lat", "lon").distinct().select(
        "lat", F.col("lon").alias("lng"), (F.col("lat") + 0.013).alias("lat2"), (F.col("lon") + 0.021).alias("lng2"))
    ends = [F.col(c) for c in ("lat", "lng", "lat2", "lng2")]
    return df.select("lat", "lng", F.round(haversine_km(*ends) * 1000, 4).alias("sphere_m"), F.round(geodesic_m(*ends), 4).alias("ellipsoid_m"))


# Twelve corrections of the longitude; lat and lng to lat2 and lng2 are nowhere near the antipode.
GEODESIC_SQL = """
SELECT * FROM (WITH RECURSIVE c AS (SELECT DISTINCT lat, lon AS lng, lat + 0.013 AS lat2, lon + 0.021 AS lng2 FROM {snap}),
k AS (SELECT 6378137.0::DOUBLE AS a, 1 / 298.257223563::DOUBLE AS f),
r AS (
  SELECT lat, lng, lat2, lng2, a, f, atan((1 - f) * tan(radians(lat))) AS u1, atan((1 - f) * tan(radians(lat2))) AS u2,
         radians(lng2 - lng) AS diff, radians(lng2 - lng) AS lam, 0 AS i FROM c, k
  UNION ALL
  SELECT lat, lng, lat2, lng2, a, f, u1, u2, diff,
         diff + (1 - g) * f * sin_az * (sigma + g * sin_s * (mid + g * cos_s * (2 * mid * mid - 1))), i + 1
  FROM (SELECT *, f / 16 * cos2 * (4 + f * (4 - 3 * cos2)) AS g, cos_s - 2 * sin(u1) * sin(u2) / cos2 AS mid
        FROM (SELECT *, 1 - sin_az * sin_az AS cos2
              FROM (SELECT *, cos(u1) * cos(u2) * sin(lam) / sin_s AS sin_az, atan2(sin_s, cos_s) AS sigma
                    FROM (SELECT *, sqrt(pow(cos(u2) * sin(lam), 2) + pow(cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam), 2)) AS sin_s,
                                 sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam) AS cos_s FROM r WHERE i < 12))))),
s AS (SELECT *, (1 - f) * a AS b, sqrt(pow(cos(u2) * sin(lam), 2) + pow(cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam), 2)) AS sin_s,
             sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam) AS cos_s FROM r WHERE i = 12),
z AS (SELECT *, 1 - pow(cos(u1) * cos(u2) * sin(lam) / sin_s, 2) AS cos2 FROM s),
e AS (SELECT *, cos2 * (a * a - b * b) / (b * b) AS k2, cos_s - 2 * sin(u1) * sin(u2) / cos2 AS mid FROM z),
h AS (SELECT *, 1 + k2 / 16384 * (4096 + k2 * (-768 + k2 * (320 - 175 * k2))) AS big, k2 / 1024 * (256 + k2 * (-128 + k2 * (74 - 47 * k2))) AS small FROM e)
SELECT lat, lng,
       round(2 * 6371000.0 * asin(sqrt(pow(sin(radians(lat2 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(lat2)) * pow(sin(radians(lng2 - lng) / 2), 2))), 4) AS sphere_m,
       round(b * big * (atan2(sin_s, cos_s) - small * sin_s * (mid + small / 4 * (cos_s * (2 * mid * mid - 1)
             - small / 6 * mid * (4 * sin_s * sin_s - 3) * (4 * mid * mid - 3)))), 4) AS ellipsoid_m FROM h)"""


def grid_sql(step: float = 2000.0) -> str:
    return f"""
WITH e AS (SELECT n_name AS city, {{edges}}.* FROM {{edges}} JOIN {{nation}} ON {{edges}}.name = n_name),
o AS (SELECT city, min(x1) AS ox, max(x1) AS mx, min(y1) AS oy, max(y1) AS my, {step} / 111320.0 AS sy FROM e GROUP BY city),
g AS (SELECT o.*, {step} / (111320.0 * cos(radians(oy))) AS sx FROM o),
p AS (SELECT city, i, j, oy + j * sy AS lat, ox + i * sx AS lng FROM
  (SELECT g.*, unnest(range(0, cast(ceil((mx - ox) / sx) AS bigint) + 1)) AS i FROM g) a,
  LATERAL (SELECT unnest(range(0, cast(ceil((a.my - a.oy) / a.sy) AS bigint) + 1)) AS j) b)
SELECT p.city, p.i, p.j, round(p.lat, 6) AS lat, round(p.lng, 6) AS lng FROM p JOIN e ON p.city = e.city
 AND (e.y1 > p.lat) <> (e.y2 > p.lat) AND p.lng < (e.x2 - e.x1) * (p.lat - e.y1) / (e.y2 - e.y1) + e.x1
GROUP BY p.city, p.i, p.j, p.lat, p.lng HAVING count(*) % 2 = 1"""


def grid(t: Source):
    areas = states(t).select(F.col("name").alias("city"), "rings")
    return spatial.city_grid(areas, 2000.0).withColumns({"lat": F.round("lat", 6), "lng": F.round("lng", 6)})


def fine_grid(t: Source):
    """The usual spacing on all areas, summed up: the points themselves would be some ten million at any scale."""
    areas = layer(t).select(F.col("name").alias("city"), "rings")
    return spatial.city_grid(areas).groupBy("city").agg(
        F.count("*").alias("points"), F.sum("i").alias("sum_i"), F.sum("j").alias("sum_j"), F.sum(F.col("i") * F.col("j")).alias("sum_ij"),
        F.round(F.min("lat"), 6).alias("south"), F.round(F.max("lng"), 6).alias("east"))


QUERIES = [
    Query(
        "d1_assign_ids", spot_ids, "SELECT cast(location_id AS integer) AS location_id, lat, lng FROM (" + ALL_CELLS_SQL + ") c",
    ),
    Query(
        "d1_assign_ids_existing",
        lambda t: assign_ids(t("spots"), ["lat", "lng"], "location_id", existing=locations(t)),
        """SELECT cast(location_id AS integer) AS location_id, lat, lng FROM {cells} UNION ALL
           SELECT cast(row_number() OVER (ORDER BY lat, lng) + (SELECT max(location_id) FROM {cells}) AS integer), lat, lng FROM
           (SELECT s.lat, s.lng FROM {spots} s WHERE NOT EXISTS (SELECT 1 FROM {cells} c WHERE c.lat = s.lat AND c.lng = s.lng)) n""",
    ),
    Query(
        "d1_assign_ids_names",
        lambda t: assign_ids(t("documents"), ["source", "text"], "name_id").select("name_id", "source", F.md5("text").alias("text")),
        """SELECT cast(row_number() OVER (ORDER BY source, text) AS integer) AS name_id, source, md5(text) AS text
           FROM (SELECT DISTINCT source, text FROM {documents} WHERE source IS NOT NULL AND text IS NOT NULL) d""",
    ),
    Query(
        "d2_map_locations",
        lambda t: lookup.map_locations(t("zone_snap").select("license_plate", "snapshot_ts", "lat", "lng"), locations(t)),
        """SELECT s.license_plate, s.snapshot_ts, s.lat, s.lng, cast(c.location_id AS integer) AS location_id FROM {zone_snap} s
           JOIN {cells} c ON round(s.lat, 3) = c.lat AND round(s.lng, 3) = c.lng""",
    ),
    Query(
        "j1_with_location_id", lambda t: lookup.with_location_id(t("sightings"), locations(t)),
        "SELECT s.*, cast(c.location_id AS integer) AS location_id FROM {sightings} s LEFT JOIN {cells} c ON s.lat = c.lat AND s.lon = c.lng",
    ),
    Query(
        "j2_with_network_id",
        lambda t: t("sightings").withColumn("network_id", lookup.mapped(F.col("network_name"), {k: v for k, v in NETWORKS.items() if k != "Heidelberg"})),
        f"""SELECT s.*, nm.code AS network_id FROM {{sightings}} s LEFT JOIN (SELECT * FROM {NETWORKS_SQL} WHERE name <> 'Heidelberg') nm
            ON s.network_name = nm.name""",
    ),
    Query(
        "j3_with_station_name",
        lambda t: lookup.with_station_name(
            t("snap").select("vehicle_id", "last_updated", "station_id"),
            t("customer").select(F.concat(F.lit("S"), (F.col("c_custkey") % 35).cast("string")).alias("station_id"), F.col("c_name").alias("station_name")),
            assign_ids(t("customer").select(F.col("c_name").alias("station_name")), ["station_name"], "station_name_id")),
        """WITH n AS (SELECT row_number() OVER (ORDER BY c_name) AS id, c_name FROM (SELECT DISTINCT c_name FROM {customer}) d)
           SELECT s.vehicle_id, s.last_updated, s.station_id, m.name AS station_name, cast(n.id AS integer) AS station_name_id FROM {snap} s
           LEFT JOIN (SELECT concat('S', c_custkey % 35) AS station_id, min(c_name) AS name FROM {customer} GROUP BY 1) m ON s.station_id = m.station_id
           LEFT JOIN n ON n.c_name = m.name""",
    ),
    Query(
        "j4_with_short_station_id",
        lambda t: lookup.with_short_station_id(
            t("snap").select("vehicle_id", "last_updated", "station_id"),
            assign_ids(t("customer").select(F.concat(F.lit("S"), (F.col("c_custkey") % 35).cast("string")).alias("station_id")), ["station_id"], "new_station_id")),
        """WITH n AS (SELECT row_number() OVER (ORDER BY station_id) AS id, station_id FROM (SELECT DISTINCT concat('S', c_custkey % 35) AS station_id FROM {customer}) d)
           SELECT s.vehicle_id, s.last_updated, cast(n.id AS integer) AS station_id FROM {snap} s LEFT JOIN n ON s.station_id = n.station_id""",
    ),
    Query(
        "j7_new_keys", lambda t: new_keys(t("spots"), locations(t), ["lat", "lng"]),
        "SELECT s.lat, s.lng FROM {spots} s WHERE NOT EXISTS (SELECT 1 FROM {cells} c WHERE c.lat = s.lat AND c.lng = s.lng)",
    ),
    Query(
        "j10_point_in_polygon", lambda t: spatial.point_in_polygon(t("spots"), layer(t)),
        f"SELECT s.lat, s.lng, coalesce(f.name, '') AS name FROM {{spots}} s LEFT JOIN ({FIRST_SQL}) f ON s.lat = f.lat AND s.lng = f.lng",
    ),
    Query(
        "j10_point_in_polygon_numeric",
        lambda t: spatial.point_in_polygon(t("spots"), layer(t).withColumn("name", F.regexp_extract("name", "([0-9]+)", 1)), "code", numeric=True),
        f"""SELECT s.lat, s.lng, coalesce(try_cast(regexp_extract(f.name, '([0-9]+)', 1) AS integer), 0) AS code FROM {{spots}} s
            LEFT JOIN ({FIRST_SQL}) f ON s.lat = f.lat AND s.lng = f.lng""",
    ),
    Query(
        "j11_split_by_polygon", split_zone,
        """WITH d AS (SELECT DISTINCT lat, lng FROM {zone_snap}), h AS (
             SELECT d.lat, d.lng, e.layer_order FROM d JOIN {edges} e ON (e.y1 > d.lat) <> (e.y2 > d.lat)
             AND d.lng < (e.x2 - e.x1) * (d.lat - e.y1) / (e.y2 - e.y1) + e.x1 WHERE e.layer_order < 1000000
             GROUP BY d.lat, d.lng, e.layer_order HAVING count(*) % 2 = 1)
           SELECT z.* REPLACE (CASE WHEN zone_id <> 'MANNHEIM-LUDWIGSHAFEN' THEN zone_id
             WHEN EXISTS (SELECT 1 FROM h WHERE h.lat = z.lat AND h.lng = z.lng) THEN 'LUDWIGSHAFEN' ELSE 'MANNHEIM' END AS zone_id) FROM {zone_snap} z""",
    ),
    Query(
        "j12_nearest_city_within",
        lambda t: spatial.nearest_city_within(t("points"), t("sites").select(F.col("station_name").alias("site"), "lat", "lng"), "site"),
        nearest_sql("SELECT station_name AS site, lat, lng FROM {sites}", f"WHERE {km_sql('p', 's')} <= 20"),
    ),
    Query(
        "j13_nearest_station",
        lambda t: spatial.nearest_station(t("points"), t("sites"), F.lit("2024-01-01").cast("date"), F.lit("2024-12-31").cast("date"))
        .withColumnRenamed("station_id", "site"),
        nearest_sql("SELECT station_id AS site, lat, lng FROM {sites} WHERE valid_from <= date '2024-01-01' AND valid_to >= date '2024-12-31'"),
    ),
    Query(
        "j13_chosen_stations",
        lambda t: spatial.chosen_stations(t("points"), t("sites"), F.lit("2024-01-01").cast("date"), F.lit("2024-12-31").cast("date")),
        "SELECT * FROM {sites} WHERE station_id IN (SELECT site FROM (" + nearest_sql(
            "SELECT station_id AS site, lat, lng FROM {sites} WHERE valid_from <= date '2024-01-01' AND valid_to >= date '2024-12-31'") + ") n)",
    ),
    Query(
        "j15_stops_in_region",
        lambda t: spatial.stops_in_region(t("spots"), states(t), layer(t).withColumn("name", F.concat(F.lit("City "), "name")), ["supplier#00000001", "AN"]),
        f"""SELECT s.lat, s.lng FROM {{spots}} s JOIN ({FIRST_SQL}) f ON s.lat = f.lat AND s.lng = f.lng
            WHERE EXISTS (SELECT 1 FROM ({HITS_SQL}) h WHERE h.layer_order >= 1000000 AND h.lat = s.lat AND h.lng = s.lng)
            AND (contains(lower(concat('City ', f.name)), 'supplier#00000001') OR contains(lower(concat('City ', f.name)), 'an'))""",
    ),
    Query(
        "a11_group_nearby", lambda t: spatial.group_nearby(t("spots")),
        "SELECT round(lat, 2) AS cell_lat, round(lng, 2) AS cell_lng, count(*) AS members FROM {spots} GROUP BY 1, 2",
    ),
    Query(
        "d3_geo_information", geo_rows,
        f"""WITH hits AS (
              SELECT DISTINCT c.glat, c.glng, e.layer_order, e.name FROM (SELECT DISTINCT round(lat, 2) AS glat, round(lng, 2) AS glng FROM {{spots}}) c
              JOIN {{edges}} e ON (e.y1 > c.glat) <> (e.y2 > c.glat) AND c.glng < (e.x2 - e.x1) * (c.glat - e.y1) / (e.y2 - e.y1) + e.x1
              GROUP BY c.glat, c.glng, e.layer_order, e.name HAVING count(*) % 2 = 1),
            wide AS (SELECT glat, glng, arg_min(name, layer_order) AS name FROM hits WHERE layer_order >= 1000000 GROUP BY 1, 2),
            allf AS (SELECT glat, glng, arg_min(name, layer_order) AS name FROM hits GROUP BY 1, 2),
            post AS (SELECT glat, glng, arg_min(name, layer_order) AS name FROM hits WHERE layer_order < 1000000 GROUP BY 1, 2),
            loc AS ({ALL_CELLS_SQL}), ci AS ({CITIES_SQL}), he AS ({HEIGHTS_SQL}),
            near AS (SELECT l.lat, l.lng, arg_min(ci.city, struct_pack(d := pow(round((ci.lat - l.lat) * 1000), 2) + pow(round((ci.lng - l.lng) * 1000), 2), c := ci.city)) AS city
              FROM loc l JOIN ci ON round(abs(ci.lat - l.lat) * 1000) <= 10 AND round(abs(ci.lng - l.lng) * 1000) <= 10 GROUP BY l.lat, l.lng)
            SELECT cast(l.location_id AS integer) AS location_id, true AS location, coalesce(w.name, '') AS continent_name, coalesce(w.name, '') AS country_name,
              coalesce(n.city, '') AS city_name, coalesce(a.name, '') AS federal_state_name,
              coalesce(try_cast(regexp_extract(p.name, '([0-9]+)', 1) AS integer), 0) AS postal_code, cast(he.elevation AS smallint) AS elevation
            FROM loc l LEFT JOIN wide w ON w.glat = round(l.lat, 2) AND w.glng = round(l.lng, 2) LEFT JOIN allf a ON a.glat = round(l.lat, 2) AND a.glng = round(l.lng, 2)
            LEFT JOIN post p ON p.glat = round(l.lat, 2) AND p.glng = round(l.lng, 2) LEFT JOIN near n ON n.lat = l.lat AND n.lng = l.lng
            LEFT JOIN he ON he.lat = l.lat AND he.lng = l.lng""",
    ),
    Query(
        "d4_lookup_elevation", lambda t: spatial.lookup_elevation(t("spots"), heights(t)),
        f"SELECT s.lat, s.lng, cast(h.elevation AS smallint) AS elevation FROM {{spots}} s LEFT JOIN ({HEIGHTS_SQL}) h ON s.lat = h.lat AND s.lng = h.lng",
    ),
    Query(
        "d4_lookup_city", lambda t: spatial.lookup_city(t("spots"), known_cities(t)),
        f"""SELECT s.lat, s.lng, arg_min(c.city, struct_pack(d := pow(round((c.lat - s.lat) * 1000), 2) + pow(round((c.lng - s.lng) * 1000), 2), c := c.city)) AS city
            FROM {{spots}} s LEFT JOIN ({CITIES_SQL}) c ON round(abs(c.lat - s.lat) * 1000) <= 10 AND round(abs(c.lng - s.lng) * 1000) <= 10 GROUP BY s.lat, s.lng""",
    ),
    Query("e5_city_grid", grid, grid_sql()),
    Query(
        "e5_city_grid_250m", fine_grid,
        """WITH o AS (SELECT name AS city, min(x1) AS ox, min(y1) AS oy, max(y1) AS my, 250.0 / 111320.0 AS sy FROM {edges} GROUP BY name),
           g AS (SELECT *, 250.0 / (111320.0 * cos(radians(oy))) AS sx, unnest(range(0, cast(ceil((my - oy) / (250.0 / 111320.0)) AS bigint) + 1)) AS j FROM o),
           l AS (SELECT *, oy + j * sy AS lat FROM g),
           c AS (SELECT city, j, lat, ox, sx, (x2 - x1) * (lat - y1) / (y2 - y1) + x1 AS x FROM l JOIN {edges} e ON e.name = city AND (y1 > lat) <> (y2 > lat)),
           s AS (SELECT *, lead(x) OVER w AS xe, row_number() OVER w AS k FROM c WINDOW w AS (PARTITION BY city, j ORDER BY x)),
           p AS (SELECT *, unnest(range(cast(floor((x - ox) / sx) AS bigint) - 1, cast(ceil((xe - ox) / sx) AS bigint) + 2)) AS i FROM s WHERE k % 2 = 1)
           SELECT city, count(*) AS points, sum(i)::BIGINT AS sum_i, sum(j)::BIGINT AS sum_j, sum(i * j)::BIGINT AS sum_ij,
             round(min(lat), 6) AS south, round(max(ox + i * sx), 6) AS east FROM p WHERE ox + i * sx >= x AND ox + i * sx < xe GROUP BY city""",
    ),
    Query(
        "g1_haversine_km",
        lambda t: t("points").withColumn("o", t("points").agg(F.struct(F.min("lat").alias("lat"), F.min("lng").alias("lng"))).scalar()).select(
            "point_id", F.round(haversine_km(F.col("lat"), F.col("lng"), F.col("o.lat"), F.col("o.lng")), 6).alias("km")),
        "WITH o AS (SELECT min(lat) AS lat, min(lng) AS lng FROM {points}) SELECT p.point_id, " + km_sql("p", "o") + " AS km FROM {points} p, o",
    ),
    Query("g2_geodesic_m", by_geodesic, GEODESIC_SQL),
    Query(
        "g3_ring_contains",
        lambda t: t("areas").where("corners = 4").select("layer_order", "cx", "cy", inside(
            F.array(*(F.struct(F.lit(a).alias("x1"), F.lit(b).alias("y1"), F.lit(c).alias("x2"), F.lit(d).alias("y2")) for a, b, c, d in (
                (8.4001, 49.4001, 8.4025, 49.4101), (8.4025, 49.4101, 8.4001, 49.4201), (8.4001, 49.4201, 8.4001, 49.4001)))),
            F.col("cx"), F.col("cy")).alias("within")),
        """WITH e(x1, y1, x2, y2) AS (VALUES (8.4001E0, 49.4001E0, 8.4025E0, 49.4101E0), (8.4025E0, 49.4101E0, 8.4001E0, 49.4201E0), (8.4001E0, 49.4201E0, 8.4001E0, 49.4001E0))
           SELECT layer_order, cx, cy, (SELECT count(*) FROM e WHERE (e.y1 > cy) <> (e.y2 > cy) AND cx < (e.x2 - e.x1) * (cy - e.y1) / (e.y2 - e.y1) + e.x1) % 2 = 1 AS within
           FROM {areas} WHERE corners = 4""",
    ),
]
