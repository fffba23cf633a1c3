"""Trips, demand and availability."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetspark.operators.availability import (
    availability, availability_station_network, availability_zone, row_counts,
)
from fleetspark.operators.demand import (
    demand_from_trips, demand_full_outer, demand_rotating, demand_station_network, demand_zone,
    first_last_sighting, trim_edge_timestamps,
)
from fleetspark.operators.keys import assign_ids, keep_first, asc
from fleetspark.operators.station_network import restrict_hierarchy, station_network_snapshot
from fleetspark.operators.trips import trips_free_floating, trips_station_network, trips_zone
from fleetspark.session import stored
from registry.base import NETWORKS, NETWORKS_SQL, ZONES, ZONES_SQL, Query, Source


def locations(t: Source):
    """The stored location dictionary of all cells the fleets were seen in."""
    found = assign_ids(t("snap").select("lat", F.col("lon").alias("lng")), ["lat", "lng"], "location_id")
    return stored(found, "locations")


def network_locations(t: Source):
    return stored(assign_ids(t("places"), ["lat", "lng"], "location_id"), "locations")


def network_names(t: Source):
    names = t("places").select(F.col("name").alias("station_name"))
    return stored(assign_ids(names, ["station_name"], "station_name_id"), "names")


def network_snapshot(t: Source):
    return station_network_snapshot(t("bikes"), t("places"), t("cities"))


def zone_trips(t: Source):
    return trips_zone(t("zone_snap"), locations(t), ZONES)


def network_trips(t: Source):
    return trips_station_network(network_snapshot(t), network_locations(t), NETWORKS, network_names(t))


def trips(t: Source, **options):
    return trips_free_floating(t("snap"), locations(t), NETWORKS, **options)


TRIPS_SQL = f"""
WITH obs AS (
  SELECT s.vehicle_id, s.last_updated AS ts, c.location_id, nm.code AS network_id, s.battery, s.range_m, s.station_id
  FROM {{snap}} s LEFT JOIN {{cells}} c ON s.lat = c.lat AND s.lon = c.lng LEFT JOIN {NETWORKS_SQL} ON s.network_name = nm.name
), lagged AS (
  SELECT *, lag(ts) OVER w AS p_ts, lag(location_id) OVER w AS p_loc, lag(network_id) OVER w AS p_net,
         lag(battery) OVER w AS p_bat, lag(range_m) OVER w AS p_range, lag(station_id) OVER w AS p_station
  FROM obs WINDOW w AS (PARTITION BY vehicle_id ORDER BY ts)
)
SELECT DISTINCT vehicle_id, p_ts AS timestamp_lend, ts AS timestamp_return,
       {{station_lend}} AS station_id_lend, {{station_return}} AS station_id_return,
       cast(NULL AS integer) AS station_name_id_lend, cast(NULL AS integer) AS station_name_id_return,
       p_net AS network_name_lend, network_id AS network_name_return,
       cast(p_loc AS integer) AS location_id_lend, cast(location_id AS integer) AS location_id_return,
       cast(p_bat AS smallint) AS pedelec_battery_lend, cast(battery AS smallint) AS pedelec_battery_return,
       cast(p_range AS integer) AS current_range_meters_lend, cast(range_m AS integer) AS current_range_meters_return,
       false AS predicted, cast(p_ts AS date) AS trip_date
FROM lagged
WHERE p_loc IS NOT NULL AND p_loc <> location_id
  AND (p_bat IS NULL OR battery IS NULL OR p_bat <> battery)
  AND (p_range IS NULL OR range_m IS NULL OR p_range <> range_m)"""
NO_STATIONS = {"{station_lend}": "cast(NULL AS varchar)", "{station_return}": "cast(NULL AS varchar)"}
WITH_STATIONS = {"{station_lend}": "p_station", "{station_return}": "station_id"}


def fill(sql: str, parts: dict[str, str]) -> str:
    for key, text in parts.items():
        sql = sql.replace(key, text)
    return sql


ZONE_TRIPS_SQL = f"""
WITH obs AS (
  SELECT s.license_plate AS vehicle_id, s.snapshot_ts AS ts, c.location_id, nm.code AS network_id, s.battery_level AS battery, s.range_m
  FROM {{zone_snap}} s LEFT JOIN {{cells}} c ON round(s.lat, 3) = c.lat AND round(s.lng, 3) = c.lng LEFT JOIN {ZONES_SQL} ON s.zone_id = nm.name
), lagged AS (
  SELECT *, lag(ts) OVER w AS p_ts, lag(location_id) OVER w AS p_loc, lag(network_id) OVER w AS p_net,
         lag(battery) OVER w AS p_bat, lag(range_m) OVER w AS p_range
  FROM obs WINDOW w AS (PARTITION BY vehicle_id ORDER BY ts)
)
SELECT DISTINCT vehicle_id, p_ts AS timestamp_lend, ts AS timestamp_return,
       cast(NULL AS varchar) AS station_id_lend, cast(NULL AS varchar) AS station_id_return,
       cast(NULL AS integer) AS station_name_id_lend, cast(NULL AS integer) AS station_name_id_return,
       p_net AS network_name_lend, network_id AS network_name_return,
       cast(p_loc AS integer) AS location_id_lend, cast(location_id AS integer) AS location_id_return,
       cast(p_bat AS smallint) AS pedelec_battery_lend, cast(battery AS smallint) AS pedelec_battery_return,
       cast(p_range AS integer) AS current_range_meters_lend, cast(range_m AS integer) AS current_range_meters_return,
       false AS predicted, cast(p_ts AS date) AS trip_date
FROM lagged
WHERE p_loc IS NOT NULL AND p_loc <> location_id AND (p_bat IS NULL OR battery IS NULL OR p_bat <> battery)"""

NET_SNAPSHOT_SQL = """
  SELECT b.number, b.snapshot_ts, b.place_uid, p.lat, p.lng, p.name AS station_name, c.name AS network_name
  FROM {bikes} b JOIN {places} p ON b.place_uid = p.uid AND b.snapshot_ts = p.snapshot_ts
  JOIN {cities} c ON p.city_uid = c.uid AND p.snapshot_ts = c.snapshot_ts"""
NET_DICTS_SQL = """
  net_cells AS (SELECT row_number() OVER (ORDER BY lat, lng) AS location_id, lat, lng FROM (SELECT DISTINCT lat, lng FROM {places}) d),
  net_names AS (SELECT row_number() OVER (ORDER BY name) AS name_id, name FROM (SELECT DISTINCT name FROM {places}) d)"""
NET_TRIPS_SQL = f"""
WITH net AS ({NET_SNAPSHOT_SQL}),{NET_DICTS_SQL},
obs AS (
  SELECT cast(n.number AS varchar) AS vehicle_id, n.snapshot_ts AS ts, c.location_id, nm.code AS network_id,
         cast(n.place_uid AS varchar) AS station_id, s.name_id
  FROM net n LEFT JOIN net_cells c ON n.lat = c.lat AND n.lng = c.lng LEFT JOIN net_names s ON n.station_name = s.name
  LEFT JOIN {NETWORKS_SQL} ON n.network_name = nm.name
), lagged AS (
  SELECT *, lag(ts) OVER w AS p_ts, lag(location_id) OVER w AS p_loc, lag(network_id) OVER w AS p_net,
         lag(station_id) OVER w AS p_station, lag(name_id) OVER w AS p_name
  FROM obs WINDOW w AS (PARTITION BY vehicle_id ORDER BY ts)
)
SELECT DISTINCT vehicle_id, p_ts AS timestamp_lend, ts AS timestamp_return,
       p_station AS station_id_lend, station_id AS station_id_return,
       cast(p_name AS integer) AS station_name_id_lend, cast(name_id AS integer) AS station_name_id_return,
       p_net AS network_name_lend, network_id AS network_name_return,
       cast(p_loc AS integer) AS location_id_lend, cast(location_id AS integer) AS location_id_return,
       cast(NULL AS smallint) AS pedelec_battery_lend, cast(NULL AS smallint) AS pedelec_battery_return,
       cast(NULL AS integer) AS current_range_meters_lend, cast(NULL AS integer) AS current_range_meters_return,
       false AS predicted, cast(p_ts AS date) AS trip_date
FROM lagged WHERE p_loc <> location_id AND p_station <> station_id AND p_name <> name_id"""


def demand_sql(trips_sql: str) -> str:
    return f"""
WITH trips AS ({trips_sql}), ends AS (
  SELECT location_id_lend AS location_id, timestamp_lend AS timestamp, network_name_lend AS network_name,
         station_name_id_lend AS station_name_id, station_id_lend AS station_id, 1 AS n_lends, 0 AS n_returns FROM trips
  UNION ALL
  SELECT location_id_return, timestamp_return, network_name_return, station_name_id_return, station_id_return, 0, 1 FROM trips
)
SELECT location_id, timestamp, network_name, station_name_id, station_id,
       cast(sum(n_lends) AS smallint) AS n_lends, cast(sum(n_returns) AS smallint) AS n_returns,
       cast(timestamp AS date) AS demand_date
FROM ends WHERE location_id IS NOT NULL AND timestamp IS NOT NULL
GROUP BY location_id, timestamp, network_name, station_name_id, station_id"""


FULL_OUTER_SQL = f"""
WITH trips AS ({fill(TRIPS_SQL, NO_STATIONS)}),
l AS (SELECT location_id_lend AS location_id, timestamp_lend AS timestamp, network_name_lend AS network_name, station_name_id_lend AS station_name_id,
             station_id_lend AS station_id, cast(timestamp_lend AS date) AS demand_date, count(*) AS n FROM trips GROUP BY 1, 2, 3, 4, 5, 6),
r AS (SELECT location_id_return AS location_id, timestamp_return AS timestamp, network_name_return AS network_name, station_name_id_return AS station_name_id,
             station_id_return AS station_id, cast(timestamp_return AS date) AS demand_date, count(*) AS n FROM trips GROUP BY 1, 2, 3, 4, 5, 6)
SELECT coalesce(l.location_id, r.location_id) AS location_id, coalesce(l.timestamp, r.timestamp) AS timestamp,
       coalesce(l.network_name, r.network_name) AS network_name, coalesce(l.station_name_id, r.station_name_id) AS station_name_id,
       coalesce(l.station_id, r.station_id) AS station_id, cast(coalesce(l.n, 0) AS smallint) AS n_lends,
       cast(coalesce(r.n, 0) AS smallint) AS n_returns, coalesce(l.demand_date, r.demand_date) AS demand_date
FROM l FULL OUTER JOIN r ON l.location_id = r.location_id AND l.timestamp = r.timestamp AND l.network_name = r.network_name
  AND l.station_name_id = r.station_name_id AND l.station_id = r.station_id AND l.demand_date = r.demand_date"""
FULL_OUTER_NET_SQL = FULL_OUTER_SQL.replace(fill(TRIPS_SQL, NO_STATIONS), NET_TRIPS_SQL)

FIRST_LAST_SQL = """
SELECT f.vehicle_id, f.last_updated AS first_ts, f.network_name AS first_network, f.battery AS first_battery, f.range_m AS first_range,
       l.last_updated AS last_ts, l.network_name AS last_network, l.battery AS last_battery, l.range_m AS last_range
FROM (SELECT DISTINCT ON (vehicle_id) * FROM {sightings} ORDER BY vehicle_id, last_updated, battery, range_m, network_name) f
JOIN (SELECT DISTINCT ON (vehicle_id) * FROM {sightings} ORDER BY vehicle_id, last_updated DESC, battery DESC, range_m DESC, network_name DESC) l
  ON f.vehicle_id = l.vehicle_id"""

ROTATING_SQL = f"""
WITH f AS (SELECT DISTINCT ON (vehicle_id) * FROM {{sightings}} ORDER BY vehicle_id, last_updated, lat, lon),
l AS (SELECT DISTINCT ON (vehicle_id) * FROM {{sightings}} ORDER BY vehicle_id, last_updated DESC, lat DESC, lon DESC),
ends AS (
  SELECT lat, lon, last_updated, network_name, 0 AS lends, 1 AS returns FROM f WHERE last_updated > (SELECT min(last_updated) FROM {{sightings}})
  UNION ALL
  SELECT lat, lon, last_updated, network_name, 1, 0 FROM l WHERE last_updated < (SELECT max(last_updated) FROM {{sightings}})
)
SELECT cast(c.location_id AS integer) AS location_id, e.last_updated AS timestamp, nm.code AS network_name,
       cast(NULL AS integer) AS station_name_id, cast(NULL AS varchar) AS station_id,
       cast(sum(lends) AS smallint) AS n_lends, cast(sum(returns) AS smallint) AS n_returns,
       cast(e.last_updated AS date) AS demand_date
FROM ends e LEFT JOIN {{cells}} c ON e.lat = c.lat AND e.lon = c.lng LEFT JOIN {NETWORKS_SQL} ON e.network_name = nm.name
GROUP BY c.location_id, e.last_updated, nm.code"""


def availability_sql(station: str) -> str:
    group = ", s.station_id" if station == "s.station_id" else ""
    return f"""
SELECT cast(c.location_id AS integer) AS location_id, s.last_updated AS timestamp, nm.code AS network_name,
       cast(NULL AS integer) AS station_name_id, {station} AS station_id,
       cast(count(DISTINCT s.vehicle_id) AS smallint) AS n_vehicles, cast(s.last_updated AS date) AS availability_date
FROM {{snap}} s LEFT JOIN {{cells}} c ON s.lat = c.lat AND s.lon = c.lng LEFT JOIN {NETWORKS_SQL} ON s.network_name = nm.name
GROUP BY c.location_id, s.last_updated, nm.code{group}"""


def hierarchy(t: Source, which: int):
    return restrict_hierarchy(t("bikes"), t("places"), t("cities"), t("countries"), ["network_a"])[which]


def flat_sightings(t: Source):
    ends = first_last_sighting(t("sightings"), "last_updated", ["battery", "range_m", "network_name"])
    return ends.select("vehicle_id", *(
        F.col(f"{end}.{c}").alias(f"{end}_{short}")
        for end in ("first", "last")
        for c, short in (("last_updated", "ts"), ("network_name", "network"), ("battery", "battery"), ("range_m", "range"))))


QUERIES = [
    Query("w1_trips_free_floating", trips, fill(TRIPS_SQL, NO_STATIONS)),
    Query(
        "w1_trips_free_floating_stations",
        lambda t: trips(t, stations=True),
        fill(TRIPS_SQL, WITH_STATIONS) + "\n  AND p_station <> station_id",
    ),
    Query("w2_trips_zone", zone_trips, ZONE_TRIPS_SQL),
    Query("w3_trips_station_network", network_trips, NET_TRIPS_SQL),
    Query("w4_first_last_sighting", flat_sightings, FIRST_LAST_SQL),
    Query(
        "w5_keep_first",
        lambda t: keep_first(t("feed_a"), ["last_updated", "vehicle_id"], asc("event_id")),
        "SELECT DISTINCT ON (last_updated, vehicle_id) * FROM {feed_a} ORDER BY last_updated, vehicle_id, event_id",
    ),
    Query(
        "w6_row_numbers",
        lambda t: assign_ids(t("sightings"), ["vehicle_id"], "row_id", id_type="bigint"),
        "SELECT row_number() OVER (ORDER BY vehicle_id) AS row_id, vehicle_id FROM (SELECT DISTINCT vehicle_id FROM {sightings}) d",
    ),
    Query("j5_station_network_snapshot", network_snapshot, NET_SNAPSHOT_SQL),
    Query(
        "j6_restrict_hierarchy_bikes", lambda t: hierarchy(t, 0),
        """SELECT b.* FROM {bikes} b WHERE EXISTS (SELECT 1 FROM {places} p JOIN {cities} c ON p.city_uid = c.uid AND p.snapshot_ts = c.snapshot_ts
           WHERE p.uid = b.place_uid AND p.snapshot_ts = b.snapshot_ts AND c.parent_country_name = 'network_a')""",
    ),
    Query(
        "j6_restrict_hierarchy_places", lambda t: hierarchy(t, 1),
        """SELECT p.* FROM {places} p WHERE EXISTS (SELECT 1 FROM {cities} c WHERE p.city_uid = c.uid AND p.snapshot_ts = c.snapshot_ts
           AND c.parent_country_name = 'network_a')""",
    ),
    Query(
        "j6_restrict_hierarchy_cities", lambda t: hierarchy(t, 2), "SELECT * FROM {cities} WHERE parent_country_name = 'network_a'"),
    Query("j6_restrict_hierarchy_countries", lambda t: hierarchy(t, 3), "SELECT * FROM {countries} WHERE name = 'network_a'"),
    Query("a1_demand_from_trips", lambda t: demand_from_trips(trips(t)), demand_sql(fill(TRIPS_SQL, NO_STATIONS))),
    Query("a2_demand_zone", lambda t: demand_zone(zone_trips(t)), demand_sql(ZONE_TRIPS_SQL)),
    Query("a3_demand_station_network", lambda t: demand_station_network(network_trips(t)), demand_sql(NET_TRIPS_SQL)),
    Query("j8_demand_full_outer", lambda t: demand_full_outer(network_trips(t)), FULL_OUTER_NET_SQL),
    Query("j8_demand_full_outer_null_keys", lambda t: demand_full_outer(trips(t)), FULL_OUTER_SQL),
    Query("a4_demand_rotating", lambda t: demand_rotating(t("sightings"), locations(t), NETWORKS), ROTATING_SQL),
    Query(
        "a5_trim_edge_timestamps",
        lambda t: trim_edge_timestamps(availability(t("snap"), locations(t), NETWORKS)),
        f"""WITH a AS ({availability_sql("cast(NULL AS varchar)")})
            SELECT * FROM a WHERE timestamp <> (SELECT min(timestamp) FROM a) AND timestamp <> (SELECT max(timestamp) FROM a)""",
    ),
    Query("a6_availability", lambda t: availability(t("snap"), locations(t), NETWORKS), availability_sql("cast(NULL AS varchar)")),
    Query(
        "a6_availability_stations",
        lambda t: availability(t("snap"), locations(t), NETWORKS, stations=True), availability_sql("s.station_id")),
    Query(
        "a7_availability_zone", lambda t: availability_zone(t("zone_snap"), locations(t), ZONES),
        f"""SELECT cast(c.location_id AS integer) AS location_id, s.snapshot_ts AS timestamp, nm.code AS network_name,
                   cast(NULL AS integer) AS station_name_id, cast(NULL AS varchar) AS station_id,
                   cast(count(*) AS smallint) AS n_vehicles, cast(s.snapshot_ts AS date) AS availability_date
            FROM {{zone_snap}} s JOIN {{cells}} c ON round(s.lat, 3) = c.lat AND round(s.lng, 3) = c.lng
            LEFT JOIN {ZONES_SQL} ON s.zone_id = nm.name GROUP BY c.location_id, s.snapshot_ts, s.zone_id, nm.code""",
    ),
    Query(
        "a8_availability_station_network",
        lambda t: availability_station_network(network_snapshot(t), network_locations(t), NETWORKS, network_names(t)),
        f"""WITH net AS ({NET_SNAPSHOT_SQL}),{NET_DICTS_SQL}
            SELECT cast(c.location_id AS integer) AS location_id, n.snapshot_ts AS timestamp, nm.code AS network_name,
                   cast(s.name_id AS integer) AS station_name_id, cast(n.place_uid AS varchar) AS station_id,
                   cast(count(*) AS smallint) AS n_vehicles, cast(n.snapshot_ts AS date) AS availability_date
            FROM net n LEFT JOIN net_cells c ON n.lat = c.lat AND n.lng = c.lng LEFT JOIN net_names s ON n.station_name = s.name
            LEFT JOIN {NETWORKS_SQL} ON n.network_name = nm.name
            GROUP BY c.location_id, n.snapshot_ts, nm.code, s.name_id, n.place_uid""",
    ),
    Query(
        "a12_row_counts", lambda t: row_counts(t("snap"), ["station_id"]),
        'SELECT count(*) AS "rows", count(*) FILTER (WHERE station_id IS NULL) AS null_station_id FROM {snap}',
    ),
]
