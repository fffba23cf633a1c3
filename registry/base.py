"""Query records, table loading and the adapters that give the tables domain shape.

An adapter is portable SQL: Spark runs it on DataFrames, the checking SQL uses it as a CTE.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[["Source"], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    naive = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in naive}) if naive else df


class Source:
    """The tables of one scale folder and the adapters over them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._seen: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._seen:
            if name in TABLES:
                self._seen[name] = table(self.spark, self.sf_dir, name)
            else:
                text = ADAPTERS[name]
                inputs = {n: self(n) for n in sorted(set(re.findall(r"\{(\w+)\}", text)))}
                self._seen[name] = self.spark.sql(text, **inputs)
        return self._seen[name]


def with_adapters(sql: str) -> str:
    """Replace ``{name}`` by the table or adapter name and prepend the adapters as CTEs."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for n in dict.fromkeys(re.findall(r"\{(\w+)\}", text)):
            if n in ADAPTERS and n not in needed:
                visit(ADAPTERS[n])
                needed.append(n)

    visit(sql)
    plain = lambda text: re.sub(r"\{(\w+)\}", r"\1", text)
    ctes = [f"{n} AS ({plain(ADAPTERS[n])})" for n in needed]
    body = plain(sql).strip()
    if body.upper().startswith("WITH "):
        ctes.append(body[5:])
        return "WITH " + ",\n".join(ctes)
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body


ADAPTERS = {
    # free-floating snapshots, one row per vehicle and hour
    "snap": """
SELECT concat('v', cast(user_id AS string)) AS vehicle_id,
       date_trunc('hour', ts) AS last_updated,
       CASE user_id % 3 WHEN 0 THEN 'Mannheim' WHEN 1 THEN 'Heidelberg' ELSE 'Stuttgart' END AS network_name,
       round(cast(49400 + max(k % 25) AS double) / cast(1000 AS double), 3) AS lat,
       round(cast(8400 + max(cast(floor(k / 25) AS int)) AS double) / cast(1000 AS double), 3) AS lon,
       max(cast(floor(value) AS int) % 101) AS battery,
       max(cast(floor(value * 100) AS int) % 40000) AS range_m,
       CASE WHEN max(k) % 10 < 7 THEN concat('S', cast(max(k) % 40 AS string)) END AS station_id
FROM (SELECT *, cast(regexp_extract(props, '([0-9]+)', 1) AS int) AS k FROM {events}) e
GROUP BY user_id, date_trunc('hour', ts)""",
    # ids that are replaced after a few sightings
    "sightings": """
SELECT concat('r', cast(cast(floor(event_id / 4) AS bigint) AS string)) AS vehicle_id,
       ts AS last_updated,
       CASE WHEN cast(floor(event_id / 4) AS bigint) % 2 = 0 THEN 'Mannheim' ELSE 'Heidelberg' END AS network_name,
       round(cast(49400 + k % 25 AS double) / cast(1000 AS double), 3) AS lat,
       round(cast(8400 + cast(floor(k / 25) AS int) AS double) / cast(1000 AS double), 3) AS lon,
       cast(floor(value) AS int) % 101 AS battery,
       cast(floor(value * 100) AS int) % 40000 AS range_m
FROM (SELECT *, cast(regexp_extract(props, '([0-9]+)', 1) AS int) AS k FROM {events}) e""",
    "zone_snap": """
SELECT concat('P', cast(user_id AS string)) AS license_plate, ts AS snapshot_ts,
       cast(49400 + k % 25 AS double) / cast(1000 AS double) + cast(event_id % 9 AS double) / cast(100000 AS double) AS lat,
       cast(8400 + cast(floor(k / 25) AS int) AS double) / cast(1000 AS double) AS lng,
       CASE WHEN user_id % 4 = 0 THEN 'HEIDELBERG' ELSE 'MANNHEIM-LUDWIGSHAFEN' END AS zone_id,
       cast(floor(value) AS int) % 101 AS battery_level,
       cast(floor(value * 100) AS int) % 40000 AS range_m
FROM (SELECT *, cast(regexp_extract(props, '([0-9]+)', 1) AS int) AS k FROM {events}) e""",
    "bikes": """
SELECT user_id AS number, date_trunc('hour', ts) AS snapshot_ts,
       max(cast(regexp_extract(props, '([0-9]+)', 1) AS int)) % 40 AS place_uid
FROM {events} GROUP BY user_id, date_trunc('hour', ts)""",
    "places": """
SELECT DISTINCT place_uid AS uid, snapshot_ts, place_uid % 4 AS city_uid,
       round(cast(49400 + place_uid AS double) / cast(1000 AS double), 3) AS lat,
       round(cast(8400 + place_uid % 7 AS double) / cast(1000 AS double), 3) AS lng,
       concat('Station ', cast(place_uid AS string)) AS name
FROM {bikes}""",
    # city ids run 0..2 while places point at 0..3: one city is unknown
    "cities": """
SELECT DISTINCT place_uid % 3 AS uid, snapshot_ts,
       CASE place_uid % 3 WHEN 0 THEN 'Mannheim' WHEN 1 THEN 'Heidelberg' ELSE 'Stuttgart' END AS name,
       CASE place_uid % 3 WHEN 2 THEN 'network_b' ELSE 'network_a' END AS parent_country_name
FROM {bikes}""",
    "countries": """
SELECT DISTINCT parent_country_name AS name, snapshot_ts FROM {cities}""",
    # two feeds of one fleet: same vehicles, instants partly the same
    "feed_a": """
SELECT concat('v', cast(user_id % 20 AS string)) AS vehicle_id, date_trunc('minute', ts) AS last_updated,
       value, 'A' AS src, event_id
FROM {events}""",
    "feed_b": """
SELECT concat('v', cast(user_id % 20 AS string)) AS vehicle_id,
       date_trunc('minute', ts + CASE WHEN event_id % 2 = 0 THEN interval '2' minute ELSE interval '0' minute END) AS last_updated,
       value, 'B' AS src, event_id
FROM {events}""",
    "stop_times": """
SELECT l_orderkey AS trip_id, l_partkey AS stop_id,
       CASE WHEN (l_orderkey + l_linenumber) % 50 = 0 THEN '7:5'
            ELSE concat(lpad(cast((l_orderkey * 7 + l_linenumber) % 27 AS string), 2, '0'), ':',
                        lpad(cast(l_partkey % 60 AS string), 2, '0'), ':00') END AS arrival_time,
       concat(lpad(cast((l_orderkey * 7 + l_linenumber) % 27 AS string), 2, '0'), ':',
              lpad(cast(l_partkey % 60 AS string), 2, '0'), ':30') AS departure_time
FROM {lineitem}""",
    "gtfs_trips": """
SELECT o_orderkey AS trip_id, o_custkey % 50 AS route_id, o_custkey % 20 AS service_id FROM {orders}""",
    "routes": """
SELECT r AS route_id, CASE WHEN r = 7 THEN NULL ELSE concat('Line ', cast(r AS string)) END AS route_long_name,
       concat('L', cast(r AS string)) AS route_short_name, cast(r % 4 AS int) AS route_type
FROM (SELECT DISTINCT o_custkey % 50 AS r FROM {orders}) o""",
    "calendar": """
SELECT s AS service_id,
       CASE WHEN s % 2 = 0 THEN 1 ELSE 0 END AS monday, 1 AS tuesday, CASE WHEN s % 3 = 0 THEN 1 ELSE 0 END AS wednesday,
       0 AS thursday, CASE WHEN s % 5 < 3 THEN 1 ELSE 0 END AS friday, CASE WHEN s % 7 = 0 THEN 1 ELSE 0 END AS saturday, 0 AS sunday,
       date '2024-01-01' AS start_date, date '2024-01-14' AS end_date
FROM (SELECT DISTINCT o_custkey % 20 AS s FROM {orders}) o""",
    # stop coordinates as text; a few cannot be read or lie outside the globe
    "stops": """
SELECT l_partkey AS stop_id, concat('Stop ', cast(l_partkey AS string)) AS stop_name,
       CASE WHEN l_partkey % 97 = 13 THEN 'n/a' WHEN l_partkey % 97 = 14 THEN ' ' WHEN l_partkey % 97 = 15 THEN '149.4'
            ELSE cast(49.4 + cast(l_partkey % 1000 AS double) / cast(1000 AS double) AS string) END AS stop_lat,
       cast(8.4 + cast(l_partkey % 11 AS double) / cast(1000 AS double) AS string) AS stop_lon
FROM (SELECT DISTINCT l_partkey FROM {lineitem}) l""",
    "weather_long": """
SELECT user_id % 20 AS station_id, date_trunc('hour', ts) AS obs_ts, event_id AS seq,
       CASE event_type WHEN 'view' THEN 'wind_speed' WHEN 'click' THEN 'temperature' WHEN 'error' THEN 'humidity'
                       WHEN 'signup' THEN 'precipitation' ELSE 'wind_direction' END AS measure,
       CASE WHEN event_id % 17 = 0 THEN '-999' WHEN event_id % 19 = 0 THEN ' '
            ELSE cast(cast(floor(value) AS int) AS string) END AS raw_value
FROM {events}""",
    "counters": """
SELECT user_id % 10 AS counter_id, date_trunc('hour', ts) AS obs_ts, event_id AS pos,
       CASE event_type WHEN 'view' THEN 'IN' WHEN 'click' THEN 'OUT' ELSE 'BOTH' END AS direction,
       cast(floor(value) AS int) AS counts
FROM {events}""",
    "points": """
SELECT s_suppkey AS point_id,
       round(cast(47 + s_suppkey % 8 AS double) + cast(s_suppkey % 13 AS double) / cast(20 AS double), 3) AS lat,
       round(cast(7 + s_suppkey % 6 AS double) + cast(s_suppkey % 17 AS double) / cast(20 AS double), 3) AS lng
FROM {supplier}""",
    "sites": """
SELECT c_custkey AS station_id, c_name AS station_name,
       cast(47 + c_custkey % 9 AS double) + cast(c_custkey % 29 AS double) / cast(30 AS double) AS lat,
       cast(6 + c_custkey % 8 AS double) + cast(c_custkey % 31 AS double) / cast(32 AS double) AS lng,
       CASE WHEN c_custkey % 5 = 0 THEN date '2024-06-01' ELSE date '2000-01-01' END AS valid_from, date '2030-01-01' AS valid_to
FROM {customer}""",
    # every coordinate that occurs: dense vehicle cells and spread lookup points
    "spots": """
SELECT DISTINCT lat, lng FROM (
  SELECT lat, lon AS lng FROM {snap} UNION ALL SELECT lat, lng FROM {points}) u""",
    # polygon layer: small diamonds around vehicle cells, wide triangles per nation
    "areas": """
SELECT cast(s_suppkey AS int) AS layer_order, s_name AS name,
       round(8.4003E0 + cast(s_suppkey % 4 AS double) / 1000E0, 4) AS cx,
       round(49.4003E0 + cast(s_suppkey % 25 AS double) / 1000E0, 4) AS cy,
       round(0.0007E0 + cast(s_suppkey % 5 AS double) * 0.0003E0, 4) AS r,
       4 AS corners
FROM {supplier}
UNION ALL
SELECT cast(1000000 + n_nationkey AS int), n_name,
       5.03E0 + cast(n_nationkey % 7 AS double) * 1.5E0, 46.02E0 + cast(n_nationkey % 5 AS double) * 2E0,
       0.9E0 + cast(n_nationkey % 3 AS double) * 1.3E0, 3
FROM {nation}""",
    "edges": """
SELECT layer_order, name, cx - r AS x1, cy AS y1, CASE corners WHEN 4 THEN cx ELSE cx + r END AS x2,
       CASE corners WHEN 4 THEN cy - r ELSE cy - r / 2E0 END AS y2 FROM {areas}
UNION ALL
SELECT layer_order, name, CASE corners WHEN 4 THEN cx ELSE cx + r END, CASE corners WHEN 4 THEN cy - r ELSE cy - r / 2E0 END,
       CASE corners WHEN 4 THEN cx + r ELSE cx END, CASE corners WHEN 4 THEN cy ELSE cy + r END FROM {areas}
UNION ALL
SELECT layer_order, name, CASE corners WHEN 4 THEN cx + r ELSE cx END, CASE corners WHEN 4 THEN cy ELSE cy + r END,
       CASE corners WHEN 4 THEN cx ELSE cx - r END, CASE corners WHEN 4 THEN cy + r ELSE cy END FROM {areas}
UNION ALL
SELECT layer_order, name, cx, cy + r, cx - r, cy FROM {areas} WHERE corners = 4""",
    # report times per operator and day: one operator sends only the zero time but in rows with old updates, one sends old stamps
    "reports": """
SELECT event_type AS operator, cast(ts AS date) AS day, concat('v', cast(user_id AS string)) AS vehicle_id,
       CASE WHEN event_type = 'signup' AND event_id % 23 = 0 OR event_type = 'error' AND event_id % 29 = 0 THEN timestamp '2021-01-01 00:00:00' ELSE date_trunc('minute', ts) END AS last_updated,
       CASE WHEN event_type = 'error' AND event_id % 29 <> 0 THEN timestamp '1754-08-30 22:43:41.128654'
            WHEN event_type = 'click' AND event_id % 11 = 0 THEN timestamp '2022-06-01 00:00:00'
            WHEN event_type IN ('view', 'click') AND event_id % 13 = 0 THEN NULL ELSE ts END AS last_reported,
       event_id
FROM {events}""",
    "uris": """
SELECT event_id,
       concat(CASE event_id % 6 WHEN 0 THEN 'DOC:Vehicle:' WHEN 1 THEN 'DOD:Vehicle:' WHEN 2 THEN 'DOG:Vehicle:' WHEN 3 THEN 'DOJ:Vehicle:'
                   WHEN 4 THEN 'LMG:Vehicle:' ELSE '' END, cast(user_id AS string)) AS vehicle_id,
       CASE event_id % 4 WHEN 0 THEN concat('https://link.example/closest?t=b2&deep=app%3A%2F%2Fscooter%2Fn', cast(user_id AS string), '&campaign=x')
            WHEN 1 THEN concat('https://www.callabike.de/bike?number=', cast(user_id AS string))
            WHEN 2 THEN concat('https://www.regioradstuttgart.de/bike?number=', cast(user_id AS string)) END AS rental_uri_ios,
       CASE WHEN event_id % 3 = 0 THEN concat('https://zeus.city/api/v1/applinks?vehicle=', cast(user_id AS string)) ELSE 'none' END AS rental_uri_web
FROM {events}""",
    "cells": """
SELECT row_number() OVER (ORDER BY lat, lng) AS location_id, lat, lng FROM (SELECT DISTINCT lat, lon AS lng FROM {snap}) d""",
}

NETWORKS = {"Mannheim": 1, "Heidelberg": 2, "Stuttgart": 3}
NETWORKS_SQL = "(VALUES ('Mannheim', 1), ('Heidelberg', 2), ('Stuttgart', 3)) AS nm(name, code)"
ZONES = {"MANNHEIM-LUDWIGSHAFEN": 11, "HEIDELBERG": 12}
ZONES_SQL = "(VALUES ('MANNHEIM-LUDWIGSHAFEN', 11), ('HEIDELBERG', 12)) AS nm(name, code)"
