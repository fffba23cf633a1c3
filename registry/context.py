"""Rotating fleets, timetables, weather and calendars."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetspark.functions.subdivisions import CANTONS, REGION_CODES, WHOLE_CODES, normalize_subdivision
from fleetspark.operators import context, merge, rotating, transit, weather
from fleetspark.operators.clean import WEATHER_MEASURES, sentinel_to_null, valid_stops
from fleetspark.operators.keys import asc
from fleetspark.operators.lookup import with_location_id
from fleetspark.plans.rotating import rotating_trips
from fleetspark.session import stored
from registry.base import NETWORKS, NETWORKS_SQL, Query, Source
from registry.facts import locations, trips

# --------------------------------------------------------------------------------- rotating fleets

FIRST = "SELECT DISTINCT ON (vehicle_id) * FROM {sightings} ORDER BY vehicle_id, last_updated, battery, range_m, lat, lon"
LAST = "SELECT DISTINCT ON (vehicle_id) * FROM {sightings} ORDER BY vehicle_id, last_updated DESC, battery DESC, range_m DESC, lat DESC, lon DESC"


def pairs_sql(lend: str, back: str) -> str:
    return f"""
WITH lend AS (SELECT *, cast(floor(epoch(last_updated)) AS bigint) AS t FROM ({lend}) x),
back AS (SELECT *, cast(floor(epoch(last_updated)) AS bigint) AS t FROM ({back}) x)
SELECT a.network_name, a.vehicle_id AS vehicle_id_lend, b.vehicle_id AS vehicle_id_return, a.t AS timestamp_lend, b.t AS timestamp_return,
       a.battery AS battery_lend, b.battery AS battery_return, a.range_m AS range_lend, b.range_m AS range_return,
       a.lat AS lat_lend, a.lon AS lng_lend, b.lat AS lat_return, b.lon AS lng_return,
       cast(make_timestamp(a.t * 1000000) AS date) AS trip_date, b.t - a.t AS time_diff, a.battery - b.battery AS battery_diff, a.range_m - b.range_m AS range_diff
FROM lend a, back b
WHERE a.network_name = b.network_name AND b.t - a.t > 0 AND b.t - a.t <= 1800 AND a.battery - b.battery BETWEEN 0 AND 10"""


CANDIDATES_SQL = f"""
WITH p AS ({pairs_sql(FIRST, LAST)}),
d AS (SELECT *, cast(floor(2 * 6371.0 * asin(least(1, sqrt(pow(sin(radians(lat_return - lat_lend) / 2), 2)
   + cos(radians(lat_lend)) * cos(radians(lat_return)) * pow(sin(radians(lng_return - lng_lend) / 2), 2)))) * 1000) AS integer) AS distance FROM p),
m AS (SELECT *, round(distance / 1000 / (time_diff / 3600), 2) AS speed, round(range_diff / 1000 / (time_diff / 3600), 2) AS speed_range_based FROM d WHERE distance <= 3000),
k AS (SELECT *, time_diff <= 6 AND range_diff = 0 AND battery_diff <= 1 AND distance < 1000 AS sure FROM m WHERE speed <= 20),
n AS (SELECT *, bool_or(sure) OVER (PARTITION BY vehicle_id_lend) AS any_sure,
        row_number() OVER (PARTITION BY vehicle_id_lend, sure ORDER BY timestamp_return, vehicle_id_return) AS nth FROM k)
SELECT * EXCLUDE (sure, any_sure, nth) FROM n WHERE NOT any_sure OR (sure AND nth = 1)"""


def candidates(t: Source):
    return rotating.trip_candidates(rotating.rotating_pairs(t("sightings"), sure="sphere"))


def model(t: Source):
    return rotating.DestinationModel.fit(rotating.trip_features(trips(t), locations(t)))


# A small model as fitted on sf0.01 (two rounds of depth two), stated so that SQL can judge with the same trees.
STATED_MODEL = """
{"means": [40113.783373127786, 0.022357282396353557, 19.326568265682596, 942.1277403950511, 0.2249305404818753, 0.01996201432602564, 1.0, 1.0],
 "scales": [2.6035673293214798e-05, 0.026464124400591236, 0.0001430401193912809, 0.0015697515277360073, 2.8679620218159356, 0.40246337291191314, 0.0, 0.0],
 "lat": [[1.0, [4, -0.2839813493554052, [7, -0.05029263377151909, 49.41264075767475, 49.411226415094305], [5, 0.8074366403398907, 49.41227522741698, 49.41163532979535]]],
         [0.1, [0, 49.423500000000004, [5, 0.2894186361870083, -0.0007086677366143293, 0.0011842056822886947], [5, 0.2894186361870083, 0.014285924064629286, -0.01071055954203743]]]],
 "lng": [[1.0, [3, -1.0459245797259502, [4, 0.7112918013691272, 8.401601899196509, 8.401920634920634], [2, -0.8100682988186138, 8.401594574780033, 8.401512776565909]]],
         [0.1, [2, 0.4084012113038388, [4, 0.41376835303526305, -6.427123874329328e-05, 4.358606165205907e-05], [6, -0.37263585557603635, 7.235519099924155e-05, 0.0005059461208529535]]]]}"""


def stated_model():
    return rotating.DestinationModel.load(STATED_MODEL)


def destination_sql(fitted: rotating.DestinationModel) -> str:
    """The candidate nearest to the place that the model's trees give, per rental."""
    columns = lambda texts: ", ".join(f"{text} AS {name}" for name, text in texts.items())
    return f"""
WITH c AS ({CANDIDATES_SQL}), x AS (SELECT *, {columns(fitted.features)} FROM c),
y AS (SELECT * EXCLUDE ({', '.join(fitted.features)}), {columns(fitted.predictions)} FROM x),
z AS (SELECT *, round(2 * 6371.0 * asin(least(1, sqrt(pow(sin(radians(lat_return - _plat) / 2), 2)
   + cos(radians(_plat)) * cos(radians(lat_return)) * pow(sin(radians(lng_return - _plng) / 2), 2)))), 6) AS miss FROM y)
SELECT DISTINCT ON (trip_date, vehicle_id_lend) * EXCLUDE (miss, _plat, _plng) FROM z ORDER BY trip_date, vehicle_id_lend, miss, timestamp_return, vehicle_id_return"""


def rotating_trips_sql(fitted: rotating.DestinationModel) -> str:
    spot = lambda end: f"(SELECT cast(location_id AS integer) FROM {{cells}} c WHERE c.lat = round(d.lat_{end}, 3) AND c.lng = round(d.lng_{end}, 3))"
    code = "(SELECT cast(code AS smallint) FROM " + NETWORKS_SQL + " WHERE nm.name = d.network_name)"
    ends = ", ".join(f"""make_timestamp(timestamp_{e} * 1000000) AS timestamp_{e}, cast(NULL AS varchar) AS station_id_{e}, cast(NULL AS integer) AS station_name_id_{e},
       {code} AS network_name_{e}, {spot(e)} AS location_id_{e}, cast(battery_{e} AS smallint) AS pedelec_battery_{e}, cast(range_{e} AS integer) AS current_range_meters_{e}""" for e in ("lend", "return"))
    return f"SELECT vehicle_id_lend AS vehicle_id, {ends}, true AS predicted, trip_date FROM ({destination_sql(fitted)}) d"


# -------------------------------------------------------------------------------------- timetables


def timetable(t: Source):
    located = stored(valid_stops(t("stops")).select("stop_id"), "located")
    return transit.gtfs_join(t("stop_times"), t("gtfs_trips"), t("routes"), t("calendar"), located)


TIMETABLE_SQL = """
SELECT r.route_long_name, r.route_short_name, r.route_type, s.stop_id, s.arrival_time, s.departure_time,
       c.monday, c.tuesday, c.wednesday, c.thursday, c.friday, c.saturday, c.sunday, c.start_date, c.end_date
FROM {stop_times} s JOIN {gtfs_trips} t ON s.trip_id = t.trip_id JOIN {routes} r ON t.route_id = r.route_id JOIN {calendar} c ON t.service_id = c.service_id
WHERE s.stop_id IN (SELECT stop_id FROM {stops} WHERE try_cast(stop_lat AS double) BETWEEN -90 AND 90 AND try_cast(stop_lon AS double) BETWEEN -180 AND 180)
  AND length(s.arrival_time) >= 8 AND length(s.departure_time) >= 8 AND s.arrival_time LIKE '%:%:%' AND s.departure_time LIKE '%:%:%'"""


def clock_sql(column: str) -> str:
    part = lambda i: f"cast(split_part({column}, ':', {i}) AS bigint)"
    return f"({part(1)} * 3600 + {part(2)} * 60 + {part(3)})"


EXPANDED_SQL = f"""
WITH j AS ({TIMETABLE_SQL}), d AS (SELECT j.*, cast(unnest(generate_series(start_date, end_date, interval 1 day)) AS date) AS day FROM j)
SELECT coalesce(route_long_name, '') AS route_long_name, coalesce(route_short_name, '') AS route_short_name, coalesce(route_type, 0) AS route_type, stop_id,
       cast(day AS timestamp) + to_seconds({clock_sql('arrival_time')}) AS arrival_time, cast(day AS timestamp) + to_seconds({clock_sql('departure_time')}) AS departure_time
FROM d WHERE CASE isodow(day) WHEN 1 THEN monday WHEN 2 THEN tuesday WHEN 3 THEN wednesday WHEN 4 THEN thursday WHEN 5 THEN friday WHEN 6 THEN saturday ELSE sunday END <> 0"""

# ----------------------------------------------------------------------------------------- weather


def wide_weather(t: Source):
    long = sentinel_to_null(t("weather_long"), ["raw_value"])
    return weather.merge_weather_types(long, ["station_id", "obs_ts"], value="raw_value")


def last_known(measure: str) -> str:
    return f"arg_max(v, seq) FILTER (WHERE measure = '{measure}' AND v IS NOT NULL)"


WIDE_SQL = f"""
WITH w AS (SELECT *, try_cast(nullif(nullif(trim(raw_value), ''), '-999') AS double) AS v FROM {{weather_long}})
SELECT station_id, obs_ts, {', '.join(f"{last_known(m)} AS {m}" for m in WEATHER_MEASURES[:-1])},
       cast({last_known('wind_direction')} AS integer) AS wind_direction FROM w GROUP BY station_id, obs_ts"""


def three_tables(t: Source):
    e = t("events")

    def part(modulus: int, a, b):
        known = lambda c, m: F.when(F.col("event_id") % m == 0, c)
        return e.groupBy((F.col("user_id") % modulus).alias("station"), F.date_trunc("hour", "ts").alias("timestamp")).agg(
            F.max(known(F.col("value"), a)).alias("temperature"), F.min(known(F.col("value"), b)).alias("airHumidity"))

    return [part(9, 2, 3), part(11, 3, 2), part(13, 1, 1)]


def part_sql(modulus: int, a: int, b: int) -> str:
    return f"""SELECT user_id % {modulus} AS station, date_trunc('hour', ts) AS timestamp, max(CASE WHEN event_id % {a} = 0 THEN value END) AS temperature,
       min(CASE WHEN event_id % {b} = 0 THEN value END) AS "airHumidity" FROM {{events}} GROUP BY 1, 2"""


OUTER_SQL = f"""
WITH a AS ({part_sql(9, 2, 3)}), b AS ({part_sql(11, 3, 2)}), c AS ({part_sql(13, 1, 1)}),
ab AS (SELECT coalesce(a.station, b.station) AS station, coalesce(a.timestamp, b.timestamp) AS timestamp,
  coalesce(a.temperature, b.temperature) AS temperature, coalesce(a."airHumidity", b."airHumidity") AS "airHumidity"
  FROM a FULL OUTER JOIN b ON a.station = b.station AND a.timestamp = b.timestamp)
SELECT coalesce(ab.station, c.station) AS station, coalesce(ab.timestamp, c.timestamp) AS timestamp,
  coalesce(ab.temperature, c.temperature) AS temperature, coalesce(ab."airHumidity", c."airHumidity") AS "airHumidity"
FROM ab FULL OUTER JOIN c ON ab.station = c.station AND ab.timestamp = c.timestamp"""


def located_readings(t: Source):
    """Readings whose file name carries the three parts that identify the station."""
    e = F.col("event_id")
    file = F.concat_ws("-", (e % 40).cast("string"), (e % 7).cast("string"), F.when(e % 11 != 0, F.lit("x")))
    readings = t("events").select("event_id", F.concat(file, F.lit(".csv")).alias("file"))
    stations = t("supplier").select(
        (F.col("s_suppkey") % 30).cast("string").alias("nr"), (F.col("s_suppkey") % 7).cast("string").alias("id"), F.lit("x").alias("id_add"),
        (47 + (F.col("s_suppkey") % 30) * 0.0101).alias("lat"), (8 + (F.col("s_suppkey") % 7) * 0.0102).alias("lng"))
    parts = ["nr", "id", "id_add"]
    return weather.attach_station(weather.file_parts(readings, parts, F.col("file")), stations, parts)


def named_readings(t: Source):
    names = [*weather.NAMED_STATIONS, "S-Unknown"]
    name = F.element_at(F.array(*(F.lit(n) for n in names)), (F.col("event_id") % len(names) + 1).cast("int"))
    return weather.attach_named_station(t("events").select("event_id", name.alias("sheet")), "sheet")


# --------------------------------------------------------------------------------------- calendars

CODES = [*WHOLE_CODES, *REGION_CODES, *CANTONS, "CZ-US-UL", "IT-ER-BO", "PT-LI-OE", "CH-AG-BA-BA", "CH-XX-YY", "DE-BW", "US-CA"]
def code_at(position):
    return F.element_at(F.array(*(F.lit(c) for c in CODES)), (position % len(CODES) + 1).cast("int"))


VALUES_SQL = ", ".join(
    f"('{k}', {repr(v) if v else 'NULL'})" for k, v in {**WHOLE_CODES, **REGION_CODES, **{c: c for c in CANTONS}}.items())
LIST_SQL = "[" + ", ".join(f"'{c}'" for c in CODES) + "]"


def mapped_sql(code: str, source: str, columns: str) -> str:
    """The definition: an exact hit decides; else a region hit on the first two parts; else unchanged."""
    regions = ", ".join(f"'{c}'" for c in [*REGION_CODES, *CANTONS])
    return f"""SELECT {columns}, CASE WHEN w.k IS NOT NULL THEN w.v WHEN r.k IS NOT NULL THEN r.v ELSE {code} END AS federal_state_name
FROM {source} LEFT JOIN (VALUES {VALUES_SQL}) w(k, v) ON w.k = {code}
LEFT JOIN (SELECT * FROM (VALUES {VALUES_SQL}) x(k, v) WHERE k IN ({regions})) r
  ON r.k = concat(split_part({code}, '-', 1), '-', split_part({code}, '-', 2))"""


def holidays(t: Source):
    """A holiday per order: none, one or two subdivisions."""
    key = F.col("o_orderkey")
    codes = F.when(key % 4 == 0, F.array().cast("array<string>")).when(key % 4 == 1, F.array(code_at(key))).otherwise(
        F.array(code_at(key), code_at(key * 7 + 3)))
    return context.explode_subdivisions(t("orders").select(
        F.concat(F.lit("Holiday "), (key % 97).cast("string")).alias("name"), F.to_date("o_orderdate").alias("start_date"),
        F.lit("DE").alias("country_name"), F.date_add(F.to_date("o_orderdate"), 2).alias("end_date"), F.lit("Public").alias("type"), codes.alias("codes")))


HOLIDAYS_SQL = mapped_sql("o.code", f"""(
  SELECT concat('Holiday ', o_orderkey % 97) AS name, cast(o_orderdate AS date) AS start_date, 'DE' AS country_name,
         cast(cast(o_orderdate AS date) + 2 AS date) AS end_date, 'Public' AS type,
         unnest(CASE o_orderkey % 4 WHEN 0 THEN [NULL] WHEN 1 THEN [({LIST_SQL})[o_orderkey % {len(CODES)} + 1]]
           ELSE [({LIST_SQL})[o_orderkey % {len(CODES)} + 1], ({LIST_SQL})[(o_orderkey * 7 + 3) % {len(CODES)} + 1]] END) AS code
  FROM {{orders}}) o""", "o.name, o.start_date, o.country_name, o.end_date, o.type")


def zipped(t: Source):
    key = F.col("o_orderkey")
    values = F.transform(F.sequence(F.lit(1), (key % 4 + 1).cast("int")), lambda i: i * key)
    areas = F.transform(F.sequence(F.lit(1), (key % 3 + 1).cast("int")), lambda i: F.concat(F.lit("area "), i.cast("string")))
    return context.zip_values(t("orders").select("o_orderkey", values.alias("vals"), areas.alias("areas")), "vals", "areas", ["o_orderkey"])


QUERIES = [
    Query("j9_rotating_pairs", lambda t: rotating.rotating_pairs(t("sightings"), max_metres=None), pairs_sql(FIRST, LAST)),
    Query("j9_rotating_pairs_swapped", lambda t: rotating.rotating_pairs(t("sightings"), roles="swapped", max_metres=None), pairs_sql(LAST, FIRST)),
    Query("f1_trip_candidates", candidates, CANDIDATES_SQL),
    Query("f2_predict_destination", lambda t: rotating.rental_destinations(t("sightings"), model(t))),
    Query("f3_rotating_trips", lambda t: rotating_trips(t("sightings"), locations(t), model(t), NETWORKS)),
    Query("f2_predict_destination_stated", lambda t: rotating.rental_destinations(t("sightings"), stated_model()), destination_sql(stated_model())),
    Query("f3_rotating_trips_stated", lambda t: rotating_trips(t("sightings"), locations(t), stated_model(), NETWORKS), rotating_trips_sql(stated_model())),
    Query("j14_gtfs_join", timetable, TIMETABLE_SQL),
    Query("e1_expand_calendar", lambda t: transit.expand_calendar(timetable(t)), EXPANDED_SQL),
    Query(
        "a9_pivot_directions", lambda t: transit.pivot_directions(t("counters"), ["counter_id", "obs_ts"]),
        """SELECT counter_id, obs_ts, arg_max(counts, pos) FILTER (WHERE direction = 'IN') AS in_count, arg_max(counts, pos) FILTER (WHERE direction = 'OUT') AS out_count
           FROM {counters} WHERE direction IN ('IN', 'OUT') GROUP BY counter_id, obs_ts""",
    ),
    Query("a10_merge_weather_types", wide_weather, WIDE_SQL),
    Query(
        "j16_coalesce_outer_merge", lambda t: weather.coalesce_outer_merge(three_tables(t), ["station", "timestamp"], ["temperature", "airHumidity"]), OUTER_SQL),
    Query(
        "j17_attach_station_by_file", located_readings,
        """SELECT DISTINCT e.event_id, concat(event_id % 40, '-', event_id % 7, '-x.csv') AS file, cast(event_id % 40 AS varchar) AS nr, cast(event_id % 7 AS varchar) AS id, 'x' AS id_add,
                  round(47 + (event_id % 40) * 0.0101E0, 3) AS lat, round(8 + (event_id % 7) * 0.0102E0, 3) AS lng
           FROM {events} e JOIN {supplier} s ON s.s_suppkey % 30 = e.event_id % 40 AND s.s_suppkey % 7 = e.event_id % 7 WHERE event_id % 11 <> 0""",
    ),
    Query(
        "j17_attach_station_by_name", named_readings,
        """WITH n(i, sheet, lat, lng) AS (VALUES (0, 'S-Mitte_AfU_Halbstd.-Werte', 48.774E0, 9.186E0), (1, 'S-Bad-Cannstatt_Branddirektion_Halbstd.-Werte', 48.797E0, 9.219E0),
             (2, 'S-Mue-HKW', 48.847E0, 9.241E0), (3, 'S-Vai-Uni', 48.747E0, 9.107E0))
           SELECT e.event_id, n.sheet, n.lat, n.lng FROM {events} e JOIN n ON e.event_id % 5 = n.i""",
    ),
    Query(
        "p10_normalize_subdivision",
        lambda t: t("orders").select("o_orderkey", code_at(F.col("o_orderkey")).alias("code")).select(
            "o_orderkey", "code", normalize_subdivision(F.col("code")).alias("federal_state_name")),
        mapped_sql("o.code", f"(SELECT o_orderkey, ({LIST_SQL})[o_orderkey % {len(CODES)} + 1] AS code FROM {{orders}}) o", "o.o_orderkey, o.code"),
    ),
    Query("e2_explode_subdivisions", holidays, HOLIDAYS_SQL),
    Query(
        "m5_merge_holidays", lambda t: merge.merge_holidays(holidays(t), holidays(t)),
        f"SELECT DISTINCT * FROM ({HOLIDAYS_SQL}) h",
    ),
    Query(
        "e3_zip_values", zipped,
        """SELECT o_orderkey, i * o_orderkey AS value, concat('area ', i) AS area FROM {orders}, range(1, 5) r(i)
           WHERE i <= least(o_orderkey % 4 + 1, o_orderkey % 3 + 1)""",
    ),
    Query(
        "e4_month_range",
        lambda t: t("orders").select("o_orderkey", F.to_date("o_orderdate").alias("d")).select(
            "o_orderkey", F.explode(context.month_range(F.col("d"), F.date_add("d", 75))).alias("month")),
        """SELECT o_orderkey, cast(unnest(generate_series(date_trunc('month', o_orderdate), date_trunc('month', cast(o_orderdate AS date) + interval 75 day), interval 1 month)) AS date) AS month FROM {orders}""",
    ),
    Query(
        "o1_sort_output", lambda t: transit.expand_calendar(timetable(t), ordered=True), EXPANDED_SQL),
    Query(
        "o2_limit",
        lambda t: with_location_id(t("snap"), locations(t)).orderBy(*asc("last_updated", "vehicle_id")).limit(5).select("vehicle_id", "last_updated", "location_id"),
        """SELECT s.vehicle_id, s.last_updated, cast(c.location_id AS integer) AS location_id FROM {snap} s LEFT JOIN {cells} c ON s.lat = c.lat AND s.lon = c.lng
           ORDER BY s.last_updated, s.vehicle_id LIMIT 5""",
    ),
]
