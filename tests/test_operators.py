"""Quirks on small tables, brute-force comparisons, and plan shapes."""

import datetime as dt
import io
import math
import pathlib
import random
import re
import struct
import tarfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from fleetspark import session
from fleetspark.functions import numbers
from fleetspark.functions.clock import day_seconds
from fleetspark.functions.geo import geodesic_m, haversine_km, swap_wkt_axes, vincenty_m
from fleetspark.functions.numbers import decimals, half_even
from fleetspark.functions.wkb import polygon_wkb, wkb_rings
from fleetspark.operators import clean, merge, rotating, spatial, transit
from fleetspark.operators.demand import demand_from_trips, first_last_sighting
from fleetspark.operators.history import changes, ordered
from fleetspark.operators.keys import asc, assign_ids, keep_first
from fleetspark.operators.trips import trips_free_floating
from fleetspark.plans.rotating import rotating_trips
from fleetspark.sinks import tables, versions
from fleetspark.sources import feeds, files, snapshots, transit as transit_files, weather as weather_files
from registry import storage
from registry.base import Source

T0 = dt.datetime(2024, 1, 1)


def hours(n):
    return T0 + dt.timedelta(hours=n)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


SNAP = "vehicle_id string, last_updated timestamp, lat double, lon double, network_name string, battery int, range_m int, station_id string"


def snaps(spark, *data):
    return spark.createDataFrame([("v", hours(h), 49.4 + c / 1000, 8.4, "n", b, r, s) for h, c, b, r, s in data], SNAP)


def ids(df):
    return assign_ids(df.select("lat", F.col("lon").alias("lng")), ["lat", "lng"], "location_id")


def test_unchanged_battery_or_range_is_no_trip(spark):
    df = snaps(spark, (0, 0, 90, 10, None), (1, 1, 90, 9, None), (2, 2, 80, 9, None), (3, 3, 70, 8, None), (4, 4, None, 7, None))
    found = [r.timestamp_return for r in trips_free_floating(df, ids(df)).collect()]
    assert sorted(found) == [hours(3), hours(4)]


def test_unknown_station_is_no_station_trip(spark):
    df = snaps(spark, (0, 0, 9, 9, "a"), (1, 1, 8, 8, None), (2, 2, 7, 7, "b"), (3, 3, 6, 6, "c"))
    found = [(r.station_id_lend, r.station_id_return) for r in trips_free_floating(df, ids(df), stations=True).collect()]
    assert found == [("b", "c")]


def test_places_without_an_id_make_no_trip(spark):
    df = snaps(spark, (0, 0, 9, 9, None), (1, 1, 8, 8, None), (2, 2, 7, 7, None))
    known = ids(df).where("abs(lat - 49.401) > 1e-6")
    assert trips_free_floating(df, known).count() == 0


@pytest.mark.parametrize("partitions", [None, 1, 2, 7, 150])
def test_changes_equal_a_plain_lag_whatever_the_ranges(spark, partitions):
    rng = random.Random(partitions)
    data = [(rng.choice("ab"), T0 + dt.timedelta(minutes=rng.randrange(0, 2000)), rng.randrange(3), rng.choice([None, 1, 2])) for _ in range(400)]
    data += [("a", None, 1, 1), ("a", None, 2, None), ("b", T0, 1, None)]
    df = spark.createDataFrame(data, "e string, ts timestamp, place int, x int")
    keep = lambda p, c: p.place != c.place
    got = [(r.e, tuple(r.prev), tuple(r.cur)) for r in changes(df, "e", "ts", ["place", "x"], keep, partitions).collect()]
    late, high = dt.datetime.max, 10**9
    order = lambda r: (r[1] or late, r[2], high if r[3] is None else r[3])
    want = []
    for e in "ab":
        mine = sorted((r for r in data if r[0] == e), key=order)
        want += [(e, p[1:], c[1:]) for p, c in zip(mine, mine[1:]) if p[2] != c[2]]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert len(set(map(str, got))) == len(got)


def test_a_busy_hour_of_one_entity_is_spread(spark):
    """Nine of ten rows are of one entity within an hour: every task gets a fair share, and no row is shuffled twice."""
    df = spark.range(20_000).selectExpr(
        "IF(id % 10 = 0, concat('v', id), 'busy') AS e", "timestamp'2024-05-01' + make_interval(0, 0, 0, 0, 0, 0, id / 6) AS ts",
        "CAST(id % 7 AS int) AS place")
    counts = [r["count"] for r in ordered(df, ["e", "ts", "place"], 16).groupBy(F.spark_partition_id()).count().collect()]
    assert len(counts) == 16 and max(counts) < 2 * 20_000 / 16
    found = changes(df, "e", "ts", ["place"], lambda p, c: p.place != c.place, 16)
    assert found.count() == 17_999 - sum(1 for a, b in zip([i for i in range(20_000) if i % 10], [i for i in range(20_000) if i % 10][1:]) if a % 7 == b % 7)
    assert found._jdf.queryExecution().toString().split("== Physical Plan ==")[1].count("Exchange hashpartitioning") == 0


def test_demand_counts_every_known_end(spark):
    df = snaps(spark, (0, 0, 9, 9, None), (1, 1, 8, 8, None), (2, 0, 7, 7, None))
    trips = trips_free_floating(df, ids(df))
    total = demand_from_trips(trips).agg(F.sum("n_lends"), F.sum("n_returns")).first()
    assert tuple(total) == (2, 2)


def test_ids_are_dense_ordered_and_stable(spark):
    rng = random.Random(1)
    names = [("CAB:Station:" + str(rng.randrange(10**6)),) for _ in range(3000)] + [("hot",)] * 2000 + [(None,)]
    df = spark.createDataFrame(names, "name string")
    first = assign_ids(df, ["name"], "id")
    got = {r["name"]: r["id"] for r in first.collect()}
    distinct = sorted({n for (n,) in names if n})
    assert got == {n: i + 1 for i, n in enumerate(distinct)}
    second = assign_ids(spark.createDataFrame([("aaa",), ("hot",), ("zzz",)], "name string"), ["name"], "id", existing=first)
    again = {r["name"]: r["id"] for r in second.collect()}
    assert {k: again[k] for k in got} == got
    assert (again["aaa"], again["zzz"]) == (len(distinct) + 1, len(distinct) + 2)


def test_keep_first_reduces_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"), "id")
    kept = keep_first(df, ["k"], asc("id"))
    assert rows(kept) == [(0, 0), (1, 1)]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.rindex("WindowGroupLimit") > plan.index("Exchange")


def test_merging_a_feed_with_itself_only_removes_copies(spark):
    df = spark.createDataFrame([("v", hours(0), 1), ("v", hours(0), 2), ("w", hours(1), 3)], "vehicle_id string, last_updated timestamp, x int")
    assert rows(merge.merge_snapshots(df, df)) == rows(keep_first(df, ["last_updated", "vehicle_id"], asc("x")))
    empty = df.where("false")
    assert rows(merge.merge_snapshots(empty, df)) == rows(merge.merge_snapshots(df, empty))


def test_merging_different_columns_is_refused(spark):
    a = spark.range(1).select("id", F.lit(1).alias("x"))
    with pytest.raises(ValueError, match="x"):
        merge.align_schemas(a, spark.range(1).select("id", F.lit("1").alias("x")))


def test_zero_time_needs_all_rows(spark):
    zero = "timestamp_micros(%d)" % clean.GO_ZERO_MICROS
    base = spark.range(3).select("id", F.lit(T0).alias("last_updated"))
    every = base.withColumn("last_reported", F.expr(zero))
    assert [r.last_reported for r in clean.sanitize_reported(every).collect()] == [None] * 3
    some = base.withColumn("last_reported", F.when(F.col("id") == 0, F.expr(zero)).when(F.col("id") == 1, F.lit(T0)))
    assert [r.id for r in clean.sanitize_reported(some).collect()] == [1]


def test_rounding(spark):
    df = spark.createDataFrame([(2.5, 8.0095), (3.5, 8.4564), (-2.5, 0.1)], "a double, b double")
    assert [r[0] for r in df.select(half_even(F.col("a"), "int")).collect()] == [2, 4, -2]
    assert [r[0] for r in df.select(decimals(F.col("b"), 3)).collect()] == [8.009, 8.456, 0.1]


def test_times_beyond_midnight(spark):
    df = spark.createDataFrame([("25:10:00",), ("7:5",), ("aa:10:00",), (" 08:00:01",)], "t string")
    assert [r[0] for r in df.select(day_seconds(F.col("t"))).collect()] == [90600, None, None, 28801]


def test_calendar_rolls_into_the_next_day(spark):
    row = ("Line", None, 3, 1, "25:10:00", "25:11:00", 1, 0, 0, 0, 0, 0, 0, dt.date(2024, 1, 1), dt.date(2024, 1, 9))
    names = "route_long_name string, route_short_name string, route_type int, stop_id int, arrival_time string, departure_time string, "
    df = spark.createDataFrame([row], names + ", ".join(f"{d} int" for d in transit.WEEKDAYS) + ", start_date date, end_date date")
    assert [r.arrival_time for r in transit.expand_calendar(df).collect()] == [dt.datetime(2024, 1, 2, 1, 10), dt.datetime(2024, 1, 9, 1, 10)]
    berlin = transit.expand_calendar(df, "Europe/Berlin").collect()
    assert berlin[0].arrival_time == dt.datetime(2024, 1, 2, 0, 10)


def box(x, y, size):
    return [[{"x": x, "y": y}, {"x": x + size, "y": y}, {"x": x + size, "y": y + size}, {"x": x, "y": y + size}]]


LAYER = "layer_order int, name string, rings array<array<struct<x: double, y: double>>>"


def test_grid_lookup_equals_brute_force(spark):
    rng = random.Random(3)
    polygons = []
    for i in range(60):
        cx, cy, r = rng.uniform(-170, 160), rng.uniform(-80, 75), 10 ** rng.uniform(-2.5, 1.2)
        corners = sorted(rng.uniform(0, 6.283) for _ in range(rng.randrange(3, 9)))
        import math

        ring = [{"x": cx + r * math.cos(a), "y": cy + r * math.sin(a)} for a in corners]
        hole = [{"x": cx + r / 5 * math.cos(a), "y": cy + r / 5 * math.sin(a)} for a in corners]
        polygons.append((i, f"p{i}", [ring, hole]))
    points = [(rng.uniform(-80, 80), rng.uniform(-175, 175)) for _ in range(300)]
    for _, _, rings in polygons:
        for p in rings[0][:3]:
            points.append((p["y"] * 0.999, p["x"] * 0.999))

    def within(rings, x, y):
        odd = False
        for ring in rings:
            for p, q in zip(ring, ring[1:] + ring[:1]):
                if (p["y"] > y) != (q["y"] > y) and x < (q["x"] - p["x"]) * (y - p["y"]) / (q["y"] - p["y"]) + p["x"]:
                    odd = not odd
        return odd

    want = sorted((lat, lng, next((n for _, n, r in polygons if within(r, lng, lat)), "")) for lat, lng in points)
    df = spatial.point_in_polygon(spark.createDataFrame(points, "lat double, lng double"), spark.createDataFrame(polygons, LAYER))
    assert rows(df) == sorted(want, key=str)


def test_spatial_and_range_joins_have_no_nested_loops(spark):
    points = spark.createDataFrame([(49.4, 8.4)], "lat double, lng double")
    layer = spark.createDataFrame([(1, "a", box(8.0, 49.0, 1.0))], LAYER)
    seen = spark.createDataFrame([("r1", T0, "n", 49.4, 8.4, 50, 100)], "vehicle_id string, last_updated timestamp, network_name string, lat double, lon double, battery int, range_m int")
    sites = spark.createDataFrame([(1, 49.0, 8.0)], "site int, lat double, lng double")
    for df in (spatial.point_in_polygon(points, layer), rotating.rotating_pairs(seen, max_metres=3000), spatial.nearest(points, sites, "site")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_nearest_around_poles_date_line_and_dense_squares(spark, monkeypatch):
    monkeypatch.setattr(spatial, "CROWD", 3)
    rng = random.Random(12)
    around = lambda y, x, d: (max(-90.0, min(90.0, y + rng.uniform(-d, d))), (x + rng.uniform(-d, d) + 180) % 360 - 180)
    places = [(90.0, 0.0), (-90.0, 0.0), (0.0, 180.0), (52.0, 179.9), (49.4, 8.4)]
    sites = [(f"s{i:03d}", *around(*places[i % 5], rng.choice([0.01, 1, 20]))) for i in range(150)] + [("s900", 90.0, 10.0), ("s901", 90.0, 100.0)]
    points = [(i, *around(*places[i % 5], rng.choice([0.005, 0.5, 30, 90]))) for i in range(250)] + [(900, 90.0, 55.0), (901, -49.4, -171.6), (902, 0.0, 180.0), (903, 0.0, -180.0)]
    p = spark.createDataFrame(points, "id int, lat double, lng double")
    s = spark.createDataFrame(sites, "site string, lat double, lng double")
    km = F.round(haversine_km(F.col("lat"), F.col("lng"), F.col("b"), F.col("c")), 6)
    every = p.crossJoin(s.toDF("site", "b", "c")).withColumn("km", km).groupBy("id").agg(F.min(F.struct("km", "site")).alias("m"))
    found = spatial.nearest(p, s, "site")
    assert rows(found.select("id", "distance_km", "site")) == rows(every.select("id", "m.km", "m.site"))
    near = spatial.nearest(p, s, "site", 100.0).select("id", "distance_km", "site")
    assert rows(near) == rows(every.where("m.km <= 100").select("id", "m.km", "m.site"))


def test_nearest_equals_brute_force(spark):
    rng = random.Random(5)
    points = [(i, rng.uniform(-89, 89), rng.uniform(-180, 180)) for i in range(120)]
    sites = [(i, rng.uniform(-89, 89), rng.choice([rng.uniform(-180, 180), 179.9, -179.9])) for i in range(150)]
    p = spark.createDataFrame(points, "id int, lat double, lng double")
    s = spark.createDataFrame(sites, "site int, lat double, lng double")
    pairs = p.alias("p").crossJoin(s.alias("s")).select("p.id", "s.site", F.round(haversine_km(F.col("p.lat"), F.col("p.lng"), F.col("s.lat"), F.col("s.lng")), 6).alias("km"))
    want = pairs.groupBy("id").agg(F.min(F.struct("km", "site")).alias("b")).select("id", "b.site", "b.km")
    assert rows(spatial.nearest(p, s, "site").select("id", "site", "distance_km")) == rows(want)
    near = spatial.nearest(p, s, "site", 900.0).select("id", "site", "distance_km")
    assert rows(near) == rows(want.where("km <= 900"))


def test_split_keeps_unknown_places(spark):
    df = spark.createDataFrame([(1, 49.5, 8.5, "old"), (2, 40.0, 8.5, "old"), (3, None, 8.5, "old"), (4, 49.5, 8.5, "other")], "id int, lat double, lon double, n string")
    layer = spark.createDataFrame([(1, "a", box(8.0, 49.0, 1.0))], LAYER)
    out = spatial.split_by_polygon(df, layer, "n", "in", "out", only=F.col("n") == "old")
    assert {r.id: r.n for r in out.collect()} == {1: "in", 2: "out", 3: "old", 4: "other"}


PAIR = ("vehicle_id_lend string, vehicle_id_return string, timestamp_lend bigint, timestamp_return bigint, lat_lend double, lng_lend double, "
        "lat_return double, lng_return double, battery_diff int, range_diff int, time_diff bigint, trip_date date")


def test_sure_match_excludes_the_other_candidates(spark):
    day = dt.date(2024, 1, 1)
    pair = lambda back, seconds, drop, ranged: ("a", back, 0, seconds, 49.4, 8.4, 49.4, 8.4, drop, ranged, seconds, day)
    df = spark.createDataFrame([pair("x", 900, 2, 5), pair("z", 5, 1, 0), pair("y", 5, 0, 0), pair("w", 6, 2, 0)], PAIR)
    assert [r.vehicle_id_return for r in rotating.trip_candidates(df).collect()] == ["y"]
    fast = spark.createDataFrame([("a", "b", 0, 60, 49.4, 8.4, 49.41, 8.4, 1, 1, 60, day), ("a", "c", 0, 600, 49.4, 8.4, 49.43, 8.4, 1, 1, 600, day)], PAIR)
    assert rotating.trip_candidates(fast).count() == 0


SIGHTING = "vehicle_id string, last_updated timestamp, network_name string, lat double, lon double, battery int, range_m int"


def test_distance_limited_pairs_lose_no_candidate(spark):
    rng = random.Random(9)
    data = [(f"r{i // 2}", T0 + dt.timedelta(seconds=rng.randrange(0, 4000)), rng.choice("nm"), 49 + rng.randrange(0, 150) / 1000, 8.4, rng.randrange(0, 30), 0) for i in range(400)]
    df = spark.createDataFrame(data, SIGHTING)
    far = rotating.trip_candidates(rotating.rotating_pairs(df, max_metres=None))
    near = rotating.trip_candidates(rotating.rotating_pairs(df))
    assert far.count() > 0
    assert rows(far.select(sorted(far.columns))) == rows(near.select(sorted(near.columns)))


@pytest.mark.parametrize("metres", [300, 3000, 40000])
def test_pairs_around_poles_and_date_line(spark, metres):
    rng = random.Random(metres)
    degrees = metres / 111_195
    data = []
    for lat, lng in [(0.0, 179.999), (-45.0, -179.99), (60.0, 0.0), (89.99, 20.0), (-89.98, 120.0), (89.6, -60.0), (49.4, 8.4)]:
        for _ in range(24):
            y = max(-90.0, min(90.0, lat + rng.uniform(-2, 2) * degrees))
            across = 360 if abs(lat) > 89 else 2 * degrees / math.cos(math.radians(lat))
            x = (lng + rng.uniform(-across, across) + 180) % 360 - 180
            data.append((f"r{len(data)}", T0 + dt.timedelta(seconds=rng.randrange(0, 1700)), "n", y, x, 50, 0))
    data.append(("nowhere", T0, "n", None, 8.4, 50, 0))
    df = spark.createDataFrame(data, SIGHTING)
    ends = [F.col(c) for c in ("lat_lend", "lng_lend", "lat_return", "lng_return")]
    pick = lambda pairs: rows(pairs.where(haversine_km(*ends) * 1000 <= metres).select("vehicle_id_lend", "vehicle_id_return"))
    near, all_pairs = rotating.rotating_pairs(df, max_metres=metres), rotating.rotating_pairs(df, max_metres=None)
    assert len(pick(all_pairs)) > 100
    assert pick(near) == pick(all_pairs)
    assert near.count() < all_pairs.count() / 2


def test_candidates_read_the_ends_once(spark):
    df = spark.createDataFrame([("a", T0, "n", 49.4, 8.4, 50, 0), ("b", hours(1), "n", 49.4, 8.4, 50, 0)], SIGHTING)
    plan = rotating.trip_candidates(rotating.rotating_pairs(df))._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" in plan and "ExistingRDD" not in plan


def crowd(spark):
    """Sightings at few places, instants and ranges, so that sure matches and equal misses are many."""
    rng = random.Random(4)
    data = [(f"r{i // 2}", T0 + dt.timedelta(seconds=rng.choice([0, 2, 5, 400, 1799, 1801, 1803, 2500])), rng.choice(["n", "m", None]),
             rng.choice([49.4, 49.4001, 49.41, None]), 8.4, rng.choice([None, 10, 11, 12, 21, 22]), rng.choice([None, 5, 6])) for i in range(600)]
    return spark.createDataFrame([*data, (None, T0, "n", 49.4, 8.4, 12, 5), (None, hours(1), "n", 49.4, 8.4, 12, 5)], SIGHTING)


@pytest.mark.parametrize("roles", ["literal", "swapped"])
def test_candidates_are_judged_as_they_meet(spark, roles):
    df = crowd(spark)
    written = rotating.trip_candidates(rotating.rotating_pairs(df, roles))
    streamed = rotating.trip_candidates(rotating.rotating_pairs(df, roles, sure="sphere"))
    assert streamed.columns == written.columns and rows(streamed) == rows(written) and written.count() > 100
    assert streamed.where("time_diff <= 6 AND range_diff = 0").count() > 0
    plan = streamed._jdf.queryExecution().executedPlan().toString()
    assert "/ends-" in plan and "/candidates-" not in plan


MODEL = rotating.DestinationModel([0.0] * 8, [1.0] * 8, [(1.0, [2, 1000.0, 49.4, 49.41]), (0.1, 0.0)], [(1.0, [3, 0.5, 8.4, 8.41])])


@pytest.mark.parametrize("roles, metres", [("literal", "sphere"), ("swapped", "ellipsoid")])
def test_destinations_are_chosen_as_candidates_meet(spark, roles, metres):
    """The same rows as from written candidates; nothing sorts them, and equal misses go by time and id."""
    df = crowd(spark)
    written = rotating.predict_destination(rotating.trip_candidates(rotating.rotating_pairs(df, roles), metres), MODEL)
    chosen = rotating.rental_destinations(df, MODEL, roles, metres)
    assert chosen.columns == written.columns and rows(chosen) == rows(written) and written.count() > 50
    assert "SortAggregate" in written._jdf.queryExecution().executedPlan().toString()
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "min(_number" in plan and not any("SortAggregate" in line and "_number" in line for line in plan.splitlines())


def test_one_condition_tests_distance_and_speed(spark):
    """``_reach`` lets through what the rounded speed and the distance do, for every gap and around both limits."""
    gaps = spark.range(-3, 1900).select(F.col("id").alias("time_diff"), F.explode(F.sequence(F.lit(0), F.lit(3100))).alias("distance"))
    hours = F.nullif(F.col("time_diff"), F.lit(0)) / 3600
    speed = F.round(F.col("distance") / 1000 / hours, 2)
    near = (F.abs(F.col("distance") - 20 * F.col("time_diff") / 3.6) < 3) | F.col("distance").isin(0, 2999, 3000, 3001)
    old = F.coalesce((F.col("distance") <= 3000) & (speed <= 20), F.lit(False))
    judged = gaps.where(near).select(old.alias("old"), (F.col("distance") < rotating._reach(F.col("time_diff"))).alias("new"))
    assert {(r.old, r.new) for r in judged.distinct().collect()} == {(True, True), (False, False)}


def test_rounding_without_printing(spark):
    rng = random.Random(6)
    values = [x for k in range(-300, 300) for x in (k / 200, math.nextafter(k / 200, 9), math.nextafter(k / 200, -9))]
    values += [rng.uniform(-1, 1) * 10 ** rng.randrange(-9, 13) for _ in range(2000)]
    values += [-0.0, 8.0095, 1.005, 20.005, math.nextafter(20.005, 0), 1e300, -1e300, math.nan, None]
    df = spark.createDataFrame([(x,) for x in values], "x double").repartition(2)
    for places in (2, 6):
        both = numbers.with_rounded(df, "got", F.col("x"), places).withColumn("want", F.round("x", places))
        assert both.where("NOT (got <=> want) OR string(got) <> string(want)").collect() == []
        counted = numbers.with_units(df, "x", places, "units").where("abs(x) < 100")
        assert counted.where(F.col("units").isNotNull()).count() > 1000
        assert counted.where(F.col("units") != F.round(F.round("x", places) * 10**places)).count() == 0


def grown_model():
    """As many trees, of the same depth, as a fitted model has."""
    rng = random.Random(2)
    grow = lambda depth: rng.uniform(0, .01) if not depth else [rng.randrange(10), rng.uniform(-2, 2), grow(depth - 1), grow(depth - 1)]
    trees = [[(rng.uniform(0, 1), grow(4)) for _ in range(10)] for _ in range(2)]
    return rotating.DestinationModel([0.5] * 8, [1.5] * 8, *trees)


def judged_by_compiled_code(spark, made):
    """The generated method that meets and judges candidates stays below the size that is compiled to machine code, and no length is computed twice."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        text = made()._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    parts = [part.split("Generated code")[0].splitlines() for part in text.split("== Subtree ")]
    head, *plan = next(lines for lines in parts if len(lines) > 1 and "HashAggregate" in lines[1] and "partial_min(_number" in lines[1])
    met = plan[:next(i for i, line in enumerate(plan) if "Join" in line) + 1]
    return int(re.search(r"maxMethodCodeSize:(\d+)", head)[1]) < 8000 and sum("ASIN" in line and "_plat" not in line for line in met) == 1


def test_destinations_are_judged_by_compiled_code(spark):
    df, model = crowd(spark), grown_model()
    written = rotating.predict_destination(rotating.trip_candidates(rotating.rotating_pairs(df)), model)
    assert rows(rotating.rental_destinations(df, model)) == rows(written) and written.count() > 50
    assert judged_by_compiled_code(spark, lambda: rotating.rental_destinations(df, model))


def test_predicted_trips_are_judged_by_compiled_code(spark):
    df, model = crowd(spark), grown_model()
    places = assign_ids(df.select("lat", F.col("lon").alias("lng")), ["lat", "lng"], "location_id")
    written = rotating.predict_destination(rotating.trip_candidates(rotating.rotating_pairs(df)), model)
    made = rotating_trips(df, places, model, {"n": 1, "m": 2})
    assert rows(made) == rows(rotating.as_trips(written, places, {"n": 1, "m": 2})) and made.where("location_id_lend IS NOT NULL").count() > 50
    assert judged_by_compiled_code(spark, lambda: rotating_trips(df, places, model, {"n": 1, "m": 2}))


def test_many_trees_are_one_sum(spark):
    """Trees written out in one expression are too long a method to be compiled; their sum is that of the text."""
    rng = random.Random(2)
    grow = lambda depth: rng.uniform(0, 9) if not depth else [rng.randrange(10), rng.uniform(-2, 2), grow(depth - 1), grow(depth - 1)]
    trees = [[(rng.uniform(0, 1), grow(4)) for _ in range(10)] for _ in range(2)]
    model = rotating.DestinationModel([0.5] * 8, [1.5] * 8, *trees)
    pairs = spark.range(300).selectExpr(*(f"rand({i}) * 4 - 2 AS {c}" for i, c in enumerate(["lat_lend", "lng_lend", *rotating.FEATURES])))
    pairs = session.stored(pairs, "judged")
    text = pairs.withColumns({k: F.expr(v) for k, v in model.features.items()}).withColumns({k: F.expr(v) for k, v in model.predictions.items()})
    made = model.transform(pairs)
    assert rows(made) == rows(text.select(made.columns)) and made.distinct().count() == 300
    assert "aggregate(array(" in made._jdf.queryExecution().executedPlan().toString()


def test_few_timetable_rows_expand_in_many_tasks(spark):
    joined = spark.range(400).coalesce(1).select(
        F.lit("Line").alias("route_long_name"), F.lit("L").alias("route_short_name"), F.lit(1).alias("route_type"), F.col("id").alias("stop_id"),
        F.lit("07:00:00").alias("arrival_time"), F.lit("07:01:00").alias("departure_time"), *(F.lit(1).alias(d) for d in transit.WEEKDAYS),
        F.lit("2024-01-01").alias("start_date"), F.lit("2024-12-30").alias("end_date"))
    sizes = transit.expand_calendar(joined).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4 and sum(r["count"] for r in sizes) == 400 * 365 and max(r["count"] for r in sizes) < 400 * 365 / 2


def test_ordered_timetables_are_sorted_by_instant_and_name(spark):
    """Names alike in their first bytes, without one and beyond ASCII; instants before 1970; the same rows as without an order."""
    names = ["L1", "L10", "L100", "L1000", "L1001", "", None, "Ä", "Äb", "L", "zzzz", "zzz"]
    name = F.element_at(F.array(*(F.lit(n) for n in names)), (F.col("id") % len(names) + 1).cast("int"))
    joined = spark.range(360).select(
        F.lit("Line").alias("route_long_name"), name.alias("route_short_name"), F.lit(1).alias("route_type"), F.col("id").alias("stop_id"),
        F.format_string("%02d:00:00", F.col("id") % 27).alias("arrival_time"), F.lit("07:01:00").alias("departure_time"), *(F.lit(1).alias(d) for d in transit.WEEKDAYS),
        F.lit("1969-12-29").alias("start_date"), F.lit("1970-01-04").alias("end_date"))
    made = transit.expand_calendar(joined, "Europe/Berlin", ordered=True)
    plain = transit.expand_calendar(joined, "Europe/Berlin")
    assert made.columns == plain.columns and rows(made) == rows(plain) and made.count() == 360 * 7
    for part in made.select("arrival_time", "route_short_name", F.spark_partition_id().alias("p")).rdd.glom().collect():
        keys = [(r.arrival_time, r.route_short_name.encode()) for r in part]
        assert keys == sorted(keys)


def test_few_places_meet_many_polygons_in_several_tasks(spark):
    points = spark.createDataFrame([(0.1 * i, 0.1) for i in range(1, 10)], "lat double, lng double").coalesce(1)
    layer = spark.range(0, 300, 1, 1).selectExpr("int(id) AS layer_order", "concat('p', id) AS name", (
        "array(array(named_struct('x', 0D, 'y', 0D), named_struct('x', 1D, 'y', 0D), named_struct('x', 1D, 'y', 1D), named_struct('x', 0D, 'y', 1D))) AS rings"))
    found = spatial.containing(points, layer)
    sizes = found.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 1 and sum(r["count"] for r in sizes) == 9 * 300


def test_first_and_last_ignore_unknown_instants(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", hours(1), 2), ("a", hours(0), 3)], "vehicle_id string, last_updated timestamp, x int")
    r = first_last_sighting(df).first()
    assert (r.first.x, r.last.x) == (3, 2)


def test_ellipsoid_distance():
    import pandas as pd

    s = lambda *v: pd.Series(v, dtype=float)
    got = vincenty_m(s(0, 50.0, 49.0), s(0, 5.0, 8.0), s(0, 58.0, 49.0), s(1, 3.0, 8.0))
    # One degree of the equator, and a zero distance.
    assert abs(got[0] - 111319.491) < 0.01 and got[2] == 0
    assert abs(got[1] - 899_000) < 3_000


def test_axes_are_swapped_once(spark):
    df = spark.createDataFrame([("POINT(1.5 -2)",), ("POLYGON((1 2))",)], "w string")
    assert [r[0] for r in df.select(swap_wkt_axes(F.col("w"))).collect()] == ["POINT(-2 1.5)", "POLYGON((1 2))"]


def test_geodesic_expression(spark):
    rng = random.Random(3)
    place = lambda: (rng.uniform(-90, 90), rng.uniform(-180, 180))
    ends = [(0.0, 0.0, 0.0, 0.0), (50.0, 5.0, 58.0, 3.0), (0.0, 0.0, 0.0, 1.0), (90.0, 0.0, -89.0, 7.0), (10.0, 179.9, 10.0, -179.9)]
    ends += [(*place(), *place()) for _ in range(60)] + [(y, x, y + 0.01, x - 0.02) for y, x in (place() for _ in range(60)) if y < 89]
    df = spark.createDataFrame(ends, "a double, b double, c double, d double")
    # Halfway round and null have no result.
    out = [r[0] for r in df.select(geodesic_m(*(F.col(c) for c in "abcd"))).collect()]
    want = vincenty_m(*(pd.Series([e[i] for e in ends]) for i in range(4)))
    far = [haversine_by_hand(*e) > 19_800 for e in ends]
    assert all(o is not None and abs(o - w) < 1e-3 for o, w, f in zip(out, want, far) if not f)
    odd = spark.createDataFrame([(0.0, 0.0, 0.0, 180.0), (0.0, 0.0, 0.3, 179.7), (None, 0.0, 0.0, 0.0)], "a double, b double, c double, d double")
    assert [r[0] for r in odd.select(geodesic_m(*(F.col(c) for c in "abcd"))).collect()][1:] == [None, None]
    assert "ArrowEvalPython" not in df.select(geodesic_m(*(F.col(c) for c in "abcd")))._jdf.queryExecution().toString()


def haversine_by_hand(a, b, c, d):
    a, b, c, d = (math.radians(x) for x in (a, b, c, d))
    return 2 * 6371 * math.asin(min(1, math.sqrt(math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2)))


def test_daily_upsert(spark, tmp_path):
    path = str(tmp_path / "t")
    day = lambda n: dt.date(2024, 1, n)
    schema = "k int, x int, d date"
    load = lambda data: tables.upsert_daily(spark.createDataFrame(data, schema), path, "d", ["k"], ["k"])
    load([(1, 1, day(1)), (5, 5, day(2)), (9, 9, None)])
    table = load([(1, 2, day(1)), (2, 2, day(1)), (3, 3, day(3))])
    want = [(1, 1, day(1)), (2, 2, day(1)), (3, 3, day(3)), (5, 5, day(2))]
    assert rows(table.select("k", "x", "d")) == want
    assert rows(load([(1, 2, day(1)), (3, 4, day(3))]).select("k", "x", "d")) == want


def failing(n, at_):
    """The column ``n``; a row of the value ``at_`` ends the job."""
    return F.when(F.col(n) == at_, F.raise_error(F.lit("broken"))).otherwise(F.col(n))


def test_a_broken_load_leaves_all_days_as_they_were(spark, tmp_path):
    path = str(tmp_path / "t")
    day = lambda n: dt.date(2024, 1, n)
    df = lambda data: spark.createDataFrame(data, "k int, x int, d date")
    put = lambda frame: tables.upsert_daily(frame, path, "d", ["k"], ["k"])
    put(df([(n, 1, day(n)) for n in range(1, 9)]))
    before = rows(tables.stored_table(spark, path))
    load = versions.Load(spark, path)
    # A load that ends between two days, and one that ends while it reads.
    df([(n, 2, day(n)) for n in range(1, 5)]).write.partitionBy("d").parquet(load.target)
    with pytest.raises(Exception, match="broken"):
        put(df([(n, 2, day(n)) for n in range(1, 9)]).withColumn("x", failing("k", 8)))
    assert rows(tables.stored_table(spark, path)) == before and versions.versions(spark, path) == [1]
    assert rows(put(df([(9, 2, day(8)), (8, 2, day(8))])).where("d = date '2024-01-08'").select("k", "x")) == [(8, 1), (9, 2)]


def test_readers_hold_a_version(spark, tmp_path):
    path = str(tmp_path / "t")
    df = lambda data: spark.createDataFrame(data, "k int, x int, d date")
    one, two = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    held = tables.upsert_daily(df([(1, 1, one), (2, 1, two)]), path, "d", ["k"], ["k"])
    late = df([(3, 2, two)]).withColumn("y", F.lit("new"))
    assert rows(tables.upsert_daily(late, path, "d", ["k"], ["k"])) == [(1, 1, one, None), (2, 1, two, None), (3, 2, two, "new")]
    assert rows(held) == rows(tables.stored_table(spark, path, 1)) == [(1, 1, one), (2, 1, two)]
    with pytest.raises(ValueError, match="another type"):
        tables.upsert_daily(df([(4, 2, one)]).withColumn("x", F.lit("text")), path, "d", ["k"], ["k"])
    dropped = versions.drop_versions(spark, path)
    assert len(dropped) == 1 and dropped[0].endswith("/d=2024-01-02") and versions.versions(spark, path) == [2]
    assert tables.stored_table(spark, path).count() == 3
    with pytest.raises(ValueError, match="no version 1"):
        tables.stored_table(spark, path, 1)


def test_loads_at_the_same_time_and_empty_ones(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a")], "k int, load string")
    assert rows(tables.overwrite_table(df.limit(0), path)) == []
    first, second = versions.Load(spark, path), versions.Load(spark, path)
    for load in (first, second):
        df.write.parquet(load.target)
    first.commit(df.schema, [first.name])
    with pytest.raises(versions.Conflict):
        second.commit(df.schema, [second.name])
    assert rows(tables.stored_table(spark, path)) == [(1, "a")]
    nothing = spark.createDataFrame([], "k int, d date")
    assert rows(tables.upsert_daily(nothing, str(tmp_path / "u"), "d", ["k"], ["k"])) == []
    df.write.parquet(str(tmp_path / "plain"))
    with pytest.raises(ValueError, match="without versions"):
        tables.append_new_only(df, str(tmp_path / "plain"), "k")


def test_ids_continue_and_dedup_option(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a",), ("b",)], "name string")
    tables.append_with_ids(df, path, ["name"])
    more = spark.createDataFrame([("b",), ("c",)], "name string")
    assert rows(tables.append_with_ids(more, path, ["name"], dedup=True)) == [(1, "a"), (2, "b"), (3, "c")]


def pack(folder, file, name, data):
    with tarfile.open(folder / file, "w:gz") as archive:
        info = tarfile.TarInfo(name)
        info.size = len(data)
        archive.addfile(info, io.BytesIO(data))


def test_archives_from_files(spark, tmp_path):
    pack(tmp_path, "1.tar.gz", "a.json", b'{"x": 1}')
    pack(tmp_path, "2.tar.gz", "a.json", b'{"httpCode": 500}')
    pack(tmp_path, "3.tar.gz", "a.txt", b'{"x": 1}')
    pack(tmp_path, "4.tar.gz", "a.json", b"{")
    (tmp_path / "5.tar.gz").write_bytes(b"nothing")
    (tmp_path / "6.zip").write_bytes(b"nothing")
    found = feeds.read_feed_archives(spark, str(tmp_path)).collect()
    assert [(r.member, r.json) for r in found] == [("a.json", '{"x": 1}')]


def test_all_documents_of_an_archive(spark, tmp_path):
    with tarfile.open(tmp_path / "two.tar.gz", "w:gz") as archive:
        folder = tarfile.TarInfo("./")
        folder.type = tarfile.DIRTYPE
        archive.addfile(folder)
        for name in ("a.json", "b.json"):
            info = tarfile.TarInfo(name)
            info.size = 2
            archive.addfile(info, io.BytesIO(b"{}"))
    assert [r.member for r in feeds.read_feed_archives(spark, str(tmp_path)).orderBy("member").collect()] == ["a.json", "b.json"]
    files = spark.read.format("binaryFile").load(str(tmp_path))
    assert [r.member for r in feeds.unpack_archives(files, first_only=True).collect()] == ["a.json"]


def test_archives_of_a_single_file_of_events_are_unpacked_in_several_tasks(spark, tmp_path):
    spark.range(0, 2000, 1, 1).selectExpr("id AS event_id", "id AS user_id", "id / 7 AS value").write.parquet(str(tmp_path / "events.parquet"))
    found = storage.archives(Source(spark, str(tmp_path)))
    sizes = found.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4 and sum(r["count"] for r in sizes) == 1400


def test_appends_keep_repeated_and_null_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("b", 2), (None, 1), ("b", 1), (None, 1)], "name string, x int")
    assert rows(tables.append_with_ids(df, path, ["name"])) == [(1, "b", 1), (2, "b", 2), (3, None, 1), (4, None, 1)]
    assert tables.append_with_ids(df, path, ["name"], dedup=True).count() == 4
    new = str(tmp_path / "new")
    for _ in range(2):
        table = tables.append_new_only(df, new, "name")
    assert table.count() == 2
    again = str(tmp_path / "again")
    for _ in range(2):
        table = tables.append_dedup_renumber(df, again, ["name"])
    assert rows(table) == [(1, "b", 1), (2, None, 1)]


def test_columns_that_begin_later_and_absent_ones(spark, tmp_path):
    base = spark.createDataFrame([("v", 1.0, 2.0)], "vehicle_id string, lat double, lon double").withColumn("timestamp", F.current_timestamp())
    base.write.parquet(str(tmp_path / "a/2024-01-01/vehicle_status.parquet"))
    base.withColumn("station_id", F.lit("s")).write.parquet(str(tmp_path / "a/2024-01-02/vehicle_status.parquet"))
    found = snapshots.read_vehicle_status(spark, str(tmp_path / "a")).orderBy("day").collect()
    assert [r.station_id for r in found] == [None, "s"]
    base.drop("vehicle_id").write.parquet(str(tmp_path / "b/2024-01-01/vehicle_status.parquet"))
    with pytest.raises(ValueError, match="vehicle_id"):
        snapshots.read_vehicle_status(spark, str(tmp_path / "b"))


def test_old_updates_are_cut_before_reports_are_judged(spark):
    at = lambda y: dt.datetime(y, 5, 1)
    zero = clean.GO_ZERO_TIME
    df = spark.createDataFrame([("a", at(2021), at(2024)), ("b", at(2024), zero)], "k string, last_updated timestamp, last_reported timestamp")
    assert rows(clean.sanitize_reported(df)) == [("b", at(2024), None)]


def test_scratch_tables_of_a_load_are_removed(spark, tmp_path):
    root = pathlib.Path(session.scratch_path(spark, "x")).parent
    before = set(root.glob("*"))
    df = spark.createDataFrame([(1, 1, dt.date(2024, 1, 1))], "k int, x int, d date")
    for _ in range(2):
        tables.upsert_daily(df, str(tmp_path / "t"), "d", ["k"], ["k"])
    tables.append_with_ids(df, str(tmp_path / "u"), ["k"])
    assert set(root.glob("*")) == before


def test_bike_counter_files(spark, tmp_path):
    import gzip
    import json

    site = {"domain_name": "A", "counter_site": "S", "counter_site_id": "1", "longitude": 8.46789, "latitude": 49.4823,
            "channels": [{"iso_timestamp": "2024-01-01T10:00:00+01:00", "direction": "IN", "counts": 3}]}
    with gzip.open(tmp_path / "m.json.gz", "wt") as f:
        json.dump([site, {**site, "domain_name": "B"}], f)
    r = transit_files.read_bike_counters(spark, str(tmp_path), ["A"]).first()
    assert (r.counter_id, r.lat, r.lng, r.timestamp, r.counts) == ("1", 49.482, 8.468, hours(9), 3)
    assert transit_files.read_bike_counters(spark, str(tmp_path)).count() == 2


def test_short_and_long_timetable_rows(spark, tmp_path):
    cells = {
        "stops": "stop_id,stop_name,stop_lat,stop_lon\n1,\"A, B\",49,8\n", "trips": "trip_id,route_id,service_id\n1,1,1\n",
        "stop_times": "trip_id,stop_id,arrival_time,departure_time\n1,1,08:00:00,08:01:00\n1,2\n1,3,1,2,3,4\n",
        "routes": "route_id,route_long_name,route_short_name,route_type\n1,L,l,3\n",
        "calendar": "service_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday,start_date,end_date\n1,1,0,0,0,0,0,0,20240101,20240131\n"}
    for name, text in cells.items():
        (tmp_path / f"{name}.txt").write_text(text)
    read = transit_files.read_gtfs_tables(spark, str(tmp_path))
    assert rows(read["stop_times"]) == [("1", "1", "08:00:00", "08:01:00"), ("1", "2", None, None)]
    assert read["stops"].first().stop_name == "A, B"
    assert read["calendar"].first().end_date == dt.date(2024, 1, 31)


def test_polygon_layer_file(spark, tmp_path):
    from fleetspark.sources.context import read_polygon_layer

    (tmp_path / "l.json").write_text("""{"type": "FeatureCollection", "features": [
      {"type": "Feature", "properties": {"GEN": "line"}, "geometry": {"type": "LineString", "coordinates": [[0, 0], [1, 1]]}},
      {"type": "Feature", "properties": {"GEN": "a"}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]], [[1, 1], [2, 1], [2, 2], [1, 2], [1, 1]]]}},
      {"type": "Feature", "properties": {"GEN": "m"}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[8, 8], [9, 8], [9, 9], [8, 8]]], [[[1, 1], [2, 1], [2, 2], [1, 2], [1, 1]]]]}}]}""")
    layer = read_polygon_layer(spark, str(tmp_path / "l.json"), "GEN")
    points = spark.createDataFrame([(0.5, 0.5), (1.5, 1.5), (8.1, 8.5), (7.0, 7.0)], "lat double, lng double")
    assert rows(spatial.point_in_polygon(points, layer)) == [(0.5, 0.5, "a"), (1.5, 1.5, "m"), (7.0, 7.0, ""), (8.1, 8.5, "m")]


def test_promotion_of_column_types():
    from fleetspark.sources.schemas import promoted

    assert promoted({"int", "double"}) == "double" and promoted({"int", "bigint"}) == "bigint" and promoted({"float"}) == "float"
    assert promoted({"decimal(20,0)"}) == promoted({"decimal(20,0)", "int"}) == "bigint" and promoted({"timestamp", "timestamp_ntz"}) == "timestamp"
    for odd in ({"string", "int"}, {"boolean", "bigint"}, {"timestamp", "bigint"}, {"array<int>", "int"}):
        with pytest.raises(ValueError):
            promoted(odd)


def test_files_of_many_schemas(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    at = [1_714_521_600_123_456_789, 1_714_521_601_000_000_001]
    days = [
        {"timestamp": pa.array(at, pa.timestamp("ns", "UTC")), "current_range_meters": pa.array([1, 2], pa.int32()), "n": pa.array([1, 2], pa.uint64())},
        {"timestamp": pa.array([x // 1000 for x in at], pa.timestamp("us", "UTC")), "current_range_meters": pa.array([1.5, None], pa.float64()), "n": pa.array([3, 4], pa.int16())},
        {"timestamp": pa.array([x // 10**6 for x in at], pa.timestamp("ms", "UTC")), "current_range_meters": pa.array([7, 8], pa.int64()), "station_id": pa.array(["a", "b"])},
    ]
    for i, columns in enumerate(days * 2):
        (tmp_path / f"2024-05-0{i + 1}").mkdir()
        table = pa.table({**columns, "lat": [49.0, 49.1], "lon": [8.0, 8.1], "vehicle_id": ["x", "y"]})
        pq.write_table(table, tmp_path / f"2024-05-0{i + 1}" / "vehicle_status.parquet")
    from fleetspark.sources.schemas import by_schema, parquet_files

    files = parquet_files(spark, f"{tmp_path}/*/vehicle_status.parquet")
    assert sorted(len(x) for x in by_schema(spark, files)) == [2, 2, 2]
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    try:
        found = snapshots.read_vehicle_status(spark, str(tmp_path))
        assert dict(found.dtypes)["timestamp"] == "timestamp" and dict(found.dtypes)["current_range_meters"] == "double"
        got = sorted((r.day.day, r.vehicle_id, r.timestamp.microsecond, r.current_range_meters, r.station_id) for r in found.collect())
        assert got[:6] == [(1, "x", 123456, 1.0, None), (1, "y", 0, 2.0, None), (2, "x", 123456, 1.5, None), (2, "y", 0, None, None), (3, "x", 123000, 7.0, "a"), (3, "y", 0, 8.0, "b")]
        (tmp_path / "2024-06-01").mkdir()
        pq.write_table(pa.table({"timestamp": days[0]["timestamp"], "lat": [1.0, 2.0]}), tmp_path / "2024-06-01" / "vehicle_status.parquet")
        with pytest.raises(ValueError, match="lon"):
            snapshots.read_vehicle_status(spark, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.legacy.parquet.nanosAsLong")


def test_a_merge_with_wrong_counts_is_refused(spark):
    a = spark.createDataFrame([(T0, "v1"), (T0, "v2")], "last_updated timestamp, vehicle_id string")
    b = spark.createDataFrame([(T0, "v3"), (T0 + dt.timedelta(hours=1), "v1")], "last_updated timestamp, vehicle_id string")
    good = merge.merge_snapshots(a, b)
    assert merge.checked_merge(a, b, good, "last_updated", "vehicle_id").count() == 3
    with pytest.raises(ValueError, match="merged 2 rows"):
        merge.checked_merge(a, b, good.limit(2), "last_updated", "vehicle_id")


def test_parts_of_a_multipolygon_may_overlap(spark, tmp_path):
    from fleetspark.sources.context import read_polygon_layer

    (tmp_path / "l.json").write_text("""{"type": "FeatureCollection", "features": [
      {"type": "Feature", "properties": {"GEN": "m"}, "geometry": {"type": "MultiPolygon", "coordinates": [
        [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]], [[3, 3], [3.5, 3], [3.5, 3.5], [3, 3.5], [3, 3]]], [[[2, 2], [6, 2], [6, 6], [2, 6], [2, 2]]]]}},
      {"type": "Feature", "properties": {"GEN": "m"}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]]]}}]}""")
    layer = read_polygon_layer(spark, str(tmp_path / "l.json"), "GEN")
    points = spark.createDataFrame([(1.0, 1.0), (2.5, 2.5), (3.2, 3.2), (5.0, 5.0), (5.0, 1.0)], "lat double, lng double")
    found = spatial.containing(points, layer, keys=("layer_order",))
    assert rows(found) == [(1.0, 1.0, 0), (1.0, 1.0, 1), (2.5, 2.5, 0), (2.5, 2.5, 1), (3.2, 3.2, 0), (3.2, 3.2, 1), (5.0, 5.0, 0)]


def test_a_polygon_of_very_many_edges_lies_in_many_tasks(spark):
    import math

    n = 100_000
    radius = lambda k: 1 + 0.1 * (k % 2)
    angles = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.struct(
        ((1 + 0.1 * (k % 2)) * F.cos(2 * math.pi * k / n)).alias("x"), ((1 + 0.1 * (k % 2)) * F.sin(2 * math.pi * k / n)).alias("y")))
    layer = spark.range(1).select(F.lit(1).alias("layer_order"), F.lit("star").alias("name"), F.array(angles).alias("rings"))
    polygons = spatial.stored_polygons(layer, ["name"])
    edges = spatial.filed_edges(polygons)
    assert edges.count() <= 4 * n
    filed = edges.repartition(8, "_poly", "_slab").groupBy(F.spark_partition_id()).count().collect()
    assert len(filed) == 8 and max(r["count"] for r in filed) < 4 * edges.count() / 8
    points = spark.createDataFrame([(0.0001, 0.9), (0.7, -0.7), (0.0001, 1.2), (0.9, 0.9), (0.0001, -1.11)], "lat double, lng double")
    assert sorted(r.lat for r in spatial.containing(points, layer).collect()) == [0.0001, 0.7]


def test_grid_equals_brute_force(spark):
    rng = random.Random(4)
    areas, span = [], 0.05
    for city in "abc":
        for _ in range(3):
            parts = []
            for part in range(2):
                x, y = 8 + rng.uniform(0, span), 49 + rng.uniform(0, span)
                parts += [([{"x": x + rng.uniform(-span, span), "y": y + rng.uniform(-span, span)} for _ in range(rng.randrange(3, 12))], part)]
            areas.append((city, [r for r, _ in parts], [p for _, p in parts]))
    df = spark.createDataFrame(areas, "city string, rings array<array<struct<x:double,y:double>>>, parts array<int>")
    got = {(r.city, r.i, r.j) for r in spatial.city_grid(df, 500.0).collect()}

    def odd(ring, x, y):
        return sum((p["y"] > y) != (q["y"] > y) and x < (q["x"] - p["x"]) * (y - p["y"]) / (q["y"] - p["y"]) + p["x"] for p, q in zip(ring, ring[1:] + ring[:1])) % 2

    import math

    want = set()
    for city in "abc":
        rings = [r for c, rs, _ in areas if c == city for r in rs]  # every ring is a part of its own
        xs, ys = [p["x"] for r in rings for p in r], [p["y"] for r in rings for p in r]
        sy = 500.0 / 111_320.0
        sx = 500.0 / (111_320.0 * math.cos(math.radians(min(ys))))
        for i in range(math.ceil((max(xs) - min(xs)) / sx) + 1):
            for j in range(math.ceil((max(ys) - min(ys)) / sy) + 1):
                if any(odd(r, min(xs) + i * sx, min(ys) + j * sy) for r in rings):
                    want.add((city, i, j))
    assert got == want and len(got) == spatial.city_grid(df, 500.0).count()


def test_facts_are_stable_when_run_again(spark, tmp_path):
    from fleetspark.plans.facts import update_facts

    df = snaps(spark, (0, 0, 9, 9, None), (1, 1, 8, 8, None), (30, 2, 7, 7, None), (50, 0, 6, 6, None)).withColumn("vehicle_id", F.lit("DOC:Vehicle:v"))
    root = str(tmp_path / "facts")
    first = {n: rows(t) for n, t in update_facts(df, root, {"n": 1}, "dott").items()}
    again = {n: rows(t) for n, t in update_facts(df, root, {"n": 1}, "dott").items()}
    assert first == again
    assert len(first["trips"]) == 3 and len(first["availability"]) == 4 and len(first["demand"]) == 2
    assert {r[0] for r in first["trips"]} == {"v"}


def test_facts_from_landed_files(spark, tmp_path):
    from fleetspark.plans.facts import landed_vehicles, update_facts

    at = lambda day, hour: dt.datetime(2024, 5, day, hour)
    kind = "timestamp timestamp, last_updated timestamp, vehicle_id string, lat double, lon double, last_reported timestamp, current_range_meters double, current_fuel_percent double"
    for day, given in {
        1: [("v", 48.0, at(1, 7), 9000.0, 0.905), ("v", 48.1, at(1, 9), 8000.0, 0.8), ("old", 48.0, at(1, 7), 1.0, 0.1)],
        2: [("v", 48.2, at(2, 9), 7000.0, None)],
    }.items():
        made = [(t, t, v, lat, 9.0, dt.datetime(2023, 1, 1) if v == "old" else t, reach, charge) for v, lat, t, reach, charge in given]
        spark.createDataFrame(made, kind).write.parquet(str(tmp_path / f"in/2024-05-0{day}/vehicle_status.parquet"))
    seen = landed_vehicles(spark, str(tmp_path / "in"), {"n": 4})
    assert rows(seen.select("vehicle_id", "battery", "range_m", "network_name")) == [
        ("v", 80, 8000, "n"), ("v", 90, 9000, "n"), ("v", None, 7000, "n")]
    facts = update_facts(seen, str(tmp_path / "facts"), {"n": 4})
    trips = facts["trips"].orderBy("timestamp_lend").collect()
    assert [(t.pedelec_battery_lend, t.current_range_meters_return, t.network_name_lend) for t in trips] == [(90, 8000, 4), (80, 7000, 4)]
    assert facts["locations"].count() == 3 and facts["availability"].count() == 3
    by_name = landed_vehicles(spark, str(tmp_path / "in"), name_network=lambda df: df.withColumn("network_name", F.lit("m")))
    assert by_name.where("network_name = 'm'").count() == 3


def test_station_history_and_demographics_files(spark, tmp_path):
    from fleetspark.sources.context import read_demographics
    from fleetspark.sources.weather import read_station_history

    (tmp_path / "station_17.json").write_text('{"data": {"2024-01-01T00:00:00Z": {"t2m_med": 1.239, "wr_med": 359.9}}}')
    r = read_station_history(spark, str(tmp_path / "station_17.json")).first()
    assert (r.station_id, r.timestamp, r.temperature, r.humidity, r.wind_direction) == ("17", T0, 1.24, None, 359)
    (tmp_path / "d.json").write_text("""{"geographies": [{"features": [], "themes": []}, {"features": [{"name": "a"}, {"name": "b"}],
      "themes": [{"name": "age", "indicators": [{"name": "people", "date": "2023", "values": ["1.5", "x", "3"]}, {"name": "people", "date": "2019", "values": ["1"]}]}]}]}""")
    found = read_demographics(spark, str(tmp_path / "d.json")).select("topic", "area", "value")
    assert rows(found) == [("age", "a", 1.5), ("age", "b", None)]


def packed(rings, order="<"):
    """A polygon's bytes, written by hand."""
    out = struct.pack(order + "BII", order == "<", 3, len(rings))
    return out + b"".join(struct.pack(order + "I", len(r)) + b"".join(struct.pack(order + "dd", *p) for p in r) for r in rings)


RINGS = "rings array<array<struct<x:double,y:double>>>, parts array<int>, multi boolean"


def test_polygons_as_bytes_and_back(spark):
    edge = [0.0, 1.0, -1.0, 2.0**-1022, -1.7976931348623157e308, math.nextafter(8, 0), math.nextafter(8, 9), 1e-300, 49.4, math.pi, 0.1]
    ring = [(x, 1 - y) for x, y in zip(edge, reversed(edge))]
    ring.append(ring[0])
    opened = [(0.0, 0.0), (1.0, 0.0), (0.0, 1.0)]
    data = [([ring], [0], False), ([ring, ring[:1], ring], [0, 0, 1], True), ([ring], [0], True), ([], [], True), ([], [], False), ([opened], [0], False),
            ([[(1.0, float("nan"))]], [0], False), ([[(float("inf"), 1.0)]], [0], False), ([[(1.0, None)]], [0], False), ([None], [0], False), (None, None, False)]
    head = lambda n: struct.pack("<BII", 1, 6, n)
    want = [packed([ring]), head(2) + packed([ring, ring[:1]]) + packed([ring]), head(1) + packed([ring]), head(0), packed([]), packed([opened + opened[:1]])] + [None] * 5
    written = spark.createDataFrame(data, RINGS).select("*", polygon_wkb(F.col("rings"), F.col("parts"), F.col("multi")).alias("w"))
    plain = lambda rings: [[tuple(p) for p in r] for r in rings]
    found = written.withColumn("b", wkb_rings(F.col("w"))).collect()
    assert [r.w and bytes(r.w) for r in found] == want
    for r in found:
        if r.w is None:
            assert r.b is None
        elif r.rings != found[5].rings:
            assert (plain(r.b.rings), r.b.parts, r.b.multi) == (plain(r.rings), r.parts, r.multi)
    assert plain(found[5].b.rings) == [opened + opened[:1]]


def test_bytes_that_are_no_polygon(spark):
    ring = [(1.5, 2.0), (3.0, 4.0), (1.5, 2.0)]
    good = packed([ring])
    several = struct.pack(">BII", 0, 6, 1) + good
    bad = [good[:-1], good + b"x", b"", b"\x01", struct.pack("<BIdd", 1, 1, 1.0, 2.0), struct.pack("<BII", 1, 3, 2**32 - 1),
           struct.pack("<BIII", 1, 3, 1, 2**32 - 1), struct.pack("<BII", 1, 6, 1) + struct.pack("<BIdd", 1, 1, 1.0, 2.0), None]
    data = [(packed([ring], ">"),), (good,), (several,), *((b,) for b in bad)]
    found = [r.b for r in spark.createDataFrame(data, "w binary").select(wkb_rings(F.col("w")).alias("b")).collect()]
    assert [[tuple(p) for p in b.rings[0]] for b in found[:3]] == [ring] * 3
    assert found[3:] == [None] * len(bad)


def test_files_outside_the_days_are_not_opened(spark, tmp_path):
    head, row = "STATIONS_ID;MESS_DATUM;QN;FF_10;DD_10;eor\n", "  7;202401150010;3;  2.5;180;eor\n"
    (tmp_path / "produkt_20240111_20240120_00044.txt").write_text(head + row)
    (tmp_path / "_20240111_20240120_hidden.txt").write_text(head + row)
    for name in ("produkt_20240101_20240110_00044.txt", "days_unknown.txt"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "broken.txt.gz").write_bytes(b"no archive")
    read = lambda start, **kw: weather_files.read_station_observations(spark, str(tmp_path), "wind", start, "2024-01-31", **kw)
    assert sorted((r.station_id, r.measure, r.raw_value) for r in read("2024-01-12").collect()) == [(7, "wind_direction", "180"), (7, "wind_speed", "2.5")]
    assert read("2024-02-01").collect() == []
    with pytest.raises(Exception, match="gzip"):
        read("2024-01-05").collect()
    assert [f.rsplit("/", 1)[1] for f in files.dated_files(spark, f"{tmp_path}/prod*", "20240101", "20240115", r"_(\d{8})_[^_]*$")] == ["produkt_20240101_20240110_00044.txt"]
