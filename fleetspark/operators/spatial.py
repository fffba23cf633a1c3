"""Point in polygon, nearest site, place descriptions and grids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from fleetspark.functions.geo import haversine_km, milli, ring_edges, wkt_point
from fleetspark.functions.numbers import decimals
from fleetspark.operators.keys import asc
from fleetspark.session import stored

# Cell sizes in degrees a polygon can be filed under; each is four times the one before.
CELL_SIZES = [0.01 * 4**i for i in range(8)]
CELLS_PER_AXIS = 16


EDGES_PER_SLAB = 64


def _parts(layer: DataFrame) -> Column:
    return F.col("parts") if "parts" in layer.columns else F.transform("rings", lambda r: F.lit(0)).alias("parts")


def stored_polygons(layer: DataFrame, keys: list[str]) -> DataFrame:
    """Polygons with a number, the keys, their box and the height of the slabs their edges are filed under.

    A slab holds some dozens of edges; no polygon has more than about two filed edges per edge. ``parts`` tells which
    part of a multi-polygon each ring belongs to; without it all rings are one part.
    """
    corners = F.flatten("rings")
    x, y = F.transform(corners, lambda p: p.x), F.transform(corners, lambda p: p.y)
    climb = F.aggregate(ring_edges(F.col("rings")), F.lit(0.0), lambda a, e: a + F.abs(e.y2 - e.y1))
    sized = layer.select(F.monotonically_increasing_id().alias("_poly"), *keys, "rings", _parts(layer), F.array_min(x).alias("x0"),
                         F.array_max(x).alias("x9"), F.array_min(y).alias("y0"), F.array_max(y).alias("y9"), F.size(corners).alias("n"), climb.alias("climb"))
    height = F.greatest((F.col("y9") - F.col("y0")) / F.ceil(F.col("n") / EDGES_PER_SLAB), F.col("climb") / F.col("n"), F.lit(1e-12))
    return stored(sized.where("n > 0").withColumn("height", height).drop("n", "climb"), "polygons")


def slab(y: Column) -> Column:
    """The slab of a polygon at ``y``; never falls as y rises."""
    return F.floor((y - F.col("y0")) / F.col("height"))


def filed_edges(polygons: DataFrame) -> DataFrame:
    """Edges as rows (_poly, part, _slab, x1, y1, x2, y2), one for each slab an edge reaches into; level ones cross nothing."""
    rings = polygons.select("_poly", "parts", "y0", "height", F.posexplode("rings").alias("_at", "_ring"))
    edges = rings.select("_poly", "y0", "height", F.get("parts", F.col("_at")).alias("part"), F.inline(ring_edges(F.array("_ring")))).where("y1 <> y2")
    return edges.withColumn("_slab", F.explode(F.sequence(slab(F.least("y1", "y2")), slab(F.greatest("y1", "y2"))))).drop("y0", "height")


def polygon_cells(polygons: DataFrame) -> DataFrame:
    """Boxes filed by grid cell (level, cx, cy); the cell size follows the box, which fills at most about 17 x 17 cells."""
    extent = F.greatest(F.col("x9") - F.col("x0"), F.col("y9") - F.col("y0"))
    level = F.lit(len(CELL_SIZES) - 1)
    for i in reversed(range(len(CELL_SIZES) - 1)):
        level = F.when(extent <= CELL_SIZES[i] * CELLS_PER_AXIS, i).otherwise(level)
    size = F.element_at(F.array(*(F.lit(s) for s in CELL_SIZES)), F.col("level") + 1)
    index = lambda c: F.floor(F.col(c) / F.col("size"))
    return (
        polygons.drop("rings", "parts").withColumn("level", level).withColumn("size", size)
        .withColumn("cx", F.explode(F.sequence(index("x0"), index("x9"))))
        .withColumn("cy", F.explode(F.sequence(index("y0"), index("y9")))).drop("size")
    )


CROSSING_X = "(x2 - x1) * ({y} - y1) / (y2 - y1) + x1"


def _point_cells(points: DataFrame, lat: str, lng: str) -> DataFrame:
    """One row per point and grid level."""
    levels = F.array(*(
        F.struct(F.lit(i).alias("level"), F.floor(F.col(lng) / s).alias("cx"), F.floor(F.col(lat) / s).alias("cy"))
        for i, s in enumerate(CELL_SIZES)))
    return points.select("*", F.inline(levels))


def containing(points: DataFrame, layer: DataFrame, lat: str = "lat", lng: str = "lng", keys: tuple[str, ...] = ("layer_order", "name")) -> DataFrame:
    """(lat, lng, *keys) of every polygon around each distinct point.

    A point meets the polygons whose box holds it, through grid cells, and of these only the edges of its own slab. A part
    holds the point if a ray to the right crosses it an odd number of times; the crossings are counted edge by edge, before
    and after the shuffle, so the edges of a large polygon and the points of a crowded one may lie in any number of tasks.
    """
    polygons = stored_polygons(layer, list(keys))
    # Both sides are dealt out to a set number of tasks: by their bytes, a few places or the polygons of one file are left to
    # one task, which would meet every pair of them and count its crossings.
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spots = points.select(F.col(lat).alias("_lat"), F.col(lng).alias("_lng")).dropna().distinct().repartition(parts, "_lng", "_lat")
    near = _point_cells(spots, "_lat", "_lng").join(polygon_cells(polygons).repartition(parts, "_poly"), ["level", "cx", "cy"]).where(
        "_lat BETWEEN y0 AND y9 AND _lng BETWEEN x0 AND x9")
    met = near.select("_lat", "_lng", "_poly", slab(F.col("_lat")).alias("_slab")).join(filed_edges(polygons), ["_poly", "_slab"])
    crossed = met.where(f"(y1 > _lat) <> (y2 > _lat) AND _lng < {CROSSING_X.format(y='_lat')}")
    odd = crossed.groupBy("_lat", "_lng", "_poly", "part").agg(F.count("*").alias("n")).where("n % 2 = 1")
    held = odd.select("_lat", "_lng", "_poly").distinct().join(polygons.select("_poly", *keys), "_poly")
    return held.select(F.col("_lat").alias(lat), F.col("_lng").alias(lng), *keys)


def _first_polygon(points: DataFrame, layer: DataFrame, lat: str, lng: str) -> DataFrame:
    """(lat, lng, _name): the polygon with the lowest layer_order around each distinct point."""
    return containing(points, layer, lat, lng).groupBy(lat, lng).agg(
        F.min(F.struct("layer_order", "name")).getField("name").alias("_name"))


def _shown(numeric: bool) -> Column:
    """The found name; outside all polygons "", or 0 where a number is wanted and there is none."""
    name = F.coalesce("_name", F.lit(""))
    if not numeric:
        return name
    return F.coalesce(F.when(name.rlike("^[0-9]+$"), name.try_cast("int")), F.lit(0))


def point_in_polygon(
    points: DataFrame, layer: DataFrame, result: str = "name", lat: str = "lat", lng: str = "lng", numeric: bool = False,
) -> DataFrame:
    """Attach the name of the first polygon (lowest layer_order) around each point.

    A point outside all polygons gets "" (0 when ``numeric``; so does a name that is no number).
    Distinct coordinates are looked up once and kept as a table; while it is small Spark broadcasts it
    and the points are not shuffled. Boundary points follow the even-odd rule.
    """
    first = stored(_first_polygon(points, layer, lat, lng), "names")
    return points.join(first, [lat, lng], "left").withColumn(result, _shown(numeric)).drop("_name")


def split_by_polygon(
    df: DataFrame, boundary: DataFrame, column: str, inside_name: str, outside_name: str,
    lat: str = "lat", lng: str = "lon", only: Column | None = None,
) -> DataFrame:
    """Rename by side of a boundary: inside, outside, or unchanged where the place is unknown.

    ``only`` limits the renaming (for instance to one zone); other rows keep their value.
    """
    within = containing(df if only is None else df.where(only), boundary, lat, lng).select(
        lat, lng, F.lit(True).alias("_in")).distinct()
    within = stored(within, "inside")
    known = F.col(lat).isNotNull() & F.col(lng).isNotNull()
    new = F.when(~known, F.col(column)).when(F.col("_in"), F.lit(inside_name)).otherwise(F.lit(outside_name))
    if only is not None:
        new = F.when(only, new).otherwise(F.col(column))
    return df.join(within, [lat, lng], "left").withColumn(column, new).select(*df.columns)


# Sides in degrees of the squares of a pyramid; each is a quarter of the one before and lies in one square of it.
SQUARES = [64.0, 16.0, 4.0, 1.0, 0.25, 0.0625, 0.015625]
CROWD = 32  # sites in a square that are not worth a finer level
SLACK_KM = 0.001  # above the error of computed distances, also between opposite ends of the earth


def _square(lat: str, lng: str, side: float) -> list[Column]:
    """Numbers (row, column) of the square around a place; longitudes are taken round the earth."""
    east = F.pmod(F.col(lng) + 180.0, F.lit(360.0))
    return [F.floor((F.col(lat) + 90.0) / side).alias("_qy"), F.floor(east / side).alias("_qx")]


def site_pyramid(sites: DataFrame) -> tuple[DataFrame, int]:
    """Stored squares of all levels that hold sites (_level, _qy, _qx, middle, near, far), and the finest level needed.

    ``near`` and ``far`` are how far the nearest and the farthest of the square's sites are from its middle.
    """
    levels = F.explode(F.array(*(
        F.struct(F.lit(i).alias("_level"), F.lit(side).alias("_side"), *_square("_slat", "_slng", side)) for i, side in enumerate(SQUARES))))
    filed = sites.select("_slat", "_slng", levels.alias("_at")).select("_slat", "_slng", "_at.*")
    off = haversine_km(F.col("_my"), F.col("_mx"), F.col("_slat"), F.col("_slng"))
    pyramid = stored(
        filed.withColumn("_my", (F.col("_qy") + 0.5) * F.col("_side") - 90.0).withColumn("_mx", (F.col("_qx") + 0.5) * F.col("_side") - 180.0)
        .groupBy("_level", "_qy", "_qx", "_my", "_mx").agg(F.min(off).alias("near"), F.max(off).alias("far"), F.count("*").alias("sites")), "pyramid")
    crowds = dict(pyramid.groupBy("_level").agg(F.max("sites")).collect())  # one row a level
    depth = next((i for i in range(len(SQUARES)) if crowds.get(i, 0) <= CROWD), len(SQUARES) - 1)
    return pyramid, depth


def nearest(
    points: DataFrame, sites: DataFrame, site: str, max_km: float | None = None,
    lat: str = "lat", lng: str = "lng", keep_sites: Column | None = None,
) -> DataFrame:
    """Attach (site, distance_km) of the nearest site; points without one in reach are dropped.

    A descent through a pyramid of squares, each a quarter of the side of the one above. By the
    triangle inequality the distance to a square's middle tells how near its nearest site can be and
    has to be; squares that cannot hold the nearest site drop out, the others are replaced by their
    parts on the next level through an equi join. A point keeps a few squares a level, wherever on
    the earth it lies, however many sites there are, and meets only the sites of the last of them.
    Distances compare to the millimetre; equal ones are decided by the site value.
    """
    chosen = sites if keep_sites is None else sites.where(keep_sites)
    chosen = chosen.select(F.col(site).alias("_site"), F.col("lat").alias("_slat"), F.col("lng").alias("_slng")).dropna()
    pyramid, depth = site_pyramid(chosen)
    spots = points.select(lat, lng).dropna().distinct()
    squares = ["_qy", "_qx", "_my", "_mx", "near", "far"]
    km = haversine_km(F.col(lat), F.col(lng), F.col("_my"), F.col("_mx"))
    for level in range(depth + 1):
        parts = pyramid.where(F.col("_level") == level).select(*squares)
        if level == 0:  # at most 3 x 6 squares cover the earth
            found = spots.withColumn("_roots", parts.agg(F.collect_list(F.struct(*squares))).scalar()).select(lat, lng, F.inline("_roots"))
        else:
            parts = parts.withColumn("_py", F.floor(F.col("_qy") / 4)).withColumn("_px", F.floor(F.col("_qx") / 4))
            found = kept.join(parts, ["_py", "_px"])
        found = found.withColumn("_km", km).select(
            lat, lng, "_qy", "_qx", F.greatest(F.col("_km") - F.col("far"), F.col("near") - F.col("_km")).alias("least"),
            (F.col("_km") + F.col("near")).alias("most"))
        held = found.groupBy(lat, lng).agg(F.min("most").alias("_reach"), F.collect_list(F.struct("_qy", "_qx", "least")).alias("_squares"))
        reach = F.col("_reach") if max_km is None else F.least("_reach", F.lit(float(max_km)))
        held = held.withColumn("_reach", reach + F.lit(SLACK_KM))
        kept = held.select(lat, lng, F.inline(F.filter("_squares", lambda s: s["least"] <= F.col("_reach")))).select(
            lat, lng, F.col("_qy").alias("_py"), F.col("_qx").alias("_px"))
    filed = chosen.select("_site", "_slat", "_slng", *_square("_slat", "_slng", SQUARES[depth]))
    pairs = kept.withColumnsRenamed({"_py": "_qy", "_px": "_qx"}).join(filed, ["_qy", "_qx"]).withColumn(
        "_km", F.round(haversine_km(F.col(lat), F.col(lng), F.col("_slat"), F.col("_slng")), 6))
    if max_km is not None:
        pairs = pairs.where(F.col("_km") <= max_km)
    best = pairs.groupBy(lat, lng).agg(F.min(F.struct("_km", "_site")).alias("_best"))
    return points.join(stored(best, "nearest"), [lat, lng]).select(
        "*", F.col("_best._site").alias(site), F.col("_best._km").alias("distance_km")).drop("_best")


def nearest_city_within(points: DataFrame, cities: DataFrame, city: str = "city", max_km: float = 20.0, **columns) -> DataFrame:
    return nearest(points, cities, city, max_km, **columns)


def nearest_station(places: DataFrame, stations: DataFrame, start: Column, end: Column) -> DataFrame:
    """Nearest station that was there during the whole of [start, end]."""
    covers = (F.col("valid_from") <= start) & (F.col("valid_to") >= end)
    return nearest(places, stations, "station_id", keep_sites=covers)


def chosen_stations(places: DataFrame, stations: DataFrame, start: Column, end: Column) -> DataFrame:
    """The stations that are the nearest of some place."""
    used = nearest_station(places, stations, start, end).select("station_id").distinct()
    return stations.join(used, "station_id", "left_semi")


def stops_in_region(
    stops: DataFrame, states: DataFrame, postal: DataFrame | None = None, cities: list[str] | None = None,
) -> DataFrame:
    """Stops inside any state; with ``cities`` the first postal area's city has to contain one of the names.

    ``postal`` is a polygon layer whose name is the city.
    """
    within = containing(stops, states).select("lat", "lng").distinct()
    inside_state = stops.join(within, ["lat", "lng"], "left_semi")
    if not cities:
        return inside_state
    located = point_in_polygon(inside_state, postal, "_city")
    wanted = F.lit(False)
    for name in cities:
        wanted = wanted | F.contains(F.lower("_city"), F.lit(name.lower()))
    return located.where(wanted).drop("_city")


def group_nearby(locations: DataFrame) -> DataFrame:
    """2-decimal cells that hold a location, with the number of members."""
    return locations.groupBy(decimals(F.col("lat"), 2).alias("cell_lat"), decimals(F.col("lng"), 2).alias("cell_lng")).agg(
        F.count("*").alias("members"))


def lookup_elevation(locations: DataFrame, heights: DataFrame) -> DataFrame:
    """Height of the 3-decimal cell as smallint, null where unknown."""
    dim = heights.select(milli(F.col("lat")).alias("_y"), milli(F.col("lng")).alias("_x"),
                         F.col("elevation").cast("smallint").alias("elevation"))
    keyed = locations.withColumn("_y", milli(F.col("lat"))).withColumn("_x", milli(F.col("lng")))
    return keyed.join(dim, ["_y", "_x"], "left").drop("_y", "_x")


def lookup_city(locations: DataFrame, known: DataFrame, tolerance_milli: int = 10) -> DataFrame:
    """City of the same 3-decimal cell, else of the nearest known cell at most 0.01 degrees off on both axes.

    Distances are compared in whole thousandths of a degree; ties go to the smaller city name.
    """
    step = tolerance_milli
    spots = locations.select("lat", "lng").dropna().distinct().withColumn("_y", milli(F.col("lat"))).withColumn(
        "_x", milli(F.col("lng")))
    around = lambda c: F.sequence(F.floor((F.col(c) - step) / step), F.floor((F.col(c) + step) / step))
    searched = spots.withColumn("_cy", F.explode(around("_y"))).withColumn("_cx", F.explode(around("_x")))
    dim = known.select(
        milli(F.col("lat")).alias("_ky"), milli(F.col("lng")).alias("_kx"), F.col("city")).distinct()
    dim = dim.withColumn("_cy", F.floor(F.col("_ky") / step)).withColumn("_cx", F.floor(F.col("_kx") / step))
    dy, dx = F.abs(F.col("_ky") - F.col("_y")), F.abs(F.col("_kx") - F.col("_x"))
    hits = searched.join(dim, ["_cy", "_cx"]).where((dy <= step) & (dx <= step))
    best = hits.groupBy("lat", "lng").agg(
        F.min(F.struct((dy * dy + dx * dx).alias("d"), F.col("city"))).getField("city").alias("city"))
    return locations.join(best, ["lat", "lng"], "left")


GEO_LAYERS = {"continent_name": False, "country_name": False, "federal_state_name": False, "postal_code": True}


def geo_information(
    locations: DataFrame, layers: dict[str, DataFrame], cities: DataFrame | None = None,
    heights: DataFrame | None = None, known: DataFrame | None = None,
) -> DataFrame:
    """Names around each location: continent, country, state, postal code; WKT, city and height.

    The layers are looked up once per 2-decimal cell, at the cell's coordinate, and handed to its
    members. Locations already in ``known`` keep their stored row.
    """
    fresh = locations if known is None else locations.join(known.select("location_id"), "location_id", "left_anti")
    fresh = fresh.withColumn("_glat", decimals(F.col("lat"), 2)).withColumn("_glng", decimals(F.col("lng"), 2)).dropna(subset=["_glat", "_glng"])
    # All layers are looked up together, and the first polygon of each is picked in one grouping.
    every = [layers[c].select("layer_order", "name", "rings", _parts(layers[c]), F.lit(c).alias("layer")) for c in GEO_LAYERS]
    hits = containing(fresh, reduce(DataFrame.unionByName, every), "_glat", "_glng", ("layer", "layer_order", "name"))
    first = lambda c: F.min(F.when(F.col("layer") == c, F.struct("layer_order", "name"))).getField("name").alias(c)
    cells = stored(hits.groupBy("_glat", "_glng").agg(*[first(c) for c in GEO_LAYERS]), "cells")
    out = fresh.join(cells, ["_glat", "_glng"], "left")
    for column, numeric in GEO_LAYERS.items():
        out = out.withColumn("_name", F.col(column)).withColumn(column, _shown(numeric)).drop("_name")
    out = lookup_city(out, cities) if cities is not None else out.withColumn("city", F.lit(None).cast("string"))
    out = lookup_elevation(out, heights) if heights is not None else out.withColumn("elevation", F.lit(None).cast("smallint"))
    out = out.select(
        F.col("location_id").cast("int").alias("location_id"), wkt_point(F.col("lat"), F.col("lng")).alias("location"),
        "continent_name", "country_name", F.coalesce("city", F.lit("")).alias("city_name"), "federal_state_name", "postal_code", "elevation")
    return out if known is None else known.select(*out.columns).unionByName(out)


METRES_PER_DEGREE = 111_320.0


def city_grid(areas: DataFrame, spacing_m: float = 250.0, limit: int | None = None) -> DataFrame:
    """Regular points (city, i, j, lat, lng) inside the union of each city's polygons (city, rings[, parts]).

    The grid starts at the south-west corner of the city. Each row of the grid is cut with the edges of its slab, and
    between an odd crossing of a part and the next one lie its points; rows of a city's polygons and parts are merged as
    spans of columns before a single point is made. The work follows the edges, the rows and the result, not the box.
    ``limit`` keeps the first points.
    """
    polygons = stored_polygons(areas, ["city"])
    corner = polygons.groupBy("city").agg(F.min("x0").alias("ox"), F.min("y0").alias("oy")).withColumn(
        "sy", F.lit(spacing_m / METRES_PER_DEGREE)).withColumn("sx", spacing_m / (METRES_PER_DEGREE * F.cos(F.radians("oy"))))
    placed = polygons.join(corner, "city")
    index = lambda c: (F.col(c) - F.col("oy")) / F.col("sy")
    lines = placed.withColumn("j", F.explode(F.sequence(F.floor(index("y0")), F.ceil(index("y9"))))).withColumn("lat", F.col("oy") + F.col("j") * F.col("sy"))
    cut = lines.select("city", "_poly", "j", "lat", "ox", "sx", slab(F.col("lat")).alias("_slab")).join(filed_edges(polygons), ["_poly", "_slab"])
    crossings = cut.where("(y1 > lat) <> (y2 > lat)").groupBy("city", "j", "lat", "ox", "sx", "_poly", "part").agg(
        F.sort_array(F.collect_list(F.expr(CROSSING_X.format(y="lat")))).alias("xs"))
    # A point of column i is inside if xs[2k] <= ox + i * sx < xs[2k + 1]; the bounds are guessed and put right by one.
    at = lambda i: F.col("ox") + i * F.col("sx")
    guess = lambda x: F.ceil((x - F.col("ox")) / F.col("sx"))

    def first(x):
        g = guess(x)
        return F.when(at(g - 1) >= x, g - 1).when(at(g) >= x, g).otherwise(g + 1)

    pairs = F.transform(F.sequence(F.lit(1), F.size("xs"), F.lit(2)), lambda k: F.struct(
        first(F.element_at("xs", k)).alias("lo"), (first(F.element_at("xs", k + 1)) - 1).alias("hi")))
    spans = crossings.select("city", "j", "lat", "ox", "sx", F.filter(pairs, lambda s: s["lo"] <= s["hi"]).alias("spans"))
    joined = spans.groupBy("city", "j", "lat", "ox", "sx").agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"))
    furthest = F.expr("transform(spans, (s, k) -> coalesce(array_max(transform(slice(spans, 1, k), t -> t.hi)), s.lo - 1))")
    own = F.zip_with("spans", furthest, lambda s, before: F.struct(F.greatest(s["lo"], before + 1).alias("lo"), s["hi"].alias("hi")))
    columns = joined.select("city", "j", "lat", "ox", "sx", F.inline(F.filter(own, lambda s: s["lo"] <= s["hi"])))
    grid = columns.withColumn("i", F.explode(F.sequence("lo", "hi"))).select("city", "i", "j", "lat", at(F.col("i")).alias("lng"))
    return grid if limit is None else grid.orderBy(*asc("city", "j", "i")).limit(limit)
