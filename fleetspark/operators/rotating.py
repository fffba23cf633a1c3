"""Likely trips of fleets whose vehicle ids change with every rental."""

from __future__ import annotations

import json
import math

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetspark.functions.clock import whole_seconds
from fleetspark.functions.geo import EARTH_RADIUS_KM, geodesic_m, haversine_km, milli
from fleetspark.functions.numbers import half_even, with_rounded, with_units
from fleetspark.operators.demand import first_last_sighting
from fleetspark.operators.lookup import mapped
from fleetspark.operators.trips import TRIP_COLUMNS
from fleetspark.session import stored

# What makes a pair of sightings a possible rental.
MAX_SECONDS = 1800
MAX_BATTERY_DROP = 10
MAX_METRES = 3000
MAX_KMH = 20
# A gap this short with an unchanged vehicle is taken as certain.
SURE_SECONDS, SURE_BATTERY_DROP, SURE_METRES = 6, 1, 1000

# Places are told apart a hundredth beyond the limit: distances on the ellipsoid differ from the sphere by half of that.
SLACK = 1.01

# A miss in millimetres and the place of a return among those of a network's half hour (or the next) share one bigint.
MISSES, PLACES = 2**35, 2**27


def _cells(lat: Column, lng: Column, max_metres: int, around: bool) -> Column:
    """The cell of a place as an array of one, or with ``around`` all cells (up to four) a place within the limit can lie in.

    Rows are twice the limit high. A row is cut into equal columns at least twice as wide as the limit spans in
    longitude where the row comes nearest to a pole, so columns widen there and become one around the pole; they
    close at the date line.
    """
    arc = (max_metres + 1) * SLACK / (EARTH_RADIUS_KM * 1000)
    reach = math.degrees(arc)
    height = 2 * reach

    def columns(row: Column) -> Column:
        north = F.greatest(F.abs(row * height), F.abs((row + 1) * height)) + reach
        ratio = math.sin(arc / 2) / F.nullif(F.cos(F.radians(F.least(north, F.lit(90.0)))), F.lit(0.0))
        width = F.when((north < 90) & (ratio < 1), 2 * F.degrees(F.asin(F.least(ratio, F.lit(1.0)))))
        count = F.coalesce(F.greatest(F.floor(180 / width), F.lit(1)), F.lit(1))
        return F.struct(row.alias("row"), F.coalesce(width, F.lit(0.0)).alias("width"), count.alias("count"))

    def cell(c: Column, shift: int) -> Column:
        column = F.pmod(F.floor((lng + 180 + c.width * shift) * c["count"] / 360), c["count"])
        return F.struct(c.row.alias("row"), column.alias("column"))

    rows = F.array(*(F.floor((lat + reach * shift) / height) for shift in ((-1, 1) if around else (0,))))
    known = F.transform(F.array_distinct(rows), columns)
    shifts = (-1, 1) if around else (0,)
    return F.array_distinct(F.flatten(F.transform(known, lambda c: F.array(*(cell(c, s) for s in shifts)))))


def rental_ends(sightings: DataFrame, roles: str = "literal", order_by: str = "last_updated", numbered: bool = False) -> tuple[DataFrame, DataFrame]:
    """(lends, returns): an id's first and its last sighting, one row per id; ``roles="swapped"`` the other way round.

    ``numbered`` stores the returns with their half hour and their place in it (_slot, _nth), per network by time and id.
    """
    payload = ["battery", "range_m", "lat", "lon", "network_name"]
    if order_by != "last_updated":
        payload = ["last_updated", *payload]
    # Written once: as a plan both sides of the join would aggregate the sightings, each for its own end.
    ends = stored(first_last_sighting(sightings, order_by, payload), "ends")
    lend_end, return_end = ("first", "last") if roles == "literal" else ("last", "first")

    def side(end: str, name: str) -> DataFrame:
        e = F.col(end)
        return ends.select(
            F.col("vehicle_id").alias(f"vehicle_id_{name}"), e.network_name.alias("network_name"),
            whole_seconds(e.last_updated).alias(f"timestamp_{name}"), e.battery.alias(f"battery_{name}"),
            e.range_m.alias(f"range_{name}"), e.lat.alias(f"lat_{name}"), e.lon.alias(f"lng_{name}"),
        ).where(F.col(f"timestamp_{name}").isNotNull() & F.col(f"battery_{name}").isNotNull())

    lends, returns = side(lend_end, "lend"), side(return_end, "return")
    if numbered:
        slot = F.floor(F.col("timestamp_return") / MAX_SECONDS)
        order = Window.partitionBy("network_name", "_slot").orderBy("timestamp_return", "vehicle_id_return")
        nth = F.col("_nth")
        counted = F.when(nth <= PLACES, nth).otherwise(F.raise_error(F.lit(f"more than {PLACES} returns of a network in half an hour")).cast("int"))
        returns = stored(returns.withColumn("_slot", slot).withColumn("_nth", F.row_number().over(order)).withColumn("_nth", counted), "returns")
    return lends, returns


def _compared(pairs: DataFrame) -> DataFrame:
    """Pairs of ends with what differs between them."""
    return pairs.withColumns({
        "trip_date": F.to_date(F.timestamp_seconds("timestamp_lend")),
        "time_diff": F.col("timestamp_return") - F.col("timestamp_lend"),
        "battery_diff": F.col("battery_lend") - F.col("battery_return"),
        "range_diff": F.col("range_lend") - F.col("range_return"),
    })


def sure_matches(lends: DataFrame, returns: DataFrame, metres: str = "sphere") -> DataFrame:
    """(vehicle_id_lend, timestamp_lend, _sure): the first sure match, by return time and id, of the lends that have one.

    They meet by network, range and some seconds: only equal ranges are sure.
    """
    now = F.floor(F.col("timestamp_lend") / SURE_SECONDS)
    lends = lends.withColumn("_moment", F.explode(F.array(now, now + 1))).withColumn("_range", F.col("range_lend"))
    returns = returns.withColumn("_moment", F.floor(F.col("timestamp_return") / SURE_SECONDS)).withColumn("_range", F.col("range_return"))
    met = _compared(lends.join(returns, ["network_name", "_moment", "_range"])).where(
        F.col("time_diff").between(1, SURE_SECONDS) & F.col("battery_diff").between(0, SURE_BATTERY_DROP))
    return _first_sure(_measured(met, metres))


def rotating_pairs(
    sightings: DataFrame, roles: str = "literal", max_metres: int | None = MAX_METRES, order_by: str = "last_updated",
    sure: str | None = None, ends: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Pairs (lend, return) of first and last sightings that could be one rental.

    In one network, 0 < gap <= 1800 s and a battery drop of 0..10. ``roles="literal"`` takes an id's
    first sighting as lend and another id's last as return; ``"swapped"`` the other way round.

    A range join as equi join: returns are filed under one (network, cell, half hour, battery step) key;
    each lend looks into the cells, half hours and battery steps its window touches, so every pair
    meets exactly once. Cells of place keep all pairs within ``max_metres`` and bound the others: places
    further apart may remain, without a place there is no pair. ``max_metres=None`` pairs by network, time and battery alone,
    which grows with the square of a network's traffic.

    ``sure`` (how to measure, see ``trip_candidates``) gives each pair the sure match of its lend (_sure); ``ends`` are
    ``rental_ends`` at hand, numbered ones give each pair the place of its return (_place).
    """
    lend, back = lends, returns = ends or rental_ends(sightings, roles, order_by)
    numbered = "_nth" in returns.columns
    if sure:
        lend = lend.join(sure_matches(lends, returns.drop("_slot", "_nth"), sure), ["vehicle_id_lend", "timestamp_lend"], "left").select(*lend.columns, "_sure")
    step = MAX_BATTERY_DROP + 1
    now = F.floor(F.col("timestamp_lend") / MAX_SECONDS)
    level = F.floor(F.col("battery_lend") / step)
    back = back.withColumn("_slot", F.floor(F.col("timestamp_return") / MAX_SECONDS)).withColumn(
        "_level", F.floor(F.col("battery_return") / step))
    keys = ["network_name", "_slot", "_level"]
    if max_metres is not None:
        placed = lambda end: F.col(f"lat_{end}").isNotNull() & F.col(f"lng_{end}").isNotNull()
        lend = lend.where(placed("lend")).withColumn("_cell", F.explode(_cells(F.col("lat_lend"), F.col("lng_lend"), max_metres, True)))
        back = back.where(placed("return")).withColumn("_cell", F.get(_cells(F.col("lat_return"), F.col("lng_return"), max_metres, False), F.lit(0)))
        lend, back = (df.withColumns({"_row": F.col("_cell.row"), "_column": F.col("_cell.column")}).drop("_cell") for df in (lend, back))
        keys += ["_row", "_column"]
    lend = (
        lend.withColumn("_slot", F.explode(F.array(now, now + 1)))
        .withColumn("_level", F.explode(F.array(level - 1, level)))
    )
    gap = F.col("timestamp_return") - F.col("timestamp_lend")
    drop = F.col("battery_lend") - F.col("battery_return")
    met = _compared(lend.join(back, keys).where((gap > 0) & (gap <= MAX_SECONDS) & drop.between(0, MAX_BATTERY_DROP)))
    if numbered:
        met = met.withColumn("_place", (F.col("_slot") - now) * PLACES + F.col("_nth")).drop("_nth")
    return met.drop("_slot", "_level", "_row", "_column")


def _reach(seconds: Column) -> Column:
    """The least whole number of metres too far for a gap: beyond ``MAX_METRES``, or faster than ``MAX_KMH``, rounded to 0.01.

    The speed is taken as a quotient of whole numbers: no distance up to the limit comes so near to the last speed that
    rounds to it that fractions would decide otherwise.
    """
    ridden = F.ceil(seconds * (MAX_KMH * 1000 + 5) / 3600)
    return F.when(seconds < 0, MAX_METRES + 1).otherwise(F.least(F.lit(MAX_METRES + 1), ridden))


def _measured(pairs: DataFrame, metres: str) -> DataFrame:
    """Pairs within distance and speed.

    One condition on the length tests both. The length is exploded, an array of one: the planner would move a test of a mere
    column before it and compute the column twice.
    """
    ends = [F.col(c) for c in ("lat_lend", "lng_lend", "lat_return", "lng_return")]
    length = F.floor(geodesic_m(*ends) if metres == "ellipsoid" else haversine_km(*ends) * 1000)
    # The planner may compute the speed before the gap is tested, so a zero gap must not raise.
    hours = F.nullif(F.col("time_diff"), F.lit(0)) / 3600
    measured = pairs.withColumn("distance", F.explode(F.array(length))).where(F.col("distance") < _reach(F.col("time_diff")))
    measured = measured.withColumn("distance", F.col("distance").cast("int"))
    measured = with_rounded(measured, "speed", F.col("distance") / 1000 / hours, 2)
    return with_rounded(measured, "speed_range_based", F.col("range_diff") / 1000 / hours, 2)


def _rank() -> Column:
    return F.struct("timestamp_return", "vehicle_id_return")


def _first_sure(measured: DataFrame) -> DataFrame:
    sure = (
        (F.col("time_diff") <= SURE_SECONDS) & (F.col("range_diff") == 0)
        & (F.col("battery_diff") <= SURE_BATTERY_DROP) & (F.col("distance") < SURE_METRES)
    )
    # The sure matches are few; aggregating them apart keeps the candidates out of any window.
    return measured.where(sure).groupBy("vehicle_id_lend", "timestamp_lend").agg(F.min(_rank()).alias("_sure"))


def trip_candidates(pairs: DataFrame, metres: str = "sphere") -> DataFrame:
    """Pairs that a bicycle can have ridden: at most 3000 m and 20 km/h.

    Where a rental has a sure match (at most 6 s, same range, battery drop at most 1, under 1000 m),
    only the first sure match by return time and id is kept. ``metres="ellipsoid"`` measures on the
    WGS-84 ellipsoid instead of the sphere. Pairs with the sure match of their lend (_sure), measured in the same way, are judged
    one by one; others are written, to look for sure matches among them.
    """
    measured = _measured(pairs, metres)
    if "_sure" not in pairs.columns:
        # Written once: read for the sure matches and for the rest, the pairs meet a single time.
        measured = stored(measured, "candidates")
        measured = measured.join(_first_sure(measured), ["vehicle_id_lend", "timestamp_lend"], "left")
    keys = ["vehicle_id_lend", "timestamp_lend"]
    return measured.where(F.col("_sure").isNull() | (F.col("_sure") == _rank())).select(
        *keys, *(c for c in measured.columns if c not in (*keys, "_sure")))


OPTIONAL = ["battery_diff", "range_diff"]
FEATURES = ["time_diff", "battery_diff", "range_diff", "distance", "speed", "speed_range_based"]


def trip_features(known_trips: DataFrame, locations: DataFrame) -> DataFrame:
    """Trips with known ids (16-column layout) with the features of a candidate, to learn from."""
    spot = lambda end: locations.select(
        F.col("location_id").alias(f"location_id_{end}"), F.col("lat").alias(f"lat_{end}"), F.col("lng").alias(f"lng_{end}"))
    both = known_trips.join(spot("lend"), "location_id_lend").join(spot("return"), "location_id_return")
    ends = [F.col(c) for c in ("lat_lend", "lng_lend", "lat_return", "lng_return")]
    seconds = whole_seconds(F.col("timestamp_return")) - whole_seconds(F.col("timestamp_lend"))
    return (
        both.withColumns({
            "time_diff": seconds,
            "battery_diff": F.col("pedelec_battery_lend") - F.col("pedelec_battery_return"),
            "range_diff": F.col("current_range_meters_lend") - F.col("current_range_meters_return"),
            "distance": F.floor(haversine_km(*ends) * 1000).cast("int"),
        })
        .withColumn("_hours", F.nullif(F.col("time_diff"), F.lit(0)) / 3600)
        .withColumns({
            "speed": F.round(F.col("distance") / 1000 / F.col("_hours"), 2),
            "speed_range_based": F.round(F.col("range_diff") / 1000 / F.col("_hours"), 2),
        })
        .drop("_hours").where("time_diff > 0")
        .dropna(subset=["time_diff", "distance", "speed"])
    )


# Nodes of trees in one generated method: methods above 8,000 bytes of bytecode are not compiled to machine code.
NODES = 64

# A fitted tree as plain data: the value of a leaf, or (feature, threshold, tree at or below it, tree above it).
Tree = float | list


def _literal(value: float) -> str:
    """A double that SQL dialects read as a double, not as a decimal."""
    text = repr(float(value))
    return f"({text if 'e' in text else text + 'E0'})"


def _case(tree: Tree) -> str:
    if not isinstance(tree, (list, tuple)):
        return _literal(tree)
    feature, threshold, low, high = tree
    return f"CASE WHEN _x{feature} <= {_literal(threshold)} THEN {_case(low)} ELSE {_case(high)} END"


def _nodes(tree: Tree) -> int:
    return 1 + _nodes(tree[2]) + _nodes(tree[3]) if isinstance(tree, (list, tuple)) else 0


def _few(trees: list[tuple[float, Tree]]) -> list[list[tuple[float, Tree]]]:
    """Trees in their order, in lists of about ``NODES`` nodes at most, one tree at least."""
    lists, held = [[]], 0
    for weight, tree in trees:
        held += _nodes(tree)
        if lists[-1] and held > NODES:
            lists.append([])
            held = _nodes(tree)
        lists[-1].append((weight, tree))
    return lists


def _tree(node) -> Tree:
    """The nodes of a fitted tree, read from the model."""
    if node.getClass().getSimpleName() != "InternalNode":
        return node.prediction()
    split = node.split()
    return [split.featureIndex(), split.threshold(), _tree(node.leftChild()), _tree(node.rightChild())]


class DestinationModel:
    """Two sums of regression trees, latitude and longitude of the return, as plain data.

    Candidates are judged by CASE expressions over scaled features, which are text that other SQL engines read as well:
    ``features`` and ``predictions``. ``saved`` and ``load`` keep a fitted model without the library that fitted it.
    Vehicles without a battery or range have no such differences: 0, and an indicator says so.
    """

    def __init__(self, means: list[float], scales: list[float], lat: list[tuple[float, Tree]], lng: list[tuple[float, Tree]]):
        self.means, self.scales, self.lat, self.lng = means, scales, lat, lng

    @staticmethod
    def _raw() -> list[str]:
        known = [f"CASE WHEN {c} IS NULL THEN 0E0 ELSE 1E0 END" for c in OPTIONAL]
        return [f"coalesce(cast({c} AS double), 0E0)" for c in FEATURES] + known

    @property
    def features(self) -> dict[str, str]:
        """Name and SQL of the origin and of the scaled features."""
        scaled = [f"({raw} - {_literal(m)}) * {_literal(s)}" for raw, m, s in zip(self._raw(), self.means, self.scales)]
        return {f"_x{i}": text for i, text in enumerate(["cast(lat_lend AS double)", "cast(lng_lend AS double)", *scaled])}

    @property
    def predictions(self) -> dict[str, str]:
        """SQL of the predicted place over ``features``."""
        total = lambda trees: " + ".join(f"{_literal(weight)} * {_case(tree)}" for weight, tree in trees)
        return {"_plat": total(self.lat), "_plng": total(self.lng)}

    @staticmethod
    def learn(trips: DataFrame, seed: int, rounds: int, depth: int):
        """The scaler and two boosted-tree models, fitted, and the rows they learned from."""
        raw = {f"_f{i}": F.expr(text) for i, text in enumerate(DestinationModel._raw())}
        rows = trips.withColumns(raw).select(
            F.col("lat_lend").cast("double"), F.col("lng_lend").cast("double"), "lat_return", "lng_return", *raw)
        # Read by the scaler and by each model.
        assembled = stored(VectorAssembler(inputCols=list(raw), outputCol="_raw").transform(rows).drop(*raw), "training")
        scaler = StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True).fit(assembled)
        data = VectorAssembler(inputCols=["lat_lend", "lng_lend", "_scaled"], outputCol="_x").transform(scaler.transform(assembled))
        fitted = [GBTRegressor(featuresCol="_x", labelCol=label, predictionCol=out, maxIter=rounds, maxDepth=depth, seed=seed).fit(
            data.select("_x", label)) for label, out in (("lat_return", "_plat"), ("lng_return", "_plng"))]
        return scaler, *fitted, data

    @classmethod
    def of(cls, scaler, *fitted) -> DestinationModel:
        scales = [1 / s if s else 0.0 for s in scaler.std.toArray().tolist()]
        trees = [[(w, _tree(t._java_obj.rootNode())) for w, t in zip(m.treeWeights, m.trees)] for m in fitted]
        return cls(scaler.mean.toArray().tolist(), scales, *trees)

    @classmethod
    def fit(cls, trips: DataFrame, seed: int = 7, rounds: int = 10, depth: int = 4) -> DestinationModel:
        return cls.of(*cls.learn(trips, seed, rounds, depth)[:3])

    def saved(self) -> str:
        return json.dumps({"means": self.means, "scales": self.scales, "lat": self.lat, "lng": self.lng})

    @classmethod
    def load(cls, text: str) -> DestinationModel:
        return cls(**json.loads(text))

    def transform(self, candidates: DataFrame) -> DataFrame:
        """Candidates with the predicted place (_plat, _plng)."""
        named = candidates.withColumns({k: F.expr(v) for k, v in self.features.items()})

        def total(trees: list[tuple[float, Tree]]) -> Column:
            # The sum of ``predictions``, over an array: written out, many trees make one method too long to be compiled to machine code.
            values = F.array(*(F.expr(f"{_literal(weight)} * {_case(tree)}") for weight, tree in trees))
            return F.aggregate(values, F.lit(0.0), lambda a, value: a + value)

        return named.withColumns({"_plat": total(self.lat), "_plng": total(self.lng)}).drop(*self.features)

    def missed(self, candidates: DataFrame) -> DataFrame:
        """Candidates with the kilometres from the predicted place to the return (_miss), without the place itself.

        The sums of ``predictions``, a few trees a step: an expression that stands twice becomes a method of its own, and one
        of a few trees is short enough to be compiled to machine code. Trees in arrays are read node by node for every row.
        """
        made = candidates.withColumns({k: F.expr(v) for k, v in self.features.items()})
        for name, trees in (("_plat", self.lat), ("_plng", self.lng)):
            total = None
            for few in _few(trees):
                for weight, tree in few:
                    value = F.expr(f"{_literal(weight)} * {_case(tree)}")
                    total = value if total is None else total + value
                made, total = made.withColumn(name, F.greatest(total, total)), F.col(name)
        miss = haversine_km(F.col("_plat"), F.col("_plng"), F.col("lat_return"), F.col("lng_return"))
        return made.withColumn("_miss", miss).drop("_plat", "_plng", *self.features)


def nearest_to_prediction(predicted: DataFrame) -> DataFrame:
    """Per rental the candidate whose return lies nearest to the predicted place (_plat, _plng)."""
    miss = F.round(haversine_km(F.col("_plat"), F.col("_plng"), F.col("lat_return"), F.col("lng_return")), 6)
    columns = [c for c in predicted.columns if c not in ("_plat", "_plng", "_place")]
    rank = F.struct(miss.alias("miss"), "timestamp_return", "vehicle_id_return")
    return (
        predicted.groupBy("trip_date", "vehicle_id_lend").agg(F.min_by(F.struct(*columns), rank).alias("best"))
        .select("best.*")
    )


def least_miss(missed: DataFrame, ends: tuple[DataFrame, DataFrame], metres: str) -> DataFrame:
    """Per rental the candidate of numbered ``ends`` whose return lies nearest to the predicted place, by its miss (_miss).

    Candidates are compared by a single number, miss and place of the return, which is aggregated where they meet; the
    chosen ones are put together again from their ends. So no candidate is sorted or moved.
    """
    columns = [c for c in missed.columns if c not in ("_miss", "_place")]
    lends, returns = ends
    miss = F.col("_miss")
    # Millimetres, at most half the way round the earth, fill 35 bits; no number comes last, as in any order of doubles.
    exact = F.when(F.isnan(miss), MISSES - 1).otherwise(F.round(F.round(miss, 6) * 1e6).cast("bigint"))
    number = F.coalesce(F.col("_millimetres").cast("bigint"), exact) * (2 * PLACES) + F.col("_place") - 1
    best = with_units(missed, "_miss", 6, "_millimetres").select("vehicle_id_lend", number.alias("_number")).groupBy("vehicle_id_lend").agg(
        F.min("_number").alias("_number")).withColumnRenamed("vehicle_id_lend", "_id")
    place = F.pmod("_number", F.lit(2 * PLACES))
    chosen = lends.join(best, lends["vehicle_id_lend"].eqNullSafe(best["_id"])).withColumns({
        "_slot": F.floor(F.col("timestamp_lend") / MAX_SECONDS) + F.floor(place / PLACES), "_nth": (F.pmod(place, F.lit(PLACES)) + 1).cast("int")})
    return _measured(_compared(chosen.join(returns, ["network_name", "_slot", "_nth"])), metres).select(*columns)


def predict_destination(
    candidates: DataFrame, model: DestinationModel, ends: tuple[DataFrame, DataFrame] | None = None, metres: str = "sphere",
) -> DataFrame:
    """The likeliest candidate of each rental; with ``ends``, the numbered ones the candidates come from, none is sorted or moved."""
    if ends is None:
        return nearest_to_prediction(model.transform(candidates))
    return least_miss(model.missed(candidates), ends, metres)


def rental_destinations(sightings: DataFrame, model: DestinationModel, roles: str = "literal", metres: str = "sphere") -> DataFrame:
    """Pairs, plausible candidates and the predicted destination of each rental."""
    ends = rental_ends(sightings, roles, numbered=True)
    candidates = trip_candidates(rotating_pairs(sightings, roles, sure=metres, ends=ends), metres)
    return predict_destination(candidates, model, ends, metres)


def as_trips(chosen: DataFrame, locations: DataFrame, networks: dict | None = None) -> DataFrame:
    """Chosen candidates in the 16-column trip layout, marked as predicted."""
    spot = lambda end: locations.select(
        F.col("location_id").alias(f"location_id_{end}"), milli(F.col("lat")).alias(f"_y_{end}"), milli(F.col("lng")).alias(f"_x_{end}"))
    out = chosen
    for end in ("lend", "return"):
        out = out.withColumn(f"_y_{end}", milli(F.col(f"lat_{end}"))).withColumn(f"_x_{end}", milli(F.col(f"lng_{end}"))).join(
            spot(end), [f"_y_{end}", f"_x_{end}"], "left")
    name = F.col("network_name")
    network = name if networks is None else mapped(name, networks)
    columns = {"vehicle_id": F.col("vehicle_id_lend"), "predicted": F.lit(True), "trip_date": F.col("trip_date")}
    for end in ("lend", "return"):
        columns |= {
            f"timestamp_{end}": F.timestamp_seconds(f"timestamp_{end}"),
            f"network_name_{end}": network,
            f"location_id_{end}": F.col(f"location_id_{end}"),
            f"pedelec_battery_{end}": half_even(F.col(f"battery_{end}"), "smallint"),
            f"current_range_meters_{end}": half_even(F.col(f"range_{end}"), "int"),
        }

    def typed(column: str, kind: str | None) -> Column:
        value = columns.get(column, F.lit(None))
        return (value.cast(kind) if kind else value).alias(column)

    return out.select(*(typed(c, k) for c, k in TRIP_COLUMNS.items()))
