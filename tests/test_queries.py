"""Every registered query against its SQL; long-running ones are checked by check.py at larger scale."""

import pytest

import __spark_entry__ as entry
import check
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from fleetspark.operators.rotating import DestinationModel, predict_destination, trip_features
from fleetspark.plans.rotating import rotating_trips
from registry import all_queries, context
from registry.base import NETWORKS, Source, with_adapters
from registry.facts import locations, trips

NAMES = [q.name for q in all_queries()]
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k in NAMES}
QUERIES = {k: v for k, v in entry.queries().items() if k in NAMES}


@pytest.fixture(scope="module")
def duck(folder):
    return check.connect(folder)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLE])
def test_matches_sql(spark, folder, duck, name):
    result = check.compare(QUERIES[name](spark, folder), duck, ORACLE[name])
    assert isinstance(result, int), result


def test_entry(spark):
    assert entry.entry(spark).count() == 911


def test_fitted_model_judges_as_its_case_expressions(spark, folder, duck):
    """The trees read from a model give what the model gives, and SQL over them chooses the same destinations."""
    t = Source(spark, folder)
    features = trip_features(trips(t), locations(t))
    # Vehicles without a battery are learned from too.
    features = features.unionByName(features.limit(50).withColumn("battery_diff", F.lit(None).cast("int")))
    scaler, lat, lng, rows = DestinationModel.learn(features, seed=7, rounds=4, depth=3)
    model = DestinationModel.load(DestinationModel.of(scaler, lat, lng).saved())
    raw = {f"_f{i}": F.expr(text) for i, text in enumerate(DestinationModel._raw())}
    known = VectorAssembler(inputCols=list(raw), outputCol="_raw").transform(features.withColumns(raw)).drop(*raw)
    known = VectorAssembler(inputCols=["lat_lend", "lng_lend", "_scaled"], outputCol="_x").transform(scaler.transform(known))
    fitted = lng.transform(lat.transform(known)).withColumnsRenamed({"_plat": "_fitted_lat", "_plng": "_fitted_lng"}).drop("_x", "_raw", "_scaled")
    both = model.transform(fitted)
    off = both.agg(F.count("*").alias("n"), F.max(F.abs(F.col("_plat") - F.col("_fitted_lat"))).alias("lat"),
                   F.max(F.abs(F.col("_plng") - F.col("_fitted_lng"))).alias("lng"), F.count_distinct("_plat").alias("places")).first()
    assert off.n == features.count() and off.places > 10 and max(off.lat, off.lng) < 1e-9
    chosen = check.compare(predict_destination(context.candidates(t), model), duck, with_adapters(context.destination_sql(model)))
    assert isinstance(chosen, int) and chosen > 0, chosen
    made = check.compare(rotating_trips(t("sightings"), locations(t), model, NETWORKS), duck, with_adapters(context.rotating_trips_sql(model)))
    assert made == chosen


def test_rows_only_queries_are_the_fitted_ones():
    assert sorted(set(QUERIES) - set(ORACLE)) == ["f2_predict_destination", "f3_rotating_trips"]
