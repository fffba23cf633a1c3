"""Mixing sources to target weights by pivotal rounding of copy numbers.

Every source gets a share of the mix by weight, no more than ``most`` times its size; what is above is shared again.
A document of a source should then be taken target / size times. Whole copies are certain; the fractions are rounded by
the pivotal method on masses: two documents exchange mass (size times fraction) in a random direction, such that the
expected fractions stay, until one of the fractions is 0 or 1. The sum of masses never changes. Groups of some thousand
documents do this apart, each leaves one open fraction at most, and these meet in groups again until each source has one
left, which is rounded to the nearer side. Larger documents go first, so the open one tends to be small.

Defined results: a null text has size 0; documents without words are taken zero times, whatever their copies; null
sources are one source, after all others; rows equal in id, source and text are rounded together and share their copies
evenly; the random choices depend on the rows only, so reruns agree. An empty table gives an empty table.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetspark.llm.common import full, numbered, same, table
from fleetspark.session import stored

WEIGHTS = (3, 1, 2)
GROUP = 4096


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Per source its place in code point order, size, weight and target; ``sizes`` has source and size."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    sources = stored(
        numbered(totals, [F.col("source").asc_nulls_last()], "place", "sources").withColumn("weight", weight), "sources")
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * share
    cap = F.col("source_size") * most
    rate, capped = 0.0, -1
    while True:
        full_ones = F.col("weight") * rate >= cap
        n, held, open_weight = sources.agg(
            F.count_if(full_ones), F.coalesce(F.sum(F.when(full_ones, cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full_ones, F.col("weight"))), F.lit(0))).first()
        if n == capped or not open_weight:
            break
        rate, capped = (total - held) / open_weight, n
    return sources.withColumn("target", F.least(cap.cast("double"), F.col("weight") * F.lit(rate)))


def pivotal(masses: list[tuple[float, float]], chance: random.Random) -> list[float]:
    """Rounds (size, fraction) pairs in order; all results but one at most are 0.0 or 1.0, the sum of masses stays."""
    out = [f for _, f in masses]
    left = None
    for i, (size, fraction) in enumerate(masses):
        if left is None:
            left = i if 0.0 < fraction < 1.0 else None
            continue
        a, p, q = masses[left][0], out[left], fraction
        up, down = min(a * (1 - p), size * q), min(a * p, size * (1 - q))
        gain = up if chance.random() * (up + down) < down else -down
        p, q = p + gain / a, q - gain / size
        # The one that reached an end is set there exactly.
        near_p, near_q = min(p, 1 - p) * a, min(q, 1 - q) * size
        if near_p <= near_q:
            p = float(round(p))
        if near_q <= near_p:
            q = float(round(q))
        out[left], out[i] = p, q
        if 0.0 < q < 1.0:
            left = i
        elif not 0.0 < p < 1.0:
            left = None
    return out


UNIT = "place long, key long, id long, size long, groups long, fraction double"


def _round(units: DataFrame, group: int) -> DataFrame:
    """``units`` with fractions rounded to 0.0 or 1.0, level by level; groups is their number in the source."""
    done = None
    level = 0
    while True:
        stage = units.withColumn("bucket", F.pmod(F.xxhash64("key", "id", F.lit(level)), "groups"))

        def settle(rows: pa.Table) -> pa.Table:
            ordered = rows.sort_by([("size", "descending"), ("key", "ascending"), ("id", "ascending")])
            place, bucket = ordered["place"][0].as_py(), ordered["bucket"][0].as_py()
            chance = random.Random(f"{place} {bucket} {level}")
            found = pivotal(list(zip(*(ordered[x].to_pylist() for x in ("size", "fraction")))), chance)
            if ordered["groups"][0].as_py() == 1:
                found = [float(round(f)) for f in found]
            at = ordered.schema.get_field_index("fraction")
            return ordered.set_column(at, "fraction", pa.array(found, pa.float64())).drop_columns(["bucket"])

        settled = stored(stage.groupBy("place", "bucket").applyInArrow(settle, UNIT), "rounded")
        ended = settled.where("fraction = 0 OR fraction = 1")
        done = ended if done is None else done.unionByName(ended)
        units = settled.where("fraction > 0 AND fraction < 1").withColumn("groups", F.ceil(F.col("groups") / group).cast("long"))
        level += 1
        if units.isEmpty():
            return done


def copies(docs: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text",
           weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, group: int = GROUP) -> DataFrame:
    """One row per id, source and text: key (hash of the text), rows, size, source_size, target, and copies of all its rows."""
    measured = stored(docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(source).alias("source"), F.xxhash64(full(text)).alias("key"),
        F.regexp_count(full(text), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long").alias("size")), "sizes")
    targets = source_targets(measured, weights, share, most).withColumnRenamed("source", "of")
    rows = stored(measured.groupBy("id", "source", "key", "size").agg(F.count("*").alias("count")), "rows")
    rate = F.col("target") / F.col("source_size") * F.col("count")
    units = rows.join(targets, same(rows, targets, [("source", "of")])).select(
        "place", "id", "source", "key", "size", "count", "source_size", "target",
        F.ceil(F.col("rows") / group).cast("long").alias("groups"),
        F.when(F.col("size") > 0, F.floor(rate)).otherwise(0).cast("long").alias("whole"),
        F.when(F.col("size") > 0, rate - F.floor(rate)).otherwise(0.0).alias("fraction"))
    units = stored(units, "units")
    # Equal rows are one unit whose mass is that of one more copy.
    open_units = units.where("fraction > 0").select(
        "place", "key", F.coalesce("id", F.lit(-1 << 63)).alias("id"), "size", "groups", "fraction")
    rounded = _round(open_units, group).select(
        F.col("place").alias("p"), F.col("key").alias("k"), F.col("id").alias("i"), F.col("fraction").alias("more"))
    found = units.join(
        rounded, (units["place"] == rounded["p"]) & (units["key"] == rounded["k"])
        & (F.coalesce(units["id"], F.lit(-1 << 63)) == rounded["i"]), "left")
    return found.select("id", "source", "key", "count", "size", "source_size", "target",
                        (F.col("whole") + F.coalesce("more", F.lit(0.0)).cast("long")).alias("copies"))


def take_counts(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: id, size, source_size, target, copies and taken (words in the mix)."""
    units = copies(docs, **options)
    shared = F.floor(F.col("copies") / F.col("count")) + (F.col("nth") < F.col("copies") % F.col("count")).cast("long")
    each = units.withColumn("nth", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)))
    return each.select(F.col("id").alias("doc_id"), "source", "size", "source_size", "target",
                       shared.alias("copies"), (shared * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, each as often as it is taken."""
    units = stored(copies(docs, id_col, source, text, **options).select(
        F.col("id").alias("_llm_i"), F.col("source").alias("_llm_s"), F.col("key").alias("_llm_k"),
        F.col("count").alias("_llm_n"), F.col("copies").alias("_llm_c")).where("copies > 0"), "copies")
    marked = docs.withColumn("_llm_hash", F.xxhash64(full(text)))

    def taken(rows: DataFrame, which: DataFrame) -> DataFrame:
        on = (rows["_llm_hash"] == which["_llm_k"]) & rows[id_col].cast("long").eqNullSafe(which["_llm_i"])
        return rows.join(which, on & rows[source].eqNullSafe(which["_llm_s"]))

    repeated = units.where("_llm_n > 1")
    once = taken(marked, units.where("_llm_n = 1"))
    alike = taken(marked, repeated).dropDuplicates([id_col, source, "_llm_hash"])
    both = once.unionByName(alike).withColumn("_llm_nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_llm_c"))))
    return both.select(*docs.columns)


def op7_mix_sources(spark, folder):
    return take_counts(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")
