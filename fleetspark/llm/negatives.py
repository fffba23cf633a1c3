"""Hard negatives by a vertical scan with branch and bound over columns.

Vectors are whole numbers and lie in tiles, dimension by dimension. An anchor reads the columns of a tile in descending
order of its own components' magnitude and adds up partial scores. What the dimensions not read yet can add at least and
at most follows from the smallest and largest number of each column; rows whose bounds rule them out leave the bitmap of
candidates. The rows left after the last column have their exact scores.

Two scans: first the best rows of an anchor's own label, its positives; then, for each positive, the best rows of other
labels whose score lies in a window below the positive's. A row is out of a window when its bounds miss it, or when enough
rows certainly inside score more. Every tile of anchors meets every tile of rows once; what a pair of tiles returns is a
few rows per anchor, ranked again over all tiles.

Defined results: rows with a null id, label or vector, or a null or non-finite component take no part, nor those with a
component of 2**24 or more (of the whole numbers), whose scores could exceed a long; missing dimensions of shorter vectors
count as 0; of rows with one id the least (label, then vector) stands for all, so repeated rows count once; ties go to the
smaller id; an anchor without positives, or a positive without negatives, has no rows; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from fleetspark.llm.common import splits, table
from fleetspark.session import stored

LARGEST = 1 << 24


@dataclass(frozen=True)
class Mining:
    """Negatives lie between ``low`` and ``high`` percent of the positive's score."""

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95
    row_tile: int = 4096
    anchor_tile: int = 512
    step: int = 8  # columns read between two looks at the bounds


class Tile:
    """Rows of a tile as columns: ids, labels, and one line of numbers per dimension with its smallest and largest."""

    def __init__(self, rows: pa.StructArray):
        self.ids = rows.field("vec_id").to_numpy()
        self.labels = rows.field("label").to_numpy()
        vectors = rows.field("q")
        sizes = vectors.value_lengths().to_numpy()
        self.columns = np.zeros((int(sizes.max(initial=0)), len(self.ids)), np.int64)
        row = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.columns[place, row] = vectors.flatten().to_numpy()
        self.least, self.most = self.columns.min(axis=1), self.columns.max(axis=1)


def vertical_scan(anchor: np.ndarray, tile: Tile, bitmap: np.ndarray, keep, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and exact scores of the rows of ``bitmap`` that ``keep(lower, upper)`` leaves over to the last column."""
    size = min(len(anchor), len(tile.columns))
    order = np.argsort(-np.abs(anchor[:size]), kind="stable")
    weight = anchor[order]
    low = np.minimum(weight * tile.least[order], weight * tile.most[order])
    high = np.maximum(weight * tile.least[order], weight * tile.most[order])
    low, high = low.sum() - np.cumsum(low), high.sum() - np.cumsum(high)
    at = np.flatnonzero(bitmap)
    score = np.zeros(len(at), np.int64)
    for start in range(0, size, step):
        read = slice(start, min(start + step, size))
        for column, w in zip(order[read], weight[read]):
            values = tile.columns[column]
            score += w * (values if len(at) == len(values) else values[at])
        left = keep(score + low[read.stop - 1], score + high[read.stop - 1])
        if not left.all():
            at, score = at[left], score[left]
            if not len(at):
                break
    return at, score


def best_first(ids: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
    """Positions of the ``n`` highest scores, ties by smaller id."""
    return np.lexsort((ids, -scores))[:n]


def _at_best(n: int):
    def keep(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        if len(lower) <= n:
            return np.ones(len(lower), bool)
        return upper >= np.partition(lower, -n)[-n]

    return keep


def _in_windows(windows: list[tuple[int, int]], n: int):
    def keep(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        kept = np.zeros(len(lower), bool)
        for low, high in windows:
            possible = (upper >= low) & (lower <= high)
            certain = lower[(lower >= low) & (upper <= high)]
            if len(certain) > n:
                possible &= upper >= np.partition(certain, -n)[-n]
            kept |= possible
        return kept

    return keep


def window(positive: int, m: Mining) -> tuple[int, int]:
    """Smallest and largest score of a negative."""
    return -(-m.low * positive // 100), m.high * positive // 100


def _positives(anchors: Tile, rows: Tile, m: Mining, _) -> Iterator[tuple]:
    for i, anchor in enumerate(anchors.ids):
        own = (rows.labels == anchors.labels[i]) & (rows.ids != anchor)
        at, score = vertical_scan(anchors.columns[:, i], rows, own, _at_best(m.positives), m.step)
        for j in best_first(rows.ids[at], score, m.positives):
            yield anchor, rows.ids[at[j]], score[j]


def _negatives(anchors: Tile, rows: Tile, m: Mining, positives: list) -> Iterator[tuple]:
    for i, anchor in enumerate(anchors.ids):
        found = [(x["positive_id"], x["positive_score"], *window(x["positive_score"], m)) for x in positives[i]]
        found = [x for x in found if x[2] <= x[3]]
        if not found:
            continue
        other = rows.labels != anchors.labels[i]
        at, score = vertical_scan(
            anchors.columns[:, i], rows, other, _in_windows(sorted({x[2:] for x in found}), m.negatives), m.step)
        for positive, positive_score, low, high in found:
            inside = np.flatnonzero((score >= low) & (score <= high))
            for j in inside[best_first(rows.ids[at[inside]], score[inside], m.negatives)]:
                yield anchor, positive, positive_score, rows.ids[at[j]], score[j]


def _tiled(rows: DataFrame, number: int, name: str) -> DataFrame:
    fields = F.struct(*[c for c in rows.columns])
    return stored(rows.groupBy(F.pmod(F.xxhash64("vec_id"), F.lit(number)).cast("int").alias("tile")).agg(
        F.collect_list(fields).alias("members")), name)


def _scanned(anchors: DataFrame, n_anchors: int, rows: DataFrame, n_rows: int, scan, names: list[str], m: Mining) -> DataFrame:
    """``scan`` of every pair of an anchor tile and a row tile."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    tasks = max(splits(rows.sparkSession), n_anchors * n_rows // 4)
    left = anchors.select(F.col("tile").alias("a"), every(n_rows).alias("r"), F.col("members").alias("anchors"))
    right = rows.select(every(n_anchors).alias("a"), F.col("tile").alias("r"), F.col("members").alias("rows"))
    pairs = left.repartition(tasks, "a", "r").join(right.repartition(tasks, "a", "r"), ["a", "r"]).select("anchors", "rows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, r in zip(batch.column("anchors"), batch.column("rows")):
                given = a.values.field("positives").to_pylist() if "positives" in [f.name for f in a.values.type] else None
                found = list(scan(Tile(a.values), Tile(r.values), m, given))
                columns = zip(*found) if found else [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(np.array(c, np.int64)) for c in columns], names)

    return pairs.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _ranked(found: DataFrame, by: list[str], score: str, of: str, n: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc(score), of)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def hard_negatives(vectors: DataFrame, anchor: str, m: Mining = Mining()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of whole-number vectors.

    ``vectors`` has vec_id, label and q (array of longs); ``anchor`` is a condition on vec_id.
    """
    sound = F.coalesce(F.forall("q", lambda x: x.isNotNull() & (F.abs(x) < LARGEST)), F.lit(False))
    one = vectors.where("vec_id IS NOT NULL AND label IS NOT NULL").where(sound).groupBy("vec_id").agg(
        F.min(F.struct(F.col("label").cast("long").alias("label"), F.col("q").cast("array<int>").alias("q"))).alias("row"))
    rows = stored(one.select("vec_id", "row.label", "row.q"), "whole-vectors")
    anchors = rows.where(anchor)
    n_rows, n_anchors = 1 + rows.count() // m.row_tile, 1 + anchors.count() // m.anchor_tile
    tiles = _tiled(rows, n_rows, "row-tiles")
    near = _scanned(_tiled(anchors, n_anchors, "anchor-tiles"), n_anchors, tiles, n_rows, _positives,
                    ["anchor_id", "positive_id", "positive_score"], m)
    positives = _ranked(near, ["anchor_id"], "positive_score", "positive_id", m.positives)
    listed = stored(positives.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives")),
                    "positives")
    asking = anchors.join(listed, F.expr("vec_id = anchor_id")).drop("anchor_id")
    far = _scanned(_tiled(asking, n_anchors, "asking-tiles"), n_anchors, tiles, n_rows, _negatives,
                   ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"], m)
    return _ranked(far, ["anchor_id", "positive_id"], "negative_score", "negative_id", m.negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(spark, folder):
    given = table(spark, folder, "embeddings").select(
        "vec_id", F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = given.where("label IS NOT NULL AND v IS NOT NULL").where(finite).select(
        "vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        F.transform("v", lambda x: F.when(F.abs(x) < LARGEST, F.floor(256 * x)).otherwise(LARGEST)).alias("q"))
    return hard_negatives(whole, "vec_id % 50 = 0")


# DuckDB: all scores by brute force.
OP12_SQL = """
WITH v AS (SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
r AS (SELECT vec_id, (m).label AS label, (m).q AS q FROM (SELECT vec_id, min({'label': label, 'q': q}) AS m FROM v GROUP BY 1)),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS own,
    coalesce(list_sum(list_transform(range(1, least(len(a.q), len(b.q)) + 1), lambda i: a.q[i] * b.q[i])), 0)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::INT AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT own AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 3
"""
