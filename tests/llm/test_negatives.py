"""Hard negatives against all scores."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetspark.llm import negatives


def by_hand(rows, positives=5, negatives_=3):
    """rows: id -> (label, vector of whole numbers)."""
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a, (label, v) in rows.items():
        if a % 50:
            continue
        ranked = sorted((-score(v, w), b, own) for b, (own, w) in rows.items() if b != a)
        for minus, p, _ in [x for x in ranked if x[2] == label][:positives]:
            top = [(b, -m) for m, b, own in ranked if own != label and 50 * -minus <= 100 * -m <= 95 * -minus]
            out += [(a, p, k + 1, b, -minus, s) for k, (b, s) in enumerate(top[:negatives_])]
    return sorted(out)


def made(n=700, d=12, labels=4):
    r = np.random.default_rng(9)
    centre = r.normal(size=(labels * 2, d)) * 40
    found = {}
    for i in range(n):
        v = centre[i % len(centre)] + r.normal(size=d) * 25
        found[i] = (int(r.integers(labels)), [int(x) for x in v][:d - (i % 9 == 0) * 3])
    for i in range(n, n + 40):  # ties: equal vectors under other ids and labels
        found[i] = (i % labels, found[i - 600][1])
    found[50] = (0, [0] * d)
    found[100] = (1, [])
    found[150] = (9, found[150][1])  # no positives
    found[200] = (2, [-x for x in found[200][1]])
    return found


@pytest.mark.parametrize("m", [negatives.Mining(), negatives.Mining(row_tile=64, anchor_tile=4, step=3), negatives.Mining(row_tile=300, step=1)])
def test_all_scores(spark, m):
    rows = made()
    given = [(i, label, v, "x", 1) for i, (label, v) in rows.items()]
    given += given[:60]  # repeated rows
    given += [(3, 8, [1] * 12, "y", 2), (None, 1, [5] * 12, "y", 2), (2000, None, [5] * 12, "y", 2), (2050, 1, None, "y", 2), (2100, 1, [None] * 12, "y", 2)]
    if rows[3][0] > 8:
        rows[3] = (8, [1] * 12)
    df = spark.createDataFrame(given, "vec_id long, label int, q array<long>, tile string, rank int").repartition(3)
    out = negatives.hard_negatives(df, "vec_id % 50 = 0", m).collect()
    assert sorted(tuple(x) for x in out) == by_hand(rows)


def test_bounds_leave_the_best(spark):
    """The scan ends with exact scores of all rows that may be asked for, and drops others on the way."""
    import pyarrow as pa

    rows = made(900, 24)
    kind = pa.struct([("vec_id", pa.int64()), ("label", pa.int64()), ("q", pa.list_(pa.int32()))])
    tile = negatives.Tile(pa.array([{"vec_id": i, "label": x, "q": v} for i, (x, v) in rows.items()], kind))
    anchor = tile.columns[:, 77]
    exact = anchor @ tile.columns
    at, score = negatives.vertical_scan(anchor, tile, np.ones(len(exact), bool), negatives._at_best(5), 4)
    assert (exact[at] == score).all() and set(np.argsort(-exact, kind="stable")[:5]) <= set(at) and len(at) < len(exact) / 2


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, label int, q array<long>")
    assert negatives.hard_negatives(df, "vec_id % 50 = 0").count() == 0


def test_query_input(spark, tmp_path):
    """Null, non-finite and far too large components; ids divisible by seven change their label."""
    r = np.random.default_rng(2)
    rows = [(i, [float(x) for x in r.normal(size=6)], i % 3) for i in range(300)]
    odd = [(301, None, 1), (302, [None] * 6, 1), (303, [float("nan")] * 6, 1), (304, [float("inf")] * 6, 1), (305, [1e30] * 6, 1), (306, [1.0] * 6, None)]
    spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    whole = {i: ((x + 1) % 10 if i % 7 == 0 else x, [int(np.floor(256 * y)) for y in v]) for i, v, x in rows}
    out = negatives.op12_hard_negatives(spark, str(tmp_path)).select(
        "anchor_id", "positive_id", "rank", "negative_id", F.col("positive_score"), "negative_score").collect()
    assert sorted(tuple(x) for x in out) == by_hand(whole)
