"""SimHash near-dedup by exact comparison of fingerprint tiles.

Distinct fingerprints are dealt into tiles that agree in the population counts of both halves. Two tiles are compared
only if those counts differ by no more than the radius together; all other pairs cannot be near. A pair of tiles is
compared with exclusive-or and bit counts in numpy and returns a spanning forest of its links, never all of them.
The work is quadratic in the number of distinct fingerprints, less the skipped tile pairs.

Defined results: null and empty texts have fingerprint 0 and link like any other; component_id is the smallest id of
the group, null only if all its ids are null; repeated rows get the same result each; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from fleetspark.llm.common import full, small_batches, table
from fleetspark.llm.components import components
from fleetspark.session import stored

SEED = 42
CHUNK = 1 << 16
PAIRS_PER_TASK = 64


def fingerprint(data: bytes, shingle: int) -> int:
    """64 majority bits over the hashes of all runs of ``shingle`` words, repeats included."""
    from xxhash import xxh64_intdigest

    words = data.lower().split()  # of bytes: A-Z, and the six blanks that separate words
    if not words:
        return 0
    if len(words) < shingle:
        runs = iter([b" ".join(words)])
        n = 1
    else:
        runs = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
        n = len(words) - shingle + 1
    ones = np.zeros(64, np.int64)
    for start in range(0, n, CHUNK):
        size = min(CHUNK, n - start)
        hashes = np.fromiter((xxh64_intdigest(next(runs), SEED) for _ in range(size)), np.uint64, size)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(size, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = 3, name: str = "_llm_fp") -> DataFrame:
    """Adds the fingerprint as a long (the same 64 bits, signed)."""

    def of_texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = np.fromiter((fingerprint((x.as_py() or "").encode(), shingle) for x in texts), np.uint64, len(texts))
            yield pa.array(found.view(np.int64))

    small_batches(docs.sparkSession)
    return docs.withColumn(name, F.arrow_udf(of_texts, "long")(F.col(text)))


def _forest(n: int, left: np.ndarray, right: np.ndarray, parent: list[int]) -> list[tuple[int, int]]:
    """The links that join two trees of the union-find ``parent``."""

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for x, y in zip(left.tolist(), right.tolist()):
        p, q = root(x), root(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            kept.append((x, y))
    return kept


def near_links(a: np.ndarray, b: np.ndarray, radius: int, rows: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two tiles of unsigned fingerprints (or inside one, if they are the same)."""
    n, inside = len(a) + len(b), a is b
    parent, links = list(range(n)), []
    for start in range(0, len(a), rows):
        near = np.bitwise_count(a[start:start + rows, None] ^ b[None, :]) <= radius
        r, c = np.nonzero(near)
        r += start
        if inside:
            r, c = r[c > r], c[c > r]
        if len(r) > 2 * len(b):
            # A dense group: each column keeps its first row, and rows are tied through shared columns.
            columns, first = np.unique(c, return_index=True)
            owner = np.zeros(len(b), np.int64)
            owner[columns] = r[first]
            tied = np.unique(r * np.int64(n) + owner[c])
            r, c = np.concatenate([r[first], tied // n]), np.concatenate([columns + len(a) * (not inside), tied % n])
        elif not inside:
            c = c + len(a)
        links += _forest(n, r, c, parent)
    if not links:
        return a[:0], a[:0]
    both = np.concatenate([a, b])
    pairs = np.array(links)
    return both[pairs[:, 0]], both[pairs[:, 1]]


def fingerprint_links(fingerprints: DataFrame, radius: int = 3, tile: int = 4096) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (column _llm_fp) within ``radius`` bits of each other."""
    cells = fingerprints.select(
        "_llm_fp", F.bit_count(F.shiftrightunsigned("_llm_fp", 32)).alias("hi"),
        F.bit_count(F.col("_llm_fp").bitwiseAND(F.lit(0xFFFFFFFF))).alias("lo"))
    # At most 33 * 33 rows.
    counts = cells.groupBy("hi", "lo").agg(F.ceil(F.count("*") / tile).alias("tiles"))
    dealt = cells.join(F.broadcast(counts), ["hi", "lo"]).withColumn("tile", F.pmod(F.xxhash64("_llm_fp"), "tiles"))
    tiles = stored(dealt.groupBy("hi", "lo", "tile").agg(F.collect_list("_llm_fp").alias("fps")), "tiles")
    steps = [(i, j) for i in range(radius + 1) for j in range(-radius, radius + 1)
             if i + abs(j) <= radius and (i > 0 or j >= 0)]
    step = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in steps]))
    left = tiles.withColumn("step", step).select(
        (F.col("hi") + F.col("step.i")).alias("hi"), (F.col("lo") + F.col("step.j")).alias("lo"),
        F.col("tile").alias("other"), F.expr("step.i = 0 AND step.j = 0").alias("own"), F.col("fps").alias("a"))
    matched = left.join(tiles, ["hi", "lo"]).where("NOT own OR other <= tile")
    pairs = matched.select("a", F.col("fps").alias("b"), F.expr("own AND other = tile").alias("same"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, alike in zip(*(batch.column(i) for i in range(3))):
                x = a.values.to_numpy(zero_copy_only=False).view(np.uint64)
                y = x if alike.as_py() else b.values.to_numpy(zero_copy_only=False).view(np.uint64)
                p, q = near_links(x, y, radius)
                yield pa.RecordBatch.from_arrays([pa.array(p.view(np.int64)), pa.array(q.view(np.int64))], ["a", "b"])

    # A row is a pair of tiles: dealt out evenly, as a few cells hold most of the pairs.
    tasks = 1 + matched.count() // PAIRS_PER_TASK
    return pairs.repartition(tasks).mapInArrow(compare, "a long, b long")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3,
                   tile: int = 4096) -> DataFrame:
    """id, _llm_text (hash of the text), fingerprint, component_id, and _llm_group (a fingerprint naming the group)."""
    marked = stored(
        with_fingerprint(docs, text, shingle)
        .select(F.col(id_col).alias("_llm_id"), F.xxhash64(full(text)).alias("_llm_text"), "_llm_fp"), "fingerprints")
    firsts = stored(marked.groupBy("_llm_fp").agg(F.min("_llm_id").alias("first")), "distinct-fingerprints")
    linked = stored(components(fingerprint_links(firsts, radius, tile), "a", "b"), "components")
    grouped = stored(
        firsts.join(linked, firsts["_llm_fp"] == linked["node"], "left")
        .select("_llm_fp", "first", F.coalesce("component", "_llm_fp").alias("_llm_group")), "grouped")
    smallest = stored(grouped.groupBy("_llm_group").agg(F.min("first").alias("component_id")), "smallest")
    named = stored(grouped.join(smallest, "_llm_group").select("_llm_fp", "_llm_group", "component_id"), "named")
    return marked.join(named, "_llm_fp").select(
        F.col("_llm_id").alias(id_col), "_llm_text", F.lower(F.lpad(F.hex("_llm_fp"), 16, "0")).alias("fingerprint"),
        "component_id", "_llm_group")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """One row of each group: the smallest id, then the smallest hash of its text; of equal rows one stays."""
    groups = simhash_groups(docs, id_col, text, shingle, radius).where(F.col("component_id").eqNullSafe(F.col(id_col)))
    keepers = groups.groupBy("_llm_group").agg(F.min(id_col).alias("_llm_id"), F.min("_llm_text").alias("_llm_hash")).select(
        "_llm_id", "_llm_hash")
    marked = docs.withColumn("_llm_hash", F.xxhash64(full(text)))
    found = marked.join(
        keepers, (marked[id_col].eqNullSafe(keepers["_llm_id"])) & (marked["_llm_hash"] == keepers["_llm_hash"]), "left_semi")
    return found.dropDuplicates([id_col, "_llm_hash"]).drop("_llm_hash")


def op8_simhash_near_dedup(spark, folder):
    return simhash_groups(table(spark, folder, "documents")).select("doc_id", "fingerprint", "component_id")
