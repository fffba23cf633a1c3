"""Embedding near-dedup over a robust-pruned flat graph.

Equal vectors are one node. Centroids fitted on a bounded sample cut the nodes into overlapping shards: a node belongs to
the ``overlap`` shards it is nearest to. A shard of more than ``block`` nodes is cut again, by centroids fitted on a sample
of its own, and so are its parts, so that the number of shards follows the number of nodes. A shard whose sample is dense,
with one pair in ``dense`` or more in range, stays whole: searching all its pairs costs no more than its links do. Every shard builds a graph: nearest candidates thinned by robust pruning, reverse
links, and well-spread links of its medoids. The adjacency lists that a node got in its shards are united. Every node
is then a query: a greedy search from the medoids follows the lists, and goes on past its beam while what it expands is
within range. Found pairs are verified in double precision, and counted in one shard only, the first that both share.
Whole shards of more than ``block`` nodes are dealt into blocks at random, and all pairs of blocks are searched, so nothing is left out.

A recall audit compares nodes that hold an id divisible by ``audit_every``, about ``audited`` of them, with all nodes, in blocks.

Defined results: vectors that are null, empty, zero, or hold a null, NaN or infinity link with nothing; vectors of
different lengths do not link; equal rows get the same result each and count as links of each other; null ids count in
links and never name a component unless all its ids are null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fleetspark.llm.common import table
from fleetspark.llm.components import components
from fleetspark.llm.simhash import _forest
from fleetspark.session import stored


@dataclass(frozen=True)
class Search:
    threshold: float = 0.9
    sample: int = 20_000  # vectors that centroids are fitted on
    shard: int = 1000  # nodes per centroid aimed at
    shards: int = 256  # centroids at most of the first cut; later ones cut on
    overlap: int = 4
    cut: int = 64  # centroids at most of a later cut, of each shard
    cut_sample: int = 1024  # nodes these are fitted on, about
    cut_overlap: int = 2
    dense: int = 16
    audited: int = 2048
    block: int = 2048  # nodes searched together
    medoids: int = 16
    candidates: int = 32
    degree: int = 16
    alpha: float = 1.2
    beam: int = 32


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(column: pa.Array) -> np.ndarray:
    """Rows of equal length as unit vectors; scaled first, so that squares stay finite."""
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit_centroids(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means from evenly spaced rows."""
    centres = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = np.argmax(x @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        norm = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(norm > 1e-9, sums / np.maximum(norm, 1e-9), centres)
    return centres


def _prune(sims: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Robust pruning of candidates in order of nearness, for all nodes at once: kept ones, -1 elsewhere."""
    distance = 2 - 2 * np.take_along_axis(sims, cand, axis=1)
    alive, kept = np.ones(cand.shape, bool), np.zeros(cand.shape, bool)
    for j in range(cand.shape[1]):
        chosen = alive[:, j] & (kept.sum(axis=1) < degree)
        kept[:, j] = chosen
        between = 2 - 2 * sims[cand[:, j][:, None], cand]
        alive &= ~(chosen[:, None] & (alpha * between <= distance))
    return np.where(kept, cand, -1)


def build_graph(x: np.ndarray, s: Search) -> tuple[list[np.ndarray], np.ndarray]:
    """Adjacency lists of unit vectors, and which rows are medoids."""
    n = len(x)
    sims = x @ x.T
    medoids = np.unique(np.argmax(fit_centroids(x, min(s.medoids, n), 4) @ x.T, axis=1))
    if n == 1:
        return [np.zeros(0, np.int64)], medoids
    c = min(s.candidates, n - 1)
    masked = sims.copy()
    np.fill_diagonal(masked, -2)
    near = np.argpartition(-masked, c - 1, axis=1)[:, :c]
    # Far candidates keep dense groups from being islands.
    cand = np.concatenate([near, np.broadcast_to(medoids, (n, len(medoids)))], axis=1)
    score = np.take_along_axis(masked, cand, axis=1)
    cand = np.take_along_axis(cand, np.argsort(-score, axis=1, kind="stable"), axis=1)
    out = _prune(sims, cand, s.degree, s.alpha)
    left, at = np.nonzero((out >= 0) & (out != np.arange(n)[:, None]))
    right = out[left, at]
    pairs = np.unique(np.concatenate([left * n + right, right * n + left]))
    left, right = pairs // n, pairs % n
    order = np.lexsort((-sims[left, right], left))
    left, right = left[order], right[order]
    starts = np.searchsorted(left, np.arange(n + 1))
    lists = [right[a:b][:2 * s.degree] for a, b in zip(starts[:-1], starts[1:])]
    for m in medoids:
        # Spread over the whole block: each next link is the nearest that the ones before do not cover.
        alive, spread = np.ones(n, bool), []
        alive[m] = False
        own = 2 - 2 * sims[m]
        while alive.any() and len(spread) < 8 * s.degree:
            p = int(np.argmin(np.where(alive, own, np.inf)))
            spread.append(p)
            alive &= s.alpha * (2 - 2 * sims[p]) > own
            alive[p] = False
        lists[m] = np.union1d(lists[m], spread)
    return lists, medoids


def range_search(queries: np.ndarray, x: np.ndarray, lists: list[np.ndarray], medoids: np.ndarray, s: Search,
                 rows: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, node) found within range by greedy search from the medoids."""
    n = len(x)
    width = max(1, max(len(a) for a in lists))
    table_ = np.full((n, width), -1, np.int64)
    for i, a in enumerate(lists):
        table_[i, :len(a)] = a
    reach = s.threshold - 1e-6
    found_q, found_n = [], []
    for start in range(0, len(queries), rows):
        q = queries[start:start + rows]
        near = np.full((len(q), n), -2.0)
        near[:, medoids] = q @ x[medoids].T
        open_ = near.copy()  # what is seen and not expanded yet
        expanded, step = 0, 4
        while True:
            k = min(step, n)
            best = np.argpartition(-open_, k - 1, axis=1)[:, :k]
            value = np.take_along_axis(open_, best, axis=1)
            # The beam first; beyond it a query goes on only inside its range.
            go = (value > -2) & ((expanded < s.beam) | (value >= reach))
            who, at = np.nonzero(go)
            if not len(who):
                break
            node = best[who, at]
            open_[who, node] = -2
            expanded += k
            if expanded >= s.beam:
                step = 32  # whole groups within range
            following = table_[node]
            who = np.repeat(who, width)[(following >= 0).ravel()]
            pairs = np.unique(who * n + following[following >= 0])
            who, node = pairs // n, pairs % n
            fresh = near[who, node] == -2
            who, node = who[fresh], node[fresh]
            for a in range(0, len(who), 100_000):
                i, j = who[a:a + 100_000], node[a:a + 100_000]
                near[i, j] = open_[i, j] = np.einsum("ij,ij->i", q[i], x[j])
        r, c = np.nonzero(near >= reach)
        found_q.append(r + start)
        found_n.append(c)
    return np.concatenate(found_q), np.concatenate(found_n)


def _verified(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    keep = [np.einsum("ij,ij->i", a[i[k:k + 100_000]], b[j[k:k + 100_000]]) >= threshold for k in range(0, len(i), 100_000)]
    return np.concatenate([*keep, np.zeros(0, bool)])


MEMBER = "shard long, node long, weight long, vec array<double>"
DIGITS = 512  # a shard's number continues that of the shard it was cut from by one digit, from 1 on
CUTS = 6  # digits that fit into a long beside the first; what is larger after these stays whole
FOUND = "a long, b long, n long"


def _dealt(near: np.ndarray, first: int, node: pa.Array, weight: pa.Array, vec: pa.Array, overlap: int) -> dict[str, pa.Array]:
    """A row for each of the nearest centroids of a node; ``first`` is the number of the shard at the first centroid."""
    k = min(overlap, near.shape[1])
    best = np.argpartition(-near, k - 1, axis=1)[:, :k]
    again = pa.array(np.repeat(np.arange(len(near)), k))
    return {"shard": pa.array(best.ravel().astype(np.int64) + first), "node": node.take(again), "weight": weight.take(again), "vec": vec.take(again)}


def _members(nodes: DataFrame, centres: np.ndarray, overlap: int) -> DataFrame:
    """A row for each shard of a node."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                node, weight, vec = batch.columns
                yield pa.RecordBatch.from_pydict(_dealt(unit(vec) @ centres.T, 1, node, weight, vec, overlap))

    return nodes.select("node", "weight", "vec").mapInArrow(assign, MEMBER)


def _cut(members: DataFrame, s: Search) -> DataFrame:
    """Members of shards that one search can hold, and of those that are dense: large shards are cut, then their parts."""
    done = None
    for level in range(CUTS):
        sizes = stored(members.groupBy("shard").agg(F.count("*").alias("size")), "sizes")
        large = sizes.where(F.col("size") > s.block)
        if large.isEmpty():
            break
        rate = F.ceil(F.col("size") / s.cut_sample)
        sample = members.join(large, "shard").where(F.pmod(F.xxhash64("node", F.lit(level + 2)), rate) == 0)

        def fit(rows: pa.Table) -> pa.Table:
            rows = rows.sort_by("node").combine_chunks()
            x, size = unit(rows["vec"].chunk(0)), rows["size"][0].as_py()
            linked = ((x @ x.T >= s.threshold).sum() - len(x)) / max(1, len(x) * (len(x) - 1))
            if linked * s.dense >= 1 or len(x) < 4 * s.cut_overlap:
                return pa.table({"shard": rows["shard"][:0], "size": rows["size"][:0], "centres": pa.array([], pa.list_(pa.float64()))})
            # Parts are a small fraction of the whole even though they overlap.
            k = min(s.cut, len(x), max(8 * s.cut_overlap, -(-s.cut_overlap * size // s.shard)))
            return pa.table({"shard": rows["shard"][:1], "size": rows["size"][:1], "centres": pa.array([fit_centroids(x, k).ravel()])})

        # The sample of a shard and its centroids are bounded, their number is not.
        fitted = stored(sample.select("shard", "node", "size", "vec").groupBy("shard").applyInArrow(
            fit, "shard long, size long, centres array<double>"), "centroids")
        if fitted.isEmpty():
            break
        chunks = F.ceil(F.col("size") / (4 * s.block)).cast("int")
        given = fitted.select("shard", "centres", F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk"))
        moved = members.join(fitted.select("shard", chunks.alias("chunks")), "shard").withColumn(
            "chunk", F.pmod(F.xxhash64("node", F.lit(1)), "chunks").cast("int"))

        def part(rows: pa.Table, centroids: pa.Table) -> pa.Table:
            if not rows.num_rows:
                return pa.schema([("shard", pa.int64()), ("node", pa.int64()), ("weight", pa.int64()), ("vec", pa.list_(pa.float64()))]).empty_table()
            rows = rows.combine_chunks()
            x = unit(rows["vec"].chunk(0))
            centres = centroids["centres"].combine_chunks().flatten().to_numpy().reshape(-1, x.shape[1])
            first = rows["shard"][0].as_py() * DIGITS + 1
            return pa.table(_dealt(x @ centres.T, first, rows["node"].chunk(0), rows["weight"].chunk(0), rows["vec"].chunk(0), s.cut_overlap))

        parts = stored(moved.select("shard", "chunk", "node", "weight", "vec").groupBy("shard", "chunk").cogroup(
            given.groupBy("shard", "chunk")).applyInArrow(part, MEMBER), "parts")
        kept = members.join(fitted.select("shard"), "shard", "left_anti")
        done = kept if done is None else done.unionByName(kept)
        members = parts
    return members if done is None else done.unionByName(members)


def _search_blocks(members: DataFrame, s: Search) -> DataFrame:
    """Links found in all shards: rows (a, b, null) that connect, and rows (a, null, number of links)."""
    counts = members.groupBy("shard").agg(F.ceil(F.count("*") / s.block).cast("int").alias("blocks"))
    dealt = stored(members.join(counts, "shard").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int")), "members")

    def build(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("node").combine_chunks()
        node = rows["node"].to_numpy()
        lists, medoids = build_graph(unit(rows["vec"].chunk(0)), s)
        offsets = np.concatenate([[0], np.cumsum([len(a) for a in lists])]).astype(np.int32)
        flat = np.concatenate([*lists, np.zeros(0, np.int64)]).astype(np.int64)
        chief = np.zeros(len(node), bool)
        chief[medoids] = True
        return pa.table({"shard": rows["shard"], "node": rows["node"], "chief": pa.array(chief),
                         "near": pa.ListArray.from_arrays(pa.array(offsets), pa.array(node[flat]))})

    built = stored(dealt.groupBy("shard", "block").applyInArrow(build, "shard long, node long, chief boolean, near array<long>"), "graphs")
    # A node has at most the overlaps of all cuts of shards.
    united = built.groupBy("node").agg(
        F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"), F.sort_array(F.collect_list("shard")).alias("shards"))
    chiefs = built.where("chief").select("shard", "node", "chief")
    graph = dealt.join(united, "node").join(chiefs, ["shard", "node"], "left")
    # Every pair of blocks of a shard is a unit; a shard of one block is one unit.
    units = graph.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "shard", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "node", "weight",
        "shards", "vec", "near", F.coalesce("chief", F.lit(False)).alias("chief"))

    def search(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("block", "ascending"), ("node", "ascending")]).combine_chunks()
        shard, node, block = rows["shard"][0].as_py(), rows["node"].to_numpy(), rows["block"].to_numpy()
        weight, x = rows["weight"].to_numpy(), unit(rows["vec"].chunk(0))
        sizes = rows["shards"].chunk(0).value_lengths().to_numpy()
        shards = np.zeros((len(node), sizes.max()), np.int64)
        shards[np.arange(shards.shape[1]) < sizes[:, None]] = rows["shards"].chunk(0).flatten().to_numpy()
        chief, near = rows["chief"].to_numpy(zero_copy_only=False), rows["near"].chunk(0)
        parts = [np.flatnonzero(block == b) for b in np.unique(block)]
        if len(parts) == 1 and rows["lo"][0].as_py() != rows["hi"][0].as_py():
            parts = []  # the other block is empty, and this one has a unit of its own
        left, right = [], []
        for graph_part in parts:
            query_part = graph_part if len(parts) == 1 else parts[0] if graph_part is parts[1] else parts[1]
            ids = node[graph_part]
            lists = []
            for i in graph_part.tolist():
                wanted = near[i].values.to_numpy()
                at = np.minimum(np.searchsorted(ids, wanted), len(ids) - 1)
                lists.append(at[ids[at] == wanted])
            q, n = range_search(x[query_part], x[graph_part], lists, np.flatnonzero(chief[graph_part]), s)
            left.append(query_part[q])
            right.append(graph_part[n])
        none = np.zeros(0, np.int64)
        i, j = np.concatenate([*left, none]), np.concatenate([*right, none])
        # A link found from either side counts; once, in the first shard that both nodes share.
        pairs = np.unique(np.minimum(i, j) * len(node) + np.maximum(i, j))
        i, j = pairs // len(node), pairs % len(node)
        i, j = i[i != j], j[i != j]
        mine = np.zeros(len(i), bool)
        for a in range(0, len(i), 100_000):
            one, two = shards[i[a:a + 100_000]], shards[j[a:a + 100_000]]
            common = np.where((one[:, :, None] == two[:, None, :]).any(axis=2) & (one > 0), one, np.int64(2**63 - 1)).min(axis=1)
            mine[a:a + 100_000] = common == shard
        i, j = i[mine], j[mine]
        good = _verified(x, x, i, j, s.threshold)
        i, j = i[good], j[good]
        links = np.bincount(i, weights=weight[j], minlength=len(node)) + np.bincount(j, weights=weight[i], minlength=len(node))
        linked = np.flatnonzero(links)
        tree = np.array(_forest(len(node), i, j, list(range(len(node)))), np.int64).reshape(-1, 2)
        return pa.table({
            "a": pa.array(np.concatenate([node[tree[:, 0]], node[linked]])),
            "b": pa.concat_arrays([pa.array(node[tree[:, 1]]), pa.nulls(len(linked), pa.int64())]),
            "n": pa.concat_arrays([pa.nulls(len(tree), pa.int64()), pa.array(links[linked].astype(np.int64))])})

    return units.groupBy("shard", "lo", "hi").applyInArrow(search, FOUND)


def _exact_counts(nodes: DataFrame, asked: DataFrame, threshold: float, rows: int = 2048) -> DataFrame:
    """(node, exact): links of the asked nodes among all nodes, by comparing blocks of vectors."""
    n_asked, n_all = asked.count(), nodes.count()
    if not n_asked:
        return asked.select("node", F.lit(0).cast("long").alias("exact"))
    q_blocks, blocks = -(-n_asked // rows), -(-n_all // rows)
    packed = F.collect_list(F.struct("node", "weight", "vec")).alias
    left = asked.groupBy(F.pmod(F.xxhash64("node"), F.lit(q_blocks)).cast("int").alias("q")).agg(packed("asked"))
    right = nodes.groupBy(F.pmod(F.xxhash64("node", F.lit(1)), F.lit(blocks)).cast("int").alias("block")).agg(packed("given"))
    pairs = right.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)))).join(left, "q").select("asked", "given")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for asked_, given in zip(batch.column(0), batch.column(1)):
                a, b = asked_.values, given.values
                near = unit(a.field("vec")) @ unit(b.field("vec")).T >= threshold
                near &= a.field("node").to_numpy()[:, None] != b.field("node").to_numpy()
                yield pa.RecordBatch.from_arrays([a.field("node"), pa.array(near @ b.field("weight").to_numpy())], ["node", "exact"])

    return pairs.mapInArrow(compare, "node long, exact long").groupBy("node").agg(F.sum("exact").alias("exact"))


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", s: Search = Search(),
                 audit_every: int | None = 50) -> DataFrame:
    """id, n_links, component_id, kept, audit_links (exact number of links of audited rows, else null) of every row."""
    rows = stored(vectors.select(
        F.col(id_col).alias("id"), F.when(usable(F.col(vec_col)), F.col(vec_col).cast("array<double>")).alias("vec")), "vectors")
    audited = F.max(F.coalesce(F.col("id") % audit_every == 0, F.lit(False))) if audit_every else F.lit(False)
    rows = rows.withColumn("node", F.xxhash64("vec", F.size("vec")))
    nodes = stored(rows.where("vec IS NOT NULL").groupBy("vec", "node").agg(
        F.count("*").alias("weight"), F.min("id").alias("first"), audited.alias("audited")), "nodes")
    found = exact = None
    for (length,) in nodes.select(F.size("vec")).distinct().collect():  # one, in a table of one model
        alike = nodes.where(F.size("vec") == length)
        n = alike.count()
        sample = alike.where(F.pmod("node", F.lit(max(1, n // s.sample))) == 0).select("node", "vec").limit(2 * s.sample).toArrow()
        if not sample.num_rows:
            sample = alike.select("node", "vec").limit(s.sample).toArrow()
        fitted = unit(sample.sort_by("node")["vec"].combine_chunks())
        centres = fit_centroids(fitted, max(1, min(s.shards, -(-n // s.shard), len(fitted))))
        part = _search_blocks(_cut(stored(_members(alike, centres, s.overlap), "shards"), s), s)
        found = part if found is None else found.unionByName(part)
        if audit_every:
            asked = alike.where("audited")
            rate = max(1, asked.count() // s.audited)
            part = _exact_counts(alike, stored(asked.where(F.pmod(F.xxhash64("node", F.lit(3)), F.lit(rate)) == 0), "asked"), s.threshold)
            exact = part if exact is None else exact.unionByName(part)
    if found is None:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"),
                           F.lit(True).alias("kept"), F.lit(None).cast("long").alias("audit_links"))
    found = stored(found, "links")
    named = stored(components(found.where("b IS NOT NULL"), "a", "b"), "components")
    grouped = stored(nodes.select("node", "weight", "first", "audited").join(named, "node", "left").withColumn(
        "group", F.coalesce("component", "node")), "grouped")
    smallest = stored(grouped.groupBy("group").agg(F.min("first").alias("component_id")), "smallest")
    counts = found.where("n IS NOT NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    known = grouped.join(smallest, "group").join(counts, "node", "left")
    if exact is not None:
        known = known.join(exact, "node", "left")
    else:
        known = known.withColumn("exact", F.lit(None).cast("long"))
    known = stored(known.select("node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"),
                                (F.col("exact") + F.col("weight") - 1).alias("exact")), "known")
    lone = rows.where("vec IS NULL").select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("component_id"), F.lit(None).cast("long").alias("exact"))
    linked = rows.where("vec IS NOT NULL").select("id", "node").join(known, "node").select("id", "links", "component_id", "exact")
    return linked.unionByName(lone).select(
        F.col("id").alias(id_col), F.col("links").alias("n_links"), "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
        F.when(F.col("id") % (audit_every or 1) == 0, F.col("exact")).alias("audit_links"))


def op2_embedding_near_dedup(spark, folder):
    return near_vectors(table(spark, folder, "embeddings"))
