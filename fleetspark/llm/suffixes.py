"""Suffix-array dedup: windows of ``width`` bytes that start earlier elsewhere are found by radix passes of bounded depth.

Suffixes are ordered only through their first ``width`` bytes, the deepest pass looks at all of them. The digit of a
pass is the smallest hash among the ``gram``-byte strings of the window (for gram = width: the window itself), which
depends on the window alone, so equal windows always meet. Neighbouring windows whose digit comes from the same place
form a run, and a pass shuffles one row per run, not per byte. Inside a digit, runs with equal bytes form a class: all
but its first are repeats in full. A digit with one class is finished; the first runs of the other digits' classes go
on to the next pass with a finer digit. After the last pass equal groups are exactly the repeated windows.

Repeats inside some megabytes of a map task are combined before the shuffle, so a passage in a third of all documents sends a
few rows per batch to its digit. Strings are compared by 64-bit hashes inside a digit of 64 bits.

Documents are ordered by id (nulls last), then by the hash of their text; rows that repeat id and text are one document
and get the same result each. Null texts are empty. Ids are integers. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetspark.llm.common import full, small_batches, table
from fleetspark.session import stored

BASE = 0x9E3779B97F4A7C15
BLOCK = 1 << 17  # bytes hashed at a time; positions inside a block take CODE bits
TOGETHER = 8 << 20  # bytes of text whose runs are combined before the shuffle; bounds the memory of a task
CODE = 20
LAST = (1 << 63) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Hashes of substrings of a block by prefix sums modulo 2**64."""

    def __init__(self, size: int):
        one = np.ones(1, np.uint64)
        self.up = np.multiply.accumulate(np.concatenate([one, np.full(size, BASE, np.uint64)]))
        self.down = np.multiply.accumulate(np.concatenate([one, np.full(size, pow(BASE, -1, 1 << 64), np.uint64)]))
        self.letters = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))

    def sums(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.letters[data] * self.down[:len(data)], out=out[1:])
        return out

    def between(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((sums[end] - sums[start]) * self.up[start] + (end - start).astype(np.uint64))


def _window_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return x if span == width else np.minimum(x[:len(x) - (width - span)], x[width - span:])


def block_runs(hasher: Hasher, data: np.ndarray, bounds: np.ndarray, width: int, gram: int):
    """Runs (first window, windows, digit, hash of their bytes) in a block of pieces that end at ``bounds``."""
    sums = hasher.sums(data)
    n = len(data) - width + 1
    grams = len(data) - gram + 1
    digits = _mix((sums[gram:] - sums[:-gram]) * hasher.up[:grams])
    low = np.uint64((1 << CODE) - 1)
    coded = (digits & ~low) | np.arange(grams, dtype=np.uint64)  # of equal digits the leftmost is the smallest
    at = (_window_min(coded, width - gram + 1) & low).astype(np.int64)
    inside = np.ones(n, bool)  # windows that do not cross the end of a piece
    for end in bounds[:-1].tolist():
        inside[max(0, end - width + 1):end] = False
    change = np.flatnonzero(at[1:] != at[:-1]) + 1
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts = np.union1d(np.union1d(change, edges), [0])
    ends = np.append(starts[1:], n)
    good = inside[starts]
    starts, ends = starts[good], ends[good]
    return starts, ends - starts, digits[at[starts]], hasher.between(sums, starts, ends + (width - 1))


def _blocks(pieces: Iterator[tuple[int, int, bytes]], width: int):
    """Pieces (owner, offset, bytes) packed into blocks; long ones are cut so that each window is in one part."""
    held, size = [], 0
    step = BLOCK - width + 1
    for owner, offset, data in pieces:
        for cut in range(0, len(data) - width + 1, step):
            part = data[cut:cut + BLOCK]
            if size + len(part) > BLOCK and held:
                yield held
                held, size = [], 0
            held.append((owner, offset + cut, part))
            size += len(part)
    if held:
        yield held


def _runs(pieces, width: int, gram: int, hasher: Hasher):
    """Arrays owner, first window, windows, digit, class of all runs of the pieces, those of some megabytes at a time."""
    found, size = [], 0
    for held in _blocks(pieces, width):
        data = np.frombuffer(b"".join(x[2] for x in held), np.uint8)
        bounds = np.cumsum([len(x[2]) for x in held])
        starts, count, digit, kind = block_runs(hasher, data, bounds, width, gram)
        piece = np.searchsorted(bounds, starts, side="right")
        owner = np.array([x[0] for x in held])[piece]
        shift = np.array([x[1] for x in held])[piece] - np.concatenate([[0], bounds[:-1]])[piece]
        found.append((owner, starts + shift, count, digit.view(np.int64), kind.view(np.int64)))
        size += len(data)
        if size >= TOGETHER:
            yield [np.concatenate(x) for x in zip(*found)]
            found, size = [], 0
    if found:
        yield [np.concatenate(x) for x in zip(*found)]


RUN = "digit long, kind long, doc long, tie long, at long, n int, more binary"


def _combined(doc: np.ndarray, tie: np.ndarray, runs) -> pa.RecordBatch:
    """One row per class of a batch: its first run, and the others packed into ``more``."""
    owner, at, count, digit, kind = runs
    d, t = doc[owner], tie[owner]
    order = np.lexsort((kind, digit))
    new = np.ones(len(order), bool)
    new[1:] = (digit[order][1:] != digit[order][:-1]) | (kind[order][1:] != kind[order][:-1])
    group = np.cumsum(new) - 1
    size = np.bincount(group)
    several = size[group] > 1
    again = order[several]  # only these need the full order
    single = order[~several]
    more: list = [None] * len(single)
    firsts = [single]
    if len(again):
        fine = np.lexsort((at[again], t[again], d[again], group[several]))
        again, groups = again[fine], group[several][fine]
        heads = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
        firsts.append(again[heads])
        packed = np.stack([d[again], t[again], at[again], count[again].astype(np.int64)], axis=1)
        more += [packed[a + 1:b].tobytes() for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(again)])]
    pick = np.sort(np.concatenate(firsts)) if not len(again) else np.concatenate(firsts)
    return pa.RecordBatch.from_arrays(
        [pa.array(digit[pick]), pa.array(kind[pick]), pa.array(d[pick]), pa.array(t[pick]), pa.array(at[pick]),
         pa.array(count[pick].astype(np.int32)), pa.array(more, pa.binary())],
        ["digit", "kind", "doc", "tie", "at", "n", "more"])


def _find_runs(pieces: DataFrame, width: int, gram: int) -> DataFrame:
    """Runs of pieces (doc, tie, at, bytes), combined per batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(BLOCK)
        for batch in batches:
            doc, tie, at = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            pieces = ((i, o, x.as_py()) for i, (o, x) in enumerate(zip(at.tolist(), batch.column(3))))
            for runs in _runs(pieces, width, gram, hasher):
                yield _combined(doc, tie, runs)
                pa.default_memory_pool().release_unused()

    return pieces.select("doc", "tie", "at", "bytes").mapInArrow(run, RUN)


MARK = "doc long, tie long, at long, n int, open boolean"


def _judge(runs: DataFrame) -> DataFrame:
    """Repeated runs (open = false), and the first runs of digits with several classes (open = true)."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # last (digit, kind); classes of its digit so far; its only first run; the first run of the last class
        last, classes, waiting, head = None, 0, None, np.zeros((1, 4), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            digit, kind, doc, tie, at, n = (batch.column(i).to_numpy() for i in range(6))
            same_digit = np.concatenate([[last is not None and last[0] == digit[0]], digit[1:] == digit[:-1]])
            same = same_digit & np.concatenate([[last is not None and last[1] == kind[0]], kind[1:] == kind[:-1]])
            group = np.cumsum(~same_digit)  # 0: the digit that the batch before ended with
            number = np.bincount(group, weights=~same, minlength=1).astype(np.int64)
            number[0] += classes
            several = (number > 1)[group]
            firsts = ~same
            columns = [doc, tie, at, n.astype(np.int64)]
            rows = np.stack(columns, axis=1)
            opened = rows[firsts & several]
            if waiting is not None and number[0] > 1:
                opened = np.concatenate([waiting, opened])
            heads = np.concatenate([head, rows[firsts]])
            of = np.cumsum(firsts)  # the class of a row, 0: the one that the batch before ended with
            packed = [(k, np.frombuffer(x.as_py(), np.int64).reshape(-1, 4)) for k, x in enumerate(batch.column(6)) if x.is_valid]
            repeats = np.concatenate([rows[same], *(x for _, x in packed)])
            own = heads[np.concatenate([of[same], *(np.full(len(x), of[k]) for k, x in packed)])]
            # A row that repeats the first one's document is the same run.
            repeats = repeats[(repeats[:, :3] != own[:, :3]).any(axis=1)]
            head = heads[-1:]
            out = np.concatenate([repeats, opened])
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[:, 0]), pa.array(out[:, 1]), pa.array(out[:, 2]), pa.array(out[:, 3].astype(np.int32)),
                 pa.array(np.arange(len(out)) >= len(repeats))], ["doc", "tie", "at", "n", "open"])
            if group[-1] > 0 or number[0] > 1:
                waiting = None
            if number[-1] == 1 and group[-1] > 0:
                waiting = rows[np.flatnonzero(firsts)[-1]][None]
            classes, last = int(number[-1]), (digit[-1], kind[-1])

    return runs.repartition("digit").sortWithinPartitions("digit", "kind", "doc", "tie", "at").mapInArrow(judge, MARK)


def _documents(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """Adds _llm_doc (id, nulls last), _llm_tie (hash of the text where an id has several texts, else 0) and _llm_bytes."""
    ids = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST))
    keyed = docs.withColumns({"_llm_doc": ids, "_llm_hash": F.xxhash64(full(text))})
    # Ids with more than one text: normally none.
    shared = stored(
        docs.select(ids.alias("_llm_id"), F.xxhash64(full(text)).alias("h")).groupBy("_llm_id")
        .agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo <> hi").select("_llm_id"), "shared-ids")
    return keyed.join(shared, keyed["_llm_doc"] == shared["_llm_id"], "left").withColumns({
        "_llm_tie": F.when(F.col("_llm_id").isNull(), F.lit(0)).otherwise(F.col("_llm_hash")),
        "_llm_bytes": F.encode(full(text), "UTF-8"),
    }).drop("_llm_id", "_llm_hash")


def repeated_runs(keyed: DataFrame, width: int = 100, grams: tuple[int, ...] = (32, 64, 100)) -> DataFrame:
    """Rows (doc, tie, at, n): the windows that start at at .. at + n - 1 also start earlier."""
    whole = keyed.select(F.col("_llm_doc").alias("doc"), F.col("_llm_tie").alias("tie"), F.lit(0).cast("long").alias("at"),
                         F.col("_llm_bytes").alias("bytes")).where(F.octet_length("bytes") >= width)
    found = None
    pieces = whole
    for depth, gram in enumerate(grams):
        marks = stored(_judge(_find_runs(pieces, width, gram)), "runs")
        repeats = marks.where("NOT open").select("doc", "tie", "at", "n")
        found = repeats if found is None else found.unionByName(repeats)
        if depth + 1 == len(grams):
            return found
        opened = marks.where("open")
        if depth:
            pieces = opened.alias("o").join(
                pieces.withColumnRenamed("at", "start").alias("p"),
                F.expr("o.doc = p.doc AND o.tie = p.tie AND o.at >= p.start AND o.at + o.n + "
                       f"{width - 1} <= p.start + octet_length(p.bytes)"))
            pieces = pieces.select("o.doc", "o.tie", "o.at", F.expr(
                f"substring(p.bytes, int(o.at - p.start + 1), o.n + {width - 1})").alias("bytes"))
            # pieces of a document do not overlap in windows: each open run is inside one of them
        else:
            wanted = opened.groupBy("doc", "tie").agg(F.collect_list(F.struct("at", "n")).alias("runs"))
            cut = F.explode("runs").alias("r")
            pieces = (
                whole.drop("at").join(wanted, ["doc", "tie"]).select("doc", "tie", "bytes", cut)
                .select("doc", "tie", F.col("r.at").alias("at"),
                        F.expr(f"substring(bytes, int(r.at + 1), r.n + {width - 1})").alias("bytes"))
                .distinct()
            )
        pieces = stored(pieces, "pieces")
    return found


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 100,
                    grams: tuple[int, ...] = (32, 64, 100)) -> DataFrame:
    """Adds n_bytes, n_removed, n_spans, kept_bytes and kept_text (characters that lost bytes go whole)."""
    small_batches(docs.sparkSession)
    keyed = _documents(docs, id_col, text)
    runs = repeated_runs(keyed, width, grams).groupBy(F.col("doc").alias("_llm_of"), F.col("tie").alias("_llm_of_tie")).agg(
        F.collect_list(F.struct("at", "n")).alias("_llm_runs"))
    joined = keyed.join(runs, (keyed["_llm_doc"] == runs["_llm_of"]) & (keyed["_llm_tie"] == runs["_llm_of_tie"]), "left")

    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, found in batches:
            out = []
            for data, spans in zip(texts, found):
                data = data.as_py()
                if not spans.is_valid:
                    out.append((data, 0, 0))
                    continue
                at = spans.values.field("at").to_numpy()
                n = spans.values.field("n").to_numpy()
                edge = np.zeros(len(data) + 1, np.int64)
                np.add.at(edge, at, 1)
                np.add.at(edge, at + n + (width - 1), -1)
                gone = np.cumsum(edge[:-1]) > 0
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                starts = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
                out.append((kept, int(gone.sum()), starts))
            yield pa.StructArray.from_arrays(
                [pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.int64()),
                 pa.array([x[2] for x in out], pa.int64()),
                 pa.array([x[0].decode("utf-8", "ignore") for x in out], pa.string())],
                ["kept", "n_removed", "n_spans", "text"])

    result = F.arrow_udf(cut, "kept binary, n_removed long, n_spans long, text string")(F.col("_llm_bytes"), F.col("_llm_runs"))
    return joined.withColumn("_llm_cut", result).withColumns({
        "n_bytes": F.octet_length("_llm_bytes").cast("long"), "n_removed": F.col("_llm_cut.n_removed"),
        "n_spans": F.col("_llm_cut.n_spans"), "kept_bytes": F.col("_llm_cut.kept"), "kept_text": F.col("_llm_cut.text"),
    }).drop("_llm_doc", "_llm_tie", "_llm_bytes", "_llm_of", "_llm_of_tie", "_llm_runs", "_llm_cut")


def op6_suffix_array_dedup(spark, folder):
    return without_repeats(table(spark, folder, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))
