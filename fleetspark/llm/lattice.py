"""Language-model scoring over all segmentations of words into the pieces of a given vocabulary.

A word, with the mark before it, is a string of pieces drawn independently, a text is its words and one end. The forward
recursion in log space sums over all segmentations, so a text's score is its marginal probability. Pieces get their
probabilities from the vocabulary's scores and the training texts: the scores, read as ranks (p falls as 1 / rank), give
a first distribution; the best segmentation of every training word under it is counted; and p(piece) is its count
smoothed by the first distribution with a total weight of one per piece. An uncovered character is drawn as its bytes.

Texts are packed: a packet holds some million characters as its distinct words and their counts per document. Only
distinct words of packets are shuffled, counted over the corpus, scored once in sorted order (forward scores up to
the common prefix are kept) and sent back to their packets. Nothing but sums per piece reaches the driver.
A packet travels as several rows, of some thousand numbers a column, and its words come back one by one: as one row each,
packets and their words would pass through buffers of many times their size, inside and outside the heap.

The base score is an add-one unigram model of the training words. Defined results: a null text is empty, has the end as
its only token; a null id is in training; repeated rows count each; without training texts probabilities are the prior.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetspark.llm.common import small_batches, table
from fleetspark.llm.pieces import HIDDEN, MARK, Vocabulary, default_path, load_vocabulary
from fleetspark.session import stored

PACKET = 8 << 20  # bytes of text
LOG10 = math.log(10.0)
PART = 1 << 12  # numbers or words of a column in one row
PACKETS = """packet long, part int, ids array<long>, held array<boolean>, owner array<int>, word array<int>, times array<int>,
             words array<binary>, trained array<long>"""
# Parquet looks at the size of its pages and row groups only after a hundred rows otherwise.
SMALL_PAGES = {"parquet.page.size.row.check.min": "1", "parquet.block.size.row.check.min": "1", "parquet.block.size": str(4 << 20),
               "compression": "zstd"}


def pack(docs: DataFrame, held_out, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Packets of documents as distinct lower-case words and counts; ``held_out`` is a condition on a document.

    The parts of a packet, put one after the other, are its columns.
    """
    from pyspark import TaskContext

    def flush(number: int, ids, held, texts) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        owner, word, times = [], [], []
        for i, data in enumerate(texts):
            counts: dict[bytes, int] = {}
            for w in data.lower().split():  # of bytes: A-Z, and the six blanks that separate words
                counts[w] = counts.get(w, 0) + 1
            owner.append(np.full(len(counts), i, np.int32))
            word.append(np.array([known.setdefault(w, len(known)) for w in counts], np.int32))
            times.append(np.fromiter(counts.values(), np.int32, len(counts)))
        none = np.zeros(0, np.int32)
        owner, word, times = (np.concatenate([*x, none]) for x in (owner, word, times))
        seen = ~np.array(held, bool)
        trained = np.bincount(word, weights=times * seen[owner], minlength=len(known)).astype(np.int64)
        columns = [(ids, pa.int64()), (held, pa.bool_()), (owner, pa.int32()), (word, pa.int32()), (times, pa.int32()),
                   (list(known), pa.binary()), (trained, pa.int64())]
        for part in range(-(-max(len(values) for values, _ in columns) // PART)):
            cut = slice(part * PART, (part + 1) * PART)
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([part], pa.int32()),
                 *(pa.array([values[cut]], pa.list_(kind)) for values, kind in columns)],
                ["packet", "part", "ids", "held", "owner", "word", "times", "words", "trained"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, held, texts, size = [], [], [], 0
        for batch in batches:
            for i, h, t in zip(*(batch.column(k) for k in range(3))):
                data = (t.as_py() or "").encode()
                ids.append(i.as_py())
                held.append(bool(h.as_py()))
                texts.append(data)
                size += len(data)
                if size >= PACKET:
                    yield from flush(number, ids, held, texts)
                    number, ids, held, texts, size = number + 1, [], [], [], 0
        if ids:
            yield from flush(number, ids, held, texts)

    return docs.select(F.col(id_col).cast("long").alias("id"), held_out.alias("held"), F.col(text).alias("text")).mapInArrow(run, PACKETS)


class Lattice:
    """Log probabilities of pieces, looked up by their text; uncovered characters by their bytes."""

    def __init__(self, log_p: dict[str, float], log_bytes: list[float]):
        self.log_p, self.log_bytes, self.longest = log_p, log_bytes, max(map(len, log_p))

    def bytes_of(self, char: str) -> float:
        return sum(self.log_bytes[b] for b in char.replace(HIDDEN, MARK).encode("utf-8", "surrogatepass"))

    def marginals(self, words: Iterable[str]) -> Iterator[float]:
        """Log of the sum over all segmentations, for words in sorted order."""
        log_p, longest = self.log_p, self.longest
        exp, log = math.exp, math.log
        total, before = [0.0], ""
        for word in words:
            shared = 0
            for x, y in zip(before, word):
                if x != y:
                    break
                shared += 1
            del total[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                found = []
                for s in range(max(0, end - longest), end):
                    p = log_p.get(word[s:end])
                    if p is not None:
                        found.append(total[s] + p)
                if word[end - 1] not in log_p:
                    found.append(total[end - 1] + self.bytes_of(word[end - 1]))
                if len(found) == 1:
                    total.append(found[0])
                else:
                    top = max(found)
                    total.append(top + log(sum([exp(x - top) for x in found])))
            before = word
            yield total[len(word)]

    def best(self, words: Iterable[str]) -> Iterator[list[str]]:
        """The likeliest segmentation of words in sorted order."""
        log_p, longest = self.log_p, self.longest
        total, back, before = [0.0], [0], ""
        for word in words:
            shared = 0
            for x, y in zip(before, word):
                if x != y:
                    break
                shared += 1
            del total[shared + 1:], back[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                top, start = float("-inf"), end - 1
                for s in range(max(0, end - longest), end):
                    p = log_p.get(word[s:end])
                    if p is not None and total[s] + p > top:
                        top, start = total[s] + p, s
                if word[end - 1] not in log_p:
                    x = total[end - 1] + self.bytes_of(word[end - 1])
                    if x > top:
                        top, start = x, end - 1
                total.append(top)
                back.append(start)
            out, end = [], len(word)
            while end:
                out.append(word[back[end]:end])
                end = back[end]
            before = word
            yield out


def marked_word(data: bytes) -> str:
    return MARK + data.decode("utf-8", "surrogatepass").replace(MARK, HIDDEN)


def prior(vocabulary: Vocabulary) -> tuple[dict[str, float], list[float], float]:
    """Probabilities of pieces, bytes and the end from the scores: 1 / rank, normalised."""
    size = len(vocabulary.ids) + 256
    ranks = {p: min(-s, size) + 1.0 for p, s in vocabulary.scores.items()}
    mass = sum(1.0 / r for r in ranks.values()) + 256.0 / size + 1.0 / size
    return {p: 1.0 / r / mass for p, r in ranks.items()}, [1.0 / size / mass] * 256, 1.0 / size / mass


def _log_lattice(p: dict[str, float], of_bytes: list[float]) -> Lattice:
    return Lattice({k: math.log(v) for k, v in p.items()}, [math.log(v) for v in of_bytes])


def score_documents(docs: DataFrame, held_out, vocabulary: Vocabulary, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10) of every row."""
    small_batches(docs.sparkSession)
    packets = stored(pack(docs, held_out, id_col, text), "packets", **SMALL_PAGES)
    ends = packets.agg(F.coalesce(F.sum(F.size(F.filter("held", lambda h: ~h))), F.lit(0))).first()[0]
    listed = packets.select("packet", "part", F.posexplode(F.arrays_zip("words", "trained")).alias("at", "w")).select(
        "packet", (F.col("part") * PART + F.col("at")).alias("at"), F.col("w.words").alias("word"), F.col("w.trained").alias("n"))
    counted = stored(
        listed.groupBy("word").agg(F.sum("n").alias("c")).repartitionByRange("word").sortWithinPartitions("word"), "words")
    in_words, kinds = counted.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    n, v = in_words + ends, kinds + (ends > 0)

    p0, bytes0, end0 = prior(vocabulary)
    first = _log_lattice(p0, bytes0)
    numbers = {p: i for i, p in enumerate(p0)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(numbers) + 256, np.int64)
        for batch in batches:
            words, times = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for pieces, c in zip(first.best(map(marked_word, words)), times):
                for piece in pieces:
                    at = numbers.get(piece)
                    if at is not None:
                        sums[at] += c
                    else:
                        for b in piece.replace(HIDDEN, MARK).encode("utf-8", "surrogatepass"):
                            sums[len(numbers) + b] += c
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[used])], ["piece", "times"])

    # One row per piece of the vocabulary.
    sums = dict(counted.where("c > 0").select("word", "c").mapInArrow(count, "piece long, times long")
                .groupBy("piece").agg(F.sum("times")).collect())
    weight = len(numbers) + 256
    mass = sum(sums.values()) + ends + weight
    p = {piece: (sums.get(i, 0) + weight * p0[piece]) / mass for piece, i in numbers.items()}
    of_bytes = [(sums.get(len(numbers) + b, 0) + weight * bytes0[b]) / mass for b in range(256)]
    model = _log_lattice(p, of_bytes)
    end_score = math.log((ends + weight * end0) / mass)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(model.marginals(map(marked_word, batch.column(0).to_pylist())))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.float64())], ["word", "c", "log_p"])

    scored = stored(counted.mapInArrow(judge, "word binary, c long, log_p double"), "scored-words")
    back = listed.join(scored, "word").select(F.col("packet").alias("of"), "at", "c", "log_p")
    rows = packets.select("packet", "part", "ids", "held", "owner", "word", "times")
    least = n + (v + 1)

    def total(parts: pa.Table, found: pa.Table) -> pa.Table:
        parts = parts.sort_by("part")
        ids, held, owner, word, times = (
            pa.concat_arrays([part.values for part in parts.column(k)]) for k in ("ids", "held", "owner", "word", "times"))
        owner, word, times, docs = owner.to_numpy(), word.to_numpy(), times.to_numpy(), len(ids)
        at = found.column("at").to_numpy()
        c, log_p = np.zeros(len(at), np.int64), np.zeros(len(at))
        c[at], log_p[at] = found.column("c").to_numpy(), found.column("log_p").to_numpy()
        base = np.log10((c + 1) / least)
        add = lambda x: np.bincount(owner, weights=x, minlength=docs)
        tokens = add(times).astype(np.int64) + 1
        known = add(times * (c[word] > 0)).astype(np.int64) + (ends > 0)
        return pa.Table.from_arrays(
            [ids, held, pa.array(tokens), pa.array(known), pa.array(np.full(docs, n, np.int64)),
             pa.array(add(times * base[word]) + math.log10((ends + 1) / least)),
             pa.array((add(times * log_p[word]) + end_score) / LOG10)],
            ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    scores = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return rows.groupBy("packet").cogroup(back.groupBy("of")).applyInArrow(total, scores).withColumnRenamed("id", id_col)


def op10_lattice_scoring(spark, folder, path: str | None = None):
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    return score_documents(table(spark, folder, "documents"), held, load_vocabulary(path or default_path()))
