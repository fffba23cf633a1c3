"""Encoding and decoding with the pieces and scores of a SentencePiece vocabulary.

A text is encoded into the pieces with the largest sum of scores (of equal sums: the one whose last piece starts first,
from the end backwards). No piece joins text before a blank with the blank, so a text falls into marked words: blanks,
written as the mark, and what follows them up to the next blank. The distinct new words of a batch are sorted, which
lays out their trie depth-first, and forward scores up to the common prefix with the word before are reused.

A character that is no piece itself, and the mark as a character of the text, can become its UTF-8 bytes at a score below
all pieces, so every text has an encoding and decoding gives it back exactly. Null texts are encoded like empty ones, as no pieces. Repeated rows and extra columns stay as they are.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from fleetspark.llm.common import full, small_batches, table

MARK = "▁"
HELD = 24 << 20  # bytes of encoded words that a task keeps, with some hundred for each word's entry; a cache only
PART = 1 << 20  # bytes of text encoded at a time


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with ids and scores; ``of_bytes[b]`` is the id of the byte b."""

    ids: dict[str, int]
    scores: dict[str, float]
    of_bytes: list[int]
    uncovered: float

    def endings(self) -> dict[str, float | None]:
        """Every ending of a piece, with its score if it is a piece itself."""
        found = dict.fromkeys(piece[k:] for piece in self.ids for k in range(len(piece)))
        return found | self.scores


def load_vocabulary(path: str) -> Vocabulary:
    """Reads a model with byte pieces on the driver; the vocabulary has a fixed size and travels with the tasks."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids, scores, of_bytes = {}, {}, [0] * 256
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            of_bytes[int(piece[3:5], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i)):
            ids[piece], scores[piece] = i, model.get_score(i)
    return Vocabulary(ids, scores, of_bytes, min(scores.values()) - 10.0)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


_CUT = re.compile(rb"\n|(?<! ) ")  # where a word begins
HIDDEN = "\ud800"  # stands for the mark as a character of the text; texts hold no surrogates


def marked(word: str) -> str:
    """Blanks as marks."""
    return word.replace(MARK, HIDDEN).replace(" ", MARK)


def forward_best(words: Iterable[str], vocabulary: Vocabulary) -> Iterator[tuple[str, list[int], float]]:
    """Best pieces of sorted distinct words; positions shared with the word before are not computed again."""
    ids, endings, uncovered, none = vocabulary.ids, vocabulary.endings(), vocabulary.uncovered, ()
    best, back = [0.0], [0]
    before = ""
    for word in words:
        shared = 0
        for x, y in zip(before, word):
            if x != y:
                break
            shared += 1
        del best[shared + 1:], back[shared + 1:]
        for end in range(shared + 1, len(word) + 1):
            top, start = float("-inf"), end - 1
            for s in range(end - 1, -1, -1):
                score = endings.get(word[s:end], none)
                if score is none:  # no piece ends like this, nor like anything longer
                    break
                if score is not None and score + best[s] >= top:
                    top, start = score + best[s], s
            if endings.get(word[end - 1]) is None and best[end - 1] + uncovered > top:
                top, start = best[end - 1] + uncovered, end - 1
            best.append(top)
            back.append(start)
        out, end = [], len(word)
        while end:
            start = back[end]
            piece = ids.get(word[start:end])
            if piece is None:
                out.extend(vocabulary.of_bytes[b] for b in reversed(word[start:end].replace(HIDDEN, MARK).encode()))
            else:
                out.append(piece)
            end = start
        out.reverse()
        before = word
        yield word, out, best[len(word)]


def _runs(text: str) -> Iterator[bytes]:
    """A text with a blank before it, a very long one in runs of whole words."""
    data, at = b" " + text.encode() if text else b"", 0
    while len(data) - at > PART and (cut := _CUT.search(data, at + PART)):
        yield data[at:cut.start()]
        at = cut.start()
    if at < len(data):
        yield data[at:]


def _words(runs: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of all runs as codes of distinct words, and the number of words of each run."""
    data = np.frombuffer(b"".join(runs), np.uint8)
    begins = np.cumsum([0] + [len(r) for r in runs[:-1]])
    blank, line = data == ord(" "), data == ord("\n")
    start = blank | line
    start[1:] &= ~(blank[1:] & blank[:-1])
    start[1:] |= line[:-1]
    start[begins] = True
    at = np.flatnonzero(start)
    offsets = pa.py_buffer(np.append(at, len(data)).astype(np.int64))
    held = pa.Array.from_buffers(pa.large_binary(), len(at), [None, offsets, pa.py_buffer(data)])
    return held.dictionary_encode(), np.diff(np.append(np.searchsorted(at, begins), len(at)))


class _Encoder:
    """Pieces of words, kept as one array of ids and the place of each word in it."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.ids, self.ends, self.scores = array("i"), array("q", [0]), array("d")
        self.held = 0

    def encode(self, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Piece ids of all runs, and the number of ids and the score of each run."""
        if self.held > HELD:
            self.clear()
        words, sizes = _words(runs)
        distinct = words.dictionary.to_pylist()
        fresh = sorted((marked(w.decode()), w) for w in distinct if w not in self.number)
        for (_, word), (_, ids, score) in zip(fresh, forward_best((m for m, _ in fresh), self.vocabulary)):
            self.number[word] = len(self.scores)
            self.ids.extend(ids)
            self.ends.append(len(self.ids))
            self.scores.append(score)
            self.held += 120 + len(word) + 4 * len(ids)
        number = np.fromiter(map(self.number.__getitem__, distinct), np.int64, len(distinct))[words.indices.to_numpy()]
        run = np.repeat(np.arange(len(runs)), sizes)
        ends = np.array(self.ends)
        pieces = np.diff(ends)[number]
        places = np.repeat(ends[number] - np.cumsum(pieces) + pieces, pieces) + np.arange(pieces.sum())
        add = lambda x: np.bincount(run, weights=x, minlength=len(runs))
        return np.array(self.ids, np.int32)[places], add(pieces).astype(np.int64), add(np.array(self.scores)[number])


def _slices(batch: pa.Array) -> Iterator[pa.Array]:
    """Runs of rows with some megabytes of text together, whatever the number of rows in a batch."""
    start = size = 0
    for i, n in enumerate(pc.binary_length(batch).to_pylist()):
        size += n or 0
        if size >= PART:
            yield batch.slice(start, i + 1 - start)
            start, size = i + 1, 0
    if start < len(batch):
        yield batch.slice(start)


def _encoded(encoder: _Encoder, texts: pa.Array) -> tuple[pa.ListArray, pa.Array]:
    """Pieces and scores of a slice."""
    values, counts, totals = [np.zeros(0, np.int32)], np.zeros(len(texts), np.int64), np.zeros(len(texts))
    rows: list[int] = []
    runs: list[bytes] = []
    size = 0

    def flush() -> None:
        ids, n, score = encoder.encode(runs)
        values.append(ids)
        np.add.at(counts, rows, n)
        np.add.at(totals, rows, score)
        rows.clear()
        runs.clear()

    for row, given in enumerate(texts):
        for run in _runs(given.as_py() or ""):
            rows.append(row)
            runs.append(run)
            size += len(run)
            if size >= PART:
                flush()
                size = 0
    if runs:
        flush()
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values))), pa.array(totals)


class _Reader:
    """Texts of arrays of piece ids."""

    def __init__(self, vocabulary: Vocabulary):
        self.size = 1 + max(max(vocabulary.ids.values()), max(vocabulary.of_bytes))
        shown = [b""] * (self.size + 1)  # the last stands for what is no piece
        for piece, i in vocabulary.ids.items():
            shown[i] = piece.replace(MARK, " ").encode()
        for byte, i in enumerate(vocabulary.of_bytes):
            shown[i] = bytes([byte])
        self.shown = pa.array(shown, pa.binary())

    def read(self, lists: pa.ListArray) -> pa.Array:
        out = []
        for ids in lists:
            if not ids.is_valid:
                out.append(None)
                continue
            at = pc.fill_null(ids.values, -1).to_numpy(zero_copy_only=False)
            at = np.where((at < 0) | (at >= self.size), self.size, at)
            one = pa.ListArray.from_arrays([0, len(at)], self.shown.take(pa.array(at)))
            data = pc.binary_join(one, b"")[0].as_py()
            out.append((data[1:] if data[:1] == b" " else data).decode("utf-8", "replace"))
        return pa.array(out, pa.string())


def encode_pieces(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", read_back: str | None = None) -> DataFrame:
    """Adds pieces (array of ids) and pieces_score (sum of their scores), and on demand the text read back from the pieces.

    Both ways in one function share a worker. What a task holds is bounded in bytes: slices of a batch, and a cache of words.
    """

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _Encoder(vocabulary)
        reader = _Reader(vocabulary) if read_back else None
        for batch in batches:
            for texts in _slices(batch):
                ids, scores = _encoded(encoder, texts)
                yield pa.StructArray.from_arrays([ids, scores, *([reader.read(ids)] if reader else [])],
                                                 ["ids", "score", *(["text"] if reader else [])])
            pa.default_memory_pool().release_unused()

    small_batches(docs.sparkSession)
    result = F.arrow_udf(encode, "ids array<int>, score double" + (", text string" if read_back else ""))(full(text))
    added = {"pieces": F.col("_llm_pieces.ids"), "pieces_score": F.col("_llm_pieces.score")}
    if read_back:
        added[read_back] = F.col("_llm_pieces.text")
    return docs.withColumn("_llm_pieces", result).withColumns(added).drop("_llm_pieces")


def decode_pieces(encoded: DataFrame, vocabulary: Vocabulary, pieces: str = "pieces", name: str = "decoded") -> DataFrame:
    """Adds the text of an array of piece ids (null: null); ids that are null or no piece read as nothing, the mark before
    the first word goes."""

    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader = _Reader(vocabulary)
        for batch in batches:
            yield reader.read(batch)

    return encoded.withColumn(name, F.arrow_udf(decode, "string")(F.col(pieces)))


def op4_piece_encoding(spark, folder, path: str | None = None):
    vocabulary = load_vocabulary(path or default_path())
    both = encode_pieces(table(spark, folder, "documents").select("doc_id", "text"), vocabulary, read_back="decoded")
    return both.select(
        "doc_id", F.size("pieces").cast("long").alias("n_pieces"), "pieces_score",
        F.sha2(F.array_join("pieces", " "), 256).alias("pieces_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
        F.col("decoded").eqNullSafe(full("text")).alias("round_trip"))
