"""The stages of the corpus pipeline, each against brute force on its own input."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fleetspark.llm import pieces, quality
from test_documents import WORD, groups_by_hand, quality_by_hand, windows_by_hand

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    """The documents and what each stage left of them."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    more = [(5000, None, None, None, None), (5001, "", "en", "src0", 0), (None, "no id " + "word " * 30, "en", None, 9), (5002, "w" * 90_000, "en", "src1", 1)]
    given = docs.unionByName(spark.createDataFrame([*more, more[2]], SCHEMA)).unionByName(docs.where("doc_id < 3"))
    root, out = tmp_path_factory.mktemp("stages"), []
    given.write.parquet(f"{root}/given")
    given = spark.read.parquet(f"{root}/given")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, given, folder).write.parquet(f"{root}/{k}")
        out.append(([tuple(r) for r in given.select("doc_id", "text", "lang", "source").collect()], spark.read.parquet(f"{root}/{k}")))
        given = out[-1][1]
    return out


def ids(rows):
    return Counter(r[0] for r in rows)


def test_quality_stage(stages):
    given, left = stages[0]
    want = Counter(r[0] for r in quality_by_hand(given, quality.Limits()) if r[7])
    assert ids(left.select("doc_id").collect()) == want and left.columns == [c.split()[0] for c in SCHEMA.split(", ")]


def test_near_copies_stage(stages):
    given, left = stages[1]
    groups = groups_by_hand(given)
    want = Counter({c for d, _, c in groups if d is not None and d == c})
    got = ids(left.select("doc_id").collect())
    got.pop(None, None)
    assert got == want


def test_repeats_stage(stages):
    given, left = stages[2]
    want = Counter(d for d, n, gone, *_ in windows_by_hand([r[:2] for r in given]) if gone < n or not n)
    assert ids(left.select("doc_id").collect()) == want


def test_mixing_stage(stages):
    given, left = stages[3]
    sizes, words = defaultdict(int), {}
    for d, t, _, s in given:
        words[d] = len(WORD.findall(t or ""))
        sizes[s] += words[d]
    got = left.select("doc_id", "source", "text").collect()
    taken = defaultdict(int)
    for r in got:
        taken[r.source] += len(WORD.findall(r.text or ""))
    assert max(ids(got).values()) <= 2
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= len(sizes) * max(words.values())
    assert all(taken[s] <= 2 * sizes[s] for s in sizes)


def test_encoding_stage(stages):
    given, left = stages[4]
    vocabulary = pieces.load_vocabulary(pieces.default_path())
    back = pieces.decode_pieces(left, vocabulary)
    assert left.where("NOT round_trip").isEmpty()
    assert Counter(r.decoded for r in back.select("decoded").collect()) == Counter(t or "" for _, t, *_ in given)


def test_empty_documents(spark, folder):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, spark.createDataFrame([], SCHEMA), folder).count() == 0


def test_run(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert out.where("NOT round_trip").isEmpty() and out.agg(F.count("*")).first()[0] > 100
