"""Operators on vectors, conversations and pages, and components, against brute force."""

import base64
import gzip
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import check
from fleetspark.llm import chat, graph, queries, warc
from fleetspark.llm.common import numbered
from fleetspark.llm.components import components


@pytest.fixture(scope="module")
def duck(folder):
    return check.connect(folder)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_sql(spark, folder, duck, name):
    result = check.compare(queries.queries()[name](spark, folder), duck, queries.oracle_sql()[name])
    assert isinstance(result, int), result


def by_hand(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            p, q = root(a), root(b)
            parent[max(p, q)] = min(p, q)
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("per_task", [10**6, 30])
def test_components(spark, per_task):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(1, 40)] + [(r.randrange(100, 300), r.randrange(100, 300)) for _ in range(120)]
    edges += [(1000, x) for x in range(1001, 1060)] + [(5, 5), (None, 3)]
    found = components(spark.createDataFrame(edges, "a long, b long"), "a", "b", per_task)
    assert {x.node: x.component for x in found.collect()} == by_hand(edges)
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_numbered(spark):
    given = [f"k{i * 37 % 500:03d}" for i in range(500)] + [None]
    df = spark.createDataFrame([(x,) for x in given], "k string").repartition(4)
    out = {r.k: r.n for r in numbered(df, [F.col("k").asc_nulls_last()], "n").collect()}
    assert out == {x: i for i, x in enumerate([*sorted(x for x in given if x), None])}


def vectors():
    r = np.random.default_rng(4)
    centre = r.normal(size=(12, 16))
    made = [centre[i % 12] + 0.15 * r.normal(size=16) for i in range(260)] + list(r.normal(size=(140, 16)))
    given = [(i, [float(y) for y in x]) for i, x in enumerate(made)]
    given += [(1000, given[0][1]), (1001, [2 * x for x in given[0][1]]), (1001, given[5][1]), (1002, given[7][1]), (1002, given[7][1])]
    given += [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [float("nan")] + [1.0] * 15), (2004, [None] + [1.0] * 15),
              (2005, [float("inf")] * 16), (2006, [1.0, 0.0, 0.0]), (2007, [1.0, 0.05, 0.0]), (None, given[3][1])]
    return given


@pytest.mark.parametrize("s", [graph.Search(shard=100), graph.Search(shard=400, block=64, overlap=2)])
def test_near_vectors(spark, s):
    given = vectors()
    df = spark.createDataFrame([(*x, 1, "x") for x in given], "vec_id long, embedding array<double>, kept int, node string").repartition(3)
    good = [i for i, (_, v) in enumerate(given) if v and None not in v and all(np.isfinite(v)) and any(v)]
    unit = {i: np.array(given[i][1]) / np.linalg.norm(given[i][1]) for i in good}
    links = {i: [j for j in good if i != j and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9] for i in good}
    root = by_hand([(i, j) for i in good for j in links[i]])
    ids = {}
    for i in range(len(given)):
        g = root.get(i, i)
        if given[i][0] is not None:
            ids[g] = min(given[i][0], ids.get(g, given[i][0]))
    want = sorted(((given[i][0], len(links.get(i, ())), ids.get(root.get(i, i))) for i in range(len(given))), key=repr)
    out = graph.near_vectors(df, s=s).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in out), key=repr) == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)
    audited = [r for r in out if r.audit_links is not None]
    assert audited and all(r.vec_id % 50 == 0 and r.audit_links == r.n_links for r in audited)


@pytest.mark.parametrize("s, shards", [
    (graph.Search(shards=1), 1), (graph.Search(shard=300), 10),
    (graph.Search(shards=4, shard=30, block=60, cut=16, cut_sample=128), 100)])
def test_recall_at_several_numbers_of_shards(spark, s, shards):
    rng = np.random.default_rng(5)
    middles = rng.normal(size=(130, 24))
    group = np.concatenate([np.arange(2600) % 130, np.zeros(300, int)])  # the first has a tenth of all rows
    x = middles[group] + 0.28 * rng.normal(size=(2900, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    nodes = df.select(F.col("vec_id").alias("node"), F.lit(1).cast("long").alias("weight"), F.col("embedding").alias("vec"))
    centres = graph.fit_centroids(x, min(s.shards, -(-len(x) // s.shard)))
    cut = graph._cut(graph._members(nodes, centres, s.overlap), s).groupBy("shard").agg(F.collect_list("node")).collect()
    assert len(cut) >= shards
    # What is large and stays whole is dense.
    assert all(near[np.ix_(held, held)].mean() > 1 / (2 * s.dense) for _, held in cut if len(held) > s.block)
    out = graph.near_vectors(df, s=s).collect()
    found = {r.vec_id: r.n_links for r in out}
    assert all(found[i] <= near[i].sum() for i in range(len(x)))
    assert sum(found.values()) >= 0.9 * near.sum()
    assert {r.vec_id: r.audit_links for r in out if r.audit_links is not None} == {i: near[i].sum() for i in range(0, len(x), 50)}


def test_no_vectors(spark):
    for rows in ([], [(1, None)]):
        assert graph.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).count() == len(rows)


def test_conversations(spark):
    text = "a\\<|im_end|>\n<|im_next|>\\"
    rows = [(1, 0, "us\\er\n<|", text), (1, 1, "us\\er\n<|", "<"), (1, 2, "assistant", None), (1, 3, "assistant", "é<\\|"),
            (2, None, None, None), (None, 5, "assistant", "x" * 200_000), (None, 5, "assistant", "x" * 200_000), (3, 1, "user", "b"), (3, 1, "user", "a")]
    df = spark.createDataFrame([(*x, 1) for x in rows], "conv_id long, turn long, role string, text string, formatted int").repartition(3)
    found = chat.format_conversations(df).select(
        "conv_id", "formatted", chat.read_conversation(F.col("formatted")).alias("turns"),
        chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    out = {r.conv_id: r for r in found.collect()}
    key = lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or "")
    for conv in (1, 2, 3, None):
        mine = sorted((x for x in rows if x[0] == conv), key=key)
        assert [tuple(t) for t in out[conv].turns] == [(x[2] or "", x[3] or "") for x in mine]
        assert out[conv].loss == "".join(x[3] or "" for x in mine if x[2] == "assistant")
    assert out[1].formatted.count("<|im_start|>") == 2 and out[3].formatted == "<|im_start|>user\na<|im_next|>b<|im_end|>\n"
    assert chat.format_conversations(df.where("false")).count() == 0


PAGES = [(1, "http://a.example/x", "<html><head><title>T &amp; t</title></head><body><p>One  two</p><script>no</script><a class=z href='/l'>go</a></body>"),
         (2, None, None), (None, "http://b.example/\r\nX: y", "plain < text \"'>"), (3, "", "<p>" + "long " * 50_000), (3, "", "<p>" + "long " * 50_000)]


def test_derived_records(spark):
    df = spark.createDataFrame([(*x, "r") for x in PAGES], "page_id long, url string, html string, record string").repartition(2)
    responses = warc.page_responses(df)
    out = warc.derive_records(responses).collect()
    assert len(out) == 2 * len(PAGES)
    sources = {dict(warc.parse_record(r.record)[0])["WARC-Record-ID"]: warc.parse_record(r.record) for r in responses.collect()}
    for r in out:
        headers, block = warc.parse_record(r.record)
        by = dict(headers)
        assert by["WARC-Refers-To"] == r.refers_to in sources and by["WARC-Type"] == r.record_type
        assert by["WARC-Block-Digest"] == r.block_digest == warc.digest(block) and r.content_length == len(block)
        assert by.get("WARC-Target-URI") == dict(sources[r.refers_to][0]).get("WARC-Target-URI") == r.target_uri
        if r.record_type == "metadata":
            said = dict(warc._fields(block))
            assert said["source-payload-digest"] == dict(sources[r.refers_to][0])["WARC-Payload-Digest"]
            assert said["source-header-content-type"] == "text/html; charset=utf-8"
    first = {r.record_type: warc.parse_record(r.record)[1].decode() for r in out if r.page_id == 1}
    assert first["conversion"] == "One two\ngo"
    assert "title: T & t\r\n" in first["metadata"] and "outlink: http://a.example/l\r\n" in first["metadata"]
    assert len({r.record_id for r in out}) == 2 * (len(PAGES) - 1)
    assert warc.derive_records(responses.where("false")).count() == 0


def test_coded_bodies_and_other_records():
    body = gzip.compress("<p>Grüße</p>".encode("latin-1"))
    chunked = b"%x;q=1\r\n" % 5 + body[:5] + b"\r\n" + b"%X\r\n" % (len(body) - 5) + body[5:] + b"\r\n0\r\n\r\n"
    block = b"HTTP/1.1 404 Not Found\r\nContent-Type: text/html;\r\n charset=ISO-8859-1\r\nTransfer-Encoding: chunked\r\nContent-Encoding: gzip\r\n\r\n" + chunked
    record = warc.build_record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x>")], block)
    meta, conversion = warc.derivatives(record)
    assert warc.parse_record(conversion[6])[1].decode() == "Grüße"
    assert b"source-status: HTTP/1.1 404 Not Found" in meta[6] and warc.digest(chunked).encode() in meta[6]
    for other in (b"", b"no record", warc.build_record([("WARC-Type", "request"), ("WARC-Record-ID", "<urn:y>")], block), record[:-40]):
        assert warc.derivatives(other) == []


def test_odd_lengths_and_charsets():
    def record(charset):
        block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset={charset}\r\n\r\n".encode() + "<p>é.</p>".encode()
        return warc.build_record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x>")], block)

    for charset in ("idna", "undefined", "hex", "rot13", "punycode", "no-such", "utf-16", "\u00b2"):
        assert len(warc.derivatives(record(charset))) == 2
    for length in ("\u00b2", "-1", "1" * 5000, "", " ", "0x1"):
        data = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x>\r\nContent-Length: " + length.encode() + b"\r\n\r\nabc"
        assert warc.parse_record(data) is None


def read_plainly(data):
    """A record read line by line, without the module's parser."""
    lines, rest = [], data
    while True:
        line, _, rest = rest.partition(b"\r\n")
        if not line:
            break
        lines.append(line.decode())
    headers = [tuple(x.split(": ", 1)) for x in lines[1:]]
    size = int(dict(headers)["Content-Length"])
    assert lines[0] == "WARC/1.1" and rest[size:] == b"\r\n\r\n"
    return headers, rest[:size]


def test_records_by_another_reader(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    given = {r.page_id: r for r in pages.collect()}
    sha1 = lambda x: "sha1:" + base64.b32encode(hashlib.sha1(x).digest()).decode()
    for r in warc.derive_records(warc.page_responses(pages)).collect():
        headers, block = read_plainly(r.record)
        by, page = dict(headers), given[r.page_id]
        assert by["WARC-Type"] == r.record_type and by["WARC-Block-Digest"] == sha1(block) and by["WARC-Target-URI"] == page.url
        assert by["WARC-Refers-To"] == r.refers_to and by["WARC-Record-ID"] == r.record_id and by["WARC-Refers-To-Target-URI"] == page.url
        if r.record_type == "metadata":
            said = dict(x.split(": ", 1) for x in block.decode().split("\r\n") if x)
            assert said["source-payload-digest"] == sha1(page.html.encode()) and said["source-status"] == "HTTP/1.1 200 OK"
        else:
            assert "<p" not in block.decode() and not block.decode().startswith("\n")


def test_long_conversation(spark):
    n = 60_000
    rows = spark.range(n).selectExpr("1L AS conv_id", "id AS turn", "CASE WHEN id % 3 = 0 THEN 'user' ELSE 'assistant' END AS role",
                                     "concat('é <|', id, '\\\\') AS text")
    out = chat.format_conversations(rows).select(
        F.size("loss_spans").alias("spans"), F.size(chat.read_conversation(F.col("formatted"))).alias("turns"),
        F.sha2(chat.masked_text(F.col("formatted"), F.col("loss_spans")), 256).alias("loss")).first()
    said = "".join(f"é <|{i}\\" for i in range(n) if i % 3)
    assert (out.spans, out.turns, out.loss) == (n - (n + 2) // 3, n, hashlib.sha256(said.encode()).hexdigest())


def test_planted_conversation(spark, folder):
    row = queries.queries()["op3_chat_formatting"](spark, folder).where("conv_id = -1").first()
    said = chat.PLANTED
    assert (row.n_turns, row.loss_chars) == (2, len(said))
    assert row.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
