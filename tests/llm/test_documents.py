"""Operators on documents against brute force, on texts with nulls, ties, repeated rows and very long ones."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from fleetspark.llm import lattice, mixing, pieces, quality, sharding, simhash, suffixes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, n_words string, hash string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def made_texts():
    r = random.Random(5)
    vocabulary = ["the", "of", "Ré", "and", "tion", "ß", "Straße", "ing", "été", "x", "▁y", "#a|", "日本語"]
    say = lambda n: " ".join(r.choice(vocabulary) + r.choice(vocabulary) for _ in range(n))
    shared = say(40)
    texts = [None, "", " \n\t ", "one", "a b c", "a" * 400, "ab" * 300, say(30), say(12), shared]
    texts += [say(5) + "\n" + shared + "\n" + say(8), shared + say(3), say(20) + " " + shared]
    base = say(60).split()
    for k in range(6):
        copy = list(base)
        copy[k * 7] = "changed"
        texts.append(" ".join(copy))
    texts += ["Menu of the site\n" + say(14) for _ in range(14)] + ["Menu of the  SITE\nshort"] * 2
    texts.append("\n".join([say(3)] * 9) + "\x0b\x00\r\n ▁ ")
    texts.append(say(9000))
    return texts


def rows():
    texts = made_texts()
    found = [(i, t, "en", None if i % 7 == 3 else "s" + str(i % 2 if i < 19 else 0), 1, False, "no", "h") for i, t in enumerate(texts)]
    return found + [found[9], found[9], (None, "free", None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def quality_by_hand(given, limits):
    held, hosts = defaultdict(set), defaultdict(set)
    firsts = {}
    norm = lambda line: tuple(WORD.findall(line.lower()))
    for d, t, _, s, *_ in given:
        hosts[s].add(t or "")
        for line in (t or "").split("\n"):
            if norm(line):
                held[s, norm(line)].add(t)
                if d is not None:
                    firsts[s, norm(line)] = min(d, firsts.get((s, norm(line)), d))
    out = []
    for d, t, _, s, *_ in given:
        t = t or ""
        w = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        n = Counter(windows)
        covered = {i + k for i, x in enumerate(windows) if n[x] > 1 for k in range(5)}
        cut = [x for x in lines if len(held[s, norm(x)]) > max(limits.documents, limits.share * len(hosts[s]))
               and not (d is not None and firsts.get((s, norm(x))) == d)]
        lost = sum(len(norm(x)) for x in cut)
        failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
        kept = not failed and not (lost and len(w) - lost < 10) and not 100 * (len(w) - lost) < 50 * len(w)
        out.append((d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered),
                    failed, kept, len(cut), lost))
    return sorted(out, key=repr)


def test_quality(docs, nothing):
    limits = quality.Limits(documents=3, share=0.01)
    judged = quality.apply_quality_rules(docs, limits)
    assert plain(judged, *quality.COLUMNS) == quality_by_hand(rows(), limits)
    cut = {r.doc_id: r.clean_text for r in judged.where("n_cut_lines > 0").collect()}
    assert len(cut) >= 13 and not any("Menu" in t for t in cut.values())
    same = judged.where("n_cut_lines = 0 AND NOT (clean_text <=> text)")
    assert same.isEmpty() and set(docs.columns) <= set(judged.columns)
    assert quality.apply_quality_rules(nothing).count() == 0


def prints_by_hand(text):
    from xxhash import xxh64_intdigest

    w = (text or "").encode().lower().split()
    runs = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)] * bool(w)
    hashes = [xxh64_intdigest(x, 42) for x in runs]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def groups_by_hand(given, radius=3):
    prints = [prints_by_hand(r[1]) for r in given]
    group = list(range(len(given)))
    for i in range(len(given)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = group[i], group[j]
                group = [b if x == a else x for x in group]
    ids = defaultdict(list)
    for g, r in zip(group, given):
        if r[0] is not None:
            ids[g].append(r[0])
    return sorted(((r[0], f"{p:016x}", min(ids[g], default=None)) for r, p, g in zip(given, prints, group)), key=repr)


@pytest.mark.parametrize("tile", [4096, 2])
def test_simhash(docs, nothing, tile):
    found = simhash.simhash_groups(docs, tile=tile)
    assert plain(found, "doc_id", "fingerprint", "component_id") == groups_by_hand(rows())
    assert simhash.simhash_groups(nothing).count() == 0


def test_simhash_keeps_one(docs, nothing):
    want = {c for d, f, c in groups_by_hand(rows()) if c is not None}
    kept = simhash.keep_one(docs)
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in ids if x is not None) == sorted(want)
    assert kept.columns == docs.columns and simhash.keep_one(nothing).count() == 0


def test_simhash_pairs_of_a_dense_group():
    import numpy as np

    base = np.uint64(0x0123456789ABCDEF)
    near = np.array([base ^ (np.uint64(1) << np.uint64(i)) for i in range(60)] + [base], np.uint64)
    a, b = simhash.near_links(near, near, 3, rows=16)
    assert len(a) == 60  # a tree
    a, b = simhash.near_links(near[:30], near[30:], 3, rows=8)
    assert len(a) == 60 and set(a.tolist()) | set(b.tolist()) == set(near.tolist())


def windows_by_hand(given, width=100):
    order = sorted(set((d is None, d or 0, int(suffix_tie(given, d, t)), t or "") for d, t, *_ in given))
    seen, found = set(), {}
    for none, d, _, t in order:
        data = t.encode()
        gone = bytearray(len(data))
        marks = []
        for s in range(len(data) - width + 1):
            if data[s:s + width] in seen:
                marks.append(s)
            seen.add(data[s:s + width])
        for s in marks:
            gone[s:s + width] = b"\1" * width
        kept = bytes(x for x, g in zip(data, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        found[none, d, t] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return sorted(((r[0], *found[r[0] is None, r[0] or 0, r[1] or ""]) for r in given), key=repr)


def suffix_tie(given, doc, text):
    """Ids with several texts are ordered by the hash of the text, which the test asks Spark for."""
    texts = {t or "" for d, t, *_ in given if d == doc}
    return TIES.get(text or "", 0) if len(texts) > 1 else 0


TIES = {}


def suffix_rows():
    r = random.Random(3)
    passage = "".join(r.choice("abcdefgh ") for _ in range(260))
    long = "".join(r.choice("abcdé ") for _ in range(150_000))
    return [*rows(), (900, passage + "tail" + passage), (901, "x" + passage[50:] + "y"), (900, passage[:180]), (None, passage),
            (902, long), (903, long[70_000:140_000] + "!")]


@pytest.mark.parametrize("grams", [(32, 64, 100), (100,)])
def test_suffixes(spark, nothing, grams):
    given = [tuple(x[:2]) for x in suffix_rows()]
    names = ["tie", "doc", "id", "bytes", "h", "lo", "hi", "at", "n", "runs", "n_bytes", "kept", "digit"]  # columns that stay
    df = spark.createDataFrame([(*x, *"e" * len(names)) for x in given], "doc_id long, text string, " + ", ".join(
        f"{x} string" for x in names)).repartition(3)
    TIES.update({x.t: x.h for x in df.select(F.coalesce("text", F.lit("")).alias("t"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()})
    found = suffixes.without_repeats(df, grams=grams)
    assert all(r[x] == "e" for r in found.select("tie", "doc", "id", "bytes", "runs", "digit").collect() for x in r.__fields__)
    got = plain(found, "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256))
    assert got == windows_by_hand(given)
    assert suffixes.without_repeats(nothing).count() == 0


def test_suffixes_keep_whole_characters(spark):
    data = "é" * 60 + "b"
    df = spark.createDataFrame([(1, data), (2, "a" + data)], "doc_id long, text string")
    texts = {r.doc_id: r.kept_text for r in suffixes.without_repeats(df).collect()}
    assert texts[1] in ("é" * 50 + "b", "é" * 51 + "b", "é" * 50, "éb", data) or texts[1].replace("é", "").replace("b", "") == ""
    assert "�" not in texts[1] + texts[2]


def test_mixing(docs, nothing):
    found = mixing.take_counts(docs)
    out = found.collect()
    assert len(out) == len(rows()) and sorted(map(repr, out)) == sorted(map(repr, mixing.take_counts(docs.repartition(5)).collect()))
    sizes = defaultdict(int)
    for d, t, _, s, *_ in rows():
        sizes[s] += len(WORD.findall(t or ""))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, rest, open_ = {}, 1.5 * sum(sizes.values()), set(order)
    while True:
        rate = rest / sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * rate > 2 * sizes[s]}
        if not above:
            break
        for s in above:
            target[s] = 2.0 * sizes[s]
            rest -= target[s]
        open_ -= above
    target |= {s: weight[s] * rate for s in open_}
    taken, largest = defaultdict(int), defaultdict(int)
    for r in out:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, target[r.source])
        assert r.taken == r.copies * r["size"] <= 2 * r["size"]
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    for s in order:
        assert abs(taken[s] - target[s]) <= largest[s]
    assert mixing.take_counts(nothing).count() == 0
    mixed = mixing.mixed(docs)
    assert mixed.count() == sum(r.copies for r in out) and mixed.columns == docs.columns


def test_pivotal_rounding_keeps_mass_and_expectation():
    masses = [(float(s), f) for s, f in zip(range(40, 0, -1), [0.25, 0.5, 0.7, 0.0, 1.0] * 8)]
    total = sum(s * f for s, f in masses)
    hits = Counter()
    for seed in range(2000):
        out = mixing.pivotal(masses, random.Random(seed))
        assert math.isclose(sum(s * f for (s, _), f in zip(masses, out)), total, rel_tol=1e-9)
        assert sum(0.0 < f < 1.0 for f in out) <= 1
        hits[0] += out[0]
    assert abs(hits[0] / 2000 - 0.25) < 0.05


def test_mixing_in_many_groups(spark):
    given = [(i, "w " * (1 + i % 9), None, "a") for i in range(3000)]
    df = spark.createDataFrame(given, "doc_id long, text string, lang string, source string")
    other = spark.createDataFrame([(i, "w " * 40, None, "b") for i in range(5000, 5100)], df.schema)
    out = mixing.take_counts(df.unionByName(other), group=16).groupBy("source").agg(
        F.sum("taken").alias("n"), F.first("target").alias("t"), F.max("size").alias("m")).collect()
    assert all(abs(r.n - r.t) <= r.m for r in out)


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load_vocabulary(pieces.default_path())


def best_by_hand(word, v):
    best = [(0.0, [])]
    for end in range(1, len(word) + 1):
        options = [(best[s][0] + v.scores[word[s:end]], best[s][1] + [word[s:end]]) for s in range(end) if word[s:end] in v.scores]
        if word[end - 1] not in v.scores:
            options.append((best[end - 1][0] + v.uncovered, best[end - 1][1] + [word[end - 1]]))
        best.append(max(options, key=lambda x: x[0]))  # of equal ones the first start
    return best[-1]


def test_best_pieces_of_words(vocabulary):
    r = random.Random(2)
    made = sorted({"▁" + "".join(r.choice(["th", "e", "ing", "é", "日", "\ud800", "q", "tion", "ñ", "𝄞"]) for _ in range(r.randrange(1, 9))) for _ in range(300)})
    for word, ids, score in pieces.forward_best(made, vocabulary):
        want = best_by_hand(word, vocabulary)
        back = {i: p for p, i in vocabulary.ids.items()}
        got = []
        for i in ids:
            got.append(back.get(i))
        assert math.isclose(score, want[0], rel_tol=1e-12)
        assert [x for x in got if x] == [x for x in want[1] if x in vocabulary.ids]


@pytest.mark.parametrize("part", [1, 7, 4 << 20])
def test_runs_of_words(vocabulary, monkeypatch, part):
    """Whatever the size of the runs, the pieces are those of the marked words one by one."""
    monkeypatch.setattr(pieces, "PART", part)
    given = ["", " ", "\n", "▁", " ▁ x", "a  b\n\n c \n", "日本語 テスト\x00 ▁▁", "  two", "x" * 50, "one\ntwo  three\n", "é é é"]
    runs, owner = [], []
    for i, text in enumerate(given):
        for run in pieces._runs(text):
            runs.append(run)
            owner.append(i)
    encoder = pieces._Encoder(vocabulary)
    ids, counts, scores = encoder.encode(runs)
    found = defaultdict(list)
    at = 0
    for i, n in zip(owner, counts):
        found[i] += ids[at:at + n].tolist()
        at += n
    for i, text in enumerate(given):
        marked = ("▁" + text.replace("▁", "\ud800").replace(" ", "▁")) if text else ""
        words = re.findall("▁+[^▁\n]*|[^▁\n]+|\n", marked)
        best = {w: (x, score) for w, x, score in pieces.forward_best(sorted(set(words)), vocabulary)}
        assert found[i] == [x for w in words for x in best[w][0]]
        assert sum(s for s, o in zip(scores, owner) if o == i) == sum(best[w][1] for w in words)


def test_pieces_round_trip(docs, nothing, vocabulary):
    both = pieces.decode_pieces(pieces.encode_pieces(docs, vocabulary), vocabulary)
    assert both.where("NOT (decoded <=> coalesce(text, ''))").isEmpty() and both.count() == len(rows())
    assert pieces.encode_pieces(nothing, vocabulary).count() == 0


def test_reading_odd_ids(spark, vocabulary):
    """Null arrays stay null; null ids and ids of no piece read as nothing."""
    ids = pieces.encode_pieces(spark.createDataFrame([("one two",)], "text string"), vocabulary).first().pieces
    odd = [None, [], [None, *ids, -1, 10**6, None], [vocabulary.of_bytes[0xFF]]]
    out = pieces.decode_pieces(spark.createDataFrame([(i, x) for i, x in enumerate(odd)], "i int, pieces array<int>"), vocabulary)
    assert [r.decoded for r in out.orderBy("i").collect()] == [None, "", "one two", "\ufffd"]


def test_reading_back_in_one_step(docs, vocabulary):
    two = pieces.decode_pieces(pieces.encode_pieces(docs, vocabulary), vocabulary)
    assert plain(pieces.encode_pieces(docs, vocabulary, read_back="decoded"), "doc_id", "pieces", "pieces_score", "decoded") == plain(
        two, "doc_id", "pieces", "pieces_score", "decoded")


def test_shards(docs, nothing, spark, tmp_path):
    slotted = sharding.with_slots(docs)
    loads = sharding.slot_loads(slotted)
    placed = sharding.first_map(loads, 3)
    sharding.save_map(sharding.map_table(spark, loads, placed, 3, 1), str(tmp_path / "map"))
    out = sharding.assign_shards(slotted, sharding.load_map(spark, str(tmp_path / "map"))).collect()
    assert len(out) == len(rows())
    for r in out:
        data = (r.text or "").encode()
        assert (r["size"], r.text_crc32) == (len(data) + 8, zlib.crc32(data))
    by = defaultdict(list)
    for r in out:
        by[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in by.values())
    grown = sharding.edited_map(loads, placed, 4)
    held = Counter()
    for slot, size, _ in loads:
        held[grown[slot]] += size
    biggest = max(size for _, size, _ in loads)
    assert max(held.values()) - min(held.values()) <= max(biggest, 2 * min(held.values()))
    before = Counter()
    for slot, size, _ in loads:
        before[placed[slot]] += size
    assert max(before.values()) - min(before[k] for k in range(3)) <= biggest
    sharding.save_map(sharding.map_table(spark, loads, grown, 4, 2), str(tmp_path / "map"))
    assert sharding.load_map(spark, str(tmp_path / "map")).agg(F.max("shards")).first()[0] == 4
    assert sharding.load_map(spark, str(tmp_path / "map"), 1).agg(F.max("shards")).first()[0] == 3
    empty = sharding.with_slots(nothing)
    assert sharding.assign_shards(empty, sharding.map_table(spark, sharding.slot_loads(empty), sharding.first_map(sharding.slot_loads(empty), 3), 3, 1)).count() == 0


def test_shards_of_documents(spark, folder):
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    out = sharding.op9_virtual_slots(spark, folder).collect()
    assert sorted(r.doc_id for r in out) == sorted(docs)
    held, grown, places = Counter(), Counter(), defaultdict(list)
    for r in out:
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(docs[r.doc_id]) + 8, zlib.crc32(docs[r.doc_id]), "bytes", None)
        held[r.shard] += r["size"]
        grown[r.next_shard] += r["size"]
        places[r.shard].append(r.slot)
    assert set(held) <= set(range(24)) and all(sorted(x) == list(range(len(x))) for x in places.values())
    largest = max(r["size"] for r in out)  # few documents: a slot holds one or two
    for loads, n in ((held, 24), (grown, 25)):
        assert max(loads.values()) - min(loads[k] for k in range(n)) <= 2 * largest
    assert sum(r["size"] for r in out if r.shard != r.next_shard) <= 0.35 * sum(held.values())


def test_growing_a_shard_map_moves_little():
    r = random.Random(1)
    loads = [(s, r.randrange(900, 1100), 1) for s in range(4096)]
    placed = sharding.first_map(loads, 24)
    grown = sharding.edited_map(loads, placed, 25)
    held = Counter()
    for slot, size, _ in loads:
        held[grown[slot]] += size
    assert max(held.values()) - min(held.values()) <= 2200
    assert sum(grown[s] != placed[s] for s in placed) < 4096 / 25 + 60


def test_marginals_sum_all_segmentations():
    model = lattice.Lattice({p: math.log(x) for p, x in {"▁": .1, "a": .2, "b": .1, "ab": .15, "▁a": .2, "▁ab": .05, "ba": .1}.items()}, [math.log(1e-3)] * 256)

    def total(word):
        if not word:
            return 1.0
        p = sum(math.exp(model.log_p[word[:k]]) * total(word[k:]) for k in range(1, len(word) + 1) if word[:k] in model.log_p)
        return p + (math.exp(model.bytes_of(word[0])) * total(word[1:]) if word[0] not in model.log_p else 0.0)

    made = sorted("▁" + x for x in ("", "a", "ab", "aba", "abab", "bba", "aéb", "ﬀ", "ba\ud800", "abba"))
    for word, got, best in zip(made, model.marginals(made), model.best(made)):
        assert math.isclose(math.exp(got), total(word), rel_tol=1e-9)
        assert "".join(reversed(best)) == word


def test_lattice_scores(docs, nothing, vocabulary, monkeypatch):
    monkeypatch.setattr(lattice, "PACKET", 300)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    counts, out = Counter(), {}
    is_held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    for d, t, *_ in rows():
        if not is_held(d):
            counts.update((t or "").encode().lower().split())
            counts["end"] += 1
    n, v = sum(counts.values()), len(counts)
    want = []
    for d, t, *_ in rows():
        tokens = [*(t or "").encode().lower().split(), "end"]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
        want.append((d, is_held(d), len(tokens), sum(counts[w] > 0 for w in tokens), n, round(base, 6)))
    found = lattice.score_documents(docs, held, vocabulary)
    assert plain(found, "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 6)) == sorted(want, key=repr)
    assert found.where("NOT (score < 0)").isEmpty()
    assert lattice.score_documents(nothing, held, vocabulary).count() == 0


def test_packets_travel_in_small_rows(docs, vocabulary, monkeypatch):
    """No row holds more than a part of a packet, no aggregate gathers a packet's words, and the scores stay the same."""
    held = F.col("doc_id") % 3 == 0
    whole = sorted(lattice.score_documents(docs, held, vocabulary).collect(), key=str)
    monkeypatch.setattr(lattice, "PART", 3, raising=False)
    sizes = lattice.pack(docs, held).select(F.greatest(*(F.size(c) for c in ("ids", "held", "owner", "word", "times", "words", "trained"))).alias("n"))
    assert [r.n for r in sizes.agg(F.max("n").alias("n")).collect()] == [3]
    scored = lattice.score_documents(docs, held, vocabulary)
    assert sorted(scored.collect(), key=str) == whole and len(whole) > 3
    assert "collect_list" not in scored._jdf.queryExecution().executedPlan().toString()
