"""Personal data against plain patterns applied with Python's re."""

import random
import re

import pytest
from pyspark.sql import functions as F

from fleetspark.llm import pii
from fleetspark.llm.common import running_sums

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
         "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base(text):
    found = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
                    "ip": kind == "ip" and max(int(x[-400:]) for x in m.group().split(".")) <= 255}[kind]
            if good:
                found.append((kind, m.start(), m.end(), m.group()))
    return found


def texts():
    r = random.Random(6)
    signs = ["a", "b@", "@", ".", "c.de", "-", "_", "+", "+1", " ", "0", "12", "4111 1111 1111 1111", "255", "256.1.1.1", "(", ")", "é", "𝒳", "\n", "%", "1.2.3.4", "007.08.9.255"]
    made = ["".join(r.choice(signs) for _ in range(r.randrange(60))) for _ in range(400)]
    made += [None, "", "a@b.c_d@e.f", "a@b.c.d@e.f", "x@y", "1.2.3.4.5.6.7.8", "4539-5787 6362 1486", "+1 (743) 555-3824.", "+123", "𝒳𝒳a@b.cc 𝒳 10.0.0.1"]
    made += ["a" * 900, "a" * 500 + "@b" + ".c" * 400, "1." * 600, "9" * 900, "+1" + " " * 500 + "2", "5 " * 600, "a@b.c " * 300, "@" * 500]
    return made


#: Very long texts, on which plain patterns would take time in proportion to the square of the length, and what they hold.
LONG = [("a" * 300_000, []), ("a" * 200_000 + "@b" + ".c" * 50_000, [("email", 0, 300_002)]), ("9" * 300_000, []), ("@" * 100_000, []),
        ("+1" + " " * 200_000 + "2", []), ("+" * 100_000, []), ("5 " * 100_000, []),
        ("a@b.c " * 20_000, [("email", 6 * i, 6 * i + 5) for i in range(20_000)]),
        ("1." * 100_000, [("ip", 8 * i, 8 * i + 7) for i in range(25_000)])]


@pytest.fixture(scope="module")
def found(spark):
    given = [(i, t, 1, "x") for i, t in enumerate(texts())]
    df = spark.createDataFrame(given + given[:5], "doc_id long, text string, base int, kind string").repartition(4)
    return pii.find_personal_data(df).collect()


def test_base(found):
    made = texts()
    assert len(found) == len(made) + 5
    for row in found:
        assert [(s.kind, s.start, s.end, s.value) for s in row.base] == base(made[row.doc_id]), (made[row.doc_id] or "")[:200]
        assert row.kind == "x"


def test_long_texts(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(LONG)], "doc_id long, text string").repartition(4)
    out = {r.doc_id: [(s.kind, s.start, s.end) for s in r.base] for r in pii.find_personal_data(df).collect()}
    for i, (_, spans) in enumerate(LONG):
        assert out[i] == spans, i


ADDED = [
    ("Transfer to IBAN GB82 WEST 1234 5698 7654 32, thanks", ["iban"], 1.0),
    ("code DE89370400440532013000.", ["iban"], 0.7),
    ("code DE88370400440532013000.", [], None),
    ("XDE89370400440532013000", [], None),
    ("my SSN is 123-45-6789", ["ssn"], 0.6),
    ("part 123-45-6789", [], None),
    ("ssn 666-45-6789 or 123-00-6789, 123-45-0000", [], None),
    ("Call (212) 555-0187 now", ["national"], 0.6),
    ("order (212) 555-0187 now", [], None),
    ("call +1 (212) 555-0187 now", [], None),
    ("telephone" + " " * 40 + "212-555-0187", [], None),
    ("recall 212-555-0187", [], None),
    ("212.555.0187 is my cell", ["national"], 0.6),
]


def test_added(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(ADDED)], "doc_id long, text string")
    out = {r.doc_id: r.added for r in pii.find_personal_data(df).collect()}
    for i, (text, kinds, score) in enumerate(ADDED):
        assert [s.kind for s in out[i]] == kinds, text
        for s in out[i]:
            assert text[s.start:s.end] == s.value and abs(s.score - score) < 1e-9, text


def test_scores(spark):
    df = spark.createDataFrame([(1, "visa card 4111111111111111"), (2, "so 4111111111111111"), (3, "a@b.cc mail"), (4, "a@b.cc")], "doc_id long, text string")
    out = {r.doc_id: round(r.base[0].score, 6) for r in pii.find_personal_data(df).collect()}
    assert out == {1: 1.0, 2: 0.7, 3: 1.0, 4: 0.7}


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find_personal_data(df).count() == 0


def test_no_python_no_shuffle(spark, folder):
    plan = pii.op13_personal_data(spark, folder)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_running_sums(spark):
    given = [[], [5], [1, 2], list(range(-50, 50)), [1] * 100_003]
    out = spark.createDataFrame([(i, x) for i, x in enumerate(given)], "i int, x array<long>").select("i", running_sums(F.col("x")).alias("s")).collect()
    for r in out:
        total, want = 0, []
        for x in given[r.i]:
            total += x
            want.append(total)
        assert r.s == want
