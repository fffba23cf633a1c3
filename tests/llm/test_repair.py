"""Conversation repair against an exhaustive search of edits."""

import hashlib
import random
import zlib
from itertools import product

import pytest

from fleetspark.llm import queries, repair

WORDLESS = set("\x20\t\n\x0b\x0c\r")


def judge(rows):
    """Rows (turn, role, text) in order: with blank, duplicate and truncated."""
    seen, out = set(), []
    for turn, role, text in rows:
        bare = text.strip("".join(WORDLESS))
        blank = not bare
        duplicate = not blank and (role, text) in seen
        out.append((role, text, blank, duplicate, not blank and not duplicate and bare[-1] not in ".!?"))
        seen.add((role, text))
    return out


def legal(initials):
    rest = initials[1:] if initials[:1] == "s" else initials
    return initials == "" or (len(rest) > 0 and rest == "ua" * (len(rest) // 2))


def cheapest(rows):
    """All edits with at most two inserts before each row and at the end."""
    best = None
    extras = ["", "u", "a", "ua", "au"]
    choices = [[("D", "", 2)] if b or d else [("D", "", 2), ("K", r[:1] or "?", 5 * t), ("R", "u", 1 + 5 * t), ("R", "a", 1 + 5 * t)]
               for r, _, b, d, t in rows]
    for edits in product(*choices):
        for inserts in product(extras, repeat=len(rows) + 1):
            cost = sum(e[2] for e in edits) + 5 * sum(map(len, inserts))
            if best and cost > best[0]:
                continue
            initials = "".join(i + e[1] for i, e in zip(inserts, edits)) + inserts[-1]
            if legal(initials):
                audit = "".join("I" * len(i) + e[0] for i, e in zip(inserts, edits)) + "I" * len(inserts[-1])
                best = min(best or (cost, audit), (cost, audit))
    return best


def repaired(rows, audit):
    state, rows, out = 0, iter(rows), []
    after = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(rows)[:2]
        if letter == "D":
            continue
        if letter != "K":
            role = "assistant" if state == 2 else "user"
        state = after[state, role[0]]
        out.append((role, text))
    return out


def by_turn(rows):
    clean = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(clean, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))


SCHEMA = "conv_id long, turn long, role string, text string, conv string, audit int, n string, kind int, code string"


def made():
    r = random.Random(3)
    texts = ["Yes.", "No", "Why?", "", " \n", "Go on!", "and so", "One. ", "…", None]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None, ""]
    found = {}
    for conv in range(60):
        found[conv] = [(i if r.random() < 0.8 else r.choice([None, 1, 2, 90]), r.choice(roles), r.choice(texts)) for i in range(r.randrange(1, 5))]
    found[100] = [(0, "user", "Hi."), (0, "user", "Hi."), (0, "user", "A."), (None, "assistant", "B.")]
    found[None] = [(1, "user", "x" * 300_000 + "."), (2, "assistant", "Fine.")]
    found[101] = [(None, "user", None), (None, None, None)]
    return found


@pytest.mark.parametrize("least_block", [2, 64])
def test_edits(spark, least_block):
    found = made()
    flat = [(c, *row, "x", 1, "y", 7, "z") for c, rows in found.items() for row in rows]
    df = spark.createDataFrame(flat, SCHEMA).repartition(3)
    judged = repair.judge_conversations(df, least_block=least_block)
    turns = repair.repair_conversations(df, judged)
    hashed = {x.conv_id: x.repaired_sha256 for x in repair.digests(turns).collect()}
    out = {x.conv_id: x for x in judged.collect()}
    assert set(out) == set(found)
    for conv, rows in found.items():
        rows = by_turn(rows)
        judged_rows = judge(rows)
        known = [t for t, _, _ in rows if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        pairs = [(a[1][:1] + b[1][:1]) for a, b in zip(rows, rows[1:])]
        got = out[conv]
        assert (got.gaps, got.blank, got.duplicate, got.truncated, got.illegal) == (
            gaps, *(sum(x[k] for x in judged_rows) for k in (2, 3, 4)), sum(p not in ("su", "ua", "au") for p in pairs)), conv
        assert (got.cost, got.audit) == cheapest(judged_rows), conv
        lines = "\n".join(f"{r}:{x}" for r, x in repaired(judged_rows, got.audit))
        want = hashlib.sha256(lines.encode()).hexdigest()
        assert hashed.get(conv, hashlib.sha256(b"").hexdigest()) == want, conv


def forward(rows):
    """Cheapest and least edits by going forward: per state, the best cost and letters so far."""
    after = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    fit = {0: 2, 1: 2, 2: 3, 3: 2}

    def grown(at):
        found = dict(at)
        for s, (cost, letters) in at.items():
            for _ in range(2):
                s, cost, letters = fit[s], cost + 5, letters + "I"
                found[s] = min(found.get(s, (cost, letters)), (cost, letters))
        return found

    at = {0: (0, "")}
    for role, _, blank, duplicate, cut in rows:
        step = {}
        for s, (cost, letters) in grown(at).items():
            ways = [(s, cost + 2, "D")]
            if not (blank or duplicate):
                ways.append((fit[s], cost + 1 + 5 * cut, "R"))
                if (s, role[:1]) in after:
                    ways.append((after[s, role[:1]], cost + 5 * cut, "K"))
            for t, c, e in ways:
                step[t] = min(step.get(t, (c, letters + e)), (c, letters + e))
        at = step
    return min((c, x) for s, (c, x) in grown(at).items() if s in (0, 3))


def test_long_conversation(spark):
    r = random.Random(8)
    rows = [(i, r.choice(["user", "assistant", "assistant", "tool", "system"]), r.choice(["Yes.", "no", ""]) + f" {i}" + r.choice([".", ""])) for i in range(3000)]
    df = spark.createDataFrame([(7, *x) for x in rows], "conv_id long, turn long, role string, text string").repartition(5)
    got = repair.judge_conversations(df, least_block=4).first()
    assert (got.cost, got.audit) == forward(judge(rows))
    assert got.illegal == sum(a[1][0] + b[1][0] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))


def test_no_conversations(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    judged = repair.judge_conversations(df)
    assert judged.count() == 0 and repair.repair_conversations(df, judged).count() == 0


def test_damage(spark, folder):
    given = spark.read.parquet(f"{folder}/conversations.parquet").collect()
    want = []
    for x in given:
        draw = zlib.crc32(f"{x.conv_id}:{x.turn}".encode()) % 20
        text = "" if draw == 1 else x.text.translate({ord(c): None for c in ".!?"}) if draw == 2 else x.text
        want += [(x.conv_id, x.turn, "user" if draw == 4 else x.role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1)
    got = repair.damaged(spark.read.parquet(f"{folder}/conversations.parquet"))
    assert sorted(tuple(x) for x in got.collect()) == sorted(want)


def test_dropped_conversation_stays(spark, tmp_path):
    dropped = next(i for i in range(10_000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(dropped, 0, "user", "Hi."), (None, None, None, None), (-5, 2, "user", "Hi.")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    out = {x.conv_id: x for x in queries.queries()["op11_structure_repair"](spark, str(tmp_path)).collect()}
    assert set(out) == {dropped, None, -5}
    gone = out[dropped]
    assert gone.audit == "" and gone.cost == gone.gaps == gone.illegal == 0 and gone.repaired_sha256 == hashlib.sha256(b"").hexdigest()
