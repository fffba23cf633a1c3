r"""Repair of conversation structure: the cheapest edits that leave an optional system turn and user/assistant pairs.

The states of a conversation are: start, after system, after user, after assistant. Keeping a row costs 0, another role 1,
deleting 2, inserting an empty turn 5, and a truncated row that stays 5 more. Blank and duplicate rows have to go.

Square-root checkpoints: the rows of all conversations are sorted by ranges and cut into blocks of at most the square root
of the longest conversation's rows. (1) Every block becomes a matrix of costs from each state before to each state after
it. (2) Per conversation these are folded backward, which gives the vector of remaining costs at each checkpoint, and no
vector between them is kept. (3) Walking forward, a block recomputes its vectors from the checkpoint behind it and writes
down, for each state before it, the least tight letters. (4) Per conversation the states are followed through the blocks.
No task holds more of a conversation than a block, one entry per checkpoint and one letter per row, so a conversation
with most of the rows is spread over the tasks. Texts are read again in order to apply the edits, as a stream.

Defined results: null roles and texts are one blank; a null conversation id is a conversation; rows sort by turn (null
first), then role, then text; repeated rows are duplicates of the first; texts of any length are looked at whole; columns
other than the four are left out; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from fleetspark.llm.common import BLANKS, table
from fleetspark.session import stored

ROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
NEVER = 1 << 60
#: States: 0 start, 1 after system, 2 after user, 3 after assistant. KEEP[class of role][state] is the state after keeping.
KEEP = ((1, None, None, None), (2, 2, None, 2), (None, None, 3, None), (None, None, None, None))
NEXT = (2, 2, 3, 2)  # after a user or assistant turn, whichever fits
END = (0, 10, 5, 0)  # inserts that complete a conversation
GONE, CUT = 4, 8  # bits of a row's code above the class of its role
LEAST_BLOCK = 64


def _before(code: int, after: list[int]) -> list[int]:
    """Remaining costs before a row, given those behind it; turns may be inserted before the row."""
    costs = []
    for state in range(4):
        cost = DELETE + after[state]
        if not code & GONE:
            extra = TRUNCATED if code & CUT else 0
            cost = min(cost, ROLE + extra + after[NEXT[state]])
            kept = KEEP[code & 3][state]
            if kept is not None:
                cost = min(cost, extra + after[kept])
        costs.append(cost)
    costs[2], costs[3] = min(costs[2], INSERT + costs[3]), min(costs[3], INSERT + costs[2])
    return [min(costs[0], INSERT + costs[2]), min(costs[1], INSERT + costs[2]), costs[2], costs[3]]


def block_costs(codes: list[int]) -> list[int]:
    """Costs from each state before a block (rows) to each state behind it (columns), as one list of 16."""
    columns = []
    for end in range(4):
        vector = [0 if s == end else NEVER for s in range(4)]
        for code in reversed(codes):
            vector = _before(code, vector)
        columns.append(vector)
    return [min(columns[e][s], NEVER) for s in range(4) for e in range(4)]


def checkpoints(blocks: list[list[int]]) -> list[list[int]]:
    """Remaining costs before each block and at the end, folded backward from the end."""
    found = [list(END)]
    for costs in reversed(blocks):
        behind = found[-1]
        found.append([min(costs[4 * s + e] + behind[e] for e in range(4)) for s in range(4)])
    return found[::-1]


def walk(codes: list[int], after: list[int]) -> list[tuple[int, str]]:
    """For each state before a block: the state behind it and the ASCII-least of the cheapest edits."""
    vectors = [after]
    for code in reversed(codes):
        vectors.append(_before(code, vectors[-1]))
    vectors.reverse()
    found = []
    for state in range(4):
        letters = []
        if vectors[0][state] < NEVER:
            for i, code in enumerate(codes):
                behind = vectors[i + 1]
                while True:
                    left = vectors[i][state]
                    extra = TRUNCATED if code & CUT else 0
                    kept = KEEP[code & 3][state]
                    if DELETE + behind[state] == left:
                        letters.append("D")
                    elif INSERT + vectors[i][NEXT[state]] == left:
                        letters.append("I")
                        state = NEXT[state]
                        continue
                    elif kept is not None and not code & GONE and extra + behind[kept] == left:
                        letters.append("K")
                        state = kept
                    else:
                        letters.append("R")
                        state = NEXT[state]
                    break
        found.append((state, "".join(letters)))
    return found


def _illegal(classes: list[int]) -> int:
    return sum((a, b) not in ((0, 1), (1, 2), (2, 1)) for a, b in zip(classes, classes[1:]))


def _clean(turns: DataFrame, id_col: str, turn: str, role: str, text: str) -> DataFrame:
    blank = lambda c: F.coalesce(F.col(c), F.lit(" "))
    return turns.select(F.col(id_col).alias("conv"), F.col(turn).cast("long").alias("turn"), blank(role).alias("role"), blank(text).alias("text"))


def row_codes(turns: DataFrame) -> DataFrame:
    """Stored (conv, turn, n, blank, duplicate, truncated, code): n rises in the order of conversations and their rows.

    Sorting by ranges of all columns and the place in the input spreads a conversation, and even equal rows, over tasks.
    """
    order = ["conv", "turn", "role", "text"]
    last = F.right(F.btrim("text", F.lit(BLANKS)), F.lit(1))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    ranged = turns.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(*order, "place").sortWithinPartitions(*order)
    rows = stored(ranged.select(
        "conv", "turn", F.monotonically_increasing_id().alias("n"), (last == "").alias("blank"),
        ((last != "") & ~last.isin(".", "!", "?")).alias("open"), kind.alias("class"),
        F.unhex(F.sha2(F.concat_ws(":", F.char_length("role").cast("string"), "role", "text"), 256)).alias("said")), "turn-rows")
    first = rows.where("NOT blank").groupBy("conv", "said").agg(F.min("n").alias("first")).select("first")
    judged = rows.join(first, rows["n"] == first["first"], "left").withColumn("duplicate", F.expr("NOT blank AND first IS NULL"))
    judged = judged.withColumn("truncated", F.expr("open AND NOT duplicate"))
    code = F.col("class") + F.when(F.expr("blank OR duplicate"), GONE).otherwise(0) + F.when(F.col("truncated"), CUT).otherwise(0)
    return stored(judged.select("conv", "turn", "n", "blank", "duplicate", "truncated", code.cast("byte").alias("code")), "turn-codes")


def _blocks(rows: DataFrame, least: int) -> DataFrame:
    longest = rows.groupBy("conv").count().agg(F.max("count")).first()[0] or 0
    size = max(least, int(np.ceil(np.sqrt(longest))))
    part, index = F.shiftright("n", 33), F.col("n").bitwiseAND(F.lit((1 << 33) - 1))
    block = F.shiftleft(part, 33) + F.floor(index / size)
    sorted_codes = F.sort_array(F.collect_list(F.struct("n", "code")))
    return stored(rows.groupBy("conv", block.alias("block")).agg(
        F.transform(sorted_codes, lambda x: x["code"].cast("int")).alias("codes")), "turn-blocks")


def _of(df: DataFrame) -> str:
    return f"conv {df.schema['conv'].dataType.simpleString()}"


def cheapest_edits(rows: DataFrame, least_block: int = LEAST_BLOCK) -> DataFrame:
    """(conv, cost, audit, illegal) from the codes of rows; audit has one letter per row and insert, in order."""
    blocks = _blocks(rows, least_block)

    def cost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column("codes").to_pylist()
            yield pa.RecordBatch.from_arrays([
                batch.column("conv"), batch.column("block"), pa.array([block_costs(c) for c in codes], pa.list_(pa.int64())),
                pa.array([[_illegal([x & 3 for x in c]), c[0] & 3, c[-1] & 3] for c in codes], pa.list_(pa.int64()))],
                ["conv", "block", "costs", "ends"])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, illegal = [], []
            for chain in batch.column("chain").to_pylist():
                vectors = checkpoints([x["costs"] for x in chain])
                found.append([{"block": x["block"], "after": v, "total": vectors[0][0]} for x, v in zip(chain, vectors[1:])])
                ends = [x["ends"] for x in chain]
                illegal.append(sum(x[0] for x in ends) + sum(_illegal([a[2], b[1]]) for a, b in zip(ends, ends[1:])))
            points = pa.list_(pa.struct([("block", pa.int64()), ("after", pa.list_(pa.int64())), ("total", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("conv"), pa.array(found, points), pa.array(illegal, pa.int64())],
                                             ["conv", "points", "illegal"])

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [walk(c, a) for c, a in zip(batch.column("codes").to_pylist(), batch.column("after").to_pylist())]
            yield pa.RecordBatch.from_arrays([
                batch.column("conv"), batch.column("block"), batch.column("total"), batch.column("illegal"),
                pa.array([[s for s, _ in d] for d in done], pa.list_(pa.int32())),
                pa.array([[x for _, x in d] for d in done], pa.list_(pa.string()))],
                ["conv", "block", "total", "illegal", "exits", "letters"])

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            audits = []
            for chain in batch.column("chain").to_pylist():
                state, letters = 0, []
                for x in chain:
                    letters.append(x["letters"][state])
                    state = x["exits"][state]
                audits.append("".join(letters) + "I" * (END[state] // INSERT))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), batch.column("total"), pa.array(audits, pa.string()), batch.column("illegal")],
                ["conv", "cost", "audit", "illegal"])

    conv = _of(rows)
    costs = blocks.mapInArrow(cost, f"{conv}, block long, costs array<long>, ends array<long>")
    chained = costs.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("block", "costs", "ends"))).alias("chain"))
    points = chained.mapInArrow(fold, f"{conv}, points array<struct<block:long,after:array<long>,total:long>>, illegal long")
    points = points.select(F.col("conv").alias("of"), "illegal", F.inline("points"))
    met = blocks.join(points.withColumnRenamed("block", "at"), F.expr("conv <=> of AND block = at")).select(
        "conv", "block", "codes", "after", "total", "illegal")
    walked = met.mapInArrow(steps, f"{conv}, block long, total long, illegal long, exits array<int>, letters array<string>")
    chains = walked.groupBy("conv").agg(F.max("total").alias("total"), F.max("illegal").alias("illegal"),
                                        F.sort_array(F.collect_list(F.struct("block", "exits", "letters"))).alias("chain"))
    return chains.mapInArrow(follow, f"{conv}, cost long, audit string, illegal long")


def judge_conversations(turns: DataFrame, id_col: str = "conv_id", turn: str = "turn", role: str = "role",
                        text: str = "text", least_block: int = LEAST_BLOCK) -> DataFrame:
    """One stored row per conversation: id, gaps, blank, duplicate, truncated, illegal, cost, audit."""
    rows = row_codes(_clean(turns, id_col, turn, role, text))
    add = lambda c: F.sum(F.col(c).cast("long")).alias(c)
    counted = rows.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).alias("gaps"),
        add("blank"), add("duplicate"), add("truncated"))
    edits = cheapest_edits(rows, least_block).withColumnRenamed("conv", "of")
    return stored(counted.join(edits, F.expr("conv <=> of")).select(
        F.col("conv").alias(id_col), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"), "judged-conversations")


def repair_conversations(turns: DataFrame, judged: DataFrame, id_col: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text") -> DataFrame:
    """The repaired turns (id, role, text) with edits applied, those of a conversation together and in order.

    A conversation's edits come before its rows in one sorted stream: a task holds the edits, never the texts.
    """
    clean = _clean(turns, id_col, turn, role, text)
    edits = judged.select(F.col(id_col).alias("conv"), F.lit(0).alias("kind"), "audit")
    rows = clean.withColumn("kind", F.lit(1)).unionByName(edits, allowMissingColumns=True)
    streamed = rows.repartition("conv").sortWithinPartitions("conv", "kind", "turn", "role", "text")
    streamed = streamed.select("conv", "kind", "role", "text", "audit")
    schema = pa.schema([("conv", to_arrow_type(clean.schema["conv"].dataType)), ("role", pa.string()), ("text", pa.string())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, at, state = None, "", 0, 0

        def inserted() -> None:
            nonlocal at, state
            while at < len(audit) and audit[at] == "I":
                state = NEXT[state]
                out[0].append(conv)
                out[1].append("assistant" if state == 3 else "user")
                out[2].append("")
                at += 1

        for batch in batches:
            out: list[list] = [[], [], []]
            kinds, roles, texts = (batch.column(c).to_pylist() for c in ("kind", "role", "text"))
            for i, (kind, said, words) in enumerate(zip(kinds, roles, texts)):
                if kind == 0:
                    conv, audit, at, state = batch.column("conv")[i].as_py(), batch.column("audit")[i].as_py(), 0, 0
                    inserted()
                    continue
                letter, at = audit[at], at + 1
                if letter == "K":
                    state = KEEP[{"s": 0, "u": 1, "a": 2}[said[0]]][state]
                elif letter == "R":
                    state = NEXT[state]
                    said = "assistant" if state == 3 else "user"
                if letter != "D":
                    out[0].append(conv)
                    out[1].append(said)
                    out[2].append(words)
                inserted()
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    return streamed.mapInArrow(apply, f"{_of(clean)}, role string, text string").withColumnRenamed("conv", id_col)


def digests(repaired: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id, repaired_sha256): hash of ``role:text`` of all turns, joined by line feeds; turns have to lie together in order."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None
        for batch in batches:
            ids, found = [], []
            for one, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if state is None or one != conv:
                    if state is not None:
                        ids.append(conv)
                        found.append(state.hexdigest())
                    conv, state = one, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.column(0).type), pa.array(found, pa.string())], [id_col, "repaired_sha256"])
            kind = batch.column(0).type
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([state.hexdigest()], pa.string())], [id_col, "repaired_sha256"])

    return repaired.mapInArrow(digest, f"{id_col} {repaired.schema[id_col].dataType.simpleString()}, repaired_sha256 string")


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with rows dropped, emptied, robbed of their stops, repeated or given the role user, by their checksum."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.encode(F.concat_ws(":", blank("conv_id"), blank("turn")), "UTF-8")) % 20
    times = F.when(F.col("_llm_draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return turns.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), draw.alias("_llm_draw")).where(
        "_llm_draw <> 0").select(
        "conv_id", "turn", F.when(F.col("_llm_draw") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_llm_draw") == 1, "").when(F.col("_llm_draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(
            F.col("text")).alias("text"), F.explode(times).alias("_llm_copy")).drop("_llm_copy")


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def op11_structure_repair(spark, folder):
    given = table(spark, folder, "conversations")
    broken = damaged(given)
    judged = judge_conversations(broken)
    hashed = digests(repair_conversations(broken, judged))
    # One row per conversation and table, met by grouping: a null id is a group like any other.
    parts = judged.unionByName(hashed, allowMissingColumns=True).unionByName(given.select("conv_id").distinct(), allowMissingColumns=True)
    empty = hashlib.sha256(b"").hexdigest()
    return parts.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in COUNTS],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"), F.coalesce(F.max("repaired_sha256"), F.lit(empty)).alias("repaired_sha256"))


# DuckDB: checksums by a folded table, then a forward recursion over rows that keeps, per state, the cheapest and ASCII-least edits.
OP11_SQL = r"""
WITH RECURSIVE crcs AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END)
    ORDER BY i) AS t FROM range(256) r(i)),
g AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
    lambda x: ascii(x)::BIGINT)), lambda c, b: xor(c // 256, t[(xor(c, b) & 255) + 1]))) % 20 AS d FROM conversations, crcs),
m AS (SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
  CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(CASE WHEN d = 3 THEN [0, 1] ELSE [0] END) AS copy FROM g WHERE d <> 0),
o AS (SELECT conv_id, turn, role, text, left(role, 1) AS c, row_number() OVER w AS i,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
  NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, lag(left(role, 1)) OVER w || left(role, 1) AS pair,
  NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS open FROM m WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
f AS (SELECT *, again AND NOT blank AS duplicate, open AND NOT blank AND NOT again AS truncated FROM o),
s AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
  count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
  count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY 1),
ins(st, k, nst) AS (VALUES (0, 0, 0), (0, 1, 2), (0, 2, 3), (1, 0, 1), (1, 1, 2), (1, 2, 3), (2, 0, 2), (2, 1, 3), (3, 0, 3), (3, 1, 2)),
step(st, kind, nst) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
mv AS (SELECT ins.st, k, ins.nst AS mid, 'D' AS e, '' AS c, ins.nst AS nst, 2 AS cost FROM ins
  UNION ALL SELECT ins.st, k, ins.nst, 'K', kind, step.nst, 0 FROM ins JOIN step ON ins.nst = step.st
  UNION ALL SELECT ins.st, k, ins.nst, 'R', '', step.nst, 1 FROM ins JOIN step ON ins.nst = step.st AND step.kind <> 's'),
r(conv_id, i, st, cost, audit) AS (
  SELECT conv_id, 0::BIGINT, 0, 0::BIGINT, '' FROM s
  UNION ALL
  SELECT b.conv_id, b.ni, b.st, (b.best).cost, (b.best).audit FROM (
    SELECT r.conv_id, f.i AS ni, mv.nst AS st, min({'cost': r.cost + mv.cost + 5 * mv.k + CASE WHEN f.truncated AND mv.e <> 'D' THEN 5 ELSE 0 END,
        'audit': r.audit || repeat('I', mv.k) || mv.e}) AS best
    FROM r JOIN f ON r.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = r.i + 1 JOIN mv ON r.st = mv.st
    WHERE (mv.e <> 'K' OR mv.c = f.c) AND (mv.e = 'D' OR NOT (f.blank OR f.duplicate)) GROUP BY 1, 2, 3) b),
z AS (SELECT r.conv_id, min({'cost': r.cost + CASE st WHEN 1 THEN 10 WHEN 2 THEN 5 ELSE 0 END,
    'audit': r.audit || CASE st WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END}) AS best
  FROM r JOIN s ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.n GROUP BY 1),
l AS (SELECT conv_id, (best).cost AS cost, (best).audit AS audit, unnest(range(1, length((best).audit) + 1)) AS p FROM z),
q AS (SELECT conv_id, p, audit[p] AS e, length(replace(left(audit, p), 'I', '')) AS i FROM l),
t AS (SELECT q.conv_id, p, e, role, text, CASE WHEN e = 'K' THEN left(role, 1) END AS c,
  count(*) FILTER (e <> 'D' AND NOT (e = 'K' AND left(role, 1) = 's')) OVER (PARTITION BY q.conv_id ORDER BY p) AS place
  FROM q LEFT JOIN f ON q.conv_id IS NOT DISTINCT FROM f.conv_id AND q.i = f.i AND q.e <> 'I' WHERE e <> 'D'),
h AS (SELECT conv_id, sha256(string_agg(CASE WHEN e = 'K' THEN role WHEN place % 2 = 1 THEN 'user' ELSE 'assistant' END || ':'
  || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY p)) AS hash FROM t GROUP BY 1)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce((best).cost, 0) AS cost, coalesce((best).audit, '') AS audit, coalesce(hash, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN s ON a.conv_id IS NOT DISTINCT FROM s.conv_id
  LEFT JOIN z ON a.conv_id IS NOT DISTINCT FROM z.conv_id LEFT JOIN h ON a.conv_id IS NOT DISTINCT FROM h.conv_id
"""
