r"""Personal data in texts: patterns propose spans, checksums confirm them, words nearby adjust their scores.

Everything is a Spark expression over one row: no shuffle, no Python. A pattern gives its matches and, by splitting, the
pieces of text between them; positions (code points, end exclusive) are running sums of their lengths. The work is linear
in the text: patterns are possessive and start only where a run of their characters starts, which finds the same leftmost
matches, and context is cut from the pieces.

Kinds ``email ip card phone`` are the base: a match that passes its check (parts at most 255; 13 to 19 digits and Luhn;
9 to 15 digits) stays whatever its score. ``iban`` (mod 97), ``ssn`` (issued ranges) and ``national`` (a phone number
without country) are added where their score reaches a limit: a passed checksum suffices, a mere shape needs a word that
speaks of it within 32 code points, on this side of the next match of the same kind. Added spans touch no letter or digit.

Defined results: a null text is empty and has no spans; texts of any length are searched whole; equal texts and repeated
rows get equal spans each; spans of different kinds may overlap (ties in start stay in the order of the kinds); an empty
table gives an empty table; a column named like an added one is replaced, all others stay.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from fleetspark.llm.common import full, once, running_sums, table

NEAR = 32
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Kind:
    """``shape`` scores a match that passes ``check``, ``proof`` is added if that check is a checksum, ``word`` if one of
    ``words`` stands nearby."""

    name: str
    pattern: str
    shape: float
    proof: float
    word: float
    words: str


# Names, patterns, scores and words are fixed values.
PHONE_WORDS = "phone|telephone|tel|call|mobile|cell|fax"
BASE = [
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.7, 0.0, 0.3,
         "email|mail|contact|write"),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", 0.5, 0.0, 0.3, "ip|address|host|server"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", 0.2, 0.5, 0.3, "card|credit|debit|visa|payment"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.5, 0.0, 0.3, PHONE_WORDS),
]
ADDED = [
    Kind("iban", r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?", 0.2, 0.5, 0.3, "iban|account|bank|transfer"),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", 0.3, 0.0, 0.3, "ssn|social|security"),
    Kind("national", r"(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}", 0.3, 0.0, 0.3, PHONE_WORDS),
]
LIMIT = 0.5

SPAN = "array<struct<kind:string,start:bigint,end:bigint,value:string,score:double>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def mod97(value: Column) -> Column:
    """Remainder of an account number in international form by 97; letters count from 10, the first four signs go last."""
    bare = F.replace(value, F.lit(" "))
    signs = F.split(F.concat(F.substring(bare, 5, 34), F.substring(bare, 1, 4)), "")

    def step(rest, sign):
        code = F.ascii(sign)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(signs, F.lit(0), step)


def _passes(kind: str, value: Column, before: Column, after: Column) -> Column:
    """Whether a match passes the check of its kind."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = r"0*+(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9]|)"
        return value.rlike(rf"\A{part}(?:\.{part}){{3}}\z")
    if kind == "card":
        digits = _digits(value)
        return F.char_length(digits).between(13, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.char_length(_digits(value)).between(9, 15)
    alone = ~before.rlike(r"[A-Za-z0-9]\z") & ~after.rlike(r"\A[A-Za-z0-9]")
    if kind == "iban":
        return alone & (mod97(value) == 1)
    if kind == "ssn":
        return alone & ~value.rlike(r"\A(?:000|666|9[0-9][0-9])|-00-|0000\z")
    return alone & ~before.rlike(r"[0-9+][\x20().-]*\z") & ~after.rlike(r"\A[-.][0-9]")


def _spoken(words: str, near: Column) -> Column:
    return F.translate(near, UPPER, LOWER).rlike(rf"(?:\A|[^a-z])(?:{words})(?:\z|[^a-z])")


def proposals(text: Column, kind: Kind) -> Column:
    """Spans of one kind that pass its check, by start, with their scores."""

    def placed(found):
        pieces = F.split(text, kind.pattern, -1)
        steps = lambda p: F.transform(found, lambda m, i: (F.char_length(F.get(p, i)) + F.char_length(m)).cast("long"))
        return once(pieces, lambda p: once(running_sums(steps(p)), lambda ends: F.transform(found, lambda m, i: F.struct(
            (F.get(ends, i) - F.char_length(m)).alias("start"), F.get(ends, i).alias("end"), m.alias("value"),
            F.right(F.get(p, i), F.lit(NEAR)).alias("before"), F.left(F.get(p, i + 1), F.lit(NEAR)).alias("after")))))

    def scored(s):
        spoken = _spoken(kind.words, s["before"]) | _spoken(kind.words, s["after"])
        return F.struct(F.lit(kind.name).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"),
                        F.when(spoken, F.lit(kind.shape + kind.proof + kind.word)).otherwise(F.lit(kind.shape + kind.proof)).alias("score"))

    passing = lambda found: F.filter(placed(found), lambda s: _passes(kind.name, s["value"], s["before"], s["after"]))
    none = F.array().cast(SPAN)
    return once(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), lambda found: F.when(
        F.size(found) > 0, F.transform(passing(found), scored)).otherwise(none))


def find_personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``base`` and ``added``: arrays of kind, start, end, value and score, by kind as listed and start."""
    whole = full(text)
    base = F.concat(*[proposals(whole, k) for k in BASE])
    added = F.concat(*[F.filter(proposals(whole, k), lambda s: s["score"] >= LIMIT) for k in ADDED])
    return docs.withColumns({"base": base, "added": added})


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op13_personal_data(spark, folder):
    found = find_personal_data(table(spark, folder, "documents").select("doc_id", "text"))
    count = lambda column, kind: F.size(F.filter(column, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count("base", k.name) for k in BASE], F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.concat("base", "added")).alias("spans"), *[count("added", k.name) for k in ADDED],
        F.array_max(F.transform(F.concat("base", "added"), lambda s: s["score"])).alias("top_score"))


def _sql() -> str:
    """DuckDB: the plain patterns of the contract, positions by sums over lists, checks by numbers instead of patterns."""
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
             "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "card": r"[0-9](?:[\x20-]?[0-9])+"}
    kinds = ", ".join(
        f"({i}, '{k.name}', '{plain.get(k.name, k.pattern)}', {k.shape}, {k.proof}, {k.word}, '{k.words}')"
        for i, k in enumerate([*BASE, *ADDED]))
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn = ("list_sum(list_transform(range(1, length(d) + 1), lambda i: CASE WHEN (length(d) - i) % 2 = 0 THEN d[i]::INT "
            "ELSE (d[i]::INT * 2) // 10 + (d[i]::INT * 2) % 10 END)) % 10 = 0")
    rest = ("list_reduce(list_prepend(0::HUGEINT, list_transform(range(1, length(a) + 1), lambda i: CASE WHEN a[i] >= 'A' "
            "THEN ascii(a[i])::HUGEINT - 55 ELSE ascii(a[i])::HUGEINT - 48 END)), lambda x, y: CASE WHEN y >= 10 "
            "THEN (x * 100 + y) % 97 ELSE (x * 10 + y) % 97 END) = 1")
    alone = "NOT regexp_matches(b, '[A-Za-z0-9]$') AND NOT regexp_matches(f, '^[A-Za-z0-9]')"
    return rf"""
WITH kinds(o, kind, pat, shape, proof, word, words) AS (VALUES {kinds}),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
x AS (SELECT r, o, kind, shape, proof, word, words, regexp_extract_all(t, pat) AS ms, regexp_split_to_array(t, pat) AS ps FROM d, kinds),
u AS (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM x WHERE len(ms) > 0),
p AS (SELECT r, o, kind, shape, proof, word, words, ms[i] AS m, right(ps[i], 32) AS b, left(ps[i + 1], 32) AS f,
  (list_sum(list_transform(ps[1:i], lambda y: length(y))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda y: length(y))), 0))::BIGINT AS s FROM u),
c AS (SELECT *, {digits} AS d, substr(replace(m, ' ', ''), 5) || substr(replace(m, ' ', ''), 1, 4) AS a,
  lower(translate(b, 'ſK', '??')) || '|' || lower(translate(f, 'ſK', '??')) AS near FROM p),
k AS (SELECT r, o, kind, s, s + length(m) AS e, shape + proof + CASE WHEN
    regexp_matches(near, '(?:^|[^a-z])(?:' || words || ')(?:$|[^a-z])') THEN word ELSE 0 END AS score
  FROM c WHERE CASE kind WHEN 'email' THEN true
    WHEN 'ip' THEN list_max(list_transform(string_split(m, '.'), lambda y: try_cast(right('000' || ltrim(y, '0'), greatest(3, length(ltrim(y, '0')))) AS HUGEINT))) <= 255
      AND list_max(list_transform(string_split(m, '.'), lambda y: length(ltrim(y, '0')))) <= 3
    WHEN 'card' THEN CASE WHEN length(d) BETWEEN 13 AND 19 THEN {luhn} ELSE false END
    WHEN 'phone' THEN length(d) BETWEEN 9 AND 15
    WHEN 'iban' THEN {alone} AND {rest}
    WHEN 'ssn' THEN {alone} AND NOT (m[1:3] IN ('000', '666') OR m[1:1] = '9' OR m[5:6] = '00' OR m[8:11] = '0000')
    ELSE {alone} AND NOT regexp_matches(b, '[0-9+][ ().-]*$') AND NOT regexp_matches(f, '^[-.][0-9]') END),
g AS (SELECT r, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
    count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY o, s) FILTER (o < 4) AS base, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY o, s) AS spans,
    count(*) FILTER (kind = 'iban') AS n_iban, count(*) FILTER (kind = 'ssn') AS n_ssn, count(*) FILTER (kind = 'national') AS n_national,
    max(score) AS top FROM k WHERE o < 4 OR score >= {LIMIT} GROUP BY r)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_iban, 0) AS n_iban, coalesce(n_ssn, 0) AS n_ssn,
  coalesce(n_national, 0) AS n_national, top::DOUBLE AS top_score
FROM d LEFT JOIN g USING (r)
"""


OP13_SQL = _sql()
