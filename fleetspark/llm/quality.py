"""Quality rules: text statistics of one document, and lines that too many documents of a host share.

Everything is a Spark expression. Lines are hashed after normalising (lower case, blanks collapsed, ends trimmed);
a line counts a document once, and equal texts count as one document, so copies of a text do not condemn it. A line
above the limits is removed from all documents of the host but the one with the smallest id, which keeps the content
alive once. A document that loses too much is rejected.

Defined results: a null text has no words and fails the base rules; a null host is a host of its own; repeated rows get
the same result each; a null id never keeps a frequent line as its first document. An empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from fleetspark.llm.common import BLANKS, BREAK, full, same, words
from fleetspark.session import stored


@dataclass(frozen=True)
class Limits:
    """A line is frequent when more distinct texts of its host hold it than ``documents`` and than ``share`` of them.

    A document is rejected below ``min_words`` words, with more than ``repeat_percent`` percent of its words in repeated
    windows of ``window`` words, or when removing lines leaves under ``left_percent`` percent of its words.
    """

    documents: int = 10
    share: float = 0.05
    min_words: int = 10
    repeat_percent: int = 20
    window: int = 5
    left_percent: int = 50


def _once(array: Column, made) -> Column:
    """``made(array)`` with the array as a bound variable: lambdas inside do not compute it again for every element,
    however the optimizer merges or pushes expressions."""
    return F.get(F.transform(F.array(array), made), F.lit(0))


def _windows(hashes: Column, size: int) -> Column:
    """Hash of each run of ``size`` neighbours of an array of hashes."""
    n = F.size(hashes) - (size - 1)
    all_windows = lambda h: F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, size)]))
    return F.when(n > 0, F.slice(_once(hashes, all_windows), 1, n)).otherwise(F.array().cast("array<bigint>"))


def text_statistics(docs: DataFrame, text: str = "text", window: int = 5) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words.

    Repeated windows are found by sorting the window hashes, only in documents whose windows are not all different.
    """
    step = docs.withColumn("_llm_words", words(full(text)))
    lines = F.filter(F.split(full(text), "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    step = step.withColumns({
        "_llm_hashes": F.transform("_llm_words", lambda x: F.xxhash64(x)),
        "_llm_lines": lines,
        "word_chars": F.char_length(F.array_join("_llm_words", "")).cast("long"),
        "n_symbols": F.char_length(F.regexp_replace(full(text), "[^#*$%&|<>]+", "")).cast("long"),
    }).drop("_llm_words")
    step = step.withColumns({
        "n_words": F.size("_llm_hashes").cast("long"),
        "n_dup_lines": (F.size("_llm_lines") - F.size(F.array_distinct("_llm_lines"))).cast("long"),
        "_llm_windows": _windows(F.col("_llm_hashes"), window),
    }).drop("_llm_lines", "_llm_hashes")
    numbered = F.sort_array(F.transform("_llm_windows", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    unequal = F.size(F.array_distinct("_llm_windows")) < F.size("_llm_windows")
    step = step.withColumn("_llm_sorted", F.when(unequal, numbered)).drop("_llm_windows")
    twice = _once(F.col("_llm_sorted"), lambda s: F.transform(s, lambda e, j: F.when(
        (e["h"] == F.get(s, j - 1)["h"]) | (e["h"] == F.get(s, j + 1)["h"]), e["i"])))
    step = step.withColumn("_llm_starts", F.sort_array(F.filter(twice, lambda x: x.isNotNull()))).drop("_llm_sorted")
    lengths = _once(F.col("_llm_starts"), lambda p: F.transform(
        p, lambda x, j: F.least(F.lit(window), F.coalesce(F.get(p, j + 1) - x, F.lit(window)))))
    covered = F.aggregate(lengths, F.lit(0), lambda a, x: a + x)
    return step.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_llm_starts")


def _keyed(docs: DataFrame, id_col: str, host: str, text: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("_llm_id"), F.col(host).alias("_llm_host"),
                       F.xxhash64(full(text)).alias("_llm_text"), full(text).alias("_llm_full"))


def _lines(docs: DataFrame, id_col: str, host: str, text: str) -> DataFrame:
    """One row per line with a word: document, number of the line, hash of its normalised form, words."""
    split = F.split(F.lower(F.btrim("_llm_line", F.lit(BLANKS))), BREAK)
    return (
        _keyed(docs, id_col, host, text)
        .select("_llm_id", "_llm_host", "_llm_text", F.posexplode(F.split("_llm_full", "\n")).alias("_llm_at", "_llm_line"))
        .where(F.btrim("_llm_line", F.lit(BLANKS)) != "")
        .select("_llm_id", "_llm_host", "_llm_text", "_llm_at", split.alias("_llm_split"))
        .select("_llm_id", "_llm_host", "_llm_text", "_llm_at",
                F.xxhash64("_llm_split").alias("_llm_hash"), F.size("_llm_split").alias("_llm_n"))
    )


def frequent_lines(docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", host: str = "source",
                   text: str = "text") -> DataFrame:
    """Lines above the limits per host: hash, distinct texts that hold it, smallest id.

    Counting is pre-aggregated before each shuffle, so a line or host with most of the rows is no hot key.
    """
    counted = (
        _lines(docs, id_col, host, text).groupBy("_llm_host", "_llm_hash", "_llm_text").agg(F.min("_llm_id").alias("_llm_first"))
        .groupBy("_llm_host", "_llm_hash").agg(F.count("*").alias("_llm_docs"), F.min("_llm_first").alias("_llm_first"))
        .where(F.col("_llm_docs") > limits.documents)
    )
    hosts = (
        _keyed(docs, id_col, host, text).select("_llm_host", "_llm_text").distinct()
        .groupBy(F.col("_llm_host").alias("_llm_of")).agg(F.count("*").alias("_llm_all"))
    )
    return counted.join(hosts, same(counted, hosts, [("_llm_host", "_llm_of")])).where(
        F.col("_llm_docs") > limits.share * F.col("_llm_all")).select("_llm_host", "_llm_hash", "_llm_docs", "_llm_first")


def apply_quality_rules(docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", host: str = "source",
                        text: str = "text") -> DataFrame:
    """Adds the statistics, base_failed, n_cut_lines, n_cut_words, clean_text and kept; all rows stay.

    ``clean_text`` is the text without its frequent lines. A document is kept if it passes the base rules and enough of
    it is left. Dropping unused columns keeps whole texts out of the shuffle.
    """
    # A few lines per host; stored, as its size decides how the lines are looked up.
    frequent = stored(frequent_lines(docs, limits, id_col, host, text), "frequent-lines").alias("f")
    lines = _lines(docs, id_col, host, text).alias("l")
    hits = lines.join(frequent, F.expr("l._llm_host <=> f._llm_host AND l._llm_hash = f._llm_hash")).where(
        ~F.col("l._llm_id").eqNullSafe(F.col("f._llm_first"))
    ).select("l._llm_id", "l._llm_host", "l._llm_text", "_llm_at", "_llm_n")
    cut = (
        hits.dropDuplicates(["_llm_id", "_llm_host", "_llm_text", "_llm_at"])
        .groupBy(F.col("_llm_id").alias("_llm_i"), F.col("_llm_host").alias("_llm_h"), F.col("_llm_text").alias("_llm_t"))
        .agg(F.count("*").alias("_llm_cut_lines"), F.sum("_llm_n").alias("_llm_cut_words"),
             F.collect_set("_llm_at").alias("_llm_cut_at"))
    )
    base = text_statistics(docs, text, limits.window).withColumns({
        "base_failed": (F.col("n_words") < limits.min_words)
        | (100 * F.col("n_repeat_words") > limits.repeat_percent * F.col("n_words")),
        "_llm_hash": F.xxhash64(full(text)),
    })
    joined = base.join(cut, same(base, cut, [(id_col, "_llm_i"), (host, "_llm_h"), ("_llm_hash", "_llm_t")]), "left")
    lost = F.coalesce("_llm_cut_words", F.lit(0))

    def uncut(lines):
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "_llm_cut_at")
        return F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")

    clean = F.when(F.col("_llm_cut_at").isNull(), F.col(text)).otherwise(_once(F.split(text, "\n"), uncut))
    depleted = ((lost > 0) & (F.col("n_words") - lost < limits.min_words)) | (
        100 * (F.col("n_words") - lost) < limits.left_percent * F.col("n_words"))
    return joined.withColumns({
        "n_cut_lines": F.coalesce("_llm_cut_lines", F.lit(0)).cast("long"),
        "n_cut_words": lost.cast("long"),
        "clean_text": clean,
        # One expression over both sides of the join: a filter on it is not pushed below, to compute the statistics twice.
        "kept": F.when(F.col("base_failed"), F.lit(False)).otherwise(~depleted),
    }).drop("_llm_i", "_llm_h", "_llm_t", "_llm_hash", "_llm_cut_lines", "_llm_cut_words", "_llm_cut_at")


COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
           "n_cut_lines", "n_cut_words"]


def op1_quality_rules(spark, folder):
    from fleetspark.llm.common import table

    return apply_quality_rules(table(spark, folder, "documents")).select(*COLUMNS)


# DuckDB: the same rules by lists and window functions.
OP1_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t,
             list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
           FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, w FROM d WHERE len(w) >= 5),
marked AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i:i+4], ' ')) AS n FROM win),
starts AS (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM marked WHERE n > 1),
rep AS (SELECT doc_id, sum(least(5, coalesce(nxt - i, 5))) AS n FROM starts GROUP BY 1),
ln AS (SELECT doc_id, source, t, list_filter(regexp_split_to_array(lower(x), '[\x20\x09-\x0D]+'), lambda y: y <> '') AS v
       FROM (SELECT doc_id, source, t, unnest(l) AS x FROM d)),
keyed AS (SELECT doc_id, source, t, array_to_string(v, ' ') AS k, len(v) AS n FROM ln),
hosts AS (SELECT source, count(DISTINCT t) AS docs FROM d GROUP BY 1),
freq AS (SELECT k.source, k.k, min(doc_id) AS first FROM keyed k JOIN hosts h ON k.source IS NOT DISTINCT FROM h.source
         GROUP BY k.source, k.k, h.docs HAVING count(DISTINCT t) > 10 AND count(DISTINCT t) > 0.05 * h.docs),
cut AS (SELECT k.doc_id, count(*) AS lines, sum(n) AS words FROM keyed k JOIN freq f
        ON k.source IS NOT DISTINCT FROM f.source AND k.k = f.k AND k.doc_id <> f.first GROUP BY 1),
s AS (SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
        coalesce(cut.lines, 0) AS n_cut_lines, coalesce(cut.words, 0) AS n_cut_words
      FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN cut USING (doc_id)),
b AS (SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed FROM s)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND NOT (n_cut_words > 0 AND n_words - n_cut_words < 10)
    AND NOT (100 * (n_words - n_cut_words) < 50 * n_words) AS kept,
  n_cut_lines::BIGINT AS n_cut_lines, n_cut_words::BIGINT AS n_cut_words
FROM b
"""
