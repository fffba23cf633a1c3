"""Merging recordings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetspark.operators import merge
from fleetspark.operators.keys import asc, union_all
from registry.base import Query, Source



def by_event():
    return asc("event_id")


def merged(t: Source) -> DataFrame:
    return merge.merge_snapshots(t("feed_a"), t("feed_b"), order=by_event())


MERGED_SQL = """
SELECT * FROM (SELECT DISTINCT ON (last_updated, vehicle_id) * FROM {feed_a} ORDER BY last_updated, vehicle_id, event_id) a
UNION ALL
SELECT * FROM (SELECT DISTINCT ON (last_updated, vehicle_id) * FROM {feed_b} ORDER BY last_updated, vehicle_id, event_id) b
WHERE last_updated NOT IN (SELECT last_updated FROM {feed_a})"""


def later(df: DataFrame, minutes: int) -> DataFrame:
    """The same table recorded by somebody else: every second instant is later."""
    odd = F.hour("snapshot_ts") % 2 == 1
    step = F.expr(f"make_dt_interval(0, 0, {minutes})")
    return df.withColumn("snapshot_ts", F.when(odd, F.col("snapshot_ts") + step).otherwise(F.col("snapshot_ts")))


def merged_network(t: Source, name: str) -> DataFrame:
    first = {n: t(n) for n in ("bikes", "places", "cities", "countries")}
    second = {n: later(df, 30) for n, df in first.items()}
    return merge.merge_station_network(first, second)[name]


def network_sql(name: str) -> str:
    shifted = "CASE WHEN hour(snapshot_ts) % 2 = 1 THEN snapshot_ts + interval 30 minute ELSE snapshot_ts END"
    return f"""
WITH b AS (SELECT * REPLACE ({shifted} AS snapshot_ts) FROM {{{name}}})
SELECT DISTINCT * FROM {{{name}}}
UNION ALL SELECT DISTINCT * FROM b WHERE snapshot_ts NOT IN (SELECT snapshot_ts FROM {{{name}}})"""


def recording(t: Source, source: str, step: int, legacy: bool) -> DataFrame:
    """One recording per operator and day; the later ones start a few minutes after the first."""
    minute = F.date_trunc("minute", F.col("ts") + F.expr(f"make_dt_interval(0, 0, cast(event_id % {step} AS int))"))
    stamp = (lambda c: F.unix_timestamp(c)) if legacy else (lambda c: c)
    return t("events").select(
        F.col("event_type").alias("operator"), F.to_date("ts").alias("date"),
        F.concat(F.lit("v"), (F.col("user_id") % 20).cast("string")).alias("bike_id" if legacy else "vehicle_id"),
        stamp(minute).alias("last_updated"), stamp(minute).alias("last_reported"),
        F.lit("2.3" if legacy else "3.0").alias("version"), F.lit(source).alias("src"), "event_id")


def operator_feeds(t: Source) -> DataFrame:
    return merge.merge_operator_feeds(
        recording(t, "native_a", 2, False), recording(t, "legacy_a", 1, True),
        recording(t, "native_b", 4, False), recording(t, "legacy_b", 3, True), order=by_event())


def recording_sql(source: str, step: int) -> str:
    return f"""SELECT DISTINCT ON (operator, date, last_updated, vehicle_id) * FROM (
  SELECT event_type AS operator, cast(ts AS date) AS date, concat('v', user_id % 20) AS vehicle_id,
         date_trunc('minute', ts + to_minutes(event_id % {step})) AS last_updated, date_trunc('minute', ts + to_minutes(event_id % {step})) AS last_reported,
         '3.0' AS version, '{source}' AS src, event_id FROM {{events}}) r ORDER BY operator, date, last_updated, vehicle_id, event_id"""


FEEDS_SQL = f"""
WITH legacy_a AS ({recording_sql('legacy_a', 1)}), native_a AS ({recording_sql('native_a', 2)}),
legacy_b AS ({recording_sql('legacy_b', 3)}), native_b AS ({recording_sql('native_b', 4)}),
one AS (SELECT * FROM legacy_a UNION ALL SELECT * FROM native_a n WHERE NOT EXISTS (
  SELECT 1 FROM legacy_a l WHERE l.operator = n.operator AND l.date = n.date AND l.last_updated = n.last_updated)),
two AS (SELECT * FROM legacy_b UNION ALL SELECT * FROM native_b n WHERE NOT EXISTS (
  SELECT 1 FROM legacy_b l WHERE l.operator = n.operator AND l.date = n.date AND l.last_updated = n.last_updated))
SELECT * FROM one UNION ALL SELECT * FROM two n WHERE NOT EXISTS (
  SELECT 1 FROM one l WHERE l.operator = n.operator AND l.date = n.date AND l.last_updated = n.last_updated)"""


def feed_documents(t: Source, source: str, modulus: int) -> DataFrame:
    return t("events").select(
        F.col("event_type").alias("operator"), F.concat(F.col("event_id") * modulus, F.lit(".tar.gz")).alias("file"), F.lit(source).alias("src"))


QUERIES = [
    Query("m1_merge_snapshots", merged, MERGED_SQL),
    *(Query(f"m2_merge_station_network_{n}", lambda t, n=n: merged_network(t, n), network_sql(n)) for n in ("bikes", "places", "cities", "countries")),
    Query("m3_merge_operator_feeds", operator_feeds, FEEDS_SQL),
    Query(
        "m3_merge_documents", lambda t: merge.merge_documents(feed_documents(t, "A", 2), feed_documents(t, "B", 3), ["operator", "file"]),
        """WITH a AS (SELECT event_type AS operator, concat(event_id * 2, '.tar.gz') AS file, 'A' AS src FROM {events}),
                b AS (SELECT event_type AS operator, concat(event_id * 3, '.tar.gz') AS file, 'B' AS src FROM {events})
           SELECT * FROM a UNION ALL SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.operator = b.operator AND a.file = b.file)""",
    ),
    Query(
        "m4_union_all", lambda t: union_all(t("feed_a"), t("feed_b"), t("feed_a")),
        "SELECT * FROM {feed_a} UNION ALL SELECT * FROM {feed_b} UNION ALL SELECT * FROM {feed_a}",
    ),
    Query(
        "m6_upsert_weather",
        lambda t: merge.upsert_weather(
            t("events").select((F.col("user_id") % 20).alias("location_id"), F.date_trunc("hour", "ts").alias("timestamp"), F.col("value").alias("temperature"), F.lit("old").alias("src")),
            t("events").select((F.col("user_id") % 30).alias("location_id"), F.date_trunc("hour", "ts").alias("timestamp"), F.col("value").alias("temperature"), F.lit("new").alias("src"))),
        """WITH a AS (SELECT user_id % 20 AS location_id, date_trunc('hour', ts) AS timestamp, value AS temperature, 'old' AS src FROM {events}
                UNION ALL SELECT user_id % 30, date_trunc('hour', ts), value, 'new' FROM {events})
           SELECT DISTINCT ON (location_id, timestamp) * FROM a ORDER BY location_id, timestamp, src DESC, temperature""",
    ),
    Query(
        "m7_schema_guard",
        lambda t: merge.merge_counts(t("feed_a"), t("feed_b"), merged(t), "last_updated", "vehicle_id"),
        """WITH m AS (""" + MERGED_SQL + """), a AS (SELECT DISTINCT last_updated, vehicle_id FROM {feed_a}),
                b AS (SELECT DISTINCT last_updated, vehicle_id FROM {feed_b} WHERE last_updated NOT IN (SELECT last_updated FROM {feed_a}))
           SELECT (SELECT count(*) FROM m) AS merged, (SELECT count(*) FROM a) AS kept_a, (SELECT count(*) FROM b) AS added_b, true AS consistent""",
    ),
]
