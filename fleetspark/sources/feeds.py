"""Feed documents packed in daily archives."""

from __future__ import annotations

import io
import itertools
import tarfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

ARCHIVE_ROWS = "archive string, member string, json string"
# Documents are handed on together, up to so many characters or rows at a time.
HANDED_ON, HANDED_ON_ROWS = 4_000_000, 10_000


def _documents(content: bytes) -> Iterator[tuple[str, str]]:
    """Name and text of every ``.json`` entry, up to where the archive cannot be read on."""
    try:
        with tarfile.open(fileobj=io.BytesIO(content), mode="r:gz") as archive:
            for member in archive:
                if member.isfile() and member.name.endswith(".json"):
                    yield member.name, archive.extractfile(member).read().decode("utf-8", errors="replace")
    except (tarfile.TarError, OSError, EOFError, zlib.error):
        return


def unpack_archives(files: DataFrame, first_only: bool = False) -> DataFrame:
    """(path, content) of .tar.gz files to one row per document; unreadable documents and error answers are left out.

    Archives are small daily files; they are unpacked side by side, each one whole. ``first_only`` takes
    the first document of an archive. Documents leave in bounded groups: a batch for each costs more than its unpacking.
    """

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, size = [], 0
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                for document in itertools.islice(_documents(content), 1 if first_only else None):
                    found.append((path, *document))
                    size += len(document[1])
                    if size >= HANDED_ON or len(found) >= HANDED_ON_ROWS:
                        yield pd.DataFrame(found, columns=["archive", "member", "json"])
                        found, size = [], 0
        if found:
            yield pd.DataFrame(found, columns=["archive", "member", "json"])

    texts = files.select("path", "content").mapInPandas(unpack, ARCHIVE_ROWS)
    return texts.where(F.get_json_object("json", "$").isNotNull() & ~F.contains("json", F.lit('"httpCode"')))


def read_feed_archives(spark: SparkSession, path: str) -> DataFrame:
    """All ``*.tar.gz`` in ``path`` as (archive, member, json)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tar.gz").load(path)
    return unpack_archives(files)


STATION_FIELDS = {"2": "string", "3": "array<struct<text: string, language: string>>"}


def station_information(docs: DataFrame, version: str = "3", prefix: str | None = None, text: str = "json") -> DataFrame:
    """Distinct (station_id, station_name) of the documents; ``prefix`` is taken off the ids."""
    schema = f"data struct<stations: array<struct<station_id: string, name: {STATION_FIELDS[version]}>>>"
    rows = docs.select(F.explode(F.from_json(text, schema).getField("data").getField("stations")).alias("s"))
    station, name = F.col("s.station_id"), F.col("s.name")
    if prefix:
        station = F.replace(station, F.lit(prefix), F.lit(""))
    if version == "3":
        name = F.get(name, F.lit(0)).getField("text")
    return rows.select(station.alias("station_id"), name.alias("station_name")).dropna().distinct()
