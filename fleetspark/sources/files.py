"""Files chosen by their names before anything in them is read."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def dated_files(spark: SparkSession, path: str, start: str, end: str | None = None, pattern: str = r"(\d{8})(?=\D*$)") -> list[str]:
    """Entries of a folder, or of a glob, whose name carries a day (yyyymmdd) from ``start`` to ``end``; no day, no entry.

    ``pattern`` is searched in the name, its group is the day. Only the listing is read, by the driver as for every read of
    Spark; give the result to a reader, which then never opens the others. Hidden entries are left out.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    system = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    found = list(system.globStatus(hadoop.Path(path)) or [])
    if len(found) == 1 and found[0].isDirectory():
        found = system.listStatus(found[0].getPath())
    kept = []
    for entry in found:
        name = entry.getPath().getName()
        day = re.search(pattern, name)
        if not name.startswith((".", "_")) and day and start <= day[1] and (end is None or day[1] <= end):
            kept.append(entry.getPath().toString())
    return sorted(kept)
