"""Time conversions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def whole_seconds(ts: Column) -> Column:
    """Epoch seconds, fraction dropped."""
    return F.unix_seconds(ts.cast("timestamp"))


def rfc3339(epoch: Column) -> Column:
    """Epoch seconds as ``2024-01-31T12:00:00+00:00`` (needs a UTC session)."""
    return F.date_format(F.timestamp_seconds(epoch), "yyyy-MM-dd'T'HH:mm:ssxxx")


def day_seconds(hms: Column) -> Column:
    """``25:10:00`` as seconds after midnight, hours beyond 24 allowed; null when malformed."""
    parts = F.split(F.trim(hms), ":")
    number = lambda i: F.get(parts, F.lit(i)).try_cast("int")
    return F.when(F.size(parts) == 3, number(0) * 3600 + number(1) * 60 + number(2))
