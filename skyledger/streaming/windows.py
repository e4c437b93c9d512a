"""Streaming forms: event-time counts with late data, and deduplicated hits by month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, ts: str, key: str, length: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by window and key; rows later than the watermark are left out, state older than it is dropped."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, length), key).agg(F.count("*").alias("n"))


def first_seen(events: DataFrame, ts: str, keys: list[str], late: str = "1 day") -> DataFrame:
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def month_slices(df: DataFrame, date: str, start: str, end: str) -> DataFrame:
    """Rows dated within [start, end] with their calendar month's window, clipped to the range."""
    d = F.col(date).cast("date")
    return df.where(d.between(F.lit(start).cast("date"), F.lit(end).cast("date"))).withColumns({
        "month": F.date_format(d, "yyyy-MM"), "window_start": F.greatest(F.trunc(d, "month"), F.lit(start).cast("date")), "window_end": F.least(F.last_day(d), F.lit(end).cast("date")),
    })
