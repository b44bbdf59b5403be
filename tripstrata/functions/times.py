"""Time text and durations. Zone-less text is read in the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def parse_time(text: Column) -> Column:
    """ISO-8601 text to timestamp; text that is no time gives null, with ANSI on or off."""
    return F.try_to_timestamp(text)


def iso_text(time: Column) -> Column:
    """Timestamp to ISO-8601 text, with microseconds only where there are any."""
    has_fraction = F.date_format(time, "SSSSSS") != F.lit("000000")
    return F.when(has_fraction, F.date_format(time, ISO_MICROS)).otherwise(
        F.date_format(time, ISO_SECONDS)
    )


def duration_minutes(start: Column, end: Column) -> Column:
    """Minutes from ``start`` to ``end``, counted in whole seconds."""
    return (F.unix_seconds(end) - F.unix_seconds(start)) / F.lit(60.0)
