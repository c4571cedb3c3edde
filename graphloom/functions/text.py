"""Measures over raw file bytes and event times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def byte_size(content: Column) -> Column:
    return F.octet_length(content).cast("long")


def line_count(content: Column) -> Column:
    """Lines by ``\\n``, counting a last line that has no terminator; byte-exact for any input."""
    text = F.decode(content, "ISO-8859-1")
    breaks = F.length(text) - F.length(F.translate(text, "\n", ""))
    unterminated = (F.length(text) > 0) & ~text.endswith("\n")
    return (breaks + unterminated.cast("int")).cast("int")


def event_time(text: Column) -> Column:
    """Timestamp of an ISO-8601 string; NULL instead of an error when it is malformed."""
    return F.try_to_timestamp(text)


def shorten(text: Column, limit: int) -> Column:
    """At most ``limit`` characters, the last three being dots when the text was cut."""
    cut = F.concat(F.substring(text, 1, limit - 3), F.lit("..."))
    return F.when(F.length(text) > limit, cut).otherwise(text)
