"""Defaults, topics, dates and small-int codes of raw text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def filled(column: Column) -> Column:
    """True where a text is present and not empty."""
    return column.isNotNull() & (column != "")


def or_empty(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def array_or_empty(column: Column, element: str) -> Column:
    return F.coalesce(column, F.array().cast(f"array<{element}>"))


def bare_topic(topic: Column, prefix: str) -> Column:
    if not prefix:
        return topic
    return F.when(F.startswith(topic, F.lit(prefix)), F.substring(topic, len(prefix) + 1, 2**31 - 1)).otherwise(topic)


def to_date(text: Column) -> Column:
    """Date of a text; NULL where it is none."""
    return text.try_cast("date")


def day_text(when: Column) -> Column:
    """Month/day/year without leading zeros, as the company list shows it."""
    return F.date_format(when, "M/d/yyyy")


def encode(word: Column, codes: dict[str, int]) -> Column:
    """Small-int code of a word; NULL for an unknown one."""
    low = F.lower(word)
    out = F.lit(None).cast("tinyint")
    for text, code in codes.items():
        out = F.when(low == text, F.lit(code).cast("tinyint")).otherwise(out)
    return out


def encode_services(codes: Column) -> Column:
    """Place-of-service texts as small ints, sorted; NULL, and first, for texts that are none."""
    return F.sort_array(codes.try_cast("array<tinyint>"))
