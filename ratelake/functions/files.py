from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratelake.functions.urls import suffix_extension


def file_type(name: Column) -> Column:
    low = F.lower(name)
    return (
        F.when(F.contains(low, F.lit("in-network")), "IN_NETWORK")
        .when(F.contains(low, F.lit("allowed-amount")), "ALLOWED_AMOUNT")
        .otherwise("UNKNOWN")
    )


def file_extension(name: Column, rule: str = "last") -> Column:
    """Extension of a file name.

    rule "last" looks behind the last dot; rule "first" takes all behind the first
    dot and knows only JSON, so `a.b.json` is UNKNOWN there.
    """
    if rule == "last":
        dotted = F.contains(name, F.lit("."))
        return F.when(dotted, suffix_extension(F.substring_index(name, ".", -1))).otherwise("UNKNOWN")
    if rule == "first":
        return F.when(F.lower(name).rlike("^[^.]*[.]json$"), "JSON").otherwise("UNKNOWN")
    raise ValueError(f"unknown rule {rule!r}")
