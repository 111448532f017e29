"""Allowed-value checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_enum_errors(df: DataFrame, allowed: Mapping[str, Sequence[str]]) -> DataFrame:
    """Add `enum_errors`: the names of the columns whose value is not allowed, NULL counted as such."""
    wrong = [
        F.when(F.coalesce(F.col(name).isin(*values), F.lit(False)), F.lit(None)).otherwise(F.lit(name))
        for name, values in allowed.items()
    ]
    return df.withColumn("enum_errors", F.array_compact(F.array(*wrong)))


def split_by_enums(df: DataFrame, allowed: Mapping[str, Sequence[str]]) -> tuple[DataFrame, DataFrame]:
    checked = with_enum_errors(df, allowed)
    valid = checked.where(F.size("enum_errors") == 0).drop("enum_errors")
    return valid, checked.where(F.size("enum_errors") > 0)
