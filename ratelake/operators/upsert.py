"""Upserts, and versioned tables to write them to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def merge_seen(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], first_seen: str, last_seen: str
) -> DataFrame:
    """Insert unknown keys and widen the seen span of known ones, by a full outer join.

    Both sides hold each key once, and keys are not NULL. Columns other than the span stay as
    they were first stored.
    """
    old, new = existing.alias("old"), incoming.alias("new")
    condition = [F.col(f"old.{key}") == F.col(f"new.{key}") for key in keys]
    columns = []
    for column in incoming.columns:
        a, b = F.col(f"old.{column}"), F.col(f"new.{column}")
        if column == first_seen:
            merged = F.least(a, b)
        elif column == last_seen:
            merged = F.greatest(a, b)
        else:
            # The key tells whether the row was known: a NULL stored before stays NULL.
            merged = F.when(F.col(f"old.{keys[0]}").isNotNull(), a).otherwise(b)
        columns.append(merged.alias(column))
    return old.join(new, condition, "full_outer").select(*columns)


def write_version(df: DataFrame, table: str, version: int) -> None:
    """Write one whole version of a table beside the older ones."""
    df.write.mode("overwrite").parquet(f"{table}/version={version}")


def read_version(spark: SparkSession, table: str, version: int, schema: str) -> DataFrame:
    """A version of a table; version 0 is the empty table before the first run."""
    if version == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{table}/version={version}")
