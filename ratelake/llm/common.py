"""What several of the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake import session

#: White space between words: the six ASCII characters, and nothing else.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the folder all executors share: computed once, safe from lost executors."""
    return session.staged(df, session.run_dir(df.sparkSession, name))


def utf8(text: Column) -> Column:
    """The bytes of a text for work in Python; NULL is the empty text."""
    return F.coalesce(text, F.lit("")).cast("binary")


def word_count(text: Column) -> Column:
    """Number of words of a text; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def slices(batch: pa.RecordBatch, column: int, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, in parts of about `size` bytes in a binary column, one row at least."""
    ends = np.cumsum([v.as_buffer().size if v.is_valid else 0 for v in batch.column(column)])
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def most_frequent(counts: DataFrame, size: int) -> DataFrame:
    """The rows with the greatest `n` (1 or more), at most `size`: all down to the level that still fits.

    Levels are sixteenths of a power of two, so there are at most 1,024 of them, and no task sorts the
    rows. Reads the table twice: stage it first.
    """
    level = F.floor(F.log2(F.col("n")) * 16)
    total, lowest = 0, None
    for row in counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        total += row["count"]
        if total > size:
            break
        lowest = row["level"]
    return counts.filter(level >= lowest) if lowest is not None else counts.limit(0)
