"""Order-dependent work on keys of any size.

A window over a key sorts all rows of that key in one task. These operators cut each key
into buckets that follow the order, work inside the buckets, and carry only one row per
bucket across them. Key columns must not be NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "_bucket"


def rank_over(df: DataFrame, keys: Sequence[str], order: Sequence[Column], bucket: Column, name: str) -> DataFrame:
    """Number the rows of each key from 1. `bucket` must never fall as the order rises.

    `df` is read twice, once for the counts: stage it first where it costs much to compute.
    """
    df = df.withColumn(BUCKET, bucket)
    before = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy(*keys, BUCKET)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*keys, BUCKET, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy(*keys, BUCKET).orderBy(*order)
    return (
        df.withColumn("_place", F.row_number().over(inside))
        .join(offsets, [*keys, BUCKET])
        .withColumn(name, F.col("_place") + F.col("_offset"))
        .drop("_place", "_offset", BUCKET)
    )


def follow_over(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str], bucket: Column
) -> DataFrame:
    """Add `next_<value>`: the values of the row that comes next within the key, NULL at its end."""
    df = df.withColumn(BUCKET, bucket).withColumn("_values", F.struct(*values))
    firsts = df.groupBy(*keys, BUCKET).agg(F.min_by("_values", F.struct(*order)).alias("_first"))
    across = Window.partitionBy(*keys).orderBy(BUCKET)
    nexts = firsts.select(*keys, BUCKET, F.lead("_first").over(across).alias("_after"))
    inside = Window.partitionBy(*keys, BUCKET).orderBy(*order)
    joined = df.withColumn("_next", F.lead("_values").over(inside)).join(nexts, [*keys, BUCKET])
    follow = F.coalesce("_next", "_after")
    return joined.select(
        *[c for c in df.columns if c not in (BUCKET, "_values")],
        *[follow[value].alias(f"next_{value}") for value in values],
    )


def gather_in_parts(
    df: DataFrame, keys: Sequence[str], value: str, bucket: Column, size: int, name: str
) -> DataFrame:
    """Arrays of at most `size` distinct values per key: one row per key and part, values in order, and `n_parts`.

    `bucket` must never fall as the value rises. A key with more than `size` values gets parts 0, 1, 2 …, so no
    row and no task has to hold all of a large key: values are gathered by bucket, repeats gone before the
    exchange, and only the buckets' counts meet by key to tell which part a bucket's values go to.
    """
    boxes = df.groupBy(*keys, bucket.alias(BUCKET)).agg(F.array_sort(F.collect_set(value)).alias("_values"))
    of_key = Window.partitionBy(*keys)
    before = of_key.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = boxes.select(*keys, BUCKET, F.size("_values").cast("bigint").alias("_n")).select(
        *keys,
        BUCKET,
        "_n",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        F.ceil(F.sum("_n").over(of_key) / size).cast("int").alias("n_parts"),
    )
    last = F.floor((F.col("_offset") + F.col("_n") - 1) / size)
    start = F.greatest(F.col("part") * size - F.col("_offset"), F.lit(0))
    stop = F.least((F.col("part") + 1) * size - F.col("_offset"), F.col("_n"))
    piece = F.slice("_values", (start + 1).cast("int"), (stop - start).cast("int"))
    return (
        boxes.join(offsets, [*keys, BUCKET])
        .withColumn("part", F.explode(F.sequence(F.floor(F.col("_offset") / size), last)))
        .select(*keys, "part", "n_parts", F.struct(BUCKET, piece.alias("piece")).alias("_box"))
        .groupBy(*keys, "part", "n_parts")
        .agg(F.array_sort(F.collect_list("_box")).alias("_boxes"))
        .select(*keys, F.col("part").cast("int"), "n_parts", F.flatten(F.col("_boxes.piece")).alias(name))
    )
