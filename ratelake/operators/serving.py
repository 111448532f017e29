"""Serving layouts: the provider fact laid out for each access path, and lookups on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ratelake import session

STEP = "_step"

# Partition columns of each path, then the columns that order rows inside a partition.
PATHS = {
    "plan_code": (
        ("insurance_plan_id", "billing_code_id"),
        ("provider_group_id", "procedure_hash"),
    ),
    "region": (
        ("region_code", "billing_code_id"),
        ("insurance_plan_id", "provider_group_id", "procedure_hash"),
    ),
    "zip": (
        ("zip_code", "billing_code_id"),
        ("insurance_plan_id", "provider_group_id", "procedure_hash"),
    ),
    "provider": (
        ("provider_group_id",),
        ("insurance_plan_id", "billing_code_id", "procedure_hash"),
    ),
}


def view(fact: DataFrame, path: str) -> DataFrame:
    """The rows a path can reach: no key column is NULL."""
    lead, rest = PATHS[path]
    return fact.dropna(subset=[*lead, *rest])


def key_cuts(rows: DataFrame, key: list[str], steps: int) -> list[Column]:
    """Keys that cut rows into `steps` ranges of about as many each, or fewer; drawn from about 4,000 keys."""
    if steps < 2:
        return []
    schema = rows.select(*key).schema
    found = sorted(map(tuple, rows.select(*key).sample(min(1.0, 4000 / max(1, rows.count())), 7).collect()))
    cuts = sorted({found[len(found) * k // steps] for k in range(1, steps)}) if found else []
    return [F.struct(*[F.lit(v).cast(schema[c].dataType).alias(c) for c, v in zip(key, cut, strict=True)]) for cut in cuts]


def write_layout(fact: DataFrame, path: str, folder: str, files: int | None = None, steps: int = 1) -> None:
    """Write one path's layout, sorted by its key, and the index of its files.

    The ranges are cut over the whole key, so a partition key with very many rows is spread
    over several files, and row groups keep narrow key spans that a lookup can skip by. Files have Bloom
    filters on the columns behind the key. The index has a row a file: the spans of the key and the rows. With
    `steps`, the key is cut into so many ranges, written one after the other: an exchange holds one of them.
    """
    lead, rest = PATHS[path]
    key, spark = [*lead, *rest], fact.sparkSession
    rows = view(fact, path)
    blooms = {f"parquet.bloom.filter.enabled#{column}": "true" for column in rest}
    whole, cuts = F.struct(*key), key_cuts(rows, key, steps)
    for step, (low, high) in enumerate(zip([None, *cuts], [*cuts, None], strict=True)):
        some = rows if low is None else rows.where(whole >= low)
        some = some if high is None else some.where(whole < high)
        ranged = some.repartitionByRange(*([files] if files else []), *key).sortWithinPartitions(*key)
        with session.shuffles_freed(spark):
            ranged.write.mode("overwrite").options(**blooms).parquet(f"{folder}/rows/{STEP}={step:04d}")
    spans = (
        read_layout(spark, folder, rows.select(*key).schema)
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(F.min(F.struct(*key)).alias("low"), F.max(F.struct(*key)).alias("high"), F.count(F.lit(1)).alias("n_rows"))
    )
    spans.write.mode("overwrite").parquet(f"{folder}/index")


def read_layout(spark: SparkSession, folder: str, schema: str | StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{folder}/rows").drop(STEP)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """(file, low, high, n_rows): the spans of the layout's files."""
    return spark.read.parquet(f"{folder}/index")


def files_of_key(index: DataFrame, path: str, *values) -> list[str]:
    """The files whose span holds a key, or its leading columns: as many as the key has, mostly one."""
    key = [column for columns in PATHS[path] for column in columns][: len(values)]
    low, high, wanted = (
        F.struct(*[F.col(f"low.{c}") for c in key]),
        F.struct(*[F.col(f"high.{c}") for c in key]),
        F.struct(*[F.lit(v).cast(index.schema["low"].dataType[c].dataType).alias(c) for c, v in zip(key, values, strict=True)]),
    )
    return sorted(row["file"] for row in index.where((low <= wanted) & (wanted <= high)).select("file").collect())


def look_up(spark: SparkSession, folder: str, schema: str, path: str, *values) -> DataFrame:
    """Rows of one key of a layout, or of its leading columns. Only the files the index names are opened.

    `first_match` of it stops at the first row: files come in the order of their names, which is the key's.
    """
    named = files_of_key(read_index(spark, folder), path, *values)
    if not named:
        return spark.createDataFrame([], schema)
    return lookup(spark.read.schema(schema).parquet(*named), path, *values)


def first_match(rows: DataFrame) -> DataFrame:
    """One row or none. Spark looks into one file and goes on only where that has no match."""
    return rows.limit(1)


def lookup(layout: DataFrame, path: str, *values) -> DataFrame:
    """Rows of one key; fewer values than key columns look up the leading ones."""
    lead, rest = PATHS[path]
    for column, value in zip([*lead, *rest], values):
        layout = layout.where(F.col(column) == F.lit(value))
    return layout


def with_rates(rows: DataFrame, dimension: DataFrame) -> DataFrame:
    """Add the price attributes to fact rows."""
    attributes = [c for c in dimension.columns if c not in ("billing_code", "first_seen_date", "last_seen_date")]
    return rows.join(dimension.select(*attributes), "procedure_hash")


def key_summary(fact: DataFrame, path: str) -> DataFrame:
    """Per partition key of a path: its rows, its provider groups' and plans' span, and when it was seen."""
    lead, _ = PATHS[path]
    return (
        view(fact, path)
        .groupBy(*lead)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min("first_seen_date").alias("first_seen_date"),
            F.max("last_seen_date").alias("last_seen_date"),
        )
    )
