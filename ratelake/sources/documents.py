"""Small documents, one row per file, read with their schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake import schemas as S


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The columns of each document, and whether it is `malformed`."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    document = F.from_json("value", f"{schema}, _corrupt STRING", options)
    return (
        spark.read.option("wholetext", True)
        .text(path)
        .select(F.col("_metadata.file_path").alias("file_id"), document.alias("document"))
        .select("file_id", "document.*", (F.col("document").isNull() | F.col("document._corrupt").isNotNull()).alias("malformed"))
        .drop("_corrupt")
    )


def malformed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The documents that cannot be read; the other functions give no rows of them."""
    return _read(spark, path, schema).where("malformed").select("file_id")


def listings(spark: SparkSession, path: str) -> DataFrame:
    """Listings with their `malformed` mark, which the gate turns into a reason."""
    return _read(spark, path, S.LISTING)


def structures(spark: SparkSession, path: str) -> DataFrame:
    """Structures of small indexes; for large ones shred section `reporting_structure`."""
    return (
        _read(spark, path, S.TOC)
        .where(~F.col("malformed"))
        .select("file_id", F.posexplode("reporting_structure").alias("rs_pos", "rs"))
        .select("file_id", F.col("rs_pos").cast("bigint").alias("rs_pos"), "rs.*")
    )


def shredded_structures(parsed: DataFrame) -> DataFrame:
    """Structures from shredded index files."""
    return parsed.withColumnRenamed("item_no", "rs_pos")
