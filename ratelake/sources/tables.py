"""Tables: parquet, and a catalogue database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """A scan in fewer splits than there are cores, spread over the cores; any other scan as it is.

    One shuffle of the scanned columns is cheaper than heavy work per row in a few tasks.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)


def catalogue(spark: SparkSession, url: str, name: str, key: str | None = None, bounds: tuple[int, int] | None = None,
              partitions: int = 1, **options: str) -> DataFrame:
    """A catalogue table over JDBC; a numeric key with bounds splits the read."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", name).options(**options)
    if key and bounds:
        reader = reader.options(
            partitionColumn=key, lowerBound=str(bounds[0]), upperBound=str(bounds[1]), numPartitions=str(partitions)
        )
    return reader.load()
