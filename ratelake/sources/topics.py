"""Message topics. The connector is a package of its own and must be on the cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def job_messages(
    spark: SparkSession, servers: str, topics: Sequence[str], per_trigger: int = 1_000_000, **options: str
) -> DataFrame:
    """(topic, value, at) of the job topics, from their first message on, in bounded batches."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", str(per_trigger))
        .options(**options)
        .load()
        .select("topic", F.col("value").cast("string").alias("value"), F.col("timestamp").alias("at"))
    )
