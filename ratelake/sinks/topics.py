"""Message sinks. The connectors are packages of their own and must be on the cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.protobuf.functions import to_protobuf

from ratelake import values as V
from ratelake.operators.rates import wire_messages


def send_jobs(messages: DataFrame, servers: str, types: Sequence[str] = V.JOB_FILE_TYPES, **options: str) -> None:
    """Send (topic, value) of the jobs of `types`. Jobs of other types exist but nothing is sent for them."""
    (
        messages.where(F.col("file_type").isin(*types))
        .select("topic", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .options(**options)
        .save()
    )


def encode_rates(messages: DataFrame, descriptor: str, message: str = "RateMessage") -> DataFrame:
    """Rate messages as protobuf; `descriptor` is the compiled form of rate_message.proto."""
    wire = wire_messages(messages)
    return wire.select(to_protobuf(F.struct(*wire.columns), message, descFilePath=descriptor).alias("value"))


def send_rates(messages: DataFrame, servers: str, descriptor: str, topic: str = V.TOPIC_RATES, **options: str) -> None:
    (
        encode_rates(messages, descriptor)
        .withColumn("key", F.lit(b""))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**options)
        .save()
    )
