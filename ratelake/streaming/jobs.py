"""Streams of jobs and files.

What a stream must remember is keyed state in Spark's state store. Sinks that are no plain append write each
micro-batch to a folder of its own number, or merge it by key, so a batch that runs again after a failure
replaces its own output.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ratelake import values as V
from ratelake.functions.keys import surrogate_id
from ratelake.functions.text import bare_topic
from ratelake.operators import jobs as J
from ratelake.operators import rates as R
from ratelake.plans.rate_ingest import land_bronze
from ratelake.sinks.merged import RUN, MergedTable
from ratelake.sources import shred as X


def _bound(files_per_trigger: int, bytes_per_trigger: int | None) -> dict[str, str]:
    """What bounds a batch: bytes where they are given, else files. Spark takes one of the two."""
    if bytes_per_trigger is None:
        return {"maxFilesPerTrigger": str(files_per_trigger)}
    return {"maxBytesPerTrigger": str(bytes_per_trigger)}


def table_stream(
    spark: SparkSession, folder: str, name: str, files_per_trigger: int = 1000, bytes_per_trigger: int | None = None
) -> DataFrame:
    """A table's parquet files as a stream, a bounded number of files or of bytes per batch.

    The table is one file or a folder of part files. The path is a pattern that fits its name only, as a
    stream takes no plain path of a file.
    """
    return (
        spark.readStream.schema(spark.read.parquet(f"{folder}/{name}.parquet").schema)
        .options(**_bound(files_per_trigger, bytes_per_trigger))
        .parquet(f"{folder}/{name}.parque[t]")
    )


def landed_files(
    spark: SparkSession, folder: str, glob: str = "*", files_per_trigger: int = 1000, bytes_per_trigger: int | None = None
) -> DataFrame:
    """(file_id, file_size) of files as they land; no content is read."""
    return (
        spark.readStream.format("binaryFile")
        .schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")
        .option("pathGlobFilter", glob)
        .options(**_bound(files_per_trigger, bytes_per_trigger))
        .load(folder)
        .select(F.col("path").alias("file_id"), F.col("length").alias("file_size"))
    )


def _by_batch(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], once: bool) -> StreamingQuery:
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if once else writer).start()


def newest(keys: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """A merge by which the row of the latest run stands."""

    def merge(rows: DataFrame) -> DataFrame:
        kept = [c for c in rows.columns if c not in (*keys, RUN)]
        return rows.groupBy(*keys).agg(F.max_by(F.struct(*kept), RUN).alias("row")).select(*keys, "row.*")

    return merge


def running_table(path: str, schema: str, keys: Sequence[str], **options) -> MergedTable:
    """A table of totals by key, of which a stream writes those that changed."""
    return MergedTable(path, StructType.fromDDL(schema), tuple(keys), newest(keys), **{"buckets": 16, **options})


def start_running(totals: DataFrame, table: MergedTable, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Keep a table of what a streaming aggregation has by key.

    The totals are keyed state of the stream, so a batch reads nothing of earlier batches; it writes the keys
    it changed, as they are now. A batch that runs again writes the same totals again.
    """

    def write(batch: DataFrame, _: int) -> None:
        table.upsert(batch.select(*table.schema.names))

    writer = totals.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if once else writer).start()


COUNTERS = "job_id STRING, file_type STRING, n_bytes BIGINT, n_files BIGINT"


def start_counters(files: DataFrame, target: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Bytes and files by job and type over all batches, see `running_counters`."""
    totals = files.groupBy("job_id", "file_type").agg(F.sum("file_size").alias("n_bytes"), F.count(F.lit(1)).alias("n_files"))
    return start_running(totals, running_table(target, COUNTERS, ["job_id", "file_type"]), checkpoint, once)


def running_counters(spark: SparkSession, target: str) -> DataFrame:
    """Counters over all batches so far."""
    return running_table(target, COUNTERS, ["job_id", "file_type"]).read(spark)


STATES = "job_id STRING, status STRING, status_time TIMESTAMP, attempt BIGINT, last_event_time TIMESTAMP"


def start_states(events: DataFrame, target: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """The state machine of each job over a stream of its status events, see `running_states`.

    A job's state is a few maxima over its events, so events may come in any order and any batch, as late as
    they like: the state is that of all events so far.
    """
    return start_running(J.latest_status(events), running_table(target, STATES, ["job_id"]), checkpoint, once)


def running_states(spark: SparkSession, target: str) -> DataFrame:
    """Current status and attempt of each job so far."""
    return running_table(target, STATES, ["job_id"]).read(spark)


def start_first_requests(
    requests: DataFrame, keys: list[str], target: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Requests without repeats, however late they come.

    The keys seen are state of the stream, kept on disk and without a horizon: behind a watermark a late
    request that was never seen would be dropped, and nothing would say so. A batch meets the state of its own
    keys only.
    """
    return start_append(requests.dropDuplicates(keys), target, checkpoint, once)


def start_append(stream: DataFrame, target: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    writer = stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def routed(messages: DataFrame, prefix: str = "") -> DataFrame:
    """Job messages with their bare topic, parsed fields and, where they cannot be handled, the reason."""
    parsed = F.from_json("value", "id STRING, payload STRING, _corrupt STRING", {"columnNameOfCorruptRecord": "_corrupt"})
    topic = bare_topic(F.col("topic"), prefix)
    reason = (
        F.when(~topic.isin(*V.JOB_TOPICS), "unknown topic")
        .when(F.col("m").isNull() | F.col("m._corrupt").isNotNull(), "not a message")
        .when(F.col("m.id").isNull(), "no job id")
    )
    return messages.withColumn("m", parsed).select(
        topic.alias("topic"),
        *[column for column in messages.columns if column != "topic"],
        F.col("m.id").alias("job_id"),
        F.col("m.payload").alias("payload"),
        reason.alias("reason"),
    )


def start_routing(messages: DataFrame, target: str, checkpoint: str, prefix: str = "", once: bool = False) -> StreamingQuery:
    """Handled messages by topic, and rejects by reason, in one partitioned table."""
    rows = routed(messages, prefix).withColumn("accepted", F.col("reason").isNull())
    writer = (
        rows.writeStream.format("parquet")
        .partitionBy("accepted")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def start_rate_files(
    files: DataFrame, target: str, checkpoint: str, block_bytes: int = X.BLOCK_BYTES, once: bool = False
) -> StreamingQuery:
    """Parse each landed in-network file into rate messages, provider references and its header.

    Items and references that do not parse and files that are not whole go beside them.
    """

    def write(batch: DataFrame, number: int) -> None:
        bronze = land_bronze(batch, f"{target}/bronze/batch={number}", block_bytes)
        tables = {
            "messages": R.rate_messages(bronze.items),
            "references": bronze.references,
            "headers": bronze.headers,
            "rejects": bronze.rejects,
            "failed": bronze.failed,
        }
        for name, rows in tables.items():
            rows.write.mode("overwrite").parquet(f"{target}/{name}/batch={number}")

    return _by_batch(files, checkpoint, write, once)


def opened_attempts(rows: DataFrame) -> DataFrame:
    """A PENDING event per handled job, to append to the status events: it opens an attempt.

    `rows` are routed messages with their time `at`. A long plan list comes in parts, of which the first opens.
    """
    part = F.coalesce(F.get_json_object("payload", "$.part").cast("int"), F.lit(0))
    return rows.where(F.col("reason").isNull() & (part == 0)).select(
        surrogate_id("event", F.col("topic"), F.col("job_id"), F.col("at")).alias("event_id"),
        "job_id",
        F.lit("PENDING").alias("status"),
        F.col("at").alias("status_time"),
    )
