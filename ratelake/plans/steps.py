"""Status events, written by the steps of a job as they happen."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake import values as V
from ratelake.functions.keys import surrogate_id

EVENT = "event_id STRING, job_id STRING, status STRING, status_time TIMESTAMP, reason STRING"


@dataclass(frozen=True)
class Steps:
    """The status events below `folder`: each call appends those of its jobs, with the time of the call.

    Jobs are rows with a `job_id` and, where one failed, its `reason`. A step that runs again writes later
    events of the same states, as a new try is. The id of an event follows from job, state and time.
    """

    folder: str
    clock: Callable[[], datetime] = field(default=lambda: datetime.now(UTC).replace(tzinfo=None))

    def record(self, jobs: DataFrame, status: str) -> None:
        if status not in V.JOB_STATUSES:
            raise ValueError(f"unknown status {status!r}")
        at = F.lit(self.clock()).cast("timestamp")
        reason = F.min("reason") if "reason" in jobs.columns else F.lit(None).cast("string")
        events = jobs.groupBy("job_id").agg(reason.alias("reason")).select(
            surrogate_id("event", F.col("job_id"), F.lit(status), at).alias("event_id"),
            "job_id",
            F.lit(status).alias("status"),
            at.alias("status_time"),
            "reason",
        )
        events.write.mode("append").parquet(self.folder)

    def events(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(EVENT).parquet(self.folder)
