"""Scan jobs: counters, states, steps, throughput and family.

A status event is (event_id, job_id, status, status_time).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelake import values as V
from ratelake.functions.keys import surrogate_id
from ratelake.functions.text import filled
from ratelake.operators.spread import follow_over, rank_over


def counters(files: DataFrame) -> DataFrame:
    """Bytes and files per job and type, per job, and overall.

    The first grouping shrinks the rows before the rollup multiplies them.
    """
    return (
        files.groupBy("job_id", "file_type")
        .agg(F.sum("file_size").alias("n_bytes"), F.count(F.lit(1)).alias("n_files"))
        .rollup("job_id", "file_type")
        .agg(
            F.sum("n_bytes").alias("n_bytes"),
            F.sum("n_files").alias("n_files"),
            F.grouping_id().cast("int").alias("level"),
        )
    )


def latest_status(events: DataFrame) -> DataFrame:
    """Current status and attempt of each job.

    A PENDING event opens an attempt. Within the last attempt the last FAILED event wins, else
    the last event. Both are maxima, so one aggregation with partial sums does it.
    """
    place = F.struct("status_time", "event_id")
    event = F.struct("status_time", "event_id", "status")
    is_status = lambda status: F.col("status") == status
    merged = events.groupBy("job_id").agg(
        F.max(event).alias("last"),
        F.max(F.when(is_status("FAILED"), event)).alias("failed"),
        F.max(F.when(is_status("PENDING"), place)).alias("opened"),
        F.count_if(is_status("PENDING")).alias("attempt"),
    )
    failed_place = F.struct("failed.status_time", "failed.event_id")
    failed_now = F.col("failed").isNotNull() & (F.col("opened").isNull() | (failed_place > F.col("opened")))
    current = F.when(failed_now, F.col("failed")).otherwise(F.col("last"))
    return merged.select(
        "job_id",
        current["status"].alias("status"),
        current["status_time"].alias("status_time"),
        "attempt",
        F.col("last.status_time").alias("last_event_time"),
    )


def steps(events: DataFrame, bucket: Column) -> DataFrame:
    """Each status event with the one that follows it in its job. `bucket` follows status_time."""
    return follow_over(events, ["job_id"], ["status_time", "event_id"], ["status", "status_time"], bucket)


STEP_OF_STATUS = {"DOWNLOADING": "DOWNLOAD", "DECOMPRESSING": "DECOMPRESS", "PARSING": "PARSE", "COMPLETED": "POST_PROCESS"}


def step_rows(events: DataFrame, bucket: Column) -> DataFrame:
    """The steps of each job in order: type, state, start and end."""
    kind = F.lit(None).cast("string")
    for status, step in STEP_OF_STATUS.items():
        kind = F.when(F.col("status") == status, step).otherwise(kind)
    working = steps(events, bucket).withColumn("type", kind).where(F.col("type").isNotNull())
    ended = F.col("next_status_time")
    state = (
        F.when((F.col("status") == "COMPLETED") | (F.col("next_status") != "FAILED"), "COMPLETED")
        .when(F.col("next_status") == "FAILED", "FAILED")
        .otherwise("IN_PROGRESS")
    )
    order = [F.col("status_time"), F.col("event_id")]
    return rank_over(working, ["job_id"], order, bucket, "sequence_order").select(
        surrogate_id(V.ID_STEP, F.col("job_id"), F.col("event_id")).alias("id"),
        "job_id",
        "type",
        state.alias("status"),
        F.col("status_time").alias("started_at"),
        ended.alias("completed_at"),
        "sequence_order",
    )


def step_durations(events: DataFrame, bucket: Column) -> DataFrame:
    """Per job and status: how often it was entered and left, and the microseconds spent in it."""
    spent = F.unix_micros("next_status_time") - F.unix_micros("status_time")
    return (
        steps(events, bucket)
        .groupBy("job_id", "status")
        .agg(
            F.count(F.lit(1)).alias("n_entered"),
            F.count("next_status_time").alias("n_left"),
            F.sum(spent).alias("spent_micros"),
        )
    )


def illegal_moves(events: DataFrame, bucket: Column) -> DataFrame:
    """Moves between states that the state machine does not have."""
    allowed = F.lit(False)
    for status, following in V.NEXT_STATUSES.items():
        allowed = F.when(F.col("status") == status, F.col("next_status").isin(*following)).otherwise(allowed)
    return steps(events, bucket).where(F.col("next_status").isNotNull() & ~allowed)


def throughput(runs: DataFrame) -> DataFrame:
    """Objects per second of each job from (job_id, at, n_objects) rows."""
    seconds = F.unix_timestamp("completed_at") - F.unix_timestamp("started_at")
    return (
        runs.groupBy("job_id")
        .agg(
            F.sum("n_objects").alias("n_objects"),
            F.min("at").alias("started_at"),
            F.max("at").alias("completed_at"),
        )
        .withColumn("seconds", seconds)
        .withColumn(
            "objects_per_second",
            F.when(F.col("seconds") > 0, F.col("n_objects").cast("double") / F.col("seconds").cast("double")),
        )
    )


def family(jobs: DataFrame) -> DataFrame:
    """Child jobs beside their parent."""
    child, parent = jobs.alias("c"), jobs.alias("p")
    return child.join(parent, F.col("c.parent_job_id") == F.col("p.id")).select(
        F.col("c.id").alias("id"),
        F.col("c.status").alias("status"),
        F.col("p.id").alias("parent_job_id"),
        F.col("p.status").alias("parent_status"),
    )


def with_source_and_company(jobs: DataFrame, sources: DataFrame, companies: DataFrame) -> DataFrame:
    """Jobs with the names of their source and company."""
    return (
        jobs.join(sources.select(F.col("id").alias("source_id"), F.col("name").alias("source_name"), "company_id"), "source_id")
        .join(companies.select(F.col("id").alias("company_id"), F.col("name").alias("company_name")), "company_id")
    )


def company_sources(companies: DataFrame, sources: DataFrame) -> DataFrame:
    """Companies with their sources, one row each; a company without a source has one row with NULLs.

    Rows rather than one array per company, and an inner join rather than an outer one from the
    companies: a company may have any number of sources, and only then may they be split.
    """
    named = companies.select(F.col("id").alias("company_id"), F.col("name").alias("company_name"))
    owned = sources.select("company_id", F.col("id").alias("source_id"), F.col("name").alias("source_name"))
    without = named.join(owned.select("company_id").distinct(), "company_id", "left_anti")
    return owned.join(named, "company_id").unionByName(without, allowMissingColumns=True)


def _first_part(parsed: DataFrame) -> Column:
    """Rows that count as an object; where there is no `part`, all objects are whole."""
    return F.col("part") == 0 if "part" in parsed.columns else F.lit(True)


def parse_metrics(parsed: DataFrame) -> DataFrame:
    """Per file: objects parsed, saved and with errors; rates among the saved ones.

    `parsed` is (file_id, part, bad, n_rates, n_providers); `bad` marks objects that did not parse. An object in
    parts counts with its first.
    """
    first = _first_part(parsed)
    return parsed.groupBy("file_id").agg(
        F.count_if(first).alias("objects_parsed"),
        F.count_if(first & ~F.col("bad")).alias("objects_saved"),
        F.count_if(first & F.col("bad")).alias("objects_with_errors"),
        F.sum(F.when(F.col("bad"), 0).otherwise(F.col("n_rates")).cast("bigint")).alias("rates_saved"),
        F.sum(F.when(F.col("bad"), 0).otherwise(F.col("n_providers")).cast("bigint")).alias("providers_named"),
    )


def reference_metrics(parsed: DataFrame) -> DataFrame:
    """Per file: provider references found and saved. `parsed` is (file_id, part, bad)."""
    first = _first_part(parsed)
    return parsed.groupBy("file_id").agg(
        F.count_if(first).alias("references_parsed"), F.count_if(first & ~F.col("bad")).alias("references_saved")
    )


def job_metrics(files: DataFrame) -> DataFrame:
    """The ten counters of a job from its files' metrics.

    `files` is (job_id, file_type, objects_parsed, objects_with_errors, rates_saved, references_parsed,
    references_saved, plans_named, plans_saved); a file without references has NULL counts of them.
    """

    def total(column: str, file_type: str | None = None) -> Column:
        value = F.col(column)
        if file_type:
            value = F.when(F.col("file_type") == file_type, value).otherwise(0)
        return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")

    counters = {
        "in_network_objects_parsed": total("objects_parsed", "IN_NETWORK"),
        "allowed_amount_objects_parsed": total("objects_parsed", "ALLOWED_AMOUNT"),
        "in_network_rates_saved": total("rates_saved", "IN_NETWORK"),
        "allowed_amount_rates_saved": total("rates_saved", "ALLOWED_AMOUNT"),
        "in_network_rates_with_errors": total("objects_with_errors", "IN_NETWORK"),
        "allowed_amount_rates_with_errors": total("objects_with_errors", "ALLOWED_AMOUNT"),
        "providers_parsed": total("references_parsed"),
        "plans_parsed": total("plans_named"),
        "providers_saved": total("references_saved"),
        "plans_saved": total("plans_saved"),
    }
    return files.groupBy("job_id").agg(*[value.alias(name) for name, value in counters.items()])


def trigger_jobs(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Jobs started from scan sources, and the requests that start none, with the reason.

    Requests repeat; each request id starts one job. The message carries all options of its source, by name;
    options that are no JSON name no listing.
    """
    parsed = F.try_parse_json("options")
    option = F.try_variant_get(parsed, f"$.{V.LISTING_URL_OPTION}", "string")
    reason = F.when(
        ~F.coalesce(F.col("source_type").isin(*V.HANDLED_SOURCE_TYPES), F.lit(False)), "source type not handled"
    ).when(~filled(F.coalesce(option, F.lit(""))), "listing url missing")
    once = (
        requests.groupBy("request_id")
        .agg(F.min(F.struct("requested_at", "source_id", "source_type", "company_id", "options")).alias("r"))
        .select("request_id", "r.*")
        .withColumn("listing_url", option)
        .withColumn("reason", reason)
    )
    source = F.struct(
        F.col("source_id").alias("id"),
        F.col("source_type").alias("sourceType"),
        F.col("company_id").alias("insuranceCompanyId"),
        parsed.alias("options"),
    )
    job_id = surrogate_id(V.ID_JOB, F.col("request_id"))
    started = once.where(F.col("reason").isNull()).select(
        job_id.alias("id"),
        "source_id",
        F.lit("PENDING").alias("status"),
        F.lit("TABLE_OF_CONTENTS").alias("file_type"),
        F.col("requested_at").alias("status_time"),
        F.to_json(
            F.struct(job_id.alias("id"), F.lit(V.TOPIC_TRIGGER).alias("type"), source.alias("payload"))
        ).alias("message"),
    )
    return started, once.where(F.col("reason").isNotNull()).select("request_id", "source_id", "source_type", "reason")
