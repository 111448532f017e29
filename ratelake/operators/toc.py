"""Table-of-contents indexes: structures to good plans, files and the plans of each file.

A structure row is (file_id, rs_pos, reporting_plans, in_network_files, allowed_amount_file):
one element of an index with its place in it. Order always comes from the places.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelake import values as V
from ratelake.functions.keys import surrogate_id
from ratelake.functions.text import filled, or_empty
from ratelake.functions.urls import url_extension, without_query
from ratelake.operators.spread import gather_in_parts, rank_over
from ratelake.sources.shred import place_in

PLAN_FIELDS = ("plan_name", "plan_id_type", "plan_id", "plan_sponsor_name", "plan_market_type")
PLAN_PLACE = ("file_id", "rs_pos", "plan_pos")


def gate_listings(listings: DataFrame) -> DataFrame:
    """Tell which listings name exactly one index file, and why the others do not.

    A column `malformed`, where there is one, marks documents that could not be read.
    """
    malformed = F.col("malformed") if "malformed" in listings.columns else F.lit(False)
    mrfs = F.coalesce(F.size("mrfs"), F.lit(0))
    files = F.col("mrfs")[0]["files"]
    n_files = F.coalesce(F.when(mrfs > 0, F.size(files)), F.lit(0))
    reason = (
        F.when(malformed, "not a listing")
        .when(mrfs <= 0, "no mrf")
        .when(mrfs > 1, "more than one mrf")
        .when(n_files != 1, "not exactly one file")
    )
    return listings.withColumn("reason", reason).withColumn(
        "index_url", F.when(F.col("reason").isNull(), files[0]["url"])
    )


def failed_listings(gated: DataFrame, job_id: Column) -> DataFrame:
    """(job_id, reason) of the jobs whose listing names no single index file, for their FAILED events."""
    return gated.where(F.col("reason").isNotNull()).select(job_id.alias("job_id"), "reason")


def flatten_plans(structures: DataFrame) -> DataFrame:
    first = place_in(structures, "reporting_plans", F.lit(0)).alias("first")
    return structures.select("file_id", "rs_pos", first, F.posexplode("reporting_plans").alias("place", "plan")).select(
        "file_id", "rs_pos", (F.col("first") + F.col("place")).alias("plan_pos"), *[F.col(f"plan.{field}") for field in PLAN_FIELDS]
    )


def first_plans(plans: DataFrame) -> DataFrame:
    """Of the plans with an id, the first per name and index."""
    return (
        plans.where(filled(F.col("plan_id")))
        .groupBy("file_id", "plan_name")
        .agg(F.min_by(F.struct(*PLAN_PLACE[1:], *PLAN_FIELDS[1:]), F.struct(*PLAN_PLACE[1:])).alias("first"))
        .select("file_id", "plan_name", "first.*")
    )


def rank_plans(plans: DataFrame, bucket_width: int = 4096) -> DataFrame:
    """Number the plans with an id within their name, in document order. NULL is a name of its own."""
    named = plans.where(filled(F.col("plan_id"))).withColumns(
        {"_name": or_empty(F.col("plan_name")), "_unnamed": F.col("plan_name").isNull()}
    )
    ranked = rank_over(
        named,
        ["file_id", "_name", "_unnamed"],
        [F.col("rs_pos"), F.col("plan_pos")],
        F.floor(F.col("rs_pos") / bucket_width),
        "name_rank",
    )
    return ranked.drop("_name", "_unnamed")


def backfill_plans(plans: DataFrame, good: DataFrame) -> DataFrame:
    """Give plans without an id all fields of the first plan of that name; drop those with none.

    Plans with an id pass by without a shuffle. Names compare null-safe.
    """
    own = plans.where(filled(F.col("plan_id")))
    lacking = plans.where(~filled(F.coalesce("plan_id", F.lit("")))).select(*PLAN_PLACE, "plan_name").alias("p")
    donors = good.select("file_id", *PLAN_FIELDS).alias("g")
    same = (F.col("p.file_id") == F.col("g.file_id")) & F.col("p.plan_name").eqNullSafe(F.col("g.plan_name"))
    found = lacking.join(donors, same).select(
        *[F.col(f"p.{place}") for place in PLAN_PLACE], *[F.col(f"g.{field}") for field in PLAN_FIELDS]
    )
    return own.select(*PLAN_PLACE, *PLAN_FIELDS).unionByName(found)


def flatten_files(
    structures: DataFrame, placeholder: str = V.EMPTY_ALLOWED_AMOUNTS, scope: str = "structure"
) -> DataFrame:
    """One row per listed file: the allowed-amount file first, then the in-network files.

    An allowed-amount file that is the known empty placeholder drops its whole structure
    (scope "structure") or only itself (scope "file").
    """
    if scope not in ("structure", "file"):
        raise ValueError(f"unknown scope {scope!r}")
    allowed = F.col("allowed_amount_file.location")
    empty = F.coalesce(F.contains(allowed, F.lit(placeholder)), F.lit(False))
    if scope == "structure":
        structures = structures.where(~empty)
    none = F.array().cast("array<struct<location:string>>")
    # The parts of a structure that came in parts all name its allowed-amount file: the first one lists it.
    first_part = F.col("part") == 0 if "part" in structures.columns else F.lit(True)
    has_allowed = allowed.isNotNull() & ~empty & first_part
    single = F.when(has_allowed, F.array("allowed_amount_file")).otherwise(none)
    first = F.when(F.col("has_allowed") & (F.col("place") == 0), "allowed_amount").otherwise("in_network")
    # A later part has the allowed-amount file before it too.
    earlier = place_in(structures, "in_network_files", F.lit(0)) + F.when(first_part, 0).otherwise((allowed.isNotNull() & ~empty).cast("int"))
    return (
        structures.select(
            "file_id",
            "rs_pos",
            has_allowed.alias("has_allowed"),
            earlier.alias("earlier_files"),
            F.posexplode(F.concat(single, F.coalesce("in_network_files", none))).alias("place", "file"),
        )
        .select("file_id", "rs_pos", (F.col("earlier_files") + F.col("place")).alias("file_pos"), F.col("file.location").alias("url"), first.alias("file_type"))
        .where(F.col("url").isNotNull())
        .withColumn("location", without_query(F.col("url")))
    )


def files_by_location(files: DataFrame) -> DataFrame:
    """One row per location; URL and type come from its first place in the index."""
    return (
        files.groupBy("file_id", "location")
        .agg(F.min(F.struct("rs_pos", "file_pos", "url", "file_type")).alias("first"))
        .select("file_id", "location", "first.*")
        .withColumn("file_extension", url_extension(F.col("url")))
    )


def plans_of_files(files: DataFrame, plans: DataFrame) -> DataFrame:
    """(file_id, location, insurance_plan_id): each file has the plans of the structures that list it, once for each."""
    return (
        files.select("file_id", "rs_pos", "location")
        .join(plans.select("file_id", "rs_pos", "insurance_plan_id"), ["file_id", "rs_pos"])
        .select("file_id", "location", "insurance_plan_id")
    )


def with_plan_parts(files: DataFrame, pairs: DataFrame, size: int = 10_000) -> DataFrame:
    """Files with their sorted plan ids, in parts of at most `size`; a file without plans has one empty part."""
    # Plan ids are evenly spread hex behind a fixed prefix, so one digit makes 16 even, ordered buckets.
    bucket = F.substring("insurance_plan_id", 1, len(V.ID_PLAN) + 2)
    parts = gather_in_parts(pairs, ["file_id", "location"], "insurance_plan_id", bucket, size, "reporting_plans")
    return (
        files.join(parts, ["file_id", "location"], "left")
        .withColumn("part", F.coalesce("part", F.lit(0)))
        .withColumn("n_parts", F.coalesce("n_parts", F.lit(1)))
        .withColumn("reporting_plans", F.coalesce("reporting_plans", F.array().cast("array<string>")))
    )


def child_jobs(files: DataFrame, parent_job_id: Column, source_id: Column, *carried: str) -> DataFrame:
    """A pending job per file of an index."""
    kind = F.upper("file_type")
    return files.select(
        surrogate_id(V.ID_JOB, parent_job_id, F.col("location")).alias("id"),
        source_id.alias("source_id"),
        parent_job_id.alias("parent_job_id"),
        F.lit("PENDING").alias("status"),
        F.col("url").alias("file_url"),
        "file_extension",
        kind.alias("file_type"),
        "rs_pos",
        "file_pos",
        *carried,
    )


def with_lots(jobs: DataFrame, size: int = V.DISPATCH_LOT, bucket_width: int = 4096) -> DataFrame:
    """Number the lots in which the files of a job and type go out, in document order."""
    ranked = rank_over(
        jobs,
        ["parent_job_id", "file_type"],
        [F.col("rs_pos"), F.col("file_pos")],
        F.floor(F.col("rs_pos") / bucket_width),
        "lot_rank",
    )
    return ranked.withColumn("lot", F.floor((F.col("lot_rank") - 1) / size)).drop("lot_rank")


def dispatched(messages: DataFrame, lots: DataFrame, types: Sequence[str] = V.JOB_FILE_TYPES) -> DataFrame:
    """The messages of the file types that are sent, each with the lot of its job; others exist but go nowhere."""
    numbered = lots.select(F.col("id").alias("_id"), "lot")
    return messages.where(F.col("file_type").isin(*types)).join(numbered, F.col("id") == F.col("_id")).drop("_id")


def dispatch_messages(jobs: DataFrame, company_id: Column, topic_prefix: str = "") -> DataFrame:
    """Add topic and JSON message to jobs that carry their plans: one row per job and part of its plan list."""
    topic = F.when(F.col("file_type") == "IN_NETWORK", V.TOPIC_IN_NETWORK).otherwise(V.TOPIC_ALLOWED_AMOUNT)
    payload = F.struct(
        F.lit(V.HANDLED_SOURCE_TYPES[0]).alias("sourceType"),
        F.col("file_url").alias("url"),
        F.col("reporting_plans").alias("reportingPlans"),
        company_id.alias("insuranceCompanyId"),
        F.col("source_id").alias("insuranceImportSourceId"),
        # Left out of the JSON while NULL: a plan list that fits one message has no parts.
        F.when(F.col("n_parts") > 1, F.col("part")).alias("part"),
        F.when(F.col("n_parts") > 1, F.col("n_parts")).alias("nParts"),
    )
    return (
        jobs.withColumn("topic", topic)
        .withColumn("value", F.to_json(F.struct("id", "topic", payload.alias("payload"))))
        .withColumn("topic", F.concat(F.lit(topic_prefix), "topic"))
        .drop("reporting_plans", "n_parts")
    )
