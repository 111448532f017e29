"""Insurance plans: normal form, hash, and the table of known plans."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ratelake import schemas as S
from ratelake import values as V
from ratelake.functions.keys import plan_hash, surrogate_id
from ratelake.operators.toc import PLAN_PLACE
from ratelake.operators.upsert import merge_seen
from ratelake.sinks.merged import RUN, MergedTable

SEEN = ("plan_first_seen", "plan_last_seen")


def normalize_plans(plans: DataFrame, company: Column) -> DataFrame:
    """Plans with their hash and id, and with type and market as the catalogue spells them."""
    market = F.when(F.col("plan_market_type") == "individual", "INDIVIDUAL").otherwise("GROUP")
    digest = plan_hash(company, F.col("plan_id"), market, F.col("plan_name"), F.col("plan_id_type"))
    return (
        plans.withColumn("insurance_plan_hash", digest)
        .withColumn("insurance_plan_id", surrogate_id(V.ID_PLAN, F.col("insurance_plan_hash")))
        .withColumn("plan_id_type", F.when(F.col("plan_id_type") == "ein", "EIN").otherwise("HIOS"))
        .withColumn("plan_market_type", market)
        .withColumn("insurance_company_id", company)
    )


def plan_rows(normalized: DataFrame, run_ts: datetime) -> DataFrame:
    """One row of the plan table per hash, taken from the first place the plan has."""
    kept = ("plan_name", "plan_id_type", "plan_id", "plan_sponsor_name", "plan_market_type")
    first = F.min_by(F.struct(*kept, "insurance_company_id"), F.struct(*PLAN_PLACE)).alias("first")
    seen = F.lit(run_ts).cast("timestamp")
    return (
        normalized.groupBy("insurance_plan_hash", "insurance_plan_id")
        .agg(first)
        .select(
            F.col("insurance_plan_id").alias("id"),
            *[f"first.{name}" for name in kept],
            seen.alias(SEEN[0]),
            seen.alias(SEEN[1]),
            F.lit(True).alias("plan_active"),
            "first.insurance_company_id",
            "insurance_plan_hash",
        )
    )


def known_plans(rows: DataFrame, table: DataFrame) -> DataFrame:
    return rows.join(table.select("insurance_plan_hash"), "insurance_plan_hash", "left_semi")


def new_plans(rows: DataFrame, table: DataFrame) -> DataFrame:
    return rows.join(table.select("insurance_plan_hash"), "insurance_plan_hash", "left_anti")


def plan_ids(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Ids of the plans of a run: those of the table for known plans, then the new ones."""
    known = table.join(rows.select("insurance_plan_hash"), "insurance_plan_hash", "left_semi").select("id")
    return known.unionByName(new_plans(rows, table).select("id"))


def upsert_plans(table: DataFrame, rows: DataFrame) -> DataFrame:
    return merge_seen(table, rows, ["insurance_plan_hash"], *SEEN)


def merge_plans(rows: DataFrame) -> DataFrame:
    """One row per hash of the plans of several runs: as first stored, but for when it was seen."""
    key, seen = "insurance_plan_hash", [F.min(SEEN[0]).alias(SEEN[0]), F.max(SEEN[1]).alias(SEEN[1])]
    kept = [c for c in rows.columns if c not in (key, RUN, *SEEN)]
    first = F.min_by(F.struct(*kept), F.struct(RUN, SEEN[0])).alias("first")
    return rows.groupBy(key).agg(first, *seen).select(key, "first.*", *SEEN)


def plans_table(path: str, **options) -> MergedTable:
    """The stored plan table, merged by hash: `upsert` takes `plan_rows`."""
    return MergedTable(path, StructType.fromDDL(S.PLANS_TABLE), ("insurance_plan_hash",), merge_plans, **options)


def with_activity(table: DataFrame, run_ts: datetime, days: int) -> DataFrame:
    """Mark plans not seen within `days` of the run as inactive; off unless called."""
    limit = F.lit(run_ts).cast("timestamp") - F.make_dt_interval(F.lit(days))
    return table.withColumn("plan_active", F.col(SEEN[1]) >= limit)
