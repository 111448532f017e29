"""Import of one table-of-contents index: plans, files, child jobs and messages."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelake import values as V
from ratelake.operators import insurance_plans as P
from ratelake.operators import toc as T
from ratelake.plans.steps import Steps
from ratelake.session import staged


@dataclass(frozen=True)
class TocImport:
    good_plans: DataFrame
    plans: DataFrame
    plan_table: DataFrame
    files: DataFrame
    file_plans: DataFrame
    jobs: DataFrame
    lots: DataFrame
    messages: DataFrame


def import_toc(
    structures: DataFrame,
    plan_table: DataFrame,
    company_id: Column,
    source_id: Column,
    parent_job_id: Column,
    run_ts: datetime,
    placeholder: str = V.EMPTY_ALLOWED_AMOUNTS,
    scope: str = "structure",
    topic_prefix: str = "",
    part_size: int = 10_000,
    staging: str | None = None,
    steps: Steps | None = None,
) -> TocImport:
    """All tables of an import; the plan table is merged once for the whole index.

    Nothing runs until a table is used, except that with a `staging` folder the plans and the
    files with their plans, which several tables share, are written there first.

    A structure dropped for its placeholder adds neither files nor plans, but its plans still
    serve as donors of ids.

    With `steps`, the import writes its own status events: PARSING as it begins and, once plans and pairs are
    staged, COMPLETED, or FAILED for an index without any plan that has an id.
    """
    own = structures.select(parent_job_id.alias("job_id"), "file_id").distinct()
    if steps:
        steps.record(own, "PARSING")
    good = T.first_plans(T.flatten_plans(structures))
    kept = structures
    if scope == "structure":
        empty = F.contains(F.col("allowed_amount_file.location"), F.lit(placeholder))
        kept = structures.where(~F.coalesce(empty, F.lit(False)))
    plans = P.normalize_plans(T.backfill_plans(T.flatten_plans(kept), good), company_id)
    listed = T.flatten_files(structures, placeholder, scope)
    files = T.files_by_location(listed)
    if staging:
        plans = staged(plans, f"{staging}/plans")
    parts = T.with_plan_parts(files, T.plans_of_files(listed, plans), part_size)
    if staging:
        parts = staged(parts, f"{staging}/file_plans")
    if steps:
        hopeless = own.join(good.select("file_id").distinct(), "file_id", "left_anti")
        steps.record(hopeless.withColumn("reason", F.lit("no plan with an id")), "FAILED")
        steps.record(own.join(hopeless.select("job_id"), "job_id", "left_anti"), "COMPLETED")
    jobs = T.child_jobs(files, parent_job_id, source_id)
    return TocImport(
        good_plans=good,
        plans=plans,
        plan_table=P.upsert_plans(plan_table, P.plan_rows(plans, run_ts)),
        files=files,
        file_plans=parts,
        jobs=jobs,
        lots=T.with_lots(jobs),
        messages=T.dispatch_messages(
            T.child_jobs(parts, parent_job_id, source_id, "part", "n_parts", "reporting_plans"), company_id, topic_prefix
        ),
    )
