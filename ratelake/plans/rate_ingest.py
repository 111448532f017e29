"""Landed in-network files to messages, dimension and fact."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ratelake import schemas as S
from ratelake.functions.keys import pack, unpack
from ratelake.operators import rates as R
from ratelake.plans.steps import Steps
from ratelake.sinks.merged import BUCKET, RUN, MergedTable
from ratelake.sources import shred as X


@dataclass(frozen=True)
class Bronze:
    items: DataFrame
    references: DataFrame
    headers: DataFrame
    rejects: DataFrame
    failed: DataFrame


def land_bronze(
    files: DataFrame,
    folder: str,
    block_bytes: int = X.BLOCK_BYTES,
    part_bytes: int = X.PART_BYTES,
    steps: Steps | None = None,
) -> Bronze:
    """Shred files once, parse each section once, and land the results as tables below `folder`.

    The raw table is partitioned by section. Its files split, so a packed file that one task had to
    stream is parsed by many. With `steps`, `files` carries the `job_id` of each file, and each step writes its
    status events as it begins: packed files alone are decompressed, and a job with a file that is not whole ends
    as FAILED with the reason, the others as COMPLETED.
    """
    if steps:
        steps.record(files.where(X.packed()), "DECOMPRESSING")
    raw = X.shred(files, ["in_network", "provider_references", X.HEADER_SECTION], block_bytes, part_bytes)
    raw.write.mode("overwrite").partitionBy("section").parquet(f"{folder}/raw")
    staged = files.sparkSession.read.schema(X.RAW).parquet(f"{folder}/raw")
    failed = X.failed_files(staged)
    whole = X.of_whole_files(staged, failed)
    if steps:
        steps.record(files, "PARSING")
    items = X.land(X.parse(whole, "in_network", S.ITEM), f"{folder}/items")
    references = X.land(X.parse(whole, "provider_references", S.PROVIDER_REFERENCE), f"{folder}/references")
    if steps:
        lost = files.select("job_id", "file_id").join(failed, "file_id")
        steps.record(files.join(lost.select("job_id"), "job_id", "left_anti"), "COMPLETED")
        steps.record(lost, "FAILED")
    return Bronze(
        items=X.good(items),
        references=X.good(references),
        headers=X.headers(whole),
        rejects=X.rejects(items).unionByName(X.rejects(references)),
        failed=failed,
    )


def upsert_dimension(table: DataFrame, priced: DataFrame, seen_date: Column) -> DataFrame:
    """The stored dimension and new rows. A table that a merge left packed lies by its keys: new rows alone are dealt, to it."""
    rows = R.dimension_rows(priced, seen_date)
    if dict(table.dtypes)["procedure_hash"] != "binary":
        return R.merge(table.unionByName(rows))
    return unpack(R.merge(table.unionByName(R.merge(pack(rows), packed=True)), packed=True))


def upsert_fact(table: DataFrame, priced: DataFrame, plans_of_files: DataFrame, locations: DataFrame) -> DataFrame:
    """The stored fact and new rows, with today's location of each provider group.

    A fact that carries `rates.NUMBERED` keeps it, and is merged and located by file.
    """
    numbered = {*R.NUMBERED} <= {*table.columns}
    rows = table.drop("zip_code", "region_code").unionByName(R.fact(priced, plans_of_files, numbered=numbered))
    return R.with_locations(R.merge(rows), locations)


def merge_dealt(rows: DataFrame, buckets: int, merged: bool) -> DataFrame:
    """Rows with their bucket merged and dealt by it, as bytes: rows of `merged` runs by one exchange, others summed up before."""
    found = pack(rows.drop(RUN))
    if merged:
        return unpack(R.merge(found.repartition(buckets, BUCKET), packed=True))
    return unpack(R.merge(found, packed=True).repartition(buckets, BUCKET))


def dimension_table(path: str, **options) -> MergedTable:
    """The stored rate dimension, merged by hash: `upsert` takes `rates.dimension_rows`."""
    schema = StructType.fromDDL(S.PROCEDURE_RATE_TABLE)
    return MergedTable(path, schema, ("procedure_hash",), lambda rows: R.merge(rows.drop(RUN)), merge_dealt=merge_dealt, **options)


def fact_table(path: str, **options) -> MergedTable:
    """The stored provider fact: `upsert` takes `rates.fact`. Locations join when it is read, so they are today's."""
    schema = StructType([f for f in StructType.fromDDL(S.PROVIDER_RATE_TABLE) if f.name not in ("zip_code", "region_code")])
    return MergedTable(path, schema, R.FACT_KEY, lambda rows: R.merge(rows.drop(RUN)), merge_dealt=merge_dealt, **options)
