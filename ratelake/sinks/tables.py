"""Tables that grow by appends: jobs, file manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ratelake.sinks.merged import RUN, MergedTable


def once_table(path: str, schema: str | StructType, key: str = "id", **options) -> MergedTable:
    """A table whose rows are stored once by key, as they first came.

    Ids follow from what a row stands for, so a run that is repeated adds nothing. An append compares with
    nothing that is stored: a row that was there before lies beside it until the bucket is read or written
    anew, and goes then.
    """

    def first(rows: DataFrame) -> DataFrame:
        kept = [c for c in rows.columns if c not in (key, RUN)]
        return rows.groupBy(key).agg(F.min_by(F.struct(*kept), F.struct(RUN, F.xxhash64(*kept))).alias("row")).select(key, "row.*")

    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return MergedTable(path, fields, (key,), first, **options)


def dump_json(df: DataFrame, folder: str) -> None:
    """One JSON object per line, for reading by people and tools."""
    df.write.mode("overwrite").json(folder)
