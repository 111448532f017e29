"""The list page: filter, sort, page, choose columns, count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def matching(df: DataFrame, column: str, text: str) -> DataFrame:
    """Rows whose column contains the text, whatever its case."""
    return df.where(F.contains(F.lower(F.col(column)), F.lower(F.lit(text))))


def page(
    df: DataFrame, sort: str, row_id: str, number: int, size: int = 10, ascending: bool = True,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Page `number` (from 0). Ties are broken by the row id, so pages never overlap."""
    order = [F.col(sort).asc() if ascending else F.col(sort).desc(), F.col(row_id).asc()]
    return df.orderBy(*order).offset(number * size).limit(size).select(*(columns or df.columns))


def page_after(
    df: DataFrame, sort: str, row_id: str, last: tuple, size: int = 10, columns: Sequence[str] | None = None,
    ascending: bool = True,
) -> DataFrame:
    """The page behind the row with sort value and id `last`, at the same cost however deep it lies.

    NULL sort values come first in ascending order and last in descending order, as on `page`.
    """
    value, last_id = last
    column, later_id = F.col(sort), F.col(row_id) > F.lit(last_id)
    if value is None:
        behind = (column.isNull() & later_id) | (column.isNotNull() if ascending else F.lit(False))
    else:
        further = column > F.lit(value) if ascending else (column < F.lit(value)) | column.isNull()
        behind = further | ((column == F.lit(value)) & later_id)
    order = [column.asc() if ascending else column.desc(), F.col(row_id).asc()]
    return df.where(behind).orderBy(*order).limit(size).select(*(columns or df.columns))


def _order(sort: str, row_id: str, ascending: bool) -> list[Column]:
    return [F.col(sort).asc() if ascending else F.col(sort).desc(), F.col(row_id).asc()]


def write_pages(df: DataFrame, sort: str, row_id: str, folder: str, ascending: bool = True, files: int | None = None) -> None:
    """Write a list in its order, cut into ranges, with an index: how many rows lie before each range's file."""
    order, spark = _order(sort, row_id, ascending), df.sparkSession
    ranged = df.repartitionByRange(*([files] if files else []), *order).sortWithinPartitions(*order)
    ranged.write.mode("overwrite").parquet(f"{folder}/rows")
    file = F.col("_metadata.file_path")
    counts = spark.read.parquet(f"{folder}/rows").groupBy(file.alias("file")).agg(F.count(F.lit(1)).alias("n_rows"))
    # Files are numbered in the order of their ranges; the window has a row a file.
    number = F.regexp_extract("file", "part-([0-9]+)", 1).cast("int")
    before = Window.orderBy(number).rowsBetween(Window.unboundedPreceding, -1)
    counts.withColumn("before", F.coalesce(F.sum("n_rows").over(before), F.lit(0))).write.mode("overwrite").parquet(f"{folder}/index")


def deep_page(
    spark: SparkSession, folder: str, sort: str, row_id: str, number: int, size: int = 10, ascending: bool = True,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Page `number` (from 0) of a written list: what `page` gives, at the same cost however deep it lies."""
    start, end = number * size, (number + 1) * size
    index = spark.read.parquet(f"{folder}/index")
    hit = index.where((F.col("before") < end) & (F.col("before") + F.col("n_rows") > start)).collect()
    schema = spark.read.parquet(f"{folder}/rows").schema
    if not hit:
        return spark.createDataFrame([], schema).select(*(columns or schema.names))
    rows = spark.read.schema(schema).parquet(*[row["file"] for row in hit])
    first = start - min(row["before"] for row in hit)
    return rows.orderBy(*_order(sort, row_id, ascending)).offset(first).limit(size).select(*(columns or schema.names))


def selection_counts(df: DataFrame, selected: Column) -> DataFrame:
    """How many of the rows are selected."""
    return df.agg(F.count_if(selected).alias("n_selected"), F.count(F.lit(1)).alias("n_rows"))
