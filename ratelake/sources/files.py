"""Landed files: listing, opening in a task, and the file manifest."""

from __future__ import annotations

import gzip
import hashlib
import io
import math
import zipfile
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake import values as V
from ratelake.functions.files import file_extension, file_type
from ratelake.functions.keys import surrogate_id

READ_BYTES = 8 << 20
#: What a task reads, about, and what opening a file costs beside.
TASK_BYTES, OPEN_BYTES = 64 << 20, 4 << 20


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(file_id, file_size) of the files below a folder; no content is read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(path)
        .select(F.col("path").alias("file_id"), F.col("length").alias("file_size"))
    )


def by_bytes(df: DataFrame, size: Column, *columns: str) -> DataFrame:
    """Deal small rows that mean much work each, such as blocks and files, to tasks of TASK_BYTES.

    `size` is how many bytes a row has its task read; opening a file counts as OPEN_BYTES more, as in a scan of
    Spark's own. So the tasks follow from the work, and a lost executor costs minutes at any size. Their number is
    fixed, which keeps AQE from merging tasks whose rows look small.
    """
    whole = df.agg(F.sum(size + F.lit(OPEN_BYTES)).alias("bytes")).first()["bytes"]
    return df.repartition(max(2, math.ceil((whole or 0) / TASK_BYTES)), *columns)


def open_file(uri: str):
    """A landed file as a seekable binary stream, from a local path or a shared file system."""
    if uri.startswith("file:"):
        return open("/" + uri.removeprefix("file:").lstrip("/"), "rb")
    if "://" not in uri:
        return open(uri, "rb")
    from pyarrow import fs

    # Listed paths are plain text, URIs are escaped.
    system, path = fs.FileSystem.from_uri(quote(uri.replace("s3a://", "s3://", 1), safe="/:@"))
    return system.open_input_file(path)


def is_packed(name: str) -> bool:
    return name.lower().endswith((".gz", ".zip"))


def packed() -> Column:
    return F.lower("file_id").rlike("[.](gz|zip)$")


ENTRY = "file_id STRING, file_name STRING, file_size BIGINT, file_hash STRING, error STRING"
# What a damaged archive raises. Other I/O errors are left to the task, which Spark runs again.
UNPACK_ERRORS = (EOFError, gzip.BadGzipFile, zlib.error, zipfile.BadZipFile)


def list_entries(files: DataFrame) -> DataFrame:
    """(file_id, entry, entry_no, size, error): a row for each file in a landed file, which a task of its own can open.

    Entries of a zip are listed from its directory, which alone is read; `size` is what they take packed. A gzip and
    a plain file are one entry without a name. An archive whose directory cannot be read is a row with the error.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file_id in batch["file_id"]:
                try:
                    with open_file(file_id) as stream, zipfile.ZipFile(stream) as archive:
                        rows = [
                            (file_id, info.filename, no, info.compress_size, None)
                            for no, info in enumerate(archive.infolist())
                            if not info.is_dir()
                        ]
                except UNPACK_ERRORS as error:
                    rows = [(file_id, None, None, 0, str(error))]
                yield pd.DataFrame(rows, columns=["file_id", "entry", "entry_no", "size", "error"]).astype({"entry_no": "Int64"})

    zipped = F.lower("file_id").endswith(".zip")
    schema = "file_id STRING, entry STRING, entry_no BIGINT, size BIGINT, error STRING"
    listed = by_bytes(files.where(zipped).select("file_id"), F.lit(0), "file_id").mapInPandas(run, schema)
    none = F.lit(None)
    others = files.where(~zipped).select(
        "file_id", none.cast("string").alias("entry"), none.cast("bigint").alias("entry_no"), F.col("file_size").alias("size"),
        none.cast("string").alias("error"),
    )
    return listed.unionByName(others)


@contextmanager
def open_entry(file_id: str, entry_no: int | None) -> Iterator[tuple[str, object]]:
    """Name and stream of a file in a landed file, unpacked as it is read. One level: an archive inside stays packed."""
    with open_file(file_id) as stream:
        if entry_no is not None:
            with zipfile.ZipFile(stream) as archive:
                info = archive.infolist()[entry_no]
                with archive.open(info) as entry:
                    yield info.filename, entry
        elif file_id.lower().endswith(".gz"):
            with gzip.open(stream) as inner:
                yield file_id[:-3].rsplit("/", 1)[-1], inner
        else:
            yield file_id.rsplit("/", 1)[-1], stream


def _measured(stream) -> tuple[int, str]:
    digest, size = hashlib.sha256(), 0
    while data := stream.read(READ_BYTES):
        digest.update(data)
        size += len(data)
    return size, digest.hexdigest()


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["file_id", "file_name", "file_size", "file_hash", "error"]).astype({"file_size": "Int64"})


def measure_files(files: DataFrame) -> DataFrame:
    """`files` is (file_id, file_size). Name, size and SHA-256 of every extracted file, read as a stream whatever its size.

    The entries of an archive are measured by tasks of their own; one that cannot be unpacked is a row with the error.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                if row.error is not None:
                    yield _frame([(row.file_id, None, None, None, row.error)])
                    continue
                try:
                    with open_entry(row.file_id, None if pd.isna(row.entry_no) else int(row.entry_no)) as (name, stream):
                        yield _frame([(row.file_id, name, *_measured(stream), None)])
                except UNPACK_ERRORS as error:
                    yield _frame([(row.file_id, None, None, None, str(error))])

    entries = list_entries(files)
    return by_bytes(entries, F.col("size"), "file_id", "entry_no").mapInPandas(run, ENTRY)


def measure_archives(archives: DataFrame) -> DataFrame:
    """As `measure_files`, for small zip files that are rows with `content`: a thin reader, one task to an archive."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file_id, content in zip(batch["file_id"], batch["content"]):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as archive:
                        names = [info.filename for info in archive.infolist() if not info.is_dir()]
                        yield _frame([(file_id, name, *_measured(archive.open(name)), None) for name in names])
                except UNPACK_ERRORS as error:
                    yield _frame([(file_id, None, None, None, str(error))])

    return archives.select("file_id", "content").mapInPandas(run, ENTRY)


def manifest(measured: DataFrame, job_id: Column, extension_rule: str = "last") -> DataFrame:
    """Rows of the file manifest from measured files."""
    name = F.col("file_name")
    return measured.where(name.isNotNull()).select(
        surrogate_id(V.ID_JOB_FILE, job_id, F.col("file_id"), name).alias("id"),
        job_id.alias("job_id"),
        "file_name",
        file_type(name).alias("file_type"),
        file_extension(name, extension_rule).alias("file_extension"),
        "file_size",
        "file_hash",
    )


def manifest_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("job_id").agg(
        F.sum("file_size").alias("total_bytes"), F.count(F.lit(1)).alias("n_files")
    )
