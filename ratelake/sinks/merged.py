"""Tables whose rows have a key and are merged: an upsert writes what is new and reads what it must rewrite.

Rows lie in buckets by the hash of their key. A run writes its own rows only, to a folder of its own, one
part for each bucket it touches. A bucket's rows are those of its runs, merged when they are read. Where the
later runs of a bucket have grown beyond a share of its oldest, the run that finds it so reads that bucket,
alone, and writes it anew. So each row is rewritten a few times over the life of a table, however large.

Which folders are live is a commit: a small table written last, in one file. A run that dies before leaves
folders that no commit names, and readers go on with the commit before. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from ratelake import session

BUCKET, RUN = "_bucket", "_run"
ENTRY = "bucket INT, run BIGINT, folder STRING, n_rows BIGINT"


@dataclass(frozen=True)
class Part:
    """Rows of one run in one bucket."""

    bucket: int
    run: int
    folder: str
    n_rows: int


@dataclass(frozen=True)
class Written:
    """What an upsert did: its run, the rows it brought, and the buckets it wrote anew."""

    run: int
    n_rows: int
    rewritten: tuple[int, ...]


@dataclass(frozen=True)
class MergedTable:
    """A table below `path`. `keys` are not NULL; `merge` makes one row per key of rows of several runs.

    `merge` gets the columns of `schema` and RUN, the number of the run a row came with, and must give the same
    whether it is applied to all rows at once or to some first. `buckets` is fixed for the life of a table; a
    bucket is what one task rewrites. `slack` is the share of a bucket's oldest rows that may lie in later runs.
    `merge_dealt` does what `merge` does to rows that carry BUCKET, keeps it, and deals them by it into as many parts
    as there are buckets; it is told whether each run's rows are merged, so that buckets are written anew behind one
    exchange in place of two.
    """

    path: str
    schema: StructType
    keys: tuple[str, ...]
    merge: Callable[[DataFrame], DataFrame]
    buckets: int = 64
    slack: float = 0.25
    merge_dealt: Callable[[DataFrame, int, bool], DataFrame] | None = None

    def bucket(self, *values: Column) -> Column:
        """The bucket of a key, from its columns or from values of the same types."""
        return F.pmod(F.xxhash64(*(values or [F.col(key) for key in self.keys])), F.lit(self.buckets)).cast("int")

    def _commits(self, spark: SparkSession) -> DataFrame:
        try:
            return spark.read.schema(f"{ENTRY}, commit BIGINT").parquet(f"{self.path}/commits")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], f"{ENTRY}, commit BIGINT")

    def last_run(self, spark: SparkSession) -> int:
        """The number of the last committed run, 0 before the first."""
        return self._commits(spark).agg(F.coalesce(F.max("commit"), F.lit(0)).alias("run")).first()["run"]

    def parts(self, spark: SparkSession, run: int) -> list[Part]:
        """The live parts behind a committed run."""
        rows = self._commits(spark).where((F.col("commit") == run) & F.col("bucket").isNotNull()).collect()
        return [Part(r["bucket"], r["run"], r["folder"], r["n_rows"]) for r in rows]

    def _scan(self, spark: SparkSession, parts: Sequence[Part]) -> DataFrame:
        """The rows of parts with their run and bucket; only these parts' files are listed and opened."""
        by_folder = defaultdict(list)
        for part in parts:
            by_folder[part.folder, part.run].append(part.bucket)
        stored = StructType([*self.schema]).add(RUN, LongType()).add(BUCKET, IntegerType())
        found = [
            spark.read.schema(stored).option("basePath", f"{self.path}/{folder}").parquet(
                *[f"{self.path}/{folder}/{BUCKET}={bucket}" for bucket in sorted(buckets)]
            )
            for (folder, _), buckets in sorted(by_folder.items())
        ]
        return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], stored)

    def _merged(self, rows: DataFrame) -> DataFrame:
        return self.merge(rows.select(*self.schema.names, RUN)).select(*self.schema.names)

    def read(self, spark: SparkSession, buckets: Sequence[int] | None = None, run: int | None = None) -> DataFrame:
        """The table as the last run left it, or an earlier one, or some buckets of it. Buckets with one run go by without an exchange."""
        by_bucket = defaultdict(list)
        for part in self.parts(spark, self.last_run(spark) if run is None else run):
            if buckets is None or part.bucket in buckets:
                by_bucket[part.bucket].append(part)
        alone = [own[0] for own in by_bucket.values() if len(own) == 1]
        several = [part for own in by_bucket.values() if len(own) > 1 for part in own]
        rows = self._scan(spark, alone).select(*self.schema.names)
        return rows.unionByName(self._merged(self._scan(spark, several))) if several else rows

    def of_key(self, spark: SparkSession, *values) -> DataFrame:
        """The row of one key, from the files of its bucket alone."""
        typed = [F.lit(v).cast(self.schema[key].dataType) for key, v in zip(self.keys, values, strict=True)]
        bucket = spark.range(1).select(self.bucket(*typed).alias("bucket")).first()["bucket"]
        rows = self.read(spark, [bucket])
        return reduce(lambda df, kv: df.where(F.col(kv[0]) == kv[1]), zip(self.keys, typed, strict=True), rows)

    def of_keys(self, rows: DataFrame) -> DataFrame:
        """The table's rows of the keys in `rows`, from the files of their buckets alone."""
        wanted = rows.select(*self.keys).distinct()
        buckets = [r["bucket"] for r in wanted.select(self.bucket().alias("bucket")).distinct().collect()]
        return self.read(rows.sparkSession, buckets).join(wanted, list(self.keys), "left_semi")

    def _dealt(self, rows: DataFrame, merged: bool) -> DataFrame:
        """Rows merged and dealt by their bucket, which they carry."""
        bucket = self.bucket().alias(BUCKET)
        if self.merge_dealt:
            return self.merge_dealt(rows.select(*self.schema.names, RUN, bucket), self.buckets, merged)
        return self._merged(rows).select("*", bucket).repartition(self.buckets, BUCKET)

    def _write(self, dealt: DataFrame, folder: str, run: int) -> list[Part]:
        """Rows by bucket, and how many each got: counted from the files' footers."""
        spark, target = dealt.sparkSession, f"{self.path}/{folder}"
        with session.shuffles_freed(spark):
            dealt.withColumn(RUN, F.lit(run)).write.partitionBy(BUCKET).parquet(target)
        stored = StructType().add(BUCKET, IntegerType())
        counts = spark.read.schema(stored).parquet(target).groupBy(BUCKET).count().collect()
        return [Part(r[BUCKET], run, folder, r["count"]) for r in counts]

    def upsert(self, rows: DataFrame) -> Written:
        """Merge rows into the table; rows of one key are merged among themselves first."""
        spark = rows.sparkSession
        before = self.last_run(spark)
        live, run, name = self.parts(spark, before), before + 1, uuid.uuid4().hex
        fresh = self._write(self._dealt(rows.withColumn(RUN, F.lit(run)), False), f"runs/{run}-{name}", run)
        by_bucket = defaultdict(list)
        for part in [*live, *fresh]:
            by_bucket[part.bucket].append(part)
        touched = {part.bucket for part in fresh}
        full = []
        for bucket in sorted(touched):
            own = sorted(by_bucket[bucket], key=lambda part: part.run)
            if len(own) > 1 and sum(part.n_rows for part in own[1:]) > self.slack * own[0].n_rows:
                full.append(bucket)
        if full:
            old = [part for bucket in full for part in by_bucket.pop(bucket)]
            for part in self._write(self._dealt(self._scan(spark, old), True), f"runs/{run}-{name}-whole", run):
                by_bucket[part.bucket].append(part)
        self._commit(spark, [part for own in by_bucket.values() for part in own], run)
        self._remove(spark, [part for part in fresh if part.bucket in full])
        return Written(run, sum(part.n_rows for part in fresh), tuple(full))

    def _remove(self, spark: SparkSession, parts: list[Part]) -> None:
        """Delete parts that no commit names."""
        for part in parts:
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{part.folder}/{BUCKET}={part.bucket}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    def _commit(self, spark: SparkSession, parts: list[Part], run: int) -> None:
        """One file, which appears whole or not at all. An empty table has a row without a bucket."""
        rows = [(p.bucket, p.run, p.folder, p.n_rows) for p in parts] or [(None, run, None, 0)]
        spark.createDataFrame(rows, ENTRY).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/commit={run}")
