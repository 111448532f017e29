"""Merged tables: what an upsert writes and reads, what a killed one leaves, and that the rows are right."""

import os
import random
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from ratelake.operators import insurance_plans as P
from ratelake.operators import serving as A
from ratelake.sinks.merged import RUN, MergedTable

SCHEMA = StructType().add("key", StringType()).add("value", StringType()).add("first", LongType()).add("last", LongType())


def merge(rows):
    kept = F.min_by(F.col("value"), F.struct(RUN, "first")).alias("value")
    return rows.groupBy("key").agg(kept, F.min("first").alias("first"), F.max("last").alias("last"))


def table(tmp_path, **options):
    return MergedTable(str(tmp_path / "t"), SCHEMA, ("key",), merge, **{"buckets": 8, **options})


def rows(spark, keys, day, value="v"):
    return spark.createDataFrame([(f"k{k}", f"{value}{k}", day, day) for k in keys], SCHEMA)


def found(df):
    return {r["key"]: (r["value"], r["first"], r["last"]) for r in df.collect()}


def size(folder):
    return sum(p.stat().st_size for p in Path(folder).rglob("*.parquet"))


def test_a_small_upsert_writes_its_share_and_reads_nothing(spark, tmp_path):
    t = table(tmp_path)
    t.upsert(rows(spark, range(20_000), 1))
    base = tmp_path / "t" / "runs"
    whole = size(base)
    hidden = tmp_path / "hidden"
    shutil.copytree(base, hidden)
    for part in base.rglob("*.parquet"):
        part.write_bytes(b"not to be opened")
    done = t.upsert(rows(spark, [*range(0, 20_000, 100), 20_000], 2, "late"))
    assert done.n_rows == 201 and done.rewritten == ()
    assert size(base) - sum(p.stat().st_size for p in base.rglob("*.parquet") if p.read_bytes() == b"not to be opened") < whole / 5
    for part in hidden.rglob("*.parquet"):
        shutil.copy(part, base / part.relative_to(hidden))
    got = found(t.read(spark))
    assert len(got) == 20_001 and got["k100"] == ("v100", 1, 2) and got["k1"] == ("v1", 1, 1) and got["k20000"] == ("late20000", 2, 2)
    # An earlier run can still be read.
    assert len(found(t.read(spark, run=1))) == 20_000


def test_buckets_that_grew_are_written_anew_and_no_others(spark, tmp_path):
    t = table(tmp_path, buckets=4)
    t.upsert(rows(spark, range(400), 1))
    one = {r["key"] for r in t.read(spark, [2]).collect()}
    of_one = [int(k[1:]) for k in one]
    done = t.upsert(rows(spark, of_one, 2))
    assert done.rewritten == (2,)
    assert {p.bucket: p.run for p in t.parts(spark, 2)} == {0: 1, 1: 1, 2: 2, 3: 1}
    got = found(t.read(spark))
    assert len(got) == 400 and all(v == ((f"v{k[1:]}"), 1, 2 if k in one else 1) for k, v in got.items())


def test_a_killed_write_leaves_the_old_version(spark, tmp_path, monkeypatch):
    t = table(tmp_path)
    t.upsert(rows(spark, range(50), 1))
    before = found(t.read(spark))

    def killed(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(MergedTable, "_commit", killed)
        with pytest.raises(RuntimeError):
            t.upsert(rows(spark, range(60), 2))
    # A commit that was begun and not finished names nothing either.
    os.makedirs(tmp_path / "t" / "commits" / "commit=2" / "_temporary" / "0")
    assert found(t.read(spark)) == before and t.last_run(spark) == 1
    t.upsert(rows(spark, range(60), 3))
    assert len(found(t.read(spark))) == 60 and found(t.read(spark))["k0"] == ("v0", 1, 3)


def test_many_runs_equal_one_merge(spark, tmp_path):
    t, draw, want = table(tmp_path, buckets=3, slack=0.5), random.Random(3), {}
    assert found(t.read(spark)) == {}
    for day in range(1, 7):
        keys = draw.choices(range(60), k=draw.choice([0, 5, 40]))
        t.upsert(rows(spark, keys, day, f"d{day}-"))
        for k in keys:
            value, first, _ = want.get(f"k{k}", (f"d{day}-{k}", day, day))
            want[f"k{k}"] = (value, first, day)
    assert found(t.read(spark)) == want
    key = next(iter(want))
    assert found(t.of_key(spark, key)) == {key: want[key]} and found(t.of_key(spark, "none")) == {}
    assert found(t.of_keys(spark.createDataFrame([(key,), ("none",)], "key string"))) == {key: want[key]}


def test_a_point_read_opens_one_bucket(spark, tmp_path):
    t = table(tmp_path)
    t.upsert(rows(spark, range(1000), 1))
    assert len(t.of_key(spark, "k7").inputFiles()) == 1


def test_plans_stay_as_first_stored(spark, tmp_path):
    t = P.plans_table(str(tmp_path / "plans"), buckets=2)
    row = ("i", "n", "EIN", "1", None, "GROUP", None, None, True, "c", "h")
    seen = lambda day, name: spark.createDataFrame([row], t.schema).withColumns(
        {"plan_name": F.lit(name), P.SEEN[0]: F.to_timestamp(F.lit(day)), P.SEEN[1]: F.to_timestamp(F.lit(day))}
    )
    t.upsert(seen("2024-02-01", "n"))
    t.upsert(seen("2024-01-01", "later"))
    got = t.read(spark).first()
    assert got.plan_name == "n" and got.plan_sponsor_name is None
    assert (str(got.plan_first_seen)[:10], str(got.plan_last_seen)[:10]) == ("2024-01-01", "2024-02-01")


def test_lookups_open_the_files_of_the_key(spark, tmp_path):
    schema = "provider_group_id STRING, zip_code STRING, region_code BIGINT, insurance_plan_id STRING, billing_code_id STRING, procedure_hash STRING, first_seen_date DATE, last_seen_date DATE"
    fact = spark.range(20_000).select(
        F.format_string("g%05d", F.col("id")).alias("provider_group_id"), F.lit("00501").alias("zip_code"), (F.col("id") % 7).alias("region_code"),
        F.format_string("p%03d", F.col("id") % 100).alias("insurance_plan_id"), F.format_string("c%02d", F.col("id") % 30).alias("billing_code_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("procedure_hash"), F.current_date().alias("first_seen_date"), F.current_date().alias("last_seen_date"),
    )
    folder = str(tmp_path / "plan_code")
    A.write_layout(fact, "plan_code", folder, files=16)
    index = A.read_index(spark, folder)
    assert index.count() == 16 and index.agg(F.sum("n_rows")).first()[0] == 20_000
    for key in (("p007", "c07"), ("p007",), ("p007", "c07", "g00007")):
        got = A.look_up(spark, folder, schema, "plan_code", *key)
        assert len(got.inputFiles()) <= 2
        columns = ("insurance_plan_id", "billing_code_id", "provider_group_id")
        want = fact.where(" AND ".join(f"{c} = '{v}'" for c, v in zip(columns, key))).count()
        assert got.count() == want > 0
    assert A.look_up(spark, folder, schema, "plan_code", "q").count() == 0
    first = A.first_match(A.look_up(spark, folder, schema, "plan_code", "p050"))
    assert first.count() == 1
