"""Exchanges of the rate jobs: what they carry, how many there are, and that nothing of them stays."""

import os
import re

import pytest
from pyspark.sql import functions as F

from ratelake import schemas as S
from ratelake import session
from ratelake.functions import keys as K
from ratelake.operators import rates as R
from ratelake.operators import serving as A
from ratelake.plans import queries as Q
from ratelake.plans import rate_ingest as P

HASH, GROUP = "0f" * 32, "group_" + "1a" * 12
ODD = [HASH, HASH.upper(), "0" * 64, "", "h1", "é\n", None, HASH + "\n", "abc"]


def exchanges(df):
    """The keys of the plan's exchanges, without those of broadcasts."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [re.sub(r"#\d+L?", "", keys) for keys in re.findall(r"Exchange (?:hash|range)partitioning\(([^\n]*?), \d+\)", plan)]


@pytest.fixture
def sorted_joins(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("digits, prefix, texts", [(64, "", ODD), (24, "group_", [*ODD, GROUP, "group_", GROUP[6:], GROUP.upper()])])
def test_packed_text_comes_back_as_it_was(spark, digits, prefix, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "t STRING")
    packed = K.packed(F.col("t"), digits, prefix)
    got = rows.select("t", packed.alias("p")).withColumn("back", K.unpacked(F.col("p"), digits, prefix)).collect()
    assert [r.back for r in got] == texts
    assert len({bytes(r.p) for r in got if r.p is not None}) == len({t for t in texts if t is not None})
    short = {r.t: len(r.p) for r in got if r.p is not None}
    assert short[HASH if digits == 64 else GROUP] == digits // 2


def test_staged_rows_leave_no_shuffle_files(spark, tmp_path):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    with session.shuffles_freed(spark):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name) == before
    assert session.staged(spark.range(9).repartition(3, "id"), str(tmp_path / "a")).count() == 9
    assert all(f.endswith(".zstd.parquet") for f in os.listdir(tmp_path / "a") if f.startswith("part-"))


@pytest.mark.parametrize("name", ["provider_rate_fact", "serve_by_region", "serve_by_zip", "serve_by_plan_code"])
def test_rows_of_the_fact_pass_one_exchange(spark, small, sorted_joins, name):
    keys = exchanges(Q.QUERIES[name](spark, small))
    assert sorted(k for k in keys if "file" in k) == ["_file", "file_id", "file_id"] and not any("provider_group_id" in k for k in keys)


def test_an_upsert_of_a_numbered_fact_is_merged_by_file(spark, small, sorted_joins):
    keys = exchanges(Q.provider_rate_upsert(spark, small))
    assert "file_id" in keys and not any("provider_group_id" in k or "hash" in k for k in keys)


def test_a_fact_without_numbers_is_upserted_the_same(spark, small):
    plans, places = Q.I.file_plans(spark, small), Q.I.locations(spark, small)
    earlier, later = Q.priced(spark, small, F.col("flag") != "R"), Q.priced(spark, small, F.col("flag") != "A")
    found = []
    for numbered in (False, True):
        stored = R.with_locations(R.fact(earlier, plans, numbered=numbered), places)
        found.append(P.upsert_fact(stored, later, plans, places).drop(*R.NUMBERED))
    assert found[0].columns == found[1].columns and found[0].count() == found[1].count() > 0
    assert found[0].exceptAll(found[1]).count() == 0


def test_a_packed_dimension_takes_new_rows_by_one_exchange(spark, small):
    seen = F.col("seen_date")
    first, later = Q.priced(spark, small, F.col("flag") != "R"), Q.priced(spark, small, F.col("flag") != "A")
    rows = R.dimension_rows(first, F.date_sub(seen, 30))
    packed = P.upsert_dimension(R.merge(K.pack(rows), packed=True), later, seen)
    assert sum(k.startswith("procedure_hash") for k in exchanges(packed)) == 2
    plain = P.upsert_dimension(R.merge(rows), later, seen)
    assert packed.exceptAll(plain).count() == plain.exceptAll(packed).count() == 0 < plain.count()


def test_a_bucket_written_anew_leaves_one_copy_behind_the_run(spark, tmp_path):
    def rows(*days):
        return spark.createDataFrame([(f"h{k}", d) for k in range(40) for d in days], "h STRING, d STRING").select(
            F.sha2("h", 256).alias("procedure_hash"), F.lit(1).cast("decimal(18,4)").alias("negotiated_rate"),
            F.lit(None).cast("date").alias("expiration_date"), F.lit("c").alias("billing_code"),
            F.array(F.lit(1).cast("tinyint")).alias("service_code"), F.lit(None).cast("tinyint").alias("billing_class"),
            F.lit(2).cast("tinyint").alias("setting"), F.array(F.lit("m")).alias("billing_code_modifier"),
            F.to_date("d").alias("first_seen_date"), F.to_date("d").alias("last_seen_date"),
        )

    table = P.dimension_table(str(tmp_path / "t"), buckets=4)
    table.upsert(rows("2001-01-01", "2001-01-03"))
    written = table.upsert(rows("2001-01-02", "2001-01-05"))
    assert written.n_rows == 40 and len(written.rewritten) == 4
    kept = [r for r in os.listdir(tmp_path / "t" / "runs") for b in os.listdir(tmp_path / "t" / "runs" / r) if b.startswith("_bucket=")]
    assert len(kept) == 8 and sum(r.endswith("-whole") for r in kept) == 4
    got = {(str(r.first_seen_date), str(r.last_seen_date)) for r in table.read(spark).collect()}
    assert table.read(spark).count() == 40 and got == {("2001-01-01", "2001-01-05")}
    assert table.read(spark, run=1).count() == 40


def test_a_layout_in_steps_has_the_rows_and_order_of_one(spark, tmp_path):
    day = F.lit("2001-01-01").cast("date")
    fact = spark.range(300).select(
        F.concat(F.lit("g"), F.col("id") % 7).alias("provider_group_id"), F.lit("00001").alias("zip_code"), (F.col("id") % 2).alias("region_code"),
        F.lit("p").alias("insurance_plan_id"), F.lit("c").alias("billing_code_id"), F.sha2(F.col("id").cast("string"), 256).alias("procedure_hash"),
        day.alias("first_seen_date"), day.alias("last_seen_date"),
    )
    for steps in (1, 4):
        A.write_layout(fact, "region", str(tmp_path / str(steps)), files=2, steps=steps)
    one, four = (A.read_layout(spark, str(tmp_path / str(s)), S.PROVIDER_RATE_TABLE) for s in (1, 4))
    assert one.columns == four.columns == fact.columns and four.count() == 300 and one.exceptAll(four).count() == 0
    index = sorted(A.read_index(spark, str(tmp_path / "4")).collect(), key=lambda r: r["file"])
    assert len(index) > 4 and all(a["high"] < b["low"] for a, b in zip(index, index[1:], strict=False))
    found = A.look_up(spark, str(tmp_path / "4"), S.PROVIDER_RATE_TABLE, "region", 1)
    assert found.count() == 150 and found.columns == fact.columns


def test_a_price_without_a_number_keeps_its_group(spark):
    day = F.lit("2001-01-01").cast("date")
    fact = spark.sql("SELECT 'p' AS insurance_plan_id, 'c' AS billing_code_id, '1' AS file_id, CAST(NULL AS STRING) AS number").select(
        "insurance_plan_id", "billing_code_id", K.group_id(F.col("file_id"), F.col("number")).alias("provider_group_id"),
        F.lit(HASH).alias("procedure_hash"), day.alias("first_seen_date"), day.alias("last_seen_date"), "file_id", "number",
    )
    known = fact.select(F.col("provider_group_id").alias("group_id"), F.lit("same").alias("content_id"), "file_id", "number")
    places = fact.select("provider_group_id", F.lit("00001").alias("zip_code"), F.lit(1).alias("region_code"), "file_id", "number")
    assert [r.provider_group_id for r in R.by_content(fact, known).collect()] == ["same"]
    assert [r.zip_code for r in R.with_locations(fact, places).collect()] == ["00001"]


LOOKUPS = ["lookup_provider", "lookup_first", "lookup_plan_code", "lookup_region", "lookup_zip"]


@pytest.mark.parametrize("name", LOOKUPS)
def test_a_lookup_writes_its_layout_in_steps(spark, small, name):
    path = {"lookup_first": "region"}.get(name, name.removeprefix("lookup_"))
    Q.QUERIES[name](spark, small)
    target = Q.stored_layout(spark.sparkContext.applicationId, spark, small, path)
    assert len([d for d in os.listdir(f"{target}/rows") if d.startswith(A.STEP)]) == Q.LAYOUT_STEPS
    kept = A.view(Q.stored_rows(spark.sparkContext.applicationId, spark, small), path)
    assert A.read_layout(spark, target, S.PROVIDER_RATE_TABLE).exceptAll(kept).count() == 0 < kept.count()


def test_contents_join_a_fact_by_file(spark, small, sorted_joins):
    rows = R.fact(Q.priced(spark, small), Q.I.file_plans(spark, small), numbered=True)
    same = Q.G.identities(Q.I.file_references(spark, small))
    keys = exchanges(R.by_content(rows, same))
    assert not any(k.startswith("provider_group_id") for k in keys)
    plain = R.by_content(rows.drop(*R.NUMBERED), same)
    assert R.by_content(rows, same).exceptAll(plain).count() == 0 < plain.count()
