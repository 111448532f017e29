"""Edge cases that once went wrong: names, pages, extensions, groups, arrays and batches."""

import json

import pytest
from pyspark.sql import functions as F

from ratelake import schemas as S
from ratelake.functions import keys as K
from ratelake.functions.urls import url_extension
from ratelake.operators import listing as L
from ratelake.operators import providers as G
from ratelake.operators import rates as R
from ratelake.operators import toc as T
from ratelake.sinks.tables import once_table


def test_extension_of_odd_urls(spark):
    urls = {
        "https://h/a b.json": "JSON", "https://h/a.json?sig=x|y": "JSON", "https://h/a.JSON.gz#part": "GZ",
        "https://h.zip": "UNKNOWN", "a.json": "UNKNOWN", "https://h/json": "UNKNOWN", "https://h/a.zip/": "UNKNOWN",
    }
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select("u", url_extension(F.col("u"))).collect()
    assert dict(map(tuple, rows)) == urls


def test_null_and_empty_names_are_two(spark):
    plans = spark.createDataFrame(
        [("f", 0, 0, None, "EIN", "1", None, None), ("f", 1, 0, "", "EIN", "2", None, None), ("f", 2, 0, None, "EIN", "3", None, None)],
        "file_id string, rs_pos long, plan_pos int, plan_name string, plan_id_type string, plan_id string, plan_sponsor_name string, plan_market_type string",
    )
    got = {r["plan_id"]: (r["plan_name"], r["name_rank"]) for r in T.rank_plans(plans).collect()}
    assert got == {"1": (None, 1), "2": ("", 1), "3": (None, 2)}


def test_pages_go_on_behind_a_null_both_ways(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a"), (4, "b"), (5, "b"), (6, "c")], "id long, v string")
    for ascending in (True, False):
        whole = [tuple(r) for r in L.page(df, "v", "id", 0, 10, ascending).collect()]
        seen, last = [], None
        while True:
            rows = L.page(df, "v", "id", 0, 2, ascending) if last is None else L.page_after(df, "v", "id", last, 2, ascending=ascending)
            rows = [tuple(r) for r in rows.collect()]
            if not rows:
                break
            seen += rows
            last = (rows[-1][1], rows[-1][0])
        assert seen == whole


def test_groups_of_two_files_stay_apart(spark):
    group = "provider_groups ARRAY<STRUCT<npi: ARRAY<BIGINT>, tin: STRUCT<type: STRING, value: STRING, business_name: STRING>, tins: STRUCT<type: STRING, value: STRING, business_name: STRING>>>"
    rows = [(file_id, 1, None, [([npi], None, None)]) for file_id, npi in (("a", 11), ("b", 22), ("a", 11))]
    references = spark.createDataFrame(rows, f"file_id STRING, provider_group_id BIGINT, network_name STRING, {group}")
    pairs, providers = G.bridge(G.members(references))
    found = pairs.collect()
    assert sorted(r.npi for r in found) == [11, 22] and len({r.group_id for r in found}) == 2 and providers.count() == 2


def test_malformed_documents_are_named(spark, tmp_path):
    from ratelake.operators import toc as T
    from ratelake.sources import documents as C

    (tmp_path / "bad.json").write_text('{"mrfs": [')
    (tmp_path / "none.json").write_text('{"mrfs": []}')
    gated = T.gate_listings(C.listings(spark, str(tmp_path)))
    assert {r.file_id.rsplit("/", 1)[1]: r.reason for r in gated.collect()} == {"bad.json": "not a listing", "none.json": "no mrf"}
    assert C.structures(spark, str(tmp_path)).count() == 0
    assert [r.file_id.rsplit("/", 1)[1] for r in C.malformed(spark, str(tmp_path), S.TOC).collect()] == ["bad.json"]


def test_parts_of_a_job_open_one_attempt(spark):
    from ratelake.streaming import jobs as M

    rows = [("in-network-file", json.dumps({"id": "j", "payload": {"part": part, "nParts": 3}}), 5 + part) for part in range(3)]
    messages = spark.createDataFrame(rows, "topic string, value string, at int").withColumn("at", F.timestamp_seconds("at"))
    assert M.opened_attempts(M.routed(messages)).count() == 1


def test_one_dimension_row_for_each_hash(spark):
    price = spark.createDataFrame([], S.ITEM).schema["negotiated_rates"].dataType.elementType["negotiated_prices"].dataType.elementType
    base = {f.name: None for f in price.fields}
    arrays = [None, [], [""], [None], ["b", "a"], ["a", "b"], ["a", None, "b", ""]]
    prices = [base | {"service_code": a, "billing_code_modifier": a} for a in arrays]
    from pyspark.sql import types as P

    schema = P.StructType([P.StructField("price", price)])
    rows = spark.createDataFrame([(tuple(p[f.name] for f in price.fields),) for p in prices], schema)
    messages = rows.groupBy().agg(F.collect_list("price").alias("negotiated_prices")).select(
        F.lit("f").alias("file_id"), F.lit(0).alias("item_no"), "negotiated_prices", F.array().cast("array<string>").alias("provider_ids"),
        F.struct(F.lit("CPT").alias("billing_code_type"), F.lit("1").alias("billing_code")).alias("procedure"),
    )
    merged = R.merge(R.dimension_rows(R.prices(messages), F.current_date())).collect()
    assert len(merged) == len({r["procedure_hash"] for r in merged}) == 2


def test_a_batch_appends_a_key_once(spark, tmp_path):
    table = once_table(str(tmp_path / "jobs"), "id STRING, n INT", buckets=2)
    table.upsert(spark.createDataFrame([("a", 1)], "id string, n int"))
    done = table.upsert(spark.createDataFrame([("a", 9), ("b", 2), ("b", 2)], "id string, n int"))
    assert done.n_rows == 2
    assert sorted(map(tuple, table.read(spark).collect())) == [("a", 1), ("b", 2)]


@pytest.mark.parametrize("members", [([["25,59"], ["25", "59"]]), [['a","b'], ["a", "b"]], [["a\\"], ['a"']]])
def test_members_of_arrays_stay_apart_in_the_hash(spark, members):
    """No member is taken for two: other modifiers or service codes are another price."""
    for field in ("billing_code_modifier", "service_code"):
        price = spark.createDataFrame([(m,) for m in members], "m array<string>").select(
            F.struct(
                *[F.lit(None).cast("string").alias(n) for n in ("negotiated_type", "negotiated_rate", "expiration_date", "billing_class", "setting")],
                *[(F.col("m") if n == field else F.array().cast("array<string>")).alias(n) for n in ("service_code", "billing_code_modifier")],
            ).alias("p")
        )
        hashes = price.select(K.price_hash(F.lit("CPT"), F.lit("1"), F.col("p")).alias("h")).distinct()
        assert hashes.count() == 2
