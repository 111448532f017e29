"""Two items, their providers, and files in every packing."""

import gzip
import json
import zipfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ratelake import schemas as S
from ratelake.operators import jobs as J
from ratelake.operators import providers as G
from ratelake.operators import rates as R
from ratelake.operators import serving as A
from ratelake.functions.keys import group_id
from ratelake.plans.rate_ingest import land_bronze, upsert_dimension, upsert_fact
from ratelake.plans.steps import Steps
from ratelake.sources import files as D
from ratelake.sources import scan
from ratelake.sources import shred as X

PRICE = {"negotiated_type": "negotiated", "expiration_date": "9999-12-31", "billing_class": "professional"}
DOCUMENT = {
    "reporting_entity_name": "Insurer",
    "reporting_entity_type": "group",
    "last_updated_on": "2024-01-01",
    "provider_references": [
        {
            "provider_group_id": 1,
            "network_name": "N",
            "provider_groups": [
                {"npi": [10, 11], "tins": {"type": "ein", "value": "T1", "business_name": "B"}},
                {"npi": [11], "tin": {"type": "npi", "value": "11"}},
            ],
        },
        {"provider_group_id": 2, "provider_groups": []},
    ],
    "in_network": [
        {
            "negotiation_arrangement": "ffs",
            "billing_code_type": "CPT",
            "billing_code": "99213",
            "negotiated_rates": [
                {
                    "negotiated_prices": [
                        {**PRICE, "negotiated_rate": 100.5, "service_code": ["22", "11"], "bogus": {"a": [1]}},
                        {**PRICE, "negotiated_rate": 80, "additional_information": ["x", "y"]},
                    ],
                    "provider_references": [1, 2],
                },
                {"negotiated_prices": [{**PRICE, "expiration_date": "soon", "setting": "moon"}], "provider_references": [2]},
            ],
        },
        {
            "billing_code_type": "MS-DRG",
            "billing_code": "470",
            "negotiated_rates": [],
            "bundled_codes": [{"billing_code_type": "CPT", "billing_code": "1", "description": "d"}],
        },
    ],
    "version": "1.0",
}
BAD = {
    "in_network": [
        {"billing_code": "a", "negotiated_rates": [{"negotiated_prices": [{"negotiated_rate": "bad"}], "provider_references": [1]}]},
        {"billing_code": "b", "negotiated_rates": [{"negotiated_prices": [], "provider_references": [2.5]}]},
        {"billing_code": "c", "negotiated_rates": [{"negotiated_prices": [{"negotiated_rate": 1}], "provider_references": [3]}]},
    ]
}


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("landed")
    text = json.dumps(DOCUMENT)
    (folder / "plain.json").write_text(text)
    (folder / "pretty file.json").write_text(json.dumps(DOCUMENT, indent=2))
    with gzip.open(folder / "packed.json.gz", "wt") as out:
        out.write(text)
    with zipfile.ZipFile(folder / "two.zip", "w") as out:
        out.writestr("in/a.json", text)
        out.writestr("b.json", json.dumps(BAD))
    return str(folder)


@pytest.fixture(scope="module")
def bronze(spark, landed, tmp_path_factory):
    staging = str(tmp_path_factory.mktemp("staging") / "raw")
    return land_bronze(D.list_files(spark, landed), staging, block_bytes=128)


@pytest.fixture(scope="module")
def one(bronze):
    items = bronze.items.where(F.col("file_id").endswith("plain.json"))
    return items, R.rate_messages(items)


def test_every_packing_gives_the_same(bronze):
    rows = bronze.items.where("part = 0").groupBy("file_id").agg(F.sort_array(F.collect_list("billing_code")).alias("codes")).collect()
    found = {r.file_id.split("/landed0/")[1]: r.codes for r in rows}
    both = ["470", "99213"]
    assert found == {"plain.json": both, "pretty file.json": both, "packed.json.gz": both, "two.zip!in/a.json": both, "two.zip!b.json": ["c"]}


def test_bad_items_cost_only_themselves(bronze):
    rows = bronze.rejects.collect()
    assert sorted(json.loads(r.text)["billing_code"] for r in rows) == ["a", "b"]


def test_headers(bronze):
    rows = {r.file_id.split("/landed0/")[1]: r for r in bronze.headers.collect()}
    assert rows["plain.json"].reporting_entity_name == "Insurer" and rows["packed.json.gz"].version == "1.0"
    assert rows["plain.json"].plan_name is None and len(rows) == 5


def test_messages(one):
    rows = sorted(one[1].collect(), key=lambda r: r.rate_no)
    assert [(r.procedure.billing_code, r.provider_ids) for r in rows] == [("99213", ["1", "2"]), ("99213", ["2"])]
    assert rows[0].procedure.name == "" and rows[0].negotiated_prices[0].negotiated_rate == Decimal("100.5000")
    assert rows[1].negotiated_prices[0].negotiated_rate is None
    assert rows[0].negotiated_prices[1].additional_information == '["x","y"]'


def test_wire_defaults(one):
    row = R.wire_messages(one[1].where("rate_no = 1")).first()
    price = row.negotiated_prices[0]
    assert price.negotiated_rate == 0.0 and price.service_code == [] and price.additional_information == []


def test_item_codes(one):
    rows = R.item_codes(one[0]).collect()
    assert [(r.item_billing_code, r.kind, r.billing_code) for r in rows] == [("470", "bundled_code", "1")]


def test_dimension(one):
    priced = R.prices(one[1])
    day = F.to_date(F.lit("2024-01-01"))
    rows = {r.negotiated_rate: r for r in R.merge(R.dimension_rows(priced, day)).collect()}
    assert set(rows) == {Decimal("100.5000"), Decimal("80.0000"), None}
    full = rows[Decimal("100.5000")]
    assert full.service_code == [11, 22] and full.billing_class == 1 and full.setting is None
    assert rows[None].expiration_date is None
    assert [(r.field, r.word, r.n_prices) for r in R.unknown_codes(priced).collect()] == [("setting", "moon", 1)]


def test_price_hash_ignores_array_order(one):
    price = F.col("price")
    turned = R.prices(one[1]).withColumn("price", price.withField("service_code", F.reverse(price["service_code"])))
    from ratelake.functions.keys import price_hash

    again = turned.withColumn("h", price_hash(F.col("billing_code_type"), F.col("billing_code"), price))
    assert again.where("h <> procedure_hash").count() == 0


def places(spark, one):
    rows = spark.createDataFrame([(1, "00501", 1), (2, None, 2)], "number long, zip_code string, region_code bigint")
    file_id = one[0].first().file_id
    return rows.select(group_id(F.lit(file_id), F.col("number")).alias("provider_group_id"), "zip_code", "region_code")


def fact_of(spark, one, day="2024-01-01"):
    priced = R.prices(one[1]).withColumn("seen_date", F.to_date(F.lit(day)))
    plans = one[0].select("file_id").distinct().withColumn("insurance_plan_id", F.lit("p1"))
    return priced, plans


def test_fact_and_upserts(spark, one):
    priced, plans = fact_of(spark, one)
    fact = upsert_fact(spark.createDataFrame([], S.PROVIDER_RATE_TABLE), priced, plans, places(spark, one))
    assert fact.count() == 5
    later = priced.withColumn("seen_date", F.to_date(F.lit("2024-02-01")))
    again = upsert_fact(fact, later.where("price.negotiated_rate = 80"), plans, places(spark, one))
    rows = again.groupBy("first_seen_date", "last_seen_date").count().collect()
    assert sorted((str(r.first_seen_date), str(r.last_seen_date), r["count"]) for r in rows) == [
        ("2024-01-01", "2024-01-01", 3),
        ("2024-01-01", "2024-02-01", 2),
    ]
    day = F.to_date(F.lit("2024-01-01"))
    table = upsert_dimension(spark.createDataFrame([], S.PROCEDURE_RATE_TABLE), priced, day)
    assert sorted(upsert_dimension(table, priced, day).collect()) == sorted(table.collect(), key=lambda r: r)


def test_members_and_join(bronze, one):
    references = bronze.references.where(F.col("file_id").endswith("plain.json"))
    members = G.members(references)
    rows = sorted((r.member_no, r.npi, r.tax_id_type, r.tax_id) for r in members.collect())
    assert rows == [(0, 10, "ein", "T1"), (0, 11, "ein", "T1"), (1, 11, "npi", "11")]
    pairs, providers = G.bridge(members)
    assert (pairs.count(), providers.count()) == (2, 2)
    joined = G.join_rates(one[1], references).collect()
    assert sorted((r.rate_no, r.provider_group_id, r.n_members) for r in joined) == [(0, 1, 2), (0, 2, 0), (1, 2, 0)]
    assert {r.group_id for r in members.select("group_id").collect()} < {r.group_id for r in joined}


def test_layouts_and_lookups(spark, one, tmp_path):
    priced, plans = fact_of(spark, one)
    fact = upsert_fact(spark.createDataFrame([], S.PROVIDER_RATE_TABLE), priced, plans, places(spark, one))
    counts = {}
    for path in A.PATHS:
        A.write_layout(fact, path, str(tmp_path / path))
        counts[path] = A.read_layout(spark, str(tmp_path / path), S.PROVIDER_RATE_TABLE).count()
    assert counts == {"plan_code": 5, "region": 5, "zip": 2, "provider": 5}
    layout = A.read_layout(spark, str(tmp_path / "zip"), S.PROVIDER_RATE_TABLE)
    found = A.lookup(layout, "zip", "00501", "99213")
    rates = A.with_rates(found, R.merge(R.dimension_rows(priced, F.col("seen_date"))))
    assert sorted(r.negotiated_rate for r in rates.collect()) == [Decimal("80.0000"), Decimal("100.5000")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(zip_code), IsNotNull(billing_code_id), EqualTo(zip_code,00501)" in plan
    provider = A.read_layout(spark, str(tmp_path / "provider"), S.PROVIDER_RATE_TABLE)
    second = places(spark, one).where("region_code = 2").first().provider_group_id
    assert A.lookup(provider, "provider", second).count() == 3


def test_manifest(spark, landed):
    import hashlib

    rows = {r.file_name: r for r in D.manifest(D.measure_files(D.list_files(spark, landed)), F.lit("job")).collect()}
    assert set(rows) == {"plain.json", "pretty file.json", "packed.json", "in/a.json", "b.json"}
    text = json.dumps(DOCUMENT).encode()
    assert rows["packed.json"].file_size == len(text)
    assert rows["in/a.json"].file_hash == rows["plain.json"].file_hash == hashlib.sha256(text).hexdigest()
    totals = D.manifest_totals(D.manifest(D.measure_files(D.list_files(spark, landed)), F.lit("job"))).first()
    assert totals.n_files == 5


def test_large_file_in_many_blocks(spark, tmp_path):
    items = [{"name": f'{i} "{{[\\', "billing_code": str(i), "description": "é" * (i % 50)} for i in range(3000)]
    (tmp_path / "big.json").write_text(json.dumps({"version": "1", "in_network": items, "z": 1}, ensure_ascii=False))
    raw = X.shred(D.list_files(spark, str(tmp_path)), ["in_network", X.HEADER_SECTION], block_bytes=5000)
    rows = X.good(X.parse(raw, "in_network", S.ITEM)).select("item_no", "name", "billing_code", "description").collect()
    found = sorted((r.item_no, r.name, r.billing_code, r.description) for r in rows)
    assert found == [(i, x["name"], x["billing_code"], x["description"]) for i, x in enumerate(items)]
    assert X.headers(raw).first().version == "1"


def test_giant_elements_come_in_parts(spark, tmp_path):
    """One code with very many rates and one group with very many members: every rate and member, in order, with all scalars."""
    rates = [{"negotiated_prices": [{**PRICE, "negotiated_rate": i}], "provider_references": [7]} for i in range(500)]
    members = [{"npi": [i], "tins": {"type": "ein", "value": str(i)}} for i in range(300)]
    bad = [{"negotiated_prices": [{"negotiated_rate": "x" if i == 99 else 1}], "provider_references": [1]} for i in range(100)]
    giant = {"billing_code_type": "CPT", "negotiated_rates": rates, "billing_code": "99", "bundled_codes": [{"billing_code": str(i)} for i in range(90)]}
    doc = {
        "in_network": [{"billing_code": "1", "negotiated_rates": rates[:1]}, giant, {"billing_code": "bad", "negotiated_rates": bad}],
        "provider_references": [{"provider_groups": members, "network_name": "N", "provider_group_id": 7}],
        "version": "1",
    }
    (tmp_path / "giant.json").write_text(json.dumps(doc))
    (tmp_path / "giant.json.gz").write_bytes(gzip.compress(json.dumps(doc).encode()))
    files = D.list_files(spark, str(tmp_path))
    bronze = land_bronze(files, str(tmp_path / "staging"), block_bytes=3000, part_bytes=1000)
    raw = spark.read.parquet(str(tmp_path / "staging" / "raw"))
    assert raw.agg(F.max(F.length("text"))).first()[0] < 4000
    messages = R.rate_messages(bronze.items)
    for packed in (".json", ".json.gz"):
        own = messages.where(F.col("file_id").endswith(packed)).where("procedure.billing_code = '99'").orderBy("rate_no").collect()
        assert [r.rate_no for r in own] == list(range(500))
        assert [r.negotiated_prices[0].negotiated_rate for r in own] == list(range(500))
        assert {r.procedure.billing_code_type for r in own} == {"CPT"}
        found = G.members(bronze.references.where(F.col("file_id").endswith(packed))).orderBy("member_no").collect()
        assert [(r.member_no, r.npi, r.network_name, r.provider_group_id) for r in found] == [(i, i, "N", 7) for i in range(300)]
        codes = R.item_codes(bronze.items.where(F.col("file_id").endswith(packed))).orderBy("pos").collect()
        assert [(r.pos, r.billing_code) for r in codes] == [(i, str(i)) for i in range(90)]
    assert bronze.items.where("billing_code = 'bad'").count() == 0
    parsed = X.parse(raw, "in_network", S.ITEM)
    none = F.lit(0)
    metrics = J.parse_metrics(parsed.select("file_id", "part", "bad", F.size("negotiated_rates").alias("n_rates"), none.alias("n_providers")))
    assert {tuple(r)[1:5] for r in metrics.collect()} == {(3, 2, 1, 501)}
    joined = G.join_rates(messages, bronze.references).where("procedure.billing_code = '99'").collect()
    assert len(joined) == 1000 and {r.n_members for r in joined} == {300}


def test_an_item_of_many_megabytes_in_flat_memory(tmp_path):
    """The scanner holds a part and a member of an item, not the item."""
    import tracemalloc

    rate = b'{"negotiated_prices":[{"negotiated_rate":1}],"provider_references":[1]},'

    class Endless:
        """A document of 256 MB that is nowhere whole."""

        left = [b'{"in_network":[{"billing_code":"1","negotiated_rates":[', *[rate * (16_384)] * 220, rate[:-1] + b"]}]}"]

        def read(self, n):
            return self.left.pop(0) if self.left else b""

    tracemalloc.start()
    n = 0
    for *_, whole, text in scan.cut(scan.chunks_of(Endless()), scan.State(), float("inf"), frozenset(["in_network"]), 1 << 20, True):
        assert not whole and len(text) < 4 << 20
        n += text.count(b"provider_references")
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 16_384 * 220 + 1 and peak < 100 << 20


def test_empty_file_gives_nothing(spark, tmp_path):
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "bare.json").write_text("{}")
    raw = X.shred(D.list_files(spark, str(tmp_path)), ["in_network"])
    assert raw.count() == 0


def test_broken_files(spark, tmp_path):
    text = json.dumps(DOCUMENT).encode()
    packed = gzip.compress(text * 50)
    (tmp_path / "short.json.gz").write_bytes(packed[: len(packed) - 20])
    (tmp_path / "no.zip").write_bytes(b"PK no archive")
    (tmp_path / "fine.json").write_bytes(text)
    (tmp_path / "cut.json").write_bytes(text[: text.index(b"470") + 20])
    files = D.list_files(spark, str(tmp_path))
    bronze = land_bronze(files, str(tmp_path / "staging"), block_bytes=200)
    name = lambda r: r.file_id.rsplit("/", 1)[1]
    assert sorted(name(r) for r in bronze.failed.collect()) == ["cut.json", "no.zip", "short.json.gz"]
    assert sorted((name(r), r.billing_code) for r in bronze.items.where("part = 0").collect()) == [("fine.json", "470"), ("fine.json", "99213")]
    measured = D.measure_files(files).collect()
    assert sorted(name(r) for r in measured if r.error) == ["no.zip", "short.json.gz"]
    assert D.manifest(D.measure_files(files), F.lit("j")).count() == 2


def test_archives_with_odd_names_and_archives_in_them(spark, tmp_path):
    """A failed archive takes its own rows with it and no others; an archive inside an archive is a failed file."""
    text = json.dumps(DOCUMENT)
    for name, members in {"a!b.zip": {"x.json": text, "y.json": text[:-5]}, "a.zip": {"x!.json": text}, "n.zip": {"x.json.gz": text}}.items():
        with zipfile.ZipFile(tmp_path / name, "w") as archive:
            for member, body in members.items():
                archive.writestr(member, body)
    bronze = land_bronze(D.list_files(spark, str(tmp_path)), str(tmp_path / "staging"))
    name = lambda r: r.file_id.rsplit("/", 1)[1]
    assert sorted(name(r) for r in bronze.failed.collect()) == ["a!b.zip", "n.zip"]
    assert {name(r) for r in bronze.items.collect()} == {"a.zip!x!.json"}


def test_fact_keeps_files_apart_and_new_codes_join_old_rows(spark, one):
    """Group 1 of two files is two groups; a word that gets a code later is no second dimension row."""
    priced, _ = fact_of(spark, one)
    both = priced.unionByName(priced.withColumn("file_id", F.lit("other")))
    plans = both.select("file_id").distinct().withColumn("insurance_plan_id", F.lit("p1"))
    groups = R.fact(both, plans).select("provider_group_id").distinct()
    assert groups.count() == 4
    rows = R.dimension_rows(priced, F.col("seen_date"))
    later = rows.withColumn("setting", F.lit(9).cast("tinyint"))
    merged = R.merge(rows.unionByName(later))
    assert merged.count() == rows.select("procedure_hash").distinct().count()
    assert merged.where("setting = 9").count() == merged.count()


def test_steps_write_their_events(spark, landed, tmp_path):
    """A packed file is decompressed first, a file that is not whole ends as FAILED, and every move is legal."""
    (tmp_path / "in").mkdir()
    text = json.dumps(DOCUMENT).encode()
    for name, body in {"a.json.gz": gzip.compress(text), "b.json": text, "c.json": text[:-9]}.items():
        (tmp_path / "in" / name).write_bytes(body)
    files = D.list_files(spark, str(tmp_path / "in")).withColumn("job_id", F.regexp_extract("file_id", "([abc])[.]json", 1))
    steps = Steps(str(tmp_path / "events"))
    steps.record(files, "PENDING")
    steps.record(files, "DOWNLOADING")
    land_bronze(files, str(tmp_path / "bronze"), steps=steps)
    events = steps.events(spark)
    found = {}
    for row in events.orderBy("status_time").collect():
        found.setdefault(row.job_id, []).append(row.status)
    assert found == {
        "a": ["PENDING", "DOWNLOADING", "DECOMPRESSING", "PARSING", "COMPLETED"],
        "b": ["PENDING", "DOWNLOADING", "PARSING", "COMPLETED"],
        "c": ["PENDING", "DOWNLOADING", "PARSING", "FAILED"],
    }
    assert J.illegal_moves(events, F.date_trunc("hour", "status_time")).count() == 0
    assert {r.job_id: r.status for r in J.latest_status(events).collect()} == {"a": "COMPLETED", "b": "COMPLETED", "c": "FAILED"}
    assert events.where("reason IS NOT NULL").count() == 1
    times = [r.status_time for r in events.where("job_id = 'a'").orderBy("status_time").collect()]
    assert len(set(times)) == 5
    with pytest.raises(ValueError):
        steps.record(files, "SLEEPING")
