"""An index of four structures, and the rules around it."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ratelake.operators import insurance_plans as P
from ratelake.operators import toc as T
from ratelake.operators.upsert import read_version, write_version
from ratelake.plans.steps import Steps
from ratelake.plans.toc_import import import_toc
from ratelake.schemas import LISTING, PLANS_TABLE, STRUCTURE
from ratelake.sources import documents, shred
from ratelake.sources import files as D
from ratelake.sources import shred as X
from ratelake.sources.files import list_files

EMPTY = "empty_allowed-amounts.json"


def plan(name, kind, plan_id, market="group"):
    row = {"plan_name": name, "plan_id_type": kind, "plan_market_type": market}
    return row if plan_id is None else {**row, "plan_id": plan_id}


INDEX = {
    "reporting_entity_name": "x",
    "reporting_structure": [
        {
            "reporting_plans": [plan("A", "ein", "11"), plan("B", "ein", None)],
            "in_network_files": [
                {"description": "d", "location": "https://h/f0.json.gz?s=1"},
                {"location": "https://h/f1.json.gz?s=1"},
            ],
        },
        {
            "reporting_plans": [plan("B", "hios", "22", "individual"), plan("A", "ein", "99")],
            "in_network_files": [{"location": "https://h/f0.json.gz?s=2"}],
            "allowed_amount_file": {"location": "https://h/aa.json?s=1"},
        },
        {"reporting_plans": [plan("C", "ein", "")], "in_network_files": [{"location": "https://h/f2.zip"}]},
        {
            "reporting_plans": [plan("D", "ein", "44")],
            "in_network_files": [{"location": "https://h/f3.json"}],
            "allowed_amount_file": {"location": f"https://h/x/{EMPTY}"},
        },
    ],
}


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("toc")
    (folder / "index.json").write_text(json.dumps(INDEX))
    return documents.structures(spark, str(folder))


def run(spark, index, table, when, **more):
    job = F.lit("ins_job_1")
    return import_toc(index, table, F.lit("ins_1"), F.lit("iss_1"), job, when, placeholder=EMPTY, **more)


@pytest.fixture(scope="module")
def imported(spark, index):
    return run(spark, index, read_version(spark, "", 0, PLANS_TABLE), datetime(2024, 1, 1))


def names(done):
    return {r.insurance_plan_id: f"{r.plan_name}/{r.plan_id}" for r in done.plans.collect()}


def file_plans(done):
    known = names(done)
    return {r.location: (r.url, r.file_type, r.file_extension, {known[p] for p in r.reporting_plans}) for r in done.file_plans.collect()}


def test_first_plan_of_a_name_wins(imported):
    assert {(r.plan_name, r.plan_id) for r in imported.good_plans.collect()} == {("A", "11"), ("B", "22"), ("D", "44")}


def test_backfill_takes_all_fields(imported):
    rows = {(r.rs_pos, r.plan_pos): r for r in imported.plans.collect()}
    filled = rows[(0, 1)]
    assert (filled.plan_id_type, filled.plan_id, filled.plan_market_type) == ("HIOS", "22", "INDIVIDUAL")
    assert (2, 0) not in rows and (3, 0) not in rows


def test_files_and_their_plans(imported):
    assert file_plans(imported) == {
        "https://h/f0.json.gz": ("https://h/f0.json.gz?s=1", "in_network", "GZ", {"A/11", "A/99", "B/22"}),
        "https://h/f1.json.gz": ("https://h/f1.json.gz?s=1", "in_network", "GZ", {"A/11", "B/22"}),
        "https://h/aa.json": ("https://h/aa.json?s=1", "allowed_amount", "JSON", {"A/99", "B/22"}),
        "https://h/f2.zip": ("https://h/f2.zip", "in_network", "ZIP", set()),
    }


def test_file_scope_keeps_the_structure(spark, index):
    done = run(spark, index, read_version(spark, "", 0, PLANS_TABLE), datetime(2024, 1, 1), scope="file")
    files = file_plans(done)
    assert files["https://h/f3.json"][3] == {"D/44"}
    assert not [location for location in files if EMPTY in location]


def test_staging_changes_nothing(spark, index, imported, tmp_path):
    done = run(spark, index, read_version(spark, "", 0, PLANS_TABLE), datetime(2024, 1, 1), staging=str(tmp_path))
    assert file_plans(done) == file_plans(imported)


def test_order_of_rows_does_not_matter(spark, index, imported):
    shuffled = index.repartition(5, F.rand(3)).sortWithinPartitions(F.desc("rs_pos"))
    done = run(spark, shuffled, read_version(spark, "", 0, PLANS_TABLE), datetime(2024, 1, 1))
    assert file_plans(done) == file_plans(imported)


def test_plan_table_twice_is_once(spark, index, imported, tmp_path):
    table = str(tmp_path / "plans")
    write_version(imported.plan_table, table, 1)
    again = run(spark, index, read_version(spark, table, 1, PLANS_TABLE), datetime(2024, 2, 1))
    write_version(again.plan_table, table, 2)
    first = {r.insurance_plan_hash: r for r in read_version(spark, table, 1, PLANS_TABLE).collect()}
    second = {r.insurance_plan_hash: r for r in read_version(spark, table, 2, PLANS_TABLE).collect()}
    assert len(first) == 3 and first.keys() == second.keys()
    for key, row in second.items():
        assert row.plan_first_seen == first[key].plan_first_seen == datetime(2024, 1, 1)
        assert row.plan_last_seen == datetime(2024, 2, 1)
        assert row.id == first[key].id


def test_known_new_and_ids(spark, imported):
    rows = P.plan_rows(imported.plans, datetime(2024, 1, 1))
    table = rows.where("plan_name = 'A'")
    assert P.known_plans(rows, table).count() == 2
    assert [r.plan_name for r in P.new_plans(rows, table).collect()] == ["B"]
    assert sorted(r.id for r in P.plan_ids(rows, table).collect()) == sorted(r.id for r in rows.collect())


def test_activity(imported):
    table = P.with_activity(imported.plan_table, datetime(2024, 3, 1), 30)
    assert not any(r.plan_active for r in table.collect())


def test_messages(imported):
    rows = {json.loads(r.value)["payload"]["url"]: r for r in imported.messages.collect()}
    jobs = {r.file_url: r.id for r in imported.jobs.collect()}
    message = json.loads(rows["https://h/f1.json.gz?s=1"].value)
    assert message["id"] == jobs["https://h/f1.json.gz?s=1"] and message["topic"] == "in-network-file"
    assert message["payload"]["insuranceCompanyId"] == "ins_1" and len(message["payload"]["reportingPlans"]) == 2
    assert "part" not in message["payload"]
    assert rows["https://h/aa.json?s=1"].topic == "allowed-amount"
    assert json.loads(rows["https://h/f2.zip"].value)["payload"]["reportingPlans"] == []


def test_long_plan_lists_go_out_in_parts(spark, index, imported):
    done = run(spark, index, read_version(spark, "", 0, PLANS_TABLE), datetime(2024, 1, 1), part_size=2)
    parts = [r for r in done.file_plans.collect() if r.location == "https://h/f0.json.gz"]
    assert sorted((r.part, len(r.reporting_plans)) for r in parts) == [(0, 2), (1, 1)]
    whole = [p for r in sorted(parts, key=lambda r: r.part) for p in r.reporting_plans]
    assert whole == sorted(whole) and len(set(whole)) == 3
    marked = [json.loads(r.value)["payload"].get("part") for r in done.messages.where("part > 0").collect()]
    assert marked == [1]


def test_shredded_index_is_the_same(spark, index, tmp_path):
    """Whole structures as they are; with blocks far smaller than a structure, its plans and files by place."""
    (tmp_path / "index.json").write_text(json.dumps(INDEX))
    picked = ["rs_pos", "reporting_plans", "in_network_files", "allowed_amount_file"]
    key = lambda r: r.rs_pos
    whole = read_index(spark, tmp_path)
    assert sorted(whole.select(*picked).collect(), key=key) == sorted(index.select(*picked).collect(), key=key)
    parts = read_index(spark, tmp_path, block_bytes=100)
    for f in (T.flatten_plans, T.flatten_files):
        rows, want = (sorted(map(str, f(df).drop("file_id").collect())) for df in (parts, index))
        assert rows == want


def test_lots(spark):
    jobs = spark.range(0, 1050).select(
        F.lit("p").alias("parent_job_id"),
        F.when(F.col("id") % 3 == 0, "ALLOWED_AMOUNT").otherwise("IN_NETWORK").alias("file_type"),
        F.col("id").alias("rs_pos"),
        F.lit(0).alias("file_pos"),
    )
    lots = T.with_lots(jobs, bucket_width=64).groupBy("file_type", "lot").agg(F.count("*").alias("n"), F.min("rs_pos").alias("p"))
    rows = sorted((r.file_type, r.lot, r.n) for r in lots.collect())
    assert rows == [("ALLOWED_AMOUNT", i, 100 if i < 3 else 50) for i in range(4)] + [("IN_NETWORK", i, 100) for i in range(7)]


def test_listings(spark, tmp_path):
    one = {"files": [{"url": "https://h/i.json"}]}
    docs = {"none": {"mrfs": []}, "one": {"mrfs": [one]}, "two": {"mrfs": [one, one]},
            "files": {"mrfs": [{"files": [{"url": "a"}, {"url": "b"}]}]}, "absent": {}}
    for name, doc in docs.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(doc))
    rows = T.gate_listings(documents.listings(spark, str(tmp_path))).collect()
    found = {r.file_id.rsplit("/", 1)[1][:-5]: (r.reason, r.index_url) for r in rows}
    assert found == {
        "none": ("no mrf", None),
        "absent": ("no mrf", None),
        "one": (None, "https://h/i.json"),
        "two": ("more than one mrf", None),
        "files": ("not exactly one file", None),
    }
    assert LISTING.startswith("mrfs")


def document(*structures):
    return json.dumps({"reporting_entity_name": "x", "reporting_structure": list(structures)})


def read_index(spark, folder, **sizes):
    raw = X.shred(D.list_files(spark, str(folder)), ["reporting_structure"], **sizes)
    return documents.shredded_structures(X.good(X.parse(raw, "reporting_structure", STRUCTURE)))


def test_an_import_writes_its_states_and_fails_without_a_good_plan(spark, tmp_path):
    """The states of each index as they happen; one whose plans all lack an id ends as FAILED."""
    plan = lambda i: {"plan_name": f"p{i}", "plan_id_type": "ein", "plan_id": i, "plan_market_type": "group"}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "good.json").write_text(document({"reporting_plans": [plan("1")], "in_network_files": [{"location": "https://h/a"}]}))
    (tmp_path / "in" / "poor.json").write_text(document({"reporting_plans": [plan(None), plan("")], "in_network_files": [{"location": "https://h/b"}]}))
    steps = Steps(str(tmp_path / "events"))
    job = F.regexp_extract("file_id", "([a-z]+)[.]json", 1)
    none = spark.createDataFrame([], PLANS_TABLE)
    import_toc(
        read_index(spark, tmp_path / "in"), none, F.lit("c"), F.lit("s"), job, datetime(2024, 1, 1),
        staging=str(tmp_path / "staging"), steps=steps,
    )
    found = sorted((r.job_id, r.status, r.reason) for r in steps.events(spark).collect())
    assert found == [
        ("good", "COMPLETED", None), ("good", "PARSING", None), ("poor", "FAILED", "no plan with an id"), ("poor", "PARSING", None),
    ]


def test_a_bad_listing_fails_its_job(spark, tmp_path):
    (tmp_path / "bad.json").write_text("{no")
    (tmp_path / "two.json").write_text(json.dumps({"mrfs": [{}, {}]}))
    steps = Steps(str(tmp_path.parent / "listing-events"))
    gated = T.gate_listings(documents.listings(spark, str(tmp_path)))
    steps.record(T.failed_listings(gated, F.regexp_extract("file_id", "([a-z]+)[.]json", 1)), "FAILED")
    found = {r.job_id: (r.status, r.reason) for r in steps.events(spark).collect()}
    assert found == {"bad": ("FAILED", "not a listing"), "two": ("FAILED", "more than one mrf")}


def test_a_giant_structure_in_parts_is_the_structure(spark, tmp_path):
    """Plans and files of one structure many blocks long: the same plans, files, places and pairs as read whole."""
    plans = [{"plan_name": f"p{i % 40}", "plan_id_type": "ein", "plan_id": str(i) if i % 3 else None} for i in range(120)]
    files = [{"location": f"https://h/f{i}.json"} for i in range(90)]
    giant = {"reporting_plans": plans, "allowed_amount_file": {"location": "https://h/aa.json"}, "in_network_files": files}
    (tmp_path / "toc.json").write_text(document({"reporting_plans": plans[:2]}, giant))
    whole, parts = read_index(spark, tmp_path), read_index(spark, tmp_path, block_bytes=1500, part_bytes=700)
    assert whole.count() == 2 and parts.count() > 6
    for f in (T.flatten_plans, T.flatten_files):
        assert sorted(map(str, f(parts).collect())) == sorted(map(str, f(whole).collect()))
