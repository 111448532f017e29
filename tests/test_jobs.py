"""Job states, counters, checks, lists, and the operators that split large keys."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ratelake.functions.files import file_extension, file_type
from ratelake.functions.text import bare_topic, encode, to_date
from ratelake.functions.urls import url_extension, without_query
from ratelake.operators import jobs as J
from ratelake.operators import listing as L
from ratelake.operators.checks import split_by_enums
from ratelake.operators.spread import follow_over, gather_in_parts, rank_over

START = datetime(2024, 1, 1)


def events(spark, *statuses, job="j"):
    rows = [(i, job, s, START + timedelta(minutes=i)) for i, s in enumerate(statuses)]
    return spark.createDataFrame(rows, "event_id int, job_id string, status string, status_time timestamp")


@pytest.mark.parametrize(
    "statuses, status, attempt",
    [
        (["PENDING", "DOWNLOADING", "FAILED", "COMPLETED"], "FAILED", 1),
        (["PENDING", "DOWNLOADING", "FAILED", "COMPLETED", "PENDING"], "PENDING", 2),
        (["PENDING", "FAILED", "PENDING", "PARSING", "COMPLETED"], "COMPLETED", 2),
        (["DOWNLOADING", "FAILED", "COMPLETED"], "FAILED", 0),
    ],
)
def test_latest_status(spark, statuses, status, attempt):
    row = J.latest_status(events(spark, *statuses)).first()
    assert (row.status, row.attempt) == (status, attempt)


def test_illegal_moves_and_durations(spark):
    rows = events(spark, "PENDING", "DOWNLOADING", "PARSING", "PENDING", "COMPLETED")
    bucket = F.date_trunc("minute", "status_time")
    assert sorted((r.status, r.next_status) for r in J.illegal_moves(rows, bucket).collect()) == [
        ("PARSING", "PENDING"),
        ("PENDING", "COMPLETED"),
    ]
    spent = {r.status: (r.n_entered, r.n_left, r.spent_micros) for r in J.step_durations(rows, bucket).collect()}
    assert spent["PENDING"] == (2, 2, 120_000_000) and spent["COMPLETED"] == (1, 0, None)


def test_counters_and_throughput(spark):
    files = spark.createDataFrame([("a", "X", 1), ("a", "X", 2), ("a", "Y", 4), ("b", "X", 8)], "job_id string, file_type string, file_size bigint")
    rows = {(r.job_id, r.file_type): (r.n_bytes, r.n_files) for r in J.counters(files).collect()}
    assert rows[("a", "X")] == (3, 2) and rows[("a", None)] == (7, 3) and rows[(None, None)] == (15, 4)
    runs = events(spark, "PENDING", "PARSING").select("job_id", F.col("status_time").alias("at"), F.lit(30).alias("n_objects"))
    assert J.throughput(runs).first().objects_per_second == 1.0


def test_parsed_is_saved_plus_errors(spark):
    rows = spark.createDataFrame([("f", False, 2, 3), ("f", True, None, None), ("f", False, 1, 0)], "file_id string, bad boolean, n_rates int, n_providers int")
    row = J.parse_metrics(rows).first()
    assert row.objects_parsed == row.objects_saved + row.objects_with_errors == 3
    assert (row.rates_saved, row.providers_named) == (3, 3)


def test_company_without_sources_stays(spark):
    companies = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    sources = spark.createDataFrame([(7, "s", 1), (8, "t", 1)], "id int, name string, company_id int")
    rows = sorted((r.company_id, r.source_id or 0) for r in J.company_sources(companies, sources).collect())
    assert rows == [(1, 7), (1, 8), (2, 0)]


def test_triggers(spark):
    rows = [
        ("r1", START, "s1", "CIGNA_INDEX_API", "c", '{"cigna_page_url":"https://h"}'),
        ("r1", START + timedelta(1), "s1", "CIGNA_INDEX_API", "c", '{"cigna_page_url":"https://h"}'),
        ("r2", START, "s2", "MANUAL", "c", "{}"),
        ("r3", START, "s3", "CIGNA_INDEX_API", "c", None),
        ("r4", START, "s4", "CIGNA_INDEX_API", "c", '{"cigna_page_url":"https://h", '),
        ("r5", START, "s5", "CIGNA_INDEX_API", "c", '{"cigna_page_url":"https://h","depth":2,"only":["a"]}'),
    ]
    requests = spark.createDataFrame(rows, "request_id string, requested_at timestamp, source_id string, source_type string, company_id string, options string")
    started, rejected = J.trigger_jobs(requests)
    assert sorted((r.source_id, r.status_time) for r in started.collect()) == [("s1", START), ("s5", START)]
    assert sorted((r.request_id, r.reason) for r in rejected.collect()) == [
        ("r2", "source type not handled"), ("r3", "listing url missing"), ("r4", "listing url missing")
    ]
    message = started.where("source_id = 's5'").first()["message"]
    assert json.loads(message)["payload"]["options"] == {"cigna_page_url": "https://h", "depth": 2, "only": ["a"]}


def test_enums(spark):
    rows = spark.createDataFrame([("PENDING",), ("RUNNING",), (None,)], "status string")
    valid, wrong = split_by_enums(rows, {"status": ("PENDING",)})
    assert valid.count() == 1 and wrong.count() == 2


def test_pages(spark):
    rows = spark.createDataFrame([(i, f"Name {i % 7}", (i * 7) % 5) for i in range(40)], "id int, name string, v int")
    whole = [(r.v, r.id) for r in L.matching(rows, "name", "nAME").orderBy("v", "id").collect()]
    pages = [[(r.v, r.id) for r in L.page(rows, "v", "id", n, 7).collect()] for n in range(6)]
    assert sum(pages, []) == whole
    last, walked = (-1, -1), []
    while behind := [(r.v, r.id) for r in L.page_after(rows, "v", "id", last, 7).collect()]:
        walked += behind
        last = behind[-1]
    assert walked == whole
    counts = L.selection_counts(rows, F.col("v") == 0).first()
    assert (counts.n_selected, counts.n_rows) == (8, 40)


def skewed(spark, rows=3000):
    hot = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 40))
    return spark.range(rows).select(hot.alias("k"), "id", (F.col("id") * 7919 % rows).alias("pos"))


@pytest.mark.parametrize("width", [1, 50, 10_000])
def test_rank_over_equals_window(spark, width):
    df = skewed(spark)
    got = rank_over(df, ["k"], [F.col("pos")], F.floor(F.col("pos") / width), "r")
    want = df.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy("pos")))
    assert got.select("id", "r").exceptAll(want.select("id", "r").withColumn("r", F.col("r").cast("bigint"))).count() == 0
    assert got.count() == df.count()


@pytest.mark.parametrize("width", [1, 50, 10_000])
def test_follow_over_equals_window(spark, width):
    df = skewed(spark).withColumn("v", F.when(F.col("id") % 5 > 0, F.col("id")))
    got = follow_over(df, ["k"], ["pos"], ["v", "pos"], F.floor(F.col("pos") / width))
    w = Window.partitionBy("k").orderBy("pos")
    want = df.withColumn("next_v", F.lead("v").over(w)).withColumn("next_pos", F.lead("pos").over(w))
    columns = ["k", "id", "next_v", "next_pos"]
    assert sorted(map(str, got.select(*columns).collect())) == sorted(map(str, want.select(*columns).collect()))


def test_gather_in_parts_is_whole_and_bounded(spark):
    df = skewed(spark).select("k", F.sha2(F.col("id").cast("string"), 256).alias("v"))
    rows = gather_in_parts(df.unionByName(df.limit(50)), ["k"], "v", F.substring("v", 1, 2), 64, "vs").collect()
    assert max(len(r.vs) for r in rows) == 64
    assert all(r.n_parts == sum(o.k == r.k for o in rows) for r in rows)
    got = {}
    for r in sorted(rows, key=lambda r: (r.k, r.part)):
        got.setdefault(r.k, []).extend(r.vs)
    want = {}
    for r in df.collect():
        want.setdefault(r.k, []).append(r.v)
    assert got == {k: sorted(v) for k, v in want.items()}


def test_names_and_urls(spark):
    names = ["2025_in-network-rates.json", "a.Allowed-Amounts.json", "x", "in-network.allowed-amount.GZ", "x.zip"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    n = F.col("n")
    rows = df.select(file_type(n), file_extension(n), file_extension(n, "first")).collect()
    assert [tuple(r) for r in rows] == [
        ("IN_NETWORK", "JSON", "JSON"),
        ("ALLOWED_AMOUNT", "JSON", "UNKNOWN"),
        ("UNKNOWN", "UNKNOWN", "UNKNOWN"),
        ("IN_NETWORK", "GZ", "UNKNOWN"),
        ("UNKNOWN", "ZIP", "UNKNOWN"),
    ]
    urls = ["https://h/a.json.GZ?x=.zip", "https://h/a.gzip", "https://h.zip/a", "not a url", "https://h/a.json#f.zip"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    rows = df.select(without_query(F.col("u")), url_extension(F.col("u"))).collect()
    assert [r[1] for r in rows] == ["GZ", "GZ", "UNKNOWN", "UNKNOWN", "JSON"]
    assert rows[0][0] == "https://h/a.json.GZ"


def test_text(spark):
    row = spark.range(1).select(
        bare_topic(F.lit("dev.in-network-file"), "dev.").alias("a"),
        bare_topic(F.lit("x"), "dev.").alias("b"),
        to_date(F.lit("never")).alias("c"),
        encode(F.lit("Both"), {"both": 3}).alias("d"),
    ).first()
    assert tuple(row) == ("in-network-file", "x", None, 3)


def test_rows_are_stored_once(spark, tmp_path):
    from ratelake.sinks.tables import dump_json, once_table

    table = once_table(str(tmp_path / "jobs"), "id STRING, n INT")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "id string, n int")
    table.upsert(rows)
    table.upsert(rows.unionByName(spark.createDataFrame([("c", 3)], "id string, n int")))
    assert sorted(map(tuple, table.read(spark).collect())) == [("a", 1), ("b", 2), ("c", 3)]
    dump_json(rows, str(tmp_path / "dump"))
    assert spark.read.json(str(tmp_path / "dump")).count() == 2


@pytest.mark.parametrize("number", [0, 3, 49, 50, 51, 1000])
def test_a_deep_page_reads_the_files_it_lies_in(spark, tmp_path, number):
    df = spark.range(503).select("id", F.when(F.col("id") % 7 > 0, F.col("id") % 50).alias("v"))
    for ascending in (True, False):
        folder = str(tmp_path / f"{number}{ascending}")
        L.write_pages(df, "v", "id", folder, ascending, files=12)
        got = L.deep_page(spark, folder, "v", "id", number, ascending=ascending)
        assert got.collect() == L.page(df, "v", "id", number, ascending=ascending).collect()
        assert len(got.inputFiles()) <= 2


def test_step_rows(spark):
    rows = events(spark, "PENDING", "DOWNLOADING", "DECOMPRESSING", "PARSING", "FAILED", "PENDING", "DOWNLOADING")
    steps = J.step_rows(rows, F.date_trunc("minute", "status_time")).orderBy("sequence_order").collect()
    assert [(r.sequence_order, r.type, r.status) for r in steps] == [
        (1, "DOWNLOAD", "COMPLETED"),
        (2, "DECOMPRESS", "COMPLETED"),
        (3, "PARSE", "FAILED"),
        (4, "DOWNLOAD", "IN_PROGRESS"),
    ]
