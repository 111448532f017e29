"""Streams give what the batch operators give, also over several triggers."""

import json

import pytest
from pyspark.sql import functions as F

from ratelake.operators import jobs as J
from ratelake.streaming import jobs as M

SCHEMA = "job_id string, file_type string, file_size bigint"


def test_counters_over_two_runs(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    whole = spark.createDataFrame([("a", "X", 1), ("b", "X", 5), ("a", "Y", 2)], SCHEMA)
    for _ in range(2):
        whole.coalesce(1).write.mode("append").parquet(source)
        files = spark.readStream.schema(SCHEMA).parquet(source)
        M.start_counters(files, target, checkpoint, once=True).awaitTermination()
    twice = spark.read.schema(SCHEMA).parquet(source)
    batch = J.counters(twice).where("level = 0").select("job_id", "file_type", "n_bytes", "n_files")
    assert sorted(M.running_counters(spark, target).collect()) == sorted(batch.collect())


def test_routing(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows = [
        ("p.in-network-file", '{"id":"1","payload":{"url":"u"}}'),
        ("p.in-network-file", "{bad"),
        ("p.nothing", '{"id":"2"}'),
        ("p.allowed-amount", '{"payload":"x"}'),
        ("p.allowed-amount", None),
    ]
    spark.createDataFrame(rows, "topic string, value string").write.parquet(source)
    stream = spark.readStream.schema("topic string, value string").parquet(source)
    M.start_routing(stream, target, checkpoint, "p.", once=True).awaitTermination()
    found = spark.read.parquet(target).collect()
    assert sorted((r.topic, r.reason or "") for r in found) == [
        ("allowed-amount", "no job id"),
        ("allowed-amount", "not a message"),
        ("in-network-file", ""),
        ("in-network-file", "not a message"),
        ("nothing", "unknown topic"),
    ]
    ok = [r for r in found if r.reason is None]
    assert [(r.job_id, json.loads(r.payload)) for r in ok] == [("1", {"url": "u"})]


def test_rate_files_as_they_land(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "state")

    def land(name, *codes):
        item = lambda c: {"billing_code": c, "negotiated_rates": [{"negotiated_prices": [{"negotiated_rate": 1}], "provider_references": [1]}]}
        (landing / name).write_text(json.dumps({"in_network": [item(c) for c in codes] + [{"billing_code": 1, "negotiated_rates": 3}]}))
        M.start_rate_files(M.landed_files(spark, str(landing)), target, checkpoint, 64, once=True).awaitTermination()

    land("a.json", "1", "2")
    land("b.json", "3")
    rows = spark.read.parquet(f"{target}/messages").select(F.col("procedure.billing_code").alias("c")).collect()
    assert sorted(r.c for r in rows) == ["1", "2", "3"]
    assert spark.read.parquet(f"{target}/rejects").count() == 2
    assert spark.read.parquet(f"{target}/references").count() == 0
    assert spark.read.parquet(f"{target}/headers").count() == 2


def test_first_requests(spark, tmp_path):
    """Repeats go, in a batch and between batches; a new request far older than the newest stays; NULL keys are equal."""
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    batches = [[("r1", "2024-06-01"), ("r1", "2024-06-01"), (None, "2024-06-01")], [("r1", "2024-06-02"), ("old", "2023-01-01"), (None, "2024-06-02")]]
    for rows in batches:
        df = spark.createDataFrame(rows, "request_id string, at string")
        df.write.mode("append").parquet(source)
        stream = spark.readStream.schema(df.schema).parquet(source)
        M.start_first_requests(stream, ["request_id"], target, checkpoint, once=True).awaitTermination()
    assert sorted(str(r.request_id) for r in spark.read.parquet(target).collect()) == ["None", "old", "r1"]


def test_tables_of_part_files_stream(spark, small, tmp_path):
    """A table is a folder of part files as well as one file, and batches may be as small as one file."""
    events = spark.read.parquet(f"{small}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    for n, (folder, bound) in enumerate([(small, {"files_per_trigger": 1}), (str(tmp_path), {"files_per_trigger": 1}), (str(tmp_path), {"bytes_per_trigger": 1})]):
        target, checkpoint = str(tmp_path / f"t{n}"), str(tmp_path / f"c{n}")
        rows = M.table_stream(spark, folder, "events", **bound).select("user_id", "event_type")
        M.start_first_requests(rows, ["user_id", "event_type"], target, checkpoint, once=True).awaitTermination()
        assert spark.read.parquet(target).count() == events.select("user_id", "event_type").distinct().count()


def test_consumed_messages_open_attempts(spark):
    rows = [("allowed-amount", '{"id":"1"}', 1), ("allowed-amount", '{"id":"1"}', 2), ("other", '{"id":"3"}', 3)]
    messages = spark.createDataFrame(rows, "topic string, value string, at int").withColumn("at", F.timestamp_seconds("at"))
    status = J.latest_status(M.opened_attempts(M.routed(messages))).collect()
    assert [(r.job_id, r.status, r.attempt) for r in status] == [("1", "PENDING", 2)]


@pytest.mark.parametrize("cuts", [[], [3], [1, 2, 3, 4, 5, 6, 7], [6]])
def test_streams_equal_the_batch_at_any_split(spark, tmp_path, cuts):
    """Counters, states and first requests over batches in any order and cut; each batch reads its own rows only."""
    kinds = ["PENDING", "DOWNLOADING", "FAILED", "PENDING", "PARSING", "COMPLETED", "PENDING", "FAILED"]
    rows = [(f"e{i}", f"j{i % 3}" if i else None, kinds[i], 100 * (i * 5 % 8), i) for i in range(8)]
    df = spark.createDataFrame(rows, "event_id string, job_id string, status string, at bigint, file_size bigint")
    df = df.withColumns({"status_time": F.timestamp_seconds("at"), "file_type": F.col("status")}).drop("at")
    source, schema = str(tmp_path / "in"), df.schema
    edges = [0, *cuts, 8]
    for low, high in zip(edges, edges[1:], strict=False):
        ids = [f"e{i}" for i in range(low, high)]
        df.where(F.col("event_id").isin(ids)).coalesce(1).write.mode("append").parquet(source)
        stream = lambda: spark.readStream.schema(schema).parquet(source)
        M.start_counters(stream(), str(tmp_path / "counters"), str(tmp_path / "c1"), once=True).awaitTermination()
        M.start_states(stream(), str(tmp_path / "states"), str(tmp_path / "c2"), once=True).awaitTermination()
        M.start_first_requests(stream(), ["job_id", "status"], str(tmp_path / "first"), str(tmp_path / "c3"), once=True).awaitTermination()
    want = df.groupBy("job_id", "file_type").agg(F.sum("file_size").alias("n_bytes"), F.count(F.lit(1)).alias("n_files"))
    assert sorted(map(str, M.running_counters(spark, str(tmp_path / "counters")).collect())) == sorted(map(str, want.collect()))
    states = M.running_states(spark, str(tmp_path / "states"))
    assert sorted(map(str, states.collect())) == sorted(map(str, J.latest_status(df).select(states.columns).collect()))
    assert spark.read.parquet(str(tmp_path / "first")).count() == df.select("job_id", "status").distinct().count()


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    table = M.running_table(str(tmp_path / "t"), M.COUNTERS, ["job_id", "file_type"])
    totals = spark.createDataFrame([("a", "X", 5, 1), (None, "X", 2, 1)], M.COUNTERS)
    for _ in range(2):
        table.upsert(totals)
    table.upsert(spark.createDataFrame([("a", "X", 9, 2)], M.COUNTERS))
    assert sorted(map(str, table.read(spark).collect())) == sorted(
        map(str, spark.createDataFrame([("a", "X", 9, 2), (None, "X", 2, 1)], M.COUNTERS).collect())
    )
