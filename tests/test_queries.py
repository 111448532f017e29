"""Every query against its SQL twin at the smallest scale, and plan shapes that must hold."""

import re
from types import SimpleNamespace

import duckdb
import pytest

import __spark_entry__ as entry_module
from ratelake import session
from ratelake.plans.oracle import ORACLE
from ratelake.plans.queries import QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents pages".split()
# Sorts and global aggregates end in one partition by nature.
SINGLE = {"list_page", "list_page_after", "list_page_deep", "list_counts", "lookup_first"}


@pytest.fixture(scope="module")
def sql(small):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    return con


def plain(rows):
    return sorted(tuple(repr(v) if isinstance(v, float) else str(v) for v in row) for row in rows)


def test_every_query_has_a_twin():
    assert set(ORACLE) == set(QUERIES)
    assert set(ORACLE) <= set(entry_module.oracle_sql()) and set(QUERIES) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sql, small, name):
    df = entry_module.queries()[name](spark, small)
    columns = sorted(df.columns)
    got = plain(df.select(*columns).collect())
    found = sql.execute(entry_module.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == plain(tuple(row[i] for i in order) for row in found.fetchall())
    if name not in SINGLE:
        assert "SinglePartition" not in df._jdf.queryExecution().executedPlan().toString()


WHOLE_KEYS = {"plan_code": "insurance_plan_id", "region": "region_code", "zip": "zip_code"}


@pytest.mark.parametrize("path", WHOLE_KEYS)
def test_a_lookup_returns_every_code_of_its_leading_key(spark, small, path):
    key = WHOLE_KEYS[path]
    fact = entry_module.queries()["provider_rate_fact"](spark, small)
    rows = [row for row in fact.collect() if row[key] is not None]
    smallest = min(row[key] for row in rows)
    want = [row for row in rows if row[key] == smallest]
    got = entry_module.queries()[f"lookup_{path}"](spark, small).select(*fact.columns).collect()
    assert plain(got) == plain(want) and len({row.billing_code_id for row in want}) > 1


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0 and "avg_rate" in df.columns


def plan(spark, small, name):
    return entry_module.queries()[name](spark, small)._jdf.queryExecution().executedPlan().toString()


def test_rate_tables_stay_hash_aggregations(spark, small):
    for name in ("procedure_rate_upsert", "provider_rate_fact", "rate_summary_by_code", "job_counters"):
        assert "SortAggregate" not in plan(spark, small, name)


def test_scans_read_only_what_is_used(spark, small):
    read = re.findall(r"FileScan parquet \[([^\]]*)\]", plan(spark, small, "rate_summary_by_code"))
    assert not any("l_tax" in columns or "l_quantity" in columns for columns in read)


def test_no_query_forces_a_broadcast_or_a_cross_join(spark, small):
    for name in ("provider_rate_fact", "rate_provider_join", "plan_backfill", "job_family"):
        assert "CartesianProduct" not in plan(spark, small, name)
        assert "BroadcastNestedLoopJoin" not in plan(spark, small, name)


class Session:
    """A session with the given settings, as far as the shared folder needs one."""

    def __init__(self, master, **conf):
        self.sparkContext = SimpleNamespace(master=master)
        self.conf = SimpleNamespace(get=lambda key, default: conf.get(key, default))


def test_shared_folder_comes_from_the_session():
    named = Session("yarn", **{"spark.checkpoint.dir": "hdfs://shared/"})
    assert session.run_dir(named, "x").startswith("hdfs://shared/x-")
    assert session.shared_dir(Session("local[2]")) == session.shared_dir(Session("local[2]"))
    with pytest.raises(ValueError):
        session.shared_dir(Session("yarn"))
