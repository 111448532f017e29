"""The queries on the given tables, by name. Each takes (spark, folder) and reads its tables whole."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake import schemas as S
from ratelake import session
from ratelake import values as V
from ratelake.functions import keys as K
from ratelake.functions.files import file_extension, file_type
from ratelake.functions.text import day_text
from ratelake.functions.urls import url_extension, without_query
from ratelake.operators import insurance_plans as P
from ratelake.operators import jobs as J
from ratelake.operators import listing as L
from ratelake.operators import providers as G
from ratelake.operators import rates as R
from ratelake.operators import serving as A
from ratelake.operators import toc as T
from ratelake.operators.checks import split_by_enums
from ratelake.plans import standins as I
from ratelake.plans.rate_ingest import dimension_table as stored_dimension
from ratelake.plans.rate_ingest import fact_table as stored_fact
from ratelake.plans.rate_ingest import Bronze, land_bronze, upsert_dimension, upsert_fact
from ratelake.plans.steps import Steps
from ratelake.plans.toc_import import TocImport, import_toc
from ratelake.sinks.merged import MergedTable
from ratelake.sinks.tables import dump_json, once_table
from ratelake.sources import files as D
from ratelake.sources import shred as X
from ratelake.sources.documents import shredded_structures
from ratelake.sources.tables import table
from ratelake.streaming import jobs as M

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
RUN_TS = datetime(2002, 1, 1)
#: Ranges of the key a layout is written in: its exchange holds one of them beside the fact and the layout.
LAYOUT_STEPS = 4


def query(build: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(session.tune(spark), folder)

    QUERIES[build.__name__] = run
    return run


def moment(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(column)


def day(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd").alias(column)


def number(column: str) -> Column:
    return F.col(column).cast("double").alias(column)


# --- index: plans ------------------------------------------------------------------------


def resolved(spark: SparkSession, folder: str) -> DataFrame:
    plans = T.flatten_plans(I.structures(spark, folder))
    return T.backfill_plans(plans, T.first_plans(plans))


def incoming_plans(spark: SparkSession, folder: str) -> DataFrame:
    return P.plan_rows(P.normalize_plans(resolved(spark, folder), F.lit(I.COMPANY)), RUN_TS)


@query
def toc_good_plans(spark, folder):
    return T.first_plans(T.flatten_plans(I.structures(spark, folder)))


@query
def toc_from_files(spark, folder):
    """Good plans of index files as they lie landed, one a month."""
    landing = session.run_dir(spark, "indexes")
    I.write_index_files(spark, folder, landing)
    raw = X.shred(D.list_files(spark, landing, "part-*"), ["reporting_structure"])
    structures = shredded_structures(X.good(X.parse(raw, "reporting_structure", S.STRUCTURE)))
    return T.first_plans(T.flatten_plans(structures)).select(
        F.regexp_extract("file_id", "document=([-0-9]+)", 1).alias("month"), *T.PLAN_FIELDS
    )


@query
def good_plans_dump(spark, folder):
    """The good plans dumped as one JSON object a line, and read back."""
    good, target = T.first_plans(T.flatten_plans(I.structures(spark, folder))), session.run_dir(spark, "dump")
    dump_json(good, target)
    return spark.read.schema(good.schema).json(target)


@query
def toc_first_rank(spark, folder):
    plans = session.staged(T.flatten_plans(I.structures(spark, folder)), session.run_dir(spark, "plans"))
    ranked = T.rank_plans(plans)
    return ranked.select("file_id", "plan_name", "plan_id", "rs_pos", "plan_pos", "name_rank")


@query
def toc_plan_count(spark, folder):
    good = T.first_plans(T.flatten_plans(I.structures(spark, folder)))
    return good.groupBy("file_id").agg(F.count(F.lit(1)).alias("n_plans"))


@query
def plan_backfill(spark, folder):
    return resolved(spark, folder)


@query
def plan_normalize(spark, folder):
    plans = P.normalize_plans(T.flatten_plans(I.structures(spark, folder)), F.lit(I.COMPANY))
    return plans.select("rs_pos", "plan_pos", "plan_name", "plan_id", "plan_id_type", "plan_market_type")


@query
def plan_hash(spark, folder):
    return P.normalize_plans(resolved(spark, folder), F.lit(I.COMPANY)).select(
        "rs_pos", "plan_pos", "insurance_plan_hash", "insurance_plan_id"
    )


@query
def plan_known(spark, folder):
    rows = P.known_plans(incoming_plans(spark, folder), I.plan_table(spark, folder))
    return rows.select("id", "plan_name", "plan_id", "insurance_plan_hash")


@query
def plan_new(spark, folder):
    rows = P.new_plans(incoming_plans(spark, folder), I.plan_table(spark, folder))
    return rows.select("id", "plan_name", "plan_id", "insurance_plan_hash")


@query
def plan_ids_union(spark, folder):
    return P.plan_ids(incoming_plans(spark, folder), I.plan_table(spark, folder))


def shown_plans(rows: DataFrame) -> DataFrame:
    return rows.select(
        "id",
        "plan_name",
        "plan_id_type",
        "plan_id",
        "plan_sponsor_name",
        "plan_market_type",
        moment("plan_first_seen"),
        moment("plan_last_seen"),
        "plan_active",
        "insurance_plan_hash",
    )


@query
def plan_upsert(spark, folder):
    return shown_plans(P.upsert_plans(I.plan_table(spark, folder), incoming_plans(spark, folder)))


@query
def plan_table(spark, folder):
    """The stored plan table behind an earlier run and this one."""
    table_ = P.plans_table(session.run_dir(spark, "plans"), buckets=16)
    table_.upsert(I.plan_table(spark, folder))
    table_.upsert(incoming_plans(spark, folder))
    return shown_plans(table_.read(spark))


# --- index: files and jobs ---------------------------------------------------------------


def imported(spark: SparkSession, folder: str, staging: str | None = None) -> TocImport:
    return import_toc(
        I.structures(spark, folder),
        I.plan_table(spark, folder),
        F.lit(I.COMPANY),
        F.lit(I.SOURCE),
        F.concat(F.lit("ins_job_"), "file_id"),
        RUN_TS,
        placeholder=I.PLACEHOLDER,
        staging=staging,
    )


@query
def toc_file_plans(spark, folder):
    return imported(spark, folder, session.run_dir(spark, "index")).file_plans.select(
        "file_id",
        "location",
        "url",
        "file_type",
        "file_extension",
        "part",
        F.size("reporting_plans").alias("n_plans"),
        F.array_join("reporting_plans", ",").alias("plans"),
    )


@query
def toc_placeholder_skip(spark, folder):
    structures = I.structures(spark, folder)
    scopes = [
        T.flatten_files(structures, I.PLACEHOLDER, scope).select("file_id", "location", F.lit(scope).alias("scope"))
        for scope in ("structure", "file")
    ]
    return (
        scopes[0]
        .unionByName(scopes[1])
        .groupBy("file_id", "location")
        .agg(
            F.count_if(F.col("scope") == "structure").alias("n_listed"),
            F.count_if(F.col("scope") == "file").alias("n_listed_by_file_scope"),
        )
    )


@query
def toc_child_jobs(spark, folder):
    return imported(spark, folder, session.run_dir(spark, "index")).messages.select(
        "id", "source_id", "parent_job_id", "status", "file_url", "file_extension", "file_type", "topic", "part", "value"
    )


@query
def dispatch_batches(spark, folder):
    jobs = session.staged(imported(spark, folder).jobs, session.run_dir(spark, "jobs"))
    return T.with_lots(jobs).select("id", "parent_job_id", "file_type", "rs_pos", "lot")


@query
def dispatch_lots(spark, folder):
    index = imported(spark, folder, session.run_dir(spark, "index"))
    sent = T.dispatched(index.messages, index.lots, ("IN_NETWORK",))
    return sent.groupBy("parent_job_id", "topic", "lot").agg(F.count(F.lit(1)).alias("n_messages"))


@query
def trigger_jobs(spark, folder):
    started, _ = J.trigger_jobs(I.requests(spark, folder))
    return started.select("id", "source_id", "status", "file_type", moment("status_time"), "message")


@query
def trigger_rejects(spark, folder):
    return J.trigger_jobs(I.requests(spark, folder))[1]


@query
def listing_gate(spark, folder):
    texts = I.listings(spark, folder)
    parsed = texts.select("file_id", F.from_json("text", S.LISTING).alias("l")).select("file_id", "l.*")
    return T.gate_listings(parsed).select("file_id", "reason", "index_url")


@query
def listing_events(spark, folder):
    """The FAILED events of the jobs whose listing names no single index file."""
    texts = I.listings(spark, folder)
    gated = T.gate_listings(texts.select("file_id", F.from_json("text", S.LISTING).alias("l")).select("file_id", "l.*"))
    steps = Steps(session.run_dir(spark, "events"), clock=lambda: RUN_TS)
    steps.record(T.failed_listings(gated, F.col("file_id")), "FAILED")
    return steps.events(spark).select("job_id", "status", moment("status_time"), "reason")


@query
def enum_reject(spark, folder):
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    rows = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("job_id"),
        F.when(priority == "5-LOW", "ALLOWED_AMOUNT")
        .when(priority == "1-URGENT", "PHARMACY")
        .otherwise("IN_NETWORK")
        .alias("file_type"),
        F.when(status == "F", "GZ").when(status == "O", "ZIP").alias("file_extension"),
        F.lit("PENDING").alias("status"),
    )
    allowed = {"file_type": V.FILE_TYPES, "file_extension": V.FILE_EXTENSIONS, "status": V.JOB_STATUSES}
    _, wrong = split_by_enums(rows, allowed)
    return wrong.select("job_id", "file_type", "file_extension", F.array_join("enum_errors", ",").alias("enum_errors"))


@query
def file_header(spark, folder):
    return X.headers(I.header_texts(spark, folder))


# --- rates -------------------------------------------------------------------------------


def messages(spark: SparkSession, folder: str, described: bool = False) -> DataFrame:
    return R.rate_messages(I.items(spark, folder, described))


def priced(spark: SparkSession, folder: str, rows: Column | None = None) -> DataFrame:
    """Prices with the day they were seen; the day of a line rides in its items."""
    items = I.items(spark, folder)
    items = items if rows is None else items.where(rows)
    return R.prices(R.rate_messages(items, "seen_date"), "seen_date")


def fact(spark: SparkSession, folder: str, *carried: str) -> DataFrame:
    rows = R.fact(priced(spark, folder), I.file_plans(spark, folder), *carried, numbered=True)
    return R.with_locations(rows, I.locations(spark, folder)).drop(*R.NUMBERED)


def shown(rows: DataFrame) -> DataFrame:
    return rows.withColumns({name: day(name) for name in R.SEEN})


@query
def rate_summary_by_code(spark, folder):
    summary = R.summary_by_code(messages(spark, folder))
    names = table(spark, folder, "part").select(F.col("p_partkey").cast("string").alias("billing_code"), F.col("p_name").alias("name"))
    return summary.join(names, "billing_code", "left").select(
        "billing_code_type",
        "billing_code",
        "name",
        "n_prices",
        "n_rates",
        number("min_rate"),
        number("max_rate"),
        number("sum_rate"),
        "avg_rate",
    )


@query
def rate_messages(spark, folder):
    def price(p):
        return F.concat_ws(
            "|",
            p["negotiated_type"],
            p["negotiated_rate"].cast("string"),
            p["expiration_date"],
            F.array_join(p["service_code"], "/"),
            p["billing_class"],
            p["setting"],
            F.array_join(p["billing_code_modifier"], "/"),
        )

    return messages(spark, folder, described=True).select(
        "file_id",
        "item_no",
        "rate_no",
        "procedure.negotiation_arrangement",
        "procedure.name",
        "procedure.billing_code_type",
        "procedure.billing_code_type_version",
        "procedure.billing_code",
        "procedure.description",
        F.array_join("provider_ids", ",").alias("provider_ids"),
        F.size("negotiated_prices").alias("n_prices"),
        F.array_join(F.transform("negotiated_prices", price), ";").alias("prices"),
    )


@query
def rate_wire(spark, folder):
    wire = R.wire_messages(messages(spark, folder))
    return wire.select(
        "procedure.billing_code",
        F.array_join("provider_ids", ",").alias("provider_ids"),
        F.col("negotiated_prices")[0]["negotiated_rate"].alias("rate_1"),
        F.col("negotiated_prices")[1]["negotiated_rate"].alias("rate_2"),
        F.size(F.col("negotiated_prices")[0]["additional_information"]).alias("n_additional"),
    )


@query
def procedure_rate_upsert(spark, folder):
    seen = F.col("seen_date")
    stored = R.merge(K.pack(R.dimension_rows(priced(spark, folder, F.col("flag") != "R"), F.date_sub(seen, 30))), packed=True)
    return upsert_dimension(stored, priced(spark, folder, F.col("flag") != "A"), seen).select(
        "procedure_hash",
        number("negotiated_rate"),
        day("expiration_date"),
        "billing_code",
        F.array_join(F.col("service_code").cast("array<string>"), ",").alias("service_code"),
        F.col("billing_class").cast("int").alias("billing_class"),
        F.col("setting").cast("int").alias("setting"),
        F.array_join("billing_code_modifier", ",").alias("billing_code_modifier"),
        day("first_seen_date"),
        day("last_seen_date"),
    )


def two_runs(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows by day: what a first run brings, and the last year, which another brings."""
    late = F.col("seen_date") >= F.lit("1998-01-01").cast("date")
    return rows.where(~late), rows.where(late)


@query
def dimension_table(spark, folder):
    """The stored rate dimension behind two runs."""
    table_ = stored_dimension(session.run_dir(spark, "dimension"))
    for rows in two_runs(priced(spark, folder)):
        table_.upsert(R.dimension_rows(rows, F.col("seen_date")))
    return table_.read(spark).select(
        "procedure_hash",
        number("negotiated_rate"),
        "billing_code",
        F.array_join("billing_code_modifier", "|").alias("billing_code_modifier"),
        day("first_seen_date"),
        day("last_seen_date"),
    )


@query
def fact_table(spark, folder):
    """The stored provider fact behind two runs, with today's locations."""
    table_, plans = stored_fact(session.run_dir(spark, "fact")), I.file_plans(spark, folder)
    for rows in two_runs(priced(spark, folder)):
        table_.upsert(R.fact(rows, plans))
    return shown(R.with_locations(table_.read(spark), I.locations(spark, folder)))


@query
def rate_unknown_codes(spark, folder):
    priced_rows = R.prices(messages(spark, folder))
    odd = F.col("price").withField("setting", F.concat_ws("-", "price.setting", "price.billing_class"))
    return R.unknown_codes(priced_rows.withColumn("price", odd))


@query
def provider_rate_fact(spark, folder):
    return shown(fact(spark, folder))


@query
def provider_rate_upsert(spark, folder):
    plans, places = I.file_plans(spark, folder), I.locations(spark, folder)
    earlier = priced(spark, folder, F.col("flag") != "R").withColumn("seen_date", F.date_sub("seen_date", 30))
    stored = R.with_locations(R.fact(earlier, plans, numbered=True), places)
    return shown(upsert_fact(stored, priced(spark, folder, F.col("flag") != "A"), plans, places)).drop(*R.NUMBERED)


@query
def inline_rates(spark, folder):
    """The fact where some rates bring their group's members: equal groups of all files and both forms are one."""
    items = session.staged(I.items(spark, folder, inline=True), session.run_dir(spark, "items"))
    rows = R.fact(R.prices(R.rate_messages(items, "seen_date"), "seen_date"), I.file_plans(spark, folder), numbered=True)
    references, inline = I.file_references(spark, folder), G.inline_references(items)
    same = session.staged(G.identities(references, inline), session.run_dir(spark, "identities"))
    number = K.group_id(F.col("file_id"), F.col("provider_group_id")).alias("group_id")
    npi = F.array_min(F.flatten(F.col("provider_groups.npi")))
    names = references.select(number, npi.alias("first_npi")).join(same, "group_id").groupBy("content_id").agg(F.min("first_npi").alias("first_npi"))
    named = session.staged(same.join(names, "content_id"), session.run_dir(spark, "names"))
    return shown(R.by_content(rows, named, "first_npi", staging=session.run_dir(spark, "contents")).drop("provider_group_id"))


@query
def rate_provider_join(spark, folder):
    references = I.two_reference_files(spark, folder)
    of_two = F.when(F.col("file_id").cast("bigint") % 2 == 0, "even").otherwise("odd")
    return G.join_rates(messages(spark, folder).withColumn("file_id", of_two), references).select(
        "file_id",
        "item_no",
        "procedure.billing_code",
        "provider_group_id",
        "network_name",
        "n_members",
    )


@query
def item_codes(spark, folder):
    return R.item_codes(I.coded_items(spark, folder)).drop("file_id", "item_no")


@query
def procedure_codes(spark, folder):
    types, codes = R.procedure_codes(I.coded_items(spark, folder))
    return codes.join(types.select(F.col("id").alias("type_id"), "type"), "type_id").select(
        "id", "code", "type_id", "type", "description"
    )


@query
def provider_ref_members(spark, folder):
    return G.members(I.references(spark, folder)).drop("file_id", "group_id")


@query
def provider_bridge(spark, folder):
    references = I.two_reference_files(spark, folder)
    pairs, providers = G.bridge(G.members(references))
    number = F.col("provider_group_id")
    groups = references.select(K.group_id(F.col("file_id"), number).alias("group_id"), F.col("network_name").alias("group_name"))
    known = providers.select("npi", K.surrogate_id("provider", F.col("npi")).alias("provider_id"))
    return groups.join(pairs, "group_id").join(known, "npi")


# --- serving -----------------------------------------------------------------------------


@query
def serve_by_plan_code(spark, folder):
    return A.view(fact(spark, folder, "negotiated_rate"), "plan_code").groupBy("insurance_plan_id", "billing_code_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("negotiated_rate").cast("double").alias("min_rate"),
        F.max("negotiated_rate").cast("double").alias("max_rate"),
    )


def served(spark: SparkSession, folder: str, path: str) -> DataFrame:
    summary = A.key_summary(fact(spark, folder), path)
    return summary.select(*A.PATHS[path][0], "n_rows", day("first_seen_date"), day("last_seen_date"))


@query
def serve_by_region(spark, folder):
    return served(spark, folder, "region")


@query
def serve_by_zip(spark, folder):
    return served(spark, folder, "zip")


@query
def serve_by_provider(spark, folder):
    return served(spark, folder, "provider")


@cache
def stored_layout(application: str, spark: SparkSession, folder: str, path: str) -> str:
    """A path's layout of the fact, written once a session and used by every lookup behind it."""
    target = session.run_dir(spark, f"layout-{path}")
    A.write_layout(stored_rows(application, spark, folder), path, target, steps=LAYOUT_STEPS)
    return target


@cache
def stored_rows(application: str, spark: SparkSession, folder: str) -> DataFrame:
    """The fact as a written table, once a session."""
    return session.staged(fact(spark, folder), session.run_dir(spark, "fact"))


@cache
def stored_rates(application: str, spark: SparkSession, folder: str) -> MergedTable:
    """The rate dimension as a written table, once a session."""
    dimension = stored_dimension(session.run_dir(spark, "dimension"))
    dimension.upsert(R.dimension_rows(priced(spark, folder), F.col("seen_date")))
    return dimension


def looked_up(spark: SparkSession, folder: str, path: str, *key: str) -> DataFrame:
    """What the smallest value of a path's leading columns `key` leads to: its rows of the layout, then their rates."""
    session_key = spark.sparkContext.applicationId
    dimension, rows = stored_rates(session_key, spark, folder), stored_rows(session_key, spark, folder)
    target = stored_layout(session_key, spark, folder, path)
    smallest = A.read_index(spark, target).agg(F.min(F.struct(*[f"low.{column}" for column in key])).alias("low")).first()["low"]
    found = A.look_up(spark, target, S.PROVIDER_RATE_TABLE, path, *(smallest or [None] * len(key)))
    return shown(A.with_rates(found, dimension.of_keys(found))).select(
        *rows.columns, number("negotiated_rate"), day("expiration_date")
    )


@query
def lookup_plan_code(spark, folder):
    return looked_up(spark, folder, "plan_code", "insurance_plan_id")


@query
def lookup_region(spark, folder):
    return looked_up(spark, folder, "region", "region_code")


@query
def lookup_zip(spark, folder):
    return looked_up(spark, folder, "zip", "zip_code")


@query
def lookup_provider(spark, folder):
    return looked_up(spark, folder, "provider", "provider_group_id")


@query
def lookup_first(spark, folder):
    """Whether any plan has a rate for a code in a region: the first match of the greatest key, and the search ends."""
    target = stored_layout(spark.sparkContext.applicationId, spark, folder, "region")
    greatest = A.read_index(spark, target).agg(F.max("high").alias("high")).first()["high"]
    wanted = [greatest[column] for column in A.PATHS["region"][0]]
    rows = A.look_up(spark, target, S.PROVIDER_RATE_TABLE, "region", *wanted)
    return A.first_match(rows).select("region_code", "billing_code_id")


# --- jobs --------------------------------------------------------------------------------


def hour() -> Column:
    return F.date_trunc("hour", "status_time")


@query
def job_counters(spark, folder):
    return J.counters(I.sized_files(spark, folder))


@query
def job_latest_status(spark, folder):
    return J.latest_status(I.status_events(spark, folder)).select(
        "job_id", "status", moment("status_time"), "attempt", moment("last_event_time")
    )


@query
def job_step_durations(spark, folder):
    return J.step_durations(I.status_events(spark, folder), hour())


@query
def job_steps(spark, folder):
    return J.step_rows(I.status_events(spark, folder), hour()).select(
        "id", "job_id", "type", "status", moment("started_at"), moment("completed_at"), "sequence_order"
    )


@query
def job_illegal_moves(spark, folder):
    return J.illegal_moves(I.status_events(spark, folder), hour()).select("event_id", "job_id", "status", "next_status")


@query
def job_throughput(spark, folder):
    runs = I.status_events(spark, folder).select("job_id", F.col("status_time").alias("at"), "n_objects")
    return J.throughput(runs).select("job_id", "n_objects", "seconds", "objects_per_second")


@query
def job_family(spark, folder):
    return J.family(I.jobs(spark, folder))


@query
def job_source_company(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").alias("source_id"))
    sources = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("company_id")
    )
    companies = table(spark, folder, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    return J.with_source_and_company(customers, sources, companies)


@query
def company_sources(spark, folder):
    companies = table(spark, folder, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    sources = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("company_id")
    )
    return J.company_sources(companies, sources)


def file_metrics(spark: SparkSession, folder: str) -> DataFrame:
    parsed = X.parse(I.item_texts(spark, folder), "in_network", S.ITEM)
    named = F.aggregate(
        F.coalesce("negotiated_rates", F.array().cast(f"array<{S.RATE}>")),
        F.lit(0),
        lambda n, r: n + F.coalesce(F.size(r["provider_references"]), F.lit(0)),
    )
    return J.parse_metrics(
        parsed.select("file_id", "part", "bad", F.size("negotiated_rates").alias("n_rates"), named.alias("n_providers"))
    )


@query
def parse_metrics(spark, folder):
    return file_metrics(spark, folder)


@query
def job_metrics(spark, folder):
    files = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("file_id"),
        F.col("o_custkey").cast("string").alias("job_id"),
        F.when(F.col("o_orderpriority") == "5-LOW", "ALLOWED_AMOUNT").otherwise("IN_NETWORK").alias("file_type"),
        F.lit(1).alias("plans_named"),
        (F.col("o_custkey") % 3 != 0).cast("int").alias("plans_saved"),
    )
    references = X.parse(I.reference_texts(spark, folder), "provider_references", S.PROVIDER_REFERENCE)
    counted = J.reference_metrics(references.select("file_id", "part", "bad"))
    return J.job_metrics(file_metrics(spark, folder).join(counted, "file_id", "left").join(files, "file_id"))


@query
def item_rejects(spark, folder):
    return X.rejects(X.parse(I.item_texts(spark, folder), "in_network", S.ITEM))


# --- files -------------------------------------------------------------------------------


@query
def file_manifest(spark, folder):
    return D.manifest(I.extracted_files(spark, folder), F.col("job_id"))


@query
def file_manifest_totals(spark, folder):
    return D.manifest_totals(D.manifest(I.extracted_files(spark, folder), F.col("job_id")))


@query
def file_classify(spark, folder):
    name = F.col("file_name")
    return I.extracted_files(spark, folder).select(
        "file_name",
        file_type(name).alias("file_type"),
        file_extension(name).alias("file_extension"),
        file_extension(name, "first").alias("extension_first_dot"),
    )


@query
def url_normalize(spark, folder):
    url = F.col("url")
    return table(spark, folder, "pages").select(
        "page_id", without_query(url).alias("location"), url_extension(url).alias("file_extension")
    )


@query
def code_bucket(spark, folder):
    code = F.col("p_partkey").cast("string")
    return table(spark, folder, "part").select(code.alias("billing_code"), K.code_bucket(code).alias("bucket"))


@query
def zip_expand(spark, folder):
    return D.measure_archives(I.archives(spark, folder)).drop("error")


@query
def shred_items(spark, folder):
    landing = session.run_dir(spark, "landing")
    I.write_rate_files(spark, folder, landing)
    raw = X.shred(D.list_files(spark, landing, "part-*"), ["in_network"])
    items = X.good(X.parse(raw, "in_network", S.ITEM))
    price = F.col("negotiated_rates")[0]["negotiated_prices"][0]
    return items.select(
        "billing_code",
        "name",
        "billing_code_type",
        "description",
        price["negotiated_rate"].cast("double").alias("negotiated_rate"),
        F.array_join(price["service_code"], ",").alias("service_code"),
        F.array_join(F.col("negotiated_rates")[0]["provider_references"].cast("array<string>"), ",").alias("provider_ids"),
    )


@cache
def landed_weeks(application: str, spark: SparkSession, folder: str) -> tuple[DataFrame, Bronze, Steps]:
    """A file per week, landed once a session: the files as jobs, what is in them, and the jobs' status events."""
    landing, staging = session.run_dir(spark, "weeks"), session.run_dir(spark, "bronze")
    I.write_week_files(spark, folder, landing)
    week = F.regexp_extract("file_id", "document=([-0-9]+)", 1)
    files = session.staged(D.list_files(spark, landing, "part-*").withColumn("job_id", week), f"{staging}/files")
    # A clock of full hours: each step is an hour behind the one before.
    hours = iter(range(24))
    steps = Steps(f"{staging}/events", clock=lambda: RUN_TS.replace(hour=next(hours)))
    steps.record(files, "DOWNLOADING")
    return files, land_bronze(files, staging, steps=steps), steps


def weeks(spark: SparkSession, folder: str) -> tuple[DataFrame, Bronze, Steps]:
    return landed_weeks(spark.sparkContext.applicationId, spark, folder)


@query
def shred_rejects(spark, folder):
    """What a landed file holds beside items and what cannot be a file: nothing goes without a row."""
    bronze = weeks(spark, folder)[1]
    return bronze.rejects.select(F.lit("reject").alias("kind"), "text").unionByName(
        bronze.failed.select(F.lit("failed").alias("kind"), F.col("reason").alias("text"))
    ).unionByName(bronze.items.select(F.lit("item").alias("kind"), F.col("billing_code").alias("text")))


@query
def shred_headers(spark, folder):
    """The scalars of each whole file, before and behind its items."""
    return weeks(spark, folder)[1].headers.select("plan_name", "reporting_entity_name", "version", "issuer_name")


@query
def job_events(spark, folder):
    """The status events the steps wrote for one job per landed file, some of which are not whole."""
    return weeks(spark, folder)[2].events(spark).select("job_id", "status", moment("status_time"), "reason")


@query
def landed_manifest(spark, folder):
    """Size and hash of each landed file, read as it lies there."""
    files = weeks(spark, folder)[0]
    measured = D.measure_files(files).join(files.select("file_id", "job_id"), "file_id")
    return D.manifest(measured, F.col("job_id")).select("job_id", "file_type", "file_size", "file_hash")


@query
def manifest_appends(spark, folder):
    """The stored manifest behind two runs, of which the second brings all files again."""
    table_ = once_table(session.run_dir(spark, "manifest"), S.FILE_MANIFEST_TABLE)
    rows = D.manifest(I.extracted_files(spark, folder), F.col("job_id"))
    table_.upsert(rows.where(F.col("file_type") == "IN_NETWORK"))
    table_.upsert(rows)
    return table_.read(spark)


@query
def job_appends(spark, folder):
    """The stored child jobs behind an import that ran twice."""
    jobs = imported(spark, folder).jobs.select("id", "source_id", "parent_job_id", "status", "file_url", "file_extension", "file_type")
    table_ = once_table(session.run_dir(spark, "jobs"), jobs.schema)
    for _ in range(2):
        table_.upsert(jobs)
    return table_.read(spark)


@query
def shred_references(spark, folder):
    landing = session.run_dir(spark, "landing")
    I.write_rate_files(spark, folder, landing)
    raw = X.shred(D.list_files(spark, landing, "part-*"), ["provider_references"])
    return G.members(X.good(X.parse(raw, "provider_references", S.PROVIDER_REFERENCE))).drop("file_id", "group_id")


# --- list page ---------------------------------------------------------------------------


def listed(spark: SparkSession, folder: str) -> DataFrame:
    return L.matching(table(spark, folder, "customer"), "c_name", "CUSTOMER#")


@query
def list_page(spark, folder):
    return L.page(listed(spark, folder), "c_acctbal", "c_custkey", 3, columns=["c_custkey", "c_name", "c_acctbal"])


@query
def list_page_after(spark, folder):
    return L.page_after(listed(spark, folder), "c_acctbal", "c_custkey", (0.0, -1), columns=["c_custkey", "c_name", "c_acctbal"])


@query
def list_page_deep(spark, folder):
    """The same page of the list as it is written for deep pages."""
    target, order = session.run_dir(spark, "pages"), ("c_acctbal", "c_custkey")
    L.write_pages(listed(spark, folder), *order, target)
    return L.deep_page(spark, target, *order, 3, columns=["c_custkey", "c_name", "c_acctbal"])


@query
def list_counts(spark, folder):
    return L.selection_counts(listed(spark, folder), F.col("c_acctbal") > 5000)


@query
def list_dates(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", day_text(F.col("o_orderdate")).alias("created"))


# --- streams -----------------------------------------------------------------------------


def finished(stream) -> None:
    stream.awaitTermination()


@query
def stream_job_counters(spark, folder):
    target = session.run_dir(spark, "counters")
    k = F.get_json_object("props", "$.k").cast("bigint")
    files = M.table_stream(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("job_id"), F.col("event_type").alias("file_type"), k.alias("file_size")
    )
    finished(M.start_counters(files, f"{target}/table", f"{target}/checkpoint", once=True))
    return M.running_counters(spark, f"{target}/table")


@query
def stream_trigger_dedupe(spark, folder):
    target = session.run_dir(spark, "requests")
    rows = M.table_stream(spark, folder, "events").select("user_id", "event_type")
    keys = ["user_id", "event_type"]
    finished(M.start_first_requests(rows, keys, f"{target}/table", f"{target}/checkpoint", once=True))
    return spark.read.schema("user_id BIGINT, event_type STRING").parquet(f"{target}/table").select("user_id", "event_type")


@query
def stream_job_states(spark, folder):
    target = session.run_dir(spark, "states")
    events = I.as_status_events(M.table_stream(spark, folder, "events"))
    finished(M.start_states(events, f"{target}/table", f"{target}/checkpoint", once=True))
    return M.running_states(spark, f"{target}/table").select(
        "job_id", "status", moment("status_time"), "attempt", moment("last_event_time")
    )


@query
def stream_rejects(spark, folder):
    target = session.run_dir(spark, "routing")
    kind = F.col("event_type")
    topic = F.when(kind == "click", f"dev.{V.TOPIC_TRIGGER}").when(kind == "error", "dev.other").otherwise(
        f"dev.{V.TOPIC_IN_NETWORK}"
    )
    user = F.col("user_id").cast("string")
    value = (
        F.when(kind == "view", F.substring("props", 1, 3))
        .when(kind == "signup", F.col("props"))
        .otherwise(F.to_json(F.struct(user.alias("id"), F.col("props").alias("payload"))))
    )
    rows = M.table_stream(spark, folder, "events").select(topic.alias("topic"), value.alias("value"))
    finished(M.start_routing(rows, f"{target}/table", f"{target}/checkpoint", "dev.", once=True))
    out = spark.read.schema("topic STRING, value STRING, job_id STRING, payload STRING, reason STRING, accepted BOOLEAN").parquet(
        f"{target}/table"
    )
    return out.select("topic", "value", "job_id", "payload", "reason", "accepted")


@query
def stream_new_files(spark, folder):
    target = session.run_dir(spark, "rate-files")
    I.write_rate_files(spark, folder, f"{target}/landing")
    files = M.landed_files(spark, f"{target}/landing", "part-*")
    finished(M.start_rate_files(files, target, f"{target}/checkpoint", once=True))
    found = spark.read.parquet(f"{target}/messages")
    return found.select(
        "procedure.billing_code",
        "procedure.description",
        F.array_join("provider_ids", ",").alias("provider_ids"),
        F.size("negotiated_prices").alias("n_prices"),
    )
