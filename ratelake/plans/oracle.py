"""SQL twins of the queries, for DuckDB on the same tables, in the plainest form."""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def with_(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


def ident(prefix: str, text: str) -> str:
    return f"'{prefix}_' || substr(sha256({text}), 1, 24)"


# --- index -------------------------------------------------------------------------------

STRUCTURE = """
s AS (
  SELECT 'toc-' || year(o_orderdate) AS file_id, o_orderkey AS rs_pos, o_orderstatus AS st, o_orderpriority AS pr, o_custkey % 500 AS lot,
         c_custkey, c_name, c_mktsegment || '-' || c_nationkey AS nm,
         CASE WHEN c_custkey % 2 = 0 THEN 'ein' ELSE 'hios' END AS idt,
         CASE WHEN c_acctbal < 0 THEN 'individual' ELSE 'group' END AS mk,
         o_orderpriority = '5-LOW' AND o_orderstatus = 'P' AS skipped
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

PLANS = """
pl AS (
  SELECT file_id, rs_pos, 0 AS plan_pos, nm AS plan_name, idt AS plan_id_type,
         CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS plan_id,
         c_name AS plan_sponsor_name, mk AS plan_market_type, skipped FROM s
  UNION ALL
  SELECT file_id, rs_pos, 1, nm || '/' || st, idt,
         CASE st WHEN 'F' THEN 'S' || c_custkey WHEN 'O' THEN '' END, c_name, mk, skipped FROM s)"""

RANKED = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY file_id, plan_name ORDER BY rs_pos, plan_pos) AS name_rank
  FROM pl WHERE plan_id IS NOT NULL AND plan_id <> '')"""

RESOLVED = """
res AS (
  SELECT file_id, rs_pos, plan_pos, plan_name, plan_id_type, plan_id, plan_sponsor_name, plan_market_type, skipped
  FROM pl WHERE plan_id IS NOT NULL AND plan_id <> ''
  UNION ALL
  SELECT p.file_id, p.rs_pos, p.plan_pos, g.plan_name, g.plan_id_type, g.plan_id, g.plan_sponsor_name, g.plan_market_type, p.skipped
  FROM pl p JOIN ranked g ON g.name_rank = 1 AND g.file_id = p.file_id AND g.plan_name IS NOT DISTINCT FROM p.plan_name
  WHERE p.plan_id IS NULL OR p.plan_id = '')"""


def normalized(name: str, source: str, company: str = "'ins_1'") -> str:
    return f"""
{name}_0 AS (
  SELECT * REPLACE (CASE WHEN plan_id_type = 'ein' THEN 'EIN' ELSE 'HIOS' END AS plan_id_type,
                    CASE WHEN plan_market_type = 'individual' THEN 'INDIVIDUAL' ELSE 'GROUP' END AS plan_market_type),
         upper(plan_id_type) AS raw_type
  FROM {source}),
{name}_1 AS (
  SELECT *, sha256({company} || '-' || plan_id || '-' || plan_market_type || '-' || plan_name || '-' || raw_type)
         AS insurance_plan_hash FROM {name}_0),
{name} AS (SELECT *, {ident("ins_plan", "insurance_plan_hash")} AS insurance_plan_id FROM {name}_1)"""


PLAN_ROWS = """
incoming AS (
  SELECT insurance_plan_id AS id, * EXCLUDE (insurance_plan_id) FROM (
    SELECT *, row_number() OVER (PARTITION BY insurance_plan_hash ORDER BY file_id, rs_pos, plan_pos) AS rn FROM norm)
  WHERE rn = 1)"""

TABLE_SOURCE = """
raw_table AS (
  SELECT 'earlier' AS file_id, c_custkey AS rs_pos, c_mktsegment || '-' || c_nationkey AS plan_name,
         CASE WHEN c_custkey % 2 = 0 THEN 'ein' ELSE 'hios' END AS plan_id_type,
         CAST(c_custkey AS VARCHAR) AS plan_id, 'earlier' AS plan_sponsor_name, 'group' AS plan_market_type
  FROM customer WHERE c_acctbal >= 0 AND c_custkey % 3 <> 0)"""

TOC = (STRUCTURE, PLANS, RANKED, RESOLVED)
INCOMING = (*TOC, normalized("norm", "res"), PLAN_ROWS, TABLE_SOURCE, normalized("known", "raw_table"))

ORACLE["toc_good_plans"] = with_(
    *TOC,
    select="""SELECT file_id, plan_name, rs_pos, plan_pos, plan_id_type, plan_id, plan_sponsor_name, plan_market_type
FROM ranked WHERE name_rank = 1""",
)
ORACLE["toc_first_rank"] = with_(*TOC, select="SELECT file_id, plan_name, plan_id, rs_pos, plan_pos, name_rank FROM ranked")
ORACLE["toc_plan_count"] = with_(
    *TOC, select="SELECT file_id, count(DISTINCT plan_name) AS n_plans FROM ranked GROUP BY 1"
)
ORACLE["plan_backfill"] = with_(*TOC, select="SELECT * EXCLUDE (skipped) FROM res")
ORACLE["plan_normalize"] = with_(
    STRUCTURE,
    PLANS,
    select="""SELECT rs_pos, plan_pos, plan_name, plan_id,
  CASE plan_id_type WHEN 'ein' THEN 'EIN' ELSE 'HIOS' END AS plan_id_type,
  CASE plan_market_type WHEN 'individual' THEN 'INDIVIDUAL' ELSE 'GROUP' END AS plan_market_type FROM pl""",
)
ORACLE["plan_hash"] = with_(
    *TOC, normalized("norm", "res"), select="SELECT rs_pos, plan_pos, insurance_plan_hash, insurance_plan_id FROM norm"
)
ORACLE["plan_known"] = with_(
    *INCOMING,
    select="""SELECT id, plan_name, plan_id, insurance_plan_hash FROM incoming
WHERE insurance_plan_hash IN (SELECT insurance_plan_hash FROM known)""",
)
ORACLE["plan_new"] = with_(
    *INCOMING,
    select="""SELECT id, plan_name, plan_id, insurance_plan_hash FROM incoming
WHERE insurance_plan_hash NOT IN (SELECT insurance_plan_hash FROM known)""",
)
ORACLE["plan_ids_union"] = with_(
    *INCOMING,
    select="""SELECT insurance_plan_id AS id FROM known
WHERE insurance_plan_hash IN (SELECT insurance_plan_hash FROM incoming)
UNION ALL SELECT id FROM incoming WHERE insurance_plan_hash NOT IN (SELECT insurance_plan_hash FROM known)""",
)
ORACLE["plan_upsert"] = with_(
    *INCOMING,
    select="""SELECT coalesce(k.insurance_plan_id, i.id) AS id, coalesce(k.plan_name, i.plan_name) AS plan_name,
  coalesce(k.plan_id_type, i.plan_id_type) AS plan_id_type, coalesce(k.plan_id, i.plan_id) AS plan_id,
  coalesce(k.plan_sponsor_name, i.plan_sponsor_name) AS plan_sponsor_name,
  coalesce(k.plan_market_type, i.plan_market_type) AS plan_market_type,
  CASE WHEN k.plan_id IS NOT NULL THEN '2001-06-01 00:00:00.000000' ELSE '2002-01-01 00:00:00.000000' END AS plan_first_seen,
  CASE WHEN i.plan_id IS NOT NULL THEN '2002-01-01 00:00:00.000000' ELSE '2001-12-01 00:00:00.000000' END AS plan_last_seen,
  true AS plan_active, coalesce(k.insurance_plan_hash, i.insurance_plan_hash) AS insurance_plan_hash
FROM known k FULL JOIN incoming i ON k.insurance_plan_hash = i.insurance_plan_hash""",
)


def listed(scope: str) -> str:
    kept = "NOT skipped" if scope == "structure" else "true"
    return f"""
listed_{scope} AS (
  SELECT file_id, rs_pos, 0 AS file_pos, 'https://h/aa' || lot || '.json' AS location,
         'https://h/aa' || lot || '.json?s=' || rs_pos AS url, 'allowed_amount' AS file_type, 'JSON' AS file_extension
  FROM s WHERE pr = '5-LOW' AND NOT skipped
  UNION ALL
  SELECT file_id, rs_pos, 1, split_part(url, '?', 1), url, 'in_network',
         CASE st WHEN 'F' THEN 'GZ' WHEN 'O' THEN 'ZIP' ELSE 'JSON' END
  FROM (SELECT *, 'https://h/f' || lot || CASE st WHEN 'F' THEN '.json.gz' WHEN 'O' THEN '.zip' ELSE '.json' END
               || '?s=' || rs_pos AS url FROM s WHERE {kept}))"""


FILES = (
    *TOC,
    normalized("norm", "res"),
    listed("structure"),
    """
files AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file_id, location ORDER BY rs_pos, file_pos) AS rn FROM listed_structure)
  WHERE rn = 1)""",
    """
pairs AS (
  SELECT DISTINCT listed_structure.file_id, location, insurance_plan_id
  FROM listed_structure JOIN norm USING (rs_pos) WHERE NOT norm.skipped)""",
    """
numbered AS (
  SELECT *, CAST(floor((row_number() OVER (PARTITION BY file_id, location ORDER BY insurance_plan_id) - 1) / 10000) AS INTEGER) AS part
  FROM pairs)""",
    """
parts AS (
  SELECT file_id, location, part, CAST(count(*) AS INTEGER) AS n_plans, string_agg(insurance_plan_id, ',' ORDER BY insurance_plan_id) AS plans,
         string_agg('"' || insurance_plan_id || '"', ',' ORDER BY insurance_plan_id) AS quoted
  FROM numbered GROUP BY file_id, location, part)""",
    """
file_parts AS (
  SELECT f.*, coalesce(part, 0) AS part, coalesce(n_plans, 0) AS n_plans, coalesce(plans, '') AS plans,
         coalesce(quoted, '') AS quoted,
         'ins_job_' || f.file_id AS parent_job_id,
         'ins_job_' || substr(sha256('ins_job_' || f.file_id || chr(31) || f.location), 1, 24) AS id,
         CASE file_type WHEN 'in_network' THEN 'in-network-file' ELSE 'allowed-amount' END AS topic
  FROM files f LEFT JOIN parts USING (file_id, location))""",
)

ORACLE["plan_table"] = ORACLE["plan_upsert"]
ORACLE["toc_from_files"] = with_(
    TOC[0],
    PLANS,
    """
dated AS (
  SELECT pl.*, strftime(o_orderdate, '%Y-%m') AS month FROM pl JOIN orders ON rs_pos = o_orderkey
  WHERE plan_id IS NOT NULL AND plan_id <> '')""",
    select="""SELECT month, plan_name, plan_id_type, plan_id, plan_sponsor_name, plan_market_type FROM (
  SELECT *, row_number() OVER (PARTITION BY month, plan_name ORDER BY rs_pos, plan_pos) AS n FROM dated) WHERE n = 1""",
)
ORACLE["good_plans_dump"] = ORACLE["toc_good_plans"]
ORACLE["toc_file_plans"] = with_(
    *FILES, select="SELECT file_id, location, url, file_type, file_extension, part, n_plans, plans FROM file_parts"
)
ORACLE["toc_placeholder_skip"] = with_(
    STRUCTURE,
    listed("structure"),
    listed("file"),
    select="""SELECT file_id, location, count(*) FILTER (scope = 'structure') AS n_listed,
  count(*) FILTER (scope = 'file') AS n_listed_by_file_scope
FROM (SELECT file_id, location, 'structure' AS scope FROM listed_structure UNION ALL SELECT file_id, location, 'file' FROM listed_file)
GROUP BY file_id, location""",
)
ORACLE["toc_child_jobs"] = with_(
    *FILES,
    select="""SELECT id, 'iss_1' AS source_id, parent_job_id, 'PENDING' AS status, url AS file_url,
  file_extension, upper(file_type) AS file_type, topic, part,
  '{"id":"' || id || '","topic":"' || topic || '","payload":{"sourceType":"CIGNA_INDEX_API","url":"' || url
  || '","reportingPlans":[' || quoted || '],"insuranceCompanyId":"ins_1","insuranceImportSourceId":"iss_1"'
  || CASE WHEN part > 0 THEN ',"part":' || part ELSE '' END || '}}' AS value
FROM file_parts""",
)
ORACLE["dispatch_batches"] = with_(
    *FILES,
    select="""SELECT 'ins_job_' || substr(sha256('ins_job_' || file_id || chr(31) || location), 1, 24) AS id,
  'ins_job_' || file_id AS parent_job_id, upper(file_type) AS file_type, rs_pos,
  CAST(floor((row_number() OVER (PARTITION BY file_id, file_type ORDER BY rs_pos, file_pos) - 1) / 100) AS BIGINT) AS lot
FROM files""",
)
ORACLE["dispatch_lots"] = with_(
    *FILES,
    select="""SELECT parent_job_id, topic, lot, count(*) AS n_messages
FROM file_parts JOIN (
  SELECT file_id, location,
    CAST(floor((row_number() OVER (PARTITION BY file_id ORDER BY rs_pos, file_pos) - 1) / 100) AS BIGINT) AS lot
  FROM files WHERE file_type = 'in_network') USING (file_id, location)
GROUP BY ALL""",
)

REQUESTS = (
    """
requests AS (
  SELECT 'iss_' || o_custkey || '_' || o_orderstatus || '_' || substr(o_orderpriority, 1, 1) AS source_id,
         o_custkey, o_orderdate AS requested_at,
         CASE WHEN o_orderstatus = 'P' THEN 'AETNA_BLOB_API' ELSE 'CIGNA_INDEX_API' END AS source_type,
         CASE WHEN o_orderpriority <> '5-LOW' THEN 'https://h/latest/' || o_custkey END AS url
  FROM orders)""",
    """
once AS (
  SELECT source_id || '|' || strftime(requested_at, '%Y-%m-%d') AS request_id, source_id, source_type, url,
         min(requested_at) AS requested_at,
         CASE WHEN source_type <> 'CIGNA_INDEX_API' THEN 'source type not handled'
              WHEN url IS NULL THEN 'listing url missing' END AS reason
  FROM requests GROUP BY 1, 2, 3, 4)""",
)
JOB_ID = ident("ins_job", "request_id")
ORACLE["trigger_jobs"] = with_(
    *REQUESTS,
    select=f"""SELECT {JOB_ID} AS id, source_id, 'PENDING' AS status, 'TABLE_OF_CONTENTS' AS file_type,
  strftime(requested_at, '%Y-%m-%d %H:%M:%S.%f') AS status_time,
  '{{"id":"' || {JOB_ID} || '","type":"insurance-source-scan-jobs","payload":{{"id":"' || source_id
  || '","sourceType":"CIGNA_INDEX_API","insuranceCompanyId":"ins_1","options":{{"cigna_page_url":"' || url || '"}}}}}}' AS message
FROM once WHERE reason IS NULL""",
)
ORACLE["trigger_rejects"] = with_(
    *REQUESTS, select="SELECT request_id, source_id, source_type, reason FROM once WHERE reason IS NOT NULL"
)
ORACLE["listing_gate"] = """
SELECT file_id, reason, CASE WHEN reason IS NULL THEN 'https://h/index' || o_orderkey || '.json' END AS index_url
FROM (SELECT o_orderkey, 'l' || o_orderkey AS file_id,
             CASE WHEN o_orderstatus = 'P' THEN 'more than one mrf' WHEN o_orderpriority = '1-URGENT' THEN 'no mrf'
                  WHEN o_orderpriority = '5-LOW' THEN 'not exactly one file' END AS reason FROM orders)"""
ORACLE["listing_events"] = """
SELECT file_id AS job_id, 'FAILED' AS status, '2002-01-01 00:00:00.000000' AS status_time, reason FROM (
  SELECT 'l' || o_orderkey AS file_id,
         CASE WHEN o_orderstatus = 'P' THEN 'more than one mrf' WHEN o_orderpriority = '1-URGENT' THEN 'no mrf'
              WHEN o_orderpriority = '5-LOW' THEN 'not exactly one file' END AS reason FROM orders) WHERE reason IS NOT NULL"""
ORACLE["enum_reject"] = """
SELECT o_orderkey AS job_id,
  CASE o_orderpriority WHEN '5-LOW' THEN 'ALLOWED_AMOUNT' WHEN '1-URGENT' THEN 'PHARMACY' ELSE 'IN_NETWORK' END AS file_type,
  CASE o_orderstatus WHEN 'F' THEN 'GZ' WHEN 'O' THEN 'ZIP' END AS file_extension,
  concat_ws(',', CASE WHEN o_orderpriority = '1-URGENT' THEN 'file_type' END,
                 CASE WHEN o_orderstatus = 'P' THEN 'file_extension' END) AS enum_errors
FROM orders WHERE o_orderpriority = '1-URGENT' OR o_orderstatus = 'P'"""
ORACLE["file_header"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS file_id, 'Insurer' AS reporting_entity_name,
  'group health plan' AS reporting_entity_type, CAST(NULL AS VARCHAR) AS issuer_name, 'Plan ' || o_custkey AS plan_name,
  CASE WHEN o_custkey % 2 = 0 THEN 'ein' ELSE 'hios' END AS plan_id_type, CAST(o_custkey AS VARCHAR) AS plan_id,
  o_orderpriority AS plan_sponsor_name, o_orderstatus AS plan_market_type, '1.0' AS version FROM orders"""

# --- rates -------------------------------------------------------------------------------

PRICES = """
lines AS (
  SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS listed,
         CAST(1 AS DECIMAL(3,2)) - CAST(l_discount AS DECIMAL(3,2)) AS cut,
         CASE l_returnflag WHEN 'A' THEN 'professional' WHEN 'N' THEN 'institutional' ELSE 'both' END AS class,
         CASE l_linestatus WHEN 'F' THEN 'inpatient' ELSE 'outpatient' END AS setting,
         strftime(l_shipdate, '%Y') || '-12-31' AS expires, CAST(l_shipdate AS DATE) AS seen_date,
         CASE l_linenumber WHEN 3 THEN ['25,59'] WHEN 4 THEN ['25', '59'] ELSE [l_returnflag] END AS mods,
         CAST(l_partkey AS VARCHAR) AS code FROM lineitem),
unhashed AS (
  SELECT *, 'negotiated' AS kind, CAST(listed AS DECIMAL(18,4)) AS rate FROM lines
  UNION ALL
  SELECT *, 'derived', CASE WHEN l_linenumber < 7 THEN CAST(listed * cut AS DECIMAL(18,4)) END FROM lines),
prices AS (
  SELECT *, sha256('CPT' || chr(31) || code || chr(31) || kind || chr(31) || coalesce(CAST(rate AS VARCHAR), '') || chr(31)
         || expires || chr(31) || '["11","' || (l_linenumber + 10) || '"]' || chr(31) || class || chr(31) || setting
         || chr(31) || to_json(mods)) AS procedure_hash FROM unhashed)"""

ORACLE["rate_summary_by_code"] = with_(
    PRICES,
    select="""SELECT 'CPT' AS billing_code_type, code AS billing_code, any_value(p_name) AS name, count(*) AS n_prices,
  count(rate) AS n_rates, CAST(min(rate) AS DOUBLE) AS min_rate, CAST(max(rate) AS DOUBLE) AS max_rate,
  CAST(sum(rate) AS DOUBLE) AS sum_rate, CAST(sum(rate) AS DOUBLE) / count(rate) AS avg_rate
FROM prices LEFT JOIN part ON p_partkey = l_partkey GROUP BY code""",
)
ORACLE["rate_messages"] = with_(
    PRICES,
    select="""SELECT CAST(l_orderkey AS VARCHAR) AS file_id, CAST(l_linenumber AS BIGINT) AS item_no, 0 AS rate_no,
  'ffs' AS negotiation_arrangement, p_name AS name, 'CPT' AS billing_code_type, '' AS billing_code_type_version,
  code AS billing_code, p_brand AS description,
  CASE WHEN l_returnflag = 'R' THEN l_suppkey || ',' || (l_suppkey + 1) ELSE CAST(l_suppkey AS VARCHAR) END AS provider_ids,
  2 AS n_prices,
  'negotiated|' || CAST(listed AS DECIMAL(18,4)) || '|' || tail || ';derived|'
  || CASE WHEN l_linenumber < 7 THEN CAST(listed * cut AS DECIMAL(18,4)) || '|' ELSE '' END || tail AS prices
FROM (SELECT *, expires || '|' || (l_linenumber + 10) || '/11|' || class || '|' || setting || '|'
         || CASE l_linenumber WHEN 3 THEN '25,59' WHEN 4 THEN '59/25' ELSE l_returnflag END AS tail
      FROM lines) JOIN part ON p_partkey = l_partkey""",
)
ORACLE["rate_wire"] = with_(
    PRICES,
    select="""SELECT code AS billing_code,
  CASE WHEN l_returnflag = 'R' THEN l_suppkey || ',' || (l_suppkey + 1) ELSE CAST(l_suppkey AS VARCHAR) END AS provider_ids,
  CAST(listed AS DOUBLE) AS rate_1,
  CASE WHEN l_linenumber < 7 THEN CAST(CAST(listed * cut AS DECIMAL(18,4)) AS DOUBLE) ELSE 0.0 END AS rate_2,
  0 AS n_additional FROM lines""",
)
DIMENSION = """procedure_hash, rate, expires, code, l_linenumber, class, setting, mods"""
ORACLE["procedure_rate_upsert"] = with_(
    PRICES,
    select=f"""SELECT procedure_hash, CAST(rate AS DOUBLE) AS negotiated_rate, expires AS expiration_date, code AS billing_code,
  CASE WHEN l_linenumber = 1 THEN '11,11' ELSE '11,' || (l_linenumber + 10) END AS service_code,
  CASE class WHEN 'professional' THEN 1 WHEN 'institutional' THEN 2 ELSE 3 END AS billing_class,
  CASE setting WHEN 'inpatient' THEN 1 ELSE 2 END AS setting, array_to_string(mods, ',') AS billing_code_modifier,
  strftime(min(CASE WHEN l_returnflag <> 'R' THEN seen_date - 30 ELSE seen_date END), '%Y-%m-%d') AS first_seen_date,
  strftime(max(CASE WHEN l_returnflag <> 'A' THEN seen_date ELSE seen_date - 30 END), '%Y-%m-%d') AS last_seen_date
FROM prices GROUP BY {DIMENSION}""",
)
ORACLE["dimension_table"] = with_(
    PRICES,
    select=f"""SELECT procedure_hash, CAST(rate AS DOUBLE) AS negotiated_rate, code AS billing_code,
  array_to_string(list_sort(mods), '|') AS billing_code_modifier, strftime(min(seen_date), '%Y-%m-%d') AS first_seen_date,
  strftime(max(seen_date), '%Y-%m-%d') AS last_seen_date
FROM prices GROUP BY {DIMENSION}""",
)
ORACLE["rate_unknown_codes"] = with_(
    PRICES,
    select="SELECT 'setting' AS field, setting || '-' || class AS word, count(*) AS n_prices FROM prices GROUP BY 1, 2",
)
FACT = (
    PRICES,
    """
places AS (
  SELECT s_suppkey AS number,
         CASE WHEN s_acctbal >= 0 THEN lpad(CAST(s_suppkey * 37 % 100000 AS VARCHAR), 5, '0') END AS zip_code,
         CAST(n_regionkey AS BIGINT) AS region_code
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey)""",
    f"""
named AS (
  SELECT *, {ident("group", "l_orderkey || chr(31) || number")} AS provider_group_id
  FROM (SELECT *, l_suppkey AS number FROM prices
        UNION ALL SELECT *, l_suppkey + 1 FROM prices WHERE l_returnflag = 'R'))""",
    """
fact AS (
  SELECT provider_group_id, zip_code, region_code, CAST(o_custkey AS VARCHAR) AS insurance_plan_id,
         code AS billing_code_id, procedure_hash, min(seen_date) AS first_seen, max(seen_date) AS last_seen,
         min(rate) AS rate
  FROM named JOIN orders ON l_orderkey = o_orderkey LEFT JOIN places USING (number)
  GROUP BY 1, 2, 3, 4, 5, 6)""",
)
SEEN = "strftime({0}(first_seen), '%Y-%m-%d') AS first_seen_date, strftime({1}(last_seen), '%Y-%m-%d') AS last_seen_date"
ORACLE["provider_rate_fact"] = with_(
    *FACT,
    select=f"""SELECT provider_group_id, zip_code, region_code, insurance_plan_id, billing_code_id, procedure_hash,
  {SEEN.format("", "")} FROM fact""",
)
ORACLE["fact_table"] = ORACLE["provider_rate_fact"]
ORACLE["provider_rate_upsert"] = with_(
    *FACT[:-1],
    """
dated AS (
  SELECT * REPLACE (seen_date - 30 AS seen_date) FROM named WHERE l_returnflag <> 'R'
  UNION ALL SELECT * FROM named WHERE l_returnflag <> 'A')""",
    FACT[-1].replace("FROM named", "FROM dated"),
    select=f"""SELECT provider_group_id, zip_code, region_code, insurance_plan_id, billing_code_id, procedure_hash,
  {SEEN.format("", "")} FROM fact""",
)
ORACLE["serve_by_plan_code"] = with_(
    *FACT,
    select="""SELECT insurance_plan_id, billing_code_id, count(*) AS n_rows, CAST(min(rate) AS DOUBLE) AS min_rate,
  CAST(max(rate) AS DOUBLE) AS max_rate FROM fact GROUP BY 1, 2""",
)
for path, keys in (
    ("region", "region_code, billing_code_id"),
    ("zip", "zip_code, billing_code_id"),
    ("provider", "provider_group_id"),
):
    ORACLE[f"serve_by_{path}"] = with_(
        *FACT,
        select=f"""SELECT {keys}, count(*) AS n_rows, {SEEN.format("min", "max")}
FROM fact WHERE {keys.split(",")[0]} IS NOT NULL GROUP BY {keys}""",
    )
DIM = """
dim AS (SELECT DISTINCT procedure_hash, rate AS priced, expires FROM prices)"""
RATED = f"""SELECT provider_group_id, zip_code, region_code, insurance_plan_id, billing_code_id, procedure_hash,
  {SEEN.format("", "")}, CAST(priced AS DOUBLE) AS negotiated_rate, expires AS expiration_date
FROM fact JOIN dim USING (procedure_hash)"""
for path, key in (
    ("plan_code", "insurance_plan_id"),
    ("region", "region_code"),
    ("zip", "zip_code"),
):
    ORACLE[f"lookup_{path}"] = with_(*FACT, DIM, select=f"{RATED} WHERE {key} = (SELECT min({key}) FROM fact)")
for path, lead in (("provider", "provider_group_id"),):
    ORACLE[f"lookup_{path}"] = with_(
        *FACT,
        f"""{DIM},
smallest AS (SELECT {lead} FROM fact WHERE {lead.split(",")[0]} IS NOT NULL ORDER BY {lead} LIMIT 1)""",
        select=f"{RATED} JOIN smallest USING ({lead})",
    )
ORACLE["lookup_first"] = with_(
    *FACT,
    select="""SELECT region_code, billing_code_id FROM fact WHERE region_code IS NOT NULL
ORDER BY region_code DESC, billing_code_id DESC LIMIT 1""",
)
ORACLE["inline_rates"] = with_(
    PRICES,
    """
rows_ AS (
  SELECT *, l_suppkey AS number FROM prices
  UNION ALL SELECT *, l_suppkey + 1 FROM prices WHERE l_returnflag = 'R' AND l_linestatus <> 'F')""",
    select="""SELECT CAST(o_custkey AS VARCHAR) AS insurance_plan_id, code AS billing_code_id, procedure_hash,
  number * 10 + 1000000000 AS first_npi, strftime(min(seen_date), '%Y-%m-%d') AS first_seen_date,
  strftime(max(seen_date), '%Y-%m-%d') AS last_seen_date
FROM rows_ JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3, 4""",
)
ORACLE["rate_provider_join"] = with_(
    PRICES,
    """
named AS (
  SELECT *, l_suppkey AS provider_group_id FROM lines
  UNION ALL SELECT *, l_suppkey + 1 FROM lines WHERE l_returnflag = 'R')""",
    select="""SELECT CASE WHEN l_orderkey % 2 = 0 THEN 'even' ELSE 'odd' END AS file_id, CAST(l_linenumber AS BIGINT) AS item_no,
  code AS billing_code, provider_group_id, CASE WHEN l_orderkey % 2 = 0 THEN s_name ELSE s_name || '/odd' END AS network_name,
  CASE WHEN s_suppkey IS NOT NULL THEN 2 END AS n_members
FROM named LEFT JOIN supplier ON s_suppkey = provider_group_id""",
)
ORACLE["item_codes"] = """
SELECT item_billing_code, kind, CAST(pos AS INTEGER) AS pos, billing_code_type, '' AS billing_code_type_version, billing_code, description
FROM (
  SELECT CAST(p_partkey AS VARCHAR) AS item_billing_code, 'bundled_code' AS kind, generate_subscripts(words, 1) - 1 AS pos,
         'WORD' AS billing_code_type, unnest(words) AS billing_code, p_brand AS description
  FROM (SELECT *, string_split(p_name, ' ') AS words FROM part)
  UNION ALL
  SELECT CAST(p_partkey AS VARCHAR), 'covered_service', 0, p_type, CAST(p_size AS VARCHAR), '' FROM part WHERE p_size > 25)"""
ORACLE["procedure_codes"] = f"""
SELECT {ident("code", "p_type || chr(31) || code")} AS id, code, {ident("code_type", "p_type")} AS type_id, p_type AS type, description
FROM (SELECT p_type, CAST(p_partkey AS VARCHAR) AS code, min(p_brand) AS description FROM part GROUP BY 1, 2)"""

MEMBERS = """
m AS (
  SELECT s_suppkey AS provider_group_id, s_name AS network_name, 0 AS member_no, 1000000000 + s_suppkey * 10 + k AS npi,
         'ein' AS tax_id_type, CAST(s_suppkey AS VARCHAR) AS tax_id, s_name AS business_name
  FROM supplier, (VALUES (0), (1)) v(k)
  UNION ALL
  SELECT s_suppkey, s_name, 1, 1000000001 + s_suppkey * 10, 'npi', CAST(1000000001 + s_suppkey * 10 AS VARCHAR), s_name FROM supplier)"""
ORACLE["provider_ref_members"] = with_(MEMBERS, select="SELECT * FROM m")
ORACLE["shred_references"] = ORACLE["provider_ref_members"]
ORACLE["provider_bridge"] = with_(
    MEMBERS,
    """
two AS (
  SELECT 'even' AS file_id, npi, provider_group_id, network_name FROM m
  UNION ALL SELECT 'odd', npi + 5000000000, provider_group_id, network_name || '/odd' FROM m)""",
    select=f"""SELECT DISTINCT npi, {ident("group", "file_id || chr(31) || provider_group_id")} AS group_id,
  network_name AS group_name, {ident("provider", "CAST(npi AS VARCHAR)")} AS provider_id FROM two""",
)

# --- jobs --------------------------------------------------------------------------------

SIZED = """
sized AS (
  SELECT CAST(o_custkey AS VARCHAR) AS job_id,
         CASE o_orderpriority WHEN '5-LOW' THEN 'ALLOWED_AMOUNT' ELSE 'IN_NETWORK' END AS file_type,
         CAST(floor(o_totalprice) AS BIGINT) AS file_size FROM orders)"""
ORACLE["job_counters"] = with_(
    SIZED,
    select="""SELECT job_id, file_type, CAST(sum(file_size) AS BIGINT) AS n_bytes, count(*) AS n_files,
  CAST(grouping_id(job_id, file_type) AS INTEGER) AS level FROM sized GROUP BY ROLLUP (job_id, file_type)""",
)
EVENTS = """
ev AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS job_id, ts AS status_time,
         CASE event_type WHEN 'click' THEN 'PENDING' WHEN 'view' THEN 'DOWNLOADING' WHEN 'signup' THEN 'PARSING'
              WHEN 'purchase' THEN 'COMPLETED' WHEN 'error' THEN 'FAILED' END AS status,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS n_objects FROM events)"""
TIME = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f') AS {1}"
ORACLE["job_latest_status"] = with_(
    EVENTS,
    """
tried AS (
  SELECT *, CAST(count(*) FILTER (status = 'PENDING') OVER (PARTITION BY job_id ORDER BY status_time, event_id) AS BIGINT) AS attempt,
         max(status_time) OVER (PARTITION BY job_id) AS last_time FROM ev)""",
    """
placed AS (
  SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY attempt DESC, status = 'FAILED' DESC, status_time DESC, event_id DESC) AS rn
  FROM tried)""",
    select=f"""SELECT job_id, status, {TIME.format("status_time", "status_time")}, attempt,
  {TIME.format("last_time", "last_event_time")} FROM placed WHERE rn = 1""",
)
FOLLOWED = """
followed AS (
  SELECT *, lead(status) OVER w AS next_status, lead(status_time) OVER w AS next_time FROM ev
  WINDOW w AS (PARTITION BY job_id ORDER BY status_time, event_id))"""
ORACLE["job_step_durations"] = with_(
    EVENTS,
    FOLLOWED,
    select="""SELECT job_id, status, count(*) AS n_entered, count(next_time) AS n_left,
  CAST(sum(epoch_us(next_time) - epoch_us(status_time)) AS BIGINT) AS spent_micros FROM followed GROUP BY 1, 2""",
)
ORACLE["job_illegal_moves"] = with_(
    EVENTS,
    FOLLOWED,
    select="""SELECT event_id, job_id, status, next_status FROM followed
WHERE next_status IS NOT NULL AND (status, next_status) NOT IN (
  ('PENDING', 'DOWNLOADING'), ('PENDING', 'FAILED'), ('DOWNLOADING', 'DECOMPRESSING'), ('DOWNLOADING', 'PARSING'),
  ('DOWNLOADING', 'FAILED'), ('DECOMPRESSING', 'PARSING'), ('DECOMPRESSING', 'FAILED'), ('PARSING', 'COMPLETED'),
  ('PARSING', 'FAILED'), ('COMPLETED', 'PENDING'), ('FAILED', 'PENDING'))""",
)
ORACLE["job_steps"] = with_(
    EVENTS,
    FOLLOWED,
    select=f"""SELECT {ident("ins_step", "job_id || chr(31) || event_id")} AS id, job_id,
  CASE status WHEN 'DOWNLOADING' THEN 'DOWNLOAD' WHEN 'PARSING' THEN 'PARSE' WHEN 'COMPLETED' THEN 'POST_PROCESS' END AS type,
  CASE WHEN status = 'COMPLETED' THEN 'COMPLETED' WHEN next_status IS NULL THEN 'IN_PROGRESS'
       WHEN next_status = 'FAILED' THEN 'FAILED' ELSE 'COMPLETED' END AS status,
  {TIME.format("status_time", "started_at")}, {TIME.format("next_time", "completed_at")},
  row_number() OVER (PARTITION BY job_id ORDER BY status_time, event_id) AS sequence_order
FROM followed WHERE status IN ('DOWNLOADING', 'PARSING', 'COMPLETED')""",
)
ORACLE["job_metrics"] = """
WITH per_file AS (
  SELECT l_orderkey, count(*) AS parsed, count(*) FILTER (l_returnflag <> 'R') AS saved,
    count(DISTINCT l_suppkey) AS refs, count(DISTINCT l_suppkey) FILTER (l_suppkey % 7 <> 0) AS refs_saved FROM lineitem GROUP BY 1),
f AS (
  SELECT CAST(o_custkey AS VARCHAR) AS job_id, o_custkey, o_orderpriority = '5-LOW' AS allowed, parsed, saved, refs, refs_saved
  FROM per_file JOIN orders ON l_orderkey = o_orderkey)
SELECT job_id,
  CAST(coalesce(sum(parsed) FILTER (NOT allowed), 0) AS BIGINT) AS in_network_objects_parsed,
  CAST(coalesce(sum(parsed) FILTER (allowed), 0) AS BIGINT) AS allowed_amount_objects_parsed,
  CAST(coalesce(sum(saved) FILTER (NOT allowed), 0) AS BIGINT) AS in_network_rates_saved,
  CAST(coalesce(sum(saved) FILTER (allowed), 0) AS BIGINT) AS allowed_amount_rates_saved,
  CAST(coalesce(sum(parsed - saved) FILTER (NOT allowed), 0) AS BIGINT) AS in_network_rates_with_errors,
  CAST(coalesce(sum(parsed - saved) FILTER (allowed), 0) AS BIGINT) AS allowed_amount_rates_with_errors,
  CAST(sum(refs) AS BIGINT) AS providers_parsed, count(*) AS plans_parsed,
  CAST(sum(refs_saved) AS BIGINT) AS providers_saved, count(*) FILTER (o_custkey % 3 <> 0) AS plans_saved
FROM f GROUP BY job_id"""
ORACLE["job_throughput"] = with_(
    EVENTS,
    """
runs AS (
  SELECT job_id, CAST(sum(n_objects) AS BIGINT) AS n_objects,
         CAST(floor(epoch(max(status_time))) - floor(epoch(min(status_time))) AS BIGINT) AS seconds FROM ev GROUP BY 1)""",
    select="""SELECT job_id, n_objects, seconds,
  CASE WHEN seconds > 0 THEN CAST(n_objects AS DOUBLE) / CAST(seconds AS DOUBLE) END AS objects_per_second FROM runs""",
)
ORACLE["job_family"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' ELSE 'PENDING' END AS status,
  'p' || c_custkey AS parent_job_id, CASE WHEN c_acctbal < 0 THEN 'FAILED' ELSE 'COMPLETED' END AS parent_status
FROM orders JOIN customer ON o_custkey = c_custkey"""
ORACLE["job_source_company"] = """
SELECT c_custkey, n_nationkey AS source_id, n_name AS source_name, r_regionkey AS company_id, r_name AS company_name
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
ORACLE["company_sources"] = """
SELECT n_nationkey AS company_id, n_name AS company_name, c_custkey AS source_id, c_name AS source_name
FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey"""
ORACLE["parse_metrics"] = """
SELECT CAST(l_orderkey AS VARCHAR) AS file_id, count(*) AS objects_parsed, count(*) FILTER (l_returnflag <> 'R') AS objects_saved,
  count(*) FILTER (l_returnflag = 'R') AS objects_with_errors, count(*) FILTER (l_returnflag <> 'R') AS rates_saved,
  count(*) FILTER (l_returnflag <> 'R') AS providers_named
FROM lineitem GROUP BY 1"""
ORACLE["item_rejects"] = """
SELECT CAST(l_orderkey AS VARCHAR) AS file_id, CAST(l_linenumber AS BIGINT) AS item_no,
  '{"billing_code":"' || l_partkey || '","negotiated_rates":[{"negotiated_prices":[{"negotiated_rate":"bad"}],"provider_references":['
  || l_suppkey || ']}]}' AS text FROM lineitem WHERE l_returnflag = 'R'"""

# --- files -------------------------------------------------------------------------------

EXTRACTED = """
x AS (
  SELECT 'doc' || doc_id AS file_id, source AS job_id, CAST(strlen(text) AS BIGINT) AS file_size, sha256(text) AS file_hash,
         doc_id || '_' || CASE lang WHEN 'en' THEN 'in-network' WHEN 'fr' THEN 'Allowed-Amounts' ELSE 'x' END || '_' || source
         || CASE WHEN n_chars % 2 = 0 THEN '.json' ELSE '.v1.json.gz' END AS file_name,
         CASE lang WHEN 'en' THEN 'IN_NETWORK' WHEN 'fr' THEN 'ALLOWED_AMOUNT' ELSE 'UNKNOWN' END AS file_type,
         CASE WHEN n_chars % 2 = 0 THEN 'JSON' ELSE 'GZ' END AS file_extension,
         CASE WHEN n_chars % 2 = 0 THEN 'JSON' ELSE 'UNKNOWN' END AS extension_first_dot FROM documents)"""
ORACLE["file_manifest"] = with_(
    EXTRACTED,
    select=f"""SELECT {ident("ins_job_file", "job_id || chr(31) || file_id || chr(31) || file_name")} AS id, job_id, file_name,
  file_type, file_extension, file_size, file_hash FROM x""",
)
ORACLE["file_manifest_totals"] = with_(
    EXTRACTED, select="SELECT job_id, CAST(sum(file_size) AS BIGINT) AS total_bytes, count(*) AS n_files FROM x GROUP BY 1"
)
ORACLE["file_classify"] = with_(
    EXTRACTED, select="SELECT file_name, file_type, file_extension, extension_first_dot FROM x"
)
ORACLE["url_normalize"] = """
SELECT page_id, split_part(url, '?', 1) AS location,
  CASE WHEN suffix IN ('gz', 'gzip') THEN 'GZ' WHEN suffix = 'zip' THEN 'ZIP' WHEN suffix = 'json' THEN 'JSON' ELSE 'UNKNOWN' END AS file_extension
FROM (SELECT *, lower(string_split(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '.')[-1]) AS suffix FROM pages)"""
ORACLE["code_bucket"] = """
SELECT CAST(p_partkey AS VARCHAR) AS billing_code,
  CAST(('0x' || substr(sha256(CAST(p_partkey AS VARCHAR)), 1, 2)) AS INTEGER) AS bucket FROM part"""
ORACLE["zip_expand"] = """
SELECT 'doc' || doc_id || '.zip' AS file_id, 'in-network/' || doc_id || '.json' AS file_name,
  CAST(strlen(text) AS BIGINT) AS file_size, sha256(text) AS file_hash FROM documents
UNION ALL
SELECT 'doc' || doc_id || '.zip', 'about.txt', strlen(doc_id || ' ' || lang), sha256(doc_id || ' ' || lang) FROM documents"""
ORACLE["shred_items"] = """
SELECT CAST(p_partkey AS VARCHAR) AS billing_code, p_name || ' "{[\\' AS name, p_type AS billing_code_type, p_brand AS description,
  CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS negotiated_rate, '11,' || p_size AS service_code,
  p_size || ',' || (p_size + 1) AS provider_ids FROM part"""
WEEKS = """
w AS (
  SELECT strftime(date_trunc('week', l_shipdate), '%Y-%m-%d') AS week, weekofyear(l_shipdate) % 5 = 0 AS short,
         CAST(l_partkey AS VARCHAR) AS code, l_orderkey, l_linenumber FROM lineitem),
named AS (SELECT DISTINCT week, short FROM w)"""
ORACLE["shred_rejects"] = with_(
    WEEKS,
    select="""SELECT 'item' AS kind, code AS text FROM w WHERE NOT short AND l_linenumber < 7
UNION ALL SELECT 'item', week FROM named WHERE NOT short
UNION ALL SELECT 'reject', 'null' FROM named WHERE NOT short
UNION ALL SELECT 'reject', '["' || code || '"]' FROM w WHERE NOT short AND l_linenumber = 7
UNION ALL SELECT 'reject', '"' || code || '"' FROM w WHERE NOT short AND l_linenumber = 6
UNION ALL SELECT 'failed', 'the document ends too early or its brackets do not match' FROM named WHERE short""",
)
ORACLE["shred_headers"] = with_(
    WEEKS,
    select="""SELECT week AS plan_name, 'Insurer' AS reporting_entity_name, '1.0' AS version, CAST(NULL AS VARCHAR) AS issuer_name
FROM named WHERE NOT short""",
)
ORACLE["job_events"] = with_(
    WEEKS,
    select="""SELECT week AS job_id, status, '2002-01-01 0' || hour || ':00:00.000000' AS status_time,
  CASE WHEN status = 'FAILED' THEN 'the document ends too early or its brackets do not match' END AS reason
FROM named, (VALUES ('DOWNLOADING', 0), ('PARSING', 2), ('COMPLETED', 3), ('FAILED', 4)) v(status, hour)
WHERE hour < 3 OR short = (status = 'FAILED')""",
)
ORACLE["landed_manifest"] = with_(
    WEEKS,
    """
lines AS (
  SELECT week, 0 AS part, 0 AS l_orderkey, 0 AS l_linenumber, '{"reporting_entity_name":"Insurer","plan_name":"' || week
         || '","in_network":[null,{"billing_code":"' || week || '","negotiated_rates":[]}' AS line FROM named
  UNION ALL
  SELECT week, 1, l_orderkey, l_linenumber,
         CASE l_linenumber WHEN 6 THEN ',"' || code || '",{"billing_code":"' || code || '","negotiated_rates":[]}'
                           WHEN 7 THEN ',["' || code || '"]' ELSE ',{"billing_code":"' || code || '","negotiated_rates":[]}' END FROM w
  UNION ALL
  SELECT week, 2, 0, 0, '],"version":"1.0"}' FROM named WHERE NOT short),
content AS (SELECT week, string_agg(line, chr(10) ORDER BY part, l_orderkey, l_linenumber) || chr(10) AS body FROM lines GROUP BY week)""",
    select="""SELECT week AS job_id, 'UNKNOWN' AS file_type, CAST(strlen(body) AS BIGINT) AS file_size, sha256(body) AS file_hash FROM content""",
)
ORACLE["manifest_appends"] = ORACLE["file_manifest"]
ORACLE["job_appends"] = with_(
    *FILES,
    select="""SELECT 'ins_job_' || substr(sha256('ins_job_' || file_id || chr(31) || location), 1, 24) AS id, 'iss_1' AS source_id,
  'ins_job_' || file_id AS parent_job_id, 'PENDING' AS status, url AS file_url, file_extension, upper(file_type) AS file_type FROM files""",
)
ORACLE["stream_new_files"] = """
SELECT CAST(p_partkey AS VARCHAR) AS billing_code, p_brand AS description, p_size || ',' || (p_size + 1) AS provider_ids,
  1 AS n_prices FROM part"""

# --- list page ---------------------------------------------------------------------------

ORACLE["list_page"] = """
SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_name ILIKE '%customer#%'
ORDER BY c_acctbal, c_custkey LIMIT 10 OFFSET 30"""
ORACLE["list_page_deep"] = ORACLE["list_page"]
ORACLE["list_page_after"] = """
SELECT c_custkey, c_name, c_acctbal FROM customer
WHERE c_name ILIKE '%customer#%' AND (c_acctbal > 0 OR (c_acctbal = 0 AND c_custkey > -1))
ORDER BY c_acctbal, c_custkey LIMIT 10"""
ORACLE["list_counts"] = """
SELECT count(*) FILTER (c_acctbal > 5000) AS n_selected, count(*) AS n_rows FROM customer WHERE c_name ILIKE '%customer#%'"""
ORACLE["list_dates"] = "SELECT o_orderkey, strftime(o_orderdate, '%-m/%-d/%Y') AS created FROM orders"

# --- streams -----------------------------------------------------------------------------

ORACLE["stream_job_counters"] = """
SELECT CAST(user_id AS VARCHAR) AS job_id, event_type AS file_type,
  CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS n_bytes, count(*) AS n_files FROM events GROUP BY 1, 2"""
ORACLE["stream_job_states"] = ORACLE["job_latest_status"]
ORACLE["stream_trigger_dedupe"] = "SELECT DISTINCT user_id, event_type FROM events"
ORACLE["stream_rejects"] = """
SELECT topic, value, CASE WHEN shaped THEN CAST(user_id AS VARCHAR) END AS job_id, CASE WHEN shaped THEN props END AS payload,
  CASE WHEN topic = 'other' THEN 'unknown topic' WHEN event_type = 'view' THEN 'not a message'
       WHEN event_type = 'signup' THEN 'no job id' END AS reason,
  topic <> 'other' AND shaped AS accepted
FROM (SELECT * EXCLUDE (value), event_type NOT IN ('view', 'signup') AS shaped,
             CASE event_type WHEN 'click' THEN 'insurance-source-scan-jobs' WHEN 'error' THEN 'other' ELSE 'in-network-file' END AS topic,
             CASE event_type WHEN 'view' THEN substr(props, 1, 3) WHEN 'signup' THEN props
                  ELSE '{"id":"' || user_id || '","payload":"' || replace(props, '"', '\\"') || '"}' END AS value FROM events)"""
