"""Explicit schemas of the input documents, messages and tables, as DDL strings."""

PLAN = (
    "STRUCT<plan_name: STRING, plan_id_type: STRING, plan_id: STRING, "
    "plan_sponsor_name: STRING, plan_market_type: STRING>"
)
LOCATION = "STRUCT<location: STRING>"

# One element of a table-of-contents index.
STRUCTURE = (
    f"reporting_plans ARRAY<{PLAN}>, in_network_files ARRAY<{LOCATION}>, "
    f"allowed_amount_file {LOCATION}"
)
TOC = (
    f"reporting_structure ARRAY<STRUCT<reporting_plans: ARRAY<{PLAN}>, "
    f"in_network_files: ARRAY<{LOCATION}>, allowed_amount_file: {LOCATION}>>"
)
LISTING = "mrfs ARRAY<STRUCT<files: ARRAY<STRUCT<url: STRING>>>>"

CODE = (
    "STRUCT<billing_code_type: STRING, billing_code_type_version: STRING, "
    "billing_code: STRING, description: STRING>"
)
PRICE = (
    "STRUCT<negotiated_type: STRING, negotiated_rate: DECIMAL(18,4), expiration_date: STRING, "
    "service_code: ARRAY<STRING>, billing_class: STRING, setting: STRING, "
    "billing_code_modifier: ARRAY<STRING>, additional_information: STRING>"
)
TAX_ID = "STRUCT<type: STRING, value: STRING, business_name: STRING>"
# Files name the tax id `tins` or `tin`.
MEMBER = f"STRUCT<npi: ARRAY<BIGINT>, tins: {TAX_ID}, tin: {TAX_ID}>"
# A rate names provider references, or brings the members of its own group.
RATE = f"STRUCT<negotiated_prices: ARRAY<{PRICE}>, provider_references: ARRAY<BIGINT>, provider_groups: ARRAY<{MEMBER}>>"

# One element of the in_network array.
ITEM = (
    "negotiation_arrangement STRING, name STRING, billing_code_type STRING, "
    "billing_code_type_version STRING, severity_of_illness STRING, billing_code STRING, "
    f"description STRING, negotiated_rates ARRAY<{RATE}>, bundled_codes ARRAY<{CODE}>, "
    f"covered_services ARRAY<{CODE}>"
)

# One element of the provider_references array.
PROVIDER_REFERENCE = (
    f"provider_group_id BIGINT, network_name STRING, provider_groups ARRAY<{MEMBER}>"
)

HEADER_FIELDS = (
    "reporting_entity_name",
    "reporting_entity_type",
    "issuer_name",
    "plan_name",
    "plan_id_type",
    "plan_id",
    "plan_sponsor_name",
    "plan_market_type",
    "version",
)
HEADER = ", ".join(f"{name} STRING" for name in HEADER_FIELDS)

JOB_MESSAGE = "id STRING, payload STRING"
FILE_PAYLOAD = (
    "sourceType STRING, url STRING, reportingPlans ARRAY<STRING>, "
    "insuranceCompanyId STRING, insuranceImportSourceId STRING"
)

PLANS_TABLE = (
    "id STRING, plan_name STRING, plan_id_type STRING, plan_id STRING, plan_sponsor_name STRING, "
    "plan_market_type STRING, plan_first_seen TIMESTAMP, plan_last_seen TIMESTAMP, "
    "plan_active BOOLEAN, insurance_company_id STRING, insurance_plan_hash STRING"
)
FILE_MANIFEST_TABLE = (
    "id STRING, job_id STRING, file_name STRING, file_type STRING, file_extension STRING, "
    "file_size BIGINT, file_hash STRING"
)
PROCEDURE_RATE_TABLE = (
    "procedure_hash STRING, negotiated_rate DECIMAL(18,4), expiration_date DATE, "
    "billing_code STRING, service_code ARRAY<TINYINT>, billing_class TINYINT, setting TINYINT, "
    "billing_code_modifier ARRAY<STRING>, first_seen_date DATE, last_seen_date DATE"
)
PROVIDER_RATE_TABLE = (
    "provider_group_id STRING, zip_code STRING, region_code BIGINT, insurance_plan_id STRING, "
    "billing_code_id STRING, procedure_hash STRING, first_seen_date DATE, last_seen_date DATE"
)
