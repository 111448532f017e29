"""Names and codes other systems write or expect, stated as they are."""

# States a scan job passes through.
JOB_STATUSES = ("PENDING", "DOWNLOADING", "PARSING", "COMPLETED", "DECOMPRESSING", "FAILED")
TERMINAL_STATUSES = ("COMPLETED", "FAILED")

# Order in which a job may move on; FAILED may follow any state.
NEXT_STATUSES = {
    "PENDING": ("DOWNLOADING", "FAILED"),
    "DOWNLOADING": ("DECOMPRESSING", "PARSING", "FAILED"),
    "DECOMPRESSING": ("PARSING", "FAILED"),
    "PARSING": ("COMPLETED", "FAILED"),
    "COMPLETED": ("PENDING",),
    "FAILED": ("PENDING",),
}

# File kinds and extensions.
FILE_TYPES = ("ALLOWED_AMOUNT", "IN_NETWORK", "TABLE_OF_CONTENTS", "UNKNOWN")
FILE_EXTENSIONS = ("ZIP", "JSON", "GZ", "UNKNOWN")
EXTENSION_BY_SUFFIX = {"gz": "GZ", "gzip": "GZ", "zip": "ZIP", "json": "JSON"}

# Plan id types and markets.
PLAN_ID_TYPES = ("EIN", "HIOS")
PLAN_MARKET_TYPES = ("INDIVIDUAL", "GROUP")

# Steps of a job.
STEP_TYPES = ("DOWNLOAD", "DECOMPRESS", "PARSE", "POST_PROCESS", "ANALYTICS")
STEP_STATUSES = ("PENDING", "IN_PROGRESS", "COMPLETED", "FAILED")

# Kinds of scan source, and the one kind whose index can be imported.
SOURCE_TYPES = (
    "INDEX_URL",
    "MANUAL",
    "CIGNA_INDEX_API",
    "KAISER_PERMANENTE_TXT_IN_NETWORK",
    "KAISER_PERMANENTE_TXT_OUT_OF_NETWORK",
    "UNITED_HEATHCARE_BLOB_API",
    "AETNA_BLOB_API",
    "HCSC_SCRAPER",
    "MOLINA_HEALTHCARE_SCRAPER",
)
HANDLED_SOURCE_TYPES = ("CIGNA_INDEX_API",)
LISTING_URL_OPTION = "cigna_page_url"
EMPTY_ALLOWED_AMOUNTS = "cigna-health-life-insurance-company_empty_allowed-amounts.json"

# Message topics, without any environment prefix.
TOPIC_TRIGGER = "insurance-source-scan-jobs"
TOPIC_IN_NETWORK = "in-network-file"
TOPIC_ALLOWED_AMOUNT = "allowed-amount"
TOPIC_RATES = "in-network-rates"
JOB_TOPICS = (TOPIC_TRIGGER, TOPIC_IN_NETWORK, TOPIC_ALLOWED_AMOUNT)

# Prefixes of generated ids.
ID_COMPANY = "ins"
ID_SOURCE = "iss"
ID_JOB = "ins_job"
ID_FILE = "ins_file"
ID_STEP = "ins_step"
ID_PLAN = "ins_plan"
ID_JOB_FILE = "ins_job_file"

#: Types of files that an index lists.
JOB_FILE_TYPES = ("IN_NETWORK", "ALLOWED_AMOUNT")

# Fixed value: files sent per lot.
DISPATCH_LOT = 100

# Small-int codes of the rate table (version 1, owned here: published files give words only).
BILLING_CLASS_CODES = {"professional": 1, "institutional": 2, "both": 3}
SETTING_CODES = {"inpatient": 1, "outpatient": 2, "both": 3}
