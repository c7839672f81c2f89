"""Names, patterns, codes and texts the results depend on.

Everything here is data of the event format, of the target table or of the
reports.  No logic lives in this file.  ``{destination}`` and ``{pipeline}`` in
the texts are filled in by the caller (the name of the target system and of the
event pipeline).
"""

# -- fixed values: columns of the events table, in table order -----------------
# Types: string, int, double, decimal(18,2), boolean, timestamp_ntz.
ATOMIC_COLUMNS = """
app_id string
platform string
etl_tstamp timestamp_ntz
collector_tstamp timestamp_ntz
dvce_created_tstamp timestamp_ntz
event string
event_id string
txn_id int
name_tracker string
v_tracker string
v_collector string
v_etl string
user_id string
user_ipaddress string
user_fingerprint string
domain_userid string
domain_sessionidx int
network_userid string
geo_country string
geo_region string
geo_city string
geo_zipcode string
geo_latitude double
geo_longitude double
geo_region_name string
ip_isp string
ip_organization string
ip_domain string
ip_netspeed string
page_url string
page_title string
page_referrer string
page_urlscheme string
page_urlhost string
page_urlport int
page_urlpath string
page_urlquery string
page_urlfragment string
refr_urlscheme string
refr_urlhost string
refr_urlport int
refr_urlpath string
refr_urlquery string
refr_urlfragment string
refr_medium string
refr_source string
refr_term string
mkt_medium string
mkt_source string
mkt_term string
mkt_content string
mkt_campaign string
se_category string
se_action string
se_label string
se_property string
se_value double
tr_orderid string
tr_affiliation string
tr_total decimal(18,2)
tr_tax decimal(18,2)
tr_shipping decimal(18,2)
tr_city string
tr_state string
tr_country string
ti_orderid string
ti_sku string
ti_name string
ti_category string
ti_price decimal(18,2)
ti_quantity int
pp_xoffset_min int
pp_xoffset_max int
pp_yoffset_min int
pp_yoffset_max int
useragent string
br_name string
br_family string
br_version string
br_type string
br_renderengine string
br_lang string
br_features_pdf boolean
br_features_flash boolean
br_features_java boolean
br_features_director boolean
br_features_quicktime boolean
br_features_realplayer boolean
br_features_windowsmedia boolean
br_features_gears boolean
br_features_silverlight boolean
br_cookies boolean
br_colordepth string
br_viewwidth int
br_viewheight int
os_name string
os_family string
os_manufacturer string
os_timezone string
dvce_type string
dvce_ismobile boolean
dvce_screenwidth int
dvce_screenheight int
doc_charset string
doc_width int
doc_height int
tr_currency string
tr_total_base decimal(18,2)
tr_tax_base decimal(18,2)
tr_shipping_base decimal(18,2)
ti_currency string
ti_price_base decimal(18,2)
base_currency string
geo_timezone string
mkt_clickid string
mkt_network string
etl_tags string
dvce_sent_tstamp timestamp_ntz
refr_domain_userid string
refr_dvce_tstamp timestamp_ntz
domain_sessionid string
derived_tstamp timestamp_ntz
event_vendor string
event_name string
event_format string
event_version string
event_fingerprint string
true_tstamp timestamp_ntz
"""

LOAD_COLUMN = "load_tstamp"
NOT_NULL_COLUMNS = ("collector_tstamp", "event_id", "v_collector", "v_etl")

# -- fixed values: the JSON fields of a line and the column each one follows ----
JSON_FIELDS = {
    "contexts": "mkt_campaign",
    "unstruct_event": "se_value",
    "derived_contexts": "refr_dvce_tstamp",
}
LINE_FIELD_COUNT = 131

# -- fixed values: entity columns ----------------------------------------------
UNSTRUCT_PREFIX = "unstruct_event_"
CONTEXTS_PREFIX = "contexts_"
UNSTRUCT_PATTERN = "^unstruct_event_.*$"
CONTEXTS_PATTERN = "^contexts_.*$"
SCHEMA_VERSION_KEY = "_schema_version"

# -- fixed values: write-failure codes that mean "the data is wrong" -------------
DATA_ISSUE_CODES = (
    "INVALID_VALUE_ROW",
    "INVALID_FORMAT_ROW",
    "MAX_ROW_SIZE_EXCEEDED",
    "UNKNOWN_DATA_TYPE",
    "NULL_VALUE",
    "NULL_OR_EMPTY_STRING",
)

# -- fixed values: error codes that mean "the target is set up wrongly" ----------
CLIENT_ERROR_CODES = (400, 499)
UNKNOWN_HOST_CODE = 513
SETUP_SQL_CODES = (2003, 2043, 3001, 3041)

# -- fixed values: patterns over error texts ------------------------------------
SQL_LINE_BREAK_PATTERN = ":? *\n"
SQL_LINE_BREAK_REPLACEMENT = ": "
SQL_COMPILATION_PATTERN = "^(?i)sql compilation error: *"
BODY_MESSAGE_PATTERN = '"message" *: *"([^"]*)"'
TABLE_TYPE_PATTERN = r"\A.*\bERR_TABLE_TYPE_NOT_SUPPORTED\b.*\z"

# -- fixed values: texts ----------------------------------------------------------
TABLE_TYPE_TEXT = (
    "Table must not be in a transient database or transient schema: "
    "{destination} streaming ingest SDK only supports permanent tables"
)
UNKNOWN_HOST_TEXT = "Unrecognized {destination} account name or host name"
UNAUTHORIZED_TEXT = (
    "Unauthorized: Invalid user name or invalid public/private key pair "
    "or mis-configured network policies"
)
ALERT_TEXTS = {
    "failed_to_connect": "Failed to connect to {destination}: %cause",
    "failed_to_show_tables": "Failed to SHOW tables in {destination} schema %db.%schema: %cause",
    "failed_to_create_events_table": "Failed to create table in schema %db.%schema: %cause",
    "failed_to_add_columns": "Failed to add columns: [%columns]. Cause: %cause",
    "failed_to_open_channel": "Failed to open {destination} channel: %cause",
    "failed_to_parse_private_key": "Failed to parse private key: %cause",
    "table_is_missing_atomic_column": (
        "Existing table is incompatible with {pipeline}: Missing required column %columns"
    ),
}
FAILED_EVENT_SINK_LABEL = "Failed event sink"
UNRECOGNIZED_COLUMN_TEXT = "Cannot alter table to add unrecognized column "

# -- fixed values: metric names ---------------------------------------------------
METRIC_GOOD = "events_good"
METRIC_BAD = "events_bad"
METRIC_LATENCY = "latency_millis"
METRIC_E2E_LATENCY = "e2e_latency_millis"

# -- fixed values: defaults of the job options --------------------------------------
DEFAULT_MAX_BATCH_BYTES = 16_000_000
DEFAULT_MAX_BATCH_DELAY = "1 second"
DEFAULT_CPU_FACTOR = "0.75"
DEFAULT_UNHEALTHY_LATENCY_MS = 300_000
DEFAULT_METRICS_PERIOD = "1 minute"
DEFAULT_MAX_RECORDS_PER_FETCH = 1000
MAX_FAILED_EVENT_BYTES = {"kafka": 1_000_000, "kinesis": 1_000_000, "pubsub": 10_000_000}
SINK_LIMITS = {
    "kinesis": {"records": 500, "bytes": 5_242_880},
    "pubsub": {"records": 100, "bytes": 1_000_000},
}
