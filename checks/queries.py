"""One query per operator, over the whole ``events`` table, with its answer in DuckDB SQL.

Unless an operator works on the text of the lines itself, the SQL computes the answer from the
``events`` table directly.  Times and decimals are compared as texts, JSON in canonical form.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from checks import fixtures as fx
from rillet import configure
from rillet.constants import FAILED_EVENT_SINK_LABEL
from rillet.functions.alerts import alert_text, qualified_name
from rillet.functions.casts import blank_as_null, decimal_value, typed_value
from rillet.functions.entities import contexts_column_name, unstruct_column_name
from rillet.functions.errors import error_class, is_data_issue, setup_error_message
from rillet.functions.jsons import drop_null_members, plain_numbers
from rillet.functions.latency import latency_ms
from rillet.functions.texts import clean_error_text, friendly_message, utf8_payload
from rillet.operators.bad_rows import Processor, limit_size, sink_groups, unreadable_events, unwritable_events
from rillet.operators.batches import assign_batches, merge_rollups, round_robin
from rillet.operators.conform import TableRules, conformed
from rillet.operators.failures import failures_with_events, written_rows
from rillet.operators.health import alerts, health_report as service_report
from rillet.operators.metrics import good_bad_counts, health_status, metrics_report
from rillet.operators.parse import parse_lines, split_good_bad
from rillet.operators.route import extra_columns, missing_columns, route_columns
from rillet.operators.transform import entity_columns, transform_events, wide_rows
from rillet.operators.validate import failure_outcome, row_validators, validate_rows
from rillet.plans.load_batch import FatalWriteError, LoadOptions, load_batch
from rillet.plans.load_once import load_once
from rillet.plans.load_report import line_chunks, load_report
from rillet.schema import ATOMIC_NAMES
from rillet.session import shared_folder
from rillet.sinks.failed_events import FailedEventSink
from rillet.sinks.ledger import Ledger, batch_metrics, create_tables
from rillet.sinks.table import add_columns, append_rows, create_events_table, evolve_table, table_exists
from rillet.sources.lines import read_lines, since
from rillet.streaming.loader import load_stream
from rillet.streaming.metrics import roll_up, stored_batches

MAX_BATCH_BYTES = 100_000
SKIP = ["x:org.demo/session_ctx/jsonschema/2-*-*", "x:com.acme/click/jsonschema/2-0-0"]
ENTITY_COLUMNS = sorted(
    [f"unstruct_event_com_acme_{kind}_{model}" for kind in ("click", "error", "purchase", "signup", "view") for model in (1, 2)]
    + ["contexts_com_acme_web_page_1", "contexts_org_demo_session_ctx_2"]
)

QUERIES, ORACLES = {}, {}


def query(sql: str | None):
    """Register a query under its name, with the SQL that gives the same rows."""

    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(configure(spark), sf_dir)

        QUERIES[function.__name__] = run
        if sql is not None:
            ORACLES[function.__name__] = _WITH + sql
        return function

    return register


_WITH = f"""WITH e AS (SELECT *, {fx.K} AS k, {fx.PAGES} AS n_pages, {fx.DUCKDB['millis']} AS millis, date_trunc('millisecond', ts) AS ms FROM events),
parsed AS (SELECT * FROM e WHERE k NOT IN (71, 83, 89, 97)),
good AS (SELECT * FROM parsed WHERE k NOT IN (73, 79)),
lines AS ({fx.duckdb_table('lines')}),
failures AS ({fx.duckdb_table('failures')}),
reports AS ({fx.duckdb_table('reports')}),
errors AS ({fx.duckdb_table('errors')}),
batch_metrics AS ({fx.duckdb_table('metrics')}),
alerts AS ({fx.duckdb_table('alerts')}),
chunks AS (SELECT src_partition, src_id // {fx.CHUNK_RECORDS} AS chunk_id, count(*) AS n,
  CAST(sum(CASE WHEN k NOT IN (71, 73, 79, 83, 89, 97) THEN 1 ELSE 0 END) AS BIGINT) AS good,
  CAST(sum(strlen(lines.value)) AS BIGINT) AS bytes, min(CASE WHEN k NOT IN (71, 83, 89, 97) THEN ms END) AS earliest
  FROM lines JOIN e ON src_id = event_id GROUP BY 1, 2),
assigned AS (SELECT *, CAST(floor((sum(bytes) OVER (PARTITION BY src_partition ORDER BY chunk_id) - bytes) / {MAX_BATCH_BYTES}) AS BIGINT)
  AS batch_id FROM chunks)
"""


def _text(column: str):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSS").alias(column)


def _parsed(spark, sf_dir):
    return parse_lines(fx.enriched_lines(spark, sf_dir))


def _rows(spark, sf_dir):
    return transform_events(_parsed(spark, sf_dir), fx.NOW)


def _good(spark, sf_dir):
    return _rows(spark, sf_dir).filter("transform_ok")


def _literal_names(spark, names):
    return spark.createDataFrame([(name,) for name in names], "name string")


# -- sources ------------------------------------------------------------------------


@query("SELECT src_id, src_partition, strlen(value) AS bytes, value LIKE 'nonsense%' AS nonsense FROM lines")
def src_lines(spark, sf_dir):
    return fx.enriched_lines(spark, sf_dir).selectExpr(
        "src_id", "src_partition", "CAST(octet_length(value) AS BIGINT) AS bytes", "startswith(value, 'nonsense') AS nonsense"
    )


@query("SELECT event_id AS src_id, event_type FROM e WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'")
def src_at_timestamp(spark, sf_dir):
    columns = {"src_id": "event_id", "src_partition": "user_id % 8", "src_ts": "ts", "value": "event_type"}
    lines = read_lines(spark, "parquet", {}, columns=columns, path=f"{sf_dir}/events.parquet")
    start = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    return since(lines, start).select("src_id", F.col("value").alias("event_type"))


# -- parsing and transforming ---------------------------------------------------------


@query("""SELECT event_id AS src_id, concat('app', CAST(user_id % 5 AS VARCHAR)) AS app_id, millis AS collector_tstamp,
concat('00000000-0000-4000-8000-', lpad(CAST(event_id AS VARCHAR), 12, '0')) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
event_id % 20 AS domain_sessionidx, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS tr_total FROM parsed""")
def parse_events(spark, sf_dir):
    return (
        _parsed(spark, sf_dir)
        .filter("parse_ok")
        .select(
            "src_id", "app_id", _text("collector_tstamp"), "event_id", "user_id",
            F.col("domain_sessionidx").cast("bigint").alias("domain_sessionidx"),
            F.col("tr_total").cast("string").alias("tr_total"),
        )
    )


@query("""SELECT event_id AS src_id, CASE k WHEN 97 THEN 'NotTSV' ELSE 'RowDecodingError' END AS type,
CASE k WHEN 97 THEN 1 ELSE 131 END AS field_count,
CASE k WHEN 97 THEN '' WHEN 89 THEN 'domain_sessionidx is not a valid int' ELSE 'contexts is not valid self-describing JSON' END AS reasons
FROM e WHERE k IN (71, 83, 89, 97)""")
def parse_failures(spark, sf_dir):
    reasons = F.transform("parse_error.fields", lambda f: F.concat_ws(" ", f["field"], f["message"]))
    return (
        _parsed(spark, sf_dir)
        .filter(~F.col("parse_ok"))
        .select("src_id", "parse_error.type", F.col("parse_error.field_count").alias("field_count"),
                F.coalesce(F.array_join(reasons, "; "), F.lit("")).alias("reasons"))
    )


@query("""SELECT event_id AS src_id, concat('app', CAST(user_id % 5 AS VARCHAR)) AS app_id, millis AS collector_tstamp,
concat('unstruct_event_com_acme_', event_type, '_', CAST(1 + event_id % 2 AS VARCHAR)) AS unstruct_name,
concat('{"k":', CAST(k AS VARCHAR), '}') AS unstruct_value, (CASE WHEN n_pages > 0 THEN 1 ELSE 0 END) + (CASE WHEN n_pages = 2 THEN 1 ELSE 0 END) AS context_columns,
'2024-12-31 00:00:00.000' AS load_tstamp FROM good""")
def transform_rows(spark, sf_dir):
    return _good(spark, sf_dir).select(
        "src_id", "app_id", _text("collector_tstamp"), "unstruct_name", F.to_json("unstruct_value").alias("unstruct_value"),
        F.coalesce(F.size("contexts"), F.lit(0)).alias("context_columns"), _text("load_tstamp"),
    )


# The inventory's name for the query above.
QUERIES["transform_events"] = QUERIES.pop("transform_rows")
ORACLES["transform_events"] = ORACLES.pop("transform_rows")


@query("SELECT event_id AS src_id, '2024-12-31 00:00:00.000' AS load_tstamp FROM e")
def with_load_tstamp(spark, sf_dir):
    return _rows(spark, sf_dir).select("src_id", _text("load_tstamp"))


@query("""SELECT event_id AS src_id, 'not a schema key' AS message, 'no key' AS schema FROM parsed WHERE k = 79
UNION ALL SELECT event_id, 'entity data is not an object', 'x:com.acme/oops/jsonschema/1-0-0' FROM parsed WHERE k = 79
UNION ALL SELECT event_id, 'a number is out of range', 'x:com.acme/big/jsonschema/1-0-0' FROM parsed WHERE k = 73""")
def transform_failures(spark, sf_dir):
    return _rows(spark, sf_dir).filter("parse_ok AND NOT transform_ok").selectExpr("src_id", "inline(transform_error)")


@query("SELECT CASE WHEN k IN (71, 73, 79, 83, 89, 97) THEN 'bad' ELSE 'good' END AS side, count(*) AS n FROM e GROUP BY 1")
def split_good_bad_rows(spark, sf_dir):
    good, bad = split_good_bad(_rows(spark, sf_dir), F.col("transform_ok"))
    sides = good.select(F.lit("good").alias("side")).unionAll(bad.select(F.lit("bad").alias("side")))
    return sides.groupBy("side").agg(F.count(F.lit(1)).alias("n"))


QUERIES["split_good_bad"] = QUERIES.pop("split_good_bad_rows")
ORACLES["split_good_bad"] = ORACLES.pop("split_good_bad_rows")


@query("""SELECT event_id AS src_id, concat('unstruct_event_com_acme_', event_type, '_', CAST(1 + event_id % 2 AS VARCHAR)) AS name,
CAST(k AS BIGINT) AS k FROM good""")
def unstruct_columns(spark, sf_dir):
    return _good(spark, sf_dir).select(
        "src_id", F.col("unstruct_name").alias("name"), F.variant_get("unstruct_value", "$.k", "bigint").alias("k")
    )


_EXACT = fx.EXACT.format(text="VARCHAR")


@query(f"""SELECT event_id AS src_id, 'contexts_com_acme_web_page_1' AS name, CAST(n_pages AS BIGINT) AS entities,
concat('[{{"_schema_version":"1-0-0","id":', CAST(event_id AS VARCHAR), {_EXACT}, CASE n_pages WHEN 2
  THEN concat('}},{{"_schema_version":"1-0-0","id":', CAST(event_id + 1 AS VARCHAR), ',"note":"n"}}]') ELSE '}}]' END) AS value FROM good WHERE n_pages > 0
UNION ALL SELECT event_id, 'contexts_org_demo_session_ctx_2', 1, concat('[{{"_schema_version":"2-0-1","s":', CAST(user_id AS VARCHAR), '}}]')
FROM good WHERE n_pages = 2""")
def context_columns(spark, sf_dir):
    exploded = _good(spark, sf_dir).select("src_id", F.explode_outer("contexts").alias("name", "value"))
    return exploded.filter("name IS NOT NULL").select(
        "src_id", "name", F.size("value").cast("bigint").alias("entities"), F.to_json("value").alias("value")
    )


def _wide_oracle(source: str) -> str:
    columns = []
    for name in ENTITY_COLUMNS:
        if name.startswith("unstruct"):
            kind, model = name.split("_")[-2:]
            columns.append(
                f"""CASE WHEN event_type = '{kind}' AND 1 + event_id % 2 = {model}
                THEN concat('{{"k":', CAST(k AS VARCHAR), '}}') ELSE '' END AS {name}"""
            )
    columns.append(f"""CASE n_pages WHEN 0 THEN '' WHEN 1 THEN concat('[{{"_schema_version":"1-0-0","id":', CAST(event_id AS VARCHAR), {_EXACT}, '}}]')
      ELSE concat('[{{"_schema_version":"1-0-0","id":', CAST(event_id AS VARCHAR), {_EXACT}, '}},{{"_schema_version":"1-0-0","id":',
      CAST(event_id + 1 AS VARCHAR), ',"note":"n"}}]') END AS contexts_com_acme_web_page_1""")
    columns.append("""CASE n_pages WHEN 2 THEN concat('[{"_schema_version":"2-0-1","s":', CAST(user_id AS VARCHAR), '}]') ELSE '' END
      AS contexts_org_demo_session_ctx_2""")
    return f"""SELECT concat('00000000-0000-4000-8000-', lpad(CAST(event_id AS VARCHAR), 12, '0')) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
      millis AS collector_tstamp, '2024-12-31 00:00:00.000' AS load_tstamp, {', '.join(columns)} FROM {source}"""


def _wide_texts(wide):
    return wide.select(
        "event_id", "user_id", _text("collector_tstamp"), _text("load_tstamp"),
        *[F.coalesce(F.to_json(name), F.lit("")).alias(name) for name in ENTITY_COLUMNS],
    )


def _wide_rows_query(spark, sf_dir):
    rows = _good(spark, sf_dir)
    names = [row["name"] for row in entity_columns(rows).collect()]
    return _wide_texts(wide_rows(rows, sorted(names)))


_wide_rows_query.__name__ = "wide_rows"
query(_wide_oracle("good"))(_wide_rows_query)


@query("""SELECT event_id AS src_id, CASE WHEN event_type = 'click' AND event_id % 2 = 1 THEN ''
ELSE concat('unstruct_event_com_acme_', event_type, '_', CAST(1 + event_id % 2 AS VARCHAR)) END AS unstruct_name,
CASE WHEN n_pages > 0 THEN 'contexts_com_acme_web_page_1' ELSE '' END AS context_names FROM good""")
def skip_schemas(spark, sf_dir):
    rows = transform_events(_parsed(spark, sf_dir), fx.NOW, skip=SKIP).filter("transform_ok")
    return rows.select(
        "src_id", F.coalesce("unstruct_name", F.lit("")).alias("unstruct_name"),
        F.coalesce(F.array_join("context_names", ","), F.lit("")).alias("context_names"),
    )


@query("""SELECT event_id, concat('unstruct_event_com_acme_sub_', event_type, '_link_click_', CAST(k AS VARCHAR)) AS unstruct_name,
concat('contexts_org_x_', event_type, '_1') AS contexts_name FROM e""")
def entity_column_name(spark, sf_dir):
    events = fx.events(spark, sf_dir)
    keys = events.selectExpr(
        "event_id",
        f"concat('x:com.acme-sub.', event_type, '/linkClick/jsonschema/', {fx.K}, '-0-1') AS event_key",
        "concat('x:org.X/', event_type, '/jsonschema/1-2-', user_id) AS context_key",
    )
    return keys.selectExpr(
        "event_id",
        f"{unstruct_column_name('event_key')} AS unstruct_name",
        f"{contexts_column_name('context_key')} AS contexts_name",
    )


# -- write failures -------------------------------------------------------------------


@query("""SELECT row_index, error_code, error_code <> 'INTERNAL_ERROR' AS data_issue FROM reports""")
def classify_failures(spark, sf_dir):
    return fx.spark_table(spark, sf_dir, "reports").select(
        "row_index", "error_code", is_data_issue(F.col("error_code")).alias("data_issue")
    )


@query("""SELECT batch_id, row_index, CASE WHEN len(extra_cols) > 0 THEN 'evolve' WHEN error_code = 'INTERNAL_ERROR' THEN 'fatal' ELSE 'bad' END
AS outcome FROM reports""")
def failure_outcomes(spark, sf_dir):
    return fx.spark_table(spark, sf_dir, "reports").select(
        "batch_id", "row_index", failure_outcome(F.col("extra_cols"), F.col("error_code")).alias("outcome")
    )


QUERIES["failure_outcome"] = QUERIES.pop("failure_outcomes")
ORACLES["failure_outcome"] = ORACLES.pop("failure_outcomes")


def _extra_columns(spark, sf_dir):
    return extra_columns(fx.spark_table(spark, sf_dir, "reports"))


_extra_columns.__name__ = "extra_columns"
query("SELECT DISTINCT unnest(extra_cols) AS name FROM reports")(_extra_columns)


def _route_columns(spark, sf_dir):
    routed = route_columns(_extra_columns(spark, sf_dir))
    return routed.withColumn("column_type", F.coalesce("column_type", F.lit("")))


_route_columns.__name__ = "route_columns"
query("""SELECT name, CASE WHEN name LIKE 'unstruct_event_%' THEN 'object' WHEN name LIKE 'contexts_%' THEN 'array'
WHEN name = 'geo_city' THEN 'missing_atomic' ELSE 'unrecognized' END AS route,
CASE WHEN name LIKE 'unstruct_event_%' THEN 'variant' WHEN name LIKE 'contexts_%' THEN 'array<variant>' ELSE '' END AS column_type
FROM (SELECT DISTINCT unnest(extra_cols) AS name FROM reports)""")(_route_columns)


def _keyed_lines(spark, sf_dir):
    return fx.enriched_lines(spark, sf_dir).selectExpr("src_partition AS batch_id", "src_id AS row_index", "src_ts", "value")


def _failures_with_events(spark, sf_dir):
    joined = failures_with_events(_keyed_lines(spark, sf_dir), fx.spark_table(spark, sf_dir, "failures"))
    return joined.selectExpr("batch_id", "row_index", "error_code", "message", "CAST(octet_length(value) AS BIGINT) AS bytes")


_failures_with_events.__name__ = "failures_with_events"
query("""SELECT batch_id, row_index, error_code, message, strlen(value) AS bytes FROM lines JOIN failures
ON batch_id = src_partition AND row_index = src_id""")(_failures_with_events)


def _written_rows(spark, sf_dir):
    return written_rows(_keyed_lines(spark, sf_dir), fx.spark_table(spark, sf_dir, "failures")).select("batch_id", "row_index")


_written_rows.__name__ = "written_rows"
query("SELECT user_id % 8 AS batch_id, event_id AS row_index FROM e WHERE event_type <> 'error'")(_written_rows)


def _missing_columns(spark, sf_dir):
    table = _literal_names(spark, [*ATOMIC_NAMES, "load_tstamp", "contexts_com_acme_web_page_1"])
    return missing_columns(entity_columns(_rows(spark, sf_dir)), table)


_missing_columns.__name__ = "missing_columns"
query("""SELECT DISTINCT concat('unstruct_event_com_acme_', event_type, '_', CAST(1 + event_id % 2 AS VARCHAR)) AS name FROM good
UNION SELECT 'contexts_org_demo_session_ctx_2' FROM good WHERE n_pages = 2""")(_missing_columns)


def _validate_rows(spark, sf_dir):
    # Rows whose values were lost on the way: no tracker version for views, no time for sign-ups.
    rows = _good(spark, sf_dir)
    damaged = rows.withColumns({
        "v_etl": F.when(~F.contains("unstruct_name", F.lit("_view_")), F.col("v_etl")),
        "collector_tstamp": F.when(~F.contains("unstruct_name", F.lit("_signup_")), F.col("collector_tstamp")),
    })
    checks = row_validators(700, [(F.col("tr_total") > 300, "INVALID_VALUE_ROW", "The total is too high")])
    checked = validate_rows(damaged, checks)
    return checked.select(
        "src_id", F.coalesce("error_code", F.lit("")).alias("error_code"), F.coalesce("error_message", F.lit("")).alias("error_message")
    )


_validate_rows.__name__ = "validate_rows"
query("""SELECT src_id, CASE WHEN event_type IN ('view', 'signup') THEN 'NULL_VALUE' WHEN strlen(lines.value) > 700 THEN 'MAX_ROW_SIZE_EXCEEDED'
WHEN CAST(good.value AS DECIMAL(18,2)) > 300 THEN 'INVALID_VALUE_ROW' ELSE '' END AS error_code,
CASE WHEN event_type = 'view' THEN 'Missing a value for column v_etl' WHEN event_type = 'signup' THEN 'Missing a value for column collector_tstamp'
WHEN strlen(lines.value) > 700 THEN 'The row is too large' WHEN CAST(good.value AS DECIMAL(18,2)) > 300 THEN 'The total is too high' ELSE '' END AS error_message
FROM good JOIN lines ON src_id = event_id""")(_validate_rows)


# -- failed events ----------------------------------------------------------------------

_PROCESSOR = Processor()


def _bad_rows(spark, sf_dir):
    keep = ["src_partition", "src_id"]
    unreadable = unreadable_events(_rows(spark, sf_dir), _PROCESSOR, keep)
    failures = fx.spark_table(spark, sf_dir, "failures")
    failed = failures.filter(failure_outcome(F.col("extra_cols"), F.col("error_code")) == "bad")
    joined = failures_with_events(_keyed_lines(spark, sf_dir), failed).withColumnsRenamed(
        {"batch_id": "src_partition", "row_index": "src_id"}
    )
    return unreadable.unionByName(unwritable_events(joined, F.col("message"), _PROCESSOR, keep))


_BAD_SQL = """, unreadable AS (SELECT src_partition, src_id, lines.value AS payload,
  CASE WHEN k IN (73, 79) THEN 'loader_transform_error' ELSE 'loader_parsing_error' END AS kind,
  CASE k WHEN 79 THEN '[{"message":"not a schema key","schema":"no key"},{"message":"entity data is not an object","schema":"x:com.acme/oops/jsonschema/1-0-0"}]'
  WHEN 73 THEN '[{"message":"a number is out of range","schema":"x:com.acme/big/jsonschema/1-0-0"}]' WHEN 97 THEN '{"type":"NotTSV","field_count":1}'
  WHEN 89 THEN '{"type":"RowDecodingError","field_count":131,"fields":[{"field":"domain_sessionidx","value":"abc","message":"is not a valid int"}]}'
  ELSE concat('{"type":"RowDecodingError","field_count":131,"fields":[{"field":"contexts","value":', CAST(to_json(split_part(lines.value, chr(9), 53)) AS VARCHAR),
    ',"message":"is not valid self-describing JSON"}]}') END AS failure
  FROM lines JOIN e ON src_id = event_id WHERE k IN (71, 73, 79, 83, 89, 97)),
unwritable AS (SELECT src_partition, src_id, value AS payload, 'loader_runtime_error' AS kind, message AS failure
  FROM lines JOIN failures ON batch_id = src_partition AND row_index = src_id WHERE len(extra_cols) = 0 AND error_code <> 'INTERNAL_ERROR'),
bad AS (SELECT src_partition, src_id, kind, 'rillet' AS processor_name, '0.1.0' AS processor_version, failure, payload,
  concat('{"schema":"self:org.example.failed_events/', kind, '/jsonschema/1-0-0","data":{"processor":{"artifact":"rillet","version":"0.1.0"},"failure":',
    CASE kind WHEN 'loader_runtime_error' THEN CAST(to_json(failure) AS VARCHAR) ELSE failure END, ',"payload":', CAST(to_json(payload) AS VARCHAR), '}}') AS json
  FROM (SELECT * FROM unreadable UNION ALL SELECT src_partition, src_id, payload, kind, failure FROM unwritable))
"""
_bad_rows.__name__ = "bad_rows"
query(_BAD_SQL + "SELECT * FROM bad")(_bad_rows)


@query(_BAD_SQL + """SELECT src_id, CASE WHEN strlen(json) > 800 THEN 'size_violation' ELSE kind END AS kind,
CASE WHEN strlen(json) > 800 THEN concat('{"maximumAllowedSizeBytes":800,"actualSizeBytes":', CAST(strlen(json) AS VARCHAR), ',"expectation":"', kind, '"}')
ELSE failure END AS failure, CASE WHEN strlen(json) > 800 THEN left(payload, 80) ELSE payload END AS payload FROM bad""")
def bad_row_size_limit(spark, sf_dir):
    return limit_size(_bad_rows(spark, sf_dir), 800, _PROCESSOR).select("src_id", "kind", "failure", "payload")


@query(_BAD_SQL + """, one AS (SELECT *, row_number() OVER (PARTITION BY src_partition, src_id ORDER BY kind) AS nth FROM bad)
SELECT src_partition, src_id, strlen(json) AS bytes,
CAST(floor((row_number() OVER w - 1) / 20) AS BIGINT) AS record_group,
CAST(floor((sum(strlen(json)) OVER w - strlen(json)) / 10000) AS BIGINT) AS byte_group
FROM one WHERE kind <> 'loader_runtime_error' WINDOW w AS (PARTITION BY src_partition ORDER BY src_id)""")
def bad_sink_groups(spark, sf_dir):
    unreadable = unreadable_events(_rows(spark, sf_dir), _PROCESSOR, ["src_partition", "src_id"])
    return sink_groups(unreadable, 20, 10_000).select("src_partition", "src_id", "bytes", "record_group", "byte_group")


# -- batches and metrics ------------------------------------------------------------------


def _chunks(spark, sf_dir):
    return line_chunks(fx.enriched_lines(spark, sf_dir), fx.NOW, fx.CHUNK_RECORDS)


def _assigned(spark, sf_dir):
    return assign_batches(_chunks(spark, sf_dir), MAX_BATCH_BYTES)


@query("""SELECT src_partition, chunk_id, n, good, bytes, strftime(earliest, '%Y-%m-%d %H:%M:%S.%g') AS earliest FROM chunks""")
def batch_rollup(spark, sf_dir):
    return _chunks(spark, sf_dir).select("src_partition", "chunk_id", "n", "good", "bytes", _text("earliest"))


def _assign_batches(spark, sf_dir):
    return _assigned(spark, sf_dir).select("src_partition", "chunk_id", "bytes", "batch_id")


_assign_batches.__name__ = "assign_batches"
query("SELECT src_partition, chunk_id, bytes, batch_id FROM assigned")(_assign_batches)


_UNIT_RECORDS = 150


@query(f"""SELECT * FROM (WITH RECURSIVE units AS (
  SELECT src_partition, src_id // {_UNIT_RECORDS} AS chunk, CASE WHEN strlen(lines.value) > {MAX_BATCH_BYTES // _UNIT_RECORDS} THEN src_id END AS line,
    min(src_id) AS unit, count(*) AS n, CAST(sum(CASE WHEN k NOT IN (71, 73, 79, 83, 89, 97) THEN 1 ELSE 0 END) AS BIGINT) AS good,
    CAST(sum(strlen(lines.value)) AS BIGINT) AS bytes, min(CASE WHEN k NOT IN (71, 83, 89, 97) THEN ms END) AS earliest
  FROM lines JOIN e ON src_id = event_id GROUP BY 1, 2, 3),
sums AS (SELECT *, sum(bytes) OVER (PARTITION BY src_partition ORDER BY unit) AS upto FROM units),
starts AS (SELECT src_partition, 0 AS batch_id, min(unit) AS unit, CAST(0 AS HUGEINT) AS before FROM sums GROUP BY 1
  UNION ALL SELECT s.src_partition, s.batch_id + 1, min(u.unit), min(u.upto - u.bytes) FROM starts s JOIN sums u
    ON s.src_partition = u.src_partition AND u.unit > s.unit AND u.upto > s.before + {MAX_BATCH_BYTES} GROUP BY s.src_partition, s.batch_id)
SELECT u.src_partition, CAST(s.batch_id AS BIGINT) AS batch_id, CAST(sum(n) AS BIGINT) AS n, CAST(sum(good) AS BIGINT) AS good,
  CAST(sum(n) - sum(good) AS BIGINT) AS bad, CAST(sum(bytes) AS BIGINT) AS bytes, strftime(min(earliest), '%Y-%m-%d %H:%M:%S.%g') AS earliest
FROM sums u ASOF JOIN starts s ON u.src_partition = s.src_partition AND u.unit >= s.unit GROUP BY 1, 2)""")
def bounded_batches(spark, sf_dir):
    """Batches that end before the limit, of units of lines."""
    report = load_report(fx.enriched_lines(spark, sf_dir), fx.NOW, MAX_BATCH_BYTES, _UNIT_RECORDS, bounded=True)
    return report.select("src_partition", "batch_id", "n", "good", "bad", "bytes", _text("earliest"))


def _merge_rollups(spark, sf_dir):
    merged = merge_rollups(_assigned(spark, sf_dir), "src_partition", "batch_id")
    return merged.select("src_partition", "batch_id", "n", "good", "bad", "bytes", _text("earliest"))


_merge_rollups.__name__ = "merge_rollups"
query("""SELECT src_partition, batch_id, CAST(sum(n) AS BIGINT) AS n, CAST(sum(good) AS BIGINT) AS good, CAST(sum(n) - sum(good) AS BIGINT) AS bad,
CAST(sum(bytes) AS BIGINT) AS bytes, strftime(min(earliest), '%Y-%m-%d %H:%M:%S.%g') AS earliest FROM assigned GROUP BY 1, 2""")(_merge_rollups)


def flagship(spark, sf_dir):
    """Per source partition and batch: counts, bytes, earliest event and end-to-end latency."""
    report = load_report(fx.enriched_lines(spark, sf_dir), fx.NOW, MAX_BATCH_BYTES, fx.CHUNK_RECORDS)
    return report.withColumn("earliest", _text("earliest"))


flagship.__name__ = "load_report"
query(f"""SELECT src_partition, batch_id, CAST(sum(n) AS BIGINT) AS n, CAST(sum(good) AS BIGINT) AS good, CAST(sum(n) - sum(good) AS BIGINT) AS bad,
CAST(sum(bytes) AS BIGINT) AS bytes, strftime(min(earliest), '%Y-%m-%d %H:%M:%S.%g') AS earliest,
epoch_ms(TIMESTAMP '{fx.NOW}') - epoch_ms(min(earliest)) AS e2e_latency_ms FROM assigned GROUP BY 1, 2""")(flagship)


def _round_robin(spark, sf_dir):
    return round_robin(_assigned(spark, sf_dir), 3, "loader").select("src_partition", "chunk_id", "channel")


_round_robin.__name__ = "round_robin"
query("SELECT src_partition, chunk_id, concat('loader-', CAST(batch_id % 3 AS VARCHAR)) AS channel FROM assigned")(_round_robin)


def _good_bad_counts(spark, sf_dir):
    return good_bad_counts(_rows(spark, sf_dir), F.col("transform_ok"))


_good_bad_counts.__name__ = "good_bad_counts"
query("""SELECT count(*) AS n, CAST(count(*) FILTER (k NOT IN (71, 73, 79, 83, 89, 97)) AS BIGINT) AS good,
CAST(count(*) FILTER (k IN (71, 73, 79, 83, 89, 97)) AS BIGINT) AS bad FROM e""")(_good_bad_counts)


@query(f"SELECT event_id AS src_id, epoch_ms(TIMESTAMP '{fx.NOW}') - epoch_ms(ms) AS e2e_latency_ms FROM parsed")
def e2e_latency(spark, sf_dir):
    now = F.lit(fx.NOW).cast("timestamp_ntz")
    parsed = _parsed(spark, sf_dir).filter("parse_ok")
    return parsed.select("src_id", latency_ms(now, F.col("collector_tstamp")).alias("e2e_latency_ms"))


def _metrics_report(spark, sf_dir):
    report = metrics_report(fx.spark_table(spark, sf_dir, "metrics"))
    return report.withColumns({
        "period": _text("period"), "e2e_latency_millis": F.coalesce("e2e_latency_millis", F.lit(-1)),
    })


_metrics_report.__name__ = "metrics_report"
query("""SELECT strftime(date_trunc('minute', t), '%Y-%m-%d %H:%M:%S.%g') AS period, CAST(sum(good) AS BIGINT) AS events_good,
CAST(sum(bad) AS BIGINT) AS events_bad, max(latency_ms) AS latency_millis, coalesce(max(e2e_latency_ms), -1) AS e2e_latency_millis
FROM batch_metrics GROUP BY 1""")(_metrics_report)


def _health_status(spark, sf_dir):
    return health_status(fx.spark_table(spark, sf_dir, "metrics")).select(_text("t"), "latency_ms", "status")


_health_status.__name__ = "health_status"
query("""SELECT strftime(t, '%Y-%m-%d %H:%M:%S.%g') AS t, latency_ms, CASE WHEN latency_ms > 300000 THEN 'unhealthy' ELSE 'healthy' END AS status
FROM batch_metrics""")(_health_status)


# -- texts --------------------------------------------------------------------------------

_CLEAN = r"regexp_replace(regexp_replace(raw, ':? *\n', ': ', 'g'), '^(?i)sql compilation error: *', '')"
_FRIENDLY = """coalesce(body_message, CASE WHEN regexp_matches(raw, '"message" *: *"([^"]*)"')
  THEN regexp_extract(raw, '"message" *: *"([^"]*)"', 1) END, raw)"""


def _clean_error_text(spark, sf_dir):
    return fx.spark_table(spark, sf_dir, "errors").select("err_id", clean_error_text(F.col("raw")).alias("message"))


_clean_error_text.__name__ = "clean_error_text"
query(f"SELECT err_id, {_CLEAN} AS message FROM errors")(_clean_error_text)


def _friendly_message(spark, sf_dir):
    errors = fx.spark_table(spark, sf_dir, "errors")
    return errors.select("err_id", friendly_message(F.col("body_message"), F.col("raw")).alias("message"))


_friendly_message.__name__ = "friendly_message"
query(f"SELECT err_id, {_FRIENDLY} AS message FROM errors")(_friendly_message)


@query(f"""SELECT err_id, CASE WHEN message IS NULL THEN 'transient' ELSE 'setup' END AS class, coalesce(message, '') AS message FROM (
SELECT err_id, CASE WHEN kind = 'ingest' AND code BETWEEN 400 AND 499 THEN CASE WHEN shown LIKE 'ERR_TABLE_TYPE_NOT_SUPPORTED %'
  THEN 'Table must not be in a transient database or transient schema: warehouse streaming ingest SDK only supports permanent tables' ELSE shown END
WHEN kind = 'ingest' AND code = 513 THEN 'Unrecognized warehouse account name or host name'
WHEN kind = 'security' THEN 'Unauthorized: Invalid user name or invalid public/private key pair or mis-configured network policies'
WHEN kind = 'sql' AND code IN (2003, 2043, 3001, 3041) THEN {_CLEAN} END AS message
FROM (SELECT *, {_FRIENDLY} AS shown FROM errors))""")
def classify_errors(spark, sf_dir):
    errors = fx.spark_table(spark, sf_dir, "errors").withColumn(
        "setup_message", setup_error_message(F.col("kind"), F.col("code"), F.col("body_message"), F.col("raw"))
    )
    return errors.select(
        "err_id", error_class(F.col("setup_message")).alias("class"), F.coalesce("setup_message", F.lit("")).alias("message")
    )


def _alert_text(spark, sf_dir):
    alerts = fx.spark_table(spark, sf_dir, "alerts")
    text = alert_text(*[F.col(c) for c in ("alert_type", "db", "schema", "columns", "cause")])
    return alerts.select(
        "alert_id", F.coalesce(text, F.lit("")).alias("alert"),
        qualified_name(F.col("db"), F.col("schema"), F.lit("events")).alias("table_name"),
    )


_alert_text.__name__ = "alert_text"
query("""SELECT alert_id, CASE alert_type WHEN 'failed_to_connect' THEN concat('Failed to connect to warehouse: ', cause)
WHEN 'failed_to_show_tables' THEN concat('Failed to SHOW tables in warehouse schema ', db, '.', schema, ': ', cause)
WHEN 'failed_to_create_events_table' THEN concat('Failed to create table in schema ', db, '.', schema, ': ', cause)
WHEN 'failed_to_add_columns' THEN concat('Failed to add columns: [', array_to_string(columns, ','), ']. Cause: ', cause)
WHEN 'failed_to_open_channel' THEN concat('Failed to open warehouse channel: ', cause)
WHEN 'failed_to_parse_private_key' THEN concat('Failed to parse private key: ', cause)
WHEN 'table_is_missing_atomic_column' THEN concat('Existing table is incompatible with the event pipeline: Missing required column ', columns[1])
ELSE '' END AS alert, concat(db, '.', schema, '.events') AS table_name FROM alerts""")(_alert_text)


@query("SELECT event_id, concat(event_type, chr(65533), '-', event_type) AS payload FROM e")
def utf8_payloads(spark, sf_dir):
    raw = F.expr("concat(CAST(event_type AS BINARY), X'FF', CAST('-' AS BINARY), CAST(event_type AS BINARY))")
    return fx.events(spark, sf_dir).select("event_id", utf8_payload(raw).alias("payload"))


QUERIES["utf8_payload"] = QUERIES.pop("utf8_payloads")
ORACLES["utf8_payload"] = ORACLES.pop("utf8_payloads")


@query("""SELECT event_id, CAST(event_id AS BIGINT) AS long_value, coalesce(TRY_CAST(CASE WHEN k = 89 THEN 'abc' ELSE CAST(k AS VARCHAR) END AS INT), -1) AS int_value,
value AS double_value, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS decimal_value,
CAST(CAST(event_id * 0.01 AS DECIMAL(18,2)) AS VARCHAR) AS cents_value, k % 2 = 1 AS boolean_value,
millis AS timestamp_value, strftime(ts, '%Y-%m-%d') AS date_value, CASE WHEN k < 50 THEN event_type ELSE '' END AS string_value,
concat('[', CAST(k AS VARCHAR), ',', CAST(k + 1 AS VARCHAR), ']') AS array_value,
concat('{"id":', CAST(event_id AS VARCHAR), ',"type":"', event_type, '"}') AS struct_value, concat('{"k":', CAST(k AS VARCHAR), '}') AS json_value FROM e""")
def typed_casts(spark, sf_dir):
    texts = fx.events(spark, sf_dir).selectExpr(
        "event_id", "CAST(event_id AS STRING) AS l", f"CASE WHEN {fx.K} = 89 THEN 'abc' ELSE CAST({fx.K} AS STRING) END AS i",
        "CAST(value AS STRING) AS d", f"CAST({fx.K} % 2 AS STRING) AS b", "date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSS') AS t",
        "date_format(ts, 'yyyy-MM-dd') AS day", f"CASE WHEN {fx.K} < 50 THEN event_type ELSE '' END AS s", "event_type", "props", f"{fx.K} AS k",
    )
    return texts.selectExpr(
        "event_id",
        f"{typed_value('l', 'bigint')} AS long_value",
        f"coalesce({typed_value('i', 'int')}, -1) AS int_value",
        f"{typed_value('d', 'double')} AS double_value",
        f"CAST({typed_value('d', 'decimal(18,2)')} AS STRING) AS decimal_value",
        f"CAST({decimal_value('event_id', 18, 2)} AS STRING) AS cents_value",
        f"{typed_value('b', 'boolean')} AS boolean_value",
        f"date_format({typed_value('t', 'timestamp_ntz')}, 'yyyy-MM-dd HH:mm:ss.SSS') AS timestamp_value",
        f"date_format({typed_value('day', 'date')}, 'yyyy-MM-dd') AS date_value",
        f"coalesce({typed_value(blank_as_null('s'), 'string')}, '') AS string_value",
        "to_json(array(k, k + 1)) AS array_value",
        "to_json(named_struct('id', event_id, 'type', event_type)) AS struct_value",
        "to_json(parse_json(props)) AS json_value",
    )


def _sql_template(template: str, text_type: str, spark: bool) -> str:
    sql = template.replace("@", text_type)
    return sql.replace("//", "DIV") if spark else sql.replace("\\\\", "\\")


@query(f"SELECT event_id, {_sql_template(fx.JSON_DOC_EXPECTED, 'VARCHAR', False)} AS json FROM e")
def json_drop_nulls(spark, sf_dir):
    docs = fx.events(spark, sf_dir).selectExpr("event_id", f"{_sql_template(fx.JSON_DOC, 'STRING', True)} AS json")
    return docs.selectExpr("event_id", f"{drop_null_members('json')} AS json")


@query(f"SELECT event_id, {_sql_template(fx.NUMBER_DOC_EXPECTED, 'VARCHAR', False)} AS json FROM e")
def json_numbers(spark, sf_dir):
    docs = fx.events(spark, sf_dir).selectExpr("event_id", f"{_sql_template(fx.NUMBER_DOC, 'STRING', True)} AS json")
    return docs.selectExpr("event_id", f"{plain_numbers('json')} AS json")


# -- tables and streams: these write a table below the shared folder and read it back -----------


def _options(spark, **more):
    folder = shared_folder(spark)
    table = "events_" + folder[-12:]
    create_events_table(spark, table, f"{folder}/table")
    return folder, LoadOptions(table=table, failed_events=FailedEventSink(path=f"{folder}/failed"), now=fx.NOW, **more)


_LOADED = _wide_oracle("good")


@query(_LOADED)
def load_rows(spark, sf_dir):
    """Append the good rows although others fail; every line is in the table or among the failed events."""
    _, options = _options(spark, persist=False)
    load_batch(fx.enriched_lines(spark, sf_dir), options)
    return _wide_texts(spark.table(options.table))


def _load_batch(spark, sf_dir):
    folder, options = _options(spark, source_time="src_ts")
    result = load_batch(fx.enriched_lines(spark, sf_dir), options)
    failed = spark.read.parquet(f"{folder}/failed").groupBy(F.col("kind").alias("item")).agg(F.count(F.lit(1)).alias("n"))
    loaded = spark.table(options.table).groupBy(F.lit("table").alias("item")).agg(F.count(F.lit(1)).alias("n"))
    counts = {"good": result.good, "bad": result.bad, "bytes": result.bytes, "e2e": result.e2e_latency_ms,
              "latency": result.latency_ms, "added": len(result.added_columns)}
    return failed.unionAll(loaded).unionAll(spark.createDataFrame(list(counts.items()), "item string, n bigint"))


_load_batch.__name__ = "load_batch"
query(f"""SELECT CASE WHEN k IN (73, 79) THEN 'loader_transform_error' ELSE 'loader_parsing_error' END AS item, count(*) AS n FROM e WHERE k IN (71, 73, 79, 83, 89, 97) GROUP BY 1
UNION ALL SELECT 'table', count(*) FROM good UNION ALL SELECT 'good', count(*) FROM good
UNION ALL SELECT 'bad', count(*) FROM e WHERE k IN (71, 73, 79, 83, 89, 97)
UNION ALL SELECT 'bytes', CAST(sum(strlen(value)) AS BIGINT) FROM lines
UNION ALL SELECT 'e2e', epoch_ms(TIMESTAMP '{fx.NOW}') - epoch_ms(min(ms)) FROM parsed
UNION ALL SELECT 'latency', epoch_ms(TIMESTAMP '{fx.NOW}') - epoch_ms(min(ms)) FROM e
UNION ALL SELECT 'added', count(*) FROM (SELECT DISTINCT event_type, event_id % 2 FROM good UNION ALL SELECT DISTINCT 'contexts', n_pages FROM good WHERE n_pages > 0)""")(_load_batch)


def _evolve_table(spark, sf_dir):
    _, options = _options(spark)
    names = sorted(row["name"] for row in entity_columns(_rows(spark, sf_dir)).collect())
    evolve_table(spark, options.table, names[:1])
    evolve_table(spark, options.table, names)
    add_columns(spark, options.table, names)
    added = spark.table(options.table).dtypes[len(ATOMIC_NAMES) + 1:]
    return spark.createDataFrame(added, "name string, column_type string")


_evolve_table.__name__ = "evolve_table"
query("""SELECT DISTINCT concat('unstruct_event_com_acme_', event_type, '_', CAST(1 + event_id % 2 AS VARCHAR)) AS name, 'variant' AS column_type FROM good
UNION SELECT 'contexts_com_acme_web_page_1', 'array<variant>' FROM good WHERE n_pages > 0
UNION SELECT 'contexts_org_demo_session_ctx_2', 'array<variant>' FROM good WHERE n_pages = 2""")(_evolve_table)


@query(f"""SELECT batch_id, batch_id = 0 AS created, (SELECT count(*) FROM good WHERE user_id % 8 % 3 <= batch_id) AS n
FROM (SELECT unnest(range(3)) AS batch_id)""")
def create_table_once(spark, sf_dir):
    """Each of three batches creates the table unless it exists; no later batch loses the rows of an earlier one."""
    folder = shared_folder(spark)
    table, found = "events_" + folder[-12:], []
    for batch_id in range(3):
        created = not table_exists(spark, table) and create_events_table(spark, table, f"{folder}/table")
        options = LoadOptions(table=table, failed_events=FailedEventSink(path=f"{folder}/failed"), now=fx.NOW)
        load_batch(fx.enriched_lines(spark, sf_dir).filter(f"src_partition % 3 = {batch_id}"), options)
        found.append((batch_id, created, spark.table(table).count()))
    return spark.createDataFrame(found, "batch_id bigint, created boolean, n bigint")


@query(f"""SELECT CAST(user_id % 8 % 4 AS BIGINT) AS batch_id, bool_or(fatal) AS aborted,
  CASE WHEN bool_or(fatal) THEN 0 ELSE count(*) END AS n FROM (SELECT *, user_id % 8 = 5 AND event_id % 7 = 0 AS fatal FROM good) GROUP BY 1""")
def aborted_batches(spark, sf_dir):
    """Batches with a row that fails for a fatal reason load nothing, the others all."""
    fatal = F.expr("src_partition = 5 AND src_id % 7 = 0")
    _, options = _options(spark, validators=[(fatal, "INTERNAL_ERROR", "internal")])
    outcomes = []
    for batch_id in range(4):
        lines = fx.enriched_lines(spark, sf_dir).filter(f"src_partition % 4 = {batch_id}")
        try:
            load_batch(lines, options, batch_id)
            outcomes.append((batch_id, False))
        except FatalWriteError:
            outcomes.append((batch_id, True))
    loaded = spark.table(options.table).groupBy(F.expr("CAST(user_id AS BIGINT) % 8 % 4").alias("batch_id")).agg(F.count(F.lit(1)).alias("n"))
    batches = spark.createDataFrame(outcomes, "batch_id bigint, aborted boolean").join(loaded, "batch_id", "left")
    return batches.withColumn("n", F.coalesce("n", F.lit(0)))


@query(_LOADED)
def altered_table(spark, sf_dir):
    """Another writer adds some of the columns after the rows were surveyed: the same rows are in the table once."""
    _, options = _options(spark)
    rows = _good(spark, sf_dir)
    names = sorted(row["name"] for row in entity_columns(rows).collect())
    add_columns(spark.newSession(), options.table, names[::2])
    append_rows(rows, options.table, names)
    return _wide_texts(spark.table(options.table))


def _load_stream(spark, sf_dir):
    """The lines as a stream of files, loaded until none is left."""
    folder, options = _options(spark)
    lines = fx.enriched_lines(spark, sf_dir)
    # Eight files by time, so that several micro-batches follow each other.
    lines.repartitionByRange(8, "src_ts").write.parquet(f"{folder}/lines")
    stream = read_lines(spark, "parquet", {"maxFilesPerTrigger": "4"}, path=f"{folder}/lines", schema=lines.schema, streaming=True)
    load_stream(spark, stream, options, f"{folder}/checkpoint", available_now=True).awaitTermination()
    spark.catalog.refreshTable(options.table)
    return _wide_texts(spark.table(options.table))


_load_stream.__name__ = "load_stream"
query(_LOADED)(_load_stream)


# -- exactly once: batches by source partition, each of them loaded again as after a fault -------


def _load_with_ledger(spark, sf_dir, batches: int):
    folder = shared_folder(spark)
    suffix = folder[-12:]
    ledger = Ledger(table="ledger_" + suffix, failed_table="failed_" + suffix, folder=f"{folder}/batches", stream="check")
    options = LoadOptions(table="events_" + suffix, now=fx.NOW, source_time="src_ts")
    create_tables(spark, ledger, options.table)
    for batch_id in [*range(batches), *range(batches)]:
        lines = fx.enriched_lines(spark, sf_dir).filter(f"src_partition % {batches} = {batch_id}")
        load_once(lines, options, ledger, batch_id)
    return options, ledger


@query(f"""SELECT CAST(load_day AS VARCHAR) AS load_day, concat('check-', CAST(batch AS VARCHAR)) AS load_batch, item, count(*) AS n,
  CAST(sum(entities) AS BIGINT) AS entities
FROM (SELECT DATE '{fx.NOW[:10]}' AS load_day, user_id % 8 % 3 AS batch, 'row' AS item, 1 + n_pages AS entities FROM good
  UNION ALL SELECT DATE '{fx.NOW[:10]}', user_id % 8 % 3, CASE WHEN k IN (73, 79) THEN 'loader_transform_error' ELSE 'loader_parsing_error' END, 0
  FROM e WHERE k IN (71, 73, 79, 83, 89, 97)) GROUP BY ALL""")
def partitioned_load(spark, sf_dir):
    """Rows, entities and failed events in the partitions of the tables, after every batch was loaded twice."""
    options, ledger = _load_with_ledger(spark, sf_dir, 3)
    rows = spark.table(options.table)
    names = [name for name in rows.columns if name.startswith("unstruct_event_")]
    contexts = [name for name in rows.columns if name.startswith("contexts_com_acme_web_page")]
    entities = " + ".join([*(f"CAST({name} IS NOT NULL AS INT)" for name in names), *(f"coalesce(size({name}), 0)" for name in contexts)])
    counted = rows.selectExpr("load_day", "load_batch", "'row' AS item", f"{entities} AS entities")
    failed = spark.table(ledger.failed_table).selectExpr("load_day", "load_batch", "kind AS item", "0 AS entities")
    return (
        counted.unionByName(failed).groupBy(F.col("load_day").cast("string").alias("load_day"), "load_batch", "item")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("entities").alias("entities"))
    )


@query(f"""SELECT CAST(user_id % 8 % 2 AS BIGINT) AS batch_id, count(*) AS n, CAST(sum(CASE WHEN k NOT IN (71, 73, 79, 83, 89, 97) THEN 1 ELSE 0 END) AS BIGINT) AS good,
  CAST(sum(CASE WHEN k IN (71, 73, 79, 83, 89, 97) THEN 1 ELSE 0 END) AS BIGINT) AS bad, CAST(sum(strlen(lines.value)) AS BIGINT) AS bytes,
  epoch_ms(TIMESTAMP '{fx.NOW}') - epoch_ms(min(CASE WHEN k NOT IN (71, 83, 89, 97) THEN ms END)) AS e2e_latency_ms,
  epoch_ms(TIMESTAMP '{fx.NOW}') - epoch_ms(min(ms)) AS latency_ms
FROM lines JOIN e ON src_id = event_id GROUP BY 1""")
def load_ledger(spark, sf_dir):
    """The ledger after every batch was loaded twice: one row per batch."""
    _, ledger = _load_with_ledger(spark, sf_dir, 2)
    return batch_metrics(spark, ledger).select("batch_id", "n", "good", "bad", "bytes", "e2e_latency_ms", "latency_ms")


@query("""SELECT strftime(date_trunc('minute', t), '%Y-%m-%d %H:%M:%S.%g') AS period, CAST(sum(good) AS BIGINT) AS events_good,
CAST(sum(bad) AS BIGINT) AS events_bad, max(latency_ms) AS latency_millis, coalesce(max(e2e_latency_ms), -1) AS e2e_latency_millis
FROM batch_metrics GROUP BY 1""")
def metrics_rollup(spark, sf_dir):
    """The metrics of periods from a stream of batch metrics whose files are not in the order of time."""
    folder = shared_folder(spark)
    metrics = fx.spark_table(spark, sf_dir, "metrics").selectExpr("t", "CAST(0 AS BIGINT) AS batch_id", "good", "bad", "CAST(0 AS BIGINT) AS bytes", "latency_ms", "e2e_latency_ms")
    metrics.repartition(4, "good").write.parquet(f"{folder}/batches")
    table = "rollup_" + folder[-12:]
    # All batches count, however late.
    roll_up(
        stored_batches(spark, f"{folder}/batches", 2), table, f"{folder}/checkpoint", late="10000 days", available_now=True
    ).awaitTermination()
    spark.catalog.refreshTable(table)
    return spark.table(table).drop("day").withColumns({"period": _text("period"), "e2e_latency_millis": F.coalesce("e2e_latency_millis", F.lit(-1))})


# Statuses of services: one per event, of a service by its type; some failed, some late.
_STATUSES = {
    "t": "ts", "batch_id": "event_id", "service": "CASE WHEN event_type = 'error' THEN 'failed_events' WHEN event_type = 'view' THEN 'source' ELSE 'table' END",
    "failed": f"({fx.K} % 9 = 0)", "latency_ms": f"CASE WHEN event_type = 'view' THEN CAST({fx.K} AS BIGINT) * 4000 END",
    "cause": f"CASE WHEN {fx.K} % 2 = 0 THEN concat('cause ', CAST(event_id AS {{text}})) END",
}


def _statuses(text: str) -> list[str]:
    return [f"{sql.format(text=text)} AS {name}" for name, sql in _STATUSES.items()]


_STATES = f""", statuses AS (SELECT {', '.join(_statuses('VARCHAR'))} FROM events),
states AS (SELECT *, CASE WHEN failed OR latency_ms > 300000 THEN 'unhealthy' ELSE 'healthy' END AS state,
  CASE service WHEN 'table' THEN 'warehouse' WHEN 'failed_events' THEN '{FAILED_EVENT_SINK_LABEL}' ELSE service END AS label FROM statuses),
changes AS (SELECT *, state <> lag(state, 1, 'healthy') OVER (PARTITION BY service ORDER BY t, batch_id, failed) AS changed,
  CASE WHEN failed THEN concat(label, ': ', coalesce(cause, 'failed')) WHEN state = 'unhealthy' THEN concat(label, ': latency of ', latency_ms, ' ms') END AS message
  FROM states)
"""


@query(_STATES + """SELECT DISTINCT service, last_value(state) OVER w AS state, strftime(max(CASE WHEN changed THEN t END) OVER p, '%Y-%m-%d %H:%M:%S.%g') AS since,
  CAST(sum(CASE WHEN changed AND state = 'unhealthy' THEN 1 ELSE 0 END) OVER p AS BIGINT) AS times_unhealthy,
  CAST(sum(CASE WHEN failed THEN 1 ELSE 0 END) OVER p AS BIGINT) AS failures, coalesce(last_value(message) OVER w, '') AS message
FROM changes WINDOW p AS (PARTITION BY service),
  w AS (PARTITION BY service ORDER BY t, batch_id, failed ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def health_report(spark, sf_dir):
    """State of each service after its last status, since when, and how often it failed."""
    statuses = fx.events(spark, sf_dir).selectExpr(*_statuses("STRING"))
    report = service_report(statuses)
    return report.withColumns({"since": _text("since"), "message": F.coalesce("message", F.lit(""))})


_BLAMES = {
    "alert_type": f"CASE {fx.K} % 5 WHEN 0 THEN 'failed_to_show_tables' WHEN 1 THEN 'failed_to_add_columns' WHEN 2 THEN 'failed_to_open_channel' "
    "WHEN 3 THEN 'table_is_missing_atomic_column' END",
    "setup": f"({fx.K} % 2 = 0)",
}


@query(f""", statuses AS (SELECT {', '.join(_statuses('VARCHAR'))}, {', '.join(f'{sql} AS {name}' for name, sql in _BLAMES.items())}, event_type FROM events),
texts AS (SELECT *, CASE WHEN failed AND setup THEN CASE alert_type
    WHEN 'failed_to_show_tables' THEN concat('Failed to SHOW tables in warehouse schema main.atomic: ', coalesce(cause, 'failed'))
    WHEN 'failed_to_add_columns' THEN concat('Failed to add columns: [a,', event_type, ']. Cause: ', coalesce(cause, 'failed'))
    WHEN 'failed_to_open_channel' THEN concat('Failed to open warehouse channel: ', coalesce(cause, 'failed'))
    WHEN 'table_is_missing_atomic_column' THEN concat('Existing table is incompatible with the event pipeline: Missing required column a,', event_type) END END AS alert
  FROM statuses),
ordered AS (SELECT *, lag(alert) OVER (PARTITION BY service ORDER BY t NULLS FIRST, batch_id NULLS FIRST, failed, alert NULLS FIRST) AS before FROM texts)
SELECT strftime(t, '%Y-%m-%d %H:%M:%S.%g') AS t, batch_id, service, alert FROM ordered WHERE alert IS NOT NULL AND alert IS DISTINCT FROM before""")
def load_alerts(spark, sf_dir):
    """Alerts for services whose set-up is wrong, each once until something changes."""
    columns = "array('a', event_type) AS columns"
    blames = [f"{sql} AS {name}" for name, sql in _BLAMES.items()]
    statuses = fx.events(spark, sf_dir).selectExpr(*_statuses("STRING"), *blames, columns)
    return alerts(statuses, "main", "atomic").withColumn("t", _text("t"))


# Rows from elsewhere: most values as text, some wrong in one way or several.
_FOREIGN = {
    "id": f"CASE WHEN {fx.K} % 10 = 1 THEN NULL WHEN {fx.K} % 10 = 2 THEN 'no id' ELSE CAST(event_id AS {{text}}) END",
    "kind": f"CASE WHEN {fx.K} % 10 = 3 THEN '' WHEN {fx.K} % 10 = 4 THEN concat(event_type, '-of-a-long-name') ELSE event_type END",
    "price": f"CASE WHEN {fx.K} % 10 IN (2, 5) THEN '123456.7' WHEN {fx.K} % 10 = 6 THEN '1,5' ELSE '12.5' END",
    "day": f"CASE WHEN {fx.K} % 10 = 7 THEN '2024-13-01' ELSE '2024-01-31' END",
    "flag": f"CASE WHEN {fx.K} % 10 = 8 THEN 'yes' ELSE '1' END",
    "note": f"CASE WHEN {fx.K} % 10 = 9 THEN repeat('n', 400) END",
    "event_id": "event_id",
}


def _foreign(text: str) -> list[str]:
    return [f"{sql.format(text=text)} AS {name}" for name, sql in _FOREIGN.items()]


@query(f"""SELECT event_id, code, coalesce(name, '') AS name FROM (SELECT event_id, unnest(list_filter([
  CASE WHEN m = 1 THEN {{'code': 'NULL_VALUE', 'name': 'id'}} END, CASE WHEN m = 2 THEN {{'code': 'INVALID_FORMAT_ROW', 'name': 'id'}} END,
  CASE WHEN m = 3 THEN {{'code': 'NULL_OR_EMPTY_STRING', 'name': 'kind'}} END, CASE WHEN m = 4 THEN {{'code': 'INVALID_VALUE_ROW', 'name': 'kind'}} END,
  CASE WHEN m IN (2, 5) THEN {{'code': 'INVALID_VALUE_ROW', 'name': 'price'}} END, CASE WHEN m = 6 THEN {{'code': 'INVALID_FORMAT_ROW', 'name': 'price'}} END,
  CASE WHEN m = 7 THEN {{'code': 'INVALID_FORMAT_ROW', 'name': 'day'}} END, CASE WHEN m = 8 THEN {{'code': 'INVALID_FORMAT_ROW', 'name': 'flag'}} END,
  {{'code': 'UNKNOWN_DATA_TYPE', 'name': 'place'}}, CASE WHEN m = 9 THEN {{'code': 'MAX_ROW_SIZE_EXCEEDED', 'name': NULL}} END], lambda x: x IS NOT NULL), recursive := true)
FROM (SELECT event_id, {fx.K} % 10 AS m FROM events))""")
def table_checks(spark, sf_dir):
    """All errors of every row against a table: all six codes, several per row."""
    rows = fx.events(spark, sf_dir).selectExpr(*_foreign("STRING"), "map(event_type, user_id) AS place")
    schema = StructType.fromDDL("id bigint NOT NULL, kind string NOT NULL, price decimal(6,2), day date, flag boolean, place double, note string, event_id bigint")
    rules = TableRules(schema, not_empty=["kind"], max_length={"kind": 12}, max_row_bytes=400)
    return conformed(rows, rules).selectExpr("event_id", "inline(errors)").select("event_id", "code", F.coalesce("name", F.lit("")).alias("name"))
