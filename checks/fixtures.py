"""Inputs for the checks, derived row by row from the driver's ``events`` table.

``DIALECT`` holds the few functions that Spark SQL and DuckDB spell differently, so that both
sides build byte-identical lines.  The payload number k of an event decides what is wrong with
its line:

    k = 97  not a line of tab-separated fields
    k = 89  text in the integer field domain_sessionidx
    k = 83  contexts are cut-off JSON
    k = 79  one context has no schema key, another one's data is a string that starts with a brace
    k = 73  a number of a context is beyond the range of a double
    k = 71  text follows the JSON of the contexts

The pages hold decimals that no double holds, and a repeated key whose last value is null.
"""

from pyspark.sql import DataFrame, SparkSession

from rillet.sources.lines import read_lines, spread

SPARK = {
    "millis": "date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSS')",
    "tab": "'\\t'",
    "text": "string",
    "newline": "'\\n'",
    "open": "array(",
    "close": ")",
    "empty": "CAST(array() AS array<string>)",
}
DUCKDB = {
    "millis": "strftime(ts, '%Y-%m-%d %H:%M:%S.%g')",
    "tab": "chr(9)",
    "text": "varchar",
    "newline": "chr(10)",
    "open": "[",
    "close": "]",
    "empty": "CAST([] AS VARCHAR[])",
}

K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"
# Page contexts of an event; events with two pages carry a session context as well.
PAGES = "CASE event_type WHEN 'error' THEN 0 WHEN 'click' THEN 2 WHEN 'view' THEN 2 ELSE 1 END"
NOW = "2024-12-31 00:00:00"
CHUNK_RECORDS = 1000
# Members whose digits a double would lose.
EXACT = """concat(',"price":', CAST(event_id AS {text}), '2345678901234567.89,"ratio":0.1000000000000000055511151231257827')"""

_CONTEXTS = '{"schema":"x:org.example.wrapper/contexts/jsonschema/1-0-0","data":['
_UNSTRUCT = '{"schema":"x:org.example.wrapper/unstruct_event/jsonschema/1-0-0","data":'


def _fields(d: dict) -> dict:
    """Line position (from 1) to SQL expression, for the fields that are not empty."""
    page = '{"schema":"x:com.acme/webPage/jsonschema/1-0-0","data":{"id":'
    return {
        1: f"concat('app', CAST(user_id % 5 AS {d['text']}))",
        2: "'web'",
        4: d["millis"],
        6: "'unstruct'",
        7: f"concat('00000000-0000-4000-8000-', lpad(CAST(event_id AS {d['text']}), 12, '0'))",
        11: "'c-1'",
        12: "'e-1'",
        13: f"CAST(user_id AS {d['text']})",
        17: f"CASE WHEN {K} = 89 THEN 'abc' ELSE CAST(event_id % 20 AS {d['text']}) END",
        53: f"""CASE WHEN {K} = 83 THEN '{_CONTEXTS}{{'
                 WHEN {K} = 79 THEN '{_CONTEXTS}{{"schema":"no key","data":{{}}}},{{"schema":"x:com.acme/oops/jsonschema/1-0-0","data":"{{oops"}}]}}'
                 WHEN {K} = 73 THEN '{_CONTEXTS}{{"schema":"x:com.acme/big/jsonschema/1-0-0","data":{{"n":-1.5e400,"t":"Infinity"}}}}]}}'
                 WHEN {K} = 71 THEN '{_CONTEXTS}]}} trailing'
                 WHEN {PAGES} = 1 THEN concat('{_CONTEXTS}{page}', CAST(event_id AS {d['text']}), ',"note":null',
                   {EXACT.format(text=d['text'])}, ',"twice":1,"twice":null}}}}]}}')
                 WHEN {PAGES} = 2 THEN concat('{_CONTEXTS}{page}', CAST(event_id AS {d['text']}), ',"note":null',
                   {EXACT.format(text=d['text'])}, ',"twice":1,"twice":null}}}},{page}',
                   CAST(event_id + 1 AS {d['text']}), ',"note":"n"}}}}]}}')
                 ELSE '' END""",
        59: f"""concat('{_UNSTRUCT}{{"schema":"x:com.acme/', event_type, '/jsonschema/', CAST(1 + event_id % 2 AS {d['text']}),
                 '-0-0","data":', props, '}}}}')""",
        62: f"CAST(value AS {d['text']})",
        123: f"""CASE WHEN {PAGES} = 2 THEN concat('{_CONTEXTS}{{"schema":"x:org.demo/session_ctx/jsonschema/2-0-1","data":{{"s":',
                 CAST(user_id AS {d['text']}), '}}}}]}}') ELSE '' END""",
    }


def line_sql(d: dict, fields: dict | None = None) -> str:
    """SQL expression for the line of an event."""
    parts, last = [], 1
    for position, expression in sorted((fields or _fields(d)).items()):
        if position > last:
            parts.append(f"repeat({d['tab']}, {position - last})")
        parts.append(expression)
        last = position
    parts.append(f"repeat({d['tab']}, {131 - last})")
    return f"CASE WHEN {K} = 97 THEN concat('nonsense', CAST(event_id AS {d['text']})) ELSE concat({', '.join(parts)}) END"


def _line_columns(d: dict) -> dict[str, str]:
    return {"src_id": "event_id", "src_partition": "user_id % 8", "src_ts": "ts", "value": line_sql(d)}


# Outcomes that a table writer reports: "reports" has one for every event, "failures" only those of type "error".
_FAILURES = {
    "batch_id": "user_id % 8",
    "row_index": "event_id",
    "extra_cols": f"""CASE WHEN {K} < 20 THEN {{open}}'unstruct_event_xyz_1'{{close}}
        WHEN {K} < 35 THEN {{open}}'contexts_abc_2', 'unstruct_event_xyz_1'{{close}}
        WHEN {K} < 40 THEN {{open}}'geo_city'{{close}} WHEN {K} < 45 THEN {{open}}'other_col'{{close}} ELSE {{empty}} END""",
    "error_code": f"""CASE {K} % 7 WHEN 0 THEN 'INVALID_FORMAT_ROW' WHEN 1 THEN 'INVALID_VALUE_ROW' WHEN 2 THEN 'NULL_VALUE'
        WHEN 3 THEN 'NULL_OR_EMPTY_STRING' WHEN 4 THEN 'MAX_ROW_SIZE_EXCEEDED' WHEN 5 THEN 'UNKNOWN_DATA_TYPE'
        ELSE 'INTERNAL_ERROR' END""",
    "message": "concat('cause ', CAST(event_id AS {text}))",
}

# Errors of the target: an HTTP answer, a refused login, a SQL error or something else.
_ERRORS = {
    "err_id": "event_id",
    "kind": """CASE event_type WHEN 'click' THEN 'ingest' WHEN 'signup' THEN 'ingest' WHEN 'view' THEN 'security'
        WHEN 'purchase' THEN 'sql' ELSE 'other' END""",
    "code": f"""CASE event_type WHEN 'click' THEN 395 + {K} WHEN 'signup' THEN CASE WHEN {K} < 50 THEN 513 ELSE 404 END
        WHEN 'purchase' THEN CASE {K} % 5 WHEN 0 THEN 2003 WHEN 1 THEN 2043 WHEN 2 THEN 3001 WHEN 3 THEN 3041 ELSE 1430 END
        ELSE {K} END""",
    "body_message": f"CASE WHEN event_type = 'click' AND {K} % 2 = 0 THEN concat('body ', CAST(event_id AS {{text}})) END",
    "raw": f"""CASE WHEN {K} % 5 = 0 THEN concat('{{{{"message" : "quoted ', CAST(event_id AS {{text}}), '"}}}}')
        WHEN {K} % 5 = 1 THEN concat('ERR_TABLE_TYPE_NOT_SUPPORTED ', CAST(event_id AS {{text}}))
        WHEN {K} % 5 = 2 THEN concat('SQL compilation error:', {{newline}}, 'object ', CAST(event_id AS {{text}}), ' is unknown')
        WHEN {K} % 5 = 3 THEN concat('line one:  ', {{newline}}, 'message "" ', CAST(event_id AS {{text}}))
        ELSE concat('{{{{"message":""}}}}', CAST(event_id AS {{text}})) END""",
}

# What a batch reports: one row per event, for the metrics of a period.
_METRICS = {
    "t": "ts",
    "good": "user_id",
    "bad": f"CAST({K} AS BIGINT)",
    "latency_ms": "CAST(floor(value * 2000) AS BIGINT)",
    "e2e_latency_ms": f"CASE WHEN {K} < 90 THEN CAST(floor(value * 3000) AS BIGINT) END",
}

_ALERTS = {
    "alert_id": "event_id",
    "alert_type": f"""CASE {K} % 8 WHEN 0 THEN 'failed_to_connect' WHEN 1 THEN 'failed_to_show_tables'
        WHEN 2 THEN 'failed_to_create_events_table' WHEN 3 THEN 'failed_to_add_columns' WHEN 4 THEN 'failed_to_open_channel'
        WHEN 5 THEN 'failed_to_parse_private_key' WHEN 6 THEN 'table_is_missing_atomic_column' ELSE 'other' END""",
    "db": "concat('db', CAST(user_id % 3 AS {text}))",
    "schema": "event_type",
    "columns": f"CASE WHEN {K} % 8 = 3 THEN {{open}}'contexts_a_1', concat('unstruct_event_', event_type, '_1'){{close}} ELSE {{open}}event_type{{close}} END",
    "cause": "concat('cause ', CAST(event_id AS {text}))",
}

# JSON with null members and unusual numbers, and the canonical text expected of it.
JSON_DOC = """concat('{"a":null,"id":', CAST(event_id AS @), ',"n":null,"deep":{"x":null,"y":[null,{"z":null,"w":', props,
    '}],"only":{"gone":null}},"text":"say \\\\"null\\\\": null, 1e3","t":"', event_type, '","last":null}')"""
JSON_DOC_EXPECTED = """concat('{"id":', CAST(event_id AS @), ',"deep":{"y":[null,{"w":', props,
    '}],"only":{}},"text":"say \\\\"null\\\\": null, 1e3","t":"', event_type, '"}')"""
NUMBER_DOC = """concat('{"whole":', CAST(event_id AS @), '.0,"thousand":', CAST(event_id + 1 AS @), 'e3,"cents":', CAST(event_id * 10 + 5 AS @),
    'E-2,"long":12345678901234567890123456789012345678901,"tail":', CAST(event_id AS @), '.250,"neg":-', CAST(event_id + 1 AS @),
    '.50e+1,"keep":"', CAST(event_id AS @), 'e3"}')"""
NUMBER_DOC_EXPECTED = """concat('{"whole":', CAST(event_id AS @), ',"thousand":', CAST(event_id + 1 AS @), '000,"cents":',
    CAST(CAST(event_id * 10 + 5 AS BIGINT) // 100 AS @), '.', CASE WHEN (event_id * 10 + 5) % 100 < 10 THEN '0' ELSE '' END,
    CAST((event_id * 10 + 5) % 100 AS @), ',"long":12345678901234567890123456789012345678901,"tail":', CAST(event_id AS @),
    '.25,"neg":-', CAST((event_id + 1) * 10 + 5 AS @), ',"keep":"', CAST(event_id AS @), 'e3"}')"""

TABLES = {"failures": _FAILURES, "reports": _FAILURES, "errors": _ERRORS, "metrics": _METRICS, "alerts": _ALERTS}
_ONLY = {"failures": " WHERE event_type = 'error'"}


def _columns(d: dict, name: str) -> list[str]:
    if name == "lines":
        return [f"{sql} AS {column}" for column, sql in _line_columns(d).items()]
    words = {key: d[key] for key in ("open", "close", "empty", "text", "newline")}
    return [f"{sql.format(**words)} AS {column}" for column, sql in TABLES[name].items()]


def duckdb_table(name: str) -> str:
    """The fixture as a DuckDB query over ``events``."""
    return f"SELECT {', '.join(_columns(DUCKDB, name))} FROM events{_ONLY.get(name, '')}"


def spark_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = events(spark, sf_dir)
    if name in _ONLY:
        rows = rows.filter(_ONLY[name].removeprefix(" WHERE "))
    return rows.selectExpr(*_columns(SPARK, name))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/events.parquet"), by_row_groups=True)


def enriched_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as lines, read through the engine's own reader."""
    return read_lines(spark, "parquet", {}, columns=_line_columns(SPARK), path=f"{sf_dir}/events.parquet")
