import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from rillet.functions.texts import utf8_payload
from rillet.operators.parse import parse_lines
from rillet.operators.transform import entity_columns, transform_events, wide_rows
from rillet.operators.validate import extra_columns_of_row
from rillet.schema import ATOMIC_FIELDS, LINE_POSITIONS, events_schema
from tests.lines import BAD_LINES, NOW, contexts, frame, line, unstruct


def parse_one(spark, **fields):
    return parse_lines(frame(spark, [line(**fields)])).first()


def errors(row):
    return [(e["field"], e["value"], e["message"]) for e in row["parse_error"]["fields"]]


def test_layout(spark):
    assert len(ATOMIC_FIELDS) == 128
    assert len(LINE_POSITIONS) == 131
    assert [LINE_POSITIONS[n] for n in ("contexts", "unstruct_event", "derived_contexts", "true_tstamp")] == [52, 58, 122, 130]
    assert len(events_schema()) == 129
    assert [f.name for f in events_schema() if not f.nullable] == ["collector_tstamp", "event_id", "v_collector", "v_etl"]


def test_minimal_event(spark):
    row = parse_one(spark)
    assert row["parse_ok"] and row["parse_error"] is None
    assert row["collector_tstamp"] == datetime.datetime(2023, 10, 24, 10)
    assert row["app_id"] is None and row["event_entity"] is None and row["context_entities"] is None


def test_typed_fields(spark):
    row = parse_one(
        spark, txn_id="-7", domain_sessionidx="40000", geo_latitude="1.5e1", tr_total="1.555", br_cookies="1", dvce_ismobile="0",
        true_tstamp="2023-01-02 03:04:05", event_id="ABCDEF00-0000-4000-8000-00000000000A",
    )
    assert row["parse_ok"]
    assert (row["txn_id"], row["domain_sessionidx"], row["geo_latitude"]) == (-7, 40000, 15.0)
    assert row["tr_total"] == Decimal("1.56")
    assert (row["br_cookies"], row["dvce_ismobile"]) == (True, False)
    assert row["true_tstamp"] == datetime.datetime(2023, 1, 2, 3, 4, 5)
    assert row["event_id"] == "abcdef00-0000-4000-8000-00000000000a"


def test_not_tab_separated(spark):
    rows = parse_lines(frame(spark, [*BAD_LINES, "a\tb", "", line() + "\t"])).collect()
    assert [(r["parse_error"]["type"], r["parse_error"]["field_count"]) for r in rows] == [
        ("NotTSV", 1), ("NotTSV", 1), ("FieldNumberMismatch", 2), ("NotTSV", 1), ("FieldNumberMismatch", 132),
    ]
    assert not any(r["parse_ok"] for r in rows)


def test_all_errors_of_a_line(spark):
    row = parse_one(
        spark, event_id="no-uuid", v_etl="", txn_id=" 7 ", br_cookies="true", tr_total="12345678901234567.00",
        collector_tstamp="2023", contexts="{broken", unstruct_event='"text"',
    )
    assert not row["parse_ok"] and row["parse_error"]["type"] == "RowDecodingError"
    assert errors(row) == [
        ("v_etl", "", "must not be empty"),
        ("collector_tstamp", "2023", "is not a valid timestamp_ntz"),
        ("event_id", "no-uuid", "is not a UUID"),
        ("txn_id", " 7 ", "is not a valid int"),
        ("tr_total", "12345678901234567.00", "is not a valid decimal(18,2)"),
        ("br_cookies", "true", "is not a valid boolean"),
        ("contexts", "{broken", "is not valid self-describing JSON"),
        ("unstruct_event", '"text"', "is not valid self-describing JSON"),
    ]


def test_invalid_utf8_is_replaced(spark):
    raw = spark.createDataFrame([(bytearray(b"a\xffb"),)], "value binary")
    assert raw.select(utf8_payload(F.col("value"))).first()[0] == "a�b"
    good = line(app_id="@").encode().replace(b"@", b"x\xff")
    row = parse_lines(spark.createDataFrame([(bytearray(good),)], "value binary")).first()
    assert row["parse_ok"] and row["app_id"] == "x�"


def transformed(spark, skip=(), **fields):
    return transform_events(parse_lines(frame(spark, [line(**fields)])), NOW, skip)


def test_entities(spark):
    rows = transformed(
        spark,
        unstruct_event=unstruct("x:com.acme/linkClick/jsonschema/1-0-3", '{"a":null,"n":1e3}'),
        contexts=contexts(("x:com.acme/page/jsonschema/1-0-0", '{"i":1}'), ("x:com.acme/page/jsonschema/1-2-0", "{}")),
        derived_contexts=contexts(("x:com.acme/page/jsonschema/1-0-0", '{"i":2}'), ("x:com.acme/page/jsonschema/2-0-0", '{"i":3}')),
    )
    names = sorted(r["name"] for r in entity_columns(rows).collect())
    assert names == ["contexts_com_acme_page_1", "contexts_com_acme_page_2", "unstruct_event_com_acme_link_click_1"]
    wide = wide_rows(rows, names).select(*[F.to_json(n).alias(n) for n in names], "load_tstamp").first()
    assert wide[0] == '[{"_schema_version":"1-0-0","i":1},{"_schema_version":"1-2-0"},{"_schema_version":"1-0-0","i":2}]'
    assert wide[1] == '[{"_schema_version":"2-0-0","i":3}]'
    assert wide[2] == '{"n":1000}'
    assert wide["load_tstamp"] == datetime.datetime(2023, 10, 24, 10, 0, 42, 123000)


def test_skipping_leaves_the_event(spark):
    page = contexts(("x:com.acme/page/jsonschema/1-0-0", "{}"), ("x:com.acme/page/jsonschema/1-0-1", "{}"))
    row = transformed(spark, ["x:com.acme/page/jsonschema/1-0-1"], contexts=page).first()
    assert row["transform_ok"] and row["context_names"] == ["contexts_com_acme_page_1"]
    row = transformed(spark, ["x:com.acme/page/jsonschema/*-*-*"], contexts=page).first()
    assert row["transform_ok"] and row["context_names"] == []


def test_unusable_entities(spark):
    for entity, message in [
        (("x:com.acme/page/jsonschema/1-0", "{}"), "not a schema key"),
        (("x:com.acme/page/jsonschema/1-0-0", '"text"'), "entity data is not an object"),
        (("x:com.acme/page/jsonschema/1-0-0", "null"), "entity data is not an object"),
        (("x:com.acme/page/jsonschema/1-0-0", '"{oops"'), "entity data is not an object"),
        (("x:com.acme/page/jsonschema/1-0-0", '{"n":[1e400]}'), "a number is out of range"),
    ]:
        good = ("x:com.acme/b/jsonschema/1-0-0", '{"t":"Infinity"}')
        row = transformed(spark, contexts=contexts(good, entity, ("no key", "{}"))).first()
        assert row["parse_ok"] and not row["transform_ok"]
        assert [tuple(error) for error in row["transform_error"]] == [
            (message, entity[0]), ("not a schema key", "no key")
        ]
        assert row["unstruct_name"] is None and row["contexts"] is None


def test_extra_columns_of_a_row(spark):
    rows = transformed(
        spark, unstruct_event=unstruct("x:a/e/jsonschema/1-0-0", "{}"), contexts=contexts(("x:a/c/jsonschema/1-0-0", "{}"))
    )
    extra = rows.select(extra_columns_of_row(["app_id", "contexts_a_c_1"]).alias("extra")).first()["extra"]
    assert extra == ["unstruct_event_a_e_1"]


def test_filters_do_not_parse_twice(spark):
    """The filter on the flag stays above the projection that computes it."""
    plan = parse_lines(frame(spark, [line()])).filter("parse_ok").select("app_id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
