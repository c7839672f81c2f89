"""Lines of text to typed events."""

from pyspark.sql import Column, DataFrame, functions as F

from rillet.constants import JSON_FIELDS, LINE_FIELD_COUNT, NOT_NULL_COLUMNS
from rillet.functions.casts import typed_value, uuid_value
from rillet.functions.jsons import bind, exact_numbers, mark_infinite
from rillet.schema import ATOMIC_FIELDS, LINE_POSITIONS
from rillet.session import evaluate_once

#: Columns `parse_lines` adds besides the atomic ones.
EVENT_ENTITY, CONTEXT_ENTITIES = "event_entity", "context_entities"
PARSE_OK, PARSE_ERROR = "parse_ok", "parse_error"

# The data of an entity stays text here: it is cleaned and parsed only when it is kept.
_ENTITY = "struct<schema:string,data:string,in_range:boolean>"
_FORM = "struct<schema:string,data:variant>"


def _text(name: str) -> str:
    """SQL for the text of a field: null where it is empty or where the line has no such field."""
    return f"get(fields, {LINE_POSITIONS[name]})"


def _entities(name: str) -> str:
    """The entity of a JSON field, or the array of its entities; null unless the field is self-describing JSON.

    ``in_range`` of an entity is false if a number of its data fits no double.

    Numbers with exponents are written in plain form before Spark reads them, so a VARIANT keeps all
    digits; of a repeated key the last value counts.  Spark's parser ignores what follows the first value:
    the field is read as an array that ends with a hash of the field, which must then be second.
    """
    marker = "concat('out of range ', xxhash64(f))"
    entity = bind(
        "to_json(e.data)",
        "data",
        f"named_struct('schema', e.schema, 'data', data, 'in_range', NOT coalesce(contains(data, {marker}), false))",
    )
    if name == "unstruct_event":
        form, entities = _FORM, f"CASE WHEN w.data IS NOT NULL THEN {bind('w.data', 'e', entity)} END"
    else:
        form, entities = f"array<{_FORM}>", f"transform(w.data, e -> {entity})"
    wrapper = f"try_variant_get(v, '$[0]', 'struct<schema:string,data:{form}>')"
    checked = f"""CASE WHEN try_variant_get(v, '$[1]', 'bigint') = xxhash64(f) THEN
        {bind(wrapper, "w", f"CASE WHEN w.schema IS NOT NULL THEN {entities} END")} END"""
    parsed = bind("try_parse_json(concat('[', j, ',', xxhash64(f), ']'))", "v", checked)
    exact = bind(mark_infinite("f", marker), "i", bind(exact_numbers("i"), "j", parsed))
    return f"CASE WHEN {_text(name)} IS NOT NULL THEN {bind(_text(name), 'f', exact)} END"


def _typed_columns():
    for name, sql_type in ATOMIC_FIELDS:
        value = uuid_value(_text(name)) if name == "event_id" else typed_value(_text(name), sql_type)
        yield f"{value} AS {name}"
    for name in JSON_FIELDS:
        yield f"{_entities(name)} AS {name}"


def _checks():
    """(field, message, SQL that is true when the check fails) for every check of a line."""
    for name in NOT_NULL_COLUMNS:
        yield name, "must not be empty", f"{_text(name)} IS NULL"
    for name, sql_type in ATOMIC_FIELDS:
        if sql_type != "string" or name == "event_id":
            message = "is not a UUID" if name == "event_id" else f"is not a valid {sql_type}"
            yield name, message, f"{_text(name)} IS NOT NULL AND {name} IS NULL"
    for name in JSON_FIELDS:
        yield name, "is not valid self-describing JSON", f"{_text(name)} IS NOT NULL AND {name} IS NULL"


def parse_lines(lines: DataFrame) -> DataFrame:
    """Parse the ``value`` column of each line; every row is kept.

    Adds the 128 atomic columns, ``event_entity`` (schema and JSON text of the self-describing
    event, and whether a VARIANT can hold its numbers), ``context_entities`` (the same for all contexts), ``parse_ok`` and, for a line that
    cannot be parsed, ``parse_error`` with the reason.  No shuffle, no Python.
    """
    checks = list(_checks())
    literals = {
        "names": ", ".join(f"'{name}'" for name, _, _ in checks),
        "messages": ", ".join(f"'{message}'" for _, message, _ in checks),
        "positions": ", ".join(str(LINE_POSITIONS[name]) for name, _, _ in checks),
        "numbers": ", ".join(str(number) for number in range(len(checks))),
    }
    field_errors = """transform(
        filter(array({numbers}), n -> get(failed, n)),
        n -> struct(
            get(array({names}), n) AS field,
            coalesce(get(fields, get(array({positions}), n)), '') AS value,
            get(array({messages}), n) AS message))""".format(**literals)
    parse_error = f"""CASE
        WHEN size(fields) <> {LINE_FIELD_COUNT} THEN struct(
            CASE WHEN size(fields) = 1 THEN 'NotTSV' ELSE 'FieldNumberMismatch' END AS type,
            size(fields) AS field_count,
            CAST(NULL AS array<struct<field:string,value:string,message:string>>) AS fields)
        WHEN array_contains(failed, true) THEN struct(
            'RowDecodingError' AS type, size(fields) AS field_count, {field_errors} AS fields) END"""
    empty = f"CAST(array() AS array<{_ENTITY}>)"
    contexts = f"""CASE WHEN contexts IS NOT NULL OR derived_contexts IS NOT NULL
        THEN concat(coalesce(contexts, {empty}), coalesce(derived_contexts, {empty})) END"""
    parse_ok = evaluate_once(f"size(fields) = {LINE_FIELD_COUNT} AND NOT array_contains(failed, true)")

    split = lines.withColumn(
        "fields", F.expr(r"transform(split(coalesce(CAST(value AS STRING), ''), '\t', -1), x -> CASE WHEN x <> '' THEN x END)")
    )
    typed = split.selectExpr("*", *_typed_columns())
    checked = typed.selectExpr("*", f"array({', '.join(failed for _, _, failed in checks)}) AS failed")
    helpers = ", ".join(("fields", "failed", *JSON_FIELDS))
    return checked.selectExpr(
        f"* EXCEPT ({helpers})",
        f"unstruct_event AS {EVENT_ENTITY}",
        f"{contexts} AS {CONTEXT_ENTITIES}",
        f"{parse_ok} AS {PARSE_OK}",
        f"{parse_error} AS {PARSE_ERROR}",
    )


def split_good_bad(rows: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """The rows for which ``ok`` holds, and all others."""
    return rows.filter(ok), rows.filter(~F.coalesce(ok, F.lit(False)))
