"""Parsed events to rows of the events table."""

from pyspark.sql import Column, DataFrame, functions as F

from rillet.constants import CONTEXTS_PREFIX, LOAD_COLUMN, SCHEMA_VERSION_KEY, UNSTRUCT_PREFIX
from rillet.functions.entities import column_of_valid_key, is_schema_key, is_skipped, schema_version
from rillet.functions.jsons import drop_null_members, is_json_object, with_member
from rillet.operators.parse import CONTEXT_ENTITIES, EVENT_ENTITY, PARSE_OK
from rillet.schema import ATOMIC_NAMES
from rillet.session import evaluate_once

#: Columns `transform_events` adds besides the load timestamp.
UNSTRUCT_NAME, UNSTRUCT_VALUE = "unstruct_name", "unstruct_value"
CONTEXT_NAMES, CONTEXTS = "context_names", "contexts"
TRANSFORM_OK, TRANSFORM_ERROR = "transform_ok", "transform_error"


def skip_schemas(parsed: DataFrame, criteria) -> DataFrame:
    """Leave out the entities whose schema matches one of the criteria; the events stay."""
    if not criteria:
        return parsed
    event_skipped, context_skipped = is_skipped(f"{EVENT_ENTITY}.schema", criteria), is_skipped("e.schema", criteria)
    return parsed.withColumns(
        {
            EVENT_ENTITY: F.expr(f"CASE WHEN NOT {event_skipped} THEN {EVENT_ENTITY} END"),
            CONTEXT_ENTITIES: F.expr(f"filter({CONTEXT_ENTITIES}, e -> NOT {context_skipped})"),
        }
    )


def _usable(entity: str) -> str:
    return f"({is_schema_key(entity + '.schema')} AND {is_json_object(entity + '.data')} AND {entity}.in_range)"


def _value(entity: str, with_schema_version: bool) -> str:
    json = drop_null_members(f"{entity}.data")
    if with_schema_version:
        json = with_member(json, SCHEMA_VERSION_KEY, schema_version(f"{entity}.schema"))
    return f"try_parse_json({json})"


def transform_events(
    parsed: DataFrame, load_tstamp, skip=(), with_schema_version: bool = True
) -> DataFrame:
    """Rows for the events table, for each parsed event.

    Adds ``load_tstamp`` (one value for all rows), ``unstruct_name`` and ``unstruct_value`` (column
    and object of the self-describing event), ``contexts`` (map from column to array of objects),
    ``context_names`` (the keys of that map), ``transform_ok`` and ``transform_error`` (reason and
    schema of each unusable entity).  Lines that were not parsed pass through with null entities and
    ``transform_ok`` false.

    The contexts of an event are grouped inside its row: no explode, no shuffle.
    """
    event, contexts = EVENT_ENTITY, CONTEXT_ENTITIES
    all_usable = f"""{PARSE_OK} AND ({event} IS NULL OR {_usable(event)})
        AND coalesce(forall({contexts}, e -> {_usable('e')}), true)"""
    entities = f"array_append(coalesce({contexts}, array()), {event})"
    error = f"""transform(filter({entities}, e -> e IS NOT NULL AND NOT {_usable('e')}), e -> struct(
        CASE WHEN NOT {is_schema_key('e.schema')} THEN 'not a schema key'
            WHEN NOT {is_json_object('e.data')} THEN 'entity data is not an object'
            ELSE 'a number is out of range' END AS message, e.schema AS schema))"""
    columns = f"transform({contexts}, e -> {column_of_valid_key('e.schema', CONTEXTS_PREFIX)})"
    values = f"transform({contexts}, e -> {_value('e', with_schema_version)})"
    # Most events carry one type of context, or each type once.
    groups = f"""CASE
        WHEN size({CONTEXT_NAMES}) = 1 THEN array(context_values)
        WHEN size({CONTEXT_NAMES}) = size(context_values) THEN transform(context_values, v -> array(v))
        ELSE transform({CONTEXT_NAMES}, c -> transform(
            filter(arrays_zip(context_columns, context_values), z -> z.context_columns = c), z -> z.context_values)) END"""

    checked = skip_schemas(parsed, skip).withColumn(TRANSFORM_OK, F.expr(evaluate_once(all_usable)))
    valued = checked.selectExpr(
        f"* EXCEPT ({event}, {contexts})",
        f"CASE WHEN {PARSE_OK} AND NOT {TRANSFORM_OK} THEN {error} END AS {TRANSFORM_ERROR}",
        f"CASE WHEN {TRANSFORM_OK} AND {event} IS NOT NULL THEN {column_of_valid_key(event + '.schema', UNSTRUCT_PREFIX)} END AS {UNSTRUCT_NAME}",
        f"CASE WHEN {TRANSFORM_OK} THEN {_value(event, False)} END AS {UNSTRUCT_VALUE}",
        f"CASE WHEN {TRANSFORM_OK} THEN {columns} END AS context_columns",
        f"CASE WHEN {TRANSFORM_OK} THEN {values} END AS context_values",
        f"CAST('{load_tstamp}' AS TIMESTAMP_NTZ) AS {LOAD_COLUMN}",
    )
    named = valued.withColumn(CONTEXT_NAMES, F.array_distinct("context_columns"))
    return named.withColumn(CONTEXTS, F.expr(f"map_from_arrays({CONTEXT_NAMES}, {groups})")).drop(
        "context_columns", "context_values"
    )


def entity_names() -> Column:
    """Array of the entity columns of a row; empty for rows without entities."""
    return F.expr(f"array_compact(array_append(coalesce({CONTEXT_NAMES}, CAST(array() AS array<string>)), {UNSTRUCT_NAME}))")


def entity_columns(rows: DataFrame) -> DataFrame:
    """The distinct entity columns the rows need: one small shuffle of names."""
    # The outer form: for the inner one Spark adds a filter that computes the names a second time.
    exploded = rows.select(F.explode_outer(entity_names()).alias("name"))
    return exploded.distinct().filter(F.col("name").isNotNull())


def wide_rows(rows: DataFrame, names) -> DataFrame:
    """The table's columns for each row: atomic columns, load timestamp, one column per entity type."""
    return rows.selectExpr(*ATOMIC_NAMES, LOAD_COLUMN, *[entity_value(name) for name in names])


def entity_value(name: str) -> str:
    """SQL for an entity column of a transformed row; null where the event lacks the entity."""
    if name.startswith(CONTEXTS_PREFIX):
        return f"{CONTEXTS}['{name}'] AS `{name}`"
    return f"CASE WHEN {UNSTRUCT_NAME} = '{name}' THEN {UNSTRUCT_VALUE} END AS `{name}`"
