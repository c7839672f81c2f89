"""Rows from elsewhere against the schema of a table: what to write, and what is wrong."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from rillet.functions.casts import FORMS
from rillet.functions.convert import converted, is_number

ERROR = "struct<code:string,name:string,message:string>"
#: A text that is a number, whether or not it fits a type.
NUMBER_FORM = r"\A[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\z"


@dataclass(frozen=True)
class TableRules:
    """schema: the table's columns; those that are not nullable must have a value.  not_empty: text columns that
    must not be empty.  max_length: characters that text columns take.  max_row_bytes: size of a row as JSON."""

    schema: T.StructType
    not_empty: Sequence[str] = ()
    max_length: Mapping[str, int] = field(default_factory=dict)
    max_row_bytes: int | None = None


def _error(condition: str, code: str, name: str | None, message: str) -> str:
    column = "CAST(NULL AS STRING)" if name is None else f"'{name}'"
    return f"CASE WHEN {condition} THEN named_struct('code', '{code}', 'name', {column}, 'message', '{message}') END"


def _column_errors(column: T.StructField, source: T.DataType | None, value: str | None, rules: TableRules):
    """SQL of the errors of one column; each is null for a row that is right."""
    name, text = column.name, f"`{column.name}`"
    kind = column.dataType.simpleString()
    if source is None:
        if not column.nullable:
            yield _error("true", "NULL_VALUE", name, "a value is required")
        return
    if not column.nullable:
        yield _error(f"{text} IS NULL", "NULL_VALUE", name, "a value is required")
    if value is None:
        yield _error(f"{text} IS NOT NULL", "UNKNOWN_DATA_TYPE", name, f"{source.simpleString()} is no {kind}")
        return
    lost = f"{text} IS NOT NULL AND {value} IS NULL"
    if is_number(column.dataType) and (is_number(source) or isinstance(source, T.StringType)):
        # Whole numbers have a form of their own; other texts are numbers if they look like one.
        form = FORMS.get(kind, NUMBER_FORM)
        right_form = f"{text} RLIKE r'{form}'" if isinstance(source, T.StringType) else "true"
        yield _error(f"{lost} AND {right_form}", "INVALID_VALUE_ROW", name, f"out of the range of {kind}")
        yield _error(f"{lost} AND NOT {right_form}", "INVALID_FORMAT_ROW", name, f"not in the form of {kind}")
    elif source != column.dataType:
        yield _error(lost, "INVALID_FORMAT_ROW", name, f"not in the form of {kind}")
    if name in rules.not_empty:
        yield _error(f"{value} = ''", "NULL_OR_EMPTY_STRING", name, "must not be empty")
    if name in rules.max_length:
        yield _error(
            f"char_length({value}) > {rules.max_length[name]}", "INVALID_VALUE_ROW", name, f"longer than {rules.max_length[name]} characters"
        )


def conformed(rows: DataFrame, rules: TableRules) -> DataFrame:
    """``rows`` with ``row``, a struct in the types of the table, ``errors`` and ``extra_columns``.

    ``errors`` holds all that is wrong with a row (code, column name, message), in the order of the table's
    columns and then the size of the row; it is empty for a row that can be written.  The codes:
    NULL_VALUE, NULL_OR_EMPTY_STRING, INVALID_FORMAT_ROW (a text that is no such value), INVALID_VALUE_ROW (a
    number out of range, a text too long), UNKNOWN_DATA_TYPE (a type that never becomes the column's),
    MAX_ROW_SIZE_EXCEEDED.  ``extra_columns`` names the columns with a value that the table lacks.

    All of it is made from the two schemas before the job runs: one projection, no shuffle, no Python.
    """
    held = {column.name: column.dataType for column in rows.schema}
    members, errors = [], []
    for column in rules.schema:
        source = held.get(column.name)
        value = None if source is None else converted(f"`{column.name}`", source, column.dataType)
        members.append(f"'{column.name}', {value or f'CAST(NULL AS {column.dataType.simpleString()})'}")
        errors.extend(_column_errors(column, source, value, rules))
    if rules.max_row_bytes is not None:
        json = f"to_json(struct({', '.join(f'`{name}`' for name in held)}))" if held else "''"
        errors.append(_error(f"octet_length({json}) > {rules.max_row_bytes}", "MAX_ROW_SIZE_EXCEEDED", None, "the row is too large"))
    names = {column.name for column in rules.schema}
    extra = [f"CASE WHEN `{name}` IS NOT NULL THEN '{name}' END" for name in held if name not in names]
    return rows.withColumns(
        {
            "row": F.expr(f"named_struct({', '.join(members)})"),
            "errors": F.expr(f"array_compact(CAST(array({', '.join(errors)}) AS array<{ERROR}>))"),
            "extra_columns": F.expr(f"array_compact(CAST(array({', '.join(extra)}) AS array<string>))"),
        }
    )


def first_error(errors: str = "errors") -> Column:
    """Code of the first error, for `rillet.operators.validate.failure_outcome`; null without errors."""
    return F.get(F.col(errors), F.lit(0))["code"]
