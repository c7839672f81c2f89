"""The events table and the layout of an input line, derived from the column list."""

from pyspark.sql import types as T

from rillet.constants import ATOMIC_COLUMNS, JSON_FIELDS, LOAD_COLUMN, NOT_NULL_COLUMNS

#: (name, SQL type) of the 128 columns an input line can fill, in table order.
ATOMIC_FIELDS = tuple(tuple(line.split(" ", 1)) for line in ATOMIC_COLUMNS.split("\n") if line)

ATOMIC_NAMES = tuple(name for name, _ in ATOMIC_FIELDS)


def _line_layout():
    """Names of the line fields in line order: atomic columns with the JSON fields between them."""
    json_after = {column: field for field, column in JSON_FIELDS.items()}
    for name in ATOMIC_NAMES:
        yield name
        if name in json_after:
            yield json_after[name]


#: Field name -> 0-based position in the line.
LINE_POSITIONS = {name: position for position, name in enumerate(_line_layout())}

#: Types of the entity columns that the table gains over time.
UNSTRUCT_TYPE = "variant"
CONTEXTS_TYPE = "array<variant>"


def events_schema() -> T.StructType:
    """Schema of a new events table: 128 atomic columns and the load timestamp."""
    ddl = ", ".join(
        f"{name} {sql_type}{' NOT NULL' if name in NOT_NULL_COLUMNS else ''}"
        for name, sql_type in (*ATOMIC_FIELDS, (LOAD_COLUMN, "timestamp_ntz"))
    )
    return T.StructType.fromDDL(ddl)
