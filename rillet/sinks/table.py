"""The events table: create it, let it gain entity columns, append rows."""

import logging
import re
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from rillet.constants import ALERT_TEXTS, LOAD_COLUMN, UNRECOGNIZED_COLUMN_TEXT
from rillet.operators.route import ADDABLE
from rillet.operators.transform import entity_columns, entity_value
from rillet.schema import ATOMIC_NAMES, events_schema

#: Partition columns of a partitioned table: the day of the load, and the batch.
LOAD_DAY, LOAD_BATCH = "load_day", "load_batch"
#: Batch of rows that `append_rows` adds to a partitioned table.
APPENDED = "appended"

log = logging.getLogger(__name__)


class MissingAtomicColumn(RuntimeError):
    """The table lacks a column that every events table must have: it was not made for events."""


class UnrecognizedColumn(RuntimeError):
    """A column that is neither atomic nor an entity column."""


@contextmanager
def blamed(alert_type: str, columns: Iterable[str] = ()) -> Iterator[None]:
    """An error inside carries the type of its alert and the columns it is about; the innermost such block counts."""
    try:
        yield
    except Exception as error:
        if not hasattr(error, "alert_type"):
            error.alert_type, error.alert_columns = alert_type, list(columns)
        raise


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def create_events_table(spark: SparkSession, table: str, location: str | None = None, partitioned: bool = False) -> bool:
    """Create the table unless it exists; True if it was created.

    A partitioned table has a partition for each day of ``load_tstamp`` and batch, registered in the
    catalog.  Writes to it list no files, reads only those of the partitions they need.
    """
    with blamed("failed_to_show_tables"):
        if table_exists(spark, table):
            return False
    columns = ", ".join(
        f"{field.name} {field.dataType.simpleString()}{'' if field.nullable else ' NOT NULL'}"
        for field in events_schema()
    )
    parts = f"PARTITIONED BY ({LOAD_DAY}, {LOAD_BATCH})" if partitioned else ""
    if partitioned:
        columns += f", {LOAD_DAY} DATE, {LOAD_BATCH} STRING"
    place = f" LOCATION '{location}'" if location else ""
    with blamed("failed_to_create_events_table"):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet {parts}{place}")
    return True


def addable_type(name: str, pipeline: str = "the event pipeline") -> str:
    """Type for a column the table lacks; raises for a column that must not be added."""
    for pattern, _, kind in ADDABLE:
        if re.search(pattern, name):
            return kind
    if name in ATOMIC_NAMES or name == LOAD_COLUMN:
        text = ALERT_TEXTS["table_is_missing_atomic_column"].format(pipeline=pipeline)
        raise MissingAtomicColumn(text.replace("%columns", name))
    raise UnrecognizedColumn(UNRECOGNIZED_COLUMN_TEXT + name)


def add_columns(spark: SparkSession, table: str, names) -> list[str]:
    """Add entity columns one by one; a column that another writer has added meanwhile is fine."""
    typed = {name: addable_type(name) for name in names}
    added = []
    for name, sql_type in typed.items():
        try:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS (`{name}` {sql_type})")
            added.append(name)
        except AnalysisException as error:
            if "ALREADY_EXISTS" not in (error.getCondition() or ""):
                raise
            log.info("%s was added to the table by another writer", name)
    if names:
        spark.catalog.refreshTable(table)
    return added


def table_columns(spark: SparkSession, table: str) -> list[str]:
    """Column names from the catalog, without a look at the files and without a job."""
    return [row[0] for row in spark.sql(f"SHOW COLUMNS IN {table}").collect()]


def evolve_table(spark: SparkSession, table: str, names) -> list[str]:
    """Add those of the columns that the table lacks; returns the added ones."""
    with blamed("failed_to_show_tables"):
        present = set(table_columns(spark, table))
    for name in (*ATOMIC_NAMES, LOAD_COLUMN):
        if name not in present:
            with blamed("table_is_missing_atomic_column", [name]):
                addable_type(name)
    missing = [name for name in names if name not in present]
    with blamed("failed_to_add_columns", missing):
        return add_columns(spark, table, missing)


def table_row(columns, atomic: bool = False) -> list[str]:
    """SQL for a transformed row in the columns of the table; entity columns come from the entities.

    With ``atomic`` the atomic columns come first without being named.
    """
    own = {*ATOMIC_NAMES, LOAD_COLUMN}
    computed = {LOAD_DAY: f"CAST({LOAD_COLUMN} AS DATE) AS {LOAD_DAY}", LOAD_BATCH: f"'{APPENDED}' AS {LOAD_BATCH}"}
    entity = ("unstruct_event_", "contexts_")
    row = [*ATOMIC_NAMES, LOAD_COLUMN] if atomic else []
    for name in columns:
        if name in own:
            row.append(name)
        elif name in computed:
            row.append(computed[name])
        elif name.startswith(entity):
            row.append(entity_value(name))
    return row


def append_rows(rows: DataFrame, table: str, names=None, attempts: int = 3) -> None:
    """Append transformed rows; columns they do not fill become null.

    ``names`` are the entity columns of the rows, found by a pass over them if not given.  The table
    gains those it lacks, so no entity is left out.  The plan is made without a lock.  If it is refused and
    the table's columns are no longer those it was made from, another writer has altered the table: it gains
    what it lacks now, and the same rows are planned again.  Any other refusal is an error at once.
    """
    spark = rows.sparkSession
    if names is None:
        names = sorted(row["name"] for row in entity_columns(rows).collect())
    planned_from = refused = None
    for _ in range(attempts):
        with blamed("failed_to_show_tables"):
            columns = table_columns(spark, table)
        if refused and columns == planned_from:
            break
        try:
            if not set(names) <= set(columns):
                evolve_table(spark, table, names)
                columns = table_columns(spark, table)
            planned_from = columns
            wide = rows.selectExpr(*table_row(columns))
            spark.sql(f"INSERT INTO {table} BY NAME SELECT * FROM {{rows}}", rows=wide)
            return
        except AnalysisException as error:
            planned_from, refused = columns, error
            log.warning("A write to %s was refused; looking whether its columns changed", table)
            spark.catalog.refreshTable(table)
    with blamed("failed_to_open_channel"):
        raise refused
