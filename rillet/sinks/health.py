"""The table of statuses that a load writes, one or more rows per attempt at a batch."""

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from rillet.operators.health import BLAME, FAILED_EVENTS, SOURCE, STATUS, TABLE
from rillet.plans.load_batch import BatchResult, FailedEventSinkError
from rillet.sinks.table import MissingAtomicColumn, UnrecognizedColumn, table_columns

#: Errors that do not pass by themselves: the table, its columns or the rights to it are not as the load needs them.
SETUP_ERRORS = (AnalysisException, MissingAtomicColumn, UnrecognizedColumn)


def create_health_table(spark: SparkSession, table: str) -> None:
    """Partitioned by day in the catalog, so that adding a status lists no files."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({STATUS}, {BLAME}, day DATE) USING parquet PARTITIONED BY (day)")
    if "alert_type" not in table_columns(spark, table):
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({BLAME})")


def _time(now: str | None) -> datetime:
    return datetime.fromisoformat(now) if now else datetime.now(timezone.utc).replace(tzinfo=None)


def success_statuses(result: BatchResult, batch_id: int, now: str | None = None) -> list[tuple]:
    """Healthy services after a batch; the source carries the latency of the batch."""
    rows = [(TABLE, None), (SOURCE, result.latency_ms)]
    if result.bad:
        rows.append((FAILED_EVENTS, None))
    return [(_time(now), batch_id, service, False, latency, None, None, None, None) for service, latency in rows]


def failure_status(error: Exception, batch_id: int | None, now: str | None = None) -> list[tuple]:
    """The service that an attempt failed at, with the first line of the error and what an alert needs.

    ``batch_id`` is null for a failure before the first batch.
    """
    service = FAILED_EVENTS if isinstance(error, FailedEventSinkError) else TABLE
    cause = (str(error).strip() or type(error).__name__).split("\n")[0]
    blame = getattr(error, "alert_type", None), getattr(error, "alert_columns", None), isinstance(error, SETUP_ERRORS)
    return [(_time(now), batch_id, service, True, None, cause, *blame)]


def add_statuses(spark: SparkSession, table: str, rows: list[tuple]) -> None:
    frame = spark.createDataFrame(rows, f"{STATUS}, {BLAME}").selectExpr("*", "CAST(t AS DATE) AS day")
    frame.coalesce(1).write.mode("append").insertInto(table)
