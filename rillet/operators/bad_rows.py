"""Failed events: one row and one self-describing JSON per event that was not loaded."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from rillet.operators.batches import running_start
from rillet.operators.parse import PARSE_ERROR, PARSE_OK
from rillet.operators.transform import CONTEXTS, TRANSFORM_ERROR, TRANSFORM_OK, UNSTRUCT_NAME, UNSTRUCT_VALUE
from rillet.schema import ATOMIC_NAMES

PARSING, TRANSFORM, RUNTIME, SIZE = (
    "loader_parsing_error",
    "loader_transform_error",
    "loader_runtime_error",
    "size_violation",
)


@dataclass(frozen=True)
class Processor:
    """The application that failed events name, and the vendor part of their schema keys."""

    name: str = "rillet"
    version: str = "0.1.0"
    schema_vendor: str = "self:org.example.failed_events"

    def columns(self) -> dict[str, Column]:
        return {"processor_name": F.lit(self.name), "processor_version": F.lit(self.version)}

    def json(self, kind: str, failure: Column, payload: Column) -> Column:
        processor = F.struct(F.lit(self.name).alias("artifact"), F.lit(self.version).alias("version"))
        return F.to_json(
            F.struct(
                F.lit(f"{self.schema_vendor}/{kind}/jsonschema/1-0-0").alias("schema"),
                F.struct(processor.alias("processor"), failure.alias("failure"), payload.alias("payload")).alias("data"),
            )
        )


def _payload() -> Column:
    return F.make_valid_utf8(F.col("value").cast("string"))


def event_json() -> Column:
    """The event of a transformed row as JSON: its atomic values, and its entities by column."""
    entity = F.map_from_arrays(F.array(UNSTRUCT_NAME), F.array(UNSTRUCT_VALUE))
    return F.to_json(
        F.struct(*ATOMIC_NAMES, F.when(F.col(UNSTRUCT_NAME).isNotNull(), entity).alias("unstruct_event"), F.col(CONTEXTS).alias("contexts"))
    )


def rejected_events(rows: DataFrame, rejected: Column, processor: Processor, keep=(), event_payload: bool = False) -> DataFrame:
    """Failed events for the rejected rows of a transformed batch: one pass, one filter.

    The kind follows from the step that failed: parsing, transforming, or the row checks if the
    rows carry an ``error_message``.  ``keep`` names further columns to carry along.  The payload is the
    line; with ``event_payload`` that of an event which was transformed is the event as JSON.
    """
    payload = _payload()
    if event_payload:
        payload = F.when(F.col(TRANSFORM_OK), event_json()).otherwise(payload)
    reasons = [
        (~F.col(PARSE_OK), PARSING, F.to_json(PARSE_ERROR), F.col(PARSE_ERROR)),
        (~F.col(TRANSFORM_OK), TRANSFORM, F.to_json(TRANSFORM_ERROR), F.col(TRANSFORM_ERROR)),
    ]
    if "error_message" in rows.columns:
        reasons.append((F.lit(True), RUNTIME, F.col("error_message"), F.col("error_message")))

    def by_reason(value) -> Column:
        chosen = F.lit(None).cast("string")
        for condition, kind, text, failure in reversed(reasons):
            chosen = F.when(condition, value(kind, text, failure)).otherwise(chosen)
        return chosen

    return rows.filter(rejected).select(
        *keep,
        by_reason(lambda kind, text, failure: F.lit(kind)).alias("kind"),
        *[column.alias(name) for name, column in processor.columns().items()],
        by_reason(lambda kind, text, failure: text).alias("failure"),
        payload.alias("payload"),
        by_reason(lambda kind, text, failure: processor.json(kind, failure, payload)).alias("json"),
    )


def unreadable_events(rows: DataFrame, processor: Processor, keep=()) -> DataFrame:
    """Failed events for the rows that could not be parsed or transformed."""
    return rejected_events(rows, ~F.col(TRANSFORM_OK), processor, keep)


def unwritable_events(rows: DataFrame, message: Column, processor: Processor, keep=()) -> DataFrame:
    """Failed events for rows that the table did not take, with the error message as the failure."""
    payload = _payload()
    return rows.select(
        *keep,
        F.lit(RUNTIME).alias("kind"),
        *[column.alias(name) for name, column in processor.columns().items()],
        message.alias("failure"),
        payload.alias("payload"),
        processor.json(RUNTIME, message, payload).alias("json"),
    )


def limit_size(bad_rows: DataFrame, max_bytes: int, processor: Processor) -> DataFrame:
    """Replace each failed event above the size limit of its sink by a small report of that fact.

    The report carries the size, the limit, the original kind and the first tenth of the limit
    of the payload.
    """
    start = F.substring(F.col("payload").cast("binary"), 1, max_bytes // 10)
    short_payload = F.make_valid_utf8(start.cast("string"))
    failure = F.struct(
        F.lit(max_bytes).alias("maximumAllowedSizeBytes"),
        F.octet_length("json").alias("actualSizeBytes"),
        F.col("kind").alias("expectation"),
    )
    too_large = F.octet_length("json") > max_bytes
    return bad_rows.withColumns(
        {
            "json": F.when(too_large, processor.json(SIZE, failure, short_payload)).otherwise(F.col("json")),
            "failure": F.when(too_large, F.to_json(failure)).otherwise(F.col("failure")),
            "payload": F.when(too_large, short_payload).otherwise(F.col("payload")),
            "kind": F.when(too_large, F.lit(SIZE)).otherwise(F.col("kind")),
        }
    )


def sink_groups(bad_rows: DataFrame, record_limit: int, byte_limit: int) -> DataFrame:
    """Number the requests to a sink that takes limited records and bytes per request.

    Rows carry ``src_partition`` and ``src_id``.  A request holds the rows of one source partition
    whose running record count and running bytes fall into the same multiple of both limits.
    """
    sized = bad_rows.withColumns({"records": F.lit(1).cast("bigint"), "bytes": F.octet_length("json").cast("bigint")})
    placed = running_start(sized, "src_partition", "src_id", ["records", "bytes"], block=100_000)
    return placed.withColumns(
        {
            "record_group": F.floor(F.col("start_records") / record_limit),
            "byte_group": F.floor(F.col("start_bytes") / byte_limit),
        }
    ).drop("start_records", "start_bytes", "records")
