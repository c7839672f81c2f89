"""Load one batch of lines into the events table."""

import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, functions as F

from rillet.constants import DEFAULT_MAX_BATCH_BYTES
from rillet.functions.errors import is_data_issue
from rillet.operators.bad_rows import Processor, limit_size, rejected_events
from rillet.operators.metrics import metric_columns
from rillet.operators.parse import parse_lines
from rillet.operators.transform import CONTEXT_NAMES, TRANSFORM_OK, UNSTRUCT_NAME, entity_names, transform_events
from rillet.operators.validate import Validator, row_validators, validate_rows
from rillet.session import configure, evaluate_once, shared_folder
from rillet.sinks.failed_events import FailedEventSink
from rillet.sinks.ledger import remove
from rillet.sinks.table import append_rows, evolve_table


class FatalWriteError(RuntimeError):
    """A row failed for a reason that is not in its data: nothing of the batch is loaded."""


class FailedEventSinkError(RuntimeError):
    """The failed events of a batch could not be written."""


@dataclass(frozen=True)
class LoadOptions:
    table: str
    #: Not used with a ledger, which has its own table for failed events.
    failed_events: FailedEventSink | None = None
    skip_schemas: Sequence[str] = ()
    with_schema_version: bool = True
    processor: Processor = Processor()
    max_failed_event_bytes: int = 1_000_000
    #: The payload of an event that fails the row checks is the event as JSON instead of its line.
    event_payload: bool = False
    #: Lines of more bytes become failed events; the table itself has no such limit.
    max_row_bytes: int | None = None
    validators: Sequence[Validator] = ()
    #: Keep the transformed batch in Spark's cache for the reads that follow, instead of staging it in the shared
    #: folder.  By default only `load_stream` does so: Spark holds up to 100 column batches of 4 MB for each
    #: partition that it caches, so a task needs memory for all rows of a partition of ordinary size.
    persist: bool | None = None
    #: Input bytes per writer, as in a batch of one writer.
    bytes_per_writer: int = DEFAULT_MAX_BATCH_BYTES
    source_time: str | None = None
    metrics_table: str | None = None
    #: Codec of the files that `rillet.plans.load_once` writes.
    compression: str = "snappy"
    #: Clock for load times and latencies, as a UTC time text; the real time by default.
    now: str | None = None


@dataclass(frozen=True)
class BatchResult:
    n: int
    good: int
    bad: int
    bytes: int
    latency_ms: int
    e2e_latency_ms: int | None
    added_columns: list = field(default_factory=list)


def prepare_rows(lines: DataFrame, options: LoadOptions, now: str) -> DataFrame:
    """Parse, transform and check the lines: every line stays, with what is to become of it.

    ``insertable`` marks the rows for the table.
    """
    rows = transform_events(parse_lines(lines), now, options.skip_schemas, options.with_schema_version)
    validated = validate_rows(rows, row_validators(options.max_row_bytes, options.validators))
    return validated.withColumn("insertable", F.expr(evaluate_once(f"{TRANSFORM_OK} AND error_code IS NULL")))


def failed_events(rows: DataFrame, options: LoadOptions) -> DataFrame:
    """Failed events of a prepared batch, cut to the size limit."""
    bad = rejected_events(rows, ~F.col("insertable"), options.processor, event_payload=options.event_payload)
    return limit_size(bad, options.max_failed_event_bytes, options.processor)


def load_batch(lines: DataFrame, options: LoadOptions, batch_id: int | None = None) -> BatchResult:
    """Load a batch: evolve the table, append the good rows, send the failed events, report.

    Only after all of that does the caller acknowledge the input, so a fault at any step means
    that the batch is loaded again.  Nothing is written if a row fails for a fatal reason.
    Staged rows are removed at the end, also after a fault.
    """
    spark = configure(lines.sparkSession)
    started = datetime.now(timezone.utc)
    now = options.now or started.strftime("%Y-%m-%d %H:%M:%S.%f")
    rows = prepare_rows(lines, options, now)
    folder = None if options.persist else shared_folder(spark)
    if options.persist:
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if options.persist:
            counts = fill_cache(rows, options, now)
        else:
            rows, counts = stage_rows(rows, folder, options, now)
        report, names = survey(counts)
        if report is None:
            return BatchResult(0, 0, 0, 0, 0, None)
        if report["fatal"]:
            raise FatalWriteError(f"{report['fatal']} rows of the batch failed for other reasons than their data")

        added = []
        if report["transformed"]:
            added = evolve_table(spark, options.table, names)
            good = rows.filter("insertable").coalesce(_writers(report["bytes"], options))
            append_rows(good, options.table, names)
        if report["bad"]:
            try:
                options.failed_events.write(failed_events(rows, options))
            except Exception as error:
                raise FailedEventSinkError(str(error)) from error
        latency = report["e2e_latency_ms"]
        if latency is not None and options.now is None:
            # An event has arrived once its batch is written.
            latency += elapsed_ms(started)
        if options.metrics_table:
            _append_metrics(spark, report, latency, now, batch_id, options.metrics_table)
        return BatchResult(
            report["n"], report["good"], report["bad"], report["bytes"],
            report["latency_ms"], latency, added,
        )
    finally:
        if options.persist:
            rows.unpersist()
        else:
            remove(spark, folder)


def elapsed_ms(started: datetime) -> int:
    return int((datetime.now(timezone.utc) - started).total_seconds() * 1000)


def stage_rows(rows: DataFrame, folder: str, options: LoadOptions, now: str) -> tuple[DataFrame, Observation]:
    """The prepared rows, written once by outcome and read back, and the counts that the write observed.

    The lines are parsed once, however often the rows are read and whichever executors are lost.  A
    read of one outcome skips the others' files.
    """
    outcome = F.when(F.col("insertable"), F.lit("good")).otherwise(F.lit("bad"))
    counts = Observation()
    counted = rows.observe(counts, *batch_counts(options, now))
    counted.withColumn("outcome", outcome).write.partitionBy("outcome").parquet(folder)
    schema = rows.schema.add("outcome", "string")
    # The flag follows from the folder, so a filter on it reads the files of one outcome only.
    staged = rows.sparkSession.read.schema(schema).parquet(folder)
    return staged.withColumn("insertable", F.col("outcome") == "good").drop("outcome"), counts


def fill_cache(rows: DataFrame, options: LoadOptions, now: str) -> Observation:
    """Compute the persisted rows, in one job without a shuffle, and count them meanwhile."""
    counts = Observation()
    source_time = [options.source_time] if options.source_time else []
    read = ["value", "parse_ok", TRANSFORM_OK, "insertable", "error_code", "collector_tstamp", CONTEXT_NAMES, UNSTRUCT_NAME]
    needed = rows.select(*dict.fromkeys([*read, *source_time]))
    needed.observe(counts, *batch_counts(options, now)).write.format("noop").mode("overwrite").save()
    return counts


def batch_counts(options: LoadOptions, now: str) -> list[Column]:
    """Aggregates that a pass over prepared rows can observe: the metrics of the batch, and ``names``.

    ``names`` is the schema of an object with one member for each entity column of the transformed
    rows, also of rows that fail the checks, so its size is that of the distinct names.  A task that ran twice
    counts once, since no shuffle follows the observation.
    """
    fatal = F.col(TRANSFORM_OK) & F.col("error_code").isNotNull() & ~is_data_issue(F.col("error_code"))
    members = F.map_from_arrays(entity_names(), F.transform(entity_names(), lambda _: F.lit(None).cast("int")))
    return [
        *metric_columns(F.col("insertable"), F.lit(now).cast("timestamp_ntz"), options.source_time),
        F.count_if(fatal).alias("fatal"),
        F.count_if(F.col(TRANSFORM_OK)).alias("transformed"),
        F.schema_of_variant_agg(F.to_variant_object(members)).alias("names"),
    ]


def survey(counts: Observation) -> tuple[dict | None, list[str]]:
    """Counts of the batch, and the entity columns its rows need; no counts for a batch without rows."""
    report = counts.get
    if not report.get("n"):
        return None, []
    return report, sorted(re.findall(r"\w+(?=`?: )", report["names"] or ""))


def _writers(n_bytes: int, options: LoadOptions) -> int:
    return max(1, -(-n_bytes // options.bytes_per_writer))


def _append_metrics(spark, report, latency, now, batch_id, table: str) -> None:
    row = [(now, batch_id, report["good"], report["bad"], report["bytes"], report["latency_ms"], latency)]
    frame = spark.createDataFrame(
        row, "t string, batch_id bigint, good bigint, bad bigint, bytes bigint, latency_ms bigint, e2e_latency_ms bigint"
    )
    frame.withColumn("t", F.col("t").cast("timestamp_ntz")).write.mode("append").saveAsTable(table)
