"""The streaming job: lines in, events table and failed events out."""

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rillet.constants import DEFAULT_MAX_BATCH_DELAY
from rillet.plans.load_batch import BatchResult, LoadOptions, load_batch
from rillet.plans.load_once import load_once
from rillet.session import configure
from rillet.sinks.health import add_statuses, create_health_table, failure_status, success_statuses
from rillet.sinks.ledger import Ledger, create_tables
from rillet.sinks.table import create_events_table


def load_stream(
    spark: SparkSession,
    lines: DataFrame,
    options: LoadOptions,
    checkpoint: str,
    table_location: str | None = None,
    available_now: bool = False,
    max_delay: str = DEFAULT_MAX_BATCH_DELAY,
    on_batch: Callable[[int, BatchResult], None] | None = None,
    ledger: Ledger | None = None,
    health_table: str | None = None,
) -> StreamingQuery:
    """Start loading a stream of lines (see `rillet.sources.lines.read_lines`).

    A micro-batch is loaded by `load_batch`, from Spark's cache unless ``options`` say otherwise.  Its offsets are committed to the checkpoint only
    when the table, the failed events and the metrics are written, so delivery is at least once:
    after a fault the same batch is read and loaded again.  The size of a micro-batch is set with
    the limits of the source (bytes, records or files per trigger), its delay with ``max_delay``.

    With a ``ledger`` delivery is exactly once: a batch is loaded by `load_once`, failed events go to
    the ledger's table and the counts of batches to the ledger itself.

    With a ``health_table`` each attempt at a batch adds its status to that table, failed attempts too:
    a row for the service that failed, else one for each service (see `rillet.operators.health`).  So does
    a failure to create the events table.  `rillet.operators.health.alerts` makes alerts of that table.
    """
    configure(spark)
    if options.persist is None:
        options = replace(options, persist=True)
    if health_table:
        create_health_table(spark, health_table)
    try:
        if ledger:
            create_tables(spark, ledger, options.table)
        else:
            create_events_table(spark, options.table, table_location)
    except Exception as error:
        if health_table:
            add_statuses(spark, health_table, failure_status(error, None, options.now))
        raise

    def load(batch: DataFrame, batch_id: int) -> None:
        try:
            result = load_once(batch, options, ledger, batch_id) if ledger else load_batch(batch, options, batch_id)
        except Exception as error:
            if health_table:
                add_statuses(spark, health_table, failure_status(error, batch_id, options.now))
            raise
        if health_table:
            add_statuses(spark, health_table, success_statuses(result, batch_id, options.now))
        if on_batch:
            on_batch(batch_id, result)

    trigger = {"availableNow": True} if available_now else {"processingTime": max_delay}
    return (
        lines.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )
