"""Load a batch exactly once: a replay finds what was loaded before and adds nothing."""

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, functions as F

from rillet.plans.load_batch import (
    BatchResult, FatalWriteError, LoadOptions, elapsed_ms, failed_events, prepare_rows, stage_rows, survey,
)
from rillet.session import configure
from rillet.sinks.ledger import RECORD, Ledger, commit, committed, publish, remove
from rillet.sinks.table import evolve_table, table_row


def load_once(lines: DataFrame, options: LoadOptions, ledger: Ledger, batch_id: int) -> BatchResult:
    """Load a batch unless the ledger has it.

    1. The lines are parsed once into a staged table of the batch, by outcome.
    2. Its good rows and failed events are written to folders of this attempt, which no table knows yet.
    3. The ledger gets the batch, with its folders and counts: one step, which succeeds once per batch.
    4. The events table gains the columns and, like the table of failed events, the folder of the batch.

    A fault before 3 leaves files that nobody reads; the replay starts anew.  A fault after 3 leaves
    step 4, which the replay takes from the ledger; both of its parts may be done twice.  Of two
    attempts at a time the second one finds the ledger entry of the first and drops its own files.
    A row that fails for a fatal reason stops the batch before 3.
    """
    spark = configure(lines.sparkSession)
    record, added = committed(spark, ledger, batch_id), []
    if record is None:
        folder = f"{ledger.folder.rstrip('/')}/{ledger.stream}/{batch_id}/{uuid.uuid4().hex}"
        if not _write(lines, options, folder):
            remove(spark, folder)
            return BatchResult(0, 0, 0, 0, 0, None)
        won = commit(spark, ledger, batch_id, f"{folder}/record")
        remove(spark, f"{folder}/rows" if won else folder)
        record = committed(spark, ledger, batch_id)
    if record["names"] is not None:
        added = evolve_table(spark, options.table, record["names"])
    publish(spark, ledger, batch_id, options.table, record)
    return BatchResult(
        record["n"], record["good"], record["bad"], record["bytes"], record["latency_ms"], record["e2e_latency_ms"], added
    )


def _write(lines: DataFrame, options: LoadOptions, folder: str) -> bool:
    """Write the good rows, failed events and record of a batch below the folder; false for an empty batch."""
    spark = lines.sparkSession
    started = datetime.now(timezone.utc)
    now = options.now or started.strftime("%Y-%m-%d %H:%M:%S.%f")
    rows, counts = stage_rows(prepare_rows(lines, options, now), f"{folder}/rows", options, now)
    report, names = survey(counts)
    if report is None:
        return False
    if report["fatal"]:
        raise FatalWriteError(f"{report['fatal']} rows of the batch failed for other reasons than their data")
    if report["good"]:
        # Entity columns of other batches are not in the files; readers see null there.
        good = rows.filter("insertable").selectExpr(*table_row(names, atomic=True))
        good.write.option("compression", options.compression).parquet(f"{folder}/good")
    if report["bad"]:
        failed_events(rows, options).write.parquet(f"{folder}/bad")
    latency = report["e2e_latency_ms"]
    if latency is not None and options.now is None:
        latency += elapsed_ms(started)
    record = Row(
        load_day=datetime.fromisoformat(now).date(), n=report["n"], good=report["good"], bad=report["bad"], bytes=report["bytes"],
        earliest=report["earliest"], latency_ms=report["latency_ms"], e2e_latency_ms=latency,
        names=names if report["transformed"] else None,
        good_folder=f"{folder}/good" if report["good"] else None, bad_folder=f"{folder}/bad" if report["bad"] else None,
        loaded=datetime.fromisoformat(now),
    )
    spark.createDataFrame([record], RECORD.replace("\n", " ")).coalesce(1).write.parquet(f"{folder}/record")
    return True
