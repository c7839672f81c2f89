"""The ledger of loaded batches: one partition per batch, registered in the catalog in one step.

The events table and the table of failed events are partitioned by day and batch, and their partitions
are registered in the catalog with the folder of the batch's files.  So nothing ever lists the files of a
table: an append adds one partition, however many there are, and a reader looks at the folders of
the days it asks for.
"""

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from rillet.sinks.table import create_events_table

#: What the ledger keeps of a batch.  The folders are null where a batch has no such rows.
RECORD = """load_day DATE, n BIGINT, good BIGINT, bad BIGINT, bytes BIGINT, earliest TIMESTAMP_NTZ, latency_ms BIGINT,
    e2e_latency_ms BIGINT, names ARRAY<STRING>, good_folder STRING, bad_folder STRING, loaded TIMESTAMP_NTZ"""
FAILED = "kind STRING, processor_name STRING, processor_version STRING, failure STRING, payload STRING, json STRING"


@dataclass(frozen=True)
class Ledger:
    """table: the ledger.  failed_table: the failed events.  folder: where the files of batches are written,
    on storage that all executors and a restarted driver reach.  stream: name of the stream; its batch ids
    are numbers that a replay repeats, so a new checkpoint needs a new name."""

    table: str
    failed_table: str
    folder: str
    stream: str = "events"

    def __post_init__(self):
        if "'" in self.stream or "/" in self.stream:
            raise ValueError("the name of a stream has no quotes or slashes")


def create_tables(spark: SparkSession, ledger: Ledger, events: str) -> None:
    """Create the events table, the table of failed events and the ledger where they do not exist."""
    create_events_table(spark, events, partitioned=True)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {ledger.failed_table} ({FAILED}, load_day DATE, load_batch STRING) USING parquet PARTITIONED BY (load_day, load_batch)")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {ledger.table} ({RECORD}, stream STRING, batch_id BIGINT) USING parquet PARTITIONED BY (stream, batch_id)")


def committed(spark: SparkSession, ledger: Ledger, batch_id: int) -> Row | None:
    """What the ledger says of a batch; null if it was not committed."""
    spark.catalog.refreshTable(ledger.table)
    return spark.table(ledger.table).filter((F.col("stream") == ledger.stream) & (F.col("batch_id") == batch_id)).first()


def commit(spark: SparkSession, ledger: Ledger, batch_id: int, folder: str) -> bool:
    """Enter a batch, whose record lies in the folder; false if another attempt has done so before.

    The catalog adds a partition once only, so of several attempts at a batch one is committed.
    """
    try:
        spark.sql(f"ALTER TABLE {ledger.table} ADD PARTITION (stream = '{ledger.stream}', batch_id = {batch_id}) LOCATION '{folder}'")
    except AnalysisException as error:
        if "ALREADY_EXIST" not in (error.getCondition() or ""):
            raise
        return False
    return True


def publish(spark: SparkSession, ledger: Ledger, batch_id: int, events: str, record: Row) -> None:
    """Add the folders of a committed batch to the tables.  Doing so again changes nothing."""
    for table, folder in ((events, record["good_folder"]), (ledger.failed_table, record["bad_folder"])):
        if folder is not None:
            spec = f"load_day = DATE'{record['load_day']}', load_batch = '{ledger.stream}-{batch_id}'"
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{folder}'")


def batch_metrics(spark: SparkSession, ledger: Ledger) -> DataFrame:
    """The batches of the ledger as `rillet.operators.metrics.metrics_report` reads them; each batch counts once."""
    columns = ["loaded AS t", "batch_id", "n", "good", "bad", "bytes", "latency_ms", "e2e_latency_ms"]
    return spark.table(ledger.table).filter(F.col("stream") == ledger.stream).selectExpr(*columns)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder that no table refers to."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
