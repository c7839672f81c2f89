"""The metrics of periods as a streaming job of its own over the metrics of batches."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from rillet import constants as C
from rillet.operators.metrics import metrics_report
from rillet.session import configure, materialise

#: What the job reads of a batch: `rillet.plans.load_batch` writes it, `rillet.sinks.ledger` keeps it.
BATCH_METRICS = "t TIMESTAMP_NTZ, batch_id BIGINT, good BIGINT, bad BIGINT, bytes BIGINT, latency_ms BIGINT, e2e_latency_ms BIGINT"
ROLLUP = f"period TIMESTAMP_NTZ, {C.METRIC_GOOD} BIGINT, {C.METRIC_BAD} BIGINT, {C.METRIC_LATENCY} BIGINT, {C.METRIC_E2E_LATENCY} BIGINT, day DATE"


def create_rollup_table(spark: SparkSession, table: str) -> None:
    """One partition per day, registered in the catalog."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ROLLUP}) USING parquet PARTITIONED BY (day)")


def stored_batches(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """The metrics of batches as a stream of the files below a folder, in the order they were written."""
    schema = StructType.fromDDL(BATCH_METRICS)
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).option("recursiveFileLookup", True)
    return reader.parquet(path)


def roll_up(
    batches: DataFrame,
    table: str,
    checkpoint: str,
    period: str = C.DEFAULT_METRICS_PERIOD,
    late: str = "1 hour",
    available_now: bool = False,
) -> StreamingQuery:
    """Keep ``table`` at the sums and maxima of each period of a stream of batch metrics.

    The state holds the periods of the last ``late``; a batch that comes later than that may not count.
    Whenever batches change periods, the days that these are in are written anew, with the changed periods
    in place of what they were.  So a late batch corrects its period, a replay after a fault writes the
    same again, and a day has one file however many batches it had.
    """
    spark = configure(batches.sparkSession)
    create_rollup_table(spark, table)
    # Watermarks need times with a zone; the session's is UTC.
    timed = batches.withColumn("t", F.col("t").cast("timestamp"))
    rolled = metrics_report(timed.withWatermark("t", late), period)

    def write(changed: DataFrame, _: int) -> None:
        session = changed.sparkSession
        session.catalog.refreshTable(table)
        new = materialise(changed.withColumn("period", F.col("period").cast("timestamp_ntz")).withColumn("day", F.col("period").cast("date")))
        if new.isEmpty():
            return
        stored = session.table(table).join(new.select("day").distinct(), "day", "left_semi").join(new.select("period"), "period", "left_anti")
        # Written aside first: the partitions it is read from are replaced.
        whole = materialise(stored.select(new.columns).union(new).repartition("day"))
        ordered = whole.select(*session.table(table).columns).sortWithinPartitions("day", "period")
        ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(table)

    trigger = {"availableNow": True} if available_now else {"processingTime": period}
    started = rolled.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return started.trigger(**trigger).start()
