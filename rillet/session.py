"""Session settings the engine relies on, and the shared folder for written data."""

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # All event times are UTC.
    "spark.sql.session.timeZone": "UTC",
    # A JSON object may repeat a key; the last value counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Parsing 131 fields makes methods the JVM refuses to compile (over 8000 bytes of byte code).
    # Beyond that size Spark runs the projections one by one, which is 2-3 times faster here.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session and return it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A new sub-folder of the folder that ``spark.checkpoint.dir`` names.

    On a cluster that is a path all executors and a restarted driver can reach.
    Without the setting the warehouse folder of the session is used.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/rillet-{uuid.uuid4().hex}"


def evaluate_once(flag: str) -> str:
    """SQL for the same flag, kept where it is computed.

    Spark copies the expression of a column into every filter on that column that it pushes down.
    For a flag that depends on the whole parsed line this means parsing each line again for each
    filter.  Spark does not push filters through a column that depends on the partition number.
    """
    return f"({flag}) AND spark_partition_id() >= 0"


def materialise(rows: DataFrame) -> DataFrame:
    """The same rows, computed once and read back from the shared folder.

    For small results of a pass over all lines that are needed more than once: Spark would repeat
    the pass for each use.  The written rows survive the loss of executors.
    """
    folder = shared_folder(rows.sparkSession)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)
