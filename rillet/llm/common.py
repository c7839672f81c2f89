"""Helpers shared by the operators of this folder."""

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than these white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def checkpointed(rows: DataFrame) -> DataFrame:
    """The same rows, computed once and kept in the shared folder of ``spark.checkpoint.dir``.

    They survive the loss of executors, and Spark removes them when nothing refers to them any
    more (``spark.cleaner.referenceTracking.cleanCheckpoints``).
    """
    if rows.sparkSession.sparkContext.getCheckpointDir() is None:
        _set_checkpoint_folder(rows.sparkSession)
    return rows.checkpoint()


def written(rows: DataFrame) -> DataFrame:
    """The same rows, written below ``spark.checkpoint.dir`` and read again.

    Unlike a checkpoint the new table knows nothing of the plan it came from, whose constraints would
    otherwise multiply in a loop.
    """
    folder = shared_folder(rows.sparkSession)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 200) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows`` rows, so that few rows at a time are held as Python objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def salts(spark: SparkSession) -> int:
    """Parts that a hot group is split into: as many as the session has shuffle partitions."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z in lower case and all else unchanged.

    ``lower`` does that for texts of ASCII only, and much faster than ``translate``.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def group_totals(rows: DataFrame, key: str, salt: str, totals: dict[str, tuple]) -> DataFrame:
    """(key, salt, totals): the totals of each group, once for each part of the group.

    ``totals`` maps a name to (aggregate, column).  A row finds the totals of its group by key and
    salt, so no task gets a whole group, however large: the parts are summed first and the sums
    of the parts then.  Counts are summed, least and largest values taken again.
    """
    again = {"count": "sum", "sum": "sum", "min": "min", "max": "max"}
    parts = rows.groupBy(key, salt).agg(
        *(getattr(F, kind)(column).alias(name) for name, (kind, column) in totals.items())
    )
    whole = parts.groupBy(F.col(key).alias("_key")).agg(
        *(getattr(F, again[kind])(name).alias(name) for name, (kind, _) in totals.items())
    )
    return parts.select(key, salt).join(whole, F.col(key) == F.col("_key")).drop("_key")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, for files that executors write and read."""
    checkpoints = spark.sparkContext.getCheckpointDir()
    if checkpoints is None:
        _set_checkpoint_folder(spark)
        checkpoints = spark.sparkContext.getCheckpointDir()
    return f"{checkpoints}/{uuid.uuid4().hex}"


def _set_checkpoint_folder(spark: SparkSession) -> None:
    """The folder the session names.  A local session without that setting, as in tests, gets its own.

    On a cluster the setting is required: the other machines could not read a folder of the driver's.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines of the cluster share")
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(folder)
