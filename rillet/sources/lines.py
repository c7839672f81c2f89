"""One reader for all sources: a DataFrame of lines with their place in the source.

Columns: ``value`` (the line), ``src_partition``, ``src_id`` (offset in the partition, null where
the source has none) and ``src_ts`` (when the source got the line).
"""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rillet.constants import DEFAULT_CPU_FACTOR
from rillet.operators.metrics import parallelism
from rillet.sources.brokers import Admission, admission_options

LINE_COLUMNS = ("src_partition", "src_id", "src_ts", "value")

#: Where each kind of source keeps the line columns.
FILE_COLUMNS = {
    "value": "value",
    # Lines of a file have no offsets; the part of the file that is read by one task bounds a partition.
    "src_partition": "xxhash64(_metadata.file_path, _metadata.file_block_start)",
    "src_id": "CAST(NULL AS BIGINT)",
    "src_ts": "CAST(_metadata.file_modification_time AS TIMESTAMP_NTZ)",
}
KAFKA_COLUMNS = {
    "value": "value",
    "src_partition": "CAST(partition AS BIGINT)",
    "src_id": "offset",
    "src_ts": "CAST(timestamp AS TIMESTAMP_NTZ)",
}

#: Formats in which rows are stored by groups that one task reads whole.
ROW_GROUP_FORMATS = ("parquet", "orc")
#: Tasks that parse the rows of a partition of such a file.  A row takes a few tens of bytes there, so a
#: partition of 128 MB has millions of lines, which take a task longer to parse than to read.
ROW_GROUP_TASKS = 8


def normalise(records: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Rename or compute the line columns; ``columns`` gives a SQL expression for each."""
    return records.selectExpr(*[f"{columns[name]} AS {name}" for name in LINE_COLUMNS])


def read_lines(
    spark: SparkSession,
    format: str,
    options: Mapping[str, str],
    columns: Mapping[str, str] | None = None,
    path: str | None = None,
    schema=None,
    streaming: bool = False,
    admission: Admission = Admission(),
) -> DataFrame:
    """Read lines from any Spark source, once or as a stream.

    A stream of files or of Kafka takes bounded micro-batches, by ``admission`` unless ``options`` limit them.

    ``columns`` says where the source keeps the line columns; text files and Kafka are known.  A
    parquet source needs its ``schema`` when it is streamed.
    """
    reader = spark.readStream if streaming else spark.read
    if streaming:
        writers = parallelism(spark.sparkContext.defaultParallelism, DEFAULT_CPU_FACTOR)
        options = admission_options(format, options, writers, admission) | dict(options)
    reader = reader.format(format).options(**options)
    if format == "text":
        # Only a line feed ends a line: a carriage return may be part of a field.
        reader = reader.option("lineSep", options.get("lineSep", "\n"))
    if schema is not None:
        reader = reader.schema(schema)
    records = reader.load(path) if path else reader.load()
    if not streaming:
        records = spread(records, by_row_groups=format in ROW_GROUP_FORMATS)
    if columns is None:
        columns = {"text": FILE_COLUMNS, "kafka": KAFKA_COLUMNS}.get(format, {name: name for name in LINE_COLUMNS})
    return normalise(records, columns)


def spread(records: DataFrame, factor: str = "1", by_row_groups: bool = False) -> DataFrame:
    """Spread a source with few partitions over the cores, since parsing costs more than moving.

    Large sources have more partitions than that and stay as they are, unless they are stored
    ``by_row_groups``: such a file is cut by bytes, but the task that holds the middle of a row group
    reads all of it, so a few partitions hold all rows and the others none.  Its rows are dealt out evenly,
    to a number of tasks that grows with the file.
    """
    wanted = parallelism(records.sparkSession.sparkContext.defaultParallelism, factor)
    partitions = records.rdd.getNumPartitions()
    if by_row_groups:
        return records.repartition(max(wanted, partitions * ROW_GROUP_TASKS))
    return records if partitions >= wanted else records.repartition(wanted)


def since(lines: DataFrame, timestamp: Column) -> DataFrame:
    """Lines the source got at or after a time; the filter reaches the scan of a stored table."""
    return lines.filter(F.col("src_ts") >= timestamp)
