"""What loading a stored stream of lines would give, batch by batch."""

from pyspark.sql import DataFrame, functions as F

from rillet.constants import DEFAULT_MAX_BATCH_BYTES, DEFAULT_MAX_RECORDS_PER_FETCH
from rillet.functions.latency import latency_ms
from rillet.operators.batches import assign_batches, bounded_batches, chunk_rollup, line_units, merge_rollups, numbered
from rillet.operators.parse import parse_lines
from rillet.operators.transform import TRANSFORM_OK, transform_events


def line_chunks(lines: DataFrame, now: str, chunk_records: int = DEFAULT_MAX_RECORDS_PER_FETCH) -> DataFrame:
    rows = transform_events(parse_lines(lines), now)
    return chunk_rollup(rows, F.col(TRANSFORM_OK), chunk_records)


def load_report(
    lines: DataFrame,
    now: str,
    max_bytes: int = DEFAULT_MAX_BATCH_BYTES,
    chunk_records: int = DEFAULT_MAX_RECORDS_PER_FETCH,
    bounded: bool = False,
) -> DataFrame:
    """Per source partition and batch: count, good, bad, bytes, earliest time, end-to-end latency.

    The lines are read once and aggregated to chunks before the only shuffle of their size; all
    later steps work on one row per chunk.

    A batch starts wherever the bytes of its partition pass a multiple of the limit, so it can be larger by
    a chunk, and lines without offsets are one chunk.  With ``bounded`` a batch ends before the limit, lines
    without offsets are numbered, and only a single line can be larger than the limit.
    """
    if bounded:
        rows = transform_events(parse_lines(numbered(lines)), now)
        assigned = bounded_batches(line_units(rows, F.col(TRANSFORM_OK), max_bytes, chunk_records), max_bytes)
    else:
        assigned = assign_batches(line_chunks(lines, now, chunk_records), max_bytes)
    batches = merge_rollups(assigned, "src_partition", "batch_id")
    return batches.withColumn(
        "e2e_latency_ms", latency_ms(F.lit(now).cast("timestamp_ntz"), F.col("earliest"))
    )
