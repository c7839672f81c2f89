"""Size batches: chunks of a source partition are put together until a byte limit is reached."""

from pyspark.sql import DataFrame, Window, functions as F

from rillet.constants import DEFAULT_MAX_BATCH_BYTES, DEFAULT_MAX_RECORDS_PER_FETCH
from rillet.functions.alerts import channel_name
from rillet.session import materialise


def running_start(rows: DataFrame, partition: str, order: str, measures: list[str], block: int) -> DataFrame:
    """For each row the sum of each measure over all earlier rows of its partition.

    Adds ``start_<measure>``.  ``order`` is a whole number that is unique in a partition, such as
    an offset.  A partition may hold a third of all rows, so it is never one window: the order is
    cut into blocks of at most ``block`` rows, the totals of the blocks are summed up first, and
    the rows are summed inside their blocks.  The rows are read for both, so they are written once
    before: pass a rollup or another small part of the lines.  A row without an order is an error.
    """
    keys = [partition, "block"]
    placed = F.coalesce(F.col(order), F.raise_error(F.lit(f"{order} is null: nothing orders these rows")).cast("long"))
    blocked = materialise(rows).withColumn("block", F.floor(placed / block))
    totals = blocked.groupBy(*keys).agg(*[F.sum(m).alias(f"total_{m}") for m in measures])
    earlier_blocks = Window.partitionBy(partition).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, *[F.coalesce(F.sum(f"total_{m}").over(earlier_blocks), F.lit(0)).alias(f"offset_{m}") for m in measures]
    )
    earlier_rows = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    inside = blocked.withColumns({f"inside_{m}": F.coalesce(F.sum(m).over(earlier_rows), F.lit(0)) for m in measures})
    return (
        inside.join(offsets, keys)
        .withColumns({f"start_{m}": F.col(f"offset_{m}") + F.col(f"inside_{m}") for m in measures})
        .drop("block", *[f"{kind}_{m}" for m in measures for kind in ("inside", "offset")])
    )


def chunk_rollup(rows: DataFrame, ok, chunk_records: int = DEFAULT_MAX_RECORDS_PER_FETCH) -> DataFrame:
    """Counts, bytes and earliest time for each chunk of ``chunk_records`` offsets.

    ``n`` and ``bytes`` cover all rows, ``good`` the rows that are ``ok``, ``earliest`` the parsed
    rows.  Rows are aggregated before the shuffle, and a busy partition has many chunks.  Lines
    without offsets are one chunk of their partition.
    """
    chunk = F.coalesce(F.floor(F.col("src_id") / chunk_records), F.lit(0).cast("long"))
    return rows.groupBy("src_partition", chunk.alias("chunk_id")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(ok).alias("good"),
        F.sum(F.octet_length("value")).alias("bytes"),
        F.min(F.when(F.col("parse_ok"), F.col("collector_tstamp"))).alias("earliest"),
    )


def assign_batches(chunks: DataFrame, max_bytes: int = DEFAULT_MAX_BATCH_BYTES) -> DataFrame:
    """Number the batches of each source partition: ``batch_id`` grows with every ``max_bytes``."""
    placed = running_start(chunks, "src_partition", "chunk_id", ["bytes"], block=10_000)
    return placed.withColumn("batch_id", F.floor(F.col("start_bytes") / max_bytes)).drop("start_bytes")


def merge_rollups(rollups: DataFrame, *keys: str) -> DataFrame:
    """Combine partial rollups: counts and bytes add up, the earliest time is the earliest present."""
    return rollups.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.sum("good").alias("good"),
        (F.sum("n") - F.sum("good")).alias("bad"),
        F.sum("bytes").alias("bytes"),
        F.min("earliest").alias("earliest"),
    )


def round_robin(batches: DataFrame, writers: int, prefix: str) -> DataFrame:
    """Rotate the batches over writers: ``channel`` is the name of the writer of a batch."""
    return batches.withColumn("channel", channel_name(prefix, F.col("batch_id") % writers))


def numbered(lines: DataFrame) -> DataFrame:
    """The lines with a number for those that have no offset: their place in the part that a task reads."""
    return lines.withColumn("src_id", F.coalesce("src_id", F.monotonically_increasing_id()))


def line_units(rows: DataFrame, ok, max_bytes: int = DEFAULT_MAX_BATCH_BYTES, chunk_records: int = DEFAULT_MAX_RECORDS_PER_FETCH) -> DataFrame:
    """As `chunk_rollup`, but with chunks that fit into a batch: no unit has more than ``max_bytes``, or is one line.

    A line that is so long that a chunk of such lines would be too large is a unit of its own.  Rows
    need numbers (`numbered`).  ``unit`` is the first number of a unit and so unique in its partition.
    """
    long = F.octet_length("value") > max_bytes // chunk_records
    return (
        rows.groupBy("src_partition", F.floor(F.col("src_id") / chunk_records).alias("chunk_id"), F.when(long, F.col("src_id")).alias("line"))
        .agg(
            F.min("src_id").alias("unit"),
            F.count(F.lit(1)).alias("n"),
            F.count_if(ok).alias("good"),
            F.coalesce(F.sum(F.octet_length("value")), F.lit(0)).alias("bytes"),
            F.min(F.when(F.col("parse_ok"), F.col("collector_tstamp"))).alias("earliest"),
        )
        .drop("chunk_id", "line")
    )


def _following(units: DataFrame, max_bytes: int) -> DataFrame:
    """(src_partition, node, next) for each unit: where the batch after it starts if one starts at it.

    Units are named by the sum of weights up to their end.  The unit looked for is the first one that ends
    beyond a target.  Ends and targets are cut into stretches of ``max_bytes``: the search in a stretch is a
    window of bounded size; where a stretch has no such unit, it is the first of the next stretch that has any.
    """
    target = F.col("start_weight") + F.greatest(F.lit(max_bytes), "weight")
    ends = units.select("src_partition", F.col("node").alias("at"), F.col("node").alias("end"), F.lit(None).cast("long").alias("node"))
    targets = units.select("src_partition", target.alias("at"), F.lit(None).cast("long").alias("end"), "node")
    both = ends.union(targets).withColumn("stretch", F.expr(f"at DIV {max_bytes}"))
    # From the end of the stretch backwards; an end at the target itself is not beyond it.
    beyond = Window.partitionBy("src_partition", "stretch").orderBy(F.desc("at"), F.col("end").isNotNull())
    inside = both.withColumn("found", F.last("end", ignorenulls=True).over(beyond.rowsBetween(Window.unboundedPreceding, 0)))
    firsts = both.groupBy("src_partition", "stretch").agg(F.min("end").alias("first"))
    later = Window.partitionBy("src_partition").orderBy(F.desc("stretch")).rowsBetween(Window.unboundedPreceding, -1)
    firsts = firsts.select("src_partition", "stretch", F.last("first", ignorenulls=True).over(later).alias("later"))
    return (
        inside.filter("node IS NOT NULL").join(firsts, ["src_partition", "stretch"])
        .select("src_partition", "node", F.coalesce("found", "later").alias("next")).filter("next IS NOT NULL")
    )


def bounded_batches(units: DataFrame, max_bytes: int = DEFAULT_MAX_BATCH_BYTES) -> DataFrame:
    """Number the batches of each source partition; a batch ends before the unit that would bring it over the limit.

    ``units`` has src_partition, unit (a number that is unique in its partition and gives the order) and
    bytes; an empty unit weighs one byte.  Adds ``batch_id``, from 0.  Only a batch of one unit can be over
    the limit, so with `line_units` only a single line is.

    Where a batch starts depends on where the one before it started.  Instead of going through a partition
    unit by unit, each unit gets a pointer to the start of the next batch if one starts at it, and the
    pointers are followed from the first unit on by doubling: marked starts mark those a pointer further, then the
    pointers are replaced by pointers of pointers.  So the number of rounds is the logarithm of the batches in the
    largest partition, and no task goes through a partition.  Each round is written to the shared folder.
    """
    weighed = units.withColumn("weight", F.greatest("bytes", F.lit(1).cast("long")))
    placed = running_start(weighed, "src_partition", "unit", ["weight"], block=10_000_000)
    placed = materialise(placed.withColumn("node", F.col("start_weight") + F.col("weight")))
    pointers = materialise(_following(placed, max_bytes))
    marks = materialise(placed.filter("start_weight = 0").select("src_partition", "node"))
    fresh = marks
    while not fresh.isEmpty():
        reached = marks.join(pointers, ["src_partition", "node"]).select("src_partition", F.col("next").alias("node"))
        fresh = materialise(reached.join(marks, ["src_partition", "node"], "left_anti"))
        marks = materialise(marks.union(fresh))
        further = pointers.select("src_partition", F.col("node").alias("next"), F.col("next").alias("_next"))
        pointers = materialise(pointers.join(further, ["src_partition", "next"]).select("src_partition", "node", F.col("_next").alias("next")))
    marked = placed.join(marks.withColumn("starts", F.lit(1).cast("long")), ["src_partition", "node"], "left")
    marked = marked.withColumn("starts", F.coalesce("starts", F.lit(0).cast("long"))).drop("node", "weight", "start_weight")
    counted = running_start(marked, "src_partition", "unit", ["starts"], block=10_000_000)
    return counted.withColumn("batch_id", F.col("start_starts") + F.col("starts") - 1).drop("starts", "start_starts")
