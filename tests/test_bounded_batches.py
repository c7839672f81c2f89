"""Batches that end before the limit, against going through each partition, for sources with and without offsets."""

import random

import pytest
from pyspark.sql import functions as F

from rillet.operators.batches import bounded_batches, line_units, numbered
from rillet.plans.load_report import load_report
from rillet.sources.brokers import KINESIS_COLUMNS, PUBSUB_COLUMNS
from rillet.sources.lines import FILE_COLUMNS, normalise, read_lines
from tests.lines import NOW

UNITS = "src_partition bigint, unit bigint, bytes bigint"


def _greedy(rows, limit):
    found, batch, held = {}, {}, {}
    for partition, unit, size in sorted(rows):
        size = max(1, size)
        if partition not in batch:
            batch[partition], held[partition] = 0, 0
        elif held[partition] + size > limit:
            batch[partition] += 1
            held[partition] = 0
        held[partition] += size
        found[partition, unit] = batch[partition]
    return found


@pytest.mark.parametrize("sizes", ["small", "mixed", "zero", "all too large"])
def test_against_going_through(spark, sizes):
    rng = random.Random(sizes)
    draw = {
        "small": lambda: rng.randrange(1, 40),
        "mixed": lambda: rng.choice([0, 1, 5, 60, 99, 100, 101, 350, 1200]),
        "zero": lambda: 0,
        "all too large": lambda: 500,
    }[sizes]
    # One partition has most of the units; numbers have gaps.
    rows = [(p, unit * 7 + p, draw()) for p, count in ((0, 400), (1, 40), (2, 1), (-3, 3)) for unit in range(count)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, UNITS).repartition(5)
    found = bounded_batches(frame, 100).collect()
    assert {(r["src_partition"], r["unit"]): r["batch_id"] for r in found} == _greedy(rows, 100)
    assert len(found) == len(rows)


def test_no_units(spark):
    assert bounded_batches(spark.createDataFrame([], UNITS), 100).collect() == []


def _sizes(lines, limit, chunk=10):
    rows = numbered(lines).withColumns({"parse_ok": F.lit(True), "collector_tstamp": F.lit(None).cast("timestamp_ntz")})
    units = line_units(rows, F.lit(True), limit, chunk)
    sums = bounded_batches(units, limit).groupBy("src_partition", "batch_id").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
    return [(r["bytes"], r["n"]) for r in sums.collect()]


def _bounded(sizes, limit, n):
    assert sum(count for _, count in sizes) == n
    assert all(size <= limit or count == 1 for size, count in sizes) and len(sizes) > 3


def test_text_split(spark, folder):
    """Lines of a file have no offsets; short and long ones, one beyond the limit."""
    rng = random.Random(2)
    lines = ["x" * rng.choice([0, 3, 20, 90, 400]) for _ in range(300)] + ["y" * 5000]
    with open(f"{folder}/a.txt", "w") as file:
        file.write("\n".join(lines) + "\n")
    read = read_lines(spark, "text", {}, FILE_COLUMNS, path=f"{folder}/a.txt")
    assert read.filter("src_id IS NOT NULL").count() == 0
    _bounded(_sizes(read, 1000), 1000, 301)


def test_shard_and_messages(spark):
    records = spark.range(500).selectExpr(
        "cast(repeat('z', cast(id % 97 as int)) as binary) AS data", "'shard-0' AS shardId", "timestamp'2024-01-01' AS approximateArrivalTimestamp",
        "cast(repeat('z', cast(id % 97 as int)) as binary) AS payload", "1700000000123L + id DIV 400 AS publishTimestampInMillis",
    )
    for columns in (KINESIS_COLUMNS, PUBSUB_COLUMNS):
        _bounded(_sizes(normalise(records, columns), 1000), 1000, 500)


def test_report_of_lines_without_offsets(spark, folder):
    with open(f"{folder}/a.txt", "w") as file:
        file.write("\n".join(f"nonsense {n}" for n in range(200)) + "\n")
    lines = read_lines(spark, "text", {}, path=f"{folder}/a.txt")
    report = load_report(lines, NOW, 300, 5, bounded=True).collect()
    assert sum(r["bad"] for r in report) == 200 and max(r["bytes"] for r in report) <= 300 and len(report) >= 8
