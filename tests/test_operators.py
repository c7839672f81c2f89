import random
import re

import pytest
from pyspark.sql import functions as F

from rillet.constants import MAX_FAILED_EVENT_BYTES
from rillet.functions.entities import skip_pattern
from rillet.functions.errors import error_class, setup_error_message
from rillet.functions.texts import clean_error_text
from rillet.operators.bad_rows import sink_groups
from rillet.operators.batches import assign_batches, running_start
from rillet.operators.metrics import parallelism
from rillet.operators.route import route_column
from rillet.operators.validate import failure_outcome
from rillet.sinks.failed_events import FailedEventSink, request_options
from rillet.sources import brokers
from rillet.sources.lines import KAFKA_COLUMNS, normalise, read_lines, spread


def test_running_start_with_a_hot_partition(spark):
    """A third of the rows in one partition, gaps in the order, blocks smaller than the partition."""
    picks = random.Random(7)
    rows = [(0 if picks.random() < 0.34 else picks.randrange(1, 6), i * picks.randrange(1, 4) * 1000 + i, picks.randrange(0, 50)) for i in range(3000)]
    rows = list({(p, o): (p, o, b) for p, o, b in rows}.values())
    expected, sums = {}, {}
    for p, o, b in sorted(rows):
        expected[p, o] = sums.get(p, 0)
        sums[p] = sums.get(p, 0) + b
    frame = spark.createDataFrame(rows, "p int, o bigint, bytes bigint").repartition(7)
    placed = running_start(frame, "p", "o", ["bytes"], block=10_000)
    assert {(r["p"], r["o"]): r["start_bytes"] for r in placed.collect()} == expected


def test_batches_by_size(spark):
    chunks = spark.createDataFrame([(0, i, 40) for i in range(6)], "src_partition bigint, chunk_id bigint, bytes bigint")
    batches = assign_batches(chunks, 100).orderBy("chunk_id").collect()
    assert [r["batch_id"] for r in batches] == [0, 0, 0, 1, 1, 2]


def test_sink_groups_respect_both_limits(spark):
    rows = [(0, i, "x" * (100 if i % 10 else 900)) for i in range(500)]
    frame = spark.createDataFrame(rows, "src_partition bigint, src_id bigint, json string")
    groups = sink_groups(frame, 20, 3000).groupBy("record_group", "byte_group").agg(F.count("*").alias("n"), F.sum("bytes").alias("b"))
    found = groups.collect()
    assert sum(r["n"] for r in found) == 500
    # The last row of a request may start below the byte limit and end above it.
    assert all(r["n"] <= 20 and r["b"] < 3000 + 900 for r in found)


def test_parallelism():
    assert [parallelism(4, "0.75"), parallelism(4, "2.5"), parallelism(1, "0.75"), parallelism(3, "2.5")] == [3, 10, 1, 8]


def test_spread_keeps_large_sources(spark):
    assert spread(spark.range(100).repartition(50)).rdd.getNumPartitions() == 50
    assert spread(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() > 1


def test_skip_criteria():
    pattern = re.compile(skip_pattern([
        "x:com.acme/skipped1/jsonschema/1-0-0", "x:com.acme/skipped2/jsonschema/1-0-*",
        "x:com.acme/skipped3/jsonschema/1-*-*", "x:com.acme/skipped4/jsonschema/*-*-*",
    ]).replace(r"\z", r"\Z"))
    matched = ["skipped1/jsonschema/1-0-0", "skipped2/jsonschema/1-0-7", "skipped3/jsonschema/1-9-7", "skipped4/jsonschema/12-9-7"]
    others = ["skipped1/jsonschema/1-0-1", "skipped2/jsonschema/1-1-0", "skipped3/jsonschema/2-0-0", "skipped5/jsonschema/1-0-0", "skipped4/other/1-0-0"]
    assert all(pattern.match("x:com.acme/" + m) for m in matched)
    assert not any(pattern.match("x:com.acme/" + m) for m in others)
    assert skip_pattern([]) is None
    with pytest.raises(ValueError):
        skip_pattern(["x:com.acme/page/jsonschema/1-0"])


def test_order_of_the_routing_rules(spark):
    names = spark.createDataFrame([("unstruct_event_a_1",), ("contexts_a_1",), ("geo_city",), ("load_tstamp",), ("xcontexts_a",)], "name string")
    assert [r[0] for r in names.select(route_column(F.col("name"))).collect()] == [
        "object", "array", "missing_atomic", "missing_atomic", "unrecognized",
    ]


def test_extra_columns_win(spark):
    rows = spark.createDataFrame(
        [(["c"], "INTERNAL_ERROR"), ([], "NULL_VALUE"), ([], "INTERNAL_ERROR"), ([], None)], "extra array<string>, code string"
    )
    assert [r[0] for r in rows.select(failure_outcome(F.col("extra"), F.col("code"))).collect()] == ["evolve", "bad", "fatal", "ok"]


def test_setup_errors(spark):
    rows = spark.createDataFrame(
        [
            ("ingest", 404, "body", "raw"), ("ingest", 403, None, 'x {"message" : "hello"} y'), ("ingest", 400, None, 'x "message":"" y'),
            ("ingest", 404, None, "a\nERR_TABLE_TYPE_NOT_SUPPORTED"), ("ingest", 404, None, "a ERR_TABLE_TYPE_NOT_SUPPORTED b"),
            ("ingest", 404, None, "aERR_TABLE_TYPE_NOT_SUPPORTED"),
            ("ingest", 513, None, "raw"), ("ingest", 500, "body", "raw"), ("security", 0, None, "raw"),
            ("sql", 2003, None, "SQL Compilation Error:\nObject 'X': \n  gone"), ("sql", 1430, None, "raw"), ("other", 404, None, "raw"),
        ],
        "kind string, code int, body string, raw string",
    )
    message = setup_error_message(*[F.col(c) for c in rows.columns], destination="Target")
    found = [r[0] for r in rows.select(message).collect()]
    table_type = "Table must not be in a transient database or transient schema: Target streaming ingest SDK only supports permanent tables"
    assert found == [
        "body", "hello", "", "a\nERR_TABLE_TYPE_NOT_SUPPORTED", table_type, "aERR_TABLE_TYPE_NOT_SUPPORTED",
        "Unrecognized Target account name or host name", None,
        "Unauthorized: Invalid user name or invalid public/private key pair or mis-configured network policies",
        "Object 'X':   gone", None, None,
    ]
    classes = [r[0] for r in rows.select(error_class(message)).collect()]
    assert classes.count("transient") == 3


def test_clean_error_text(spark):
    frame = spark.createDataFrame([("a: \nb\nc",), ("x SQL compilation error: y",)], "m string")
    assert [r[0] for r in frame.select(clean_error_text(F.col("m"))).collect()] == ["a: b: c", "x SQL compilation error: y"]


def test_kafka_options():
    consumer = {"group.id": "loader", "enable.auto.commit": "false", "allow.auto.create.topics": "false", "auto.offset.reset": "earliest", "security.protocol": "SASL_SSL"}
    assert brokers.kafka_options("topic", "host:9092", consumer, max_records=500) == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "topic", "kafka.group.id": "loader",
        "kafka.security.protocol": "SASL_SSL", "startingOffsets": "earliest", "maxOffsetsPerTrigger": "500",
    }
    at = brokers.kafka_options("t", "h", position=brokers.AT_TIME, timestamp="2023-01-01T00:00:00+00:00")
    assert at["startingTimestamp"] == "1672531200000" and "startingOffsets" not in at
    assert brokers.kafka_options("t", "h", position=brokers.NEWEST)["startingOffsets"] == "latest"
    assert brokers.kafka_sink_options("bad", "h", {"client.id": "c"}) == {"kafka.bootstrap.servers": "h", "topic": "bad", "kafka.client.id": "c"}


def test_positions_of_other_connectors():
    names = {"position": "startingPosition", "timestamp": "startingTime", "max_records": "maxFetch"}
    assert brokers.position_options(names) == {"startingPosition": "LATEST"}
    assert brokers.position_options(names, brokers.AT_TIME, "2023-01-01T00:00:00Z", 1000) == {
        "startingPosition": "AT_TIMESTAMP", "startingTime": "2023-01-01T00:00:00Z", "maxFetch": "1000",
    }


def test_normalised_sources(spark):
    records = {
        "kafka": ("SELECT CAST('l' AS BINARY) AS value, 3 AS partition, 7L AS offset, TIMESTAMP '2023-01-01 00:00:00' AS timestamp", KAFKA_COLUMNS),
        "kinesis": ("SELECT CAST('l' AS BINARY) AS data, 's' AS shardId, TIMESTAMP '2023-01-01 00:00:00' AS approximateArrivalTimestamp", brokers.KINESIS_COLUMNS),
        "pubsub": ("SELECT CAST('l' AS BINARY) AS payload, 1672531200000L AS publishTimestampInMillis", brokers.PUBSUB_COLUMNS),
    }
    for sql, columns in records.values():
        row = normalise(spark.sql(sql), columns).first()
        assert bytes(row["value"]) == b"l" and str(row["src_ts"]) == "2023-01-01 00:00:00"
    assert normalise(spark.sql(records["kafka"][0]), KAFKA_COLUMNS).first()["src_id"] == 7


def test_text_files(spark, folder):
    with open(f"{folder}/a.txt", "wb") as file:
        file.write(b"one\rtwo\nthree\n")
    lines = read_lines(spark, "text", {}, path=folder)
    assert sorted(r["value"] for r in lines.collect()) == ["one\rtwo", "three"]
    assert lines.columns == ["src_partition", "src_id", "src_ts", "value"]


def test_sink_limits(spark, folder):
    assert MAX_FAILED_EVENT_BYTES == {"kafka": 1_000_000, "kinesis": 1_000_000, "pubsub": 10_000_000}
    assert request_options("kinesis") == {"maxRecordsPerFile": "500"}
    rows = spark.range(250).selectExpr("CAST(id AS STRING) AS json").coalesce(1)
    FailedEventSink(path=f"{folder}/bad", options=request_options("pubsub")).write(rows)
    from pathlib import Path

    assert len(list(Path(folder, "bad").glob("*.parquet"))) == 3
    assert spark.read.parquet(f"{folder}/bad").count() == 250


@pytest.mark.parametrize("format", ["parquet", "orc"])
def test_rows_of_one_row_group_are_dealt_out(spark, folder, format):
    """The file is cut into many partitions by bytes, of which one would read all rows."""
    wanted = parallelism(spark.sparkContext.defaultParallelism, "1")
    rows = spark.range(0, 50_000, 1, 1).selectExpr("id AS src_id", "0 AS src_partition", "sha2(CAST(id AS STRING), 256) AS value")
    rows.write.format(format).save(f"{folder}/in")
    columns = {"src_id": "src_id", "src_partition": "src_partition", "src_ts": "CAST(NULL AS TIMESTAMP_NTZ)", "value": "value"}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        assert spark.read.format(format).load(f"{folder}/in").rdd.getNumPartitions() >= wanted
        lines = read_lines(spark, format, {}, columns=columns, path=f"{folder}/in")
        parts = [r["count"] for r in lines.groupBy(F.spark_partition_id().alias("part")).count().collect()]
        assert sum(parts) == lines.select("src_id").distinct().count() == 50_000
        assert max(parts) <= 50_000 // wanted
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
