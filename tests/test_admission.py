"""How much of a backlog a micro-batch takes, and when a refused write is planned again."""

import os
import time

import pytest
from pyspark.errors import AnalysisException

from rillet.operators.parse import parse_lines
from rillet.operators.route import route_columns
from rillet.operators.transform import transform_events
from rillet.sinks import table as tables
from rillet.sinks.failed_events import FailedEventSink
from rillet.plans.load_batch import LoadOptions
from rillet.sources.brokers import AT_TIME, Admission, admission_options, kafka_options
from rillet.sources.lines import read_lines
from rillet.streaming.loader import load_stream
from tests.lines import frame, line

NOW = "2024-12-31 00:00:00.000"


def test_options_by_source():
    assert admission_options("text", {}, 6) == {"maxBytesPerTrigger": "96000000"}
    assert admission_options("kafka", {}, 6) == {"maxOffsetsPerTrigger": "96000"}
    assert admission_options("kafka", {}, 2, Admission(1000, 2000, "1 second")) == {
        "maxOffsetsPerTrigger": "2", "minOffsetsPerTrigger": "1", "maxTriggerDelay": "1 second"}
    assert admission_options("kinesis", {}, 6) == {}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_start_time_is_utc_in_any_zone(zone, monkeypatch):
    """A text without a zone means UTC, whatever the zone of the driver; milliseconds are exact."""
    monkeypatch.setenv("TZ", zone)
    time.tzset()
    try:
        starts = {"2024-03-10T07:00:00.123": "1710054000123", "2024-03-10T07:00:00.123Z": "1710054000123", "2024-03-10T07:00:00+02:00": "1710046800000",
                  "1969-12-31 23:59:59.999": "-1"}
        for text, millis in starts.items():
            assert kafka_options("t", "s", position=AT_TIME, timestamp=text)["startingTimestamp"] == millis
    finally:
        monkeypatch.undo()
        time.tzset()


@pytest.mark.parametrize("given", ["maxFilesPerTrigger", "MAXBYTESPERTRIGGER", "minOffsetsPerTrigger"])
def test_own_limits_count(given):
    assert admission_options("text", {given: "1"}, 6) == admission_options("kafka", {given: "1"}, 6) == {}


@pytest.mark.parametrize("batch_bytes, batches", [(10**9, 1), (1, 7)])
def test_backlog_of_files(spark, folder, batch_bytes, batches):
    """Seven files wait: they are one micro-batch or one each, and all their lines are loaded once."""
    os.makedirs(f"{folder}/lines")
    for n in range(7):
        with open(f"{folder}/lines/{n}", "w") as file:
            file.write("".join(line() + "\n" for _ in range(n + 1)))
    name = "adm_" + folder[-6:].lower().replace("-", "_")
    options = LoadOptions(table=name, failed_events=FailedEventSink(path=f"{folder}/failed"), now=NOW)
    lines = read_lines(spark, "text", {}, path=f"{folder}/lines", streaming=True, admission=Admission(batch_bytes))
    loaded = []
    query = load_stream(spark, lines, options, f"{folder}/checkpoint", f"{folder}/table", available_now=True, on_batch=lambda n, result: loaded.append(result.good))
    query.awaitTermination()
    assert len(loaded) == batches and sum(loaded) == 28
    spark.catalog.refreshTable(name)
    assert spark.table(name).count() == 28


def test_refused_write_of_an_unchanged_table(spark, folder, monkeypatch):
    """The columns did not change, so the refusal is an error and the write is not tried again."""
    name = "ref_" + folder[-6:].lower().replace("-", "_")
    tables.create_events_table(spark, name, f"{folder}/table")
    planned = []

    def row(columns):
        planned.append(columns)
        return ["no_such_column"]

    monkeypatch.setattr(tables, "table_row", row)
    rows = transform_events(parse_lines(frame(spark, [line()])), NOW)
    with pytest.raises(AnalysisException):
        tables.append_rows(rows, name, [])
    assert len(planned) == 1


def test_table_that_keeps_changing(spark, folder, monkeypatch):
    name = "cha_" + folder[-6:].lower().replace("-", "_")
    tables.create_events_table(spark, name, f"{folder}/table")
    planned = []

    def row(columns):
        planned.append(columns)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS (contexts_a_{len(planned)} array<variant>)")
        return ["no_such_column"]

    monkeypatch.setattr(tables, "table_row", row)
    rows = transform_events(parse_lines(frame(spark, [line()])), NOW)
    with pytest.raises(AnalysisException):
        tables.append_rows(rows, name, [], attempts=3)
    assert len(planned) == 3


def test_one_rule_for_columns(spark):
    names = ["unstruct_event_a_1", "contexts_a_1", "geo_city", "load_tstamp", "other", "my_contexts_a_1"]
    routed = {r.name: r.column_type for r in route_columns(spark.createDataFrame([(n,) for n in names], "name string")).collect()}
    for name in names:
        try:
            assert tables.addable_type(name) == routed[name]
        except RuntimeError:
            assert routed[name] is None
