"""The metrics roll-up as a stream, and the health of services written by the load."""

from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from rillet.operators.health import BLAME, STATUS, alerts, health_report, service_states
from rillet.plans.load_batch import LoadOptions
from rillet.sinks.failed_events import FailedEventSink
from rillet.sinks.ledger import Ledger
from rillet.sources.lines import read_lines
from rillet.streaming.loader import load_stream
from rillet.streaming.metrics import BATCH_METRICS, roll_up, stored_batches
from tests.lines import BAD_LINES, NOW, line

STATUSES = "t timestamp_ntz, batch_id bigint, service string, failed boolean, latency_ms bigint, cause string"


def _time(minute, second=0):
    return datetime(2024, 5, 1, 10, minute, second)


def test_late_batches_correct_their_minute(spark, folder):
    table = "rollup_" + folder[-6:].lower().replace("-", "_")

    def load(rows):
        spark.createDataFrame(rows, BATCH_METRICS).coalesce(1).write.mode("append").parquet(f"{folder}/batches")
        roll_up(stored_batches(spark, f"{folder}/batches"), table, f"{folder}/check", available_now=True).awaitTermination()
        spark.catalog.refreshTable(table)
        rows = spark.table(table).orderBy("period").collect()
        return [(r["period"].strftime("%H:%M"), r["events_good"], r["events_bad"], r["latency_millis"], r["e2e_latency_millis"]) for r in rows]

    first = load([(_time(0, 5), 0, 10, 1, 100, 50, None), (_time(0, 50), 1, 20, 0, 100, 90, 700), (_time(1), 2, 5, 5, 100, 10, 20)])
    assert first == [("10:00", 30, 1, 90, 700), ("10:01", 5, 5, 10, 20)]
    # A late batch of the first minute, and a new minute.
    second = load([(_time(0, 59), 3, 1, 2, 100, 95, 5), (_time(2), 4, 7, 0, 100, 1, 1)])
    assert second == [("10:00", 31, 3, 95, 700), ("10:01", 5, 5, 10, 20), ("10:02", 7, 0, 1, 1)]
    # One file for the day, however often it was written.
    assert len(spark.table(table).inputFiles()) == 1


def test_states_of_services(spark):
    rows = [
        (_time(0), 0, "table", False, None, None), (_time(1), 1, "table", True, None, "gone"), (_time(2), 1, "table", True, None, None),
        (_time(3), 1, "table", False, None, None), (_time(0), 0, "source", False, 300_001, None), (_time(1), 1, "source", False, 300_000, None),
        (_time(5), 2, "failed_events", True, None, "full"),
    ]
    statuses = spark.createDataFrame(rows, STATUSES)
    states = {(r["service"], r["t"].minute): (r["state"], r["changed"], r["message"]) for r in service_states(statuses).collect()}
    assert states["table", 0] == ("healthy", False, None)
    assert states["table", 1][:2] == ("unhealthy", True) and states["table", 1][2].endswith(": gone")
    assert states["table", 2][:2] == ("unhealthy", False) and states["table", 3] == ("healthy", True, None)
    assert states["source", 0] == ("unhealthy", True, "source: latency of 300001 ms") and states["source", 1][:2] == ("healthy", True)
    report = {r["service"]: tuple(r)[1:5] for r in health_report(statuses).collect()}
    assert report == {
        "table": ("healthy", _time(3), 1, 2), "source": ("healthy", _time(1), 1, 0), "failed_events": ("unhealthy", _time(5), 1, 1),
    }
    assert health_report(spark.createDataFrame([], STATUSES)).collect() == []


@pytest.mark.parametrize("exact", [False, True])
def test_a_failed_batch_leaves_a_status(spark, folder, exact):
    """The first attempt fails at a fatal row or at the sink; the replay succeeds."""
    import os

    os.mkdir(f"{folder}/in")
    with open(f"{folder}/in/a.txt", "w", newline="") as file:
        file.write("\n".join([line(app_id="x"), *BAD_LINES]) + "\n")
    suffix = folder[-6:].lower().replace("-", "_")
    health = f"h_{suffix}"
    ledger = Ledger(f"l_{suffix}", f"f_{suffix}", f"{folder}/batches") if exact else None

    def run(**changes):
        options = LoadOptions(**{"table": f"e_{suffix}", "failed_events": FailedEventSink(path=f"{folder}/failed"), "now": NOW} | changes)
        source = read_lines(spark, "text", {}, path=f"{folder}/in", streaming=True)
        query = load_stream(
            spark, source, options, f"{folder}/check", f"{folder}/table", available_now=True, ledger=ledger, health_table=health
        )
        query.awaitTermination()

    fatal = [(F.col("app_id") == "x", "INTERNAL_ERROR", "internal")]
    with pytest.raises(Exception):  # noqa: B017 - the error of the stream wraps the cause
        run(validators=fatal, now="2023-01-01 00:00:00")
    (row,) = health_report(spark.table(health)).collect()
    assert (row["service"], row["state"], row["failures"]) == ("table", "unhealthy", 1)
    if not exact:
        open(f"{folder}/file", "w").close()
        with pytest.raises(Exception):  # noqa: B017
            run(failed_events=FailedEventSink(path=f"{folder}/file/failed"), now="2023-01-02 00:00:00")
        assert {r["service"] for r in health_report(spark.table(health)).filter("state = 'unhealthy'").collect()} == {"table", "failed_events"}
    run()
    report = {r["service"]: (r["state"], r["failures"]) for r in health_report(spark.table(health)).collect()}
    assert report == {"table": ("healthy", 1), "source": ("healthy", 0), "failed_events": ("healthy", 0 if exact else 1)}


def test_alerts(spark):
    def failure(minute, kind, columns, cause, setup=True, service="table"):
        return (_time(minute), minute, service, True, None, cause, kind, columns, setup)

    def success(minute, service="table"):
        return (_time(minute), minute, service, False, None, None, None, None, None)

    rows = [
        failure(0, "failed_to_add_columns", ["a", "b"], "SQL compilation error: denied"),
        failure(1, "failed_to_add_columns", ["a", "b"], "denied"),  # the same text: no further alert
        failure(2, "failed_to_add_columns", ["a"], "denied"),
        failure(3, "failed_to_open_channel", [], "timeout", setup=False),  # may pass by itself
        failure(4, "failed_to_add_columns", ["a"], "denied"),
        success(5),
        failure(6, "failed_to_add_columns", ["a"], "denied"),
        failure(7, None, None, "disk"),  # no known type
        failure(8, "failed_to_show_tables", None, None),
        success(0, "source"),
        failure(9, "table_is_missing_atomic_column", ["app_id"], "x", service="other"),
    ]
    found = alerts(spark.createDataFrame(rows, f"{STATUS}, {BLAME}"), "main", "atomic").collect()
    assert {r["batch_id"]: r["alert"] for r in found} == {
        0: "Failed to add columns: [a,b]. Cause: denied", 2: "Failed to add columns: [a]. Cause: denied",
        4: "Failed to add columns: [a]. Cause: denied", 6: "Failed to add columns: [a]. Cause: denied",
        8: "Failed to SHOW tables in warehouse schema main.atomic: failed",
        9: "Existing table is incompatible with the event pipeline: Missing required column app_id",
    }
    assert alerts(spark.createDataFrame([], f"{STATUS}, {BLAME}")).collect() == []


def test_the_load_blames_its_table(spark, folder):
    """A table that was not made for events: the status of the attempt makes an alert, once however often it is tried."""
    import os

    os.mkdir(f"{folder}/in")
    with open(f"{folder}/in/a.txt", "w", newline="") as file:
        file.write(line() + "\n")
    suffix = folder[-6:].lower().replace("-", "_")
    spark.sql(f"CREATE TABLE w_{suffix} (app_id STRING) USING parquet")
    # A health table of an earlier version gains the columns that alerts need.
    spark.sql(f"CREATE TABLE h_{suffix} ({STATUS}, day DATE) USING parquet PARTITIONED BY (day)")
    for minute in range(2):
        options = LoadOptions(f"w_{suffix}", FailedEventSink(path=f"{folder}/failed"), now=f"2024-01-01 00:0{minute}:00")
        source = read_lines(spark, "text", {}, path=f"{folder}/in", streaming=True)
        with pytest.raises(Exception):  # noqa: B017 - the error of the stream wraps the cause
            load_stream(spark, source, options, f"{folder}/check", available_now=True, health_table=f"h_{suffix}").awaitTermination()
    # So does a table that cannot be created.
    options = LoadOptions(f"nowhere.w_{suffix}", FailedEventSink(path=f"{folder}/failed"), now="2024-01-01 00:02:00")
    with pytest.raises(AnalysisException):
        load_stream(spark, source, options, f"{folder}/check2", available_now=True, health_table=f"h_{suffix}")
    statuses = spark.table(f"h_{suffix}")
    assert statuses.count() == 3
    first, second = alerts(statuses).orderBy("t").collect()
    assert first["alert"].startswith("Existing table is incompatible with the event pipeline: Missing required column ")
    assert second["alert"].startswith("Failed to create table") or second["alert"].startswith("Failed to SHOW tables")
    assert second["batch_id"] is None
