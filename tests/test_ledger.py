"""Exactly-once loading: faults between each pair of steps, replays, attempts at a time, partitions."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from rillet.operators.metrics import metrics_report
from rillet.plans import load_once as plan
from rillet.plans.load_batch import FatalWriteError, LoadOptions, fill_cache, load_batch, prepare_rows, survey
from rillet.plans.load_once import load_once
from rillet.sinks import ledger as ledgers
from rillet.sinks.failed_events import FailedEventSink
from rillet.sinks.ledger import Ledger, batch_metrics, create_tables
from rillet.sinks.table import append_rows, create_events_table, table_columns
from rillet.sources.lines import read_lines
from rillet.streaming.loader import load_stream
from tests.lines import BAD_LINES, NOW, contexts, frame, line, unstruct

XYZ = unstruct("x:xyz/event/jsonschema/1-0-0", '{"a":1}')
ABC = contexts(("x:abc/ctx/jsonschema/2-0-0", '{"b":null}'))
DAY = NOW[:10]


@pytest.fixture
def place(spark, folder):
    suffix = folder[-6:].lower().replace("-", "_")
    ledger = Ledger(table=f"l_{suffix}", failed_table=f"f_{suffix}", folder=f"{folder}/batches")
    options = LoadOptions(table=f"e_{suffix}", now=NOW)
    create_tables(spark, ledger, options.table)
    return options, ledger


def counts(spark, place):
    options, ledger = place
    return tuple(spark.table(name).count() for name in (options.table, ledger.failed_table, ledger.table))


def lines(spark):
    return frame(spark, [line(unstruct_event=XYZ), line(contexts=ABC), line(), *BAD_LINES])


def test_load_and_replay(spark, place):
    options, ledger = place
    first = load_once(lines(spark), options, ledger, 7)
    assert (first.n, first.good, first.bad) == (5, 3, 2)
    assert first.added_columns == ["contexts_abc_ctx_2", "unstruct_event_xyz_event_1"]
    again = load_once(lines(spark), options, ledger, 7)
    assert (again.n, again.good, again.bad, again.added_columns) == (5, 3, 2, [])
    assert counts(spark, place) == (3, 2, 1)
    rows = spark.table(options.table)
    assert rows.select("load_day", "load_batch").distinct().collect()[0][1] == "events-7"
    assert rows.filter("unstruct_event_xyz_event_1 IS NOT NULL").count() == 1
    # Later batches have columns of their own; files without them read as null.
    load_once(frame(spark, [line(contexts=contexts(("x:new/ctx/jsonschema/1-0-0", "{}")))]), options, ledger, 8)
    rows = spark.table(options.table)
    assert rows.count() == 4 and rows.filter("contexts_new_ctx_1 IS NOT NULL").count() == 1
    assert rows.columns[-2:] == ["load_day", "load_batch"]


def test_only_folders_of_tables_stay(spark, place, folder):
    options, ledger = place
    load_once(lines(spark), options, ledger, 1)
    (attempt,) = os.listdir(f"{folder}/batches/events/1")
    assert sorted(os.listdir(f"{folder}/batches/events/1/{attempt}")) == ["bad", "good", "record"]


STEPS = ["stage_rows", "survey", "failed_events", "commit", "remove", "evolve_table", "publish"]


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("step", STEPS)
def test_fault_at_each_step(spark, place, step, after, monkeypatch):
    """A fault before or after any step: the replay leaves every row once."""
    options, ledger = place
    real = getattr(plan, step)

    def broken(*arguments):
        if after:
            real(*arguments)
        raise RuntimeError("fault")

    monkeypatch.setattr(plan, step, broken)
    with pytest.raises(RuntimeError, match="fault"):
        load_once(lines(spark), options, ledger, 0)
    monkeypatch.undo()
    load_once(lines(spark), options, ledger, 0)
    assert counts(spark, place) == (3, 2, 1)


def test_fault_between_the_tables(spark, place, monkeypatch):
    """The events are published, the failed events not yet."""
    options, ledger = place
    sent = []
    real = type(spark).sql

    def once(session, text, *more, **named):
        if text.startswith("ALTER TABLE f_"):
            sent.append(text)
            if len(sent) == 1:
                raise RuntimeError("fault")
        return real(session, text, *more, **named)

    monkeypatch.setattr(type(spark), "sql", once)
    with pytest.raises(RuntimeError, match="fault"):
        load_once(lines(spark), options, ledger, 0)
    assert counts(spark, place) == (3, 0, 1)
    load_once(lines(spark), options, ledger, 0)
    assert counts(spark, place) == (3, 2, 1)


def test_two_attempts_at_a_time(spark, place, folder, monkeypatch):
    """Another driver commits the batch while this one writes: its rows count, these are dropped."""
    options, ledger = place
    real, inside = plan.commit, []

    def late(*arguments):
        if not inside:
            inside.append(1)
            load_once(lines(spark), options, ledger, 0)
        return real(*arguments)

    monkeypatch.setattr(plan, "commit", late)
    result = load_once(lines(spark), options, ledger, 0)
    assert (result.good, result.bad) == (3, 2) and counts(spark, place) == (3, 2, 1)
    assert len(os.listdir(f"{folder}/batches/events/0")) == 1


def test_fatal_row_and_empty_batch(spark, place, folder):
    options, ledger = place
    checks = [(F.col("app_id") == "x", "INTERNAL_ERROR", "internal")]
    fatal = LoadOptions(table=options.table, now=NOW, validators=checks)
    with pytest.raises(FatalWriteError):
        load_once(frame(spark, [line(app_id="x"), line()]), fatal, ledger, 0)
    assert counts(spark, place) == (0, 0, 0)
    assert load_once(frame(spark, []), options, ledger, 0).n == 0
    assert counts(spark, place) == (0, 0, 0)
    # Only bad rows: the events table gets no partition.
    assert load_once(frame(spark, BAD_LINES), options, ledger, 0).bad == 2
    assert counts(spark, place) == (0, 2, 1)
    assert spark.sql(f"SHOW PARTITIONS {options.table}").count() == 0


def test_metrics_from_the_ledger(spark, place):
    options, ledger = place
    for batch_id in (0, 1, 0, 1):
        load_once(lines(spark), options, ledger, batch_id)
    (row,) = metrics_report(batch_metrics(spark, ledger)).collect()
    assert (row[1], row[2]) == (6, 4)


def test_stream_with_a_fault(spark, place, folder, monkeypatch):
    options, ledger = place
    os.mkdir(f"{folder}/in")
    for name in "ab":
        with open(f"{folder}/in/{name}.txt", "w", newline="") as file:
            file.write("\n".join([line(), *BAD_LINES]) + "\n")

    def run():
        source = read_lines(spark, "text", {"maxFilesPerTrigger": "1"}, path=f"{folder}/in", streaming=True)
        query = load_stream(spark, source, options, f"{folder}/checkpoint", available_now=True, ledger=ledger)
        query.awaitTermination()

    real, calls = plan.publish, []

    def broken(*arguments):
        calls.append(1)
        real(*arguments)
        if len(calls) == 2:
            raise RuntimeError("fault after the last step")

    monkeypatch.setattr(plan, "publish", broken)
    with pytest.raises(Exception):  # noqa: B017 - the error of the stream wraps the cause
        run()
    monkeypatch.undo()
    run()
    assert counts(spark, place) == (2, 4, 2)


def test_reads_and_writes_touch_their_partitions_only(spark, place, monkeypatch):
    options, ledger = place
    load_once(lines(spark), options, ledger, 0)
    other_day = LoadOptions(table=options.table, now="2031-01-01 00:00:00")
    load_once(lines(spark), other_day, ledger, 1)
    day = spark.table(options.table).filter("load_day = DATE'2031-01-01'")
    files = day.inputFiles()
    assert files and all("/1/" in file for file in files) and day.count() == 3
    # The names come from the catalog although a folder of the table is gone.
    ledgers.remove(spark, f"{ledger.folder}/events/0")
    assert "load_tstamp" in table_columns(spark, options.table)
    load_once(frame(spark, [line()]), other_day, ledger, 2)


def test_plain_append_to_a_partitioned_table(spark, folder):
    name = "p_" + folder[-6:].lower().replace("-", "_")
    create_events_table(spark, name, partitioned=True)
    options = LoadOptions(table=name, failed_events=FailedEventSink(path=f"{folder}/failed"), now=NOW)
    load_batch(frame(spark, [line(unstruct_event=XYZ)]), options)
    (row,) = spark.table(name).collect()
    assert (str(row["load_day"]), row["load_batch"]) == (DAY, "appended")
    assert append_rows.__doc__


def test_one_parse_of_a_stored_table(spark, folder):
    """Without persisting, the lines are read once and the staged rows of an outcome by themselves."""
    source = f"{folder}/lines"
    frame(spark, [line(), *BAD_LINES] * 20).write.parquet(source)
    count = spark.sparkContext.accumulator(0)
    stored = spark.read.parquet(source)

    def seen(batches):
        for batch in batches:
            count.add(batch.num_rows)
            yield batch

    counted = stored.mapInArrow(seen, stored.schema)
    name = "s_" + folder[-6:].lower().replace("-", "_")
    create_events_table(spark, name, f"{folder}/table")
    options = LoadOptions(table=name, failed_events=FailedEventSink(path=f"{folder}/failed"), now=NOW, persist=False)
    result = load_batch(counted, options)
    assert (result.good, result.bad, count.value) == (20, 40, 60)


def jobs(spark, action):
    """Jobs that an action starts."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted jobs")
    try:
        action()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_counts_come_from_the_write(spark, place, folder):
    """The pass that computes the rows counts them: one job, without a shuffle or a second one for the counts."""
    options, ledger = place
    rows = prepare_rows(lines(spark), options, NOW)
    assert jobs(spark, lambda: survey(fill_cache(rows, options, NOW))) == 1
    assert jobs(spark, lambda: survey(plan.stage_rows(rows, f"{folder}/staged", options, NOW)[1])) == 1
    assert jobs(spark, lambda: table_columns(spark, options.table)) == 0


def test_names_of_all_transformed_rows(spark, place):
    """Each entity column once, however many rows and partitions carry it, also of rows that fail the checks."""
    options, _ = place
    events = [line(contexts=contexts((f"x:v{i % 300}/ctx/jsonschema/{i % 2 + 1}-0-0", "{}")), app_id="x" if i < 300 else "y") for i in range(900)]
    checks = LoadOptions(table=options.table, validators=[(F.col("app_id") == "x", "NULL_VALUE", "bad")])
    rows = prepare_rows(frame(spark, [*events, line(unstruct_event=XYZ), *BAD_LINES]).repartition(7), checks, NOW)
    report, names = survey(fill_cache(rows, checks, NOW))
    expected = {f"contexts_v{i % 300}_ctx_{i % 2 + 1}" for i in range(900)} | {"unstruct_event_xyz_event_1"}
    assert names == sorted(expected)
    assert (report["n"], report["good"], report["bad"], report["transformed"]) == (903, 601, 302, 901)
