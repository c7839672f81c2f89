"""Loading: the cases of a loader with good, bad, mixed, new and failing input."""

import json
import os

import pytest
from pyspark.sql import functions as F

from rillet.plans import load_batch as plan
from rillet.plans.load_batch import FatalWriteError, LoadOptions, load_batch
from rillet.sinks import table as tables
from rillet.sinks.failed_events import FailedEventSink
from rillet.sources.lines import read_lines
from rillet.streaming.loader import load_stream
from tests.lines import BAD_LINES, COLLECTED, NOW, contexts, frame, line, unstruct

XYZ = unstruct("x:xyz/event/jsonschema/1-0-0", '{"a":1}')
ABC = contexts(("x:abc/ctx/jsonschema/2-0-0", '{"b":null}'))


@pytest.fixture
def options(spark, folder):
    name = "t_" + folder[-6:].lower().replace("-", "_")
    tables.create_events_table(spark, name, f"{folder}/table")
    return LoadOptions(table=name, failed_events=FailedEventSink(path=f"{folder}/failed"), now=NOW)


def with_(options, **changes):
    return LoadOptions(**{**{f: getattr(options, f) for f in options.__dataclass_fields__}, **changes})


def failed(spark, options):
    return spark.read.parquet(options.failed_events.path)


def written(options):
    import os

    return os.path.exists(options.failed_events.path)


def test_good_lines(spark, options):
    result = load_batch(frame(spark, [line() for _ in range(4)]), options)
    assert (result.good, result.bad, result.e2e_latency_ms) == (4, 0, 42123)
    assert spark.table(options.table).count() == 4
    assert not written(options)


def test_bad_lines(spark, options):
    result = load_batch(frame(spark, BAD_LINES * 3), options)
    assert (result.good, result.bad, result.e2e_latency_ms) == (0, 6, None)
    assert spark.table(options.table).count() == 0
    assert failed(spark, options).groupBy("kind", "payload").count().orderBy("payload").collect() == [
        ("loader_parsing_error", "nonsense1", 3), ("loader_parsing_error", "nonsense2", 3),
    ]


def test_lines_without_a_value(spark, options):
    result = load_batch(frame(spark, [None, line()]), options)
    assert (result.n, result.good, result.bad) == (2, 1, 1)
    assert failed(spark, options).select("kind", "payload").collect() == [("loader_parsing_error", None)]
    assert load_batch(frame(spark, []), options).n == 0


def test_mixed_lines(spark, options):
    result = load_batch(frame(spark, (BAD_LINES + [line(), line()]) * 3), options)
    assert (result.good, result.bad, result.e2e_latency_ms) == (6, 6, 42123)
    assert spark.table(options.table).count() == 6
    assert failed(spark, options).count() == 6


def test_table_gains_columns(spark, options):
    load_batch(frame(spark, [line()]), options)
    result = load_batch(frame(spark, [line(unstruct_event=XYZ, contexts=ABC), line()]), options)
    assert result.added_columns == ["contexts_abc_ctx_2", "unstruct_event_xyz_event_1"]
    assert (result.good, result.bad) == (2, 0)
    rows = spark.table(options.table)
    assert rows.dtypes[-2:] == [("contexts_abc_ctx_2", "array<variant>"), ("unstruct_event_xyz_event_1", "variant")]
    values = rows.select(F.to_json("contexts_abc_ctx_2").alias("c"), F.to_json("unstruct_event_xyz_event_1").alias("u")).collect()
    assert sorted((v["c"] or "", v["u"] or "") for v in values) == [("", ""), ("", ""), ('[{"_schema_version":"2-0-0"}]', '{"a":1}')]
    # A later batch adds nothing.
    assert load_batch(frame(spark, [line(unstruct_event=XYZ)]), options).added_columns == []


def test_rows_with_wrong_data(spark, options):
    checks = [(F.col("app_id") == "wrong", "INVALID_FORMAT_ROW", "bad format")]
    lines = frame(spark, [line(), line(app_id="wrong", unstruct_event=XYZ)])
    result = load_batch(lines, with_(options, validators=checks))
    assert (result.good, result.bad, result.e2e_latency_ms) == (1, 1, 42123)
    # Columns of failing rows are added as well.
    assert result.added_columns == ["unstruct_event_xyz_event_1"]
    row = failed(spark, options).first()
    assert (row["kind"], row["failure"]) == ("loader_runtime_error", "bad format")
    assert row["payload"].startswith("wrong\t")


def test_event_as_payload(spark, options):
    checks = [(F.col("app_id") == "wrong", "INVALID_FORMAT_ROW", "bad format")]
    lines = frame(spark, [line(app_id="wrong", unstruct_event=XYZ, contexts=ABC), line(app_id="wrong"), *BAD_LINES])
    load_batch(lines, with_(options, validators=checks, event_payload=True))
    rows = {r["payload"]: r["json"] for r in failed(spark, options).collect()}
    events = [json.loads(payload) for payload in rows if payload.startswith("{")]
    assert len(rows) == 4 and len(events) == 2 and all(event["app_id"] == "wrong" for event in events)
    (full,) = (event for event in events if "unstruct_event" in event)
    assert full["unstruct_event"] == {"unstruct_event_xyz_event_1": {"a": 1}}
    assert full["contexts"] == {"contexts_abc_ctx_2": [{"_schema_version": "2-0-0"}]}
    assert "nonsense1" in rows


def test_fatal_failure_writes_nothing(spark, options):
    checks = [(F.col("app_id") == "x", "INTERNAL_ERROR", "internal")]
    lines = frame(spark, [line(), line(app_id="x", unstruct_event=XYZ), *BAD_LINES])
    with pytest.raises(FatalWriteError):
        load_batch(lines, with_(options, validators=checks))
    spark.catalog.refreshTable(options.table)
    assert spark.table(options.table).count() == 0
    assert len(spark.table(options.table).columns) == 129
    assert not written(options)


def test_other_writer_altered_the_table(spark, options):
    load_batch(frame(spark, [line()]), options)
    other = spark.newSession()
    other.sql(f"ALTER TABLE {options.table} ADD COLUMNS (contexts_abc_ctx_2 array<variant>)")
    result = load_batch(frame(spark, [line(contexts=ABC)]), options)
    assert result.good == 1 and result.added_columns == []
    assert spark.table(options.table).filter("contexts_abc_ctx_2 IS NOT NULL").count() == 1


def test_changed_table_is_planned_again(spark, options, monkeypatch):
    """The first plan still has a column that the table lost: look the table up again."""
    stale, calls = tables.table_columns, []

    def first_stale(session, name):
        calls.append(name)
        columns = stale(session, name)
        return columns + ["contexts_gone_1"] if len(calls) == 1 else columns

    from rillet.operators.parse import parse_lines
    from rillet.operators.transform import transform_events

    rows = transform_events(parse_lines(frame(spark, [line()])), NOW)
    monkeypatch.setattr(tables, "table_columns", first_stale)
    tables.append_rows(rows, options.table)
    assert len(calls) == 2 and spark.table(options.table).count() == 1


def test_missing_atomic_column(spark, folder):
    name = "u_" + folder[-6:].lower().replace("-", "_")
    spark.sql(f"CREATE TABLE {name} (app_id STRING) USING parquet LOCATION '{folder}/table'")
    assert not tables.create_events_table(spark, name)
    options = LoadOptions(table=name, failed_events=FailedEventSink(path=f"{folder}/failed"), now=NOW)
    with pytest.raises(tables.MissingAtomicColumn, match="Missing required column platform"):
        load_batch(frame(spark, [line()]), options)
    with pytest.raises(tables.UnrecognizedColumn):
        tables.add_columns(spark, name, ["other"])


def test_create_and_add_are_idempotent(spark, options):
    assert tables.table_exists(spark, options.table)
    assert not tables.create_events_table(spark, options.table)
    assert tables.add_columns(spark, options.table, ["contexts_a_1"]) == ["contexts_a_1"]
    assert tables.add_columns(spark, options.table, ["contexts_a_1", "contexts_b_1"]) == ["contexts_b_1"]


def test_large_failed_events_are_cut(spark, options):
    load_batch(frame(spark, ["é" * 4000]), with_(options, max_failed_event_bytes=2000))
    row = failed(spark, options).first()
    assert row["kind"] == "size_violation" and '"maximumAllowedSizeBytes":2000' in row["failure"]
    assert row["payload"] == "é" * 100 and len(row["json"].encode()) < 2000


def test_without_persisting(spark, options):
    result = load_batch(frame(spark, [line(unstruct_event=XYZ), *BAD_LINES]), with_(options, persist=False))
    assert (result.good, result.bad) == (1, 2)
    assert spark.table(options.table).count() == 1 and failed(spark, options).count() == 2


@pytest.fixture
def appended(monkeypatch, folder):
    """For each append: whether its rows come from Spark's cache, and whether staged rows are there."""
    seen, append = [], plan.append_rows

    def watched(rows, *args):
        seen.append(("InMemoryRelation" in rows._jdf.queryExecution().withCachedData().toString(), os.path.exists(f"{folder}/staged")))
        append(rows, *args)

    monkeypatch.setattr(plan, "append_rows", watched)
    monkeypatch.setattr(plan, "shared_folder", lambda _: f"{folder}/staged")
    return seen


def test_stored_table_is_not_cached(spark, options, folder, appended):
    """A batch of any size is staged: a task that caches a partition holds most of its rows on the heap.  The staged rows go."""
    result = load_batch(frame(spark, [line(unstruct_event=XYZ), line(), *BAD_LINES]).repartition(3), options)
    assert (result.good, result.bad) == (2, 2)
    assert spark.table(options.table).count() == 2 and failed(spark, options).count() == 2
    assert appended == [(False, True)] and not os.path.exists(f"{folder}/staged")
    # A small batch has one writer, also if many tasks parsed it.
    assert len([name for name in os.listdir(f"{folder}/table") if name.endswith(".parquet")]) == 1


def test_staged_rows_go_after_a_fault(spark, options, folder, appended):
    checks = [(F.lit(True), "INTERNAL_ERROR", "internal")]
    with pytest.raises(FatalWriteError):
        load_batch(frame(spark, [line()]), with_(options, validators=checks))
    assert not appended and not os.path.exists(f"{folder}/staged")
    load_batch(frame(spark, []), options)
    assert not os.path.exists(f"{folder}/staged")


@pytest.mark.parametrize("persist", [None, True, False])
def test_cache_of_a_stream(spark, stream_folder, options, appended, persist):
    """Bounded micro-batches stay in the cache unless the options say otherwise."""
    put(stream_folder, "a", [line(), *BAD_LINES])
    start(spark, stream_folder, with_(options, persist=persist)).awaitTermination()
    assert spark.table(options.table).count() == 1 and failed(spark, options).count() == 2
    assert appended == [(persist is not False, persist is False)]


# -- streams of text files ------------------------------------------------------------


def put(folder, name, lines):
    with open(f"{folder}/in/{name}.txt", "w", newline="") as file:
        file.write("\n".join(lines) + "\n")


def start(spark, folder, options, **more):
    lines = read_lines(spark, "text", {"maxFilesPerTrigger": "1"}, path=f"{folder}/in", streaming=True)
    return load_stream(spark, lines, options, f"{folder}/checkpoint", available_now=True, **more)


@pytest.fixture
def stream_folder(folder):
    import os

    os.mkdir(f"{folder}/in")
    return folder


def test_stream(spark, stream_folder, options):
    put(stream_folder, "a", [line(app_id="a\r"), *BAD_LINES])
    put(stream_folder, "b", [line(contexts=ABC), line()])
    seen = []
    options = with_(options, metrics_table=options.table + "_metrics", source_time="src_ts", now=None)
    start(spark, stream_folder, options, on_batch=lambda i, r: seen.append((i, r.good, r.bad))).awaitTermination()
    assert sorted(i for i, _, _ in seen) == [0, 1]
    assert sorted((good, bad) for _, good, bad in seen) == [(1, 2), (2, 0)]
    spark.catalog.refreshTable(options.table)
    rows = spark.table(options.table)
    assert rows.count() == 3 and rows.filter("contexts_abc_ctx_2 IS NOT NULL").count() == 1
    assert rows.filter("app_id = 'a\r'").count() == 1
    metrics = spark.table(options.metrics_table)
    assert metrics.selectExpr("sum(good)", "sum(bad)").first() == (3, 2)
    assert metrics.filter("latency_ms >= 0 AND e2e_latency_ms > 0").count() == 2
    # Nothing new: the next run loads nothing.
    start(spark, stream_folder, options, on_batch=lambda i, r: seen.append(i)).awaitTermination()
    assert len(seen) == 2


@pytest.mark.parametrize("fault", ["fatal", "failed_event_sink", "writer"])
def test_replay_after_a_fault(spark, stream_folder, options, fault, monkeypatch):
    put(stream_folder, "a", [line(app_id="x"), *BAD_LINES])
    broken = options
    if fault == "fatal":
        broken = with_(options, validators=[(F.col("app_id") == "x", "INTERNAL_ERROR", "internal")])
    elif fault == "failed_event_sink":
        open(f"{stream_folder}/file", "w").close()
        broken = with_(options, failed_events=FailedEventSink(path=f"{stream_folder}/file/failed"))
    else:
        def fail(*_):
            raise RuntimeError("writer is gone")

        monkeypatch.setattr("rillet.plans.load_batch.append_rows", fail)
    with pytest.raises(Exception):  # noqa: B017 - the error of the stream wraps the cause
        start(spark, stream_folder, broken).awaitTermination()
    assert not written(options)
    monkeypatch.undo()

    seen = []
    start(spark, stream_folder, options, on_batch=lambda i, r: seen.append((i, r.good, r.bad))).awaitTermination()
    assert seen == [(0, 1, 2)]
    spark.catalog.refreshTable(options.table)
    # Delivery is at least once: a fault after the append leaves its rows to be written again.
    assert spark.table(options.table).count() == (2 if fault == "failed_event_sink" else 1)
    assert failed(spark, options).count() == 2
