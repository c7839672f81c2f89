"""Lines without offsets, and tables that lack the columns of the rows."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from checks import fixtures as fx
from rillet.operators.batches import running_start
from rillet.operators.parse import parse_lines
from rillet.operators.transform import transform_events
from rillet.plans.load_report import load_report
from rillet.sinks.table import append_rows, create_events_table
from rillet.sources.brokers import PUBSUB_COLUMNS
from rillet.sources.lines import normalise, read_lines

SF = "/root/testdata/sf0.001"


def totals(report):
    return report.agg(*[F.sum(name) for name in ("n", "good", "bad", "bytes")], F.min("earliest")).first()


def test_report_of_lines_without_offsets(spark, folder):
    lines = fx.enriched_lines(spark, SF)
    expected = totals(load_report(lines, fx.NOW))
    assert expected[0] == lines.count()
    lines.select("value").repartition(3).write.text(f"{folder}/lines")
    assert totals(load_report(read_lines(spark, "text", {}, path=f"{folder}/lines"), fx.NOW)) == expected
    messages = lines.selectExpr("value AS payload", "src_id AS publishTimestampInMillis")
    assert totals(load_report(normalise(messages, PUBSUB_COLUMNS), fx.NOW)) == expected


def test_rows_that_nothing_orders_are_an_error(spark):
    rows = spark.createDataFrame([(0, None, 5), (0, 1, 5)], "p long, o long, bytes long")
    with pytest.raises(PySparkException, match="nothing orders"):
        running_start(rows, "p", "o", ["bytes"], 10).collect()


def test_append_adds_the_columns_that_the_table_lacks(spark):
    rows = transform_events(parse_lines(fx.enriched_lines(spark, SF)), fx.NOW).filter("transform_ok")
    create_events_table(spark, "lacking")
    append_rows(rows, "lacking")
    wanted = rows.filter("array_contains(context_names, 'contexts_com_acme_web_page_1')").count()
    assert spark.table("lacking").filter("contexts_com_acme_web_page_1 IS NOT NULL").count() == wanted > 0
