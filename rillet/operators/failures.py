"""Write failures and the rows of their batch."""

from pyspark.sql import DataFrame

#: A row is known by its batch and its position in it.
ROW_KEY = ["batch_id", "row_index"]


def failures_with_events(events: DataFrame, failures: DataFrame) -> DataFrame:
    """Each failure with its row.  The key is unique, so no key can be hot."""
    return events.join(failures, ROW_KEY, "inner")


def written_rows(events: DataFrame, failures: DataFrame) -> DataFrame:
    """The rows of a batch without a failure."""
    return events.join(failures.select(*ROW_KEY), ROW_KEY, "left_anti")
