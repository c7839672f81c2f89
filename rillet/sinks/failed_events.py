"""Where failed events go."""

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from rillet.constants import SINK_LIMITS


@dataclass(frozen=True)
class FailedEventSink:
    """Any Spark sink.  Kafka gets the JSON as its value; files and tables get all columns."""

    format: str = "parquet"
    path: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    def write(self, bad_rows: DataFrame) -> None:
        rows = bad_rows.selectExpr("json AS value") if self.format == "kafka" else bad_rows
        writer = rows.write.format(self.format).options(**self.options)
        if self.format == "kafka":
            writer.save()
        else:
            writer.mode("append").save(self.path)


def request_options(service: str) -> dict[str, str]:
    """Records per file or request for a service with known limits."""
    return {"maxRecordsPerFile": str(SINK_LIMITS[service]["records"])}
