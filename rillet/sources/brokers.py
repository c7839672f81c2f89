"""Options of message brokers as options of Spark's stream readers.

The readers themselves are Spark connectors that the cluster provides.  Spark keeps the read
offsets in the checkpoint, so commit settings of the consumers have no counterpart.
"""

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from rillet.constants import DEFAULT_MAX_BATCH_BYTES

# -- fixed values: start positions ------------------------------------------------
OLDEST, NEWEST, AT_TIME = "TRIM_HORIZON", "LATEST", "AT_TIMESTAMP"

# Consumer settings that Spark sets itself or that name an option of its own.
_KAFKA_NOT_PASSED = {"auto.offset.reset", "enable.auto.commit", "allow.auto.create.topics", "bootstrap.servers"}


def _epoch_millis(timestamp: str) -> str:
    """Whole milliseconds since 1970; a text without a zone is in UTC, wherever the driver is."""
    time = datetime.fromisoformat(timestamp)
    time = time if time.tzinfo else time.replace(tzinfo=timezone.utc)
    return str((time - datetime.fromtimestamp(0, timezone.utc)) // timedelta(milliseconds=1))


FILE_FORMATS = frozenset({"avro", "csv", "json", "orc", "parquet", "text"})
#: Options with which a caller limits the micro-batches of a source.
LIMIT_OPTIONS = frozenset(
    {"maxbytespertrigger", "maxfilespertrigger", "maxoffsetspertrigger", "minoffsetspertrigger", "maxtriggerdelay"}
)


@dataclass(frozen=True)
class Admission:
    """How much of a backlog one micro-batch takes: a batch of ``batch_bytes`` for each writer.

    Kafka counts records, so ``line_bytes`` is the expected size of a line.  With ``max_delay`` (as "1 second") a
    micro-batch also waits until one writer's batch is there, at most that long; leave it out for a run that
    ends with the backlog, as the rest of one would wait for the next run.
    """

    batch_bytes: int = DEFAULT_MAX_BATCH_BYTES
    line_bytes: int = 1000
    max_delay: str | None = None


def admission_options(format: str, given: Mapping[str, str], writers: int, admission: Admission = Admission()) -> dict[str, str]:
    """Default limits for the micro-batches of a source; none if the caller gives any, or for another format."""
    if LIMIT_OPTIONS & {name.lower() for name in given}:
        return {}
    if format in FILE_FORMATS:
        return {"maxBytesPerTrigger": str(writers * admission.batch_bytes)}
    if format != "kafka":
        return {}
    records = max(1, admission.batch_bytes // admission.line_bytes)
    options = {"maxOffsetsPerTrigger": str(writers * records)}
    if admission.max_delay:
        options |= {"minOffsetsPerTrigger": str(records), "maxTriggerDelay": admission.max_delay}
    return options


def kafka_options(
    topic: str,
    servers: str,
    consumer: Mapping[str, str] | None = None,
    max_records: int | None = None,
    position: str | None = None,
    timestamp: str | None = None,
) -> dict[str, str]:
    """Options for ``format("kafka")``.

    The start position is used by a new checkpoint only.  Without one the consumer setting
    ``auto.offset.reset`` counts; the oldest record is the default.
    """
    consumer = dict(consumer or {})
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    options |= {f"kafka.{key}": value for key, value in consumer.items() if key not in _KAFKA_NOT_PASSED}
    if position == AT_TIME:
        options["startingTimestamp"] = _epoch_millis(timestamp)
        # A partition without later records is read from its end instead of stopping the query.
        options["startingOffsetsByTimestampStrategy"] = "latest"
    else:
        names = {OLDEST: "earliest", NEWEST: "latest", None: consumer.get("auto.offset.reset", "earliest")}
        options["startingOffsets"] = names[position]
    if max_records is not None:
        options["maxOffsetsPerTrigger"] = str(max_records)
    return options


def kafka_sink_options(topic: str, servers: str, producer: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options for writing with ``format("kafka")``."""
    return {"kafka.bootstrap.servers": servers, "topic": topic} | {
        f"kafka.{key}": value for key, value in (producer or {}).items()
    }


def position_options(
    names: Mapping[str, str], position: str = NEWEST, timestamp: str | None = None, max_records: int | None = None
) -> dict[str, str]:
    """Start position and fetch size for a connector with its own option names.

    ``names`` maps ``position``, ``timestamp`` and ``max_records`` to the connector's options.
    """
    options = {names["position"]: position}
    if position == AT_TIME:
        options[names["timestamp"]] = timestamp
    if max_records is not None:
        options[names["max_records"]] = str(max_records)
    return options


# Where connectors for the two queue services usually keep the line columns; pass your own
# mapping to `read_lines` for a connector that differs.
KINESIS_COLUMNS = {
    "value": "data",
    "src_partition": "xxhash64(shardId)",
    "src_id": "CAST(NULL AS BIGINT)",
    "src_ts": "CAST(approximateArrivalTimestamp AS TIMESTAMP_NTZ)",
}
PUBSUB_COLUMNS = {
    "value": "payload",
    # The service has no partitions: messages are put together by the second in which they were published.
    "src_partition": "CAST(publishTimestampInMillis AS BIGINT) DIV 1000",
    "src_id": "CAST(NULL AS BIGINT)",
    "src_ts": "CAST(timestamp_millis(publishTimestampInMillis) AS TIMESTAMP_NTZ)",
}
