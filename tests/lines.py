"""Lines for the tests: a minimal event, with any field set."""

import uuid

from rillet.schema import LINE_POSITIONS

COLLECTED = "2023-10-24 10:00:00.000"
NOW = "2023-10-24 10:00:42.123"
BAD_LINES = ["nonsense1", "nonsense2"]


def line(**fields) -> str:
    values = {
        "event_id": str(uuid.uuid4()),
        "collector_tstamp": COLLECTED,
        "v_collector": "0.0.0",
        "v_etl": "0.0.0",
        **fields,
    }
    texts = [""] * len(LINE_POSITIONS)
    for name, value in values.items():
        texts[LINE_POSITIONS[name]] = value
    return "\t".join(texts)


def contexts(*entities) -> str:
    items = ",".join(f'{{"schema":"{schema}","data":{data}}}' for schema, data in entities)
    return f'{{"schema":"x:org.example/contexts/jsonschema/1-0-1","data":[{items}]}}'


def unstruct(schema: str, data: str) -> str:
    return f'{{"schema":"x:org.example/unstruct_event/jsonschema/1-0-0","data":{{"schema":"{schema}","data":{data}}}}}'


def frame(spark, lines):
    return spark.createDataFrame([(value,) for value in lines], "value string")
