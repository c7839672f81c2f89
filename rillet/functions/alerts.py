"""Alerts as text, and names used in health reports."""

import re

from pyspark.sql import Column, functions as F

from rillet import constants as C


def _fill(template: str, values: dict) -> Column:
    pieces = [F.lit("")]
    for piece in re.split(r"(%[a-z]+)", template):
        pieces.append(F.coalesce(values[piece[1:]], F.lit("")) if piece.startswith("%") else F.lit(piece))
    return F.concat(*pieces)


def alert_text(
    alert_type: Column,
    db: Column,
    schema: Column,
    columns: Column,
    cause: Column,
    destination: str = "warehouse",
    pipeline: str = "the event pipeline",
) -> Column:
    """The text of an alert; null for an unknown alert type."""
    values = {"db": db, "schema": schema, "columns": F.array_join(columns, ","), "cause": cause}
    text = None
    for name, template in C.ALERT_TEXTS.items():
        filled = _fill(template.format(destination=destination, pipeline=pipeline), values)
        text = F.when(alert_type == name, filled) if text is None else text.when(alert_type == name, filled)
    return text


def service_label(service: Column, destination: str = "warehouse") -> Column:
    """Name of a service in a health report: ``table`` or ``failed_events``."""
    return F.when(service == "table", F.lit(destination)).when(
        service == "failed_events", F.lit(C.FAILED_EVENT_SINK_LABEL)
    )


def qualified_name(*parts: Column) -> Column:
    """``db.schema.table``"""
    return F.concat_ws(".", *parts)


def channel_name(prefix: str, index: Column) -> Column:
    return F.concat(F.lit(prefix + "-"), index.cast("string"))
