"""Payload and error texts."""

from pyspark.sql import Column, functions as F

from rillet import constants as C


def utf8_payload(raw: Column) -> Column:
    """Bytes as text; each invalid byte sequence becomes the replacement character."""
    return F.make_valid_utf8(raw.cast("string"))


def clean_error_text(message: Column) -> Column:
    """A SQL error on one line, without its standard prefix."""
    one_line = F.regexp_replace(message, C.SQL_LINE_BREAK_PATTERN, C.SQL_LINE_BREAK_REPLACEMENT)
    return F.regexp_replace(one_line, C.SQL_COMPILATION_PATTERN, "")


def friendly_message(body_message: Column, raw: Column) -> Column:
    """The message of an error body, else the message quoted in the raw text, else the raw text."""
    # The match itself may be empty, so rlike decides and not the extracted text.
    quoted = F.when(raw.rlike(C.BODY_MESSAGE_PATTERN), F.regexp_extract(raw, C.BODY_MESSAGE_PATTERN, 1))
    return F.coalesce(body_message, quoted, raw)
