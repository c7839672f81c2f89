"""What an error means: wrong data, wrong set-up, or a passing fault."""

from pyspark.sql import Column, functions as F

from rillet import constants as C
from rillet.functions.texts import clean_error_text, friendly_message


def is_data_issue(error_code: Column) -> Column:
    """True for codes that blame the row, false for codes that blame the environment."""
    return error_code.isin(*C.DATA_ISSUE_CODES)


def setup_error_message(
    kind: Column, code: Column, body_message: Column, raw: Column, destination: str = "warehouse"
) -> Column:
    """The text for a set-up error; null for an error that may pass by itself.

    ``kind`` is ``ingest`` (an HTTP answer), ``security``, ``sql`` or anything else.
    """
    shown = friendly_message(body_message, raw)
    ingest = (
        F.when(
            code.between(*C.CLIENT_ERROR_CODES),
            F.when(shown.rlike(C.TABLE_TYPE_PATTERN), F.lit(C.TABLE_TYPE_TEXT.format(destination=destination)))
            .otherwise(shown),
        )
        .when(code == C.UNKNOWN_HOST_CODE, F.lit(C.UNKNOWN_HOST_TEXT.format(destination=destination)))
    )
    return (
        F.when(kind == "ingest", ingest)
        .when(kind == "security", F.lit(C.UNAUTHORIZED_TEXT))
        .when((kind == "sql") & code.isin(*C.SETUP_SQL_CODES), clean_error_text(raw))
    )


def error_class(setup_message: Column) -> Column:
    return F.when(setup_message.isNotNull(), F.lit("setup")).otherwise(F.lit("transient"))
