"""Row checks before the write, and what becomes of the rows that fail them."""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from rillet.constants import NOT_NULL_COLUMNS
from rillet.functions.errors import is_data_issue
from rillet.operators.transform import entity_names

#: (condition that is true for a failing row, error code, message)
Validator = tuple[Column, str, str]


def row_validators(max_row_bytes: int | None = None, extra: Iterable[Validator] = ()) -> list[Validator]:
    """The checks of every events table, then the caller's own."""
    checks = [
        (F.col(name).isNull(), "NULL_VALUE", f"Missing a value for column {name}") for name in NOT_NULL_COLUMNS
    ]
    if max_row_bytes is not None:
        checks.append(
            (F.octet_length("value") > max_row_bytes, "MAX_ROW_SIZE_EXCEEDED", "The row is too large")
        )
    return checks + list(extra)


def validate_rows(rows: DataFrame, validators: Iterable[Validator]) -> DataFrame:
    """Add ``error_code`` and ``error_message`` of the first failing check; null for valid rows."""
    code, message = F.lit(None).cast("string"), F.lit(None).cast("string")
    for condition, check_code, check_message in reversed(list(validators)):
        code = F.when(condition, F.lit(check_code)).otherwise(code)
        message = F.when(condition, F.lit(check_message)).otherwise(message)
    return rows.withColumns({"error_code": code, "error_message": message})


def extra_columns_of_row(table_columns: Iterable[str]) -> Column:
    """Entity columns a row needs and the table lacks."""
    return F.array_except(entity_names(), F.array(*[F.lit(name) for name in table_columns]))


def failure_outcome(extra_cols: Column, error_code: Column) -> Column:
    """``evolve``, ``bad`` or ``fatal`` for a failed row, ``ok`` without a failure.

    A row with extra columns is written again after the table gained them, whatever else was
    reported for it.
    """
    return (
        F.when(F.size(extra_cols) > 0, F.lit("evolve"))
        .when(error_code.isNull(), F.lit("ok"))
        .when(is_data_issue(error_code), F.lit("bad"))
        .otherwise(F.lit("fatal"))
    )
