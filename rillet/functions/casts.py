"""Text to typed values, as SQL expressions over a text expression.

Null stays null; a text of the wrong form gives null.  An empty text counts as null where the
caller says so (`blank_as_null`).  Spark's casts trim blanks, so the form is checked first.
"""

# Forms a text must have for its type.
FORMS = {
    "int": r"\A[+-]?[0-9]+\z",
    "bigint": r"\A[+-]?[0-9]+\z",
    "timestamp_ntz": r"\A\d{4}-\d\d-\d\d[ T]\d\d:\d\d:\d\d(\.\d{1,9})?\z",
    "date": r"\A\d{4}-\d\d-\d\d\z",
}
UUID_FORM = r"\A[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\z"


def blank_as_null(text: str) -> str:
    return f"nullif({text}, '')"


def typed_value(text: str, sql_type: str) -> str:
    """The value of a text in a table type.

    Booleans are written 1 and 0.  A decimal is rounded half up to its scale; overflow gives null.
    """
    if sql_type == "string":
        return text
    if sql_type == "boolean":
        return f"CASE {text} WHEN '1' THEN true WHEN '0' THEN false END"
    cast = f"try_cast({text} AS {sql_type})"
    if sql_type in FORMS:
        return f"CASE WHEN {text} RLIKE r'{FORMS[sql_type]}' THEN {cast} END"
    return cast


def uuid_value(text: str) -> str:
    return f"CASE WHEN {text} RLIKE r'{UUID_FORM}' THEN lower({text}) END"


def decimal_value(unscaled: str, precision: int, scale: int) -> str:
    """A whole number of the smallest unit as a decimal, e.g. cents; null where it does not fit."""
    unit = f"CAST('1e-{scale}' AS DECIMAL({scale + 1},{scale}))"
    return f"try_cast(try_cast({unscaled} AS DECIMAL({37 - scale},0)) * {unit} AS DECIMAL({precision},{scale}))"
