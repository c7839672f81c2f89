"""Schema keys of entities: ``<scheme>:<vendor>/<name>/<format>/<model>-<revision>-<addition>``.

The functions take and return SQL expressions.
"""

import re

from rillet.constants import CONTEXTS_PREFIX, UNSTRUCT_PREFIX

_NUMBER = "(?:0|[1-9][0-9]*)"
SCHEMA_KEY = rf"\A[a-z]+:[\w.-]+/[\w-]+/[\w-]+/{_NUMBER}-{_NUMBER}-{_NUMBER}\z"


def is_schema_key(key: str) -> str:
    return f"coalesce({key} RLIKE r'{SCHEMA_KEY}', false)"


def schema_version(key: str) -> str:
    """``model-revision-addition`` of a schema key."""
    return f"substring_index({key}, '/', -1)"


def column_of_valid_key(key: str, prefix: str) -> str:
    """Column for an entity type: prefix, vendor, snake-case name and model number, lower case."""
    vendor = f"substring_index(substring_index({key}, '/', 1), ':', -1)"
    name = f"substring_index(substring_index({key}, '/', 2), '/', -1)"
    snake = f"regexp_replace({name}, '([^A-Z_.-])([A-Z])', '$1_$2')"
    model = f"substring_index({schema_version(key)}, '-', 1)"
    column = f"lower(concat('{prefix}', {vendor}, '_', {snake}, '_', {model}))"
    return f"replace(replace({column}, '.', '_'), '-', '_')"


def unstruct_column_name(key: str) -> str:
    """Column of a self-describing event; null where the key is not a schema key."""
    return f"CASE WHEN {is_schema_key(key)} THEN {column_of_valid_key(key, UNSTRUCT_PREFIX)} END"


def contexts_column_name(key: str) -> str:
    """Column of a context; null where the key is not a schema key."""
    return f"CASE WHEN {is_schema_key(key)} THEN {column_of_valid_key(key, CONTEXTS_PREFIX)} END"


def skip_pattern(criteria) -> str | None:
    """One regular expression for a list of criteria such as ``x:com.acme/page/jsonschema/1-*-*``.

    A ``*`` stands for any number.  Returns None for an empty list.
    """
    alternatives = []
    for criterion in criteria:
        head, version = criterion.rsplit("/", 1)
        if not re.fullmatch(r"(\d+|\*)-(\d+|\*)-(\d+|\*)", version) or head.count("/") != 2:
            raise ValueError(f"Not a schema criterion: {criterion}")
        numbers = [r"\d+" if part == "*" else part for part in version.split("-")]
        alternatives.append(re.escape(head) + "/" + "-".join(numbers))
    return rf"\A(?:{'|'.join(alternatives)})\z" if alternatives else None


def is_skipped(key: str, criteria) -> str:
    pattern = skip_pattern(criteria)
    return f"coalesce({key} RLIKE r'{pattern}', false)" if pattern else "false"
