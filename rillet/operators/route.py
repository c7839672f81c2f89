"""Columns the rows need and the table lacks: find them and decide what to do about each."""

from pyspark.sql import Column, DataFrame, functions as F

from rillet import constants as C
from rillet.schema import ATOMIC_NAMES, CONTEXTS_TYPE, UNSTRUCT_TYPE


def extra_columns(failures: DataFrame) -> DataFrame:
    """The distinct extra columns that write failures report."""
    # The outer form spares the second evaluation that Spark's inferred filter would cost.
    return failures.select(F.explode_outer("extra_cols").alias("name")).distinct().filter("name IS NOT NULL")


def missing_columns(required: DataFrame, table_columns: DataFrame) -> DataFrame:
    """Required column names that are not among the table's."""
    return required.join(table_columns, "name", "left_anti")


#: Columns that can be added: the pattern of their names, the route, and their type.
ADDABLE = ((C.UNSTRUCT_PATTERN, "object", UNSTRUCT_TYPE), (C.CONTEXTS_PATTERN, "array", CONTEXTS_TYPE))


def route_column(name: Column) -> Column:
    """What a missing column calls for; the order of the rules matters.

    ``object`` and ``array`` columns can be added.  ``missing_atomic`` means that the table was not
    made for these events, and ``unrecognized`` that the rows are not events.
    """
    atomic = F.when(name.isin(*ATOMIC_NAMES, C.LOAD_COLUMN), F.lit("missing_atomic"))
    addable = [F.when(name.rlike(pattern), F.lit(route)) for pattern, route, _ in ADDABLE]
    return F.coalesce(*addable, atomic, F.lit("unrecognized"))


def route_columns(names: DataFrame) -> DataFrame:
    """``name``, ``route`` and the type to add the column with (null where it cannot be added)."""
    routed = names.select("name", route_column(F.col("name")).alias("route"))
    return routed.withColumn("column_type", F.coalesce(*(F.when(F.col("route") == route, F.lit(kind)) for _, route, kind in ADDABLE)))
