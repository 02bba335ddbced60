"""Typed columns from raw text."""

from __future__ import annotations

from pyspark.sql import Column as SparkColumn
from pyspark.sql import functions as F

from plantmart.contracts import LOADED_AT, SOURCE, SOURCE_LENGTH, Column, Contract


def blank_to_null(text: SparkColumn) -> SparkColumn:
    """Spaces at both ends go; what is empty then is NULL. Tabs stay."""
    return F.nullif(F.trim(text), F.lit(""))


def cast_expr(column: Column) -> SparkColumn:
    """Raw text to the declared type under the declared name.

    Only BIGINT input is trimmed. A malformed number fails the query, as ANSI casts do. Text is cut
    to its length with ``substring``: a Spark cast to varchar(n) keeps the whole value.
    """
    raw = F.col(f"`{column.raw_name}`")
    if column.kind == "bigint":
        value = blank_to_null(raw).cast("bigint")
    elif column.kind == "text":
        value = raw if column.length is None else F.substring(raw, 1, column.length)
    else:
        value = raw.cast(column.spark_type)
    return value.alias(column.name)


def malformed(column: Column) -> SparkColumn:
    """True where the cast of a non-text column would fail."""
    raw = F.col(f"`{column.raw_name}`")
    text = blank_to_null(raw) if column.kind == "bigint" else raw
    return text.isNotNull() & text.try_cast(column.spark_type).isNull()


def overlong(column: Column) -> SparkColumn:
    """True where the cast would cut text."""
    return F.coalesce(F.length(F.col(f"`{column.raw_name}`")) > column.length, F.lit(False))


def audit_columns() -> list[SparkColumn]:
    return [
        F.substring(F.col(SOURCE), 1, SOURCE_LENGTH).alias(SOURCE),
        F.col(LOADED_AT).cast("timestamp_ntz").alias(LOADED_AT),
    ]


def contract_projection(contract: Contract) -> list[SparkColumn]:
    """Declared columns in declared order, then the two audit columns."""
    return [cast_expr(c) for c in contract.columns] + audit_columns()
