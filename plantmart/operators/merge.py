"""Union of sources whose extracts need not agree on column order or completeness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from plantmart.contracts import LOADED_AT, SOURCE, Contract


def merge_sources(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of both, columns matched by name, missing ones NULL."""
    return first.unionByName(second, allowMissingColumns=True)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of many frames as a balanced tree, which Spark analyses much faster than a chain."""
    if len(frames) == 1:
        return frames[0]
    half = len(frames) // 2
    return union_all(frames[:half]).unionByName(union_all(frames[half:]))


def with_audit_columns(table: DataFrame, contract: Contract) -> DataFrame:
    """A table written before the audit columns existed, completed with NULLs."""
    spark = table.sparkSession
    wanted = {SOURCE, LOADED_AT}
    audit = [f for f in contract.schema.fields if f.name in wanted]
    missing = [f for f in audit if f.name not in table.columns]
    empty = spark.createDataFrame([], type(contract.schema)(missing)) if missing else None
    return table if empty is None else table.unionByName(empty, allowMissingColumns=True)
