"""Row filters the contract describes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantmart.lab_tables import (
    EXCLUDED_CODE,
    FORMAT_TYPE,
    MONTHLY_CODE,
    STATUS_FLAGS,
)


def without_excluded(
    results: DataFrame, flags: Sequence[str] = STATUS_FLAGS, code: str = EXCLUDED_CODE
) -> DataFrame:
    """Rows none of whose flags holds the excluded code; a NULL flag excludes nothing."""
    for name in flags:
        results = results.filter(~F.col(name).eqNullSafe(F.lit(code)))
    return results


def of_type(phrases: DataFrame, phrase_type: str, column: str = "phrase_type") -> DataFrame:
    return phrases.filter(F.col(column) == phrase_type)


def format_phrases(phrases: DataFrame) -> DataFrame:
    return of_type(phrases, FORMAT_TYPE)


def monthly_rows(results: DataFrame, column: str = "annuel", code: str = MONTHLY_CODE) -> DataFrame:
    return results.filter(F.col(column) == code)


def window_start(as_of: Column, months: int = 24) -> Column:
    return as_of - F.make_ym_interval(F.lit(0), F.lit(months))


def rolling_window(
    results: DataFrame, date_column: str, as_of: datetime | Column, months: int = 24
) -> DataFrame:
    """Rows later than ``as_of`` minus the window, the lower bound itself excluded.

    The contract declares no date column, so the caller names it. Given a plain date, the bound is a
    constant that reaches the Parquet scan.
    """
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp_ntz")
    return results.filter(F.col(date_column) > window_start(as_of, months))
