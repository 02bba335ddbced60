"""Delimited-text scans. Every column is a string; types belong to the warehouse."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MALFORMED = "_malformed_record"


@dataclass(frozen=True)
class Layout:
    has_header: bool = True
    delimiter: str = ","
    encoding: str = "utf-8"
    multi_line: bool = False


def _reader(spark: SparkSession, layout: Layout):
    return (
        spark.read.option("header", str(layout.has_header).lower())
        .option("inferSchema", "false")
        .option("sep", layout.delimiter)
        .option("encoding", layout.encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", str(layout.multi_line).lower())
    )


def scan_delimited(
    spark: SparkSession,
    path: str,
    layout: Layout = Layout(),
    names: Sequence[str] | None = None,
    parts: int = 1,
    keep_malformed: bool = False,
) -> DataFrame:
    """One extract (a file or a folder of part files) as an all-string DataFrame.

    Column names come folded to lower case from the header. An extract without one takes ``names``,
    or positional ``_c0`` names. Rows with too few fields are filled with NULL and surplus fields
    dropped; ``keep_malformed`` adds the text of such rows as one more column.
    """
    reader = _reader(spark, layout)
    if layout.has_header or names is None:
        header = [name.lower() for name in reader.csv(path).columns]
        if not header:
            raise ValueError(f"{path} holds no header and no data")
    else:
        header = list(names)
    fields = [T.StructField(name, T.StringType()) for name in header]
    if keep_malformed:
        fields.append(T.StructField(MALFORMED, T.StringType()))
    if parts > 1:
        # Spark assigns values by position; parts that disagree on the header must not pass.
        reader = reader.option("enforceSchema", "false")
    return (
        reader.option("columnNameOfCorruptRecord", MALFORMED).schema(T.StructType(fields)).csv(path)
    )
