"""Table contracts as data: columns, types, lengths, keys, references and value checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import types as T

SOURCE = "source"
LOADED_AT = "last_updated_at"
SOURCE_LENGTH = 10
# The two delivering plants.
PLANTS = ("DKQ", "FOS")

_SPARK_TYPES = {
    "text": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampNTZType(),
}


@dataclass(frozen=True)
class Column:
    """One warehouse column; ``extract`` is its name in the delivery where that differs."""

    name: str
    kind: str
    length: int | None = None
    required: bool = True
    extract: str | None = None

    @property
    def raw_name(self) -> str:
        return self.extract or self.name

    @property
    def spark_type(self) -> T.DataType:
        return _SPARK_TYPES[self.kind]

    @property
    def max_bytes(self) -> int | None:
        """Largest in-memory size of one value: UTF-8 takes at most four bytes a character."""
        if self.kind != "text":
            return 8
        return None if self.length is None else 16 + 4 * self.length


@dataclass(frozen=True)
class Reference:
    """A foreign key."""

    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class Contract:
    name: str
    columns: tuple[Column, ...]
    key: tuple[str, ...] = ()
    references: tuple[Reference, ...] = ()
    allowed: tuple[tuple[str, tuple[str, ...]], ...] = ()

    def column(self, name: str) -> Column:
        return next(c for c in self.columns if c.name == name)

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if c.required]

    @property
    def raw_names(self) -> list[str]:
        return [c.raw_name for c in self.columns]

    @property
    def raw_schema(self) -> T.StructType:
        fields = [T.StructField(name, T.StringType()) for name in self.raw_names]
        return T.StructType(
            fields
            + [T.StructField(LOADED_AT, T.TimestampType()), T.StructField(SOURCE, T.StringType())]
        )

    @property
    def schema(self) -> T.StructType:
        fields = [T.StructField(c.name, c.spark_type) for c in self.columns]
        return T.StructType(
            fields
            + [T.StructField(SOURCE, T.StringType()), T.StructField(LOADED_AT, T.TimestampNTZType())]
        )

    def row_bytes(self, names: Sequence[str]) -> int | None:
        """Upper bound for one row of the named columns, None if a text has no length."""
        sizes = [self.column(n).max_bytes for n in names if n not in (SOURCE, LOADED_AT)]
        if any(size is None for size in sizes):
            return None
        return sum(sizes) + 16 + 4 * SOURCE_LENGTH + 8


def text(name: str, length: int | None = None, required: bool = True, extract: str | None = None):
    return Column(name, "text", length, required, extract)


def flag(name: str, required: bool = True):
    return Column(name, "text", 1, required)


def number(name: str, required: bool = True):
    return Column(name, "bigint", None, required)


def refers(columns: str, parent: str, parent_columns: str | None = None) -> Reference:
    child = tuple(columns.split())
    return Reference(child, parent, tuple((parent_columns or columns).split()))


def catalogue(*contracts: Contract) -> dict[str, Contract]:
    """Contracts by table name, in load order."""
    return {contract.name: contract for contract in contracts}
