"""The raw zone: all-string Parquet per table and source, exposed as external tables."""

from __future__ import annotations

from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from plantmart import storage
from plantmart.contracts import LOADED_AT, SOURCE


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


# The printable characters that Spark escapes in the name of a partition folder.
_ESCAPED = "\"#%'*/:=?\\{[]^"


def _folder(source: str) -> str:
    escaped = (f"%{ord(c):02X}" if c in _ESCAPED or ord(c) < 32 or ord(c) == 127 else c for c in source)
    return f"{SOURCE}={''.join(escaped)}"


class RawZone:
    def __init__(self, spark: SparkSession, base: str, database: str):
        self.spark = spark
        self.base = base.rstrip("/")
        self.database = database
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)} LOCATION {literal(self.base)}")

    def path(self, table: str) -> str:
        return f"{self.base}/{table}"

    def leaf(self, table: str, source: str) -> str:
        return f"{self.path(table)}/{_folder(source)}"

    def qualified(self, table: str) -> str:
        return f"{quoted(self.database)}.{quoted(table)}"

    def sources(self, table: str) -> list[str]:
        """Sources with a partition folder."""
        folders = storage.child_names(self.spark, self.path(table))
        prefix = f"{SOURCE}="
        return [unquote(f[len(prefix):]) for f in folders if f.startswith(prefix)]

    def layout_differences(self, table: str, expected: Iterable[str]) -> list[tuple[str, str]]:
        """(source, problem) where the partition folders differ from the expected sources."""
        found, wanted = set(self.sources(table)), set(expected)
        missing = [(source, "missing") for source in sorted(wanted - found)]
        return missing + [(source, "unexpected") for source in sorted(found - wanted)]

    def tables(self) -> set[str]:
        """Tables the catalog knows."""
        listed = self.spark.catalog.listTables(quoted(self.database))
        return {t.name for t in listed if not t.isTemporary}

    def holds(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.qualified(table))

    def columns(self, table: str, known_sources: Iterable[str] = ()) -> list[str]:
        """Text columns of the registered table, or of its files where it is not registered yet.

        All files of one source come from one write, so one footer per source tells its columns, and
        none is needed for sources whose columns the caller knows.
        """
        if self.holds(table):
            found = self.spark.table(self.qualified(table)).columns
        else:
            found = []
            for source in sorted(set(self.sources(table)) - set(known_sources)):
                leaf = self.spark.read.parquet(self.leaf(table, source))
                found += [c for c in leaf.columns if c not in found]
        return [c for c in found if c not in (SOURCE, LOADED_AT)]

    def register(
        self, table: str, columns: Iterable[str] = (), written_sources: Iterable[str] = ()
    ) -> None:
        """Expose the table's files. A column that any source ever delivered stays in the schema.

        ``columns`` are those of the sources just written.
        """
        known = self.columns(table, written_sources)
        new = [c for c in columns if c not in known]
        name = self.qualified(table)
        if not self.holds(table):
            fields = ", ".join(f"{quoted(c)} STRING" for c in known + new)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({fields}, {LOADED_AT} TIMESTAMP, {SOURCE} STRING) "
                f"USING parquet PARTITIONED BY ({SOURCE}) LOCATION {literal(self.path(table))}"
            )
        elif new:
            fields = ", ".join(f"{quoted(c)} STRING" for c in new)
            self.spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({fields})")
        partitions = " ".join(f"PARTITION ({SOURCE}={literal(s)})" for s in self.sources(table))
        if partitions:
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {partitions}")
        self.spark.catalog.refreshTable(name)

    def recover(self) -> None:
        """Register tables that have files but no catalog entry, e.g. in a session-only catalog."""
        for table in storage.child_names(self.spark, self.base):
            if self.sources(table) and not self.holds(table):
                self.register(table)

    def read(self, table: str) -> DataFrame:
        """All sources of a table; a column one of them lacks is NULL there."""
        return self.spark.table(self.qualified(table))
