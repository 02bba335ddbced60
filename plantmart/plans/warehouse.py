"""Typed warehouse: full reload of tables, published all at once or not at all."""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantmart import storage
from plantmart.contracts import PLANTS, SOURCE, SOURCE_LENGTH, Contract
from plantmart.functions.casts import contract_projection, overlong
from plantmart.operators.filters import rolling_window, window_start
from plantmart.operators.merge import with_audit_columns
from plantmart.operators.quality import REQUIRED, check_keys, typed_rules
from plantmart.plans.ingest import NoRowCount
from plantmart.sources.raw import RawZone, literal, quoted

OK, UNKNOWN_TABLE, FAILED = 200, 400, 500
# The day of a clustered moment, stored beside it: Spark skips row groups by dates, but not by moments without a zone.
DAY = "_on_day"
TABLES_AT_ONCE = 10


class ContractViolation(Exception):
    """Typed rows break a rule that must hold before they are published."""


class LoadFailed(Exception):
    """A reload did not end with status 200."""


@dataclass(frozen=True)
class Published:
    path: str
    rows: int
    # What the raw zone held when the table was loaded, if that is known.
    raw: str | None = None
    # The column whose ranges the files hold, if the table is clustered.
    clustered: str | None = None


@dataclass
class ReloadResult:
    run_id: str
    status: int
    loaded: dict[str, int] = field(default_factory=dict)
    skipped: list[str] = field(default_factory=list)
    # Published rows of tables that were left as they are, because nothing new was delivered for them.
    carried: dict[str, int] = field(default_factory=dict)
    per_source: dict[str, dict[str, int]] = field(default_factory=dict)
    cut_values: dict[str, dict[str, int]] = field(default_factory=dict)
    message: str = ""
    # What went wrong after the rows were published; the next run mends it.
    warnings: list[str] = field(default_factory=list)

    def report(self, spark: SparkSession) -> DataFrame:
        """One row per table and per warning, or one row for a run that failed."""
        rows = [(self.run_id, t, "loaded", n, None) for t, n in self.loaded.items()]
        rows += [(self.run_id, t, "skipped", None, "not delivered") for t in self.skipped]
        rows += [(self.run_id, t, "carried", n, "unchanged") for t, n in self.carried.items()]
        rows += [(self.run_id, None, "warning", None, w) for w in self.warnings]
        if self.status != OK:
            rows = [(self.run_id, None, "failed", None, self.message)]
        schema = "run_id string, table_name string, status string, row_count bigint, message string"
        who = session_identity(spark).first()
        return (
            spark.createDataFrame(rows, schema)
            .withColumn("status_code", F.lit(self.status))
            .withColumn("run_by", F.lit(who.run_by))
            .withColumn("run_database", F.lit(who.run_database))
        )


def reason_of(error: Exception) -> str:
    """What an error says in one line; one of the JVM says so behind the call that it interrupted."""
    lines = str(error).strip().splitlines() or [type(error).__name__]
    return lines[1].lstrip(": ") if lines[0].startswith("An error occurred while calling") and lines[1:] else lines[0]


def session_identity(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(
        F.current_user().alias("run_by"), F.current_database().alias("run_database")
    )


def require_success(result: ReloadResult) -> ReloadResult:
    if result.status != OK:
        raise LoadFailed(f"status {result.status}: {result.message}")
    return result


class Snapshot:
    """The tables of one publish record. Reads through it stay consistent while others publish."""

    def __init__(self, spark: SparkSession, contracts: Mapping[str, Contract], tables: dict[str, Published]):
        self.spark = spark
        self.contracts = contracts
        self.published = tables

    def __contains__(self, table: str) -> bool:
        return table in self.published

    def read(self, table: str) -> DataFrame:
        """Rows of a table, all sources merged; the declared schema spares reading footers."""
        return read_typed(self.spark, self.contracts[table], self.published[table].path)

    def recent(self, table: str, column: str, as_of: datetime, months: int = 24) -> DataFrame:
        """The rolling window over a moment; of a table clustered by it only the files and row groups of the window."""
        entry, contract = self.published[table], self.contracts[table]
        rows = self.read(table)
        if entry.clustered == column and contract.column(column).kind == "timestamp":
            schema = T.StructType([*contract.schema.fields, T.StructField(DAY, T.DateType())])
            first = window_start(F.lit(as_of).cast("timestamp_ntz"), months).cast("date")
            rows = self.spark.read.schema(schema).parquet(entry.path).where(F.col(DAY) >= first).select(*contract.schema.names)
        return rolling_window(rows, column, as_of, months)

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in self.published}

    def lookup_bytes(self, table: str, columns: Sequence[str]) -> int | None:
        """Upper bound of the in-memory size of some columns: published rows times declared width."""
        width = self.contracts[table].row_bytes(columns)
        return None if width is None else self.published[table].rows * width

    def create_views(self, prefix: str = "") -> None:
        """One view per table over the rows of all sources."""
        for name, rows in self.tables().items():
            rows.createOrReplaceTempView(prefix + name)


def read_typed(spark: SparkSession, contract: Contract, path: str) -> DataFrame:
    stored = spark.read.schema(contract.schema).parquet(path)
    return stored.select(*contract.schema.names)


class Warehouse:
    """Tables live in one folder per run; a numbered record names the current folder of each.

    Readers follow the highest record. A reload writes only new folders and publishes one record
    after all of its tables are complete, so a failure leaves the previous load untouched. The record
    is the commit, and the only one. One writer at a time is assumed; a second one fails on the record number.

    With ``database``, the current folder of each table is also an external table there, so other
    sessions can read the warehouse with SQL. The tables follow the record: each changes its location in
    one step and is never missing, a failure is a warning, and the next run moves what stayed
    behind. Tables move one after the other; reads that must agree with one another go through :meth:`snapshot`.

    ``clustered`` names a column for some tables. Their files hold narrow ranges of it, so a filter on it skips
    files and row groups by their statistics, and :meth:`Snapshot.recent` does for moments; the load
    shuffles the table for that.
    """

    def __init__(
        self,
        spark: SparkSession,
        base: str,
        contracts: Mapping[str, Contract],
        database: str | None = None,
        clustered: Mapping[str, str] | None = None,
    ):
        self.spark = spark
        self.base = base.rstrip("/")
        self.contracts = contracts
        self.database = database
        self.clustered = dict(clustered or {})
        if unknown := [t for t, c in self.clustered.items() if c not in [column.name for column in contracts[t].columns]]:
            raise ValueError(f"clustered by columns that the contracts lack: {unknown}")

    def _records(self) -> list[int]:
        names = storage.child_names(self.spark, f"{self.base}/published")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _record_path(self, number: int) -> str:
        return f"{self.base}/published/{number:010d}.json"

    def _record(self, number: int) -> dict:
        return json.loads(storage.read_text(self.spark, self._record_path(number)))

    def published(self) -> dict[str, Published]:
        numbers = self._records()
        tables = self._record(numbers[-1])["tables"] if numbers else {}
        return {name: Published(**entry) for name, entry in tables.items()}

    def _publish(self, run_id: str, number: int, tables: Mapping[str, Published]) -> None:
        """The commit. A store may fail to answer after the record appeared, so that is looked up."""
        record = {"run_id": run_id, "tables": {n: vars(p) for n, p in tables.items()}}
        try:
            storage.publish_text(self.spark, self._record_path(number), json.dumps(record, indent=1))
        except Exception:
            if number not in self._records() or self._record(number)["run_id"] != run_id:
                raise

    def qualified(self, table: str) -> str:
        return f"{quoted(self.database)}.{quoted(table)}"

    def registered(self) -> dict[str, str | None]:
        """Where the external tables lie, for those published tables that have one; NULL for what is no table."""
        names = self.published() if self.database and self.spark.catalog.databaseExists(quoted(self.database)) else ()
        return {t: self._location(t) for t in names if self.spark.catalog.tableExists(self.qualified(t))}

    def _location(self, table: str) -> str | None:
        details = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.qualified(table)}")
        found = details.where("col_name = 'Location'").first()
        return found.data_type.rstrip("/") if found else None

    def behind(self) -> list[str]:
        """Published tables whose external table is missing or lies elsewhere than the current record says."""
        if not self.database:
            return []
        found = self.registered()
        paths = {t: storage.qualified(self.spark, entry.path) for t, entry in self.published().items()}
        return [table for table, path in paths.items() if found.get(table) != path]

    def register(self, tables: Sequence[str] | None = None) -> list[str]:
        """Point the external tables to the folders of the current record, and say what could not be moved."""
        problems: list[str] = []
        if not self.database:
            return problems
        try:
            self.spark.sql(
                f"CREATE DATABASE IF NOT EXISTS {quoted(self.database)} LOCATION {literal(self.base)}"
            )
            current = self.published()
        except Exception as error:  # the rows are published all the same
            return [f"{self.database} is not registered: {reason_of(error)}"]
        for table in current if tables is None else tables:
            try:
                self._follow(table, current[table].path)
            except Exception as error:
                problems.append(f"{table} is not registered: {reason_of(error)}")
        return problems

    def _follow(self, table: str, path: str) -> None:
        """Create the external table or change its location: one step of the catalog, and no moment without it.

        The files' folders tell the source, so the entry lists no partitions that would have to follow too.
        """
        name, fields = self.qualified(table), self.contracts[table].schema.fields
        declared = {f.name: f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fields}
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(declared.values())}) USING parquet LOCATION {literal(path)}"
            )
        known = {f.name: f.dataType for f in self.spark.table(name).schema.fields}
        changed = [f.name for f in fields if f.name in known and known[f.name] != f.dataType]
        if changed or not set(known) <= set(declared):
            raise ContractViolation(f"{name} was declared with other columns")
        if new := [text for column, text in declared.items() if column not in known]:
            self.spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(new)})")
        if self._location(table) != storage.qualified(self.spark, path):
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION {literal(path)}")
        self.spark.catalog.refreshTable(name)

    def recover(self) -> list[str]:
        """Move the external tables that an earlier run left behind; what cannot be moved is returned."""
        try:
            left = self.behind()
        except Exception as error:
            return [f"{self.database} cannot be read: {reason_of(error)}"]
        return self.register(left) if left else []

    def adopt(self, table: str, rows: DataFrame, run_id: str | None = None) -> Published:
        """Publish a table that was written before the audit columns existed; these are NULL then."""
        run_id = run_id or uuid.uuid4().hex
        contract, path = self.contracts[table], f"{self.base}/runs/{run_id}/{table}"
        counts = Observation()
        completed = with_audit_columns(rows, contract).select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in contract.schema.fields]
        )
        completed.observe(counts, F.count(F.lit(1)).alias("rows")).write.partitionBy(SOURCE).parquet(path)
        numbers, current = self._records(), self.published()
        current[table] = Published(path, counts.get["rows"])
        self._publish(run_id, numbers[-1] + 1 if numbers else 1, current)
        self.register()
        return current[table]

    def snapshot(self) -> Snapshot:
        return Snapshot(self.spark, self.contracts, self.published())

    def read(self, table: str) -> DataFrame:
        return self.snapshot().read(table)

    # Reload

    def _load(self, raw_zone: RawZone, table: str, run_id: str, strict_keys: bool):
        """Write one table to its run folder, counting rows and violations in the same pass."""
        contract = self.contracts[table]
        raw = raw_zone.read(table)
        delivered = raw_zone.sources(table)
        sources = sorted({s[:SOURCE_LENGTH] for s in delivered})
        if len(sources) < len(delivered):
            raise ContractViolation(f"{table}: sources are equal in {SOURCE_LENGTH} characters: {sorted(delivered)}")
        bounded = [c for c in contract.columns if c.length is not None]
        limited = [*(c.name for c in bounded), SOURCE]
        counted = contract_projection(contract) + [
            overlong(c).alias(f"_cut_{c.name}") for c in bounded
        ]
        counted.append((F.length(SOURCE) > SOURCE_LENGTH).alias(f"_cut_{SOURCE}"))
        rules = [r for r in typed_rules(contract, PLANTS) if r[0] == REQUIRED]
        counts = Observation()
        observed = self._in_ranges(table, raw.select(*counted)).observe(
            counts,
            F.count(F.lit(1)).alias("rows"),
            *[F.count_if(F.col(SOURCE) == s).alias(f"source_{i}") for i, s in enumerate(sources)],
            *[F.count_if(violated).alias(f"null_{name}") for _, name, violated in rules],
            *[F.count_if(f"_cut_{name}").alias(f"cut_{name}") for name in limited],
        )
        path = f"{self.base}/runs/{run_id}/{table}"
        (
            observed.select(*contract.schema.names, *self._days(table))
            .write.option("compression", "snappy")
            .partitionBy(SOURCE)
            .parquet(path)
        )
        seen = self._counted(table, counts.get, path)
        missing = {name: seen[f"null_{name}"] for _, name, _ in rules if seen[f"null_{name}"]}
        if missing:
            raise ContractViolation(f"{table}: NULL in required columns {missing}")
        if strict_keys and contract.key:
            surplus = check_keys(read_typed(self.spark, contract, path), contract).filter("violations > 0").collect()
            if surplus:
                raise ContractViolation(
                    f"{table}: repeated keys {({r[SOURCE]: r.violations for r in surplus})}"
                )
        per_source = {s: seen[f"source_{i}"] for i, s in enumerate(sources)}
        cut = {name: seen[f"cut_{name}"] for name in limited if seen[f"cut_{name}"]}
        return Published(path, seen["rows"], clustered=self.clustered.get(table)), per_source, cut

    def _in_ranges(self, table: str, rows: DataFrame) -> DataFrame:
        """Rows of a clustered table in ranges of its column, sorted within them.

        A value that many rows share, or NULL, is spread by a hash of the row. What is counted must be counted
        above this: finding the ranges reads the rows once before.
        """
        if table not in self.clustered:
            return rows
        column = self.clustered[table]
        spread = F.xxhash64(*self.contracts[table].schema.names)
        return rows.repartitionByRange(F.col(column), spread).sortWithinPartitions(SOURCE, column)

    def _days(self, table: str) -> list[Column]:
        column = self.clustered.get(table)
        is_moment = column is not None and self.contracts[table].column(column).kind == "timestamp"
        return [F.col(column).cast("date").alias(DAY)] if is_moment else []

    def _counted(self, table: str, metrics: Mapping[str, int | None], path: str) -> dict[str, int]:
        """The metrics of a write. Without rows Spark may give none; otherwise one that is missing fails the load."""
        if not metrics or any(value is None for value in metrics.values()):
            if not read_typed(self.spark, self.contracts[table], path).isEmpty():
                raise NoRowCount(f"{table}: rows were written, but not counted")
            return defaultdict(int)
        return dict(metrics)

    def reload(
        self,
        raw_zone: RawZone,
        table: str | None = None,
        run_id: str | None = None,
        strict_keys: bool = False,
        tables_at_once: int = TABLES_AT_ONCE,
        states: Mapping[str, str] | None = None,
        carry_unchanged: bool = False,
    ) -> ReloadResult:
        """Reload all contract tables, or one. Tables never delivered keep their previous rows.

        NULL in a required column and a malformed number fail the run; repeated keys do so only
        under ``strict_keys``. The external tables follow once the record is published, and a run begins
        with those that an earlier one left behind; either failing is a warning.

        ``states`` says what the raw zone holds of each table. It is published with the table, and with
        ``carry_unchanged`` a table whose state is the published one keeps its folder and its rows.
        """
        states = states or {}
        run_id = run_id or uuid.uuid4().hex
        if table and table != "all" and table not in self.contracts:
            return ReloadResult(run_id, UNKNOWN_TABLE, message=f"no contract for {table}")
        wanted = [table] if table and table != "all" else list(self.contracts)
        delivered = raw_zone.tables()
        skipped = [t for t in wanted if t not in delivered]
        to_load = [t for t in wanted if t in delivered]
        result = ReloadResult(run_id, OK, skipped=skipped)
        self.recover()
        numbers = self._records()
        current = self.published()
        if carry_unchanged:
            same = [t for t in to_load if t in current and t in states and current[t].raw == states[t]]
            result.carried = {t: current[t].rows for t in same}
            to_load = [t for t in to_load if t not in same]
        try:
            with ThreadPoolExecutor(max_workers=max(1, tables_at_once)) as pool:
                jobs = {t: pool.submit(self._load, raw_zone, t, run_id, strict_keys) for t in to_load}
            for name in to_load:
                published, result.per_source[name], cut = jobs[name].result()
                current[name] = replace(published, raw=states.get(name))
                result.loaded[name] = current[name].rows
                if cut:
                    result.cut_values[name] = cut
            self._publish(run_id, numbers[-1] + 1 if numbers else 1, current)
        except Exception as error:  # whatever went wrong, nothing was published
            return ReloadResult(run_id, FAILED, skipped=skipped, message=str(error))
        result.warnings = self.register()
        return result

    def retire(self, keep: int = 3) -> list[str]:
        """Delete run folders and records that none of the last ``keep`` records needs.

        What external tables still point to stays too. Folders that are newer than the last record may belong to a load that has not published yet.
        """
        numbers = self._records()
        kept = numbers[-keep:]
        used = set()
        for number in kept:
            record = self._record(number)
            used |= {entry["path"].rsplit("/", 2)[1] for entry in record["tables"].values()}
            used.add(record["run_id"])
        used |= {location.rsplit("/", 2)[1] for location in self.registered().values() if location}
        runs = {r: f"{self.base}/runs/{r}" for r in storage.child_names(self.spark, f"{self.base}/runs")}
        newest = storage.modified(self.spark, self._record_path(numbers[-1])) if numbers else 0
        gone = [r for r, path in runs.items() if r not in used and storage.modified(self.spark, path) < newest]
        for run in gone:
            storage.delete(self.spark, f"{self.base}/runs/{run}")
        for number in numbers[:-keep]:
            storage.delete(self.spark, self._record_path(number))
        return gone
