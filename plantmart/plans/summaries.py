"""Contract reports from stored summaries: only sources that changed are counted again.

A summary holds the row counts and all violations of one source of one table. References hold within a source,
so it depends on that source of the table and of the parents, and on the contract, and on nothing else. What the raw
zone held of them when they were loaded is published with each table; a digest of it names the summary.
Summaries of different sources are disjoint, so a report is their union.
"""

from __future__ import annotations

import hashlib
import json
from collections import defaultdict
from collections.abc import Mapping, Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantmart import storage
from plantmart.contracts import PLANTS, SOURCE, SOURCE_LENGTH, Contract
from plantmart.operators.merge import union_all
from plantmart.operators.quality import check_tables, rows_per_source
from plantmart.plans.warehouse import Snapshot

_CHECKS = "array<struct<rule: string, column_name: string, violations: bigint>>"
_SCHEMA = f"table_name string, {SOURCE} string, row_count bigint, unknown_source_rows bigint, checks {_CHECKS}"


class Summaries:
    """Summaries under ``base``, one small file for each table and source.

    A file appears complete and is never changed; a load that broke off leaves sources without a summary, which
    are counted when a report is asked for. A table whose state in the raw zone is not known, or
    that refers to one, is counted anew for every report.
    """

    def __init__(
        self, spark: SparkSession, base: str, contracts: Mapping[str, Contract], plants: Sequence[str] = PLANTS
    ):
        self.spark = spark
        self.base = base.rstrip("/")
        self.contracts = contracts
        self.plants = plants

    @staticmethod
    def _sources(snapshot: Snapshot) -> dict[str, dict[str, str]]:
        """What the raw zone held of each source of the tables for which that is known."""
        return {
            name: {source[:SOURCE_LENGTH]: json.dumps(state) for source, *state in json.loads(entry.raw)}
            for name, entry in snapshot.published.items()
            if entry.raw is not None
        }

    def _wanted(self, snapshot: Snapshot) -> dict[tuple[str, str], str]:
        """The file of each table and source whose summary can be kept."""
        states, found = self._sources(snapshot), {}
        for table, sources in states.items():
            contract = self.contracts[table]
            parents = [r.parent for r in contract.references]
            if all(p in states or p not in snapshot for p in parents):
                for source, state in sources.items():
                    inputs = [repr(contract), list(self.plants), state, [states.get(p, {}).get(source) for p in parents]]
                    digest = hashlib.sha256(json.dumps(inputs).encode()).hexdigest()
                    found[table, source] = f"{quote(source, safe='')}-{digest}.json"
        return found

    def _folder(self, table: str) -> str:
        return f"{self.base}/{quote(table, safe='')}"

    def _stored(self, tables: set[str]) -> dict[str, set[str]]:
        return {t: set(storage.child_names(self.spark, self._folder(t))) for t in tables}

    def update(self, snapshot: Snapshot) -> dict[str, list[str]]:
        """Count the sources without a summary, and say which those were. No other source is read."""
        wanted = self._wanted(snapshot)
        stored = self._stored({t for t, _ in wanted})
        stale: dict[str, list[str]] = defaultdict(list)
        for (table, source), name in sorted(wanted.items()):
            if name not in stored[table]:
                stale[table].append(source)
        if not stale:
            return {}
        # At most one row for each rule, or table, and source.
        checks: dict[tuple[str, str], list[dict]] = defaultdict(list)
        for r in self.counted(snapshot, stale).collect():
            cell = {"rule": r.rule, "column_name": r.column_name, "violations": r.violations}
            checks[r.table_name, r[SOURCE]].append(cell)
        rows = union_all([
            rows_per_source(snapshot.read(t).where(F.col(SOURCE).isin(sources)), t, self.plants)
            for t, sources in stale.items()
        ])
        counts = {(r.table_name, r[SOURCE]): (r.row_count, r.unknown_source_rows) for r in rows.collect()}
        for table, sources in stale.items():
            for source in sources:
                n, unknown = counts.get((table, source), (0, 0))
                summary = {
                    "table_name": table, SOURCE: source, "row_count": n, "unknown_source_rows": unknown,
                    "checks": checks[table, source],
                }
                path = f"{self._folder(table)}/{wanted[table, source]}"
                storage.publish_text(self.spark, path, json.dumps(summary))
        return dict(stale)

    def counted(self, snapshot: Snapshot, only: Mapping[str, Sequence[str] | None]) -> DataFrame:
        """The checks of some sources of some tables, from their rows."""
        return check_tables(snapshot.tables(), self.contracts, self.plants, snapshot.lookup_bytes, only)

    def _summaries(self, snapshot: Snapshot) -> DataFrame:
        paths = [f"{self._folder(table)}/{name}" for (table, _), name in sorted(self._wanted(snapshot).items())]
        if not paths:
            return self.spark.createDataFrame([], _SCHEMA)
        # Names hold percent signs of their own, which a path given as text keeps.
        return self.spark.read.schema(_SCHEMA).json(paths)

    def _unknown(self, snapshot: Snapshot) -> list[str]:
        known = {t for t, _ in self._wanted(snapshot)} | {t for t, s in self._sources(snapshot).items() if not s}
        return [t for t in snapshot.published if t not in known]

    def report(self, snapshot: Snapshot) -> DataFrame:
        """(table_name, rule, column_name, source, violations), as ``check_tables`` gives it for the whole snapshot."""
        self.update(snapshot)
        found = self._summaries(snapshot).select("table_name", SOURCE, F.inline("checks"))
        found = found.select("table_name", "rule", "column_name", SOURCE, "violations")
        unknown = self._unknown(snapshot)
        return found.unionByName(self.counted(snapshot, dict.fromkeys(unknown))) if unknown else found

    def row_counts(self, snapshot: Snapshot) -> DataFrame:
        """(table_name, source, row_count, unknown_source_rows), as ``rows_per_source`` gives it for each table."""
        self.update(snapshot)
        columns = ("table_name", SOURCE, "row_count", "unknown_source_rows")
        found = self._summaries(snapshot).select(*columns).where("row_count > 0")
        live = [rows_per_source(snapshot.read(t), t, self.plants).select(*columns) for t in self._unknown(snapshot)]
        return union_all([found, *live])

    def retire(self, snapshot: Snapshot) -> list[str]:
        """Delete the summaries that the snapshot's reports do not need."""
        kept = defaultdict(set)
        for (table, _), name in self._wanted(snapshot).items():
            kept[table].add(name)
        gone = []
        for table, names in self._stored(set(self.contracts)).items():
            gone += [f"{self._folder(table)}/{name}" for name in sorted(names - kept[table])]
        for path in gone:
            storage.delete(self.spark, path)
        return gone
