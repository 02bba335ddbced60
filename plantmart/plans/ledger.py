"""Which delivered extracts have been ingested: one small record for each, replaced when it is ingested again."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass
from datetime import datetime
from urllib.parse import quote

from pyspark.sql import DataFrame, Row, SparkSession

from plantmart import storage
from plantmart.sources.landing import versions
from plantmart.sources.raw import RawZone

_SCHEMA = "table string, source string, version string, rows bigint, malformed bigint, loaded_at string"


@dataclass(frozen=True)
class Finished:
    """An extract in the raw zone; `version` stands for the files it was read from."""

    table: str
    source: str
    version: str
    rows: int
    malformed: int
    loaded_at: str


class Ledger:
    """Records under ``base``. One appears when its extract is in the raw zone, and goes before that changes.

    So a run that breaks off leaves at most extracts without a record, which are ingested again, and
    never a record without its extract.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def _path(self, table: str, source: str) -> str:
        return f"{self.base}/{quote(table, safe='')}/{quote(source, safe='')}.json"

    def finished(self) -> dict[tuple[str, str], Finished]:
        """All records, one row per extract as in the manifest. What is no whole record is none."""
        if not storage.child_names(self.spark, self.base):
            return {}
        rows = self.spark.read.schema(_SCHEMA).option("recursiveFileLookup", True).json(self.base)
        found = (Finished(**r.asDict()) for r in rows.where("version IS NOT NULL AND rows IS NOT NULL").collect())
        return {(f.table, f.source): f for f in found}

    def begin(self, table: str, source: str) -> None:
        """From now on the extract in the raw zone is not known."""
        storage.delete(self.spark, self._path(table, source))

    def finish(self, table: str, source: str, version: str, rows: int, malformed: int, loaded_at: datetime) -> None:
        done = Finished(table, source, version, rows, malformed, loaded_at.isoformat())
        storage.publish_text(self.spark, self._path(table, source), json.dumps(asdict(done)))


class Bookkeeping:
    """The extracts of one run against the ledger: which are new, and what the raw zone holds after them."""

    def __init__(self, ledger: Ledger, zone: RawZone, files: DataFrame, entries: Sequence[Row]):
        self.ledger, self.zone = ledger, zone
        self.finished = ledger.finished()
        known = {r.path: r.version for r in versions(files).collect()} if entries else {}
        self.version = {(e.job.target_table, e.job.source_system): known[e.job.source_path] for e in entries}

    def holds(self, entry: Row) -> bool:
        """Whether the raw zone holds exactly this extract."""
        key = (entry.job.target_table, entry.job.source_system)
        known = self.finished.get(key)
        return known is not None and known.version == self.version[key] and key[1] in self.zone.sources(key[0])

    def begin(self, entries: Sequence[Row]) -> None:
        for entry in entries:
            self.finished.pop((entry.job.target_table, entry.job.source_system), None)
            self.ledger.begin(entry.job.target_table, entry.job.source_system)

    def finish(self, table: str, source: str, rows: int, malformed: int, loaded_at: datetime) -> None:
        self.ledger.finish(table, source, self.version[table, source], rows, malformed, loaded_at)
        done = Finished(table, source, self.version[table, source], rows, malformed, loaded_at.isoformat())
        self.finished[table, source] = done

    def states(self, tables: Sequence[str]) -> Mapping[str, str]:
        """What the raw zone holds of each table: load times and versions of all its sources, if all are known."""
        found = {}
        for table in tables:
            parts = [self.finished.get((table, source)) for source in sorted(self.zone.sources(table))]
            if parts and all(parts):
                found[table] = json.dumps([[p.source, p.version, p.loaded_at] for p in parts])
        return found
