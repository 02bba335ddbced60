"""A full historical load that resumes: extract by extract, each recorded as soon as it is in the raw zone."""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from plantmart import session, storage
from plantmart.contracts import Contract
from plantmart.plans.daily_run import FILES_AT_ONCE, ledger_of, survey_landing
from plantmart.plans.ingest import ingest_table
from plantmart.plans.ledger import Bookkeeping
from plantmart.plans.vault import replicate
from plantmart.plans.warehouse import ReloadResult, Warehouse, reason_of, require_success
from plantmart.sources.landing import Zones
from plantmart.sources.raw import RawZone
from plantmart.sources.stores import arrow_uri

INGESTED, CARRIED, BROKEN = "ingested", "carried", "broken"
REPORT_SCHEMA = "table_name string, source string, outcome string, row_count bigint, message string"


@dataclass(frozen=True)
class Outcome:
    table: str
    source: str
    outcome: str
    rows: int | None
    message: str | None = None


@dataclass
class BackfillResult:
    outcomes: list[Outcome]
    reload: ReloadResult | None = None

    def report(self, spark: SparkSession) -> DataFrame:
        """One row per extract: ingested by this run, carried from an earlier one, or broken, and why."""
        rows = [(o.table, o.source, o.outcome, o.rows, o.message) for o in self.outcomes]
        return spark.createDataFrame(rows, REPORT_SCHEMA)


class BackfillBroken(Exception):
    """Some extracts failed. The others are in the raw zone and are not read again by the next run."""

    def __init__(self, result: BackfillResult):
        self.result = result
        broken = [o for o in result.outcomes if o.outcome == BROKEN]
        super().__init__(f"{len(broken)} of {len(result.outcomes)} extracts failed, first {broken[0].table} of "
                         f"{broken[0].source}: {broken[0].message}")  # fmt: skip


def _load_extract(
    zone: RawZone, book: Bookkeeping, entry: Row, contract: Contract | None, loaded_at: datetime
) -> Outcome:
    """Ingest one extract and record it."""
    table, source = entry.job.target_table, entry.job.source_system
    try:
        (done,) = ingest_table(zone, table, [entry], loaded_at, contract)
        book.finish(table, source, done.rows, done.malformed, loaded_at)
    except Exception as error:  # the others go on
        return Outcome(table, source, BROKEN, None, reason_of(error))
    return Outcome(table, source, INGESTED, done.rows)


def backfill(
    spark: SparkSession,
    zones: Zones,
    contracts: Mapping[str, Contract],
    loaded_at: datetime | None = None,
    run_id: str | None = None,
    strict_keys: bool = False,
) -> BackfillResult:
    """Load everything that is landed, and continue where an earlier run broke off.

    Extracts of one table follow one another, tables are loaded side by side. An extract whose files are the ones
    that the ledger knows is carried: it is neither copied nor read again and keeps its time of load. If an
    extract fails the others still go on; then the run fails before the warehouse is touched. With all of
    them in the raw zone, the warehouse is reloaded as in a daily run.
    """
    spark = session.configure(spark)
    for place in (zones.landed, zones.replicated):
        arrow_uri(storage.qualified(spark, place))
    loaded_at = loaded_at or datetime.now(timezone.utc)
    zone = RawZone(spark, zones.processed, zones.database)
    zone.recover()
    landing = survey_landing(spark, zones)
    entries = sorted(landing.entries, key=lambda e: (e.job.target_table, e.job.source_system))
    book = Bookkeeping(ledger_of(spark, zones), zone, landing.files, entries)
    pending = [e for e in entries if not book.holds(e)]
    book.begin(pending)
    if pending:
        # One job copies all that is new, before any of it is recorded.
        paths = spark.createDataFrame([(e.job.source_path,) for e in pending], "wanted string")
        new = landing.accepted.join(paths, F.col("job.source_path") == F.col("wanted"), "left_semi")
        replicate(landing.files, new, zones.replicated, sum(e.delivery.bytes for e in pending))
    by_table: dict[str, list[Row]] = defaultdict(list)
    for entry in entries:
        by_table[entry.job.target_table].append(entry)

    def load(entries: list[Row]) -> list[Outcome]:
        outcomes = []
        for entry in entries:
            table, source = entry.job.target_table, entry.job.source_system
            if entry in pending:
                outcomes.append(_load_extract(zone, book, entry, contracts.get(table), loaded_at))
            else:
                outcomes.append(Outcome(table, source, CARRIED, book.finished[table, source].rows))
        return outcomes

    with ThreadPoolExecutor(max_workers=FILES_AT_ONCE) as pool:
        loaded = list(pool.map(load, by_table.values()))
    result = BackfillResult([o for outcomes in loaded for o in outcomes])
    if any(o.outcome == BROKEN for o in result.outcomes):
        raise BackfillBroken(result)
    warehouse = Warehouse(spark, zones.warehouse, contracts, zones.warehouse_database)
    run_id = run_id or uuid.uuid4().hex
    states = book.states(list(contracts))
    result.reload = require_success(warehouse.reload(zone, run_id=run_id, strict_keys=strict_keys, states=states))
    return result
