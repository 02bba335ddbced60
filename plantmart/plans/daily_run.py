"""The daily run: route, replicate and ingest every extract, then reload the warehouse."""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from plantmart import session, storage
from plantmart.contracts import Contract
from plantmart.plans.ingest import Ingested, ingest_table
from plantmart.plans.ledger import Bookkeeping, Ledger
from plantmart.plans.vault import replicate
from plantmart.plans.warehouse import ReloadResult, Warehouse, require_success
from plantmart.sources.landing import (
    REJECTS_SCHEMA,
    Zones,
    discover,
    extracts,
    manifest,
    read_configs,
    rejects,
    route,
)
from plantmart.sources.raw import RawZone
from plantmart.sources.stores import arrow_uri

FILES_AT_ONCE = 10


REJECTED = "rejected"


@dataclass
class RunResult:
    rejected: DataFrame
    ingested: list[Ingested]
    reload: ReloadResult
    # Extracts (table, source) that the raw zone held already and that were not read again.
    carried: list[tuple[str, str]] = field(default_factory=list)

    def report(self) -> DataFrame:
        """The reload's report, and a row for each extract that was not accepted, with the reason."""
        loaded = self.reload.report(self.rejected.sparkSession)
        who = loaded.select("run_id", "status_code", "run_by", "run_database").limit(1)
        named = F.concat_ws("/", "source_system", "file_name")
        refused = self.rejected.select(
            F.lit(None).cast("string").alias("table_name"),
            F.lit(REJECTED).alias("status"),
            F.lit(None).cast("bigint").alias("row_count"),
            F.concat_ws(": ", named, "reason").alias("message"),
        )
        run = who.first()
        audit = {c: F.lit(run[c]).cast(loaded.schema[c].dataType) for c in who.columns}
        return loaded.unionByName(refused.withColumns(audit))


@dataclass
class Landing:
    files: DataFrame
    routed: DataFrame
    accepted: DataFrame
    entries: list[Row]


def survey_landing(spark: SparkSession, zones: Zones) -> Landing:
    """Discover and route. The manifest, one row per extract, is all that reaches the driver."""
    files = discover(spark, zones.landed)
    routed = route(extracts(files), read_configs(spark, zones.configs))
    accepted = manifest(routed, zones)
    return Landing(files, routed, accepted, accepted.collect())


def ingest_landing(
    zone: RawZone, landing: Landing, contracts: Mapping[str, Contract], loaded_at: datetime
) -> list[Ingested]:
    """Ingest table by table, several at once. The first failure is raised after all have ended."""
    by_table: dict[str, list[Row]] = defaultdict(list)
    for entry in landing.entries:
        by_table[entry.job.target_table].append(entry)
    with ThreadPoolExecutor(max_workers=FILES_AT_ONCE) as pool:
        jobs = [
            pool.submit(ingest_table, zone, table, entries, loaded_at, contracts.get(table))
            for table, entries in by_table.items()
        ]
    return [result for job in jobs for result in job.result()]


def daily_run(
    spark: SparkSession,
    zones: Zones,
    contracts: Mapping[str, Contract],
    table: str = "all",
    loaded_at: datetime | None = None,
    run_id: str | None = None,
    strict_keys: bool = False,
    carry_unchanged: bool = False,
    clustered: Mapping[str, str] | None = None,
) -> RunResult:
    """One run. A failing extract stops it before the reload, a failing reload fails the run.

    A landed zone in a store whose files cannot be replicated is refused before anything is read.

    With nothing landed the reload still republishes what was ingested before. What was not accepted
    is kept, with the reason, under the run's name.

    Every extract is read and every table rewritten, so all rows carry the time of this run. With
    ``carry_unchanged``, an extract whose files the ledger knows is not read, and a table whose extracts are
    all known keeps its published folder; their rows keep the time of the run that read them last.
    ``clustered`` names a column for tables that are to be written in ranges of it, see :class:`Warehouse`.
    """
    spark = session.configure(spark)
    for place in (zones.landed, zones.replicated):
        arrow_uri(storage.qualified(spark, place))
    loaded_at = loaded_at or datetime.now(timezone.utc)
    run_id = run_id or uuid.uuid4().hex
    zone = RawZone(spark, zones.processed, zones.database)
    zone.recover()
    landing = survey_landing(spark, zones)
    rejected = f"{zones.warehouse}/rejects/{run_id}"
    rejects(landing.routed).write.parquet(rejected)
    book = Bookkeeping(ledger_of(spark, zones), zone, landing.files, landing.entries)
    pending = [e for e in landing.entries if not (carry_unchanged and book.holds(e))]
    carried = [(e.job.target_table, e.job.source_system) for e in landing.entries if e not in pending]
    book.begin(pending)
    ingested: list[Ingested] = []
    if pending:
        total = sum(entry.delivery.bytes for entry in pending)
        accepted = landing.accepted
        if carried:
            paths = spark.createDataFrame([(e.job.source_path,) for e in pending], "wanted string")
            accepted = accepted.join(paths, F.col("job.source_path") == F.col("wanted"), "left_semi")
        with ThreadPoolExecutor(max_workers=1) as pool:
            copied = pool.submit(replicate, landing.files, accepted, zones.replicated, total)
            ingested = ingest_landing(zone, replace(landing, entries=pending), contracts, loaded_at)
            copied.result()
        # Recorded once they are copied too.
        for done in ingested:
            book.finish(done.table, done.source, done.rows, done.malformed, loaded_at)
    warehouse = Warehouse(spark, zones.warehouse, contracts, zones.warehouse_database, clustered)
    states = book.states(list(contracts))
    reloaded = warehouse.reload(zone, table, run_id, strict_keys, states=states, carry_unchanged=carry_unchanged)
    result = require_success(reloaded)
    return RunResult(spark.read.schema(REJECTS_SCHEMA).parquet(rejected), ingested, result, carried)


def ledger_of(spark: SparkSession, zones: Zones) -> Ledger:
    return Ledger(spark, f"{zones.warehouse}/ledger")


def write_configs(spark: SparkSession, folder: str, settings: Mapping[str, Mapping[str, str]]) -> None:
    """One JSON object per extract stem."""
    for stem, values in settings.items():
        storage.write_text(spark, f"{folder}/{stem}.json", json.dumps(values, indent=2))


def standard_settings(
    contracts: Mapping[str, Contract], encoding: str = "windows-1252"
) -> dict[str, dict[str, str]]:
    """Settings of a standard delivery: every table under its upper-case name, comma separated."""
    # The names of the settings, as sources/landing.py reads them.
    return {
        name.upper(): {
            "TargetTable": name,
            "HasHeader": "true",
            "Delimiter": ",",
            "Encoding": encoding,
        }
        for name in contracts
    }
