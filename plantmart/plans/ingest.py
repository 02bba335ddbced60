"""Ingestion: delivered extracts to all-string Parquet with per-source replacement."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation, Row
from pyspark.sql import functions as F

from plantmart.contracts import LOADED_AT, SOURCE, Contract
from plantmart.operators.merge import merge_sources
from plantmart.sources.delimited import MALFORMED, Layout, scan_delimited
from plantmart.sources.raw import RawZone

# Raw text one write task should handle, and how much gzip text grows when unpacked.
TARGET_BYTES = 256 << 20
GZIP_GROWTH = 6


class NoRowCount(Exception):
    """The number of rows that were written is not known."""


@dataclass(frozen=True)
class Ingested:
    table: str
    source: str
    rows: int
    malformed: int


def layout_of(entry: Row) -> Layout:
    return Layout(
        has_header=entry.job.has_header.lower() == "true",
        delimiter=entry.job.delimiter,
        encoding=entry.job.encoding,
        multi_line=entry.delivery.multi_line.lower() == "true",
    )


def write_tasks(entry: Row, target_bytes: int = TARGET_BYTES) -> int | None:
    """Tasks to spread an extract over after its scan, None where the scan is parallel enough.

    Gzip and multi-line files are read by one task each. Plain files split by themselves, and part
    files are parallel already, so only a few large unsplittable files are worth a shuffle.
    """
    packed = entry.job.source_path.lower().endswith(".gz")
    if not (packed or layout_of(entry).multi_line):
        return None
    growth = GZIP_GROWTH if packed else 1
    wanted = math.ceil(entry.delivery.bytes * growth / target_bytes)
    oversized = entry.delivery.largest_part * growth > 2 * target_bytes
    return wanted if oversized and wanted > entry.delivery.parts else None


def scan_entry(
    zone: RawZone, entry: Row, loaded_at: datetime, contract: Contract | None, target_bytes: int
) -> DataFrame:
    names = contract.raw_names if contract else None
    raw = scan_delimited(
        zone.spark,
        entry.job.source_path,
        layout_of(entry),
        names,
        parts=entry.delivery.parts,
        keep_malformed=True,
    )
    tasks = write_tasks(entry, target_bytes)
    if tasks:
        # Ids given right after a file scan are the same on every retry, and they balance.
        raw = raw.repartition(tasks, F.monotonically_increasing_id())
    return raw.withColumn(SOURCE, F.lit(entry.job.source_system)).withColumn(
        LOADED_AT, F.lit(loaded_at)
    )


def _prove_empty(table: str, source: str, scan: DataFrame, rows: int | None) -> None:
    """An extract is empty if it has no row, not because nobody counted its rows."""
    if not scan.isEmpty():
        raise NoRowCount(f"{table}, {source}: {rows} rows counted, but the extract has rows")


def ingest_table(
    zone: RawZone,
    table: str,
    entries: Sequence[Row],
    loaded_at: datetime,
    contract: Contract | None = None,
    target_bytes: int = TARGET_BYTES,
) -> list[Ingested]:
    """Replace the partitions of the delivered sources of one table, and only those.

    Each extract is scanned on its own, because its header decides its columns. All sources go out
    in one write, which also counts rows and malformed records.
    """
    sources = [entry.job.source_system for entry in entries]
    scans = [scan_entry(zone, e, loaded_at, contract, target_bytes) for e in entries]
    merged = reduce(merge_sources, scans)
    counts = Observation()
    metrics = []
    for i, source in enumerate(sources):
        mine = F.col(SOURCE) == source
        metrics.append(F.count_if(mine).alias(f"rows_{i}"))
        metrics.append(F.count_if(mine & F.col(MALFORMED).isNotNull()).alias(f"malformed_{i}"))
    observed = merged.observe(counts, *metrics).drop(MALFORMED)
    (
        observed.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(SOURCE)
        .parquet(zone.path(table))
    )
    seen = counts.get
    results = []
    for i, (source, scan) in enumerate(zip(sources, scans)):
        rows = seen.get(f"rows_{i}")
        if not rows:
            _prove_empty(table, source, scan, rows)
            # A dynamic overwrite without rows leaves the old partition; replace its folder instead.
            scan.drop(MALFORMED, SOURCE).limit(0).write.mode("overwrite").parquet(zone.leaf(table, source))
        results.append(Ingested(table, source, rows or 0, seen.get(f"malformed_{i}") or 0))
    columns = [c for c in merged.columns if c not in (SOURCE, LOADED_AT, MALFORMED)]
    zone.register(table, columns, sources)
    return results
