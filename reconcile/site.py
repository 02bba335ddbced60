"""A throw-away site: zones under the shared folder, and extracts delivered into its landed zone."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantmart import session
from plantmart.contracts import LOADED_AT, PLANTS, SOURCE, Contract
from plantmart.plans.daily_run import (
    Landing,
    RunResult,
    daily_run,
    ingest_landing,
    survey_landing,
    write_configs,
)
from plantmart.plans.ingest import Ingested
from plantmart.plans.warehouse import ReloadResult, Snapshot, Warehouse
from plantmart.sources.delimited import Layout
from plantmart.sources.landing import Zones
from plantmart.sources.raw import RawZone
from reconcile.tables import TEST_TABLES

# Every load of a reconciliation carries this moment; the oracles state the same one.
LOADED = datetime(2026, 7, 1, 6, 0, tzinfo=timezone.utc)
LOADED_SQL = "TIMESTAMP '2026-07-01 06:00:00'"

GZIP_COMMA = Layout()
# Rows of one part file, so that reading it back stays the work of one task however large the extract is.
PART_ROWS = 1_000_000
ENTRY = Mapping[str, str]


def plant(key: str) -> Column:
    """Even keys belong to DKQ, odd ones to FOS."""
    return F.when(F.col(key) % 2 == 0, PLANTS[0]).otherwise(PLANTS[1])


def plant_sql(key: str) -> str:
    return f"CASE WHEN {key} % 2 = 0 THEN 'DKQ' ELSE 'FOS' END"


class Site:
    def __init__(
        self, spark: SparkSession, sf_dir: str, contracts: Mapping[str, Contract] = TEST_TABLES
    ):
        self.spark = spark
        self.sf_dir = sf_dir
        self.contracts = contracts
        self.root = session.new_folder(spark, "site")
        self.zones = Zones.under(self.root, f"raw_{uuid.uuid4().hex}")
        self.settings: dict[str, dict[str, str]] = {}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def deliver(
        self,
        rows: DataFrame,
        source: str,
        table: str,
        layout: Layout = GZIP_COMMA,
        stem: str | None = None,
        suffix: str = "_prod_extract",
        extension: str = ".csv.gz",
        parts: int = 1,
    ) -> None:
        """Write an extract as its part files, ``parts`` or more, replacing the previous one.

        Rows move only where their scan has fewer partitions than that; a large table is written as it is
        scanned. Values are turned to text first: the CSV writer would cut timestamps to milliseconds. Gzip files are
        packed at the fastest level, as most of the time of a delivery went into packing.
        """
        stem = stem or table.upper()
        self.settings[stem] = {
            "TargetTable": table,
            "HasHeader": str(layout.has_header).lower(),
            "Delimiter": layout.delimiter,
            "Encoding": layout.encoding,
            "MultiLine": str(layout.multi_line).lower(),
        }
        if parts > 1 and rows.rdd.getNumPartitions() < parts:
            rows = rows.repartition(parts, F.monotonically_increasing_id())
        texts = rows.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in rows.columns])
        (
            texts.write.mode("overwrite")
            .option("header", layout.has_header)
            .option("sep", layout.delimiter)
            .option("encoding", layout.encoding)
            .option("quote", '"')
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .option("maxRecordsPerFile", PART_ROWS)
            .option("compression", "gzip" if extension.endswith(".gz") else "none")
            .option("zlib.compress.level", "BEST_SPEED")
            .csv(f"{self.zones.landed}/{source}/{stem}{suffix}{extension}")
        )

    def deliver_by_plant(self, rows: DataFrame, key: str, table: str, **options) -> None:
        self.deliver_each({s: rows.filter(plant(key) == s) for s in PLANTS}, table, **options)

    def deliver_each(self, rows: Mapping[str, DataFrame], table: str, **options) -> None:
        """One extract per plant, written side by side."""
        with ThreadPoolExecutor(max_workers=len(rows)) as pool:
            for job in [pool.submit(self.deliver, r, s, table, **options) for s, r in rows.items()]:
                job.result()

    def deliver_tables(self, *names: str) -> None:
        for name in names:
            contract = self.contracts[name]
            self.deliver_by_plant(self.table(name), contract.key[0], name)

    def zone(self) -> RawZone:
        return RawZone(self.spark, self.zones.processed, self.zones.database)

    def warehouse(self, database: str | None = None) -> Warehouse:
        return Warehouse(self.spark, self.zones.warehouse, self.contracts, database)

    def survey(self) -> Landing:
        write_configs(self.spark, self.zones.configs, self.settings)
        return survey_landing(self.spark, self.zones)

    def ingest(self) -> list[Ingested]:
        return ingest_landing(self.zone(), self.survey(), self.contracts, LOADED)

    def snapshot(self) -> Snapshot:
        return self.warehouse().snapshot()

    def reload(self, table: str | None = None, **options) -> ReloadResult:
        return self.warehouse().reload(self.zone(), table, **options)

    def run(self, **options) -> RunResult:
        write_configs(self.spark, self.zones.configs, self.settings)
        return daily_run(self.spark, self.zones, self.contracts, loaded_at=LOADED, **options)

    def loaded(self, table: str) -> DataFrame:
        """Ingest what was delivered, reload that table and read it back."""
        self.ingest()
        result = self.reload(table)
        if result.status != 200:
            raise RuntimeError(result.message)
        return self.warehouse().read(table)


def tagged(rows: DataFrame, key: str) -> DataFrame:
    """A table as the warehouse holds it: with its plant and load time."""
    return rows.withColumn(SOURCE, plant(key)).withColumn(
        LOADED_AT, F.lit(LOADED).cast("timestamp_ntz")
    )


def exact_sum(column: str) -> Column:
    """Sum of amounts with two decimals, without floating-point order effects."""
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double")


def exact_sum_sql(column: str) -> str:
    return f"CAST(SUM(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"
