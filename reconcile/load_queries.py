"""Ingestion, typed reload, replacement, publishing and the daily run."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantmart import storage
from plantmart.contracts import LOADED_AT, PLANTS, SOURCE
from plantmart.operators.merge import union_all
from plantmart.operators.quality import check_tables, rows_per_source
from plantmart.plans.backfill import BackfillBroken, backfill
from plantmart.plans.daily_run import daily_run, write_configs
from plantmart.plans.summaries import Summaries
from plantmart.plans.vault import file_digests, replicate, restore, vault_digests
from plantmart.plans.warehouse import LoadFailed, require_success
from plantmart.sources.delimited import Layout
from plantmart.sources.landing import discover
from reconcile.registry import query
from reconcile.reports import report_sql
from reconcile.site import LOADED, LOADED_SQL, Site, exact_sum, exact_sum_sql, plant, plant_sql
from reconcile.tables import TEST_TABLES, limited, renamed

_LINEITEM_COLUMNS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate"
)


def _audited(table: str, key: str, columns: str = "*") -> str:
    return f"SELECT {columns}, {plant_sql(key)} AS source, {LOADED_SQL} AS last_updated_at FROM {table}"


@query(_audited("orders", "o_orderkey"))
def typed_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    site = Site(spark, sf_dir)
    site.deliver_tables("orders")
    return site.loaded("orders")


@query(_audited("events", "event_id"))
def exact_values_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Microseconds, doubles and quoted JSON survive the way through text."""
    site = Site(spark, sf_dir)
    site.deliver_tables("events")
    return site.loaded("events")


def _text_round_trip(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    site = Site(spark, sf_dir)
    key = site.contracts[table].key[0]
    site.deliver_by_plant(site.table(table), key, table, layout=Layout(multi_line=True), parts=4)
    return site.loaded(table)


@query(_audited("pages", "page_id"))
def markup_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole web pages, full of quotes, delimiters and line breaks."""
    return _text_round_trip(spark, sf_dir, "pages")


@query(_audited("conversations", "conv_id"))
def conversation_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_round_trip(spark, sf_dir, "conversations")


@query(
    "SELECT CASE WHEN l_linenumber = 7 THEN NULL ELSE l_orderkey END AS l_orderkey, "
    + _LINEITEM_COLUMNS.removeprefix("l_orderkey, ")
    + f", {plant_sql('l_partkey')} AS source, {LOADED_SQL} AS last_updated_at FROM lineitem"
)
def padded_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys padded with spaces, and blanks where the line number is seven."""
    site = Site(spark, sf_dir)
    padded = F.concat(F.lit("  "), F.col("l_orderkey").cast("string"), F.lit(" "))
    rows = site.table("lineitem").withColumn(
        "l_orderkey", F.when(F.col("l_linenumber") == 7, F.lit("   ")).otherwise(padded)
    )
    site.deliver_by_plant(rows, "l_partkey", "lineitem", parts=4)
    return site.loaded("lineitem")


def _short_texts():
    documents = limited(TEST_TABLES["documents"], "text", 50)
    orders = limited(TEST_TABLES["orders"], "o_orderpriority", 1)
    return {**TEST_TABLES, "documents": documents, "orders": orders}


@query(
    f"SELECT doc_id AS id, left(text, 50) AS value, {plant_sql('doc_id')} AS source FROM documents "
    f"UNION ALL SELECT o_orderkey, left(o_orderpriority, 1), {plant_sql('o_orderkey')} FROM orders"
)
def declared_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text cut to fifty characters, a flag to one."""
    site = Site(spark, sf_dir, _short_texts())
    rows = site.table("documents").withColumnRenamed("source", "origin")
    site.deliver_by_plant(rows, "doc_id", "documents", layout=Layout(multi_line=True), parts=4)
    site.deliver_tables("orders")
    documents = site.loaded("documents")
    orders = site.loaded("orders")
    return documents.select(F.col("doc_id").alias("id"), F.col("text").alias("value"), SOURCE).unionAll(
        orders.select("o_orderkey", "o_orderpriority", SOURCE)
    )


@query(
    "SELECT 'documents' AS table_name, 'text' AS column_name, count(*)::BIGINT AS cut_values FROM documents"
    " WHERE length(text) > 50 UNION ALL SELECT 'orders', 'o_orderpriority', count(*)::BIGINT FROM orders"
    " WHERE length(o_orderpriority) > 1"
)
def cut_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many values the reload had to cut, counted while it wrote."""
    site = Site(spark, sf_dir, _short_texts())
    rows = site.table("documents").withColumnRenamed("source", "origin")
    site.deliver_by_plant(rows, "doc_id", "documents", layout=Layout(multi_line=True), parts=4)
    site.deliver_tables("orders")
    site.ingest()
    cut = site.reload().cut_values
    found = [(t, c, n) for t, columns in cut.items() for c, n in columns.items()]
    return spark.createDataFrame(found, "table_name string, column_name string, cut_values bigint")


@query(
    "SELECT s_suppkey AS identity, s_name, s_nationkey, s_acctbal, "
    f"{plant_sql('s_suppkey')} AS source, {LOADED_SQL} AS last_updated_at FROM supplier"
)
def renamed_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extract names the key ENTRY_CODE, the warehouse calls it identity."""
    contract = renamed(TEST_TABLES["supplier"], "identity", "entry_code")
    site = Site(spark, sf_dir, {"supplier": contract})
    rows = site.table("supplier").withColumnRenamed("s_suppkey", "ENTRY_CODE")
    site.deliver_by_plant(rows, "ENTRY_CODE", "supplier")
    return site.loaded("supplier")


def _drifted_parts(site: Site) -> None:
    """DKQ delivers all columns, FOS other ones in another order and without the size."""
    parts = site.table("part")
    by_plant = {s: parts.filter(plant("p_partkey") == s) for s in ("DKQ", "FOS")}
    site.deliver(by_plant["DKQ"], "DKQ", "part")
    fos = by_plant["FOS"].select(
        "p_retailprice", F.col("p_name").alias("P_NAME"), "p_type", "p_partkey", "p_brand",
        F.upper("p_type").alias("p_extra"),
    )
    site.deliver(fos, "FOS", "part")


_MERGED_SQL = (
    "SELECT p_partkey, p_name, p_brand, p_type, CASE WHEN p_partkey % 2 = 0 THEN p_size END AS p_size, "
    f"p_retailprice, {plant_sql('p_partkey')} AS source, {LOADED_SQL} AS last_updated_at FROM part"
)


@query(_MERGED_SQL)
def merged_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    site = Site(spark, sf_dir)
    _drifted_parts(site)
    return site.loaded("part")


@query(f"SELECT source, p_brand, count(*)::BIGINT AS row_count, count(p_size)::BIGINT AS sizes FROM ({_MERGED_SQL}) GROUP BY 1, 2")
def merged_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The warehouse database over both plants, read with SQL by qualified names."""
    site = Site(spark, sf_dir)
    _drifted_parts(site)
    site.ingest()
    warehouse = site.warehouse(site.zones.warehouse_database)
    require_success(warehouse.reload(site.zone(), "part"))
    return spark.sql(
        f"SELECT source, p_brand, count(*) AS row_count, count(p_size) AS sizes FROM {warehouse.qualified('part')} GROUP BY ALL"
    )


@query(
    "SELECT * FROM (" + _audited("orders", "o_orderkey") + ") WHERE source = 'FOS' OR o_orderkey % 4 = 0"
)
def source_replacement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DKQ alone, then FOS, then DKQ again with fewer rows: only DKQ changes."""
    site = Site(spark, sf_dir)
    orders = site.table("orders")
    dkq = orders.filter(plant("o_orderkey") == "DKQ")
    site.deliver(dkq, "DKQ", "orders")
    site.ingest()
    site.deliver(orders.filter(plant("o_orderkey") == "FOS"), "FOS", "orders")
    site.ingest()
    site.deliver(dkq.filter(F.col("o_orderkey") % 4 == 0), "DKQ", "orders")
    return site.loaded("orders")


@query("SELECT * FROM (" + _audited("orders", "o_orderkey") + ") WHERE source = 'FOS'")
def emptied_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extract with a header and no rows empties its source."""
    site = Site(spark, sf_dir)
    site.deliver_tables("orders")
    site.ingest()
    site.deliver(site.table("orders").filter("false"), "DKQ", "orders")
    return site.loaded("orders")


@query(
    f"SELECT 'orders' AS table_name, {plant_sql('o_orderkey')} AS source, count(*)::BIGINT AS row_count, "
    "NULL::VARCHAR AS problem FROM orders GROUP BY 2 UNION ALL "
    "SELECT 'customer', CASE WHEN c_custkey % 2 = 0 THEN 'DKQ' ELSE 'OLD' END, count(*)::BIGINT, "
    "CASE WHEN c_custkey % 2 = 1 THEN 'unexpected' END FROM customer GROUP BY ALL "
    "UNION ALL SELECT 'customer', 'FOS', 0, 'missing'"
)
def partition_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by the partition folder their file lies in, and what is wrong with the folders."""
    site = Site(spark, sf_dir)
    site.deliver_tables("orders")
    for source, odd in (("DKQ", 0), ("OLD", 1)):
        site.deliver(site.table("customer").filter(F.col("c_custkey") % 2 == odd), source, "customer")
    site.ingest()
    counted, problems = [], []
    for table in ("orders", "customer"):
        folder = F.regexp_extract("_metadata.file_path", "/source=([^/]*)/[^/]*$", 1)
        one = (
            site.zone().read(table)
            .groupBy(folder.alias(SOURCE))
            .agg(F.count("*").alias("row_count"))
            .select(F.lit(table).alias("table_name"), SOURCE, "row_count")
        )
        counted.append(one)
        problems += [(table, s, p) for s, p in site.zone().layout_differences(table, PLANTS)]
    found = spark.createDataFrame(problems, "table_name string, source string, problem string")
    joined = union_all(counted).join(F.broadcast(found), ["table_name", SOURCE], "full")
    return joined.withColumn("row_count", F.coalesce("row_count", F.lit(0).cast("bigint")))


@query("SELECT *, 500 AS second_status FROM (" + _audited("orders", "o_orderkey") + ")")
def failed_reload_keeps_previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One malformed number in the second run; orders, changed too, must stay as published."""
    site = Site(spark, sf_dir)
    site.deliver_tables("orders")
    site.loaded("orders")
    site.deliver(site.table("orders").filter("o_orderkey % 4 = 1"), "DKQ", "orders")
    rows = site.table("customer")
    last = rows.agg(F.max("c_custkey")).first()[0]
    broken = F.when(F.col("c_custkey") == last, F.lit("12x")).otherwise(F.col("c_custkey").cast("string"))
    site.deliver(rows.withColumn("c_custkey", broken), "FOS", "customer")
    site.ingest()
    status = site.reload().status
    return site.warehouse().read("orders").withColumn("second_status", F.lit(status))


@query(
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {plant_sql(k)} AS source, count(*)::BIGINT AS row_count, "
        f"true AS vault_equal, true AS restored_equal, 64 AS digest_digits FROM {t} GROUP BY 2"
        for t, k in (("customer", "c_custkey"), ("part", "p_partkey"))
    )
)
def replica_vault(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records counted in the restored files, after replicating twice.

    Each landed file, its copy in the vault and the restored file have the same root digest.
    """
    site = Site(spark, sf_dir)
    for table in ("customer", "part"):
        key = site.contracts[table].key[0]
        site.deliver_by_plant(site.table(table), key, table, extension=".csv")
    landing = site.survey()
    total = sum(e.delivery.bytes for e in landing.entries)
    chunk = 10_000
    for _ in range(2):
        replicate(landing.files, landing.accepted, site.zones.replicated, total, chunk_bytes=chunk)
    restored = f"{site.root}/restored"
    restore(spark, site.zones.replicated, restored)

    def digests(files: DataFrame, root: str, name: str) -> DataFrame:
        """Root digests by source, file and part, which are the folders below the root."""
        below = F.split(F.regexp_extract("path", f"/{root}/(.+)$", 1), "/")
        parts = [below[i].alias(c) for i, c in enumerate(("source", "file", "part"))]
        return file_digests(files, chunk).select(*parts, "bytes", F.col("digest").alias(name))

    key = ["source", "file", "part"]
    files = digests(landing.files, "landed", "landed").join(
        vault_digests(spark.read.parquet(site.zones.replicated), chunk).select(*key, F.col("digest").alias("vault")), key, "full"
    ).join(digests(discover(spark, restored), "restored", "restored").drop("bytes"), key, "full")
    compared = files.groupBy("source", "file").agg(
        F.bool_and(F.col("vault").eqNullSafe(F.col("landed"))).alias("vault_equal"),
        F.bool_and(F.col("restored").eqNullSafe(F.col("landed"))).alias("restored_equal"),
        F.max(F.length("landed")).alias("digest_digits"),
        # Every part file has a header line.
        F.count_if(F.col("bytes") > 0).alias("heads"),
    )
    lines = spark.read.option("recursiveFileLookup", True).text(restored).groupBy(
        F.regexp_extract("_metadata.file_path", "/restored/([^/]+)/([^/]+)", 1).alias("source"),
        F.regexp_extract("_metadata.file_path", "/restored/([^/]+)/([^/]+)", 2).alias("file"),
    ).agg(F.count("*").alias("lines"))
    return lines.join(compared, ["source", "file"]).select(
        F.lower(F.regexp_extract("file", "^([A-Z]+)_", 1)).alias("table_name"), "source",
        (F.col("lines") - F.col("heads")).alias("row_count"), "vault_equal", "restored_equal", "digest_digits",
    )


_REPORT_TABLES = ("region", "customer", "orders", "lineitem")


@query(
    "SELECT *, 200 AS status_code, true AS has_run_by, 'default' AS run_database FROM ("
    "SELECT 'customer' AS table_name, 'loaded' AS status, count(*)::BIGINT AS row_count FROM customer"
    " UNION ALL SELECT 'orders', 'loaded', count(*)::BIGINT FROM orders"
    " UNION ALL SELECT 'region', 'skipped', NULL UNION ALL SELECT 'lineitem', 'skipped', NULL)"
)
def reload_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four tables wanted, two delivered."""
    site = Site(spark, sf_dir, {t: TEST_TABLES[t] for t in _REPORT_TABLES})
    site.deliver_tables("customer", "orders")
    site.ingest()
    report = site.reload().report(spark)
    named = F.length("run_by") > 0
    return report.select("table_name", "status", "row_count", "status_code", named.alias("has_run_by"), "run_database")


def _table_counts(site: Site) -> DataFrame:
    counted = []
    for name, rows in site.snapshot().tables().items():
        one = rows.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        counted.append(one)
    return union_all(counted)


@query(
    "SELECT 'customer' AS table_name, count(*)::BIGINT AS row_count FROM customer WHERE c_custkey % 2 = 1"
    " UNION ALL SELECT 'orders', count(*)::BIGINT FROM orders"
)
def single_table_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both extracts change, one table is reloaded, the other keeps its published rows."""
    site = Site(spark, sf_dir)
    site.deliver_tables("customer", "orders")
    site.ingest()
    site.reload()
    site.deliver(site.table("customer").filter("false"), "DKQ", "customer")
    site.deliver(site.table("orders").filter("false"), "DKQ", "orders")
    site.ingest()
    site.reload("customer")
    return _table_counts(site)


@query(
    "SELECT 'customer' AS table_name, count(*)::BIGINT AS row_count FROM customer"
    " UNION ALL SELECT 'orders', count(*)::BIGINT FROM orders"
)
def empty_landing_republish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that finds nothing landed still republishes what was ingested before."""
    from dataclasses import replace

    site = Site(spark, sf_dir)
    site.deliver_tables("customer", "orders")
    site.ingest()
    site.zones = replace(site.zones, landed=site.zones.landed + "-nothing")
    site.run()
    return _table_counts(site)


@query(
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {plant_sql(k)} AS source, count(*)::BIGINT AS row_count, "
        f"0::BIGINT AS unknown_source_rows FROM {t} GROUP BY 2"
        for t, k in (("customer", "c_custkey"), ("orders", "o_orderkey"))
    )
    + " UNION ALL SELECT 'part', CASE WHEN p_partkey % 2 = 0 THEN 'DKQ' ELSE 'OLD' END, count(*)::BIGINT, "
    "sum(p_partkey % 2)::BIGINT FROM part GROUP BY 2"
)
def source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table and plant after a run; one folder is no known plant."""
    site = Site(spark, sf_dir)
    site.deliver_tables("customer", "orders")
    parts = site.table("part")
    site.deliver(parts.filter("p_partkey % 2 = 0"), "DKQ", "part")
    site.deliver(parts.filter("p_partkey % 2 = 1"), "OLD", "part")
    site.run()
    counted = []
    for name, rows in site.snapshot().tables().items():
        one = rows_per_source(rows, name)
        counted.append(one)
    return union_all(counted)


_TOTALS = {
    "orders": ("o_orderkey", "o_totalprice"),
    "customer": ("c_custkey", "c_acctbal"),
    "lineitem": ("l_orderkey", "l_extendedprice"),
}


@query(
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {plant_sql(k)} AS source, count(*)::BIGINT AS row_count, "
        f"{exact_sum_sql(v)} AS amount, {LOADED_SQL} AS loaded_at, 'loaded' AS status FROM {t} GROUP BY 2"
        for t, (k, v) in _TOTALS.items()
    )
)
def daily_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole daily run on three tables, then totals per table and plant next to its report."""
    site = Site(spark, sf_dir)
    for table, (key, _) in _TOTALS.items():
        site.deliver_by_plant(site.table(table), key, table, parts=4)
    report = site.run().reload.report(spark)
    totals = []
    for table, (_, amount) in _TOTALS.items():
        one = (
            site.warehouse().read(table)
            .groupBy(SOURCE)
            .agg(
                F.count("*").alias("row_count"),
                exact_sum(amount).alias("amount"),
                F.max(LOADED_AT).alias("loaded_at"),
            )
            .select(F.lit(table).alias("table_name"), SOURCE, "row_count", "amount", "loaded_at")
        )
        totals.append(one)
    return union_all(totals).join(report.select("table_name", "status"), "table_name")


@query(
    "SELECT 'loaded' AS status, count(*)::BIGINT AS row_count, NULL::VARCHAR AS message FROM customer"
    " UNION ALL SELECT 'skipped', NULL, 'not delivered'"
    " UNION ALL SELECT 'rejected', NULL, 'DKQ/' || f || ': several extracts for one table and source' FROM "
    "(VALUES ('ORDERS_prod_extract.csv.gz'), ('ORDERS_qa_extract.csv.gz')) v(f)"
    " UNION ALL SELECT 'rejected', NULL, 'FOS/STRANGE_prod_extract.csv.gz: no configuration'"
)
def rejected_in_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two extracts of one table and source, and one without settings, are named in the run's report."""
    site = Site(spark, sf_dir, {t: TEST_TABLES[t] for t in ("customer", "orders")})
    site.deliver_tables("customer")
    orders = site.table("orders")
    for suffix in ("_prod_extract", "_qa_extract"):
        site.deliver(orders, "DKQ", "orders", suffix=suffix)
    site.deliver(orders, "FOS", "orders", stem="STRANGE")
    del site.settings["STRANGE"]
    return site.run().report().select("status", "row_count", "message")


@query(
    "SELECT source, count(*)::BIGINT AS row_count, "
    "(SELECT count(*)::BIGINT FROM customer WHERE c_custkey % 2 = 0) AS cut_sources FROM (SELECT "
    "CASE WHEN c_custkey % 2 = 0 THEN 'DKQ_LABORA' ELSE 'FOS' END AS source FROM customer) GROUP BY 1"
)
def long_source_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source name beyond ten characters is cut, and the rows concerned are counted."""
    site = Site(spark, sf_dir)
    customers = site.table("customer")
    site.deliver(customers.filter("c_custkey % 2 = 0"), "DKQ_LABORATORY", "customer")
    site.deliver(customers.filter("c_custkey % 2 = 1"), "FOS", "customer")
    site.ingest()
    cut = site.reload("customer").cut_values["customer"][SOURCE]
    counted = site.warehouse().read("customer").groupBy(SOURCE).agg(F.count("*").alias("row_count"))
    return counted.withColumn("cut_sources", F.lit(cut).cast("bigint"))


@query(
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, NULL::VARCHAR AS source, "
    "NULL::TIMESTAMP AS last_updated_at FROM customer"
)
def adopted_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table from before the audit columns joins the warehouse; nobody knows its sources."""
    site = Site(spark, sf_dir)
    site.warehouse().adopt("customer", site.table("customer"))
    return site.warehouse().read("customer")


@query(
    "SELECT 'customer' AS table_name, count(*)::BIGINT AS row_count, true AS stopped FROM customer"
    " UNION ALL SELECT 'part', count(*)::BIGINT, true FROM part"
)
def failed_extract_keeps_previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extract that cannot be read stops the run before the reload, though another one changed."""
    site = Site(spark, sf_dir)
    site.deliver_tables("customer", "part")
    site.run()
    site.deliver(site.table("customer").filter("false"), "DKQ", "customer")
    site.deliver(site.table("part"), "FOS", "part", parts=2)
    extract = f"{site.zones.landed}/FOS/PART_prod_extract.csv.gz"
    storage.write_text(spark, f"{extract}/part-broken.csv.gz", "this is no gzip")
    stopped = False
    try:
        site.run()
    except Exception:  # whatever the scan says
        stopped = True
    return _table_counts(site).withColumn("stopped", F.lit(stopped))


@query(
    "SELECT o.*, g.gate FROM (" + _audited("orders", "o_orderkey") + ") o, (SELECT 'status 500' AS gate) g"
)
def closed_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run whose reload fails ends in an error, and the published rows are those of the run before."""
    site = Site(spark, sf_dir)
    site.deliver_tables("orders")
    site.run()
    broken = F.when(F.col("o_orderkey") % 2 == 0, "12x").otherwise(F.col("o_orderkey").cast("string"))
    site.deliver(site.table("orders").withColumn("o_custkey", broken), "DKQ", "orders")
    gate = "open"
    try:
        site.run()
    except LoadFailed as error:
        gate = str(error)[:10]
    return site.warehouse().read("orders").withColumn("gate", F.lit(gate))


@query(
    report_sql(
        [TEST_TABLES["lineitem"]],
        [
            "SELECT 'lineitem' AS table_name, 'reference' AS rule, 'l_orderkey -> orders' AS column_name, "
            "CASE WHEN l_partkey % 2 = 0 THEN 'DKQ' ELSE 'FOS' END AS source, count(*) AS violations "
            "FROM lineitem WHERE l_linenumber <> 7 GROUP BY 4",
            "SELECT 'lineitem', 'unique key', 'l_orderkey, l_linenumber', source, sum(n - 1) FROM ("
            "SELECT CASE WHEN l_linenumber <> 7 THEN l_orderkey END AS k, l_linenumber, "
            "CASE WHEN l_partkey % 2 = 0 THEN 'DKQ' ELSE 'FOS' END AS source, count(*) AS n "
            "FROM lineitem GROUP BY ALL) GROUP BY source",
        ],
    )
)
def undelivered_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders were never delivered, so every line with an order number refers to nothing."""
    site = Site(spark, sf_dir, {t: TEST_TABLES[t] for t in ("orders", "lineitem")})
    rows = site.table("lineitem").withColumn(
        "l_orderkey", F.when(F.col("l_linenumber") != 7, F.col("l_orderkey"))
    )
    site.deliver_by_plant(rows, "l_partkey", "lineitem", parts=2)
    site.ingest()
    require_success(site.reload())
    tables = site.snapshot()
    return check_tables(tables.tables(), site.contracts, size_of=tables.lookup_bytes)


@query(
    "SELECT *, 200 AS first_status, 1 AS first_warnings, 1 AS first_behind, 0 AS later_behind FROM ("
    + _audited("orders", "o_orderkey")
    + ") WHERE source = 'FOS' OR o_orderkey % 4 = 0"
)
def unregistered_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Somebody's view takes the name of a table: its rows are published, and the next run registers them.

    The second run reloads another table; the first one's rows are then read with SQL.
    """
    site = Site(spark, sf_dir)
    site.deliver_tables("orders", "region")
    site.loaded("orders")
    site.deliver(site.table("orders").filter("o_orderkey % 4 = 0"), "DKQ", "orders")
    site.ingest()
    warehouse = site.warehouse(site.zones.warehouse_database)
    spark.sql(f"CREATE DATABASE {site.zones.warehouse_database} LOCATION '{site.zones.warehouse}'")
    spark.sql(f"CREATE VIEW {warehouse.qualified('orders')} AS SELECT 1 AS one")
    first = warehouse.reload(site.zone(), "orders")
    behind = len(warehouse.behind())
    spark.sql(f"DROP VIEW {warehouse.qualified('orders')}")
    require_success(warehouse.reload(site.zone(), "region"))
    later = len(warehouse.behind())
    said = {"first_status": first.status, "first_warnings": len(first.warnings), "first_behind": behind, "later_behind": later}
    return spark.table(warehouse.qualified("orders")).withColumns({c: F.lit(n) for c, n in said.items()})


@query(
    "SELECT 'first' AS seen, source, count(*)::BIGINT AS row_count FROM (" + _audited("customer", "c_custkey") + ") GROUP BY 2 "
    "UNION ALL SELECT 'second', source, count(*)::BIGINT FROM (" + _audited("customer", "c_custkey")
    + ") WHERE source = 'DKQ' OR c_custkey % 3 = 0 GROUP BY 2"
)
def moved_external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The external table after each of two loads; it changes its location and is never dropped."""
    site = Site(spark, sf_dir)
    site.deliver_tables("customer")
    site.ingest()
    warehouse = site.warehouse(site.zones.warehouse_database)
    seen = []
    for name in ("first", "second"):
        require_success(warehouse.reload(site.zone(), "customer"))
        # Read through the location of this moment: the next load moves the table.
        rows = spark.read.schema(site.contracts["customer"].schema).parquet(warehouse.registered()["customer"])
        assert rows.count() == spark.table(warehouse.qualified("customer")).count()
        seen.append(rows.groupBy(SOURCE).agg(F.count("*").alias("row_count")).withColumn("seen", F.lit(name)))
        site.deliver(site.table("customer").filter("c_custkey % 2 = 1 AND c_custkey % 3 = 0"), "FOS", "customer")
        site.ingest()
    return union_all(seen)


_HISTORY = {"customer": "c_custkey", "orders": "o_orderkey", "part": "p_partkey"}


@query(
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {plant_sql(k)} AS source, count(*)::BIGINT AS row_count, "
        f"CASE WHEN '{t}' = 'part' AND {plant_sql(k)} = 'FOS' THEN 'broken' ELSE 'ingested' END AS first_run, "
        f"CASE WHEN '{t}' = 'part' AND {plant_sql(k)} = 'FOS' THEN 'ingested' ELSE 'carried' END AS second_run, "
        f"true AS nothing_before FROM {t} GROUP BY ALL"
        for t, k in _HISTORY.items()
    )
)
def resumed_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full historical load breaks at one extract of six; the next run reads that one only, then reloads.

    Before it, the warehouse has no rows at all. Carried extracts keep their time of load.
    """
    site = Site(spark, sf_dir)
    for table, key in _HISTORY.items():
        site.deliver_by_plant(site.table(table), key, table, parts=2)
    extract = f"{site.zones.landed}/FOS/PART_prod_extract.csv.gz/part-broken.csv.gz"
    storage.write_text(spark, extract, "this is no gzip")
    write_configs(spark, site.zones.configs, site.settings)
    try:
        backfill(spark, site.zones, site.contracts, loaded_at=LOADED)
        raise AssertionError("a broken extract was loaded")
    except BackfillBroken as broken:
        first = broken.result
    nothing = not site.warehouse().published()
    storage.delete(spark, extract)
    second = backfill(spark, site.zones, site.contracts, loaded_at=LOADED)
    runs = [
        run.report(spark).select("table_name", SOURCE, F.col("outcome").alias(name))
        for run, name in ((first, "first_run"), (second, "second_run"))
    ]
    tables = site.snapshot().tables()
    counted = union_all([rows_per_source(rows, name).drop("unknown_source_rows") for name, rows in tables.items()])
    joined = counted.join(runs[0], ["table_name", SOURCE]).join(runs[1], ["table_name", SOURCE])
    return joined.withColumn("nothing_before", F.lit(nothing))


_LATER_SQL = "TIMESTAMP '2026-07-02 06:00:00'"


@query(
    "SELECT 'customer' AS table_name, 'carried' AS status, source, count(*)::BIGINT AS row_count, last_updated_at AS loaded_at "
    f"FROM ({_audited('customer', 'c_custkey')}) GROUP BY ALL UNION ALL "
    "SELECT 'orders', 'loaded', source, count(*)::BIGINT, CASE WHEN source = 'FOS' THEN "
    f"{_LATER_SQL} ELSE last_updated_at END FROM ({_audited('orders', 'o_orderkey')}) "
    "WHERE source = 'DKQ' OR o_orderkey % 3 = 0 GROUP BY ALL"
)
def unchanged_extracts_carried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One extract of four changes: the others are not read again, and customer keeps its published folder."""
    site = Site(spark, sf_dir)
    site.deliver_tables("customer", "orders")
    site.run(carry_unchanged=True)
    site.deliver(site.table("orders").filter("o_orderkey % 2 = 1 AND o_orderkey % 3 = 0"), "FOS", "orders")
    later = LOADED + timedelta(days=1)
    run = daily_run(spark, site.zones, site.contracts, loaded_at=later, carry_unchanged=True)
    statuses = run.report().where("table_name IS NOT NULL").select("table_name", "status")
    counted = [
        rows.groupBy(SOURCE, F.col(LOADED_AT).alias("loaded_at")).agg(F.count("*").alias("row_count"))
        .withColumn("table_name", F.lit(name))
        for name, rows in site.snapshot().tables().items()
    ]
    return union_all(counted).join(statuses.where("status IN ('carried', 'loaded')"), "table_name")


_KEPT_ORDERS_SQL = "o_orderkey % 2 = 0 OR o_orderkey % 3 = 0"


@query(
    "SELECT t.*, t.source = 'FOS' AS recounted FROM ("
    + report_sql(
        [TEST_TABLES["orders"], TEST_TABLES["lineitem"]],
        [
            f"SELECT 'orders' AS table_name, 'allowed values' AS rule, 'o_orderstatus' AS column_name, "
            f"{plant_sql('o_orderkey')} AS source, count(*) AS violations FROM orders "
            f"WHERE o_orderstatus <> 'F' AND ({_KEPT_ORDERS_SQL}) GROUP BY 4",
            f"SELECT 'lineitem', 'reference', 'l_orderkey -> orders', {plant_sql('l_orderkey')}, count(*) FROM lineitem "
            f"ANTI JOIN (SELECT o_orderkey FROM orders WHERE {_KEPT_ORDERS_SQL}) ON l_orderkey = o_orderkey "
            "WHERE l_orderkey IS NOT NULL GROUP BY 4",
            f"SELECT 'lineitem', 'unique key', 'l_orderkey, l_linenumber', {plant_sql('l_orderkey')}, sum(n - 1) "
            "FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY 4",
        ],
    )
    + ") t"
)
def report_from_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source of a parent changes: it and the same source of its children are counted again, and nothing else."""
    site = Site(spark, sf_dir)
    site.deliver_tables("orders", "lineitem")
    site.run(carry_unchanged=True)
    kept = Summaries(spark, f"{site.zones.warehouse}/summaries", site.contracts)
    kept.update(site.snapshot())
    site.deliver(site.table("orders").filter("o_orderkey % 2 = 1 AND o_orderkey % 3 = 0"), "FOS", "orders")
    site.run(carry_unchanged=True)
    again = [(t, s) for t, sources in kept.update(site.snapshot()).items() for s in sources]
    counted = spark.createDataFrame(again, "table_name string, source string").withColumn("counted", F.lit(True))
    report = kept.report(site.snapshot()).join(counted, ["table_name", SOURCE], "left")
    return report.select(
        "table_name", "rule", "column_name", SOURCE, "violations", F.coalesce("counted", F.lit(False)).alias("recounted")
    )
