"""Contract checks on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantmart.contracts import SOURCE, refers
from plantmart.operators.filters import monthly_rows
from plantmart.operators.joins import orphan_keys, referenced_keys
from plantmart.operators.quality import (
    check_keys,
    check_raw,
    check_reference,
    check_rows,
    duplicate_keys,
    rows_per_source,
    schema_differences,
    undeclared_columns,
)
from reconcile.registry import query
from reconcile.site import Site, plant_sql, tagged
from reconcile.tables import TEST_TABLES, required


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@query(
    f"SELECT l_orderkey, l_linenumber, {plant_sql('l_orderkey')} AS source, count(*)::BIGINT AS copies "
    "FROM lineitem GROUP BY ALL HAVING count(*) > 1"
)
def repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tagged(_read(spark, sf_dir, "lineitem"), "l_orderkey")
    return duplicate_keys(rows, TEST_TABLES["lineitem"].key)


@query(
    "SELECT 'lineitem' AS table_name, 'unique key' AS rule, 'l_orderkey, l_linenumber' AS column_name, source, "
    "sum(n - 1)::BIGINT AS violations FROM (SELECT l_orderkey, l_linenumber, "
    "CASE WHEN l_partkey % 2 = 0 THEN 'DKQ' ELSE 'FOS' END AS source, count(*) AS n FROM lineitem "
    "GROUP BY ALL HAVING count(*) > 1) GROUP BY source"
)
def key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surplus rows per plant, where one business key may occur in both plants."""
    return check_keys(tagged(_read(spark, sf_dir, "lineitem"), "l_partkey"), TEST_TABLES["lineitem"])


@query("SELECT doc_id, count(*)::BIGINT AS child_rows FROM documents ANTI JOIN labels USING (doc_id) GROUP BY 1")
def unlabelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    return orphan_keys(documents, labels, [("doc_id", "doc_id")])


@query(
    "SELECT 'lineitem' AS table_name, 'reference' AS rule, 'l_orderkey -> orders' AS column_name, l.source, "
    "count(*)::BIGINT AS violations FROM (SELECT l_orderkey, "
    "CASE WHEN l_partkey % 2 = 0 THEN 'DKQ' ELSE 'FOS' END AS source FROM lineitem WHERE l_linenumber <> 7) l "
    "ANTI JOIN (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'DKQ' ELSE 'FOS' END AS source FROM orders) o "
    "ON l.l_orderkey = o.o_orderkey AND l.source = o.source GROUP BY l.source"
)
def cross_plant_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order of the other plant is no parent; rows with a NULL key are no orphans."""
    rows = _read(spark, sf_dir, "lineitem")
    rows = rows.withColumn("l_orderkey", F.when(F.col("l_linenumber") != 7, F.col("l_orderkey")))
    child = tagged(rows, "l_partkey")
    parent = tagged(_read(spark, sf_dir, "orders"), "o_orderkey")
    return check_reference(child, parent, "lineitem", TEST_TABLES["lineitem"].references[0])


@query(
    "SELECT o_orderkey, count(*)::BIGINT AS child_rows FROM orders "
    "SEMI JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1"
)
def partial_key_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reference to one column of a two-column key matches once, however many lines exist."""
    orders, lines = _read(spark, sf_dir, "orders"), _read(spark, sf_dir, "lineitem")
    return referenced_keys(orders, lines, [("o_orderkey", "l_orderkey")])


_CHECKED_SQL = (
    "SELECT CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END AS o_custkey, "
    "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus, "
    "CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN 'OLD' "
    "WHEN o_orderkey % 2 = 0 THEN 'DKQ' ELSE 'FOS' END AS source FROM orders"
)


def _violations_sql(rule: str, column: str, condition: str) -> str:
    return (
        f"SELECT 'orders' AS table_name, '{rule}' AS rule, '{column}' AS column_name, source, "
        f"(count(*) FILTER (WHERE {condition}))::BIGINT AS violations FROM checked GROUP BY source"
    )


@query(
    f"WITH checked AS ({_CHECKED_SQL}) "
    + " UNION ALL ".join(
        [
            _violations_sql("not null", c, f"{c} IS NULL" if c in ("o_custkey", "o_orderstatus") else "false")
            for c in TEST_TABLES["orders"].required
        ]
        + [
            _violations_sql("allowed values", "o_orderstatus", "o_orderstatus <> 'F'"),
            _violations_sql("known source", "source", "source IS NULL OR source NOT IN ('DKQ', 'FOS')"),
        ]
    )
)
def row_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULLs, a value check and unknown sources of one table, counted in one pass."""
    key = F.col("o_orderkey")
    rows = (
        tagged(_read(spark, sf_dir, "orders"), "o_orderkey")
        .withColumn("o_custkey", F.when(key % 3 != 0, F.col("o_custkey")))
        .withColumn("o_orderstatus", F.when(key % 5 != 0, F.col("o_orderstatus")))
        .withColumn(
            SOURCE, F.when(key % 7 == 0, None).when(key % 11 == 0, "OLD").otherwise(F.col(SOURCE))
        )
    )
    return check_rows(rows, TEST_TABLES["orders"])


@query(
    " UNION ALL ".join(
        f"SELECT 'orders' AS table_name, '{rule}' AS rule, '{column}' AS column_name, {plant_sql('o_orderkey')} AS source, "
        f"(count(*) FILTER (WHERE {broken}))::BIGINT AS violations FROM orders GROUP BY 4"
        for rule, column, broken in (
            ("length", "o_orderstatus", "false"),
            ("length", "o_orderpriority", "o_orderkey % 13 = 0"),
            ("malformed", "o_orderkey", "false"),
            ("malformed", "o_custkey", "o_orderkey % 10 IN (3, 4)"),
            ("malformed", "o_totalprice", "false"),
            ("malformed", "o_orderdate", "false"),
        )
    )
)
def raw_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text the casts would cut or fail on; blanks and padding are neither."""
    site = Site(spark, sf_dir)
    key = F.col("o_orderkey")
    number = F.col("o_custkey").cast("string")
    rows = (
        site.table("orders")
        .withColumn(
            "o_custkey",
            F.when(key % 10 == 3, F.concat(number, F.lit("x")))
            .when(key % 10 == 4, F.lit("1.5"))
            .when(key % 10 == 5, F.lit("  "))
            .otherwise(F.concat(F.lit(" "), number)),
        )
        .withColumn("o_orderpriority", F.when(key % 13 == 0, F.repeat(F.lit("é"), F.lit(51))).otherwise(F.repeat(F.lit("é"), F.lit(50))))
    )
    site.deliver_by_plant(rows, "o_orderkey", "orders")
    site.ingest()
    return check_raw(site.zone().read("orders"), TEST_TABLES["orders"])


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def monthly_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return monthly_rows(rows, "o_orderstatus")


@query(
    "SELECT column_name, problem, detail, row_count FROM (VALUES "
    "('p_size', 'missing', 'string'), ('p_extra', 'extra', 'string')"
    ") v(column_name, problem, detail), (SELECT count(*)::BIGINT AS row_count FROM part)"
)
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences between the columns of an ingested extract and the contract, with the rows they concern."""
    site = Site(spark, sf_dir)
    names = ("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    drifted = site.table("part").select(*names, F.upper("p_type").alias("P_EXTRA"))
    site.deliver_by_plant(drifted, "p_partkey", "part")
    site.ingest()
    stored = site.zone().read("part")
    differences = schema_differences(stored.schema, TEST_TABLES["part"].raw_schema)
    extra = [c for c, problem, _ in differences if problem == "extra"]
    if extra != undeclared_columns(stored, TEST_TABLES["part"]):
        raise AssertionError("both ways of finding surplus columns must agree")
    found = spark.createDataFrame(differences, "column_name string, problem string, detail string")
    return found.withColumn("row_count", F.lit(stored.count()).cast("bigint"))


@query(
    f"SELECT 'events' AS table_name, {plant_sql('user_id')} AS source, count(*)::BIGINT AS row_count, "
    "0::BIGINT AS unknown_source_rows FROM events GROUP BY 2"
)
def rows_by_plant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_per_source(tagged(_read(spark, sf_dir, "events"), "user_id"), "events")


def _nullable_key(spark: SparkSession, sf_dir: str) -> Site:
    contracts = {**TEST_TABLES, "lineitem": required(TEST_TABLES["lineitem"], "l_orderkey")}
    site = Site(spark, sf_dir, contracts)
    rows = site.table("lineitem").withColumn(
        "l_orderkey", F.when(F.col("l_linenumber") != 7, F.col("l_orderkey"))
    )
    site.deliver_by_plant(rows, "l_partkey", "lineitem", parts=4)
    return site


@query(
    "SELECT 'failed' AS status, 500 AS status_code, 'lineitem: NULL in required columns {''l_orderkey'': ' "
    "|| count(*) || '}' AS message, 0::BIGINT AS published FROM lineitem WHERE l_linenumber = 7"
)
def required_blank_fails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blanks in a required key stop the reload, which says how many there are."""
    site = _nullable_key(spark, sf_dir)
    site.ingest()
    report = site.reload("lineitem").report(spark)
    published = len(site.warehouse().published())
    return report.select("status", "status_code", "message", F.lit(published).cast("bigint").alias("published"))


@query(
    "SELECT table_name, rule, column_name, source, violations FROM ("
    "SELECT 'orders' AS table_name, 'reference' AS rule, 'o_custkey -> customer' AS column_name, o.source, "
    "count(*)::BIGINT AS violations FROM (SELECT o_custkey, "
    f"{plant_sql('o_orderkey')} AS source FROM orders) o ANTI JOIN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) c "
    "ON o.o_custkey = c.c_custkey GROUP BY o.source)"
)
def plant_free_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same check with keys shared by the plants; customers in debt are no parents here."""
    child = tagged(_read(spark, sf_dir, "orders"), "o_orderkey")
    parent = tagged(_read(spark, sf_dir, "customer").filter("c_acctbal >= 0"), "c_custkey")
    reference = refers("o_custkey", "customer", "c_custkey")
    return check_reference(child, parent, "orders", reference, per_source=False)
