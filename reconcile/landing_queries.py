"""Discovery, routing and scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantmart.contracts import LOADED_AT, SOURCE
from plantmart.functions.casts import contract_projection
from plantmart.operators.merge import union_all
from plantmart.plans.ingest import layout_of
from plantmart.sources.delimited import Layout, scan_delimited
from plantmart.sources.landing import Zones, extracts, manifest, rejects, route
from plantmart.sources.raw import RawZone
from reconcile.registry import query
from reconcile.site import LOADED, LOADED_SQL, Site, plant, plant_sql

ZONES = Zones(
    "s3://lab-in/landed", "s3://lab-in/configs", "s3://lab-out/kept/copies//",
    "s3://lab-out/processed/", "s3://lab-out/dw", "lab_raw",
)

# One listed object per customer, two for the shapes that need them; the shape goes by key % 10.
_SHAPES = {
    0: ["{p}/{s}_prod_extract.csv.gz/part-0.csv.gz", "{p}/{s}_prod_extract.csv.gz/part-1.csv.gz"],
    1: ["{p}/{s}_QA_extract.TSV.GZ"],
    2: ["{p}/deeper/{s}_dev_Extract.csv"],
    3: ["{p}/{s}.tsv"],
    4: ["{p}/{s}_prod_extract.csv.gz.csv"],
    5: ["{s}.csv"],
    6: ["{p}/{s}_prod_extract.csv.gz"],
    7: ["{p}/{s}_prod_extract.csv.gz"],
    8: ["{p}/{s}/"],
    9: ["{p}/{s}_prod_extract.csv", "{p}/{s}_qa_extract.csv"],
}


def _listing(customers: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    stem = F.concat(F.lit("T"), key)
    shapes = None
    for remainder, templates in _SHAPES.items():
        paths = [F.concat(F.lit("s3://lab-in/" if remainder == 5 else "s3://lab-in/landed/"),
                          F.replace(F.replace(F.lit(t), F.lit("{p}"), plant("c_custkey")), F.lit("{s}"), stem))
                 for t in templates]
        when = F.when if shapes is None else shapes.when
        shapes = when(key % 10 == remainder, F.array(*paths))
    return customers.select(F.explode(shapes).alias("path"), key.alias("length"))


def _configs(customers: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    shape = key % 10
    return customers.filter(shape != 6).select(
        F.concat(F.lit("T"), key).alias("stem"),
        F.when(shape != 7, F.concat(F.lit("t"), key)).alias("TargetTable"),
        F.when(shape == 2, "FALSE").alias("HasHeader"),
        F.when(shape.isin(1, 3), "\t").alias("Delimiter"),
        F.when(shape == 0, "windows-1252").alias("Encoding"),
        F.lit(None).cast("string").alias("MultiLine"),
    )


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return route(extracts(_listing(customers)), _configs(customers))


_ROUTED_SQL = """
WITH listed AS (
  SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN 'DKQ' ELSE 'FOS' END AS p,
         'T' || c_custkey AS s FROM customer
), files AS (
  SELECT k, s, unnest(CASE k % 10
    WHEN 0 THEN ['landed/' || p || '/' || s || '_prod_extract.csv.gz']
    WHEN 1 THEN ['landed/' || p || '/' || s || '_QA_extract.TSV.GZ']
    WHEN 2 THEN ['landed/' || p || '/deeper/' || s || '_dev_Extract.csv']
    WHEN 3 THEN ['landed/' || p || '/' || s || '.tsv']
    WHEN 4 THEN ['landed/' || p || '/' || s || '_prod_extract.csv.gz.csv']
    WHEN 5 THEN [s || '.csv']
    WHEN 8 THEN ['landed/' || p || '/' || s || '/']
    WHEN 9 THEN ['landed/' || p || '/' || s || '_prod_extract.csv', 'landed/' || p || '/' || s || '_qa_extract.csv']
    ELSE ['landed/' || p || '/' || s || '_prod_extract.csv.gz'] END) AS key FROM listed
), named AS (
  SELECT k, s, key, split_part(key, '/', -1) AS file,
    CASE WHEN contains(key, '/') THEN split_part(key, '/', -2) END AS folder FROM files
), stemmed AS (
  SELECT *, regexp_replace(regexp_replace(file, '\\.(csv\\.gz|tsv\\.gz|csv|tsv)$', '', 'i'),
    '_(prod|qa|dev)_extract$', '', 'i') AS stem FROM named WHERE file <> ''
), configured AS (
  SELECT 'T' || c_custkey AS stem, c_custkey % 10 AS shape,
    CASE WHEN c_custkey % 10 <> 7 THEN 't' || c_custkey END AS target
  FROM customer WHERE c_custkey % 10 <> 6
), routed AS (
  SELECT t.*, c.shape, c.target,
    CASE WHEN c.stem IS NULL THEN 'no configuration'
         WHEN c.target IS NULL THEN 'configuration without TargetTable'
         WHEN t.folder IS NULL THEN 'no enclosing source folder'
         WHEN t.k % 10 = 9 THEN 'several extracts for one table and source' END AS reason
  FROM stemmed t LEFT JOIN configured c ON t.stem = c.stem
)
"""


@query(
    _ROUTED_SQL
    + """
SELECT 'lab-out' AS bucket, 'kept/copies/' || folder || '/' || file AS "key",
  'lab-in/' || key AS copy_source, 's3://lab-in/' || key AS source_path,
  's3://lab-out/processed/' || target || '/' AS processed_path, target AS target_table,
  folder AS source_system, 'lab_raw' AS "database",
  CASE WHEN shape = 2 THEN 'FALSE' ELSE 'true' END AS has_header,
  CASE WHEN shape IN (1, 3) THEN chr(9) ELSE ',' END AS delimiter,
  CASE WHEN shape = 0 THEN 'windows-1252' ELSE 'utf-8' END AS encoding,
  CASE WHEN shape = 0 THEN 2 ELSE 1 END::BIGINT AS parts,
  CASE WHEN shape = 0 THEN 2 * k ELSE k END::BIGINT AS bytes
FROM routed WHERE reason IS NULL
"""
)
def route_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = manifest(_routed(spark, sf_dir), ZONES)
    return entries.select("copy.*", "job.*", "delivery.parts", "delivery.bytes")


@query(_ROUTED_SQL + "SELECT 's3://lab-in/' || key AS path, stem, folder AS source_system, reason FROM routed WHERE reason IS NOT NULL")
def route_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects(_routed(spark, sf_dir)).drop("file_name")


@query(
    " UNION ALL ".join(
        f"SELECT '{t}' AS target_table, {plant_sql(k)} AS source_system, count(*)::BIGINT AS row_count"
        f" FROM {t} GROUP BY 2"
        for t, k in (("customer", "c_custkey"), ("part", "p_partkey"), ("orders", "o_orderkey"))
    )
)
def landed_extracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discover real files and configurations, route them, and count what each extract holds."""
    site = Site(spark, sf_dir)
    site.deliver_tables("customer", "part", "orders")
    counted = []
    for entry in site.survey().entries:
        rows = scan_delimited(spark, entry.job.source_path, layout_of(entry), parts=entry.delivery.parts)
        one = rows.agg(F.count("*").alias("row_count")).select(
            F.lit(entry.job.target_table).alias("target_table"),
            F.lit(entry.job.source_system).alias("source_system"),
            "row_count",
        )
        counted.append(one)
    return union_all(counted)


_LAYOUTS = {
    "COMMA_GZ": (Layout(), ".csv.gz"),
    "TAB_PLAIN": (Layout(delimiter="\t"), ".tsv"),
    "COMMA_BARE": (Layout(has_header=False), ".csv"),
    "TAB_BARE_GZ": (Layout(has_header=False, delimiter="\t"), ".tsv.gz"),
}


@query(
    f"""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, {plant_sql('c_custkey')} AS source,
  {LOADED_SQL} AS last_updated_at,
  ['COMMA_GZ', 'TAB_PLAIN', 'COMMA_BARE', 'TAB_BARE_GZ'][(c_custkey // 2 % 4 + 1)::INTEGER] AS stem
FROM customer
"""
)
def delimited_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both headers and none, comma and tab, packed and plain, one extract per layout and plant."""
    site = Site(spark, sf_dir)
    customers = site.table("customer")
    contract = site.contracts["customer"]
    for i, (stem, (layout, extension)) in enumerate(_LAYOUTS.items()):
        rows = customers.filter(F.floor(F.col("c_custkey") / 2) % 4 == i)
        site.deliver_by_plant(rows, "c_custkey", f"customer_{i}", layout=layout, stem=stem, extension=extension)
    scans = []
    for entry in site.survey().entries:
        stem = entry.copy.key.rsplit("/", 1)[1].split("_prod")[0]
        rows = scan_delimited(
            spark, entry.job.source_path, layout_of(entry), contract.raw_names, entry.delivery.parts
        )
        one = (
            rows.withColumn(SOURCE, F.lit(entry.job.source_system))
            .withColumn(LOADED_AT, F.lit(LOADED))
            .select(*contract_projection(contract), F.lit(stem).alias("stem"))
        )
        scans.append(one)
    return union_all(scans)


@query(
    f"SELECT doc_id, text, lang, source AS origin, n_chars, {plant_sql('doc_id')} AS source, "
    f"{LOADED_SQL} AS last_updated_at FROM documents"
)
def windows_1252_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with line breaks through the legacy code page and back."""
    site = Site(spark, sf_dir)
    rows = site.table("documents").withColumnRenamed("source", "origin")
    layout = Layout(encoding="windows-1252", multi_line=True)
    site.deliver_by_plant(rows, "doc_id", "documents", layout=layout, parts=4)
    return site.loaded("documents")


@query(
    """
SELECT CASE WHEN l_partkey % 2 = 0 THEN 'DKQ' ELSE 'FOS' END AS source, count(*)::BIGINT AS row_count,
  count(*) FILTER (WHERE l_linenumber IN (2, 5))::BIGINT AS malformed
FROM lineitem GROUP BY 1
"""
)
def ragged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows one field short (line 2) or one field long (line 5) are kept and counted."""
    site = Site(spark, sf_dir)
    fields = ["l_partkey", "l_suppkey", "l_linenumber"]
    line = F.col("l_linenumber")
    body = F.concat_ws("|", *fields)
    text = F.when(line == 2, F.concat_ws("|", *fields[:2])).when(line == 5, F.concat(body, F.lit("|x"))).otherwise(body)
    rows = site.table("lineitem").select(text.alias("|".join(fields)), "l_partkey")
    for source in ("DKQ", "FOS"):
        mine = rows.filter(plant("l_partkey") == source).drop("l_partkey")
        # The joined fields contain no comma or quote, so a comma layout writes them as they are.
        site.deliver(mine, source, "lineitem", extension=".csv")
    site.settings["LINEITEM"]["Delimiter"] = "|"
    results = site.ingest()
    return RawZone(spark, site.zones.processed, site.zones.database).read("lineitem").groupBy(SOURCE).agg(
        F.count("*").alias("row_count")
    ).join(
        F.broadcast(spark.createDataFrame([(r.source, r.malformed) for r in results], "source string, malformed bigint")),
        SOURCE,
    )
