"""Landed-zone discovery and routing: which extract goes where, with which settings."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantmart import storage
from plantmart.functions import names
from plantmart.session import new_folder
from plantmart.sources.stores import arrow_uri

# The names of the settings of an extract.
CONFIG_SCHEMA = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("TargetTable", "HasHeader", "Delimiter", "Encoding", "MultiLine")
    ]
)

FILES_SCHEMA = "path string, length bigint, modificationTime timestamp"
FOLDER, FILE = "folder", "file"
_LISTED_SCHEMA = "path string, uri string, length bigint, modificationTime timestamp, kind string"
# Tasks that list the folders of one level, and rows that a task passes on at once.
LISTINGS_PER_CORE = 4
LISTED_AT_ONCE = 10_000

# What the ingestion and the vault expect of one manifest entry.
MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField(
            "copy",
            T.StructType(
                [T.StructField(n, T.StringType()) for n in ("bucket", "key", "copy_source")]
            ),
        ),
        T.StructField(
            "job",
            T.StructType(
                [
                    T.StructField(n, T.StringType())
                    for n in (
                        "source_path",
                        "processed_path",
                        "target_table",
                        "source_system",
                        "database",
                        "has_header",
                        "delimiter",
                        "encoding",
                    )
                ]
            ),
        ),
        T.StructField(
            "delivery",
            T.StructType(
                [
                    T.StructField("multi_line", T.StringType()),
                    T.StructField("parts", T.LongType()),
                    T.StructField("bytes", T.LongType()),
                    T.StructField("largest_part", T.LongType()),
                ]
            ),
        ),
    ]
)

REJECTS_SCHEMA = "path string, file_name string, stem string, source_system string, reason string"

NO_FOLDER = "no enclosing source folder"
NO_CONFIG = "no configuration"
NO_TARGET = "configuration without TargetTable"
DUPLICATE = "several extracts for one table and source"


@dataclass(frozen=True)
class Zones:
    """Base locations of one environment."""

    landed: str
    configs: str
    replicated: str
    processed: str
    warehouse: str
    database: str

    @property
    def warehouse_database(self) -> str:
        return f"{self.database}_dw"

    @classmethod
    def under(cls, root: str, database: str) -> Zones:
        return cls(*(f"{root}/{z}" for z in ("landed", "configs", "replicated", "processed", "dw")), database)


def discover(spark: SparkSession, base: str) -> DataFrame:
    """Every file below the landed base, listed once; the file contents are not read.

    Folders are listed level by level. Those of a level are dealt to tasks anew, whatever folder they lie in,
    so a source with most of the files is listed by many tasks; a single folder is one call of its store.
    The driver counts the folders of a level and sees none of them. The listing is written to the
    shared folder, and all that need it read it there.
    """
    if not storage.exists(spark, base):
        return spark.createDataFrame([], FILES_SCHEMA)
    root = storage.qualified(spark, base).rstrip("/")
    target = new_folder(spark, "listing")
    level = spark.createDataFrame([(root, arrow_uri(root))], "folder string, uri string")
    most = LISTINGS_PER_CORE * spark.sparkContext.defaultParallelism
    depth, folders = 0, 1
    while folders:
        # Dealt by a hash of the name: neighbours in the tree, which may be equally large, part.
        dealt = level.repartition(min(folders, most), F.xxhash64("folder"))
        place = f"{target}/level={depth:04d}"
        dealt.mapInArrow(_lister(), _LISTED_SCHEMA).write.partitionBy("kind").parquet(place)
        listed = spark.read.schema(_LISTED_SCHEMA).parquet(place)
        level = listed.where(F.col("kind") == FOLDER).select(F.col("path").alias("folder"), "uri")
        depth, folders = depth + 1, level.count()
    listed = spark.read.schema(f"{_LISTED_SCHEMA}, level string").parquet(target)
    return listed.where(F.col("kind") == FILE).select("path", "length", "modificationTime")


def _lister():
    """A local function travels to the executors by value, so they need not have this package."""
    most, folder_kind, file_kind = LISTED_AT_ONCE, FOLDER, FILE

    def list_folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The visible files and folders in each folder, as Spark's own file scans spell and choose them."""
        from pyarrow import fs

        for batch in batches:
            for row in batch.to_pylist():
                store, path = fs.FileSystem.from_uri(row["uri"])
                found = []
                for info in store.get_file_info(fs.FileSelector(path.rstrip("/"))):
                    name = info.base_name
                    if name.startswith(".") or (name.startswith("_") and "=" not in name):
                        continue
                    if info.type == fs.FileType.File:
                        found.append((f"{row['folder']}/{name}", None, info.size, info.mtime_ns // 1000, file_kind))
                    elif info.type == fs.FileType.Directory:
                        uri = f"{row['uri'].rstrip('/')}/{name if row['uri'].startswith('/') else quote(name)}"
                        found.append((f"{row['folder']}/{name}", uri, None, None, folder_kind))
                for at in range(0, len(found), most):
                    columns = list(zip(*found[at : at + most]))
                    types = (pa.string(), pa.string(), pa.int64(), pa.timestamp("us", "UTC"), pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, types)],
                        ["path", "uri", "length", "modificationTime", "kind"],
                    )

    return list_folders


def versions(files: DataFrame) -> DataFrame:
    """path and version of each extract: equal as long as its files keep names, lengths and times of change."""
    one = F.xxhash64("path", "length", "modificationTime")
    return files.groupBy(names.extract_path(F.col("path")).alias("path")).agg(
        F.concat_ws("-", F.count("*"), F.sum("length"), F.lower(F.hex(F.bit_xor(one)))).alias("version")
    )


def read_configs(spark: SparkSession, folder: str) -> DataFrame:
    """One JSON object per file; the file name is the stem it applies to."""
    schema = T.StructType([T.StructField("stem", T.StringType()), *CONFIG_SCHEMA.fields])
    if not storage.child_names(spark, folder):
        return spark.createDataFrame([], schema)
    return (
        spark.read.schema(CONFIG_SCHEMA)
        .option("multiLine", True)
        .option("pathGlobFilter", "*.json")
        .json(folder)
        .select(
            F.regexp_replace("_metadata.file_name", r"\.json$", "").alias("stem"),
            *CONFIG_SCHEMA.names,
        )
    )


def extracts(files: DataFrame) -> DataFrame:
    """One row per extract: a single file, or a folder of part files under the extract's name."""
    return files.groupBy(names.extract_path(F.col("path")).alias("path")).agg(
        F.count("*").alias("parts"),
        F.sum("length").alias("bytes"),
        F.max("length").alias("largest_part"),
    )


def _or_default(column: str, default: str) -> Column:
    return F.coalesce(F.col(column), F.lit(default))


def route(deliveries: DataFrame, configs: DataFrame) -> DataFrame:
    """Deliveries with their settings and, where one cannot be processed, the ``reason``.

    No delivery is lost: each comes out once, either with a NULL reason or as a reject.
    """
    named = (
        deliveries.withColumn("file_name", names.base_name(F.col("path")))
        .filter(F.col("file_name") != "")
        .withColumn("stem", names.config_stem(F.col("file_name")))
        .withColumn("source_system", names.source_system(F.col("path")))
    )
    settings = configs.select(
        "stem",
        F.lit(True).alias("configured"),
        F.col("TargetTable").alias("target_table"),
        _or_default("HasHeader", "true").alias("has_header"),
        _or_default("Delimiter", ",").alias("delimiter"),
        _or_default("Encoding", "utf-8").alias("encoding"),
        _or_default("MultiLine", "false").alias("multi_line"),
    )
    routed = named.join(settings, "stem", "left").withColumn(
        "reason",
        F.when(F.col("configured").isNull(), NO_CONFIG)
        .when(F.col("target_table").isNull(), NO_TARGET)
        .when(F.col("source_system").isNull(), NO_FOLDER),
    )
    # Counting first keeps a table and source with very many extracts out of any single task.
    repeated = (
        routed.filter(F.col("reason").isNull())
        .groupBy("target_table", "source_system")
        .count()
        .filter(F.col("count") > 1)
        .select("target_table", "source_system", F.lit(DUPLICATE).alias("repeated"))
    )
    return (
        routed.join(repeated, ["target_table", "source_system"], "left")
        .withColumn("reason", F.coalesce("reason", "repeated"))
        .drop("configured", "repeated")
    )


def manifest(routed: DataFrame, zones: Zones) -> DataFrame:
    """The accepted deliveries as nested entries for replication and ingestion."""
    path, file_name = F.col("path"), F.col("file_name")
    source, table = F.col("source_system"), F.col("target_table")
    replicated = F.lit(zones.replicated)
    copy = F.struct(
        names.uri_bucket(replicated).alias("bucket"),
        names.join_path(names.uri_key(replicated), source, file_name).alias("key"),
        F.concat_ws("/", names.uri_bucket(path), names.uri_key(path)).alias("copy_source"),
    )
    job = F.struct(
        path.alias("source_path"),
        names.join_path(zones.processed, table, F.lit("")).alias("processed_path"),
        table.alias("target_table"),
        source.alias("source_system"),
        F.lit(zones.database).alias("database"),
        "has_header",
        "delimiter",
        "encoding",
    )
    delivery = F.struct("multi_line", "parts", "bytes", "largest_part")
    accepted = routed.filter(F.col("reason").isNull()).select(
        copy.alias("copy"), job.alias("job"), delivery.alias("delivery")
    )
    return accepted.to(MANIFEST_SCHEMA)


def rejects(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("reason").isNotNull()).select(
        "path", "file_name", "stem", "source_system", "reason"
    )
