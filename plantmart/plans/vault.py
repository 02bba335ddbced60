"""Replica vault: landed files kept byte for byte, in chunks, replaced file by file.

Every chunk has a SHA-256 digest, and a file has the root of a hash tree over them. So ranges of a file, in a store or
in the vault, are digested by many tasks, each on its own, and two files are equal if their roots are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantmart.functions import names
from plantmart.session import new_folder
from plantmart.sources.stores import ARROW_SCHEMES, arrow_uri

CHUNK_BYTES = 8 << 20
TASK_BYTES = 256 << 20
# Digests under one node of the hash tree.
FAN = 1024
# Chunks are large rows. By default Parquet would look at the sizes of pages and row groups after a hundred of them, so a task
# held all of its chunks several times over; and a reader takes a whole row group at once.
_LARGE_ROWS = {
    "parquet.page.size.row.check.min": "1",
    "parquet.page.size.row.check.max": "1",
    "parquet.block.size": str(32 << 20),
}

_SCHEMA = (
    "source string, file string, part string, modified timestamp, part_bytes bigint, "
    "chunk_start bigint, content binary"
)
_COLUMNS = ["source", "file", "part", "modified", "part_bytes", "chunk_start"]


def _chunk_reader():
    """A local function travels to the executors by value, so they need not have this package."""
    kept = list(_COLUMNS)

    def read_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Add the bytes of each listed range; one chunk is in memory at a time."""
        from pyarrow import fs

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                store, path = fs.FileSystem.from_uri(row["uri"][0].as_py())
                with store.open_input_file(path) as handle:
                    content = handle.read_at(
                        row["chunk_bytes"][0].as_py(), row["chunk_start"][0].as_py()
                    )
                columns = [row[c] for c in kept] + [pa.array([content], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, [*kept, "content"])

    return read_chunks


def _range_digester():
    """A local function travels to the executors by value, so they need not have this package."""

    def digest_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The digest of each listed range; one chunk is in memory at a time and none leaves the task."""
        import hashlib

        from pyarrow import fs

        for batch in batches:
            digests = []
            for row in batch.to_pylist():
                store, path = fs.FileSystem.from_uri(row["uri"])
                with store.open_input_file(path) as handle:
                    content = handle.read_at(row["chunk_bytes"], row["chunk_start"])
                digests.append(hashlib.sha256(content).hexdigest())
            kept = [batch.column(c) for c in ("path", "bytes", "chunk_no")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(digests, pa.string())], ["path", "bytes", "chunk_no", "digest"])

    return digest_ranges


def file_digests(files: DataFrame, chunk_bytes: int = CHUNK_BYTES, task_bytes: int = TASK_BYTES) -> DataFrame:
    """path, bytes and root digest of each file, read where it lies; `files` needs path and length.

    Ranges are dealt to tasks, so a huge file is read by many.
    """
    total = files.agg(F.sum("length")).first()[0] or 0
    zero, step = F.lit(0).cast("bigint"), F.lit(chunk_bytes).cast("bigint")
    ranges = files.select(
        "path",
        F.col("length").alias("bytes"),
        _uri(F.col("path")).alias("uri"),
        F.posexplode(F.sequence(zero, F.greatest(F.col("length") - 1, zero), step)).alias("chunk_no", "chunk_start"),
    ).withColumns(
        {"chunk_bytes": F.least(step, F.col("bytes") - F.col("chunk_start")), "chunk_no": F.col("chunk_no").cast("bigint")}
    )
    tasks = max(1, math.ceil(total / task_bytes), min(files.sparkSession.sparkContext.defaultParallelism, math.ceil(total / chunk_bytes)))
    dealt = ranges.repartition(tasks, F.xxhash64("path", "chunk_start"))
    digests = dealt.mapInArrow(_range_digester(), "path string, bytes bigint, chunk_no bigint, digest string")
    return tree_roots(digests, ["path"])


def vault_digests(vault: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """source, file, part, bytes and root digest of each vaulted file, from the content that is there.

    A file with a chunk missing, repeated or of a wrong length has a NULL digest.
    """
    step = F.lit(chunk_bytes).cast("bigint")
    place = F.col("chunk_start") / step
    chunks = vault.select(
        "source", "file", "part", F.col("part_bytes").alias("bytes"), place.cast("bigint").alias("chunk_no"),
        F.sha2("content", 256).alias("digest"), (F.col("chunk_start") % step == 0).alias("aligned"),
        F.octet_length("content").alias("size"),
    )
    key = ["source", "file", "part"]
    whole = chunks.groupBy(*key, "bytes").agg(
        F.count("*").alias("found"), F.sum("size").alias("sum"), F.bool_and("aligned").alias("aligned"),
        F.max("chunk_no").alias("last"), F.count_distinct("chunk_no").alias("distinct"),
    )
    complete = (
        F.col("aligned") & (F.col("sum") == F.col("bytes")) & (F.col("found") == F.col("last") + 1)
        & (F.col("distinct") == F.col("found"))
    )
    roots = tree_roots(chunks.select(*key, "bytes", "chunk_no", "digest"), key)
    judged = whole.select(*key, complete.alias("complete"))
    checked = roots.join(judged, key)
    return checked.select(*key, "bytes", F.when(F.col("complete"), F.col("digest")).alias("digest"))


def tree_roots(chunks: DataFrame, key: list[str]) -> DataFrame:
    """The key, bytes and root of each file, from one row for each chunk: key, bytes, chunk_no, digest.

    A node is the digest of up to FAN digests below it, so no group has more rows, however long a file is. All
    files have as many levels as the longest needs; the length is part of the root.
    """
    last = chunks.agg(F.max("chunk_no")).first()[0] or 0
    nodes = chunks.select(*key, "bytes", F.col("chunk_no").cast("bigint").alias("no"), "digest")
    while True:
        below = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("no", "digest"))), lambda x: x.digest), "")
        above = F.floor(F.col("no") / FAN).cast("bigint")
        nodes = nodes.withColumn("above", above).groupBy(*key, "bytes", "above").agg(F.sha2(below, 256).alias("digest"))
        nodes = nodes.withColumnRenamed("above", "no")
        if last < FAN:
            break
        last //= FAN
    root = F.sha2(F.concat_ws(":", "bytes", "digest"), 256)
    return nodes.select(*key, "bytes", root.alias("digest"))


def _uri(path: Column) -> Column:
    """arrow_uri() as a column expression, for listed paths of known stores."""
    found = F.when(path.startswith("/"), path).when(
        path.startswith("file:"), F.regexp_replace(path, "^file:/+", "/")
    )
    escaped = F.regexp_replace(F.regexp_replace(F.url_encode(path), r"\+", "%20"), "%2F", "/")
    escaped = F.regexp_replace(F.regexp_replace(escaped, "%3A", ":"), "%40", "@")
    for scheme, arrow in ARROW_SCHEMES.items():
        if scheme != "file":
            found = found.when(path.startswith(f"{scheme}:"), F.concat(F.lit(arrow), F.substr(escaped, F.lit(len(scheme) + 1))))
    return found.otherwise(F.raise_error(F.concat(F.lit("unknown store: "), path)))


def replica_chunks(
    files: DataFrame, accepted: DataFrame, chunk_bytes: int = CHUNK_BYTES, tasks: int = 1
) -> DataFrame:
    """Chunks of every landed file that belongs to an accepted extract.

    The manifest names the store; a store that cannot be read in ranges is refused here.

    Files are cut into ranges first, and the ranges are what Spark distributes, so a huge file is
    read by many tasks and never held whole anywhere.
    """
    wanted = accepted.select(F.col("job.source_path").alias("extract"), F.col("job.source_system").alias("source"))
    listed = files.withColumn("extract", names.extract_path(F.col("path"))).join(wanted, "extract")
    zero = F.lit(0).cast("bigint")
    ranges = listed.select(
        "source",
        names.base_name(F.col("extract")).alias("file"),
        F.when(F.col("path") == F.col("extract"), "").otherwise(names.base_name(F.col("path"))).alias("part"),
        F.col("modificationTime").alias("modified"),
        F.col("length").alias("part_bytes"),
        "path",
        _uri(F.col("path")).alias("uri"),
        F.explode(
            F.sequence(zero, F.greatest(F.col("length") - 1, zero), F.lit(chunk_bytes).cast("bigint"))
        ).alias("chunk_start"),
    ).withColumn("chunk_bytes", F.least(F.lit(chunk_bytes), F.col("part_bytes") - F.col("chunk_start")))
    # Ranges of the order deal chunks evenly, and neighbours stay together, so a task writes a few
    # large files instead of many small ones.
    spread = ranges.repartitionByRange(tasks, "path", "chunk_start")
    return spread.mapInArrow(_chunk_reader(), _SCHEMA).withColumn("sha256", F.sha2("content", 256))


def replicate(
    files: DataFrame,
    accepted: DataFrame,
    target: str,
    total_bytes: int,
    chunk_bytes: int = CHUNK_BYTES,
) -> None:
    """Write the chunks; a file delivered again replaces its old copy, others stay."""
    least = files.sparkSession.sparkContext.defaultParallelism
    tasks = max(math.ceil(total_bytes / TASK_BYTES), min(least, math.ceil(total_bytes / chunk_bytes)), 1)
    (
        replica_chunks(files, accepted, chunk_bytes, tasks)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("source", "file")
        .options(**_LARGE_ROWS)
        .parquet(target)
    )


def _file_writer(root: str):
    """A local function travels to the executors by value, so they need not have this package."""

    def write_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Write the chunks of each file in their order, checked one by one; one chunk is in memory."""
        import hashlib

        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        current, out, written, whole, expected = None, None, 0, None, 0

        def close() -> pa.RecordBatch:
            out.close()
            if written != expected:
                raise ValueError(f"{current}: {written} of {expected} bytes are in the vault")
            row = [*current, written, whole.hexdigest()]
            return pa.RecordBatch.from_arrays(
                [pa.array([v]) for v in row], ["source", "file", "part", "bytes", "sha256"]
            )

        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                key = (row["source"], row["file"], row["part"])
                if key != current:
                    if current is not None:
                        yield close()
                    path = "/".join([base.rstrip("/"), *(x for x in key if x)])
                    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
                    current, out, written, whole = key, store.open_output_stream(path, compression=None), 0, hashlib.sha256()
                    expected = row["part_bytes"]
                if row["chunk_start"] != written or hashlib.sha256(row["content"]).hexdigest() != row["sha256"]:
                    raise ValueError(f"{key}: the chunk at {row['chunk_start']} is missing, repeated or damaged")
                out.write(row["content"])
                whole.update(row["content"])
                written += len(row["content"])
        if current is not None:
            yield close()

    return write_files


def restore(spark: SparkSession, vault: str, target: str) -> DataFrame:
    """Write all vaulted files below ``target``, as {source}/{file} or {source}/{file}/{part}.

    Files are dealt to tasks, and each is written chunk by chunk. Every chunk must follow the one before
    and agree with its digest, and a file must be complete, or the restoring fails. The report has a row
    for each file: source, file, part, bytes, sha256.
    """
    key = ["source", "file", "part"]
    schema = "source string, file string, part string, bytes bigint, sha256 string"
    dealt = spark.read.parquet(vault).repartition(*key).sortWithinPartitions(*key, "chunk_start")
    columns = [*key, "part_bytes", "chunk_start", "content", "sha256"]
    report = new_folder(spark, "restored")
    dealt.select(*columns).mapInArrow(_file_writer(arrow_uri(target)), schema).write.parquet(report)
    return spark.read.schema(schema).parquet(report)
