"""Session settings the engine relies on, and its shared work folder."""

from __future__ import annotations

import gc
import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import SparkSession

# All are runtime SQL settings; they hold in a session of the engine's own.
SETTINGS = {
    # Audit timestamps carry no zone in the warehouse.
    "spark.sql.session.timeZone": "UTC",
    # A malformed number must fail the load instead of becoming NULL.
    "spark.sql.ansi.enabled": "true",
    # Without it Spark 4 rejects windows-1252.
    "spark.sql.legacy.javaCharsets": "true",
    # source=01 must stay the string '01'.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # A task meets few sources, so partitioned writes keep one writer per source open and skip the
    # sort by source they would otherwise need.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # Unpacked text shrinks to a fifth as Parquet; larger scan tasks leave fewer and larger files.
    "spark.sql.files.maxPartitionBytes": str(256 << 20),
    # Tables are partitioned by source only and joins stay within a source, so pruning at run time
    # can drop nothing, while planning its filters for a dozen nested joins takes half a minute.
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A star join moves its rows once for each large lookup. Where all partitions of a lookup are this small, they
    # are hashed and the rows need no sort; the sizes are those that the shuffle has measured.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(64 << 20),
}

_MARK = "plantmart.configured"

_fallback_folder: str | None = None
_own_sessions: WeakKeyDictionary[SparkSession, SparkSession] = WeakKeyDictionary()


def configure(spark: SparkSession) -> SparkSession:
    """The engine's session of the same application: the given one's settings, and its own above them.

    The given session is left as it is. Both share the catalog and all resources.
    """
    if spark.conf.get(_MARK, None):
        return spark
    own = _own_sessions.get(spark)
    if own is None:
        own = _own_sessions[spark] = spark.newSession()
    for key, value in {**spark.conf.getAll, **SETTINGS, _MARK: "true"}.items():
        if key in SETTINGS or key == _MARK or own.conf.isModifiable(key):
            own.conf.set(key, value)
    return own


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for intermediate data.

    A machine-local folder is acceptable only where driver and executors are one process.
    """
    global _fallback_folder
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    if _fallback_folder is None:
        _fallback_folder = tempfile.mkdtemp(prefix="plantmart-")
    return _fallback_folder


def new_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of what is done.

    They are dropped once the driver no longer refers to them, which it only notices when it collects
    its garbage; without this they would pile up over all steps.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
