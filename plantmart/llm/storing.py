"""Steps written to the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from plantmart import storage
from plantmart.session import new_folder, release


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once to the shared folder and read from there."""
    return Steps(rows.sparkSession).store(rows, purpose)


class Steps:
    """Stored steps of one computation, of which those go that later ones no longer read."""

    def __init__(self, spark):
        self.spark = spark
        self.folders: dict[int, tuple[DataFrame, str]] = {}

    def store(self, rows: DataFrame, purpose: str) -> DataFrame:
        folder = new_folder(self.spark, purpose)
        rows.write.parquet(folder)
        found = rows.sparkSession.read.schema(rows.schema).parquet(folder)
        self.folders[id(found)] = (found, folder)
        return found

    def drop(self, *steps: DataFrame | None) -> None:
        """Delete what was stored; nothing that is still to be computed may read it."""
        for rows in steps:
            if rows is not None and id(rows) in self.folders:
                storage.delete(self.spark, self.folders.pop(id(rows))[1])

    def keep_only(self, *steps: DataFrame | None) -> None:
        """Delete all steps but these, and the shuffle files behind them."""
        kept = {id(rows) for rows in steps}
        self.drop(*[rows for key, (rows, _) in self.folders.items() if key not in kept])
        release(self.spark)


def in_small_batches(rows: DataFrame, most_bytes: int) -> DataFrame:
    """The same rows, handed to Python in Arrow batches of at most `most_bytes` (or of a single larger row).

    Spark's JVM and the Python worker hold whole batches beside the heap, several times over. The size is a setting
    of the session, so the rows get a session of their own; the given one is left as it is.
    """
    spark = rows.sparkSession
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most_bytes))
    name = f"rows_{uuid.uuid4().hex}"
    rows.createGlobalTempView(name)
    try:
        return own.table(f"{spark.conf.get('spark.sql.globalTempDatabase')}.{name}")
    finally:
        own.catalog.dropGlobalTempView(name)


def unused(name: str, columns: list[str]) -> str:
    """A column name that none of the columns has, in any case of letters."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
