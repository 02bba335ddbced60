"""Hash trees: equal files have equal roots, ranges are digested on their own."""

import hashlib
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from plantmart.plans import vault
from plantmart.plans.vault import file_digests, replicate, tree_roots, vault_digests
from plantmart.sources.landing import discover


def plain(data, chunk, fan):
    level = [hashlib.sha256(data[k : k + chunk]).hexdigest() for k in range(0, max(len(data), 1), chunk)]
    return level, fan


def root(data, chunk, fan, levels):
    level, _ = plain(data, chunk, fan)
    for _ in range(levels):
        level = [hashlib.sha256("".join(level[k : k + fan]).encode()).hexdigest() for k in range(0, len(level), fan)]
    assert len(level) == 1
    return hashlib.sha256(f"{len(data)}:{level[0]}".encode()).hexdigest()


@pytest.mark.parametrize("fan, levels", ((1024, 1), (2, 6), (3, 4)))
def test_roots_of_files(spark, tmp_path, monkeypatch, fan, levels):
    monkeypatch.setattr(vault, "FAN", fan)
    contents = {"a.csv": b"x" * 500, "b.csv": b"x" * 499 + b"y", "empty.csv": b"", "long.csv": os.urandom(4001)}
    for name, data in contents.items():
        (tmp_path / name).write_bytes(data)
    found = file_digests(discover(spark, str(tmp_path)), chunk_bytes=100)
    got = {r.path.rsplit("/", 1)[1]: (r.bytes, r.digest) for r in found.collect()}
    assert got == {name: (len(data), root(data, 100, fan, levels)) for name, data in contents.items()}


def test_a_huge_file_is_digested_by_several_tasks(spark, tmp_path):
    (tmp_path / "one.csv").write_bytes(os.urandom(100_000))
    one = file_digests(discover(spark, str(tmp_path)), chunk_bytes=1000, task_bytes=10_000)
    plan = one._jdf.queryExecution().toString()
    assert "RepartitionByExpression [xxhash64(path" in plan and ", 10" in plan
    assert one.count() == 1


def test_damage_in_the_vault_shows(spark):
    data = os.urandom(2500)
    rows = [("DKQ", "A.csv", "", 2500, k, data[k : k + 1000]) for k in (0, 1000, 2000)]
    schema = "source string, file string, part string, part_bytes bigint, chunk_start bigint, content binary"
    whole = spark.createDataFrame(rows, schema)
    (good,) = vault_digests(whole, 1000).collect()
    assert good.digest == root(data, 1000, 1024, 1)
    damaged = whole.withColumn("content", F.when(F.col("chunk_start") == 1000, F.lit(b"z" * 1000)).otherwise(F.col("content")))
    assert vault_digests(damaged, 1000).first().digest not in (None, good.digest)
    for broken in (whole.where("chunk_start <> 1000"), whole.where("chunk_start < 2000"), whole.unionByName(whole.limit(1))):
        assert vault_digests(broken, 1000).first().digest is None


def test_roots_of_no_files(spark):
    none = spark.createDataFrame([], "path string, bytes bigint, chunk_no bigint, digest string")
    assert tree_roots(none, ["path"]).collect() == []


def test_a_task_holds_few_chunks_of_a_large_file(spark, tmp_path):
    size = 72 << 20
    (tmp_path / "DKQ").mkdir()
    (tmp_path / "DKQ" / "A.csv").write_bytes(os.urandom(size))
    files = discover(spark, str(tmp_path))
    accepted = files.select(F.struct(F.col("path").alias("source_path"), F.lit("DKQ").alias("source_system")).alias("job"))
    replicate(files, accepted, str(tmp_path / "vault"), total_bytes=1, chunk_bytes=2 << 20)
    (written,) = (tmp_path / "vault").rglob("*.parquet")
    stored = pq.ParquetFile(written).metadata
    groups = [stored.row_group(k) for k in range(stored.num_row_groups)]
    assert sum(g.num_rows for g in groups) == size >> 21
    assert max(g.total_byte_size for g in groups) <= 40 << 20
