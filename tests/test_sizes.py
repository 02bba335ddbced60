"""What grows with the tables: lookups that are sent, and the part files of a delivery."""

import gzip
import os

from pyspark.sql import functions as F

from plantmart.operators.joins import lookup_join
from reconcile import mart_queries, site


def optimized(rows):
    return rows._jdf.queryExecution().optimizedPlan().toString()


def test_a_lookup_is_sent_only_within_its_limit(spark, tmp_path):
    spark.createDataFrame([(1, 1), (2, 1), (None, 2)], "l_orderkey bigint, l_linenumber int").write.parquet(f"{tmp_path}/lineitem.parquet")
    for name, n in (("few", 1_000), ("many", 1_000_000)):
        folder = tmp_path / name
        folder.mkdir()
        os.symlink(tmp_path / "lineitem.parquet", folder / "lineitem.parquet")
        orders = spark.range(1, n).select(F.col("id").alias("o_orderkey"), (F.col("id") * 2).alias("o_custkey"))
        orders.write.parquet(f"{folder}/orders.parquet")
        found = mart_queries.mixed_key_types(spark, str(folder))
        assert ("strategy=broadcast" in optimized(found)) is (name == "few")
        expected = [(k, line, way, k and 2 * k) for k, line in ((1, 1), (2, 1), (None, 2)) for way in ("sent", "shuffled")]
        rows = [(r.l_orderkey, r.l_linenumber, r.way, r.o_custkey) for r in found.collect()]
        assert sorted(rows, key=repr) == sorted(expected, key=repr)


def delivered(spark, tmp_path, rows, parts):
    there = site.Site(spark, str(tmp_path))
    there.deliver(rows, "DKQ", "region", parts=parts)
    folder = f"{there.zones.landed}/DKQ/REGION_prod_extract.csv.gz".removeprefix("file:")
    files = [f"{folder}/{name}" for name in os.listdir(folder) if name.endswith(".gz")]
    return [len(gzip.open(f, "rt").read().splitlines()) - 1 for f in files]


def test_part_files_are_bounded_and_rows_stay_where_they_are_scanned(spark, tmp_path, monkeypatch):
    spark.range(1000).repartition(8).write.parquet(f"{tmp_path}/t.parquet")
    rows = spark.read.parquet(f"{tmp_path}/t.parquet")
    held = rows.rdd.getNumPartitions()
    monkeypatch.setattr(site, "PART_ROWS", 100)
    for parts in (1, 2):
        found = delivered(spark, tmp_path, rows, parts)
        assert sum(found) == 1000 and max(found) <= 100
    one = rows.coalesce(1)
    assert held > 2 and len(delivered(spark, tmp_path, one.limit(40), 4)) == 4


def test_rows_are_not_sorted_to_meet_a_lookup_of_small_partitions(spark):
    unset = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in unset:
        spark.conf.set(key, "-1")
    try:
        facts = spark.range(5000).select("id", (F.col("id") % 700).alias("k"))
        lookup = spark.range(600).select(F.col("id").alias("key"), (F.col("id") * 3).alias("value"))
        joined = lookup_join(facts, lookup, [("k", "key")], broadcast_bytes=-1)
        assert sorted(map(tuple, joined.collect())) == [(i, i % 700, i % 700 * 3 if i % 700 < 600 else None) for i in range(5000)]
        plan = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    finally:
        for key in unset:
            spark.conf.unset(key)
