import pytest
from pyspark.sql import functions as F

from plantmart.plans.vault import _uri
from plantmart.sources.stores import UnknownStore, arrow_uri

# How a path is spelled by Spark, and by Arrow.
SPELLED = {
    "/landed/DKQ/a b.csv": "/landed/DKQ/a b.csv",
    "file:/landed/DKQ/a b+é.csv": "/landed/DKQ/a b+é.csv",
    "file:///landed/x.csv": "/landed/x.csv",
    "hdfs://name:8020/landed/x.csv": "hdfs://name:8020/landed/x.csv",
    "s3a://bucket/landed/x y.csv": "s3://bucket/landed/x%20y.csv",
    "s3://bucket/landed/x.csv": "s3://bucket/landed/x.csv",
    "gs://bucket/landed/x+y.csv": "gs://bucket/landed/x%2By.csv",
    "abfss://box@account.dfs.core.windows.net/x.csv": "abfss://box@account.dfs.core.windows.net/x.csv",
}


def test_paths_of_known_stores(spark):
    assert {path: arrow_uri(path) for path in SPELLED} == SPELLED
    rows = spark.createDataFrame([(p,) for p in SPELLED], "path string").select("path", _uri(F.col("path")).alias("uri"))
    assert {r.path: r.uri for r in rows.collect()} == SPELLED


@pytest.mark.parametrize("path", ["wasbs://box@account/x.csv", "viewfs://store/x.csv", "ftp://host/x.csv"])
def test_unknown_stores_are_refused(spark, path):
    with pytest.raises(UnknownStore):
        arrow_uri(path)
    with pytest.raises(Exception, match="unknown store"):
        spark.createDataFrame([(path,)], "path string").select(_uri(F.col("path"))).collect()
