import pytest
from pyspark.sql import functions as F

from plantmart.functions import names


def value(spark, expression, text):
    return spark.createDataFrame([(text,)], "x string").select(expression(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "name, stem",
    [
        ("SUPPLIES_prod_extract.csv.gz", "SUPPLIES"),
        ("SUPPLIES_QA_Extract.CSV.GZ", "SUPPLIES"),
        ("SUPPLIES_dev_extract.tsv", "SUPPLIES"),
        ("SUPPLIES.tsv.gz", "SUPPLIES"),
        ("SUPPLIES", "SUPPLIES"),
        ("supplies_prod_extract.csv", "supplies"),
        ("S_prod_extract_qa_extract.csv", "S_prod_extract"),
        ("S.csv.csv", "S.csv"),
        ("S.txt", "S.txt"),
        ("DKQ-S.csv.gz", "DKQ-S"),
    ],
)
def test_config_stem(spark, name, stem):
    assert value(spark, names.config_stem, name) == stem


@pytest.mark.parametrize(
    "path, source",
    [
        ("s3://b/landed/DKQ/T.csv", "DKQ"),
        ("s3://b/DKQ/T.csv", "DKQ"),
        ("s3://b/T.csv", None),
        ("file:/data/landed/FOS/T.csv", "FOS"),
        ("file:/T.csv", None),
    ],
)
def test_source_system(spark, path, source):
    assert value(spark, names.source_system, path) == source


@pytest.mark.parametrize(
    "uri, bucket, key",
    [
        ("s3://b/x/y", "b", "x/y"),
        ("s3://b/", "b", ""),
        ("s3://b", "b", ""),
        ("s3a://b/x/", "b", "x/"),
        ("/srv/x", "", "srv/x"),
        ("file:/srv/x", "", "srv/x"),
        ("file:///srv/x", "", "srv/x"),
    ],
)
def test_uri_parts(spark, uri, bucket, key):
    assert value(spark, names.uri_bucket, uri) == bucket
    assert value(spark, names.uri_key, uri) == key


def test_extract_path_folds_part_files(spark):
    assert value(spark, names.extract_path, "s3://b/DKQ/T.csv.gz/part-1.csv.gz") == "s3://b/DKQ/T.csv.gz"
    assert value(spark, names.extract_path, "s3://b/DKQ/T.csv.gz") == "s3://b/DKQ/T.csv.gz"
    assert value(spark, names.extract_path, "s3://b/DKQ/T.txt/part-1") == "s3://b/DKQ/T.txt/part-1"


def test_join_path_strips_trailing_slashes(spark):
    assert value(spark, lambda c: names.join_path("s3://b/x//", c), "t") == "s3://b/x/t"
    assert value(spark, names.base_name, "s3://b/x/") == ""
