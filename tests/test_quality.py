from datetime import datetime

from pyspark.sql import functions as F

from plantmart.contracts import Contract, flag, number, refers, text
from plantmart.lab_tables import GRANULOMETRY_TYPE, LAB_TABLES
from plantmart.operators.filters import (
    format_phrases,
    monthly_rows,
    of_type,
    rolling_window,
    without_excluded,
)
from plantmart.operators.quality import (
    check_keys,
    check_raw,
    check_reference,
    check_rows,
    check_tables,
    duplicate_keys,
    rows_per_source,
    schema_differences,
    undeclared_columns,
)

CONTRACT = Contract(
    "t", (number("id"), flag("kind"), text("note", 3, required=False)), key=("id",),
    allowed=(("kind", ("F",)),),
)


def typed(spark, *rows):
    return spark.createDataFrame(rows, "id bigint, kind string, note string, source string")


def broken(frame):
    return {(r.rule, r.column_name, r.source): r.violations for r in frame.collect() if r.violations}


def test_row_rules(spark):
    rows = typed(
        spark, (1, "F", None, "DKQ"), (None, "F", "x", "DKQ"), (2, "G", "x", "FOS"), (3, None, "x", "OLD"),
        (4, "F", "x", None),
    )
    assert broken(check_rows(rows, CONTRACT)) == {
        ("not null", "id", "DKQ"): 1,
        ("allowed values", "kind", "FOS"): 1,
        ("not null", "kind", "OLD"): 1,
        ("known source", "source", "OLD"): 1,
        ("known source", "source", None): 1,
    }


def test_row_checks_are_one_aggregation(spark):
    rows = typed(spark, (1, "F", None, "DKQ"))
    plan = check_rows(rows, CONTRACT)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_raw_rules(spark):
    rows = spark.createDataFrame(
        [("1x", "FF", "abcd", "DKQ"), (" 1 ", "F", "abc", "DKQ"), ("", None, None, "DKQ")],
        "id string, kind string, note string, source string",
    )
    assert broken(check_raw(rows, CONTRACT)) == {
        ("malformed", "id", "DKQ"): 1, ("length", "kind", "DKQ"): 1, ("length", "note", "DKQ"): 1
    }


def test_keys_are_scoped_by_source(spark):
    rows = typed(spark, (1, "F", "a", "DKQ"), (1, "F", "b", "FOS"), (2, "F", "a", "FOS"), (2, "F", "b", "FOS"), (2, "F", "b", "FOS"))
    assert [tuple(r) for r in duplicate_keys(rows, ["id"]).collect()] == [(2, "FOS", 3)]
    assert {tuple(r) for r in duplicate_keys(rows, ["id"], per_source=False).collect()} == {(1, 2), (2, 3)}
    assert broken(check_keys(rows, CONTRACT)) == {("unique key", "id", "FOS"): 2}


def test_references(spark):
    child = spark.createDataFrame(
        [("a", 1, "DKQ"), ("a", 1, "FOS"), ("b", 1, "DKQ"), ("a", None, "DKQ"), (None, 1, "DKQ")],
        "x string, v bigint, source string",
    )
    parent = spark.createDataFrame([("a", 1, "DKQ"), ("a", 2, "DKQ"), ("c", 1, "FOS")], "id string, ver bigint, source string")
    both = refers("x v", "p", "id ver")
    assert broken(check_reference(child, parent, "t", both)) == {
        ("reference", "x, v -> p", "FOS"): 1, ("reference", "x, v -> p", "DKQ"): 1
    }
    assert broken(check_reference(child, parent, "t", both, per_source=False)) == {("reference", "x, v -> p", "DKQ"): 1}
    partial = refers("x", "p", "id")
    assert broken(check_reference(child, parent, "t", partial)) == {
        ("reference", "x -> p", "FOS"): 1, ("reference", "x -> p", "DKQ"): 1
    }


def test_all_checks_together(spark):
    analysis = spark.createDataFrame(
        [("A1", 1, "DKQ"), ("A1", 1, "DKQ")], "identity string, analysis_version bigint, source string"
    )
    component = spark.createDataFrame(
        [("n", "A1", 1, "DKQ"), ("n", "A2", 1, "DKQ")], "name string, analysis string, analysis_version bigint, source string"
    )
    tables = {"versioned_analysis": analysis, "versioned_component": component}
    assert broken(check_tables(tables, LAB_TABLES)) == {
        ("unique key", "identity, analysis_version", "DKQ"): 1,
        ("reference", "analysis, analysis_version -> versioned_analysis", "DKQ"): 1,
    }


def test_rows_per_source(spark):
    rows = typed(spark, (1, "F", "a", "DKQ"), (2, "F", "a", "OLD"), (3, "F", "a", None))
    found = {r.source: (r.row_count, r.unknown_source_rows) for r in rows_per_source(rows, "t").collect()}
    assert found == {"DKQ": (1, 0), "OLD": (1, 1), None: (1, 1)}


def test_schema_differences(spark):
    actual = spark.createDataFrame([], "ID bigint, note int, more string, source string, last_updated_at timestamp_ntz").schema
    assert schema_differences(actual, CONTRACT.schema) == [
        ("kind", "missing", "string"), ("more", "extra", "string"), ("note", "type", "int instead of string")
    ]
    assert schema_differences(CONTRACT.schema, CONTRACT.schema) == []
    raw = spark.createDataFrame([], "id string, more string, source string, last_updated_at timestamp")
    assert undeclared_columns(raw, CONTRACT) == ["more"]


def test_excluded_rows_go_and_null_flags_stay(spark):
    values = ["V", "X", "x", None]
    rows = [(a, b, c) for a in values for b in values for c in values]
    frame = spark.createDataFrame(rows, "status string, result_status string, test_status string")
    kept = [tuple(r) for r in without_excluded(frame).collect()]
    assert sorted(kept, key=str) == sorted([r for r in rows if "X" not in r], key=str)


def test_phrase_and_monthly_filters(spark):
    phrases = spark.createDataFrame([("a", "GRANULO"), ("b", "FORMAT"), ("c", None)], "phrase_id string, phrase_type string")
    assert [r[0] for r in of_type(phrases, GRANULOMETRY_TYPE).collect()] == ["a"]
    assert [r[0] for r in format_phrases(phrases).collect()] == ["b"]
    months = spark.createDataFrame([("F",), ("T",), (None,)], "annuel string")
    assert monthly_rows(months).count() == 1


def test_rolling_window_bounds_and_pushdown(spark, tmp_path):
    rows = spark.createDataFrame(
        [("2024-02-28 10:00:00",), ("2024-02-29 10:00:00",), ("2024-02-29 10:00:01",), ("2026-02-28 10:00:00",)], "t string"
    ).select(F.col("t").cast("timestamp_ntz").alias("t"))
    kept = rolling_window(rows, "t", datetime(2026, 2, 28, 10, 0, 0))
    assert kept.count() == 3
    assert rolling_window(rows, "t", datetime(2026, 2, 28, 10, 0, 0), months=1).count() == 1
    rows.write.parquet(str(tmp_path / "t"))
    scan = rolling_window(spark.read.parquet(str(tmp_path / "t")), "t", datetime(2026, 2, 28))
    assert "GreaterThan(t,2024-02-28T00:00)" in scan._jdf.queryExecution().executedPlan().toString()


def test_small_and_missing_parents_take_one_pass_over_the_child(spark, tmp_path):
    keys = spark.range(50).selectExpr("CAST(id AS STRING) AS identity", "'DKQ' AS source")
    child = Contract(
        "child", (text("a", 9), text("b", 9), text("c", 9)),
        references=(refers("a", "small", "identity"), refers("b", "missing", "identity"), refers("c", "large", "identity")),
    )
    parent = (text("identity", 9),)
    contracts = {"child": child, "small": Contract("small", parent), "large": Contract("large", parent)}
    rows = spark.range(100).selectExpr(
        "CAST(id AS STRING) AS a", "IF(id < 10, NULL, 'x') AS b", "CAST(id + 20 AS STRING) AS c",
        "IF(id % 2 = 0, 'DKQ', 'FOS') AS source",
    )
    tables = {}
    for name, frame in {"child": rows, "small": keys, "large": keys}.items():
        frame.write.parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))
    report = check_tables(tables, contracts, size_of=lambda table, columns: 1000 if table == "small" else None)
    found = {(r.rule, r.column_name, r.source): r.violations for r in report.collect() if r.table_name == "child"}
    assert found["reference", "a -> small", "DKQ"] == 25 and found["reference", "a -> small", "FOS"] == 50
    assert found["reference", "b -> missing", "DKQ"] == 45 and found["reference", "b -> missing", "FOS"] == 45
    assert found["reference", "c -> large", "DKQ"] == 35 and found["reference", "c -> large", "FOS"] == 50
    assert found["known source", "source", "DKQ"] == 0
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [a#") == 2
