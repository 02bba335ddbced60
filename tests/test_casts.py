import pytest
from pyspark.sql import functions as F

from plantmart.contracts import Column, Contract, flag, number, text
from plantmart.functions.casts import cast_expr, contract_projection, malformed, overlong


def raw(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "x string")


def cast(spark, column, *values):
    return [r[0] for r in raw(spark, *values).select(cast_expr(column)).collect()]


def test_bigint_is_trimmed_and_blank_is_null(spark):
    assert cast(spark, number("x"), " 2 ", "", "   ", None, "-7", "9223372036854775807") == [
        2, None, None, None, -7, 9223372036854775807
    ]


@pytest.mark.parametrize("bad", ["12x", "1.5", "9223372036854775808", "1 2"])
def test_malformed_bigint_fails(spark, bad):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cast(spark, number("x"), "1", bad)


def test_text_is_cut_in_characters_not_bytes(spark):
    assert cast(spark, text("x", 3), "éœ€x", "ab", "", None) == ["éœ€", "ab", "", None]
    assert cast(spark, flag("x"), "FX", "F", " F") == ["F", "F", " "]
    assert cast(spark, text("x"), "any length" * 50) == ["any length" * 50]


def test_text_is_not_trimmed(spark):
    assert cast(spark, text("x", 10), "  a ") == ["  a "]


def test_rename_and_reserved_names(spark):
    rows = spark.createDataFrame([("a", "1")], "ENTRY_CODE string, `select` string")
    out = rows.select(cast_expr(text("identity", 5, extract="entry_code")), cast_expr(number("select")))
    assert out.columns == ["identity", "select"]
    assert out.first() == ("a", 1)


def test_other_types_take_the_generic_cast(spark):
    assert cast(spark, Column("x", "double"), "1.5", None) == [1.5, None]
    moment = cast(spark, Column("x", "timestamp"), "2026-01-02 03:04:05.123456")[0]
    assert moment.microsecond == 123456


def test_projection_keeps_declared_order_and_adds_audit_columns(spark):
    contract = Contract("t", (text("b", 2), number("a")))
    rows = spark.createDataFrame(
        [("1", "xyz", "w", "a source of names", None)],
        "a string, b string, other string, source string, last_updated_at timestamp",
    )
    out = rows.select(*contract_projection(contract))
    assert out.columns == ["b", "a", "source", "last_updated_at"]
    assert out.first() == ("xy", 1, "a source o", None)
    assert out.schema.simpleString() == contract.schema.simpleString()


def test_diagnostics_do_not_fail(spark):
    rows = raw(spark, "12x", " 3 ", "", None, "1.5")
    flags = [r[0] for r in rows.select(malformed(number("x"))).collect()]
    assert flags == [True, False, False, False, True]
    cut = [r[0] for r in raw(spark, "abc", "ab", None).select(overlong(text("x", 2))).collect()]
    assert cut == [True, False, False]


def test_tabs_are_not_spaces(spark):
    assert raw(spark, "\t").select(malformed(number("x"))).first()[0] is True
    assert raw(spark, "\t").select(F.trim("x")).first()[0] == "\t"
