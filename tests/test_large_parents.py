"""References to parents of any size."""

from __future__ import annotations

from plantmart.contracts import refers
from plantmart.operators.quality import check_reference


def test_keys_meet_in_one_aggregate(spark):
    child = spark.createDataFrame(
        [(1, "DKQ"), (1, "DKQ"), (2, "DKQ"), (None, "DKQ"), (1, "FOS"), (3, None)], "k int, source string"
    )
    parent = spark.createDataFrame([(1, "DKQ"), (1, "DKQ"), (None, "DKQ"), (7, "XYZ")], "id bigint, source string")
    found = check_reference(child, parent, "t", refers("k", "p", "id"))
    assert {(r.source, r.violations) for r in found.collect()} == {("DKQ", 1), ("FOS", 1), (None, 0)}
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
