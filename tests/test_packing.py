"""How delivered extracts are packed."""

from __future__ import annotations

import gzip
import pathlib

from reconcile.site import Site


def test_extracts_are_packed_fast(spark, tmp_path):
    site = Site(spark, str(tmp_path))
    site.deliver(spark.range(30_000).selectExpr("id", "id * 37 AS n", "concat('name ', id % 91) AS name").coalesce(1), "FOS", "t")
    (part,) = pathlib.Path(f"{site.zones.landed}/FOS/T_prod_extract.csv.gz").glob("part-*.gz")
    rows = gzip.decompress(part.read_bytes())
    assert rows.count(b"\n") == 30_001
    assert part.stat().st_size > 1.05 * len(gzip.compress(rows, 6))
