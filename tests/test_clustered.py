from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from plantmart.contracts import SOURCE, Column, Contract, catalogue, number
from plantmart.operators.filters import rolling_window
from plantmart.plans.warehouse import Warehouse
from tests.lab import Lab

CONTRACTS = catalogue(Contract("result", (number("id"), Column("day", "timestamp", None, False)), key=("id",)))
FIRST = datetime(2020, 1, 1)
AS_OF = FIRST + timedelta(days=2000)
N = 4000


def scanned(frame):
    """Rows that come out of the Parquet scan, after row groups were skipped."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    while plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    while plan.children().size():
        plan = plan.children().head()
    return plan.metrics().apply("numOutputRows").value()


@pytest.fixture
def lab(spark, tmp_path):
    lab = Lab(spark, tmp_path, CONTRACTS)
    for source in ("DKQ", "FOS"):
        days = [FIRST + timedelta(days=k * 7919 % N % 2000) if k % 10 else None for k in range(N)]
        # A third of all rows share one day.
        days = [datetime(2021, 6, 1) if k % 3 == 0 and d else d for k, d in enumerate(days)]
        lab.deliver(source, "RESULT", ["ID,DAY", *(f"{k},{d or ''}" for k, d in enumerate(days))])
    lab.configure()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield lab
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def recent(lab):
    return lab.warehouse().snapshot().recent("result", "day", AS_OF, months=3).select("id", "day", SOURCE)


def test_a_window_reads_few_rows_of_a_clustered_table(lab):
    lab.run()
    plain = lab.rows("result")
    expected = sorted(map(tuple, rolling_window(plain, "day", AS_OF, months=3).select("id", "day", SOURCE).collect()))
    assert scanned(recent(lab)) == 2 * N and sorted(map(tuple, recent(lab).collect())) == expected
    run = lab.run(clustered={"result": "day"})
    # Finding the ranges reads the rows too, but they are counted once.
    assert run.reload.loaded == {"result": 2 * N} and run.reload.per_source["result"] == {"DKQ": N, "FOS": N}
    rows = lab.rows("result")
    assert rows.columns == plain.columns and sorted(map(tuple, recent(lab).collect())) == expected and expected
    assert scanned(recent(lab)) <= N / 2
    # Other runs may leave the table as it is, or write it as delivered again.
    lab.run()
    assert sorted(map(tuple, recent(lab).collect())) == expected


def test_a_day_that_many_rows_share_is_many_files(lab):
    lab.run(clustered={"result": "day"})
    rows = lab.rows("result").withColumn("file", F.input_file_name())
    sizes = [r["count"] for r in rows.groupBy("file").count().collect()]
    assert sum(sizes) == 2 * N and max(sizes) < N / 4
    assert rows.where("day = '2021-06-01'").select("file").distinct().count() > 2


def test_a_column_that_the_contract_lacks_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="clustered"):
        Warehouse(spark, str(tmp_path), CONTRACTS, clustered={"result": "month"})

