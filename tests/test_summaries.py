import pytest
from pyspark.sql import functions as F

from plantmart.contracts import SOURCE, Contract, catalogue, flag, number, refers, text
from plantmart.operators.quality import check_tables, rows_per_source
from plantmart.plans.summaries import Summaries
from tests.lab import Lab

CONTRACTS = catalogue(
    Contract("product", (number("id"), text("name", 20)), key=("id",)),
    Contract(
        "sample", (number("id"), number("product_id"), flag("kind")), key=("id",),
        references=(refers("product_id", "product", "id"),), allowed=(("kind", ("F",)),),
    ),
    Contract("order", (number("id"),)),
)
PRODUCTS, SAMPLES = ["ID,NAME", "1,one", "2,two"], ["ID,PRODUCT_ID,KIND", "1,1,F", "1,2,G", "2,3,F"]


@pytest.fixture
def lab(spark, tmp_path):
    lab = Lab(spark, tmp_path, CONTRACTS)
    for source in ("DKQ", "FOS", "n w%1"):
        lab.deliver(source, "PRODUCT", PRODUCTS)
        lab.deliver(source, "SAMPLE", SAMPLES)
    lab.configure()
    lab.run(carry_unchanged=True)
    return lab


def kept(lab, contracts=CONTRACTS):
    return Summaries(lab.spark, f"{lab.zones.warehouse}/summaries", contracts)


def rows(frame):
    columns = sorted(frame.columns)
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)


def agrees(lab, summaries):
    snapshot = lab.warehouse().snapshot()
    assert rows(summaries.report(snapshot)) == rows(check_tables(snapshot.tables(), CONTRACTS))
    counted = [x for t in snapshot.published for x in rows(rows_per_source(snapshot.read(t), t))]
    assert rows(summaries.row_counts(snapshot)) == sorted(counted, key=repr)
    return snapshot


def test_first_report_counts_everything_and_the_next_nothing(lab):
    summaries = kept(lab)
    agrees(lab, summaries)
    found = {(r.table_name, r.rule, r[SOURCE]): r.violations for r in summaries.report(lab.warehouse().snapshot()).collect()}
    assert found["sample", "reference", "FOS"] == 1 and found["sample", "unique key", "n w%1"] == 1
    assert found["sample", "known source", "n w%1"] == 3 and found["product", "known source", "DKQ"] == 0
    assert kept(lab).update(lab.warehouse().snapshot()) == {}


@pytest.mark.parametrize("changed, recounted", (
    ({"SAMPLE": [*SAMPLES, "3,9,F"]}, {"sample": ["FOS"]}),
    ({"PRODUCT": [*PRODUCTS, "3,three"]}, {"product": ["FOS"], "sample": ["FOS"]}),
    ({"SAMPLE": SAMPLES[:1]}, {"sample": ["FOS"]}),
    ({"ORDER": ["ID", "1"]}, {"order": ["FOS"]}),
))
def test_one_source_changed(lab, changed, recounted):
    summaries = kept(lab)
    summaries.update(lab.warehouse().snapshot())
    for table, lines in changed.items():
        lab.deliver("FOS", table, lines)
    lab.configure()
    lab.run(carry_unchanged=True)
    assert kept(lab).update(lab.warehouse().snapshot()) == recounted
    snapshot = agrees(lab, summaries)
    gone = summaries.retire(snapshot)
    assert len(gone) == sum(t != "order" for t in recounted)
    assert kept(lab).update(snapshot) == {} and summaries.retire(snapshot) == []


def test_only_the_changed_source_is_scanned(lab):
    snapshot = lab.warehouse().snapshot()
    plan = kept(lab).counted(snapshot, {"sample": ["FOS"]})._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("PartitionFilters: [" in line and "= FOS)" in line for line in scans)


def test_a_changed_contract_and_an_unknown_state_are_counted_anew(lab):
    kept(lab).update(lab.warehouse().snapshot())
    product = CONTRACTS["product"]
    other = {**CONTRACTS, "product": Contract("product", product.columns, ())}
    assert kept(lab, other).update(lab.warehouse().snapshot()) == {"product": ["DKQ", "FOS", "n w%1"]}
    # A plain reload does not say what the raw zone held.
    assert lab.warehouse().reload(lab.zone(), "product").status == 200
    summaries = kept(lab)
    snapshot = lab.warehouse().snapshot()
    assert summaries.update(snapshot) == {}
    assert summaries.report(snapshot).where(F.col("table_name") == "sample").count() > 0
    agrees(lab, summaries)


def test_a_load_that_broke_off_is_completed(lab, monkeypatch):
    from plantmart import storage

    publish, written = storage.publish_text, []

    def breaking(spark, path, text):
        if len(written) == 2:
            raise OSError("no space")
        written.append(path)
        publish(spark, path, text)

    monkeypatch.setattr(storage, "publish_text", breaking)
    with pytest.raises(OSError):
        kept(lab).update(lab.warehouse().snapshot())
    monkeypatch.undo()
    left = kept(lab).update(lab.warehouse().snapshot())
    assert sum(len(s) for s in left.values()) == 4
    agrees(lab, kept(lab))


def test_without_tables(spark, tmp_path):
    lab = Lab(spark, tmp_path, CONTRACTS)
    assert kept(lab).report(lab.warehouse().snapshot()).count() == 0
