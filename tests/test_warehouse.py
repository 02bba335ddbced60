import json
import os
import time

import pytest

from plantmart import storage
from plantmart.lab_tables import LAB_TABLES
from plantmart.plans.daily_run import ingest_landing, survey_landing
from plantmart.plans.warehouse import LoadFailed, ReloadResult, require_success, session_identity
from tests.lab import AT, DELIVERY, Lab


@pytest.fixture
def lab(spark, tmp_path):
    lab = Lab(spark, tmp_path)
    lab.configure()
    return lab


def ingest(lab):
    ingest_landing(lab.zone(), survey_landing(lab.spark, lab.zones), lab.contracts, AT)


def reload(lab, table=None, **options):
    return lab.warehouse().reload(lab.zone(), table, **options)


def identities(lab, table):
    return sorted((r.source, r[0]) for r in lab.rows(table).collect())


def test_full_reload(lab):
    lab.deliver_all("DKQ")
    ingest(lab)
    result = reload(lab)
    assert result.status == 200 and result.skipped == []
    assert result.loaded == {t.lower(): len(lines) - 1 for t, lines in DELIVERY.items()}
    for name, contract in LAB_TABLES.items():
        assert lab.rows(name).schema.simpleString() == contract.schema.simpleString()
    assert identities(lab, "fournisseur") == [("DKQ", "Bœuf & Cie €"), ("DKQ", "F1")]
    assert {r.analysis_version for r in lab.rows("versioned_analysis").collect()} == {1, 2}


def test_reload_twice_equals_once(lab):
    lab.deliver_all("DKQ")
    ingest(lab)
    first = reload(lab)
    rows = sorted(map(tuple, lab.rows("phrase").collect()))
    second = reload(lab)
    assert second.loaded == first.loaded
    assert sorted(map(tuple, lab.rows("phrase").collect())) == rows


def test_undelivered_tables_are_skipped_and_keep_their_rows(lab):
    lab.deliver("DKQ", "CUSTOMER", ["IDENTITY", "C1"])
    ingest(lab)
    result = reload(lab)
    assert result.loaded == {"customer": 1} and len(result.skipped) == 15
    report = {r.table_name: r for r in result.report(lab.spark).collect()}
    assert report["customer"].row_count == 1 and report["sample"].status == "skipped"
    assert report["customer"].run_database == "default" and report["customer"].run_by


def test_unknown_table_is_refused(lab):
    result = reload(lab, "nothing")
    assert (result.status, result.loaded) == (400, {})
    assert lab.warehouse().published() == {}
    with pytest.raises(LoadFailed, match="400"):
        require_success(result)


def test_single_table_reload(lab):
    for table in ("CUSTOMER", "SAMPLE"):
        lab.deliver("DKQ", table, DELIVERY[table])
    ingest(lab)
    reload(lab)
    lab.deliver("DKQ", "CUSTOMER", ["IDENTITY", "C9"])
    lab.deliver("DKQ", "SAMPLE", ["ID_NUMERIC", "9"])
    ingest(lab)
    assert reload(lab, "customer").loaded == {"customer": 1}
    assert identities(lab, "customer") == [("DKQ", "C9")]
    assert identities(lab, "sample") == [("DKQ", 501), ("DKQ", 502)]


def test_failure_publishes_nothing(lab):
    lab.deliver("DKQ", "CUSTOMER", DELIVERY["CUSTOMER"])
    lab.deliver("DKQ", "SAMPLE", DELIVERY["SAMPLE"])
    ingest(lab)
    reload(lab)
    before = lab.warehouse().published()
    lab.deliver("DKQ", "CUSTOMER", ["IDENTITY", "C9"])
    lab.deliver("DKQ", "SAMPLE", ["ID_NUMERIC", "1", "12x"])
    ingest(lab)
    result = reload(lab)
    assert result.status == 500 and "12x" in result.message and result.loaded == {}
    assert lab.warehouse().published() == before
    assert identities(lab, "customer") == [("DKQ", "C1"), ("DKQ", "C2")]
    (failed,) = result.report(lab.spark).collect()
    assert (failed.status, failed.status_code) == ("failed", 500)


@pytest.mark.parametrize("blank", ["", '""'])
def test_blank_in_required_column_fails(lab, blank):
    lab.deliver("DKQ", "PHRASE", ["PHRASE_ID,PHRASE_TYPE", f"G1,{blank}", "G2,GRANULO"])
    ingest(lab)
    result = reload(lab, "phrase")
    assert result.status == 500
    assert result.message == "phrase: NULL in required columns {'phrase_type': 1}"


def test_column_missing_everywhere_fails(lab):
    lab.deliver("DKQ", "MLP_HEADER", ["IDENTITY,PRODUCT_VERSION", "P1,1"])
    ingest(lab)
    result = reload(lab, "mlp_header")
    assert result.status == 500 and "entry_code" in result.message


def test_required_column_missing_in_one_source_fails(lab):
    lab.deliver("DKQ", "PHRASE", ["PHRASE_ID,PHRASE_TYPE", "G1,GRANULO"])
    lab.deliver("FOS", "PHRASE", ["PHRASE_ID", "G2"])
    ingest(lab)
    assert reload(lab, "phrase").message == "phrase: NULL in required columns {'phrase_type': 1}"


def test_long_text_is_cut_and_counted(lab):
    lab.deliver("DKQ", "CUSTOMER", ["IDENTITY", "é" * 51, "é" * 50])
    ingest(lab)
    result = reload(lab, "customer")
    assert result.cut_values == {"customer": {"identity": 1}}
    assert identities(lab, "customer") == [("DKQ", "é" * 50)] * 2


def test_repeated_keys_load_unless_strict(lab):
    lab.deliver("DKQ", "CUSTOMER", ["IDENTITY", "C1", "C1"])
    lab.deliver("FOS", "CUSTOMER", ["IDENTITY", "C1"])
    ingest(lab)
    strict = reload(lab, "customer", strict_keys=True)
    assert strict.status == 500 and "repeated keys {'DKQ': 1}" in strict.message
    relaxed = reload(lab, "customer")
    assert relaxed.loaded == {"customer": 3}
    assert relaxed.per_source == {"customer": {"DKQ": 2, "FOS": 1}}


def test_records_are_numbered_and_published_once(lab):
    lab.deliver("DKQ", "CUSTOMER", DELIVERY["CUSTOMER"])
    ingest(lab)
    for run in ("r1", "r2"):
        assert reload(lab, run_id=run).status == 200
    names = storage.child_names(lab.spark, f"{lab.zones.warehouse}/published")
    assert names == ["0000000001.json", "0000000002.json"]
    record = json.loads(storage.read_text(lab.spark, f"{lab.zones.warehouse}/published/{names[-1]}"))
    assert record["run_id"] == "r2" and record["tables"]["customer"]["rows"] == 2
    with pytest.raises(FileExistsError):
        storage.publish_text(lab.spark, f"{lab.zones.warehouse}/published/{names[0]}", "{}")


def test_snapshot_outlives_later_loads(lab):
    lab.deliver("DKQ", "CUSTOMER", ["IDENTITY", "C1"])
    ingest(lab)
    reload(lab)
    snapshot = lab.warehouse().snapshot()
    lab.deliver("DKQ", "CUSTOMER", ["IDENTITY", "C2"])
    ingest(lab)
    reload(lab)
    assert [r.identity for r in snapshot.read("customer").collect()] == ["C1"]
    assert [r.identity for r in lab.rows("customer").collect()] == ["C2"]


def test_retire_keeps_what_records_need(lab):
    lab.deliver("DKQ", "CUSTOMER", DELIVERY["CUSTOMER"])
    lab.deliver("DKQ", "SAMPLE", DELIVERY["SAMPLE"])
    ingest(lab)
    reload(lab, run_id="r1")
    for run in ("r2", "r3", "r4"):
        reload(lab, "customer", run_id=run)
    assert lab.warehouse().retire(keep=2) == ["r2"]
    assert sorted(os.listdir(f"{lab.zones.warehouse}/runs")) == ["r1", "r3", "r4"]
    assert identities(lab, "sample") == [("DKQ", 501), ("DKQ", 502)]
    assert lab.warehouse().retire(keep=2) == []


def test_views_and_identity(lab):
    for source in ("DKQ", "FOS"):
        lab.deliver(source, "CUSTOMER", ["IDENTITY", "C1"])
    ingest(lab)
    reload(lab)
    lab.warehouse().snapshot().create_views("v_")
    assert lab.spark.sql("SELECT count(*) FROM v_customer").first()[0] == 2
    assert session_identity(lab.spark).first().run_database == "default"


def test_temporary_views_are_no_delivery(lab):
    lab.spark.range(1).createOrReplaceTempView("location")
    lab.deliver("a'source with a long name", "CUSTOMER", ["IDENTITY", "C1"])
    ingest(lab)
    result = reload(lab)
    assert result.loaded == {"customer": 1}
    assert result.per_source == {"customer": {"a'source w": 1}}
    lab.spark.catalog.dropTempView("location")


def test_width_bounds(lab):
    lab.deliver("DKQ", "PHRASE", DELIVERY["PHRASE"])
    ingest(lab)
    reload(lab)
    snapshot = lab.warehouse().snapshot()
    assert snapshot.lookup_bytes("phrase", ["phrase_id"]) == 2 * (16 + 200 + 16 + 40 + 8)
    assert snapshot.lookup_bytes("phrase", ["phrase_id", "phrase_type"]) > snapshot.lookup_bytes("phrase", ["phrase_id"])


def test_success_passes_the_gate():
    ok = ReloadResult("r", 200)
    assert require_success(ok) is ok


def test_sources_that_would_merge_fail_the_reload(lab):
    for source in ("LABORATORY1", "LABORATORY2"):
        lab.deliver(source, "CUSTOMER", ["IDENTITY", "C1"])
    ingest(lab)
    result = reload(lab)
    assert result.status == 500 and "equal in 10 characters" in result.message
    assert lab.warehouse().published() == {}


def test_retire_spares_a_load_that_has_not_published(lab):
    lab.deliver("DKQ", "CUSTOMER", DELIVERY["CUSTOMER"])
    ingest(lab)
    for run in ("r1", "r2"):
        reload(lab, run_id=run)
    time.sleep(1.1)
    os.makedirs(f"{lab.zones.warehouse}/runs/going-on/customer")
    assert lab.warehouse().retire(keep=1) == ["r1"]
    assert sorted(os.listdir(f"{lab.zones.warehouse}/runs")) == ["going-on", "r2"]


# Publishing and registering


def in_catalog(lab, table="customer"):
    return sorted(r[0] for r in lab.spark.table(f"{lab.zones.database}_dw.{table}").collect())


def catalogued(lab):
    return lab.warehouse(f"{lab.zones.database}_dw")


def load(lab, lines, warehouse, **options):
    lab.deliver("DKQ", "CUSTOMER", lines)
    ingest(lab)
    return warehouse.reload(lab.zone(), "customer", **options)


def test_failing_registration_is_a_warning_and_repaired(lab, monkeypatch):
    warehouse = catalogued(lab)
    assert load(lab, ["IDENTITY", "C1"], warehouse).warnings == []
    assert in_catalog(lab) == ["C1"] and warehouse.behind() == []

    def fail(table, path):
        raise RuntimeError("no catalog today\nsecond line")

    monkeypatch.setattr(warehouse, "_follow", fail)
    second = load(lab, ["IDENTITY", "C2"], warehouse)
    assert (second.status, second.loaded) == (200, {"customer": 1})
    assert second.warnings == ["customer is not registered: no catalog today"]
    assert [r.message for r in second.report(lab.spark).collect() if r.status == "warning"] == second.warnings
    # The record counts: readers see the new rows, the external table the old ones, and no run folder goes.
    assert identities(lab, "customer") == [("DKQ", "C2")] and in_catalog(lab) == ["C1"]
    assert warehouse.behind() == ["customer"] and warehouse.retire(keep=1) == []
    monkeypatch.undo()
    lab.deliver("DKQ", "SAMPLE", DELIVERY["SAMPLE"])
    ingest(lab)
    assert warehouse.reload(lab.zone(), "sample").warnings == []
    assert in_catalog(lab) == ["C2"] and warehouse.behind() == []


def test_failing_publish_keeps_the_old_record(lab, monkeypatch):
    warehouse = catalogued(lab)
    load(lab, ["IDENTITY", "C1"], warehouse)

    def refuse(*_):
        raise OSError("disk full")

    with monkeypatch.context() as patch:
        patch.setattr(storage, "publish_text", refuse)
        result = load(lab, ["IDENTITY", "C2"], warehouse)
    assert (result.status, result.message) == (500, "disk full")
    assert identities(lab, "customer") == [("DKQ", "C1")] and in_catalog(lab) == ["C1"]

    # The record appears, but the store fails to say so.
    publish = storage.publish_text

    def silent(*args):
        publish(*args)
        raise OSError("connection lost")

    with monkeypatch.context() as patch:
        patch.setattr(storage, "publish_text", silent)
        assert load(lab, ["IDENTITY", "C3"], warehouse).status == 200
    assert identities(lab, "customer") == [("DKQ", "C3")] and in_catalog(lab) == ["C3"]


def test_external_tables_are_never_dropped(lab, monkeypatch):
    said = []
    run = type(lab.spark).sql
    monkeypatch.setattr(type(lab.spark), "sql", lambda self, text, *a, **k: said.append(text) or run(self, text, *a, **k))
    warehouse = catalogued(lab)
    for lines in (["IDENTITY", "C1"], ["IDENTITY", "C1", "C2"]):
        load(lab, lines, warehouse)
    assert in_catalog(lab) == ["C1", "C2"]
    assert not [text for text in said if "DROP" in text.upper()]
    assert sum("SET LOCATION" in text for text in said) == 1


def test_declared_columns_follow_the_contract(lab):
    from dataclasses import replace

    from plantmart.contracts import Column, number

    load(lab, ["IDENTITY", "C1"], catalogued(lab))
    old = lab.contracts["customer"]
    lab.contracts = {**lab.contracts, "customer": replace(old, columns=(*old.columns, Column("town", "text", 20, required=False)))}
    assert load(lab, ["IDENTITY,TOWN", "C2,Lyon"], catalogued(lab)).warnings == []
    row = lab.spark.table(f"{lab.zones.database}_dw.customer").first()
    assert (row.identity, row.town, row.source) == ("C2", "Lyon", "DKQ")
    lab.contracts = {**lab.contracts, "customer": replace(old, columns=(number("identity"),))}
    result = load(lab, ["IDENTITY", "3"], catalogued(lab))
    assert result.status == 200 and "other columns" in result.warnings[0]


def test_withheld_metrics_fail_unless_there_are_no_rows(lab, monkeypatch):
    from plantmart.plans import warehouse as module

    class Silent(module.Observation):
        get = property(lambda self: {name: None for name in super(Silent, self).get})

    with monkeypatch.context() as patch:
        patch.setattr(module, "Observation", Silent)
        result = load(lab, ["IDENTITY", "C1"], lab.warehouse())
        assert result.status == 500 and "not counted" in result.message
        assert lab.warehouse().published() == {}
        lab.deliver("DKQ", "CUSTOMER", ["IDENTITY"])
        ingest(lab)
        assert lab.warehouse().reload(lab.zone(), "customer").loaded == {"customer": 0}
