"""The full historical load: it goes on where it broke off, and reads nothing twice."""

import json
import os

import pytest

from plantmart.plans import backfill as module
from plantmart.plans.backfill import BROKEN, CARRIED, INGESTED, BackfillBroken, backfill
from plantmart.plans.daily_run import daily_run, ledger_of
from plantmart.plans.ledger import Ledger
from tests.lab import AT, DELIVERY, Lab


@pytest.fixture
def lab(spark, tmp_path):
    lab = Lab(spark, tmp_path)
    lab.configure()
    for source in ("DKQ", "FOS"):
        for table in ("CUSTOMER", "PHRASE"):
            lab.deliver(source, table, DELIVERY[table])
    return lab


def load(lab, **options):
    return backfill(lab.spark, lab.zones, lab.contracts, loaded_at=AT, **options)


def outcomes(result):
    return {(o.table, o.source): o.outcome for o in result.outcomes}


@pytest.fixture
def scanned(monkeypatch):
    """The extracts that are read, in the order in which that happens."""
    seen = []
    ingest = module.ingest_table

    def watched(zone, table, entries, *rest):
        seen.extend((table, e.job.source_system) for e in entries)
        return ingest(zone, table, entries, *rest)

    monkeypatch.setattr(module, "ingest_table", watched)
    return seen


def test_a_broken_load_resumes(lab, scanned):
    bad = lab.deliver("FOS", "CUSTOMER", DELIVERY["CUSTOMER"])
    good = open(bad, "rb").read()
    with open(bad, "wb") as out:
        out.write(b"this is no gzip")
    with pytest.raises(BackfillBroken, match="1 of 4 extracts failed, first customer of FOS") as raised:
        load(lab)
    assert sorted(outcomes(raised.value.result).values()) == [BROKEN, INGESTED, INGESTED, INGESTED]
    assert lab.warehouse().published() == {} and len(scanned) == 4
    with open(bad, "wb") as out:
        out.write(good)
    scanned.clear()
    result = load(lab)
    assert scanned == [("customer", "FOS")]
    assert [o for k, o in sorted(outcomes(result).items())] == [CARRIED, INGESTED, CARRIED, CARRIED]
    assert lab.rows("customer").count() == 4 and result.reload.loaded["phrase"] == 2 * (len(DELIVERY["PHRASE"]) - 1)
    report = {(r.table_name, r.source): r.row_count for r in result.report(lab.spark).collect()}
    assert report["customer", "DKQ"] == 2


def test_only_what_changed_is_loaded_again(lab, scanned):
    load(lab)
    scanned.clear()
    later = AT.replace(year=AT.year + 1)
    lab.deliver("DKQ", "CUSTOMER", ["IDENTITY", "C7"])
    backfill(lab.spark, lab.zones, lab.contracts, loaded_at=later)
    assert scanned == [("customer", "DKQ")]
    rows = lab.rows("customer").collect()
    assert sorted((r.source, r.identity) for r in rows) == [("DKQ", "C7"), ("FOS", "C1"), ("FOS", "C2")]
    # A carried extract keeps its time of load.
    assert {r.source: r.last_updated_at.year for r in rows} == {"DKQ": later.year, "FOS": AT.year}


def test_a_run_that_stops_while_it_ingests_leaves_no_record(lab, scanned, monkeypatch):
    load(lab)
    lab.deliver("DKQ", "CUSTOMER", ["IDENTITY", "C7"])
    with monkeypatch.context() as patch:
        patch.setattr(Ledger, "finish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(BackfillBroken, match="lost"):
            load(lab)
    assert ("customer", "DKQ") not in ledger_of(lab.spark, lab.zones).finished()
    # The old files come back with their old times: the raw zone has other rows, so they are read again.
    scanned.clear()
    load(lab)
    assert scanned == [("customer", "DKQ")]


def test_records_without_their_extract_do_not_count(lab, scanned):
    load(lab)
    ledger = ledger_of(lab.spark, lab.zones)
    one = ledger.finished()["phrase", "FOS"]
    assert one.rows == len(DELIVERY["PHRASE"]) - 1 and one.malformed == 0
    path = ledger._path("phrase", "FOS")
    with open(path, "w") as out:
        out.write(json.dumps({"table": "phrase"})[:-3])
    os.remove(f"{os.path.dirname(path)}/.FOS.json.crc")
    leaf = lab.zone().leaf("customer", "DKQ")
    for name in os.listdir(leaf):
        os.remove(f"{leaf}/{name}")
    os.rmdir(leaf)
    assert ("phrase", "FOS") not in ledger.finished()
    scanned.clear()
    load(lab)
    assert sorted(scanned) == [("customer", "DKQ"), ("phrase", "FOS")]


def test_a_daily_run_carries_what_did_not_change(lab):
    lab.run(carry_unchanged=True)
    folders = {t: p.path for t, p in lab.warehouse().published().items()}
    later = AT.replace(year=AT.year + 1)
    lab.deliver("FOS", "CUSTOMER", ["IDENTITY", "C9"])

    def again(**options):
        return daily_run(lab.spark, lab.zones, lab.contracts, loaded_at=later, **options)

    run = again(carry_unchanged=True)
    assert [(i.table, i.source, i.rows) for i in run.ingested] == [("customer", "FOS", 1)]
    assert sorted(run.carried) == [("customer", "DKQ"), ("phrase", "DKQ"), ("phrase", "FOS")]
    assert run.reload.carried == {"phrase": 2 * (len(DELIVERY["PHRASE"]) - 1)} and set(run.reload.loaded) == {"customer"}
    statuses = {r.table_name: r.status for r in run.report().collect() if r.status in ("carried", "loaded")}
    assert statuses == {"customer": "loaded", "phrase": "carried"}
    now = {t: p.path for t, p in lab.warehouse().published().items()}
    assert now["phrase"] == folders["phrase"] and now["customer"] != folders["customer"]
    assert {(r.source, r.last_updated_at.year) for r in lab.rows("customer").collect()} == {("DKQ", AT.year), ("FOS", later.year)}
    # Without the option everything is read and rewritten, as always.
    whole = again()
    assert len(whole.ingested) == 4 and whole.carried == [] and whole.reload.carried == {}
    assert {r.last_updated_at.year for r in lab.rows("phrase").collect()} == {later.year}
    assert again(carry_unchanged=True).reload.loaded == {}


def test_an_unknown_state_is_loaded_again(lab):
    """Raw rows that no ledger knows, such as those of a run before there was one."""
    from plantmart.plans.daily_run import ingest_landing, survey_landing

    ingest_landing(lab.zone(), survey_landing(lab.spark, lab.zones), lab.contracts, AT)
    lab.warehouse().reload(lab.zone())
    run = lab.run(carry_unchanged=True)
    assert len(run.ingested) == 4 and run.reload.carried == {}
