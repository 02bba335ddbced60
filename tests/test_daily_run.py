import dataclasses
import os
import shutil

import pytest
from pyspark.sql import functions as F

from plantmart import session
from plantmart.lab_tables import FACT, LAB_TABLES
from plantmart.operators.quality import check_tables
from plantmart.plans.marts import current_results, enriched_results, monthly_results
from plantmart.plans.vault import replicate, restore
from plantmart.plans.daily_run import survey_landing
from plantmart.sources.stores import UnknownStore
from tests.lab import AT, DELIVERY, FACT_HEADER, Lab


@pytest.fixture
def lab(spark, tmp_path):
    lab = Lab(spark, tmp_path)
    lab.configure()
    return lab


def vaulted(lab):
    chunks = lab.spark.read.parquet(lab.zones.replicated).collect()
    files = {}
    for c in sorted(chunks, key=lambda c: (c.source, c.file, c.part, c.chunk_start)):
        files.setdefault((c.source, c.file, c.part), []).append(bytes(c.content))
    return {key: b"".join(parts) for key, parts in files.items()}


def test_two_plants_end_to_end(lab):
    lab.deliver_all("DKQ")
    lab.deliver_all("FOS", without=("MLP_VIEW",))
    lab.deliver("DKQ", "UNKNOWN", ["A", "1"])
    run = lab.run()
    os.remove(f"{lab.zones.landed}/DKQ/UNKNOWN_prod_extract.csv.gz")
    assert [(r.stem, r.reason) for r in run.rejected.collect()] == [("UNKNOWN", "no configuration")]
    assert len(run.ingested) == 31 and all(r.malformed == 0 for r in run.ingested)
    assert run.reload.loaded["fournisseur"] == 4
    assert run.reload.per_source["mlp_view"] == {"DKQ": 1}
    # The sum over plants is the table, for every table.
    for table, counts in run.reload.per_source.items():
        assert sum(counts.values()) == lab.rows(table).count() == run.reload.loaded[table]
    report = check_tables(lab.warehouse().snapshot().tables(), LAB_TABLES)
    assert report.filter("violations > 0").count() == 0
    assert len(vaulted(lab)) == 31


def test_enriched_results(lab):
    lab.deliver_all("DKQ")
    # FOS knows none of the lookups, so its result finds nothing.
    lab.deliver("FOS", FACT, [FACT_HEADER, "A1,1,Humidité,P1,1,inlet,L1,D1,K1,C1,F1,,,,501,J1,G1,T1,S1"],
                name="SAMP_TEST_RESULT_LAFA_prod_extract.csv.gz")
    lab.run()
    snapshot = lab.warehouse().snapshot()
    assert current_results(snapshot).count() == 3
    rows = {(r.source, r.analysis_version): r for r in enriched_results(snapshot).collect()}
    assert len(rows) == 3
    full, sparse, foreign = rows["DKQ", 1], rows["DKQ", 2], rows["FOS", 1]
    flags = [c for c in full.asDict() if c.endswith("_known")]
    assert len(flags) == 14
    assert all(full[f] for f in flags)
    assert full.granulometrie_phrase_type == "GRANULO" and full.format_phrase_type == "FORMAT"
    assert sparse.granulometrie == "G2" and sparse.granulometrie_phrase_type is None
    # Limits know no analysis version, so they hold for this one too.
    assert not sparse.sampling_point_known and sparse.limits_known and sparse.customer_id_known
    assert not any(foreign[f] for f in flags)
    assert enriched_results(snapshot, include_excluded=True).count() == 4
    shared = {(r.source, r.analysis_version): r for r in enriched_results(snapshot, per_source=False).collect()}
    assert all(shared["FOS", 1][f] for f in flags)
    assert {r.mesure for r in monthly_results(snapshot).collect()} == {"m1", "m2"}


def test_enrichment_without_optional_tables(lab):
    lab.deliver_all("DKQ", without=("MLP_VIEW", "PHRASE"))
    lab.run()
    rows = enriched_results(lab.warehouse().snapshot())
    assert [(r.limits_known, r.granulometrie_known) for r in rows.collect()] == [(False, False)] * 2


def test_undelivered_source_is_reloaded_from_its_partition(lab):
    for source in ("DKQ", "FOS"):
        lab.deliver(source, "CUSTOMER", ["IDENTITY", "C1"])
    lab.run()
    os.remove(f"{lab.zones.landed}/FOS/CUSTOMER_prod_extract.csv.gz")
    lab.deliver("DKQ", "CUSTOMER", ["IDENTITY", "C2"])
    run = lab.run()
    assert run.reload.per_source["customer"] == {"DKQ": 1, "FOS": 1}


def test_empty_landing_republishes(lab):
    lab.deliver_all("DKQ")
    lab.run()
    os.rename(lab.zones.landed, lab.zones.landed + "-yesterday")
    run = lab.run()
    assert run.ingested == [] and run.reload.loaded["customer"] == 2
    assert len(lab.warehouse().snapshot().published) == 16


def test_failing_extract_stops_before_the_reload(lab):
    lab.deliver("DKQ", "CUSTOMER", DELIVERY["CUSTOMER"])
    lab.run()
    before = lab.warehouse().published()
    lab.deliver("DKQ", "CUSTOMER", ["IDENTITY", "C9"])
    with open(f"{lab.zones.landed}/DKQ/SAMPLE_prod_extract.csv.gz", "wb") as out:
        out.write(b"this is no gzip")
    with pytest.raises(Exception):
        lab.run()
    assert lab.warehouse().published() == before


def test_failing_reload_fails_the_run(lab):
    lab.deliver("DKQ", "SAMPLE", ["ID_NUMERIC", "x"])
    with pytest.raises(Exception, match="status 500"):
        lab.run()
    assert lab.warehouse().published() == {}


def test_wrong_key_name_in_an_extract_fails_the_load(lab):
    lab.deliver("DKQ", "MLP_HEADER", ["IDENTITY,PRODUCT_VERSION", "P1,1"])
    with pytest.raises(Exception, match="entry_code"):
        lab.run()


def test_vault_holds_the_bytes_and_replaces_file_by_file(lab):
    customer = lab.deliver("DKQ", "CUSTOMER", ["IDENTITY", *[f"C{i}" for i in range(5000)]])
    sample = lab.deliver("FOS", "SAMPLE", DELIVERY["SAMPLE"], name="SAMPLE_prod_extract.csv")
    phrase = lab.deliver("FOS", "PHRASE", [], name="PHRASE_prod_extract.csv")
    open(phrase, "wb").close()
    lab.deliver("FOS", "IGNORED", ["A"])

    def copy():
        landing = survey_landing(lab.spark, lab.zones)
        total = sum(e.delivery.bytes for e in landing.entries)
        replicate(landing.files, landing.accepted, lab.zones.replicated, total, chunk_bytes=1000)

    copy()
    copy()
    expected = {("DKQ", "CUSTOMER_prod_extract.csv.gz", ""): open(customer, "rb").read(),
                ("FOS", "SAMPLE_prod_extract.csv", ""): open(sample, "rb").read(),
                ("FOS", "PHRASE_prod_extract.csv", ""): b""}
    assert vaulted(lab) == expected
    wrong = lab.spark.read.parquet(lab.zones.replicated).filter("sha256 <> sha2(content, 256)").count()
    assert wrong == 0
    # Yesterday's copy of a file that is not delivered today stays.
    os.remove(sample)
    lab.deliver("DKQ", "CUSTOMER", ["IDENTITY", "C1"])
    copy()
    after = vaulted(lab)
    assert after["FOS", "SAMPLE_prod_extract.csv", ""] == expected["FOS", "SAMPLE_prod_extract.csv", ""]
    assert after["DKQ", "CUSTOMER_prod_extract.csv.gz", ""] == open(customer, "rb").read()


def test_restored_files_are_checked(lab, tmp_path):
    customer = lab.deliver("DKQ", "CUSTOMER", ["IDENTITY", *[f"C{i}" for i in range(900)]])
    sample = lab.deliver("FOS", "SAMPLE", [], name="SAMPLE_prod_extract.csv")
    open(sample, "wb").close()
    landing = survey_landing(lab.spark, lab.zones)
    replicate(landing.files, landing.accepted, lab.zones.replicated, 10**6, chunk_bytes=500)
    report = {(r.source, r.file): r.bytes for r in restore(lab.spark, lab.zones.replicated, str(tmp_path / "out")).collect()}
    for path in (customer, sample):
        source, name = path.split("/")[-2:]
        content = open(path, "rb").read()
        assert (tmp_path / "out" / source / name).read_bytes() == content
        assert report[source, name] == len(content)
    chunks = lab.spark.read.parquet(lab.zones.replicated)
    damages = {
        "lost": chunks.filter("chunk_start <> 500"),
        "twice": chunks.unionByName(chunks.filter("chunk_start = 500")),
        "changed": chunks.withColumn("content", F.expr("IF(chunk_start = 500, reverse(content), content)")),
        "short": chunks.filter("chunk_start < 500"),
    }
    for name, rows in damages.items():
        rows.write.parquet(str(tmp_path / name))
        with pytest.raises(Exception, match="damaged|are in the vault"):
            restore(lab.spark, str(tmp_path / name), str(tmp_path / "out"))


def test_landed_zone_in_an_unknown_store_is_refused(lab):
    lab.deliver("DKQ", "CUSTOMER", DELIVERY["CUSTOMER"])
    lab.spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.odd.link./in", f"file://{lab.zones.landed}")
    lab.zones = dataclasses.replace(lab.zones, landed="viewfs://odd/in")
    with pytest.raises(UnknownStore):
        lab.run()
    assert not os.path.exists(lab.zones.processed) or os.listdir(lab.zones.processed) == []


def test_part_files_keep_their_names_in_the_vault(lab):
    folder = lab.deliver("DKQ", "CUSTOMER", DELIVERY["CUSTOMER"], name="one.csv.gz")
    target = f"{lab.zones.landed}/DKQ/CUSTOMER_prod_extract.csv.gz"
    os.makedirs(target)
    shutil.move(folder, f"{target}/part-0.csv.gz")
    lab.run()
    assert set(vaulted(lab)) == {("DKQ", "CUSTOMER_prod_extract.csv.gz", "part-0.csv.gz")}
    assert lab.rows("customer").count() == 2


def test_work_folder_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.new_folder(spark, "x").startswith(named + "/x-")
    assert session.new_folder(spark, "x") != session.new_folder(spark, "x")


def test_results_have_the_same_columns_whatever_was_delivered(lab):
    lab.deliver_all("DKQ", without=("PHRASE", "MLP_HEADER", "MLP_VIEW"))
    lab.run()
    some = enriched_results(lab.warehouse().snapshot())
    assert [(r.product_known, r.granulometrie_known, r.limits_known) for r in some.collect()] == [(False,) * 3] * 2
    assert all(r.granulometrie_phrase_type is None and r.sampling_point_known is not None for r in some.collect())
    report = check_tables(lab.warehouse().snapshot().tables(), LAB_TABLES).filter("violations > 0").collect()
    found = {(r.table_name, r.column_name): r.violations for r in report if r.rule == "reference"}
    assert found[FACT, "product, product_version -> mlp_header"] == 3
    assert found[FACT, "granulometrie -> phrase"] == 2
    lab.deliver_all("DKQ")
    lab.run()
    whole = enriched_results(lab.warehouse().snapshot())
    assert whole.schema.simpleString() == some.schema.simpleString()


def test_warehouse_database_follows_the_record(lab):
    lab.deliver("DKQ", "CUSTOMER", ["IDENTITY", "C1"])
    lab.run()
    name = f"{lab.zones.warehouse_database}.customer"
    assert [tuple(r)[:2] for r in lab.spark.table(name).collect()] == [("C1", AT.replace(tzinfo=None))]
    lab.deliver("FOS", "CUSTOMER", ["IDENTITY", "C2"])
    lab.run()
    lab.run()
    assert sorted(r.identity for r in lab.spark.table(name).collect()) == ["C1", "C2"]
    assert len(os.listdir(f"{lab.zones.warehouse}/runs")) == 3


def test_the_given_session_keeps_its_settings(spark):
    given = spark.newSession()
    given.conf.set("spark.sql.shuffle.partitions", "3")
    before = given.conf.getAll
    own = session.configure(given)
    assert own.conf.get("spark.sql.shuffle.partitions") == "3"
    assert all(own.conf.get(k) == v for k, v in session.SETTINGS.items())
    assert given.conf.getAll == before
    given.conf.set("spark.sql.shuffle.partitions", "5")
    assert session.configure(given) is own and own.conf.get("spark.sql.shuffle.partitions") == "5"
    assert session.configure(own) is own
