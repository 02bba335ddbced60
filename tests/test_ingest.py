import hashlib
import os

import pytest
from pyspark.sql import Observation, Row
from pyspark.sql import functions as F

from plantmart.lab_tables import LAB_TABLES
from plantmart.operators.merge import merge_sources, with_audit_columns
from plantmart.plans.daily_run import ingest_landing, survey_landing
from plantmart.plans.ingest import NoRowCount, write_tasks
from tests.lab import AT, Lab


def ingest(lab):
    return ingest_landing(lab.zone(), survey_landing(lab.spark, lab.zones), lab.contracts, AT)


def contents(lab, table):
    return sorted((r.source, r[0]) for r in lab.zone().read(table).collect())


def digests(folder):
    found = {}
    for base, _, files in os.walk(folder):
        for name in files:
            if name.endswith(".parquet"):
                path = os.path.join(base, name)
                found[os.path.relpath(path, folder)] = hashlib.sha256(open(path, "rb").read()).hexdigest()
    return found


def test_sources_are_replaced_one_by_one(spark, tmp_path):
    lab = Lab(spark, tmp_path)
    lab.configure()
    lab.deliver("DKQ", "CUSTOMER", ["IDENTITY", "C1", "C2"])
    lab.deliver("FOS", "CUSTOMER", ["IDENTITY", "C1"])
    ingest(lab)
    assert contents(lab, "customer") == [("DKQ", "C1"), ("DKQ", "C2"), ("FOS", "C1")]
    before = digests(f"{lab.zones.processed}/customer/source=FOS")

    os.remove(f"{lab.zones.landed}/FOS/CUSTOMER_prod_extract.csv.gz")
    lab.deliver("DKQ", "CUSTOMER", ["IDENTITY", "C9"])
    for _ in range(2):
        (result,) = ingest(lab)
        assert (result.source, result.rows, result.malformed) == ("DKQ", 1, 0)
        assert contents(lab, "customer") == [("DKQ", "C9"), ("FOS", "C1")]
    assert digests(f"{lab.zones.processed}/customer/source=FOS") == before


def test_raw_table_layout(spark, tmp_path):
    lab = Lab(spark, tmp_path)
    lab.configure()
    lab.deliver("DKQ", "MLP_HEADER", ["ENTRY_CODE,PRODUCT_VERSION,MORE", "P1, 7 ,x"])
    ingest(lab)
    raw = lab.zone().read("mlp_header")
    assert raw.dtypes == [
        ("entry_code", "string"), ("product_version", "string"), ("more", "string"),
        ("last_updated_at", "timestamp"), ("source", "string"),
    ]
    row = raw.withColumn("at", F.date_format("last_updated_at", "yyyy-MM-dd HH:mm")).first()
    assert (row.entry_code, row.product_version, row.at) == ("P1", " 7 ", "2026-07-01 06:00")
    files = [f for f in digests(f"{lab.zones.processed}/mlp_header")]
    assert files and all(f.startswith("source=DKQ/") and ".snappy.parquet" in f for f in files)
    assert lab.zone().tables() == {"mlp_header"}


def test_header_only_extract_empties_its_source(spark, tmp_path):
    lab = Lab(spark, tmp_path)
    lab.configure()
    for source in ("DKQ", "FOS"):
        lab.deliver(source, "CUSTOMER", ["IDENTITY", "C1"])
    ingest(lab)
    lab.deliver("DKQ", "CUSTOMER", ["IDENTITY"])
    assert {(r.source, r.rows) for r in ingest(lab)} == {("DKQ", 0), ("FOS", 1)}
    assert contents(lab, "customer") == [("FOS", "C1")]
    assert lab.zone().sources("customer") == ["DKQ", "FOS"]


def test_source_names_with_special_characters(spark, tmp_path):
    lab = Lab(spark, tmp_path)
    lab.configure()
    for source in ("a'b=c", "d%e", "f g"):
        lab.deliver(source, "CUSTOMER", ["IDENTITY", "C1"])
    ingest(lab)
    assert contents(lab, "customer") == [("a'b=c", "C1"), ("d%e", "C1"), ("f g", "C1")]
    lab.deliver("a'b=c", "CUSTOMER", ["IDENTITY"])
    ingest(lab)
    assert contents(lab, "customer") == [("d%e", "C1"), ("f g", "C1")]
    assert sorted(lab.zone().sources("customer")) == ["a'b=c", "d%e", "f g"]


def test_first_extract_may_be_empty(spark, tmp_path):
    lab = Lab(spark, tmp_path)
    lab.configure()
    lab.deliver("DKQ", "CUSTOMER", ["IDENTITY"])
    ingest(lab)
    assert contents(lab, "customer") == [] and lab.zone().read("customer").columns[0] == "identity"


def test_columns_match_by_name_across_sources_and_runs(spark, tmp_path):
    lab = Lab(spark, tmp_path)
    lab.configure()
    lab.deliver("DKQ", "PHRASE", ["PHRASE_ID,PHRASE_TYPE,OLD", "G1,GRANULO,o"])
    lab.deliver("FOS", "PHRASE", ["phrase_type,PHRASE_ID", "GRANULO,G2"])
    ingest(lab)
    lab.deliver("FOS", "PHRASE", ["NEW,PHRASE_ID", "n,G3"])
    os.remove(f"{lab.zones.landed}/DKQ/PHRASE_prod_extract.csv.gz")
    ingest(lab)
    rows = {r.source: r.asDict() for r in lab.zone().read("phrase").drop("last_updated_at").collect()}
    assert rows["DKQ"] == {"phrase_id": "G1", "phrase_type": "GRANULO", "old": "o", "new": None, "source": "DKQ"}
    assert rows["FOS"] == {"phrase_id": "G3", "phrase_type": None, "old": None, "new": "n", "source": "FOS"}


def test_recovery_without_a_catalog(spark, tmp_path):
    lab = Lab(spark, tmp_path)
    lab.configure()
    lab.deliver("DKQ", "PHRASE", ["PHRASE_ID,PHRASE_TYPE", "G1,GRANULO"])
    lab.deliver("FOS", "PHRASE", ["PHRASE_ID,EXTRA", "G2,x"])
    ingest(lab)
    spark.sql(f"DROP TABLE {lab.zone().qualified('phrase')}")
    zone = lab.zone()
    assert zone.tables() == set()
    zone.recover()
    assert zone.tables() == {"phrase"}
    assert sorted(zone.read("phrase").columns) == ["extra", "last_updated_at", "phrase_id", "phrase_type", "source"]
    assert contents(lab, "phrase") == [("DKQ", "G1"), ("FOS", "G2")]


def test_numeric_looking_sources_stay_text(spark, tmp_path):
    lab = Lab(spark, tmp_path)
    lab.configure()
    lab.deliver("01", "CUSTOMER", ["IDENTITY", "C1"])
    ingest(lab)
    assert contents(lab, "customer") == [("01", "C1")]
    assert lab.zone().layout_differences("customer", ["DKQ", "01"]) == [("DKQ", "missing")]
    assert lab.zone().layout_differences("customer", []) == [("01", "unexpected")]


def test_header_less_extract_takes_contract_names(spark, tmp_path):
    lab = Lab(spark, tmp_path)
    lab.configure(PHRASE={"HasHeader": "False", "Delimiter": ";"})
    lab.deliver("DKQ", "PHRASE", ["G1;GRANULO", "G2"])
    (result,) = ingest(lab)
    assert (result.rows, result.malformed) == (2, 1)
    assert [tuple(r)[:2] for r in lab.zone().read("phrase").orderBy("phrase_id").collect()] == [
        ("G1", "GRANULO"), ("G2", None)
    ]


def test_spread_extract_keeps_all_rows(spark, tmp_path):
    """A large unsplittable extract goes through a shuffle after its scan."""
    from plantmart.plans.ingest import ingest_table

    lab = Lab(spark, tmp_path)
    lab.configure()
    lab.deliver("DKQ", "CUSTOMER", ["IDENTITY", *[f"C{i}" for i in range(20_000)]])
    landing = survey_landing(spark, lab.zones)
    (entry,) = landing.entries
    tasks = write_tasks(entry, target_bytes=20_000)
    assert tasks and tasks > 4
    (result,) = ingest_table(lab.zone(), "customer", landing.entries, AT, None, target_bytes=20_000)
    assert result.rows == 20_000
    assert lab.zone().read("customer").distinct().count() == 20_000
    assert len(digests(f"{lab.zones.processed}/customer")) == tasks


def entry(path, size, parts=1, multi_line="false"):
    job = Row(source_path=path, has_header="true", delimiter=",", encoding="utf-8")
    return Row(job=job, delivery=Row(multi_line=multi_line, parts=parts, bytes=size, largest_part=size // parts))


def test_only_large_unsplittable_files_are_spread():
    gb = 1 << 30
    assert write_tasks(entry("x.csv", 100 * gb)) is None
    assert write_tasks(entry("x.csv.gz", gb // 100)) is None
    assert write_tasks(entry("x.csv.gz", 10 * gb)) == 240
    assert write_tasks(entry("x.csv.gz", 10 * gb, parts=1000)) is None
    assert write_tasks(entry("x.csv", 10 * gb, multi_line="true")) == 40


def test_merge_and_audit_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([("y", 2, True)], "NAME string, id int, extra boolean")
    assert sorted(map(tuple, merge_sources(a, b).collect())) == [(1, "x", None), (2, "y", True)]
    old = spark.createDataFrame([("c",)], "identity string")
    completed = with_audit_columns(old, LAB_TABLES["customer"])
    assert completed.schema.simpleString() == LAB_TABLES["customer"].schema.simpleString()
    assert tuple(completed.first()) == ("c", None, None)
    assert with_audit_columns(completed, LAB_TABLES["customer"]).columns == completed.columns


@pytest.mark.parametrize("seen", [{}, {"rows_0": None}, {"rows_0": 0, "malformed_0": 0}])
def test_an_extract_is_not_emptied_for_want_of_a_count(spark, tmp_path, monkeypatch, seen):
    lab = Lab(spark, tmp_path)
    lab.configure()
    lab.deliver("DKQ", "CUSTOMER", ["IDENTITY", "C1", "C2"])
    ingest(lab)
    monkeypatch.setattr(Observation, "get", property(lambda self: seen))
    with pytest.raises(NoRowCount):
        ingest(lab)
    assert contents(lab, "customer") == [("DKQ", "C1"), ("DKQ", "C2")]
    lab.deliver("DKQ", "CUSTOMER", ["IDENTITY"])
    (result,) = ingest(lab)
    assert result.rows == 0 and contents(lab, "customer") == []
