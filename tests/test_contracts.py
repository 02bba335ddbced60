from plantmart.lab_tables import FACT, LAB_TABLES
from plantmart.plans.daily_run import standard_settings
from tests.lab import DELIVERY


def test_sixteen_tables_in_load_order():
    names = list(LAB_TABLES)
    assert len(names) == 16 and names[-2:] == ["mensuel", FACT]
    for contract in LAB_TABLES.values():
        for reference in contract.references:
            assert names.index(reference.parent) < names.index(contract.name)


def test_nineteen_references_and_fifteen_keys():
    assert sum(len(c.references) for c in LAB_TABLES.values()) == 19
    assert sum(bool(c.key) for c in LAB_TABLES.values()) == 15
    for contract in LAB_TABLES.values():
        for reference in contract.references:
            parent = LAB_TABLES[reference.parent]
            assert set(reference.parent_columns) <= {c.name for c in parent.columns}
            for child, other in zip(reference.columns, reference.parent_columns):
                assert contract.column(child).kind == parent.column(other).kind
        assert set(contract.key) <= set(contract.required)


def test_schemas():
    # The columns of two tables of the contract.
    header = LAB_TABLES["mlp_header"]
    assert header.raw_names == ["entry_code", "product_version"]
    assert header.schema.simpleString() == (
        "struct<identity:string,product_version:bigint,source:string,last_updated_at:timestamp_ntz>"
    )
    assert header.raw_schema.simpleString() == (
        "struct<entry_code:string,product_version:string,last_updated_at:timestamp,source:string>"
    )
    fact = LAB_TABLES[FACT]
    assert len(fact.columns) == 19 and sum(not c.required for c in fact.columns) == 12


def test_delivery_covers_every_table():
    assert {t.lower() for t in DELIVERY} == set(LAB_TABLES)
    settings = standard_settings(LAB_TABLES)
    # The settings of one table.
    assert settings["FOURNISSEUR"] == {
        "TargetTable": "fournisseur", "HasHeader": "true", "Delimiter": ",", "Encoding": "windows-1252"
    }
