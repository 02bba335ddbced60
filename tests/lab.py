"""A small, consistent delivery of the sixteen lab tables, written as single gzip files."""

import gzip
import os
import uuid
from datetime import datetime, timezone

from plantmart.lab_tables import LAB_TABLES
from plantmart.plans.daily_run import daily_run, standard_settings, write_configs
from plantmart.plans.warehouse import Warehouse
from plantmart.sources.landing import Zones
from plantmart.sources.raw import RawZone

AT = datetime(2026, 7, 1, 6, 0, tzinfo=timezone.utc)

FACT_HEADER = (
    "ANALYSIS,ANALYSIS_VERSION,COMPONENT_NAME,PRODUCT,PRODUCT_VERSION,SAMPLING_POINT,LOCATION_ID,"
    "DESTINATION_MATIERE,CODE_CONTROLE,CUSTOMER_ID,FOURNISSEUR,STATUS,RESULT_STATUS,TEST_STATUS,"
    "ORIGINAL_SAMPLE,JOB_NAME,GRANULOMETRIE,FORMAT,TEST_SCHEDULE"
)

DELIVERY = {
    "VERSIONED_ANALYSIS": ["IDENTITY,ANALYSIS_VERSION", "A1,1", "A1,2", "A2, 1 "],
    "VERSIONED_COMPONENT": ["NAME,ANALYSIS,ANALYSIS_VERSION", "Humidité,A1,1", "Humidité,A1,2", "pH,A2,1"],
    "MLP_HEADER": ["ENTRY_CODE,PRODUCT_VERSION", "P1,1", "P2,1"],
    "SAMPLE": ["ID_NUMERIC", "501", "502"],
    "SAMPLE_POINT": ["IDENTITY", "inlet"],
    "CUSTOMER": ["IDENTITY", "C1", "C2"],
    "LOCATION": ["IDENTITY", "L1"],
    "CODE_CONTROLE": ["IDENTITY", "K1"],
    "FOURNISSEUR": ["IDENTITY", "F1", "Bœuf & Cie €"],
    "JOB_HEADER": ["JOB_NAME", "J1"],
    "PHRASE": ["PHRASE_ID,PHRASE_TYPE", "G1,GRANULO", "G2,OTHER"],
    "DESTINATION": ["IDENTITY", "D1"],
    "PHRASE_FORMAT": ["PHRASE_ID,PHRASE_TYPE", "T1,FORMAT"],
    "MLP_VIEW": ["ANALYSIS_ID,COMPONENT_NAME,PRODUCT_ID,PRODUCT_VERSION", "A1,Humidité,P1,1"],
    "MENSUEL": [
        "ANALYSE,ANNUEL,MESURE,PRODUIT,PRODUCT_VERSION,LOCALISATION,CODE_CONTROLE",
        "A1,F,m1,P1,1,L1,K1",
        "A2,F,m2,P2,1,L1,",
    ],
    "SAMP_TEST_RESULT_LAFA": [
        FACT_HEADER,
        "A1,1,Humidité,P1,1,inlet,L1,D1,K1,C1,F1,V,V,V,501,J1,G1,T1,S1",
        "A1,2,Humidité,P1,1,,,,,C2,F1,,,,,,G2,,",
        "A2,1,pH,P2,1,inlet,L1,D1,K1,C1,Bœuf & Cie €,V,X,V,502,J1,,T1,S2",
    ],
}


class Lab:
    def __init__(self, spark, root, contracts=LAB_TABLES):
        self.spark = spark
        self.contracts = contracts
        self.zones = Zones.under(str(root), f"lab_{uuid.uuid4().hex}")

    def deliver(self, source, table, lines, name=None, encoding="windows-1252"):
        folder = os.path.join(self.zones.landed, source)
        os.makedirs(folder, exist_ok=True)
        path = os.path.join(folder, name or f"{table}_prod_extract.csv.gz")
        data = ("\n".join(lines) + "\n").encode(encoding)
        with open(path, "wb") as out:
            out.write(gzip.compress(data) if path.endswith(".gz") else data)
        return path

    def deliver_all(self, source, replacing=None, without=()):
        for table, lines in {**DELIVERY, **(replacing or {})}.items():
            if table not in without:
                self.deliver(source, table, lines)

    def configure(self, **changes):
        settings = standard_settings(self.contracts)
        for stem, values in changes.items():
            settings[stem] = {**settings.get(stem, {}), **values}
        write_configs(self.spark, self.zones.configs, settings)

    def run(self, **options):
        return daily_run(self.spark, self.zones, self.contracts, loaded_at=AT, **options)

    def zone(self):
        return RawZone(self.spark, self.zones.processed, self.zones.database)

    def warehouse(self, database=None):
        return Warehouse(self.spark, self.zones.warehouse, self.contracts, database)

    def rows(self, table):
        return self.warehouse().read(table)
