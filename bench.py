"""Times the headline jobs and prints one JSON line.

counts, the others once. Other systems write the delivered extracts, so delivering is not timed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from plantmart import session  # noqa: E402
from plantmart.lab_tables import LAB_TABLES  # noqa: E402
from plantmart.operators.quality import check_keys, check_reference, check_rows  # noqa: E402
from plantmart.plans.daily_run import ingest_landing  # noqa: E402
from plantmart.plans.marts import enriched_results  # noqa: E402
from reconcile import check_queries, landing_queries, load_queries, mart_queries  # noqa: E402,F401
from reconcile.registry import QUERIES  # noqa: E402
from reconcile.site import LOADED, Site  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REGISTERED = (
    "star_lookups", "star_lookups_spread", "hot_key_join", "repeated_keys", "cross_plant_orphans",
    "unlabelled_documents", "optional_enrichment", "excluded_results", "rolling_two_years",
    "route_manifest", "partial_key_reference", "lab_contract_report",
)
REPEATS = 3
REPEATED = (
    "ingest_lineitem", "reload_lineitem", "row_checks_lineitem", "key_check_lineitem",
    "reference_check_lineitem", "star_lookups",
)


def consume(rows: DataFrame) -> None:
    rows.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session.configure(
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    run_site = Site(spark, SF_DIR)
    for table, key in (("orders", "o_orderkey"), ("customer", "c_custkey"), ("lineitem", "l_orderkey")):
        run_site.deliver_by_plant(run_site.table(table), key, table, parts=4)
    site = Site(spark, SF_DIR)
    site.deliver_by_plant(site.table("lineitem"), "l_partkey", "lineitem", parts=4)
    site.deliver_by_plant(site.table("orders"), "o_orderkey", "orders")
    landing = site.survey()
    landing.entries = [e for e in landing.entries if e.job.target_table == "lineitem"]
    site.ingest()
    site.reload()
    lineitem = site.contracts["lineitem"]
    lab = mart_queries._lab_site(spark, SF_DIR)

    def ingest() -> None:
        ingest_landing(site.zone(), landing, site.contracts, LOADED)

    def reload() -> None:
        assert site.reload("lineitem").status == 200

    jobs = {
        "daily_run": lambda: run_site.run(),
        "ingest_lineitem": ingest,
        "reload_lineitem": reload,
        "row_checks_lineitem": lambda: consume(check_rows(site.snapshot().read("lineitem"), lineitem)),
        "key_check_lineitem": lambda: consume(check_keys(site.snapshot().read("lineitem"), lineitem)),
        "reference_check_lineitem": lambda: consume(
            check_reference(
                site.snapshot().read("lineitem"), site.snapshot().read("orders"), "lineitem",
                lineitem.references[0],
            )
        ),
        "lab_reload_all": lambda: lab.reload(),
        "lab_enriched_results": lambda: consume(enriched_results(lab.snapshot())),
    }
    assert set(lab.contracts) == set(LAB_TABLES)
    for name in REGISTERED:
        jobs[name] = lambda name=name: consume(QUERIES[name](spark, SF_DIR))

    seconds = {}
    for name, job in jobs.items():
        job()
        taken = []
        for _ in range(REPEATS if name in REPEATED else 1):
            started = time.perf_counter()
            job()
            taken.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(taken), 3)
    rows = site.table("lineitem").count()
    print(
        json.dumps(
            {
                "metric": "total of headline jobs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "rows_per_sec": {
                    name: round(rows / seconds[name]) for name in ("ingest_lineitem", "reload_lineitem")
                },
            }
        )
    )


if __name__ == "__main__":
    main()
