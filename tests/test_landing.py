import json

from pyspark.sql import functions as F

from plantmart.sources.landing import (
    DUPLICATE,
    MANIFEST_SCHEMA,
    NO_CONFIG,
    NO_FOLDER,
    NO_TARGET,
    Zones,
    discover,
    extracts,
    manifest,
    read_configs,
    rejects,
    route,
)

ZONES = Zones("s3://in/landed", "s3://in/cfg", "s3://out/copies/", "s3://out/processed/", "s3://out/dw", "db")


def configs(spark, folder, **settings):
    for stem, values in settings.items():
        (folder / f"{stem}.json").write_text(json.dumps(values, indent=2))
    return read_configs(spark, str(folder))


def listed(spark, *paths):
    return spark.createDataFrame([(p, 10) for p in paths], "path string, length bigint")


def test_discovery_lists_recursively_without_reading(spark, tmp_path):
    (tmp_path / "DKQ" / "deep").mkdir(parents=True)
    (tmp_path / "DKQ" / "a.csv").write_text("x")
    (tmp_path / "DKQ" / "deep" / "b.csv").write_text("yy")
    (tmp_path / "DKQ" / "_SUCCESS").write_text("")
    files = discover(spark, str(tmp_path))
    assert sorted((r.path.rsplit("/", 1)[1], r.length) for r in files.collect()) == [("a.csv", 1), ("b.csv", 2)]
    (tmp_path / "DKQ" / "with space+é.csv").write_text("")
    files = discover(spark, str(tmp_path))
    assert sorted((r.path.rsplit("/", 1)[1], r.length) for r in files.collect()) == [
        ("a.csv", 1), ("b.csv", 2), ("with space+é.csv", 0)
    ]
    assert discover(spark, str(tmp_path / "nothing")).count() == 0


def test_configs_are_keyed_by_file_name(spark, tmp_path):
    found = configs(
        spark, tmp_path, A={"TargetTable": "a", "Encoding": "windows-1252"}, b={"Delimiter": ";", "HasHeader": True}
    )
    by_stem = {r.stem: r for r in found.collect()}
    assert by_stem["A"].TargetTable == "a" and by_stem["A"].Encoding == "windows-1252"
    assert by_stem["b"].TargetTable is None and by_stem["b"].HasHeader == "true"


def test_broken_config_is_isolated(spark, tmp_path):
    (tmp_path / "BAD.json").write_text("{not json")
    found = configs(spark, tmp_path, A={"TargetTable": "a"})
    routed = route(extracts(listed(spark, "s3://in/landed/DKQ/A.csv", "s3://in/landed/DKQ/BAD.csv")), found)
    assert {(r.stem, r.reason) for r in routed.collect()} == {("A", None), ("BAD", NO_TARGET)}


def test_defaults_and_manifest(spark, tmp_path):
    found = configs(
        spark, tmp_path, A={"TargetTable": "a"},
        B={"TargetTable": "b", "HasHeader": "false", "Delimiter": "\t", "Encoding": "windows-1252", "MultiLine": "true"},
    )
    files = listed(spark, "s3://in/landed/DKQ/A_prod_extract.csv.gz", "s3://in/landed/FOS/B.tsv")
    entries = manifest(route(extracts(files), found), ZONES)
    assert entries.schema.simpleString() == MANIFEST_SCHEMA.simpleString()
    a, b = sorted(entries.collect(), key=lambda e: e.job.target_table)
    assert tuple(a.copy) == (
        "out", "copies/DKQ/A_prod_extract.csv.gz", "in/landed/DKQ/A_prod_extract.csv.gz"
    )
    assert tuple(a.job) == (
        "s3://in/landed/DKQ/A_prod_extract.csv.gz", "s3://out/processed/a/", "a", "DKQ", "db", "true", ",", "utf-8"
    )
    assert tuple(a.delivery) == ("false", 1, 10, 10)
    assert (b.job.has_header, b.job.delimiter, b.job.encoding, b.delivery.multi_line) == (
        "false", "\t", "windows-1252", "true"
    )


def test_rejects_say_why(spark, tmp_path):
    found = configs(spark, tmp_path, A={"TargetTable": "a"}, B={"Delimiter": ";"}, C={"TargetTable": "c"})
    files = listed(
        spark, "s3://in/A.csv", "s3://in/landed/DKQ/B.csv", "s3://in/landed/DKQ/a.csv", "s3://in/landed/DKQ/DKQ-A.csv.gz",
        "s3://in/landed/DKQ/C.csv", "s3://in/landed/DKQ/C_qa_extract.csv", "s3://in/landed/FOS/C.csv", "s3://in/landed/DKQ/",
    )
    routed = route(extracts(files), found)
    why = {r.path.removeprefix("s3://in/"): r.reason for r in rejects(routed).collect()}
    assert why == {
        "A.csv": NO_FOLDER,
        "landed/DKQ/B.csv": NO_TARGET,
        "landed/DKQ/a.csv": NO_CONFIG,
        "landed/DKQ/DKQ-A.csv.gz": NO_CONFIG,
        "landed/DKQ/C.csv": DUPLICATE,
        "landed/DKQ/C_qa_extract.csv": DUPLICATE,
    }
    assert [e.job.source_path for e in manifest(routed, ZONES).collect()] == ["s3://in/landed/FOS/C.csv"]


def test_part_files_are_one_extract(spark, tmp_path):
    found = configs(spark, tmp_path, A={"TargetTable": "a"})
    files = listed(spark, *[f"s3://in/landed/DKQ/A_prod_extract.csv.gz/part-{i}.csv.gz" for i in range(3)])
    (entry,) = manifest(route(extracts(files), found), ZONES).collect()
    assert entry.job.source_path == "s3://in/landed/DKQ/A_prod_extract.csv.gz"
    assert tuple(entry.delivery) == ("false", 3, 30, 10)


def test_discovery_prunes_content(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x")
    plan = discover(spark, str(tmp_path)).select(F.col("path"))._jdf.queryExecution().executedPlan().toString()
    assert plan.rstrip().endswith("ReadSchema: struct<path:string>")


def test_a_large_source_is_listed_by_several_tasks(spark, tmp_path, monkeypatch):
    """Nearly all files lie below one source, in folders of their own and deeper."""
    from plantmart.sources import landing

    monkeypatch.setattr(landing, "LISTED_AT_ONCE", 3)
    expected = []
    for k in range(40):
        folder = tmp_path / "DKQ" / f"T{k}.csv" / ("x" if k % 2 else ".")
        folder.mkdir(parents=True)
        for part in range(7):
            (folder / f"part-{part}.csv").write_text("x" * part)
            expected.append((str((folder / f"part-{part}.csv").resolve()), part))
    (tmp_path / "FOS").mkdir()
    (tmp_path / "FOS" / "A.csv").write_text("x")
    (tmp_path / "DKQ" / "_hidden").mkdir()
    (tmp_path / "DKQ" / "_hidden" / "B.csv").write_text("x")
    files = discover(spark, str(tmp_path))
    found = sorted((r.path.removeprefix("file:"), r.length) for r in files.collect())
    assert found == sorted([*expected, (str(tmp_path / "FOS" / "A.csv"), 1)])
    # Each task of a level has written a file of its own.
    written = [r[0] for r in files.where(F.col("path").contains("/DKQ/")).select(F.input_file_name()).distinct().collect()]
    assert len(written) > 6


def test_versions_follow_names_lengths_and_times(spark, tmp_path):
    from plantmart.sources.landing import versions

    rows = [("s3://in/landed/DKQ/A.csv/part-0.csv", 5, 1), ("s3://in/landed/DKQ/A.csv/part-1.csv", 5, 1), ("s3://in/landed/FOS/A.csv", 9, 2)]

    def of(rows):
        frame = spark.createDataFrame(rows, "path string, length bigint, t bigint")
        frame = frame.withColumn("modificationTime", F.timestamp_seconds("t"))
        return {r.path: r.version for r in versions(frame).collect()}

    first = of(rows)
    assert first == of(rows[::-1]) and set(first) == {"s3://in/landed/DKQ/A.csv", "s3://in/landed/FOS/A.csv"}
    for changed in ((rows[0][0], 6, 1), (rows[0][0], 5, 2), (rows[0][0] + "x.csv", 5, 1)):
        second = of([changed, *rows[1:]])
        assert second["s3://in/landed/DKQ/A.csv"] != first["s3://in/landed/DKQ/A.csv"]
        assert second["s3://in/landed/FOS/A.csv"] == first["s3://in/landed/FOS/A.csv"]
