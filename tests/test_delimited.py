import gzip

import pytest

from plantmart.sources.delimited import MALFORMED, Layout, scan_delimited


def write(path, data, encoding="utf-8"):
    raw = data.encode(encoding)
    path.write_bytes(gzip.compress(raw) if path.name.endswith(".gz") else raw)
    return str(path)


def rows(frame):
    return [tuple(r) for r in frame.collect()]


def test_everything_is_text_and_names_are_folded(spark, tmp_path):
    path = write(tmp_path / "t.csv", "ID,Name\n007,1.50\n")
    scanned = scan_delimited(spark, path)
    assert scanned.dtypes == [("id", "string"), ("name", "string")]
    assert rows(scanned) == [("007", "1.50")]


def test_quotes_and_embedded_delimiters(spark, tmp_path):
    path = write(tmp_path / "t.csv", 'a,b\n"x,""y""",2\n"tab\tinside",3\n')
    assert rows(scan_delimited(spark, path)) == [('x,"y"', "2"), ("tab\tinside", "3")]


def test_blank_fields_are_null_and_spaces_stay(spark, tmp_path):
    path = write(tmp_path / "t.csv", 'a,b,c\n,"",  x \n')
    assert rows(scan_delimited(spark, path)) == [(None, None, "  x ")]


@pytest.mark.parametrize("name", ["t.csv", "t.csv.gz", "t.tsv", "T.TSV.gz"])
def test_gzip_and_tab(spark, tmp_path, name):
    path = write(tmp_path / name, "a\tb\n1\t2\n")
    assert rows(scan_delimited(spark, path, Layout(delimiter="\t"))) == [("1", "2")]


def test_without_header(spark, tmp_path):
    path = write(tmp_path / "t.csv", "1,2\n3,4\n")
    bare = Layout(has_header=False)
    assert scan_delimited(spark, path, bare).columns == ["_c0", "_c1"]
    named = scan_delimited(spark, path, bare, ["x", "y"])
    assert named.columns == ["x", "y"] and rows(named) == [("1", "2"), ("3", "4")]


def test_legacy_code_page(spark, tmp_path):
    path = write(tmp_path / "t.csv.gz", "a\né œ €\n", "windows-1252")
    assert rows(scan_delimited(spark, path, Layout(encoding="windows-1252"))) == [("é œ €",)]
    assert "\ufffd" in rows(scan_delimited(spark, path))[0][0]


def test_ragged_rows_are_kept_and_marked(spark, tmp_path):
    path = write(tmp_path / "t.csv", "a,b\n1\n1,2,3\n1,2\n")
    scanned = scan_delimited(spark, path, keep_malformed=True)
    assert rows(scanned.drop(MALFORMED)) == [("1", None), ("1", "2"), ("1", "2")]
    assert [r[MALFORMED] for r in scanned.collect()] == ["1", "1,2,3", None]


def test_line_breaks_in_fields_need_the_setting(spark, tmp_path):
    path = write(tmp_path / "t.csv", 'a,b\n"x\ny",1\n')
    assert rows(scan_delimited(spark, path, Layout(multi_line=True))) == [("x\ny", "1")]
    assert scan_delimited(spark, path).count() == 2


def test_header_only(spark, tmp_path):
    scanned = scan_delimited(spark, write(tmp_path / "t.csv", "a,b\n"))
    assert scanned.columns == ["a", "b"] and scanned.count() == 0


def test_empty_file_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="no header"):
        scan_delimited(spark, write(tmp_path / "t.csv", ""))


def test_parts_must_share_their_header(spark, tmp_path):
    folder = tmp_path / "t.csv"
    folder.mkdir()
    write(folder / "part-0.csv", "a,b\n1,2\n")
    write(folder / "part-1.csv", "A,B\n3,4\n")
    assert sorted(rows(scan_delimited(spark, str(folder), parts=2))) == [("1", "2"), ("3", "4")]
    write(folder / "part-2.csv", "b,a\n5,6\n")
    with pytest.raises(Exception, match="header does not conform"):
        scan_delimited(spark, str(folder), parts=3).collect()
