from __future__ import annotations

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from vintara.catalog.files import HEADER, workbook
from vintara.sources import archives, listing, tables, workbooks


def test_listing(spark, tmp_path):
    for name in ["a/x.xlsx", "a/b/y.PDF", "a/b/z.pdf", "c.csv", "d.txt", "a/.tmp/e.pdf", "f.tmp.zip"]:
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"12345")
    rows = listing.with_vintage(listing.list_files(spark, str(tmp_path))).collect()
    assert sorted((r["filename"], r["length"]) for r in rows) == [("c.csv", 5), ("x.xlsx", 5), ("z.pdf", 5)]
    assert {r["filename"]: r["vintage"] for r in rows}["x.xlsx"] == "a"
    plan = listing.list_files(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_main_file_rules(frame):
    cases = {
        "1": ["only.parquet"],
        "2": ["a.parquet", "b_Disclosure_Data.parquet"],
        "3": ["a_Disclosure_Data.parquet", "b_Disclosure_Data_New_Form.parquet", "c.parquet"],
        "4": ["b_Disclosure_Data.parquet", "a_Disclosure_Data.parquet"],
        "5": ["only.xlsx", "note.txt"],
        "6": ["a.parquet", "b.parquet", "c_Disclosure_Data.xlsx", "d.xlsx"],
        "7": ["a.csv"],
        "8": ["a.parquet", "b_disclosure_data.parquet"],
    }
    files = frame([(v, n, f"/{v}/{n}") for v, ns in cases.items() for n in ns], "vintage string, filename string, path string")
    got = {r["vintage"]: (r["filename"], r["rule"], r["path"]) for r in listing.main_files(files).collect()}
    assert got == {
        "1": ("only.parquet", 1, "/1/only.parquet"), "2": ("b_Disclosure_Data.parquet", 2, "/2/b_Disclosure_Data.parquet"),
        "3": ("b_Disclosure_Data_New_Form.parquet", 3, "/3/b_Disclosure_Data_New_Form.parquet"),
        "4": ("a_Disclosure_Data.parquet", 4, "/4/a_Disclosure_Data.parquet"), "5": ("only.xlsx", 1, "/5/only.xlsx"),
        "6": ("c_Disclosure_Data.xlsx", 2, "/6/c_Disclosure_Data.xlsx")}


def test_fingerprint(spark, tmp_path):
    import hashlib

    (tmp_path / "a.zip").write_bytes(b"\x00\xffdata")
    row = listing.read_files(spark, str(tmp_path), ["zip"]).select(listing.fingerprint("content").alias("h"), "length").collect()[0]
    assert (row["h"], row["length"]) == (hashlib.sha256(b"\x00\xffdata").hexdigest(), 6)


def test_archives(spark, tmp_path):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("dir/", "")
        z.writestr("dir/a.txt", "A")
        z.writestr("b.csv", "B" * 100)
    (tmp_path / "good.zip").write_bytes(out.getvalue())
    (tmp_path / "bad.zip").write_bytes(b"no zip")
    rows = archives.zip_members(listing.read_files(spark, str(tmp_path), ["zip"])).collect()
    got = sorted((r["folder"].rsplit("/", 1)[-1], r["member"] or "", r["ok"]) for r in rows)
    assert got == [("bad", "", False), ("good", "b.csv", True), ("good", "dir/a.txt", True)]
    assert "BadZipFile" in next(r["error"] for r in rows if not r["ok"])


@pytest.fixture
def books(spark, tmp_path):
    for year in ("2019", "2020"):
        (tmp_path / year).mkdir()
        for i in range(2):
            (tmp_path / year / f"r{i}.xlsx").write_bytes(workbook(HEADER, 10 + i, "name & <x>", 1.5))
    (tmp_path / "2020" / "bad.xlsx").write_bytes(b"damaged")
    return listing.read_files(spark, str(tmp_path), ["xlsx"])


def test_workbooks(spark, books):
    rows = workbooks.workbook_rows(books)
    assert rows.where("NOT ok").count() == 1
    assert [r["cells"] for r in workbooks.workbook_headers(rows).collect()] == [HEADER] * 4
    table = workbooks.workbook_table(rows, HEADER)
    row = table.where(F.col("path").endswith("2019/r1.xlsx")).collect()[0]
    assert [row[h] for h in HEADER] == [
        "11", "name & <x>", None, "2017-10-03 00:00:00", "2017-09-22 12:00:00", "True", "1.5"]


def test_repeated_and_unnamed_workbook_headers(frame):
    rows = frame([("p", 1, ["a", "a", None], True), ("p", 2, ["1", "NA"], True)], "path string, row long, cells array<string>, ok boolean")
    table = workbooks.workbook_table(rows, ["a", "a", ""])
    assert table.columns == ["path", "row", "a", "a.1", "Unnamed: 2"]
    assert tuple(table.collect()[0]) == ("p", 2, "1", None, None)


def test_only_workbooks_without_output_are_converted(frame):
    books = frame([("/d/2019/a.xlsx",), ("/d/2019/b.xlsx",)], "path string")
    outputs = frame([("/d/2019/a.parquet",)], "path string")
    assert [r["path"] for r in workbooks.missing_outputs(books, outputs).collect()] == ["/d/2019/b.xlsx"]


def test_csv_round_trip(spark, frame, tmp_path):
    data = [("1", 'quote " and, comma', None), ("2", "line\nbreak", "NA"), ("3", "", "NAN")]
    tables.write_csv(frame(data, "id string, `Some Name` string, v string"), str(tmp_path / "t"))
    got = tables.read_csv(spark, str(tmp_path / "t"), columns=["v", "id", "Some Name", "absent"])
    assert got.columns == ["id", "Some Name", "v"]
    assert sorted(map(tuple, got.collect())) == [("1", 'quote " and, comma', None), ("2", "line\nbreak", None), ("3", None, "NAN")]


def test_mapping_last_line_wins(frame):
    rows = frame([(" A ", "x", 1), ("A", " y ", 2), ("B", "z", 3)], "o string, f string, n int")
    assert sorted(map(tuple, tables.mapping_table(rows, "o", "f", "n").collect())) == [("A", "y"), ("B", "z")]


def test_parquet_and_size(spark, frame, tmp_path):
    tables.write_parquet(frame([("1",)], "a string"), str(tmp_path / "t"))
    size = tables.size_in_mb(listing.list_files(spark, str(tmp_path), ["parquet"])).collect()[0][0]
    assert size is not None
    rows = tables.read_release(spark, str(tmp_path / "t")).collect()
    assert rows[0]["_row_index"] == 0 and rows[0]["_file_path"].endswith(".parquet")
    assert tables.header_of(spark, str(tmp_path / "t")) == ["a"]


def test_convert_writes_releases_beside_workbooks(spark, tmp_path, books):
    from vintara.plans.convert import convert_workbooks
    from vintara.plans.releases import find_releases

    done = {r["path"].rsplit("/", 1)[-1]: r["ok"] for r in convert_workbooks(spark, str(tmp_path)).collect()}
    assert done == {"r0.xlsx": True, "r1.xlsx": True, "bad.xlsx": False}
    found = find_releases(spark, str(tmp_path))
    assert [(r.vintage, r.filename) for r in found] == [
        (y, f"r{i}.parquet") for y in ("2019", "2020") for i in range(2)]
    table = spark.read.parquet(str(tmp_path / "2019" / "r1.parquet"))
    assert table.columns == HEADER and table.count() == 1
    again = convert_workbooks(spark, str(tmp_path), skip_existing=True)
    assert [r["ok"] for r in again.collect()] == [False]


def test_unreadable_release_falls_back_to_its_workbook(spark, tmp_path):
    from vintara.plans.lca import compile_lca

    (tmp_path / "2019").mkdir()
    (tmp_path / "2019" / "r.xlsx").write_bytes(workbook(["CASE NO", "NAME", "x", "y", "z", "u", "WAGE_RATE_1"], 5, "name", 2.5))
    (tmp_path / "2019" / "r.parquet").write_bytes(b"damaged")
    (tmp_path / "2019" / "s.xlsx").write_bytes(workbook(["CASE NO", "NAME", "x", "y", "z", "u", "WAGE_RATE_1"], 6, "name", 3.5))
    rows = compile_lca(spark, str(tmp_path), convert=True).select("case_number", "employer_name", "wage_rate_of_pay_from")
    assert sorted(map(tuple, rows.collect())) == [("5", "name", "2.5"), ("6", "name", "3.5")]


def test_cell_values():
    from xml.etree import ElementTree

    def value(xml, dates=frozenset({1})):
        return workbooks._value(ElementTree.fromstring(xml), ["s0"], set(dates), workbooks._EPOCH)

    assert value("<c><v>5</v></c>") == "5" and value("<c><v>5.0</v></c>") == "5" and value("<c><v>1E3</v></c>") == "1000"
    assert value("<c><v>0.10000000000000001</v></c>") == "0.1"
    assert value('<c s="1"><v>43831</v></c>') == "2020-01-01 00:00:00"
    assert value('<c s="1"><v>0.5</v></c>') == "12:00:00" and value('<c s="1"><v>1</v></c>') == "1900-01-01 00:00:00"
    assert value('<c t="e"><v>#N/A</v></c>') is None and value("<c/>") is None
    assert value('<c t="s"><v>0</v></c>') == "s0" and value('<c t="str"><v>x</v></c>') == "x"
    assert value('<c t="b"><v>1</v></c>') == "True" and value('<c t="d"><v>2020-01-02T03:04:05</v></c>') == "2020-01-02 03:04:05"
    assert workbooks._date("0", workbooks._EPOCH_1904) == "00:00:00"
    assert workbooks._date("366", workbooks._EPOCH_1904) == "1905-01-01 00:00:00"


def test_csv_values_with_line_breaks_stay_whole(spark, frame, tmp_path):
    data = [("1", "a\nb\n\nc"), ("2", 'said "x\ny", then'), ("3", "z")]
    tables.write_csv(frame(data, "id string, v string").coalesce(1), str(tmp_path / "b"))
    assert sorted(map(tuple, tables.read_csv(spark, str(tmp_path / "b")).collect())) == data
