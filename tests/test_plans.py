"""The end-to-end jobs on small trees of files."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from vintara.config.lca import LCA_COLUMNS, LCA_LABELS
from vintara.config.perm import PERM_COLUMNS, PERM_LITERAL
from vintara.operators import manifest as m
from vintara.plans import acquire as a
from vintara.plans import lca, perm, wages


def release(spark, path, columns, rows, parts=1):
    schema = ", ".join(f"c{i} string" for i in range(len(columns)))
    df = spark.createDataFrame(rows, schema).toDF(*columns).coalesce(parts)
    df.write.parquet(str(path))


@pytest.fixture
def lca_root(spark, tmp_path):
    root = tmp_path / "lca"
    release(spark, root / "2010/LCA_2010.parquet", ["CASE NO", "Approval-Status", "Submitted_Date", "WAGE_RATE_1", "City_2"], [
        ("i-1 ", "certified", "1/2/2010", "10", "z"), ("I-2", "DENIED", "2010-01-03", "$3", "z"), (None, "DENIED", None, "1", "z")])
    columns = ["CASE_NUMBER", "CASE_STATUS", "RECEIVED_DATE", "WAGE_RATE_OF_PAY_FROM", "WAGE_RATE_OF_PAY_FROM_1", "YES"]
    release(spark, root / "2019/LCA_2019_Q1.parquet", columns, [
        ("I-1", "Withdrawn", "2019-05-06 00:00:00", None, "20", "1"), ("I-3", "CERTIFIED-WITHDRAWN", "soon", None, "30", "1")])
    release(spark, root / "2019/LCA_2019_Q2.parquet", columns, [
        ("I-3", "Denied", None, "31", "99", "1"), (None, "Denied", None, "32", "98", "1"), ("I-4", "nan", "2019-07-08", "33", None, "1")])
    release(spark, root / "2019/LCA_Worksites.parquet", ["CASE_NUMBER"], [("I-9",)])
    return str(root)


def test_lca(spark, lca_root):
    compiled = lca.compile_lca(spark, lca_root)
    assert compiled.columns == LCA_COLUMNS
    got = {r["case_number"]: (r["year"], r["wage_rate_of_pay_from"]) for r in compiled.collect()}
    assert got == {"I-1": ("2010", "10"), "I-2": ("2010", "$3"), None: ("2010", "1"), "I-3": ("2019", "30"), "I-4": ("2019", "33")}
    clean = lca.clean_lca(compiled)
    rows = {r["case_number"]: r for r in clean.collect()}
    assert rows["I-1"]["case_status"] == "Certified" and rows["I-3"]["case_status"] == "Certified - Withdrawn"
    assert rows["I-1"]["received_date"] == datetime(2010, 1, 2) and rows["I-3"]["received_date"] is None
    assert rows["I-2"]["wage_rate_of_pay_from"] is None and rows["I-1"]["wage_rate_of_pay_from"] == 10.0
    assert rows["I-4"]["case_status"] is None
    types = dict(clean.dtypes)
    assert len(types) == 36
    assert sorted(types.values()).count("timestamp") == 4 and list(types.values()).count("double") == 3
    assert list(types.values()).count("bigint") == 6
    assert set(lca.clean_lca(compiled, labels=True).columns) == set(LCA_LABELS.values())


def test_lca_in_blocks(spark, lca_root):
    # positions 0..7 in file order: I-1 I-2 null | I-1 I-3 | I-3 null I-4
    whole = lca.compile_lca(spark, lca_root, mode="blocks", block_rows=100)
    assert whole.count() == 8
    two = lca.compile_lca(spark, lca_root, mode="blocks", block_rows=2)
    assert two.count() == 6
    four = lca.compile_lca(spark, lca_root, mode="blocks", block_rows=4)
    repeated = four.groupBy("case_number").count().where("count > 1")
    assert sorted(r["case_number"] for r in repeated.collect()) == ["I-1", "I-3"]


def test_cleaned_scan_reads_only_the_kept_columns(spark, lca_root):
    plan = lca.clean_lca(lca.compile_lca(spark, lca_root))._jdf.queryExecution().executedPlan().toString()
    read = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert read and not any("YES" in line for line in read) and "Python" not in plan


def test_perm(spark, tmp_path):
    root = tmp_path / "perm"
    release(spark, root / "2022/PERM_2022.parquet", ["CASE_NUMBER", "CASE_STATUS", "EMPLOYER_NAME", "WAGE_OFFER_FROM", "CLASS_OF_ADMISSION"], [
        ("a-1", " certified ", "Old Co", "5", " h-1b"), ("a-2", "Denied", "B", "6", "nan")])
    release(spark, root / "2024/PERM_2024_New_Form.parquet", ["CASE_NUMBER", "CASE_STATUS", "EMP_BUSINESS_NAME", "JOB_OPP_PWD_NUMBER"], [
        ("A-1", "Withdrawn", "New Co", "J1"), ("g-3", "certified-expired", "C", "J3")])
    release(spark, root / "2024/PERM_2024_Old_Form.parquet", ["CASE_NUMBER", "PW_TRACK_NUMBER"], [("a-4", "P4")])
    compiled = perm.compile_perm(spark, str(root))
    assert compiled.columns == PERM_COLUMNS
    got = {r["case_number"]: (r["year"], r["form_type"], r["emp_business_name"], r["pw_track_number"]) for r in compiled.collect()}
    assert got == {"A-1": ("2022", "old", "Old Co", None), "A-2": ("2022", "old", "B", None),
                   "G-3": ("2024", "new", "C", "J3"), "A-4": ("2024", "old", None, "P4")}
    clean = {r["case_number"]: (r["case_status"], r["form_type"], r["class_of_admission"]) for r in perm.clean_perm(compiled).collect()}
    assert clean["A-1"] == ("Certified", "OLD", "H-1B") and clean["A-2"] == ("Denied", "OLD", None)
    literal = {r["case_number"]: r for r in perm.compile_perm(spark, str(root), PERM_LITERAL).collect()}
    assert literal["A-1"]["wage_offer_from"] is None and literal["A-4"]["pw_track_number"] is None
    assert literal["G-3"]["pw_track_number"] == "J3" and literal["A-1"]["class_of_admission"] == " h-1b"


def test_wages(spark, tmp_path):
    root = tmp_path / "pw"
    release(spark, root / "2015/PW_2015.parquet", ["STATUS", "CASE_STATUS", "VOIDED_DATE", "EIN", "odd"], [("s", "c", "v", "1", "o")])
    release(spark, root / "2020/PW_Disclosure_Data_old.parquet", ["CASE_STATUS"], [("wrong",)])
    release(spark, root / "2020/PW_Disclosure_Data_revised_form.parquet", ["VOIDED_DATE", "PW_SOC_TITLE", "case_status"], [("v", "t", "x")])
    release(spark, root / "2025/PW_Disclosure_Data.parquet", ["CASE_STATUS", "EMPLOYER_FEIN"], [("d", "2"), ("d", "2")])
    (root / "2016").mkdir()
    (root / "2016" / "PW.parquet").write_bytes(b"damaged")
    release(spark, root / "notes/x.parquet", ["CASE_STATUS"], [("no",)])
    done = wages.amalgamate(spark, str(root))
    assert done.rows.columns == ["CASE_STATUS", "EMPLOYER_FEIN", "SOURCE_YEAR"]
    assert sorted(map(tuple, done.rows.fillna("").collect())) == [
        ("", "", 2020), ("d", "2", 2025), ("d", "2", 2025), ("s", "1", 2015)]
    assert [tuple(r) for r in done.unmapped.collect()] == [
        ("PW_SOC_TITLE", "2020"), ("VOIDED_DATE", "2020"), ("case_status", "2020"), ("odd", "2015")]
    assert [r.vintage for r in done.errors] == ["2016"]
    duplicates = done.headers.where("outcome = 'duplicate'").collect()
    assert [(r["year"], r["name"]) for r in duplicates] == [(2015, "CASE_STATUS")]
    with pytest.raises(ValueError):
        wages.amalgamate(spark, str(root), target_year=1999)


def test_candidates_of_labelled_pages(spark):
    html = ('<a href="/m/jan2024.pdf">January 2024</a><a href="/m/jan2024.pdf">again</a><a href="/m/FY2023.XLS"> </a>'
            '<a href="/h/H1B_fy24.csv">c</a><a href="/y/Table%201.ZIP?x=1">z</a>')
    pages = spark.createDataFrame([(1, "http://h/", html, "L")], "page_id long, url string, html string, label string")

    def got(kind):
        return sorted(tuple(r) for r in a.labelled_candidates(pages, kind).select("period", "filename", "folder").collect())

    assert got("monthly") == [
        ("FY2023", "FY2023.XLS", "/data/visa_stats/monthly/L/FY2023/FY2023"),
        ("FY2024-01", "jan2024.pdf", "/data/visa_stats/monthly/L/FY2024/FY2024-01"),
        ("misc", "H1B_fy24.csv", "/data/visa_stats/monthly/L/misc")]
    assert got("employer") == [
        ("L/2023", "FY2023.XLS", "/data/uscis_data/L/2023"), ("L/2024", "H1B_fy24.csv", "/data/uscis_data/L/2024")]
    assert ("L", "jan2024.pdf", "/data/visa_stats/annual/L") in got("annual")
    assert ("L", "table%201.zip", "/data/immigration_yearbook/L") in got("yearbook")


def test_acquisition(spark):
    html = '<h2>PERM</h2><a href="/p/FY2024_a.xlsx">a</a><a href="/p/FY2024_b.xlsx">b</a><a href="/p/lca_2023.csv">c</a>'
    pages = spark.createDataFrame([(1, "https://h/", html), (2, "https://h/x", html)], "page_id long, url string, html string")
    offered = a.candidates(pages)
    rows = {r["filename"]: r for r in offered.collect()}
    assert len(rows) == 3
    assert rows["lca_2023.csv"]["saved_path"] == "/data/performance_data/LCA Program/2023/lca_2023.csv"
    held = spark.createDataFrame([], m.MANIFEST)
    probe = spark.createDataFrame(
        [], "url string, http_ok boolean, etag string, last_modified string, content_length long, not_modified boolean")
    fetched = spark.createDataFrame(
        [("PERM Program/2024", "https://h/p/FY2024_a.xlsx", False, "1", 5, "e", "l")],
        "period string, url string, http_304 boolean, sha256 string, bytes long, etag string, last_modified string")
    listing = spark.createDataFrame(
        [("/data/performance_data/LCA Program/2023/lca_2023.csv", 7, "z")], "path string, length long, sha256 string")
    run = a.acquire(offered, held, probe, fetched, listing, F.lit(datetime(2025, 1, 1)))
    assert {r["url"].rsplit("/", 1)[-1]: r["outcome"] for r in run.outcomes.collect()} == {
        "FY2024_a.xlsx": "downloaded", "FY2024_b.xlsx": "errors", "lca_2023.csv": "registered"}
    assert m.outcome_counts(run.outcomes).collect()[0]["downloaded"] == 2
    assert run.manifest.count() == 2 and m.constraint_violations(run.manifest).count() == 0
    again = a.acquire(offered, run.manifest, probe, fetched, listing, F.lit(datetime(2025, 1, 2)), mode="fast")
    assert {r["outcome"] for r in again.outcomes.where("url NOT LIKE '%b.xlsx'").collect()} == {"skipped"}
    assert again.manifest.exceptAll(run.manifest).count() == 0


def test_names_that_differ_in_case(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    (tmp_path / "2012").mkdir()
    pq.write_table(pa.table({"CASE_NO": ["1"], "Status": ["first"], "STATUS": ["second"]}), tmp_path / "2012" / "r.parquet")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        row = lca.compile_lca(spark, str(tmp_path)).select("case_number", "case_status").collect()[0]
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")
    assert tuple(row) == ("1", "first")


def test_typed_releases_of_one_header_are_read_apart(spark, tmp_path):
    release(spark, tmp_path / "2012/a.parquet", ["CASE_NO", "WAGE_RATE_1"], [("1", "10")])
    spark.createDataFrame([("2", 20.5)], "CASE_NO string, WAGE_RATE_1 double").coalesce(1).write.parquet(str(tmp_path / "2013/b.parquet"))
    rows = lca.compile_lca(spark, str(tmp_path)).select("case_number", "wage_rate_of_pay_from").collect()
    assert sorted(map(tuple, rows)) == [("1", "10"), ("2", "20.5")]


def test_unreadable_perm_release_stops_the_job(spark, tmp_path):
    (tmp_path / "2012").mkdir()
    (tmp_path / "2012" / "r.parquet").write_bytes(b"damaged")
    with pytest.raises(ValueError, match="unreadable"):
        perm.compile_perm(spark, str(tmp_path))


def test_missing_case_numbers_are_one_case(spark, tmp_path):
    release(spark, tmp_path / "2012/r.parquet", ["CASE_NUMBER", "CASE_STATUS"], [(None, "a"), (None, "b"), ("x", "c")])
    kept = perm.compile_perm(spark, str(tmp_path)).select("case_number", "case_status").collect()
    assert sorted((r[0] or "", r[1]) for r in kept) == [("", "a"), ("X", "c")]
    shown = perm.compile_perm(spark, str(tmp_path), null_key="NAN").select("case_number").collect()
    assert sorted(r[0] for r in shown) == ["NAN", "X"]


def test_every_data_file_is_read_or_reported(spark, tmp_path):
    root = tmp_path / "lca.parquet.d"
    columns = ["CASE_NUMBER", "CASE_STATUS"]
    release(spark, root / "2019/a.parquet", columns, [("I-1", "x"), ("I-2", "x")], parts=2)
    spark.createDataFrame([("I-3", "x")], "CASE_NUMBER string, CASE_STATUS string").toPandas().to_parquet(
        _made(root / "2020") / "a.parquet.v2.parquet")
    (root / "2020/b.parquet").write_bytes(b"damaged")
    (_made(root / "2021") / "book.xlsx").write_bytes(b"x")
    (root / "2019/a.xlsx").write_bytes(b"the same release")
    (root / "2021/table.csv").write_text("a,b")
    errors: dict = {}
    compiled = lca.compile_lca(spark, str(root), errors=errors)
    assert {(r["case_number"], r["year"]) for r in compiled.collect()} == {("I-1", "2019"), ("I-2", "2019"), ("I-3", "2020")}
    assert {(r.vintage, r.filename) for r in errors} == {("2020", "b.parquet"), ("2021", "book.xlsx"), ("2021", "table.csv")}


def _made(folder):
    folder.mkdir(parents=True, exist_ok=True)
    return folder


def test_a_year_with_only_a_workbook_is_reported(spark, tmp_path):
    release(spark, tmp_path / "2025/PW.parquet", ["CASE_STATUS"], [("c",)])
    (_made(tmp_path / "2024") / "PW.xlsx").write_bytes(b"x")
    done = wages.amalgamate(spark, str(tmp_path))
    assert done.rows.count() == 1 and [(r.vintage, r.filename) for r in done.errors] == [("2024", "PW.xlsx")]


def test_parts_are_ordered_by_number(spark):
    paths = [f"r/2020/a.parquet/part-{n}-x.parquet" for n in ("100000", "99999", "00001")] + ["r/2020/b.parquet", "r/2019/z.parquet"]
    frame = spark.createDataFrame([(p,) for p in paths], "path string")
    from vintara.plans.releases import file_order, release_of
    got = [r["path"] for r in frame.orderBy(file_order("path", release_of("path"))).collect()]
    assert got == [paths[4], paths[2], paths[1], paths[0], paths[3]]


@pytest.mark.parametrize("path,release_path", [
    ("/d/lca.parquet.d/2020/a.parquet", "/d/lca.parquet.d/2020/a.parquet"),
    ("/d/lca.parquet/2020/a.parquet", "/d/lca.parquet/2020/a.parquet"),
    ("/d/2020/a.parquet.v2.parquet", "/d/2020/a.parquet.v2.parquet"),
    ("/d/2020/a.parquet.v2.parquet/part-0.snappy.parquet", "/d/2020/a.parquet.v2.parquet"),
    ("/d/2020/a.parquet/state=CA/year=2/part-0.parquet", "/d/2020/a.parquet"),
    ("/d/2020/book.xlsx", "/d/2020/book.xlsx"),
])
def test_release_of(spark, path, release_path):
    from vintara.plans.releases import release_of
    assert spark.createDataFrame([(path,)], "p string").select(release_of("p").alias("r")).first()["r"] == release_path
