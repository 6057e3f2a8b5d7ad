"""A release whose rows cannot be read is left out and reported, the others come through."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from vintara.plans import lca, perm, releases, wages

GROUP = 1000


def _release(path, columns: dict, **options) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table(columns), path, row_group_size=GROUP, compression="snappy", use_dictionary=False, **options)


def _damage(path, group: int, column: str, flip: bool = False) -> None:
    """Overwrite the pages of a column chunk, or one byte of their values."""
    meta = pq.ParquetFile(path).metadata.row_group(group)
    chunk = next(meta.column(i) for i in range(meta.num_columns) if meta.column(i).path_in_schema == column)
    raw = bytearray(path.read_bytes())
    at, size = chunk.data_page_offset, chunk.total_compressed_size
    if flip:
        raw[at + size - 20] ^= 0x55
    else:
        raw[at:at + size] = b"\xff" * size
    path.write_bytes(bytes(raw))


def _columns(n: int, year: int) -> dict:
    return {"CASE_NUMBER": [f"I-{year}-{i}" for i in range(n)], "CASE_STATUS": [f"status number {i}" for i in range(n)],
            "ODD": [f"odd {i}" for i in range(n)]}


@pytest.fixture
def tree(tmp_path):
    for year in (2019, 2020, 2021):
        _release(tmp_path / str(year) / "a.parquet", _columns(3500, year))
    return tmp_path


def _years(frame) -> dict:
    return {r["year"]: r["count"] for r in frame.groupBy("year").count().collect()}


@pytest.mark.parametrize("group", [0, 2, 3])
def test_a_damaged_row_group_loses_its_release_only(spark, tree, group):
    _damage(tree / "2020/a.parquet", group, "CASE_STATUS")
    errors: dict = {}
    assert _years(lca.compile_lca(spark, str(tree), errors=errors)) == {"2019": 3500, "2021": 3500}
    assert [(r.vintage, r.filename) for r in errors] == [("2020", "a.parquet")]
    assert "of 3500 rows unreadable in 1 file(s)" in next(iter(errors.values()))
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        lca.compile_lca(spark, str(tree)).select("case_status").collect()


def test_rows_kept_and_reported_are_the_rows_on_disk(spark, tree):
    _damage(tree / "2020/a.parquet", 2, "CASE_STATUS")
    found, _ = releases.read_headers(spark, releases.find_releases(spark, str(tree)))
    rows = {r["release"].rsplit("/", 2)[1]: r for r in releases.count_rows(spark, found).collect()}
    assert {y: r["on_disk"] for y, r in rows.items()} == {"2019": 3500, "2020": 3500, "2021": 3500}
    assert rows["2019"]["readable"] == rows["2021"]["readable"] == 3500 and 0 <= rows["2020"]["readable"] < 3500


def test_a_column_that_is_not_used_may_be_damaged(spark, tree):
    _damage(tree / "2020/a.parquet", 1, "ODD")
    errors: dict = {}
    assert _years(lca.compile_lca(spark, str(tree), errors=errors)) == {"2019": 3500, "2020": 3500, "2021": 3500} and not errors


def test_a_flipped_byte_is_found_by_its_checksum(spark, tree):
    _release(tree / "2020/a.parquet", _columns(3500, 2020), write_page_checksum=True)
    _damage(tree / "2020/a.parquet", 1, "CASE_STATUS", flip=True)
    errors: dict = {}
    assert _years(lca.compile_lca(spark, str(tree), errors=errors)) == {"2019": 3500, "2021": 3500}
    assert [r.vintage for r in errors] == ["2020"]


def test_one_damaged_part_of_many(spark, tmp_path):
    for part in range(3):
        _release(tmp_path / f"2020/a b.parquet/part-{part}.parquet", _columns(1500, part))
    _release(tmp_path / "2021/x.parquet", _columns(10, 7))
    _damage(tmp_path / "2020/a b.parquet/part-1.parquet", 1, "CASE_NUMBER")
    errors: dict = {}
    assert _years(lca.compile_lca(spark, str(tmp_path), errors=errors)) == {"2021": 10}
    assert [(r.vintage, r.filename) for r in errors] == [("2020", "a b.parquet")]
    assert "of 1500 rows unreadable in 1 file(s)" in next(iter(errors.values()))


def test_wages_skip_the_damaged_year(spark, tmp_path):
    for year in (2015, 2020, 2025):
        _release(tmp_path / f"{year}/PW.parquet", {"CASE_STATUS": [f"s{i}" for i in range(2500)], "EMPLOYER_FEIN": ["1"] * 2500})
    _damage(tmp_path / "2020/PW.parquet", 2, "CASE_STATUS")
    done = wages.amalgamate(spark, str(tmp_path))
    assert {r["SOURCE_YEAR"]: r["count"] for r in done.rows.groupBy("SOURCE_YEAR").count().collect()} == {2015: 2500, 2025: 2500}
    assert [r.vintage for r in done.errors] == ["2020"] and {r["year"] for r in done.headers.collect()} == {2015, 2025}
    _damage(tmp_path / "2025/PW.parquet", 0, "EMPLOYER_FEIN")  # its header still gives the columns
    done = wages.amalgamate(spark, str(tmp_path))
    assert done.rows.columns == ["CASE_STATUS", "EMPLOYER_FEIN", "SOURCE_YEAR"] and done.rows.count() == 2500
    assert {r.vintage for r in done.errors} == {"2020", "2025"}


def test_a_damaged_perm_release_stops_the_job_at_once(spark, tree):
    _damage(tree / "2020/a.parquet", 2, "CASE_STATUS")
    with pytest.raises(ValueError, match="unreadable releases"):
        perm.compile_perm(spark, str(tree), errors={})


def test_no_release_at_all(spark):
    assert releases.find_damaged(spark, {}) == {}


def test_the_count_on_disk_reads_no_column(spark, tree):
    found, _ = releases.read_headers(spark, releases.find_releases(spark, str(tree)))
    plan = releases.count_rows(spark, found, lambda names: ["CASE_STATUS"])._jdf.queryExecution().executedPlan().toString()
    read = [line.split("ReadSchema:")[1].strip() for line in plan.splitlines() if "ReadSchema:" in line]
    assert sorted(read) == ["struct<>", "struct<CASE_STATUS:string>"]
