"""Tables that are kept: the manifest in buckets, cases release by release, the JSON manifest, counts."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
from datetime import datetime
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from vintara.operators import manifest as m
from vintara.plans import lca, manifest_table
from vintara.plans.incremental import CaseStore
from vintara.plans.manifest_store import ManifestStore
from vintara.plans.releases import find_releases
from vintara.sources.listing import fingerprinted
from vintara.sources.manifest_json import read_manifest_json, write_manifest_json

WHEN = datetime(2025, 1, 1)


def _manifest(spark, n: int):
    return spark.range(n).selectExpr(
        "cast(id as string) id", "'s' source_id", "'dol' file_type", "'p' program", "'FY' period", "concat('u', id) url",
        "concat('f', id) filename", "concat('/d/f', id) saved_path", "id bytes", "'x' sha256", "'' etag", "'' last_modified",
        "1 version", "'active' status", "cast(null as string) error_message", "cast(null as timestamp) downloaded_at",
        "cast(null as timestamp) created_at", "cast(null as timestamp) updated_at")


def _outcomes(spark, ids):
    rows = spark.createDataFrame([(i,) for i in ids], "i long")
    return rows.selectExpr(
        "'p' program", "'s' source_id", "'dol' file_type", "'FY' period", "concat('u', i) url", "'/d' folder", "'versioned' outcome",
        "2 next_version", "'y' sha256", "1L bytes", "'e' etag", "'l' last_modified")


def _files(root) -> dict:
    return {str(f.relative_to(root)): f.stat().st_mtime_ns for f in root.rglob("*.parquet")}


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    root = tmp_path / "manifest"
    store, manifest = ManifestStore(str(root), buckets=64), _manifest(spark, 3000)
    store.create(manifest)
    before = _files(root)
    outcomes = _outcomes(spark, [5, 17, 4242])
    touched = store.apply(outcomes, F.lit(WHEN))
    after = _files(root)
    assert 1 <= len(touched) <= 3
    changed = {p.split("/")[0] for p in before.keys() ^ after.keys()}
    assert changed == {f"bucket={b}" for b in touched}
    assert all(after[p] == t for p, t in before.items() if p in after)
    want = m.apply_fetch(manifest, outcomes, F.lit(WHEN))
    assert store.read(spark).exceptAll(want).count() == 0 and store.read(spark).count() == want.count() == 3003
    # once more, as after a run that broke off
    assert store.apply(outcomes, F.lit(WHEN)) == touched
    assert store.read(spark).exceptAll(want).count() == 0 and store.read(spark).count() == 3003
    assert m.constraint_violations(store.read(spark)).count() == 0


def test_a_run_without_news_writes_nothing(spark, tmp_path):
    store = ManifestStore(str(tmp_path / "m"), buckets=8)
    store.create(_manifest(spark, 20))
    before = _files(tmp_path / "m")
    assert store.apply(_outcomes(spark, [1]).withColumn("outcome", F.lit("unchanged")), F.lit(WHEN)) == []
    assert _files(tmp_path / "m") == before


def test_one_entry_with_very_many_versions(spark, tmp_path):
    store = ManifestStore(str(tmp_path / "m"), buckets=4, parts=4)
    many = _manifest(spark, 4000).withColumns({"url": F.lit("u0"), "version": F.col("bytes").cast("int") + 10})
    store.create(many)
    assert len({p.split("/")[0] for p in _files(tmp_path / "m")}) == 1
    assert store.read(spark).count() == 4000


# ---- cases release by release ----


def _tree(spark, root) -> None:
    releases = {"2019/a": [("I-1", "old"), ("I-2", "old"), (None, "old")], "2020/b": [("I-2", "mid"), ("I-3", "mid"), (" i-3", "mid2")],
                "2021/c": [("I-1", "new"), ("I-3", "new"), ("I-4", "new"), (None, "new")]}
    for path, rows in releases.items():
        spark.createDataFrame(rows, "CASE_NUMBER string, CASE_STATUS string").coalesce(1).write.parquet(str(root / f"{path}.parquet"))


def _rows(df) -> list:
    return sorted((tuple(r) for r in df.select("case_number", "case_status", "year").collect()), key=str)


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 2, 0)])
def test_adding_releases_in_any_order_equals_a_full_compile(spark, tmp_path, order):
    _tree(spark, tmp_path / "lca")
    releases = find_releases(spark, str(tmp_path / "lca"))
    want = _rows(lca.compile_lca(spark, str(tmp_path / "lca")))
    store = CaseStore(str(tmp_path / "store"))
    for i in order:
        store.add(spark, [releases[i]])
        shutil.rmtree(tmp_path / "lca" / releases[i].vintage)  # old releases are not read again
    assert _rows(store.read(spark)) == want and len(want) == 5
    assert order in list(permutations(range(3)))


def test_a_batch_that_broke_off_is_written_anew(spark, tmp_path):
    _tree(spark, tmp_path / "lca")
    releases = find_releases(spark, str(tmp_path / "lca"))
    want = _rows(lca.compile_lca(spark, str(tmp_path / "lca")))
    store = CaseStore(str(tmp_path / "store"))
    store.add(spark, releases[:1])
    store.add(spark, releases[1:])
    shutil.rmtree(tmp_path / "store/done/1")  # its mark was never written
    assert {r[2] for r in _rows(store.read(spark))} == {"2019"}
    store.add(spark, releases[1:])
    assert _rows(store.read(spark)) == want


def test_unreadable_releases_are_reported(spark, tmp_path):
    _tree(spark, tmp_path / "lca")
    (tmp_path / "lca/2022").mkdir()
    (tmp_path / "lca/2022/d.parquet").write_bytes(b"damaged")
    store, errors = CaseStore(str(tmp_path / "store")), {}
    store.add(spark, find_releases(spark, str(tmp_path / "lca")), errors)
    assert [r.vintage for r in errors] == ["2022"] and len(_rows(store.read(spark))) == 5
    store.add(spark, [], errors)
    with pytest.raises(ValueError):
        CaseStore(str(tmp_path / "none")).read(spark)


# ---- the JSON manifest ----

FIELDS = ("program", "year", "etag")


def test_json_round_trip(spark, tmp_path):
    rows = [("http://h/a?x=1", "P \"q\"", "2020", None), ("http://h/é", None, "2021", "e\n1"), ("", "", "", "")]
    entries = spark.createDataFrame(rows, "url string, program string, year string, etag string")
    path = str(tmp_path / "manifest.json")
    write_manifest_json(entries, path, FIELDS)
    assert json.loads(open(path, encoding="utf-8").read()) == {u: dict(zip(FIELDS, e)) for u, *e in rows}
    found, damaged = read_manifest_json(spark, path, FIELDS)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(rows, key=str) and damaged.count() == 0
    write_manifest_json(entries.limit(1), path, FIELDS)
    assert len(json.load(open(f"{path}.bak"))) == 3 and len(json.load(open(path))) == 1
    assert not list(tmp_path.glob("*.draft"))


def test_damaged_members_and_documents(spark, tmp_path):
    path = tmp_path / "manifest.json"
    path.write_text('{"a": {"program": "P", "year": 2020, "more": [1]}, "b": "text", "c": [1, 2], "d": null, "a": {"program": "Q"}}')
    found, damaged = read_manifest_json(spark, str(path), FIELDS)
    assert [tuple(r) for r in found.collect()] == [("a", "Q", None, None)]
    assert sorted(r["url"] for r in damaged.collect()) == ["b", "c", "d"]
    (tmp_path / "manifest.json.bak").write_text('{"z": {"year": "1"}}')
    path.write_text('{"a": {"pro')
    assert [r["url"] for r in read_manifest_json(spark, str(path), FIELDS)[0].collect()] == ["z"]
    assert read_manifest_json(spark, str(tmp_path / "none.json"), FIELDS)[0].count() == 0
    path.write_text("")
    (tmp_path / "manifest.json.bak").write_text("[]")
    assert read_manifest_json(spark, str(path), FIELDS)[0].count() == 0


# ---- counts of the pass that writes ----


def test_counts_come_with_the_write(spark, tmp_path):
    rows = [("I-1", "1"), ("I-1", "1"), ("I-2", "0.5"), ("I-3", "x"), ("I-4", "2.25")]
    compiled = spark.createDataFrame(rows, "case_number string, new_employment string")
    done = lca.write_clean(compiled, str(tmp_path / "out"))
    written = spark.read.parquet(str(tmp_path / "out"))
    assert (done.rows_in, done.rows_out, done.duplicates, done.columns_in, done.columns_out) == (5, written.count(), 1, 2, 2)
    assert done.flags_rejected == {"new_employment": 2}


# ---- the manifest in buckets of its paths ----


def test_reconciling_moves_only_the_listing(spark):
    manifest = _manifest(spark, 500).withColumn("saved_path", F.expr("if(bytes % 3 = 0, '/d/hot', saved_path)")).withColumn(
        "status", F.expr("if(bytes % 7 = 0, 'replaced', 'active')"))
    listing = spark.createDataFrame([(f"/d/f{i}",) for i in range(0, 600, 2)] + [("/d/f4",), ("/d/x",)], "path string")
    spark.sql("DROP TABLE IF EXISTS manifest_paths")
    manifest_table.save(manifest, "manifest_paths", buckets=8)
    got, want = (f for f in (manifest_table.reconcile(spark, "manifest_paths", listing, F.lit(WHEN)), m.reconcile(manifest, listing, F.lit(WHEN))))
    assert got.exceptAll(want).count() == 0 and got.count() == want.count() == 500
    assert _paths(manifest_table.untracked(spark, "manifest_paths", listing)) == _paths(m.untracked(manifest, listing).distinct())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = manifest_table.reconcile(spark, "manifest_paths", listing, F.lit(WHEN))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = plan[plan.index("Join"):]
    scan = join[:join.index("FileScan")]
    assert "Exchange" not in scan and "Bucketed: true" in join and "Exchange" in join[join.index("FileScan"):]
    spark.sql("DROP TABLE manifest_paths")


def _paths(df) -> list:
    return sorted(r["path"] for r in df.collect())


def test_only_changed_files_are_fingerprinted(spark, tmp_path):
    for name in "abc":
        (tmp_path / f"{name}.csv").write_text(f"{name} one")
    first = fingerprinted(spark, str(tmp_path))
    held = spark.createDataFrame(first.collect(), first.schema)
    assert {r["path"].rsplit("/", 1)[-1]: r["sha256"] for r in held.collect()} == {
        f"{n}.csv": hashlib.sha256(f"{n} one".encode()).hexdigest() for n in "abc"}
    stat = (tmp_path / "a.csv").stat()
    (tmp_path / "a.csv").write_text("a two")  # same length and time: not opened, so the old fingerprint stays
    os.utime(tmp_path / "a.csv", ns=(stat.st_atime_ns, stat.st_mtime_ns))
    (tmp_path / "b.csv").write_text("b longer")
    (tmp_path / "c.csv").unlink()
    (tmp_path / "d.csv").write_text("d new")
    got = {r["path"].rsplit("/", 1)[-1]: r["sha256"] for r in fingerprinted(spark, str(tmp_path), held).collect()}
    assert got == {n: hashlib.sha256(t.encode()).hexdigest() for n, t in (("a.csv", "a one"), ("b.csv", "b longer"), ("d.csv", "d new"))}
    again = fingerprinted(spark, str(tmp_path), spark.createDataFrame(fingerprinted(spark, str(tmp_path)).collect(), first.schema))
    assert again.count() == 3 and fingerprinted(spark, str(tmp_path), extensions=["zip"]).count() == 0


def test_case_store_sends_no_positions_to_the_tasks(spark, tmp_path):
    """Positions take little room in files and much in memory."""
    _tree(spark, tmp_path / "lca")
    store = CaseStore(str(tmp_path / "store"))
    for release in find_releases(spark, str(tmp_path / "lca")):
        store.add(spark, [release])
    plan = store.read(spark)._jdf.queryExecution().executedPlan().toString()
    assert "_bits" in plan and "_lost" not in plan


def test_buckets_grow_with_the_manifest(spark, monkeypatch):
    manifest, listing = _manifest(spark, 1000), spark.range(0, 1000, 2).selectExpr("concat('/d/f', id) AS path")
    monkeypatch.setattr(manifest_table, "BUCKET_ROWS", 40)
    manifest_table.save(manifest, "manifest_grown", buckets=8)
    got, want = (f for f in (manifest_table.reconcile(spark, "manifest_grown", listing, F.lit(WHEN)), m.reconcile(manifest, listing, F.lit(WHEN))))
    assert got.exceptAll(want).count() == 0 and got.count() == 1000
    detail = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE EXTENDED manifest_grown").collect()}
    assert int(detail["Num Buckets"]) == 25
    spark.sql("DROP TABLE manifest_grown")
