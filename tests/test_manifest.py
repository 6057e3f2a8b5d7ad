from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from vintara.operators import manifest as m

T0 = datetime(2024, 1, 1)


def run_at(year=2025):
    return F.lit(datetime(year, 1, 1))


def entry(period, url, version, status="active", path=None, **more):
    row = dict(id=f"{period}{url}{version}", source_id="s", file_type="dol", program="P", period=period, url=url,
               filename="f", saved_path=path or f"/d/{period}/{url}/{version}", bytes=10, sha256=f"h{version}", etag="e",
               last_modified="m", version=version, status=status, error_message=None, downloaded_at=T0, created_at=T0,
               updated_at=T0)
    return tuple({**row, **more}[f.name] for f in m.MANIFEST)


def manifest(spark, rows):
    return spark.createDataFrame(rows, m.MANIFEST)


CANDIDATE = "program string, source_id string, file_type string, period string, url string, folder string, saved_path string"
PROBE = "url string, http_ok boolean, etag string, last_modified string, content_length long, not_modified boolean"
FETCHED = "period string, url string, http_304 boolean, sha256 string, bytes long, etag string, last_modified string"


def candidate(period, url):
    return ("P", "s", "dol", period, url, "/d", f"/d/{url}")


def by_rule(held, probe, mode):
    """The plan as a chain of early returns."""
    if held is None:
        return "unseen"
    if mode == "fast":
        return "seen-fast"
    if probe is None or not probe[1]:
        return "head-failed"
    _, _, etag, modified, length, unchanged = probe
    if held["etag"] and etag and held["etag"] == etag:
        return "etag-match"
    if held["last_modified"] and modified and held["last_modified"] == modified and (length is None or length == held["bytes"]):
        return "last-modified-match"
    return "not-modified" if unchanged else "content-may-differ"


@pytest.mark.parametrize("mode", ["safe", "fast"])
def test_plan_equals_the_rules(spark, mode):
    random.seed(5)
    pick = random.choice
    held, rows, probes = {}, [], []
    urls = [f"u{i}" for i in range(300)]
    for url in urls:
        if random.random() < 0.8:
            for version in (1, 2):
                held[url] = {"etag": pick(["", None, "a", "b"]), "last_modified": pick(["", None, "x"]), "bytes": pick([1, 2, None])}
                rows.append(entry("p", url, version, **held[url]))
            rows.append(entry("p", url, 3, status="replaced"))
        if random.random() < 0.9:
            probes.append((url, pick([True, True, True, False, None]), pick(["", None, "a", "b"]), pick([None, "", "x"]),
                           pick([None, 1, 2]), pick([True, False, None])))
    plan = m.fetch_plan(
        spark.createDataFrame([candidate("p", u) for u in urls], CANDIDATE), manifest(spark, rows),
        spark.createDataFrame(probes, PROBE), mode)
    by_url = {p[0]: p for p in probes}
    for r in plan.collect():
        assert r["reason"] == by_rule(held.get(r["url"]), by_url.get(r["url"]), mode)
        assert r["next_version"] == (4 if r["url"] in held else 1)


def test_apply_keeps_one_active_version_and_unique_keys(spark):
    held = manifest(spark, [
        entry("p", "a.x", 1, "replaced"), entry("p", "a.x", 2), entry("p", "b.x", 1), entry("p", "lost.x", 1, "missing"),
        entry("p", "same.x", 1, sha256="new"), entry("p", "kept.x", 1)])
    urls = ["a.x", "lost.x", "same.x", "new.x", "gone.x", "b.x"]
    probe = spark.createDataFrame([(u, True, "z", "z", None, False) for u in urls], PROBE)
    plan = m.fetch_plan(spark.createDataFrame([candidate("p", u) for u in urls], CANDIDATE), held, probe)
    fetched = spark.createDataFrame(
        [("p", u, u == "b.x", "new", 5, None, "lm") for u in urls if u != "gone.x"], FETCHED)
    outcomes = m.fetch_outcomes(plan, fetched)
    assert {r["url"]: r["outcome"] for r in outcomes.collect()} == {
        "a.x": "versioned", "lost.x": "downloaded", "same.x": "unchanged", "new.x": "downloaded", "gone.x": "errors",
        "b.x": "unchanged"}
    counts = m.outcome_counts(outcomes).collect()[0].asDict()
    assert counts == {"downloaded": 2, "versioned": 1, "skipped": 0, "unchanged": 2, "errors": 1}
    after = m.apply_fetch(held, outcomes, run_at())
    got = {(r["url"], r["version"]): (r["status"], r["filename"]) for r in after.collect()}
    assert got[("a.x", 2)][0] == "replaced" and got[("a.x", 3)] == ("active", "a.v3.x")
    # a version after the lost one, where a fixed 1 would break the key
    assert got[("lost.x", 1)][0] == "missing" and got[("lost.x", 2)] == ("active", "lost.x")
    assert got[("new.x", 1)] == ("active", "new.x") and got[("kept.x", 1)][0] == "active"
    assert after.where("status = 'active'").groupBy("period", "url").count().where("count > 1").count() == 0
    assert m.constraint_violations(after).count() == 0
    assert after.columns == [f.name for f in m.MANIFEST]
    new = after.where("url = 'new.x'").collect()[0]
    assert (new["etag"], new["last_modified"], new["saved_path"]) == ("", "lm", "/d/new.x")


def test_reconcile_twice_is_reconcile_once(spark):
    held = manifest(spark, [entry("p", "a", 1, path="/1"), entry("p", "b", 1, path="/2"), entry("p", "c", 1, "missing", path="/3")])
    listing = spark.createDataFrame([("/1", 1), ("/3", 1), ("/4", 1)], "path string, length long")
    once = m.reconcile(held, listing, run_at())
    assert {r["url"]: r["status"] for r in once.collect()} == {"a": "active", "b": "missing", "c": "missing"}
    later = m.reconcile(once, listing, run_at(2026))
    assert sorted(map(tuple, later.collect())) == sorted(map(tuple, once.collect()))
    assert sorted(r["path"] for r in m.untracked(held, listing).collect()) == ["/3", "/4"]
    report = m.untracked_report(m.untracked(held, listing), shown=1).collect()
    assert [tuple(r) for r in report] == [("/3", 1)]


def test_register_only_unknown_files(spark):
    held = manifest(spark, [entry("p", "a", 1), entry("p", "b", 4, "missing")])
    offered = spark.createDataFrame([candidate("p", u) for u in ("a", "b", "c", "d")], CANDIDATE)
    listing = spark.createDataFrame([(f"/d/{u}", 3, "s") for u in ("a", "b", "c")], "path string, length long, sha256 string")
    plan = m.fetch_plan(offered, held, spark.createDataFrame([], PROBE))
    rows = m.registered_entries(m.register_existing(plan, listing), run_at()).collect()
    assert sorted((r["url"], r["version"], r["etag"], r["bytes"]) for r in rows) == [("b", 5, "", 3), ("c", 1, "", 3)]


def test_plan_by_url(spark):
    held = spark.createDataFrame(
        [("a", "/a", "e", "m"), ("b", "/b", "e", "m"), ("c", "/c", None, "m"), ("d", "/d", "e", "m"), ("e", "/e", "e", "m")],
        "url string, saved_path string, etag string, last_modified string")
    offered = spark.createDataFrame(
        [("a", "/a"), ("b", "/b"), ("c", "/c"), ("d", "/d"), ("e", "/e"), ("x", "/a"), ("y", "/y")], "url string, saved_path string")
    probe = spark.createDataFrame(
        [("a", True, "e", None, None, None), ("b", True, "f", "m", 1, None), ("c", True, "", "n", None, None),
         ("d", False, None, None, None, None)], PROBE)
    listing = spark.createDataFrame([("/d",)], "path string")
    got = {r["url"]: (r["decision"], r["reason"]) for r in m.plan_by_url(offered, held, probe, listing).collect()}
    assert got == {
        "a": ("skip", "etag-match"), "b": ("skip", "last-modified-match"), "c": ("download", "changed"),
        "d": ("skip", "probe-failed-file-exists"), "e": ("download", "probe-failed"), "x": ("skip", "path-owned"),
        "y": ("download", "unseen")}


def test_violations(spark):
    rows = [entry("p", "a", 1), entry("p", "a", 1), entry("p", "b", 1, status="odd"), entry("p", "c", 1, file_type="x")]
    got = {r["rule"]: r["rows"] for r in m.constraint_violations(manifest(spark, rows)).collect()}
    assert got == {"unique(period,url,version)": 2, "status": 1, "file_type": 1}


def test_reports(spark):
    held = manifest(spark, [
        entry("p", "a", 1, downloaded_at=None), entry("p", "b", 1), entry("q", "b", 1, "missing", updated_at=None)])
    assert m.recent_downloads(held).collect()[0]["downloaded_at"] is None
    assert m.missing_files(held).collect()[0]["id"] == "qb1"
    assert [r["url"] for r in m.active_files(held, "s").collect()] == ["a", "b"]
    assert tuple(m.active_by_source(held).collect()[0]) == ("s", "dol", 2)


def test_a_file_listed_twice_changes_no_row(spark):
    rows = spark.createDataFrame([("a", "active", None), ("b", "active", None)], "saved_path string, status string, updated_at timestamp")
    listing = spark.createDataFrame([("a",), ("a",)], "path string")
    got = m.reconcile(rows, listing, F.current_timestamp()).collect()
    assert sorted((r["saved_path"], r["status"]) for r in got) == [("a", "active"), ("b", "missing")]
