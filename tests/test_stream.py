from __future__ import annotations

from datetime import datetime

from vintara.operators import manifest as m
from vintara.plans.manifest_store import ManifestStore
from vintara.streaming.entries import held_results
from vintara.streaming.entries import manifest_stream as entry_stream
from vintara.streaming.manifest import manifest_stream, snapshot_path

RESULT = ("program string, source_id string, file_type string, period string, url string, folder string, decision string, "
          "http_304 boolean, sha256 string, bytes long, etag string, last_modified string, run_at timestamp")


def result(url, sha, day, decision="download"):
    return ("P", "s", "dol", "p", url, "/d", decision, False, sha, 1, "e", "l", datetime(2025, 1, day))


def test_batches_build_snapshots(spark, tmp_path):
    inbox, root, checkpoint = (str(tmp_path / n) for n in ("inbox", "manifest", "checkpoint"))
    first = spark.createDataFrame([], m.MANIFEST)

    def run():
        results = spark.readStream.schema(RESULT).parquet(inbox)
        query = manifest_stream(results, first, root, checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()

    spark.createDataFrame([result("a.x", "1", 1), result("b.x", "1", 1)], RESULT).coalesce(1).write.parquet(inbox)
    run()
    one = spark.read.parquet(snapshot_path(root, 1))
    assert sorted((r["url"], r["version"], r["status"]) for r in one.collect()) == [("a.x", 1, "active"), ("b.x", 1, "active")]
    spark.createDataFrame(
        [result("a.x", "2", 2, "version"), result("b.x", "1", 2, "version"), result("b.x", "0", 1, "version")], RESULT
    ).coalesce(1).write.mode("append").parquet(inbox)
    run()
    two = spark.read.parquet(snapshot_path(root, 2))
    assert sorted((r["url"], r["version"], r["status"]) for r in two.collect()) == [
        ("a.x", 1, "replaced"), ("a.x", 2, "active"), ("b.x", 1, "active")]
    assert m.constraint_violations(two).count() == 0


# ---- a state per entry ----


def _versions(frame) -> list:
    return sorted((r["url"], r["version"], r["status"], r["sha256"], r["filename"], r["created_at"], r["updated_at"]) for r in frame.collect())


def _streamed(spark, tmp_path, name: str, batches: list[list[tuple]], held=None):
    inbox, checkpoint = str(tmp_path / name / "inbox"), str(tmp_path / name / "checkpoint")
    store = ManifestStore(str(tmp_path / name / "store"), buckets=8)
    schema = RESULT + ", held string"
    spark.createDataFrame([], schema).write.parquet(inbox)
    frames = [spark.createDataFrame([(*r, None) for r in batch], schema) for batch in batches]
    frames = ([] if held is None else [held_results(held).select([f.split()[0] for f in schema.split(", ")])]) + frames
    for frame in frames:  # a new run from the checkpoint each time
        frame.coalesce(1).write.mode("append").parquet(inbox)
        results = spark.readStream.schema(schema).parquet(inbox)
        entry_stream(results, store, checkpoint).trigger(availableNow=True).start().awaitTermination()
    return store.read(spark)


def test_any_order_and_any_cut_gives_the_same_manifest(spark, tmp_path):
    rows = [result("a.x", "1", 1), result("a.x", "1", 2, "version"), result("a.x", "2", 3, "version"), result("a.x", "1", 5, "version"),
            result("b.x", "7", 2), result("b.x", "9", 2), result("c.x", "3", 4), result("c.x", "3", 1), result("d.x", "0", 1, "skip")]
    whole = _streamed(spark, tmp_path, "whole", [rows])
    want = _versions(whole)
    assert [(u, v, s, h, f) for u, v, s, h, f, _, _ in want] == [
        ("a.x", 1, "replaced", "1", "a.x"), ("a.x", 2, "replaced", "2", "a.v2.x"), ("a.x", 3, "active", "1", "a.v3.x"),
        ("b.x", 1, "active", "9", "b.x"), ("c.x", 1, "active", "3", "c.x")]
    assert m.constraint_violations(whole).count() == 0
    late = _streamed(spark, tmp_path, "late", [[rows[3], rows[5]], [rows[0], rows[4], rows[7]], rows[1:3] + [rows[6]], rows])
    assert _versions(late) == want


def test_a_stream_goes_on_from_a_manifest(spark, tmp_path):
    first = _streamed(spark, tmp_path, "first", [[result("a.x", "1", 1), result("b.x", "1", 1)]])
    news = [result("a.x", "2", 3, "version"), result("b.x", "1", 3, "version"), result("c.x", "1", 3)]
    got = _streamed(spark, tmp_path, "next", [news], held=first)
    assert [(u, v, s) for u, v, s, *_ in _versions(got)] == [
        ("a.x", 1, "replaced"), ("a.x", 2, "active"), ("b.x", 1, "active"), ("c.x", 1, "active")]
    assert got.where("url = 'b.x'").exceptAll(first).count() == 0


def test_a_batch_touches_its_entries_only(spark, tmp_path):
    root = tmp_path / "few" / "store"
    rows = [result(f"u{i}.x", "1", 1) for i in range(200)]
    _streamed(spark, tmp_path, "few", [rows])
    before = {f: f.stat().st_mtime_ns for f in root.rglob("*.parquet")}
    store, schema = ManifestStore(str(root), buckets=8), RESULT + ", held string"
    spark.createDataFrame([(*result("u7.x", "2", 2, "version"), None)], schema).write.mode("append").parquet(str(tmp_path / "few/inbox"))
    results = spark.readStream.schema(schema).parquet(str(tmp_path / "few/inbox"))
    entry_stream(results, store, str(tmp_path / "few/checkpoint")).trigger(availableNow=True).start().awaitTermination()
    after = {f: f.stat().st_mtime_ns for f in root.rglob("*.parquet")}
    assert len({f.parent for f in before.keys() ^ after.keys()}) == 1 and store.read(spark).count() == 201
