"""The manifest from a stream of fetch results, with a state per entry.

A batch touches the entries it has results for and nothing else: each entry's state holds the results
that made a version, and the sink rewrites the buckets of those entries (``ManifestStore``). Versions
follow the time of the run, not of arrival: a result that comes late takes its place among the
earlier ones, and the versions after it are counted anew. Of results of one entry and run the last by
content, size and tag counts, so the manifest is the same for any order and any cut into batches.

Rows are planned fetches with their result, as in ``streaming.manifest``; ``held_results`` turns a
manifest into the rows that a stream begins with.
"""

from __future__ import annotations

import hashlib
import json
import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from vintara.functions import urls
from vintara.operators import manifest as m
from vintara.plans.manifest_store import ManifestStore

# the tasks' functions travel whole: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_RESULT = ["program", "source_id", "file_type", "folder", "decision", "http_304", "sha256", "bytes", "etag", "last_modified", "run_at",
           "plain", "held"]
_ROW = ("period string, url string, program string, source_id string, file_type string, folder string, plain string, version int, "
        "versioned boolean, status string, sha256 string, bytes long, etag string, last_modified string, run_at long, replaced_at long, held string")


def held_results(manifest: DataFrame) -> DataFrame:
    """A manifest's rows as the results that a stream begins with; they come out as they are."""
    names = [f.name for f in m.MANIFEST]
    return manifest.select(
        "program", "source_id", "file_type", "period", "url", F.lit("").alias("folder"), F.lit("held").alias("decision"),
        F.lit(False).alias("http_304"), "sha256", "bytes", "etag", "last_modified", F.lit(None).cast("timestamp").alias("run_at"),
        F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("held"))


def versions_of(results: list[dict]) -> tuple[list[dict], list[dict]]:
    """Versions that an entry's results make, and the results that matter for later ones.

    Held rows come first. A response that says not modified, or content equal to the active version's,
    makes no version; any other replaces the active one.
    """
    held = sorted((r for r in results if r["held"]), key=lambda r: r["held"])
    runs: dict[int, dict] = {}
    for r in sorted((r for r in results if not r["held"]), key=lambda r: (
            r["run_at"], r["sha256"] or "", r["bytes"] or 0, r["etag"] or "", bool(r["http_304"]))):
        runs[r["run_at"]] = r
    rows, top, active = [], 0, None
    for r in held:
        row = json.loads(r["held"])
        top = max(top, row["version"] or 0)
        rows.append({"version": row["version"], "status": row["status"], "sha256": row["sha256"], "held": r["held"], "replaced_at": None})
        if row["status"] == "active" and (active is None or (active["version"] or 0) < (row["version"] or 0)):
            active = rows[-1]
    for r in runs.values():
        if r["decision"] == "skip" or r["http_304"] or (active is not None and active["sha256"] == r["sha256"]):
            continue
        top += 1
        for row in rows:
            if row["status"] == "active":
                row.update(status="replaced", replaced_at=r["run_at"])
        active = {**r, "version": top, "versioned": r["decision"] == "version", "status": "active", "replaced_at": None}
        rows.append(active)
    return rows, held + list(runs.values())


def _advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    results = json.loads(state.get[0]) if state.exists else []
    for batch in batches:
        results += json.loads(batch[_RESULT].to_json(orient="records"))
    for r in results:
        r["bytes"] = None if r["bytes"] is None else int(r["bytes"])
    rows, kept = versions_of(results)
    state.update((json.dumps(kept),))
    names = [c.split()[0] for c in _ROW.split(", ")]
    out = pd.DataFrame([{"period": key[0], "url": key[1]} | {n: r.get(n) for n in names[2:]} for r in rows], columns=names)
    yield out.astype({"version": "Int32", "bytes": "Int64", "run_at": "Int64", "replaced_at": "Int64", "versioned": "boolean"})


def entry_versions(results: DataFrame) -> DataFrame:
    """All versions of every entry that a batch has results for, as a stream of updates."""
    given = results.columns
    named = results.withColumns({
        "run_at": F.unix_micros("run_at"), "plain": urls.file_name("url", "period"),
        "held": F.col("held") if "held" in given else F.lit(None).cast("string")})
    rows = named.select("period", "url", *_RESULT).groupBy(*m.ENTRY).applyInPandasWithState(
        _advance, _ROW, "results string", "update", GroupStateTimeout.NoTimeout)
    at = F.timestamp_micros("run_at")
    name = F.when(F.col("versioned"), urls.versioned_name("plain", F.col("version"))).otherwise(F.col("plain"))
    fresh = {
        "id": F.md5(F.concat_ws("|", "period", "url", "version").cast("binary")), "filename": name,
        "saved_path": F.concat_ws("/", "folder", name), "etag": F.coalesce("etag", F.lit("")),
        "last_modified": F.coalesce("last_modified", F.lit("")), "error_message": F.lit(None).cast("string"), "downloaded_at": at,
        "created_at": at, "updated_at": F.coalesce(F.timestamp_micros("replaced_at"), at)}
    before = F.from_json("held", m.MANIFEST)
    kept = {"updated_at": F.coalesce(F.timestamp_micros("replaced_at"), before["updated_at"]), "status": F.col("status")}
    return rows.select(*[F.when(F.col("held").isNotNull(), kept.get(f.name, before[f.name])).otherwise(
        fresh.get(f.name, F.col(f.name))).cast(f.dataType).alias(f.name) for f in m.MANIFEST])


def put_batches(store: ManifestStore) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function; a batch that is repeated writes the same again."""
    def put(rows: DataFrame, batch: int) -> None:
        store.put(rows)

    return put


def manifest_stream(results: DataFrame, store: ManifestStore, checkpoint: str) -> DataStreamWriter:
    """Writer that keeps a store up to date with a stream of fetch results."""
    return entry_versions(results).writeStream.outputMode("update").foreachBatch(put_batches(store)).option(
        "checkpointLocation", checkpoint)
