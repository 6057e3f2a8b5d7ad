"""Versioned manifest of source files, as set-based jobs over snapshots.

A manifest snapshot has one row per (period, url, version); a run turns one snapshot and
the run's inputs (candidates, probe results, fetch results, storage listing) into the next.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintara.config.sites import FILE_TYPES, STATUSES
from vintara.functions import urls
from vintara.operators.dedup import keep_first
from vintara.operators.joins import lookup_join
from vintara.operators.profile import conditional_counts

MANIFEST = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("source_id", T.StringType(), False),
    T.StructField("file_type", T.StringType(), False),
    T.StructField("program", T.StringType()),
    T.StructField("period", T.StringType(), False),
    T.StructField("url", T.StringType(), False),
    T.StructField("filename", T.StringType(), False),
    T.StructField("saved_path", T.StringType(), False),
    T.StructField("bytes", T.LongType()),
    T.StructField("sha256", T.StringType()),
    T.StructField("etag", T.StringType()),
    T.StructField("last_modified", T.StringType()),
    T.StructField("version", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("downloaded_at", T.TimestampType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])

ENTRY = ["period", "url"]
OUTCOMES = ["downloaded", "versioned", "skipped", "unchanged", "errors"]


# ---- reports ----


def active(manifest: DataFrame) -> DataFrame:
    return manifest.where("status = 'active'")


def latest_active(manifest: DataFrame) -> DataFrame:
    """Highest active version of each (period, url)."""
    return keep_first(active(manifest), ENTRY, [F.desc("version"), F.desc("id")])


def active_summary(manifest: DataFrame) -> DataFrame:
    """Files, bytes and age of the active files by source, type and program."""
    by = ["source_id", "file_type", "program"]
    return (
        active(manifest).groupBy(*by)
        .agg(
            F.count("*").alias("file_count"),
            F.sum("bytes").alias("total_bytes"),
            F.min("downloaded_at").alias("oldest_download"),
            F.max("downloaded_at").alias("newest_download"),
        )
        .orderBy("source_id", "file_type", F.asc_nulls_last("program"))
    )


def active_by_source(manifest: DataFrame) -> DataFrame:
    by = ["source_id", "file_type"]
    return active(manifest).groupBy(*by).agg(F.count("*").alias("file_count")).orderBy(*by)


def active_files(manifest: DataFrame, source_id: str) -> DataFrame:
    """Active files of one source, by period and url."""
    return active(manifest).where(F.col("source_id") == source_id).orderBy("period", "url", "version")


def recent_downloads(manifest: DataFrame, top: int = 100) -> DataFrame:
    """Newest downloads first; files without a time lead."""
    return (
        manifest.orderBy(F.desc_nulls_first("downloaded_at"), "period", "url", F.desc("version"))
        .limit(top)
        .select("source_id", "file_type", "program", "period", "filename", "bytes",
                "downloaded_at", "status")
    )


def missing_files(manifest: DataFrame) -> DataFrame:
    return (
        manifest.where("status = 'missing'")
        .select("id", "source_id", "file_type", "program", "period", "filename", "saved_path",
                "downloaded_at", "updated_at")
        .orderBy(F.desc_nulls_first("updated_at"), "id")
    )


def next_versions(manifest: DataFrame) -> DataFrame:
    """Next version of each known (period, url), whatever the status."""
    return manifest.groupBy(*ENTRY).agg(
        (F.coalesce(F.max("version"), F.lit(0)) + 1).cast("int").alias("next_version")
    )


def constraint_violations(manifest: DataFrame) -> DataFrame:
    """Rows per broken rule: one count of duplicate keys, one pass for the rest."""
    repeated = (
        manifest.groupBy(*ENTRY, "version").agg(F.count("*").alias("n")).where("n > 1")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
        .select(F.lit("unique(period,url,version)").alias("rule"), "rows")
    )
    required = [f.name for f in MANIFEST if not f.nullable]
    checks = {f"not_null({name})": F.col(name).isNull() for name in required}
    checks["file_type"] = ~F.col("file_type").isin(FILE_TYPES)
    checks["status"] = ~F.col("status").isin(STATUSES)
    names = list(checks)
    counted = manifest.agg(*[F.count_if(c).alias(n) for n, c in checks.items()])
    long = counted.unpivot([], [F.col(f"`{n}`") for n in names], "rule", "rows")
    return repeated.unionByName(long).where("rows > 0").orderBy("rule")


# ---- storage ----


def _stored_files(listing: DataFrame) -> DataFrame:
    """(saved_path, bytes, sha256) of a listing, once for each path even if it was listed twice."""
    file = F.max(F.struct("length", "sha256"))
    return listing.groupBy(F.col("path").alias("saved_path")).agg(file.alias("f")).select(
        "saved_path", F.col("f.length").alias("bytes"), "f.sha256")


def reconcile(manifest: DataFrame, listing: DataFrame, run_at: Column) -> DataFrame:
    """Next snapshot: active files that storage no longer holds become ``missing``.

    ``listing(path)`` holds the files found; one listed twice counts once.
    """
    found = listing.select(F.col("path").alias("saved_path")).distinct().withColumn("_found", F.lit(True))
    joined = lookup_join(manifest, found, ["saved_path"])
    lost = (F.col("status") == "active") & F.col("_found").isNull()
    return joined.withColumns({
        "status": F.when(lost, "missing").otherwise(F.col("status")),
        "updated_at": F.when(lost, run_at).otherwise(F.col("updated_at")),
    }).drop("_found")


def untracked(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """Files found that no active entry refers to."""
    known = active(manifest).select(F.col("saved_path").alias("path")).distinct()
    return lookup_join(listing, known, ["path"], "left_anti")


def untracked_report(files: DataFrame, shown: int = 10) -> DataFrame:
    """The first paths, and how many more there are."""
    total = files.agg(F.count("*")).scalar()
    first = files.orderBy("path").limit(shown).select("path")
    return first.withColumn("more", F.greatest(total - shown, F.lit(0)).cast("bigint"))


# ---- planning ----


def _text(name: str) -> Column:
    """Header value; empty counts as absent."""
    return F.nullif(F.col(name), F.lit(""))


def entry_states(manifest: DataFrame) -> DataFrame:
    """What a run needs to know of each (period, url): its latest active version's headers,
    size and hash, and the highest version whatever the status.

    One aggregate with map-side combine, so the manifest is scanned and shuffled once and an
    entry may have any number of versions.
    """
    held = F.struct("version", "etag", "last_modified", "bytes", "sha256")
    live = F.when(F.col("status") == "active", F.struct("version", "id"))
    return (
        manifest.groupBy(*ENTRY)
        .agg(F.max_by(held, live).alias("held"), F.max("version").alias("top_version"))
    )


def _plan_rules(mode: str) -> Column:
    etag_same = _text("held.etag") == _text("probe_etag")
    size_fits = (F.col("held.bytes") == F.col("probe_length")) | F.col("probe_length").isNull()
    modified_same = (_text("held.last_modified") == _text("probe_modified")) & size_fits

    def verdict(decision: str, reason: str) -> Column:
        return F.struct(F.lit(decision).alias("decision"), F.lit(reason).alias("reason"))

    rules = F.when(F.col("held").isNull(), verdict("download", "unseen"))
    if mode == "fast":
        return rules.otherwise(verdict("skip", "seen-fast"))
    return (
        rules
        .when(~F.coalesce(F.col("probe_ok"), F.lit(False)), verdict("version", "head-failed"))
        .when(etag_same, verdict("skip", "etag-match"))
        .when(modified_same, verdict("skip", "last-modified-match"))
        .when(F.col("probe_not_modified"), verdict("skip", "not-modified"))
        .otherwise(verdict("version", "content-may-differ"))
    )


def fetch_plan(candidates: DataFrame, manifest: DataFrame, probe: DataFrame, mode: str = "safe") -> DataFrame:
    """Candidates with ``decision`` (skip, download, version) and ``reason``.

    ``candidates`` have one row per (period, url). ``probe(url, http_ok, etag, last_modified,
    content_length, not_modified)`` has at most one row per url; a url without one counts as
    a failed probe. ``held_sha256`` and ``next_version`` go along for the steps after the
    fetch, so the manifest need not be read for them again.
    """
    joined = candidates.join(entry_states(manifest), ENTRY, "left")
    if mode != "fast":
        seen = probe.select(
            "url",
            F.col("http_ok").alias("probe_ok"),
            F.col("etag").alias("probe_etag"),
            F.col("last_modified").alias("probe_modified"),
            F.col("content_length").alias("probe_length"),
            F.col("not_modified").alias("probe_not_modified"),
        )
        joined = lookup_join(joined, seen, ["url"])
    return joined.withColumn("_plan", _plan_rules(mode)).select(
        *candidates.columns, "_plan.decision", "_plan.reason",
        F.col("held.sha256").alias("held_sha256"),
        (F.coalesce("top_version", F.lit(0)) + 1).cast("int").alias("next_version"),
    )


def plan_by_url(candidates: DataFrame, manifest: DataFrame, probe: DataFrame, listing: DataFrame) -> DataFrame:
    """Plan over an unversioned manifest keyed by url.

    Known url: skip on equal ETag or equal Last-Modified, and when the probe failed but the
    file is there. Unknown url: skip when another entry owns the target path. Otherwise
    download, replacing the entry. ``manifest(url, saved_path, etag, last_modified)`` has
    one row per url, ``candidates`` a ``saved_path`` to store to.
    """
    held = manifest.select(
        "url", F.lit(True).alias("_known"),
        F.col("etag").alias("_etag"), F.col("last_modified").alias("_last_modified"),
    )
    owned = manifest.select("saved_path").distinct().withColumn("_owned", F.lit(True))
    stored = listing.select(F.col("path").alias("saved_path")).distinct().withColumn("_stored", F.lit(True))
    seen = probe.select(
        "url", F.coalesce(F.col("http_ok"), F.lit(False)).alias("_ok"),
        _text("etag").alias("_new_etag"), _text("last_modified").alias("_new_modified"),
    )
    joined = lookup_join(lookup_join(candidates, held, ["url"]), seen, ["url"])
    joined = lookup_join(lookup_join(joined, owned, ["saved_path"]), stored, ["saved_path"])
    ok = F.coalesce(F.col("_ok"), F.lit(False))
    reason = (
        F.when(F.col("_known"),
               F.when(~ok & F.col("_stored"), "probe-failed-file-exists")
               .when(~ok, "probe-failed")
               .when(F.col("_new_etag") == F.col("_etag"), "etag-match")
               .when(F.col("_new_modified") == F.col("_last_modified"), "last-modified-match")
               .otherwise("changed"))
        .when(F.col("_owned"), "path-owned")
        .otherwise("unseen")
    )
    skip = F.col("reason").isin(
        "probe-failed-file-exists", "etag-match", "last-modified-match", "path-owned")
    return (
        joined.withColumn("reason", reason)
        .withColumn("decision", F.when(skip, "skip").otherwise("download"))
        .select(*candidates.columns, "decision", "reason")
    )


def latest_by_url(entries: DataFrame, order: str) -> DataFrame:
    """Unversioned manifest from its log: the last entry of each url."""
    return keep_first(entries, ["url"], [F.desc(order)])


# ---- applying a run ----


def register_existing(plan: DataFrame, listing: DataFrame) -> DataFrame:
    """Planned entries that are not held but whose target file is in storage.

    ``plan`` is a fetch plan whose candidates carry ``saved_path``; ``listing(path, length,
    sha256)`` holds each stored file once.
    """
    return lookup_join(plan.where("reason = 'unseen'"), _stored_files(listing), ["saved_path"], "inner")


def fetch_outcomes(
    plan: DataFrame, fetched: DataFrame, mode: str = "safe", listing: DataFrame | None = None
) -> DataFrame:
    """Plan rows with what became of them.

    ``fetched(period, url, http_304, sha256, bytes, etag, last_modified)`` has one row per
    fetched entry. A planned fetch without one is an error; not-modified responses and, in
    safe mode, equal content leave the entry unchanged. With a ``listing(path, length,
    sha256)`` of storage (each file once, plan rows carrying ``saved_path``), entries not held
    whose file is already there are ``registered`` instead of fetched.
    """
    rows = plan.join(fetched.withColumn("_fetched", F.lit(True)), ENTRY, "left")
    same = F.coalesce(F.col("held_sha256") == F.col("sha256"), F.lit(False)) & F.lit(mode == "safe")
    outcome = F.when(F.col("decision") == "skip", "skipped")
    if listing is not None:
        stored = _stored_files(listing).select("saved_path", F.struct("bytes", "sha256").alias("_stored"))
        rows = lookup_join(rows, stored, ["saved_path"])
        outcome = outcome.when((F.col("reason") == "unseen") & F.col("_stored").isNotNull(), "registered")
    outcome = (
        outcome.when(F.col("_fetched").isNull(), "errors")
        .when(F.col("http_304") | same, "unchanged")
        .when(F.col("decision") == "version", "versioned")
        .otherwise("downloaded")
    )
    rows = rows.withColumn("outcome", outcome)
    if listing is not None:
        found = F.col("outcome") == "registered"
        rows = rows.withColumns({
            "bytes": F.when(found, F.col("_stored.bytes")).otherwise(F.col("bytes")),
            "sha256": F.when(found, F.col("_stored.sha256")).otherwise(F.col("sha256")),
            "etag": F.when(~found, F.col("etag")),
            "last_modified": F.when(~found, F.col("last_modified")),
        })
    return rows.drop("_fetched", "http_304", "_stored")


def new_entries(outcomes: DataFrame, run_at: Column) -> DataFrame:
    """Manifest rows for downloaded, versioned and registered outcomes.

    The version always follows the highest one known, whatever its status, so the key
    (period, url, version) stays unique. ``outcomes`` carry source_id, file_type, program
    and ``folder``.
    """
    plain = urls.file_name("url", "period")
    fresh = outcomes.where(F.col("outcome").isin("downloaded", "versioned", "registered")).withColumn(
        "version", F.col("next_version"))
    filename = F.when(F.col("outcome") == "versioned", urls.versioned_name(plain, F.col("version"))).otherwise(plain)
    saved_path = F.concat_ws("/", "folder", "filename")
    if "saved_path" in outcomes.columns:  # where a registered file was found
        found = F.col("outcome") == "registered"
        filename = F.when(found, urls.last_segment("saved_path")).otherwise(filename)
        saved_path = F.when(found, F.col("saved_path")).otherwise(saved_path)
    return _as_entries(fresh.withColumn("filename", filename).withColumn("saved_path", saved_path), run_at)


def registered_entries(registered: DataFrame, run_at: Column) -> DataFrame:
    """Manifest rows for files found in storage: empty headers."""
    rows = registered.withColumns({
        "version": F.col("next_version"),
        "filename": urls.last_segment("saved_path"),
        "etag": F.lit(""),
        "last_modified": F.lit(""),
    })
    return _as_entries(rows, run_at)


def _as_entries(rows: DataFrame, run_at: Column) -> DataFrame:
    identity = F.md5(F.concat_ws("|", "period", "url", "version").cast("binary"))
    filled = rows.withColumns({
        "id": identity,
        "etag": F.coalesce(F.col("etag"), F.lit("")),
        "last_modified": F.coalesce(F.col("last_modified"), F.lit("")),
        "status": F.lit("active"),
        "error_message": F.lit(None).cast("string"),
        "downloaded_at": run_at,
        "created_at": run_at,
        "updated_at": run_at,
    })
    return filled.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in MANIFEST])


def apply_entries(manifest: DataFrame, entries: DataFrame, run_at: Column) -> DataFrame:
    """Next snapshot: new entries in, the active ones they supersede ``replaced``.

    ``entries`` have one row per (period, url).
    """
    fresh = entries.select(*ENTRY, F.lit(True).alias("_fresh"))
    superseded = F.col("_fresh") & (F.col("status") == "active")
    old = lookup_join(manifest, fresh, ENTRY).withColumns({
        "status": F.when(superseded, "replaced").otherwise(F.col("status")),
        "updated_at": F.when(superseded, run_at).otherwise(F.col("updated_at")),
    })
    names = [f.name for f in MANIFEST]
    return old.select(*names).unionByName(entries.select(*names))


def apply_fetch(manifest: DataFrame, outcomes: DataFrame, run_at: Column) -> DataFrame:
    return apply_entries(manifest, new_entries(outcomes, run_at), run_at)


def outcome_counts(outcomes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counters of a run; registered files count as downloaded."""
    counted = outcomes.withColumn(
        "outcome", F.when(F.col("outcome") == "registered", "downloaded").otherwise(F.col("outcome"))
    )
    return conditional_counts(counted, "outcome", OUTCOMES, by)
