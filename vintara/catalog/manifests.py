"""Queries over a file manifest derived from events, with customers as candidates."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara.catalog import ORACLES, cases, derive, derive_sql, query, table
from vintara.config.sites import FILE_TYPES, SOURCES, STATUSES
from vintara.operators import manifest as m
from vintara.plans import manifest_table
from vintara.plans.acquire import acquire
from vintara.plans.manifest_store import ManifestStore
from vintara.session import new_folder
from vintara.sources.manifest_json import read_manifest_json, write_manifest_json

RUN = "TIMESTAMP '2025-01-01 00:00:00'"
_USER = "cast(user_id as string)"
_PERIOD = "'FY' || cast(2020 + event_id % 5 as string)"
_PATH = (
    "'/data/' || event_type || '/' || " + _PERIOD + " || '/u' || " + _USER + " || '.v' || cast(event_id + 1 as string) || '.xlsx'"
)
#: One entry per event: the entry of a user's file in a period, versions growing with the event.
MANIFEST = {
    "id": "cast(event_id as string)",
    "source_id": cases("user_id % 5", list(SOURCES.values())[:4], "'uscis'"),
    "file_type": cases("user_id % 5", FILE_TYPES[:4], "'uscis'"),
    "program": "CASE WHEN user_id % 5 = 3 THEN NULL ELSE 'P' || cast(user_id % 3 as string) END",
    "period": _PERIOD,
    "url": f"'http://h/u' || {_USER} || '.xlsx'",
    "filename": f"'u' || {_USER} || '.v' || cast(event_id + 1 as string) || '.xlsx'",
    "saved_path": _PATH,
    "bytes": "cast(floor(value * 100) as bigint)",
    "sha256": "sha2(cast(event_id as string), 256)",
    "etag": "CASE WHEN user_id % 3 = 0 THEN '' ELSE 'e' || cast(user_id % 11 as string) END",
    "last_modified": "CASE WHEN user_id % 4 = 0 THEN NULL ELSE 'm' || cast(user_id % 6 as string) END",
    "version": "cast(event_id + 1 as int)",
    "status": cases("event_id % 7", ["active", "active", "missing", "failed"], "'replaced'"),
    "error_message": "CASE WHEN event_id % 7 = 3 THEN 'HTTP 500' END",
    "downloaded_at": "CASE WHEN event_id % 50 = 0 THEN NULL ELSE ts END",
    "created_at": "ts",
    "updated_at": "CASE WHEN event_id % 60 = 2 THEN NULL ELSE ts END",
}
_COLUMNS = ", ".join(MANIFEST)
MANIFEST_SQL = derive_sql("events", {**MANIFEST, "sha256": "sha256(cast(event_id as string))"})
#: Storage holds most paths; the file of every 7th event is somewhere else.
DISK = {
    "path": f"CASE WHEN event_id % 49 = 7 THEN '/data/extra/' || cast(event_id as string) || '.pdf' ELSE {_PATH} END",
    "length": "cast(floor(value * 100) as bigint)",
}
_CUST = "cast(c_custkey as string)"
CANDIDATES = {
    "program": "c_mktsegment", "source_id": "'dolstats'", "file_type": "'dol'",
    "year": "cast(2020 + c_custkey % 5 as string)",
    "period": "'FY' || cast(2020 + c_custkey % 5 as string)",
    "url": f"'http://h/u' || {_CUST} || '.xlsx'",
    "filename": f"'u' || {_CUST} || '.xlsx'",
    "folder": "'/data/' || c_mktsegment",
}
PROBE = {
    "url": CANDIDATES["url"],
    "http_ok": "CASE WHEN c_custkey % 8 = 1 THEN false WHEN c_custkey % 8 = 2 THEN NULL ELSE true END",
    "etag": "CASE c_custkey % 7 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN 'other' ELSE 'e' || cast(c_custkey % 11 as string) END",
    "last_modified": "CASE WHEN c_custkey % 5 = 1 THEN NULL ELSE 'm' || cast(c_custkey % 6 as string) END",
    "content_length": "CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE c_custkey * 10 END",
    "not_modified": "c_custkey % 13 = 5",
}
FETCHED = {
    "period": CANDIDATES["period"], "url": CANDIDATES["url"], "http_304": "c_custkey % 17 = 3",
    "sha256": "CASE WHEN c_custkey % 9 = 0 THEN '' ELSE sha2(cast(c_custkey as string), 256) END",
    "bytes": "c_custkey * 10", "etag": "'new'", "last_modified": "CASE WHEN c_custkey % 2 = 0 THEN 'mm' END",
}
_FETCHED_SQL = derive_sql("customer", {**FETCHED, "sha256": "CASE WHEN c_custkey % 9 = 0 THEN '' ELSE sha256(cast(c_custkey as string)) END"})


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(table(spark, sf_dir, "events"), MANIFEST)


def disk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(table(spark, sf_dir, "events"), DISK)


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(table(spark, sf_dir, "customer"), CANDIDATES)


def probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(table(spark, sf_dir, "customer"), PROBE)


def fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(table(spark, sf_dir, "customer"), FETCHED)


# ---- reports ----


@query(f"""SELECT source_id, file_type, program, count(*) AS file_count, cast(sum(bytes) AS BIGINT) AS total_bytes,
min(downloaded_at) AS oldest_download, max(downloaded_at) AS newest_download
FROM {MANIFEST_SQL} WHERE status = 'active' GROUP BY ALL""")
def active_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active files by source, type and program."""
    return m.active_summary(snapshot(spark, sf_dir))


@query(f"""SELECT source_id, file_type, count(*) AS file_count FROM {MANIFEST_SQL} WHERE status = 'active' GROUP BY ALL""")
def active_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active files by source and type."""
    return m.active_by_source(snapshot(spark, sf_dir))


@query(f"""SELECT {_COLUMNS} FROM {MANIFEST_SQL} WHERE status = 'active' AND source_id = 'dolstats'""")
def source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active files of one source."""
    return m.active_files(snapshot(spark, sf_dir), "dolstats")


@query(f"""SELECT source_id, file_type, program, period, filename, bytes, downloaded_at, status FROM {MANIFEST_SQL}
ORDER BY downloaded_at DESC NULLS FIRST, period, url, version DESC LIMIT 100""")
def recent_downloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest hundred downloads (a report of a hundred lines)."""
    return m.recent_downloads(snapshot(spark, sf_dir))


@query(f"""SELECT id, source_id, file_type, program, period, filename, saved_path, downloaded_at, updated_at
FROM {MANIFEST_SQL} WHERE status = 'missing'""")
def missing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files lost from storage, newest update first."""
    return m.missing_files(snapshot(spark, sf_dir))


@query(f"""SELECT period, url, cast(max(version) + 1 AS INTEGER) AS next_version FROM {MANIFEST_SQL} GROUP BY ALL""")
def next_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next version of each entry."""
    return m.next_versions(snapshot(spark, sf_dir))


_LATEST_SQL = f"""SELECT {_COLUMNS} FROM {MANIFEST_SQL} WHERE status = 'active'
QUALIFY row_number() OVER (PARTITION BY period, url ORDER BY version DESC) = 1"""


@query(_LATEST_SQL)
def latest_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest active version of each entry."""
    return m.latest_active(snapshot(spark, sf_dir))


BROKEN = {
    **MANIFEST,
    "version": "cast(event_id % 40 as int)",
    "file_type": "CASE WHEN event_id % 31 = 0 THEN 'weekly' ELSE " + MANIFEST["file_type"] + " END",
    "status": "CASE WHEN event_id % 37 = 0 THEN 'gone' ELSE " + MANIFEST["status"] + " END",
    "filename": "CASE WHEN event_id % 41 = 0 THEN NULL ELSE " + MANIFEST["filename"] + " END",
}
_BROKEN_SQL = derive_sql("events", {**BROKEN, "sha256": "''"})
_REQUIRED = [f.name for f in m.MANIFEST if not f.nullable]


@query(
    f"""SELECT * FROM (SELECT 'unique(period,url,version)' AS rule, coalesce(sum(n), 0)::BIGINT AS "rows"
FROM (SELECT count(*) AS n FROM {_BROKEN_SQL} GROUP BY period, url, version HAVING count(*) > 1)"""
    + "".join(f" UNION ALL SELECT 'not_null({c})', count(*) FILTER ({c} IS NULL) FROM {_BROKEN_SQL}" for c in _REQUIRED)
    + f" UNION ALL SELECT 'file_type', count(*) FILTER (file_type NOT IN ({', '.join(repr(t) for t in FILE_TYPES)})) FROM {_BROKEN_SQL}"
    + f" UNION ALL SELECT 'status', count(*) FILTER (status NOT IN ({', '.join(repr(t) for t in STATUSES)})) FROM {_BROKEN_SQL}"
    + ') WHERE "rows" > 0'
)
def constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that break a rule of the manifest."""
    return m.constraint_violations(derive(table(spark, sf_dir, "events"), BROKEN))


# ---- storage ----

_LOST = f"status = 'active' AND saved_path NOT IN (SELECT path FROM {derive_sql('events', DISK)})"
_SAME = ", ".join(c for c in MANIFEST if c not in ("status", "updated_at"))


@query(f"""SELECT {_SAME}, CASE WHEN {_LOST} THEN 'missing' ELSE status END AS status,
CASE WHEN {_LOST} THEN {RUN} ELSE updated_at END AS updated_at FROM {MANIFEST_SQL}""")
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest after a comparison with storage."""
    return m.reconcile(snapshot(spark, sf_dir), disk(spark, sf_dir), F.expr(RUN))


_UNTRACKED_SQL = f"""SELECT path, length FROM {derive_sql('events', DISK)}
WHERE path NOT IN (SELECT saved_path FROM {MANIFEST_SQL} WHERE status = 'active')"""


@query(_UNTRACKED_SQL)
def untracked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored files without an active entry."""
    return m.untracked(snapshot(spark, sf_dir), disk(spark, sf_dir))


@query(f"""SELECT path, cast(greatest((SELECT count(*) FROM ({_UNTRACKED_SQL})) - 10, 0) AS BIGINT) AS more
FROM ({_UNTRACKED_SQL}) ORDER BY path LIMIT 10""")
def untracked_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten untracked files and how many more there are (a report of ten lines)."""
    return m.untracked_report(m.untracked(snapshot(spark, sf_dir), disk(spark, sf_dir)))


# ---- runs ----

_CAND_SQL = derive_sql("customer", CANDIDATES)
_PROBE_SQL = derive_sql("customer", PROBE)
_PLAN_SQL = f"""
SELECT c.*, CASE WHEN a.url IS NULL THEN 'download:unseen'
  WHEN p.http_ok IS NOT TRUE THEN 'version:head-failed'
  WHEN nullif(a.etag, '') = nullif(p.etag, '') THEN 'skip:etag-match'
  WHEN nullif(a.last_modified, '') = nullif(p.last_modified, '') AND (p.content_length IS NULL OR a.bytes = p.content_length)
    THEN 'skip:last-modified-match'
  WHEN p.not_modified THEN 'skip:not-modified' ELSE 'version:content-may-differ' END AS verdict
FROM {_CAND_SQL} c LEFT JOIN ({_LATEST_SQL}) a ON a.period = c.period AND a.url = c.url LEFT JOIN {_PROBE_SQL} p ON p.url = c.url
"""
_PLAN_COLUMNS = ", ".join(CANDIDATES)


@query(f"SELECT {_PLAN_COLUMNS}, split_part(verdict, ':', 1) AS decision, split_part(verdict, ':', 2) AS reason FROM ({_PLAN_SQL})")
def fetch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What to do with each candidate, safe mode."""
    plan = m.fetch_plan(candidates(spark, sf_dir), snapshot(spark, sf_dir), probe(spark, sf_dir))
    return plan.select(*CANDIDATES, "decision", "reason")


@query(f"""SELECT c.*, CASE WHEN a.url IS NULL THEN 'download' ELSE 'skip' END AS decision,
CASE WHEN a.url IS NULL THEN 'unseen' ELSE 'seen-fast' END AS reason
FROM {_CAND_SQL} c LEFT JOIN ({_LATEST_SQL}) a ON a.period = c.period AND a.url = c.url""")
def fetch_plan_fast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What to do with each candidate, fast mode."""
    plan = m.fetch_plan(candidates(spark, sf_dir), snapshot(spark, sf_dir), probe(spark, sf_dir), mode="fast")
    return plan.select(*CANDIDATES, "decision", "reason")


_OUTCOME_SQL = f"""
SELECT x.*, f.sha256, f.bytes, f.etag, f.last_modified,
  CASE WHEN verdict LIKE 'skip:%' THEN 'skipped' WHEN f.url IS NULL THEN 'errors'
       WHEN f.http_304 OR coalesce(a.sha256 = f.sha256, false) THEN 'unchanged'
       WHEN verdict LIKE 'version:%' THEN 'versioned' ELSE 'downloaded' END AS outcome
FROM ({_PLAN_SQL}) x
LEFT JOIN (SELECT * FROM {_FETCHED_SQL} WHERE sha256 <> '') f ON f.period = x.period AND f.url = x.url
LEFT JOIN ({_LATEST_SQL}) a ON a.period = x.period AND a.url = x.url
"""


def run_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = m.fetch_plan(candidates(spark, sf_dir), snapshot(spark, sf_dir), probe(spark, sf_dir))
    # fetches that failed have left no result
    return m.fetch_outcomes(plan, fetched(spark, sf_dir).where("sha256 <> ''"))


@query(f"""SELECT program, {', '.join(f"count(*) FILTER (outcome = '{o}') AS {o}" for o in m.OUTCOMES)}
FROM ({_OUTCOME_SQL}) GROUP BY program""")
def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of a run by program."""
    return m.outcome_counts(run_outcomes(spark, sf_dir), ["program"])


_NEW_SQL = f"""
SELECT md5(period || '|' || url || '|' || cast(version as string)) AS id, source_id, file_type, program, period, url,
  CASE WHEN outcome = 'versioned' THEN replace(filename, '.xlsx', '.v' || cast(version as string) || '.xlsx') ELSE filename END AS filename,
  folder || '/' || CASE WHEN outcome = 'versioned' THEN replace(filename, '.xlsx', '.v' || cast(version as string) || '.xlsx') ELSE filename END AS saved_path,
  bytes, sha256, coalesce(etag, '') AS etag, coalesce(last_modified, '') AS last_modified, version,
  'active' AS status, CAST(NULL AS VARCHAR) AS error_message, {RUN} AS downloaded_at, {RUN} AS created_at, {RUN} AS updated_at
FROM (SELECT o.*, cast(coalesce(v.n, 0) + 1 AS INTEGER) AS version FROM ({_OUTCOME_SQL}) o
      LEFT JOIN (SELECT period, url, max(version) AS n FROM {MANIFEST_SQL} GROUP BY ALL) v ON v.period = o.period AND v.url = o.url
      WHERE outcome IN ('downloaded', 'versioned'))
"""


@query(f"""
WITH fresh AS ({_NEW_SQL})
SELECT {_SAME}, CASE WHEN status = 'active' AND EXISTS (SELECT 1 FROM fresh f WHERE f.period = x.period AND f.url = x.url)
    THEN 'replaced' ELSE status END AS status,
  CASE WHEN status = 'active' AND EXISTS (SELECT 1 FROM fresh f WHERE f.period = x.period AND f.url = x.url)
    THEN {RUN} ELSE updated_at END AS updated_at
FROM {MANIFEST_SQL} x
UNION ALL SELECT {_SAME}, status, updated_at FROM fresh""")
def apply_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next manifest: new versions in, superseded ones replaced."""
    return m.apply_fetch(snapshot(spark, sf_dir), run_outcomes(spark, sf_dir), F.expr(RUN))


@query(ORACLES["apply_fetch"])
def manifest_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same next manifest, kept in buckets of which only the touched ones are rewritten."""
    store = ManifestStore(new_folder(spark), buckets=32)
    store.create(snapshot(spark, sf_dir))
    store.apply(run_outcomes(spark, sf_dir), F.expr(RUN))
    return store.read(spark)


_LATEST_SQL = f"(SELECT * FROM {MANIFEST_SQL} QUALIFY row_number() OVER (PARTITION BY url ORDER BY version DESC) = 1)"
_JSON_FIELDS = ("program", "filename", "period", "saved_path", "sha256", "etag", "last_modified")


@query(f"SELECT url, {', '.join(_JSON_FIELDS)} FROM {_LATEST_SQL}")
def json_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last entry of each url written as one JSON document, and read back."""
    path = f"{new_folder(spark)}/manifest.json"
    write_manifest_json(m.latest_by_url(snapshot(spark, sf_dir), "version"), path, _JSON_FIELDS)
    return read_manifest_json(spark, path, _JSON_FIELDS)[0]


STORED = {
    "path": f"'/data/' || c_mktsegment || '/u' || {_CUST} || CASE WHEN c_custkey % 6 = 0 THEN '.pdf' ELSE '.xlsx' END",
    "length": "c_custkey * 3", "sha256": "'s' || " + _CUST,
}


@query(f"""
SELECT md5(c.period || '|' || c.url || '|' || cast(coalesce(v.n, 0) + 1 as string)) AS id, c.source_id, c.file_type,
  c.program, c.period, c.url, c.filename, s.path AS saved_path, s.length AS bytes, s.sha256, '' AS etag,
  '' AS last_modified, cast(coalesce(v.n, 0) + 1 AS INTEGER) AS version, 'active' AS status,
  CAST(NULL AS VARCHAR) AS error_message, {RUN} AS downloaded_at, {RUN} AS created_at, {RUN} AS updated_at
FROM {_CAND_SQL} c JOIN {derive_sql('customer', STORED)} s ON s.path = c.folder || '/' || c.filename
LEFT JOIN (SELECT period, url, max(version) AS n FROM {MANIFEST_SQL} GROUP BY ALL) v ON v.period = c.period AND v.url = c.url
WHERE NOT EXISTS (SELECT 1 FROM {MANIFEST_SQL} a WHERE a.status = 'active' AND a.period = c.period AND a.url = c.url)""")
def register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries for files that storage holds but the manifest does not."""
    held = snapshot(spark, sf_dir)
    offered = candidates(spark, sf_dir).withColumn("saved_path", F.concat_ws("/", "folder", "filename"))
    stored = derive(table(spark, sf_dir, "customer"), STORED)
    plan = m.fetch_plan(offered, held, probe(spark, sf_dir))
    return m.registered_entries(m.register_existing(plan, stored), F.expr(RUN))


@query(f"""
SELECT x.period, x.url, CASE WHEN x.verdict = 'download:unseen' AND s.path IS NOT NULL THEN 'registered' ELSE x.outcome END AS outcome,
  CASE WHEN x.verdict = 'download:unseen' AND s.path IS NOT NULL THEN s.sha256 ELSE x.sha256 END AS sha256,
  CASE WHEN x.verdict = 'download:unseen' AND s.path IS NOT NULL THEN s.length ELSE x.bytes END AS bytes
FROM ({_OUTCOME_SQL}) x LEFT JOIN {derive_sql('customer', STORED)} s ON s.path = x.folder || '/' || x.filename""")
def acquisition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole run: planned, what storage holds registered, results applied; what became of each candidate."""
    offered = candidates(spark, sf_dir).withColumn("saved_path", F.concat_ws("/", "folder", "filename"))
    run = acquire(
        offered, snapshot(spark, sf_dir), probe(spark, sf_dir), fetched(spark, sf_dir).where("sha256 <> ''"),
        derive(table(spark, sf_dir, "customer"), STORED), F.expr(RUN))
    return run.outcomes.select("period", "url", "outcome", "sha256", "bytes")


# ---- the manifest without versions, keyed by url ----

_LOG = {c: MANIFEST[c] for c in ("url", "etag", "last_modified")} | {
    "saved_path": f"'/data/' || event_type || '/u' || cast(user_id - user_id % 2 as string) || '.xlsx'",
    "logged": "event_id",
}
_BY_PATH = {
    "url": f"'http://h/u' || {_CUST} || '.xlsx'",
    "saved_path": "'/data/' || " + cases("c_custkey % 3", ["click", "view"], "'other'") + f" || '/u' || {_CUST} || '.xlsx'",
}
_STORED_PATHS = {"path": "CASE WHEN c_custkey % 4 = 1 THEN " + _BY_PATH["saved_path"] + " ELSE '/data/none/' || " + _CUST + " END"}


@query(f"""
WITH held AS (SELECT url, saved_path, etag, last_modified FROM {derive_sql('events', _LOG)}
              QUALIFY row_number() OVER (PARTITION BY url ORDER BY logged DESC) = 1),
r AS (SELECT c.url, c.saved_path, CASE WHEN h.url IS NOT NULL THEN
    CASE WHEN p.http_ok IS NOT TRUE THEN CASE WHEN c.saved_path IN (SELECT path FROM {derive_sql('customer', _STORED_PATHS)})
           THEN 'probe-failed-file-exists' ELSE 'probe-failed' END
         WHEN nullif(p.etag, '') = h.etag THEN 'etag-match'
         WHEN nullif(p.last_modified, '') = h.last_modified THEN 'last-modified-match' ELSE 'changed' END
    WHEN c.saved_path IN (SELECT saved_path FROM held) THEN 'path-owned' ELSE 'unseen' END AS reason
  FROM {derive_sql('customer', _BY_PATH)} c LEFT JOIN held h ON h.url = c.url LEFT JOIN {_PROBE_SQL} p ON p.url = c.url)
SELECT *, CASE WHEN reason IN ('probe-failed-file-exists', 'etag-match', 'last-modified-match', 'path-owned')
  THEN 'skip' ELSE 'download' END AS decision FROM r""")
def plan_by_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plan over the unversioned manifest."""
    held = m.latest_by_url(derive(table(spark, sf_dir, "events"), _LOG), "logged").drop("logged")
    return m.plan_by_url(
        derive(table(spark, sf_dir, "customer"), _BY_PATH), held, probe(spark, sf_dir),
        derive(table(spark, sf_dir, "customer"), _STORED_PATHS))


@query(ORACLES["reconcile"])
def reconcile_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same reconciled manifest, from a table in buckets of its paths."""
    name = f"manifest_{uuid.uuid4().hex}"
    manifest_table.save(snapshot(spark, sf_dir), name, buckets=8)
    return manifest_table.reconcile(spark, name, disk(spark, sf_dir), F.expr(RUN))
