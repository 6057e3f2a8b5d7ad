"""One acquisition run: stored pages and a manifest in, the next manifest out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintara.config.sites import SOURCES
from vintara.functions import names, urls
from vintara.operators import manifest as m
from vintara.operators.dedup import keep_first
from vintara.operators.links import discover_files, file_links, first_links
from vintara.session import settle


@dataclass(frozen=True)
class Run:
    outcomes: DataFrame
    manifest: DataFrame


def _placed(found: DataFrame, file_type: str, part: str) -> DataFrame:
    """Add source, folder and path; a (period, url) offered several times is one candidate."""
    placed = found.withColumns({
        "source_id": F.lit(SOURCES[file_type]),
        "file_type": F.lit(file_type),
        "folder": names.storage_folder(F.lit(file_type), "program", part),
    }).withColumn("saved_path", F.concat_ws("/", "folder", "filename"))
    return keep_first(placed, m.ENTRY, ["page_id", "pos", "filename"]).select(
        "program", "year", "period", "url", "filename", "source_id", "file_type", "folder", "saved_path")


def candidates(pages: DataFrame) -> DataFrame:
    """Files the disclosure pages offer, with the entry and path each would be stored under."""
    found = discover_files(pages).withColumn("period", names.program_period("program", "year"))
    return _placed(found.withColumn("pos", F.when(F.col("found_in") == "table", 0).otherwise(1)), "dol", "year")


def labelled_candidates(pages: DataFrame, kind: str) -> DataFrame:
    """The same for the other kinds of pages, whose ``label`` says what a page is about: the
    program of ``monthly`` and ``employer`` pages, the year of ``annual`` and ``yearbook`` ones.
    """
    found = first_links(file_links(pages, kind, keep=["label"]), ["page_id", "url"])
    none = F.lit(None).cast("string")
    if kind == "monthly":
        text = F.when(F.col("text") != "", F.col("text")).otherwise(F.col("href"))
        found = found.withColumns({"program": F.col("label"), "period": names.month_period(text, "url")})
        found = found.withColumns({"year": none, "filename": urls.file_name("url", "period"), "part": F.col("period")})
    elif kind == "employer":
        found = found.withColumn("filename", urls.hub_file_name("url"))
        year = names.year_of_hub_file("filename")
        found = found.withColumns({
            "program": F.col("label"), "year": year, "period": names.hub_period("label", "filename"),
            "part": F.coalesce(year, F.lit("misc"))})
    else:
        filename = urls.yearbook_file_name("href") if kind == "yearbook" else urls.file_name("url", "label")
        found = found.withColumns({
            "program": none, "year": F.col("label"), "period": F.col("label"), "filename": filename,
            "part": F.col("label")})
    file_type = {"employer": "uscis"}.get(kind, kind)
    return _placed(found, file_type, "part")


def acquire(
    offered: DataFrame,
    manifest: DataFrame,
    probe: DataFrame,
    fetched: DataFrame,
    listing: DataFrame,
    run_at: Column,
    mode: str = "safe",
) -> Run:
    """Plan, register what storage already holds, apply the fetch results.

    The outcomes (one row per candidate) are written to the session's shared folder, so the
    pages are not taken apart again for every use of them.
    """
    plan = m.fetch_plan(offered, manifest, probe, mode)
    # the run's own table: written once, then read for the counters and twice for the snapshot
    outcomes = settle(m.fetch_outcomes(plan, fetched, mode, listing))
    return Run(outcomes, m.apply_fetch(manifest, outcomes, run_at))
