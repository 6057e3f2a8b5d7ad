"""Prevailing-wage releases: one main file per year, mapped onto the newest header."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara.config.wages import IGNORED_HEADERS, WAGE_RENAMES
from vintara.functions.text import quoted
from vintara.operators.harmonise import resolve_header, resolve_headers, union_all, unmapped_report
from vintara.plans.releases import Release, find_damaged, read_headers, release_of, report
from vintara.sources.listing import list_files, main_files, with_vintage
from vintara.sources.tables import mapping_dict, mapping_of


@dataclass(frozen=True)
class Amalgamated:
    rows: DataFrame
    headers: DataFrame
    errors: dict[Release, str]

    @property
    def unmapped(self) -> DataFrame:
        return unmapped_report(self.headers)


def main_releases(spark: SparkSession, root: str) -> list[Release]:
    """The main file of each all-digit folder below ``root``; a workbook where there is no Parquet."""
    paths = list_files(spark, root, ["parquet", "xlsx", "xls"]).select(
        release_of("path").alias("path")).distinct()
    yearly = with_vintage(paths).where(F.col("vintage").rlike("^[0-9]+$"))
    rows = main_files(yearly, ["parquet", "xlsx", "xls"]).orderBy(F.col("vintage").cast("int")).select(
        "path", "vintage", "filename").collect()
    return [Release(*row) for row in rows]


def amalgamate(
    spark: SparkSession,
    root: str,
    target_year: int = 2025,
    renames: Mapping[str, str] = WAGE_RENAMES,
    ignored: Mapping[int, Sequence[str]] = IGNORED_HEADERS,
    mapping: DataFrame | None = None,
    verify: bool = True,
) -> Amalgamated:
    """Union of the yearly main files with the columns of ``target_year``'s file.

    Headers match exactly. ``mapping(original, final)`` replaces the built-in table. A
    release that cannot be read is reported and skipped, also one whose footer is sound and whose
    rows are not; without ``verify`` the pass that finds the latter is left out. The header of the
    target year counts even where its rows are lost.
    """
    found = main_releases(spark, root)
    books = {r: "workbook without a Parquet release: convert it first" for r in found if not r.path.endswith(".parquet")}
    report(books)
    headers, errors = read_headers(spark, [r for r in found if r not in books])
    errors |= books
    target = next((s.names for r, s in headers.items() if int(r.vintage) == target_year), None)
    if target is None:
        raise ValueError(f"no main file for {target_year} below {root}")
    names = spark.createDataFrame(
        [(int(r.vintage), pos, name) for r, s in headers.items() for pos, name in enumerate(s.names)],
        "year int, pos int, name string")
    table = mapping_dict(mapping) if mapping is not None else mapping_of(target, renames)
    def used(release: Release) -> dict[str, str]:
        return resolve_header(headers[release].names, table, target, ignored.get(int(release.vintage), ()))

    if verify:
        # the mapping depends on the year, so releases of one header may differ in what they use
        uses = {tuple(headers[r].names): set() for r in headers}
        for release in headers:
            uses[tuple(headers[release].names)] |= set(used(release).values())
        errors |= find_damaged(spark, headers, lambda names: [n for n in names if n in uses[tuple(names)]])
    sound = [r for r in headers if r not in errors]
    if not sound:
        raise ValueError(f"no readable main file below {root}")
    resolved = resolve_headers(names.where(F.col("year").isin([int(r.vintage) for r in sound])), table, target, ignored)
    missing = F.lit(None).cast("string")
    frames = []
    for release in sound:
        year = int(release.vintage)
        found = used(release)
        frames.append(spark.read.parquet(release.path).select(
            *[F.col(quoted(found[t])).cast("string").alias(t) if t in found else missing.alias(t)
              for t in target],
            F.lit(year).alias("SOURCE_YEAR"),
        ))
    return Amalgamated(union_all(frames), resolved, errors)
