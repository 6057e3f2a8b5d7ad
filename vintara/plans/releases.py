"""Which release files to read, and reading those that share a header in one scan."""

from __future__ import annotations

import logging
import re
from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vintara.functions.text import quoted
from vintara.operators.harmonise import Layout, candidates, contested_columns, harmonise, union_all
from vintara.sources.footers import count_values
from vintara.sources.listing import list_files, release_files
from vintara.sources.tables import read_release, schema_of

log = logging.getLogger(__name__)

#: First row wins in the order of year folder, release, part.
ORDER = ["_file_order", "_row_index"]

#: What may hold a release that is not read: reported, never passed over in silence.
UNREAD = ["xlsx", "xls", "csv"]


def release_of(path: str | Column) -> Column:
    """Path of the release a file belongs to: the file itself, or the folder of parts it lies in,
    whose own name ends in ``.parquet``. Partition folders below that belong to it."""
    return F.regexp_replace(path, r"(\.parquet)(?:/[^/=]+=[^/]*)*/[^/]+$", "$1")


def file_order(path: str | Column, release: str | Column) -> Column:
    """Sorts files by release, then part number (not its text), then path."""
    part = F.lpad(F.regexp_extract(path, r"/part-(\d+)[^/]*$", 1), 12, "0")
    return F.concat_ws("/", release, part, path)


@dataclass(frozen=True)
class Release:
    path: str
    vintage: str
    filename: str


def find_releases(spark: SparkSession, root: str, companions: bool = False) -> list[Release]:
    """Releases below ``root`` in reading order: one entry per file, not per row or part."""
    parts = list_files(spark, root, ["parquet"])
    paths = parts.select(release_of("path").alias("path")).distinct()
    rows = release_files(paths, ["parquet"], companions).select("path", "vintage", "filename").collect()
    return [Release(*row) for row in rows]


def find_unread(spark: SparkSession, root: str, releases: Sequence[Release], companions: bool = False) -> dict[Release, str]:
    """Data files below ``root`` that are no Parquet release and have none of their name beside
    them, each with the reason it is not read."""
    files = release_files(list_files(spark, root, UNREAD), UNREAD, companions)
    rows = files.select("path", "vintage", "filename").collect()
    read = {r.path.removesuffix(".parquet") for r in releases}
    return {Release(*row): f"{row['filename'].rsplit('.', 1)[1]} without a Parquet release: convert it first"
            for row in rows if row["path"].rsplit(".", 1)[0] not in read}


def read_headers(
    spark: SparkSession, releases: Sequence[Release]
) -> tuple[dict[Release, StructType], dict[Release, str]]:
    """Schema of each readable release, and the reason for each unreadable one; footers are read
    side by side."""
    def header(release: Release) -> StructType | str:
        try:
            return schema_of(spark, release.path)
        except Exception as problem:  # a damaged release must not stop the others
            return str(problem).splitlines()[0]

    with ThreadPoolExecutor(16) as pool:
        found = dict(zip(releases, pool.map(header, releases)))
    errors = {r: problem for r, problem in found.items() if isinstance(problem, str)}
    report(errors)
    return {r: schema for r, schema in found.items() if r not in errors}, errors


def _counted(spark: SparkSession, paths: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(path, on_disk, readable) for each file of releases with one header.

    On disk is what the footers say; no column is read for it. Readable are the rows whose
    ``columns`` can all be decoded, pages checked against their checksums; what a damaged file
    yields before it breaks off counts, the other files are not touched by it.
    """
    path = F.col("_metadata.file_path").alias("path")
    there = spark.read.parquet(*paths).groupBy(path).agg(F.count("*").alias("on_disk"))
    rows = spark.read.options(**{"ignoreCorruptFiles": "true", "parquet.page.verify-checksum.enabled": "true"}).parquet(*paths)
    # a hash that the optimizer cannot know makes the scan decode every value
    decoded = F.xxhash64(*[F.col(quoted(c)) for c in columns]) >= F.lit(-2**63) if columns else F.lit(True)
    read = rows.groupBy(path).agg(F.count_if(decoded).alias("readable"))
    zero = F.lit(0).cast("long")
    return there.select("path", "on_disk", zero.alias("readable")).unionByName(
        read.select("path", zero.alias("on_disk"), "readable"))


def count_rows(
    spark: SparkSession, headers: Mapping[Release, StructType], used: Callable[[Sequence[str]], Sequence[str]] = list
) -> DataFrame:
    """Rows on disk and readable rows of each file: (release, path, on_disk, readable).

    One job over all releases; ``used`` gives the columns of a header that have to be readable.
    """
    counted = union_all([
        _counted(spark, [r.path for r in group], used(headers[group[0]].names)) for group in by_header(headers)])
    return counted.groupBy("path").agg(F.sum("on_disk").alias("on_disk"), F.sum("readable").alias("readable")).withColumn(
        "release", release_of("path"))


def find_damaged(
    spark: SparkSession, headers: Mapping[Release, StructType], used: Callable[[Sequence[str]], Sequence[str]] = list
) -> dict[Release, str]:
    """Releases that have a sound footer but rows that cannot be read, with the reason."""
    if not headers:
        return {}
    short = count_rows(spark, headers, used).where("readable < on_disk").groupBy("release").agg(
        F.sum("readable").alias("readable"), F.sum("on_disk").alias("on_disk"), F.count("*").alias("files"),
        F.min("path").alias("path"))
    by_path = {r.path: r for r in headers}
    found = {}
    for row in short.collect():  # a row per damaged release
        release = next(r for path, r in by_path.items() if _same_path(path, row["release"]))
        found[release] = (f"{row['on_disk'] - row['readable']} of {row['on_disk']} rows unreadable in {row['files']} file(s), "
                          f"the first being {row['path']}")
    report(found)
    return found


def _spellings(spark: SparkSession, path: str) -> list[str]:
    """A path as listed, and as it is named beside rows, percent-encoded."""
    return list(dict.fromkeys([path, spark._jvm.org.apache.hadoop.fs.Path(path).toUri().toString()]))


def _same_path(a: str, b: str) -> bool:
    """Whether two spellings (percent-encoded or not, with one or three slashes) are one path."""
    return unquote(re.sub("^file:/+", "/", a)) == unquote(re.sub("^file:/+", "/", b))


def by_header(headers: Mapping[Release, StructType]) -> list[list[Release]]:
    """The releases in groups that share a header, so that each group is one scan."""
    same: dict[str, list[Release]] = defaultdict(list)
    for release, schema in headers.items():
        same[schema.json()].append(release)
    return list(same.values())


def report(errors: Mapping[Release, str]) -> None:
    for release, problem in errors.items():
        log.warning("cannot read %s: %s", release.path, problem)


def used_columns(layout: Layout) -> Callable[[Sequence[str]], list[str]]:
    """Which columns of a header the layout reads."""
    def used(names: Sequence[str]) -> list[str]:
        return [names[p] for p in sorted({p for ps in candidates(names, layout).values() for p in ps})]

    return used


def with_origin(df: DataFrame) -> DataFrame:
    """Release, folder and file name of each row, by cheap cuts of its file path."""
    return df.withColumn("_release", release_of("_file_path")).withColumns({
        "_vintage": F.substring_index(F.substring_index("_release", "/", -2), "/", 1),
        "_release_name": F.substring_index("_release", "/", -1),
        "_file_order": file_order("_file_path", "_release"),
    })


def harmonise_releases(
    spark: SparkSession,
    headers: Mapping[Release, StructType],
    layout: Layout,
    lineage: Callable[[], Mapping[str, Column]],
) -> DataFrame:
    """Union of all releases on the canonical layout, one scan per distinct header.

    Keeps the origin of each row beside the canonical columns. Which of the columns that map to one
    target hold values at all is read from the footers of the releases.
    """
    contested = {r: contested_columns(s.names, layout) for r, s in headers.items()}
    values = count_values(spark, {r.path: names for r, names in contested.items() if names})
    frames = []
    keep = (*ORDER, "_release", "_vintage", "_release_name")
    for group in by_header(headers):
        df = with_origin(read_release(spark, *[r.path for r in group]))
        filled = {c: [p for r in group if values[r.path][c] for p in _spellings(spark, r.path)] for c in contested[group[0]]}
        frames.append(harmonise(df, layout, lineage(), keep, file="_release", filled=filled))
    return union_all(frames)
