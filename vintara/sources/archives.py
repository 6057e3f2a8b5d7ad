"""Members of zip archives."""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# the tasks' functions travel whole: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MEMBERS = "path string, member string, content binary, ok boolean, error string"


#: Bytes of members that leave a task together.
_BATCH_BYTES = 16 * 1024 * 1024


def _members(path: str, content: bytes) -> Iterator[tuple]:
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            for info in archive.infolist():
                if not info.is_dir():
                    yield path, info.filename, archive.read(info), True, None
    except Exception as problem:  # a damaged archive is a row of the result, not a failed job
        yield path, None, None, False, f"{type(problem).__name__}: {problem}"


def _expand(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["path", "member", "content", "ok", "error"]
    batch: list[tuple] = []
    size = 0
    for frame in frames:
        for path, content in zip(frame["path"], frame["content"]):
            for row in _members(path, bytes(content)):
                batch.append(row)
                size += len(row[2] or b"")
                if size >= _BATCH_BYTES:
                    yield pd.DataFrame(batch, columns=names)
                    batch, size = [], 0
    if batch:
        yield pd.DataFrame(batch, columns=names)


def zip_members(files: DataFrame) -> DataFrame:
    """Members of each archive of ``files(path, content)``, one at a time.

    ``folder`` is where a member belongs: a folder beside the archive, named by its stem. A
    damaged archive yields one row with ``ok`` false.
    """
    return files.select("path", "content").mapInPandas(_expand, MEMBERS).withColumn(
        "folder", F.regexp_replace("path", r"\.[^./]*$", ""))
