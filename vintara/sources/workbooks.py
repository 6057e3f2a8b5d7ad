"""XLSX workbooks as tables of text.

A workbook is a zip of XML parts and is read by one task; the tasks are Spark's, one file
each. The first sheet is streamed row by row and leaves the task in small batches.
"""

from __future__ import annotations

import io
import re
import sys
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from itertools import islice
from xml.etree import ElementTree

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintara.functions.text import na_to_null

# the tasks' functions travel whole: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_BATCH = 2_000
# Number formats that show a date or time.
_DATE_FORMAT_IDS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
_EPOCH, _EPOCH_1904 = datetime(1899, 12, 30), datetime(1904, 1, 1)

ROWS = "path string, row long, cells array<string>, ok boolean, error string"


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _texts(element: ElementTree.Element) -> str:
    """Text runs of a string item, phonetic hints left out."""
    out = []
    for child in element:
        if _local(child.tag) == "t":
            out.append(child.text or "")
        elif _local(child.tag) == "r":
            out += [t.text or "" for t in child if _local(t.tag) == "t"]
    return "".join(out)


def _strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    out: list[str] = []
    with book.open("xl/sharedStrings.xml") as part:
        for _, element in ElementTree.iterparse(part):
            if _local(element.tag) == "si":
                out.append(_texts(element))
                element.clear()
    return out


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Cell style numbers that show dates."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    custom = set()
    styles: set[int] = set()
    for element in root.iter():
        if _local(element.tag) == "numFmt":
            code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", element.get("formatCode", ""))
            if re.search("[dmyhs]", code, re.IGNORECASE):
                custom.add(int(element.get("numFmtId", "0")))
    for element in root.iter():
        if _local(element.tag) == "cellXfs":
            for number, xf in enumerate(element):
                if int(xf.get("numFmtId", "0")) in _DATE_FORMAT_IDS | custom:
                    styles.add(number)
    return styles


def _first_sheet(book: zipfile.ZipFile) -> tuple[str, datetime]:
    """Path of the first sheet listed in the workbook, and the workbook's day zero."""
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    sheet = next(e for e in root.iter() if _local(e.tag) == "sheet")
    link = next(v for k, v in sheet.attrib.items() if _local(k) == "id")
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = next(e.get("Target", "") for e in links if e.get("Id") == link)
    mac = any(_local(e.tag) == "workbookPr" and e.get("date1904") in ("1", "true") for e in root.iter())
    path = target.lstrip("/") if target.startswith("/") else "xl/" + target
    return path, _EPOCH_1904 if mac else _EPOCH


def _column(reference: str) -> int:
    number = 0
    for char in reference:
        if not char.isalpha():
            break
        number = number * 26 + ord(char.upper()) - 64
    return number - 1


def _number(raw: str) -> str:
    """Decimal text: whole numbers without a fraction."""
    if not set(raw) & set(".eE"):
        return str(int(raw))
    value = float(raw)
    return str(int(value)) if value.is_integer() else repr(value)


def _date(raw: str, epoch: datetime) -> str:
    """Date and time of a day number; a fraction alone is a time of day."""
    days = float(raw)
    if epoch is _EPOCH and 1 <= days < 60:
        days += 1  # day 60 is a leap day that 1900 did not have
    moment = epoch + timedelta(milliseconds=round(days * 86_400_000))
    return str(moment.time()) if 0 <= days < 1 else str(moment)


def _value(cell: ElementTree.Element, strings: list[str], dates: set[int], epoch: datetime) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return next((_texts(e) for e in cell if _local(e.tag) == "is"), None)
    raw = next((e.text for e in cell if _local(e.tag) == "v"), None)
    if raw is None or kind == "e":
        return None
    if kind == "s":
        return strings[int(raw)]
    if kind == "b":
        return "True" if raw == "1" else "False"
    if kind == "d":
        return str(datetime.fromisoformat(raw))
    if kind == "n":
        return _date(raw, epoch) if int(cell.get("s", "0")) in dates else _number(raw)
    return raw


def _sheet_rows(content: bytes) -> Iterator[tuple[int, list[str | None]]]:
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        strings, dates = _strings(book), _date_styles(book)
        sheet, epoch = _first_sheet(book)
        with book.open(sheet) as part:
            number = 0
            for _, element in ElementTree.iterparse(part):
                if _local(element.tag) != "row":
                    continue
                number = int(element.get("r", number + 1))
                cells: list[str | None] = []
                for position, cell in enumerate(e for e in element if _local(e.tag) == "c"):
                    reference = cell.get("r")
                    at = _column(reference) if reference else position
                    cells += [None] * (at + 1 - len(cells))
                    cells[at] = _value(cell, strings, dates, epoch)
                yield number, cells
                element.clear()


def _rows_of(path: str, content: bytes) -> Iterator[tuple]:
    try:
        for row, cells in _sheet_rows(content):
            yield path, row, cells, True, None
    except Exception as problem:  # a damaged workbook is a row of the result, not a failed job
        yield path, 0, None, False, f"{type(problem).__name__}: {problem}"


def _read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["path", "row", "cells", "ok", "error"]
    rows = (
        row for frame in frames for path, content in zip(frame["path"], frame["content"])
        for row in _rows_of(path, bytes(content))
    )
    while batch := list(islice(rows, _BATCH)):
        yield pd.DataFrame(batch, columns=names)


def workbook_rows(files: DataFrame) -> DataFrame:
    """Rows of the first sheet of each workbook of ``files(path, content)``.

    ``cells`` is null and ``ok`` false for a workbook that cannot be read.
    """
    return files.select("path", "content").mapInPandas(_read, ROWS)


def workbook_cells(rows: DataFrame) -> DataFrame:
    """Long form (path, row, col, value) of the filled cells."""
    return (
        rows.where("ok").select("path", "row", F.posexplode("cells").alias("col", "value"))
        .where("value IS NOT NULL")
    )


def workbook_table(rows: DataFrame, header: list[str]) -> DataFrame:
    """Table of text of workbooks that share a header: row 1 names the columns.

    Column names are made unique (``name.1``) and unnamed ones numbered; missing-value
    tokens are null.
    """
    seen: dict[str, int] = {}
    columns = []
    for i, text in enumerate(header):
        name = text if text else f"Unnamed: {i}"
        count = seen.get(name, 0)
        seen[name] = count + 1
        columns.append(na_to_null(F.get("cells", F.lit(i))).alias(f"{name}.{count}" if count else name))
    return rows.where("ok AND row > 1").select("path", "row", *columns)


def workbook_headers(rows: DataFrame) -> DataFrame:
    """(path, cells) of each workbook's first row."""
    return rows.where("ok AND row = 1").select("path", "cells")


def missing_outputs(workbooks: DataFrame, outputs: DataFrame) -> DataFrame:
    """Workbooks without a converted sibling of the same stem."""
    def stem(name: str):
        return F.regexp_replace(F.col(name), r"\.[^./]+$", "")

    done = outputs.select(stem("path").alias("_stem")).distinct()
    return workbooks.withColumn("_stem", stem("path")).join(done, "_stem", "left_anti").drop("_stem")


