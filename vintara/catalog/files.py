"""Fingerprints of contents; archives and workbooks built from the tables for tests."""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara.catalog import query, table
from vintara.sources.archives import zip_members as expand
from vintara.sources.listing import fingerprint
from vintara.sources.workbooks import workbook_cells, workbook_rows


# the tasks' functions travel whole: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@query("SELECT doc_id, sha256(text) AS sha256, cast(octet_length(encode(text)) AS INTEGER) AS bytes FROM documents")
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and size of each text."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", fingerprint("text").alias("sha256"), F.octet_length("text").alias("bytes"))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows over all cores: a small table is one task, but every row becomes a file."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, key)


def _zip(parts: dict[str, str]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in parts.items():
            archive.writestr(name, content)
    return out.getvalue()


def _archives(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        content = [
            b"damaged" if number % 50 == 7 else _zip({"text.txt": text, f"meta/{lang}.txt": lang})
            for number, text, lang in zip(frame["doc_id"], frame["text"], frame["lang"])
        ]
        yield pd.DataFrame({"path": "/z/" + frame["doc_id"].astype(str) + ".zip", "content": content})


def zip_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of an archive per document, every fiftieth of them damaged."""
    rows = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), "doc_id")
    archives = rows.mapInPandas(_archives, "path string, content binary")
    return expand(archives).select("path", "folder", "member", fingerprint("content").alias("sha256"), "ok")


_WORKBOOK = (
    '<workbook xmlns="m" xmlns:r="r"><sheets><sheet name="Data" sheetId="1" r:id="rId7"/></sheets></workbook>')
_LINKS = '<Relationships><Relationship Id="rId7" Target="worksheets/data.xml"/></Relationships>'
_STYLES = ('<styleSheet xmlns="m"><numFmts><numFmt numFmtId="170" formatCode="yyyy\\-mm\\-dd"/></numFmts>'
           '<cellXfs><xf numFmtId="0"/><xf numFmtId="170"/><xf numFmtId="22"/></cellXfs></styleSheet>')


def workbook(header: list[str], customer: int, name: str, balance: float) -> bytes:
    """A workbook with shared, inline, numeric, date and missing cells."""
    shared = "".join(f"<si><t>{escape(h)}</t></si>" for h in header)
    head = "".join(f'<c r="{chr(65 + i)}1" t="s"><v>{i}</v></c>' for i in range(len(header)))
    body = (
        f'<c r="A2"><v>{customer}</v></c>'
        f'<c r="B2" t="inlineStr"><is><r><t>{escape(name[:4])}</t></r><r><t>{escape(name[4:])}</t></r></is></c>'
        f'<c r="D2" s="1"><v>{43000 + customer % 900}</v></c><c r="E2" s="2"><v>{43000.5}</v></c>'
        f'<c r="F2" t="b"><v>{customer % 2}</v></c><c r="G2"><v>{balance!r}</v></c>'
    )
    return _zip({
        "xl/workbook.xml": _WORKBOOK, "xl/_rels/workbook.xml.rels": _LINKS, "xl/styles.xml": _STYLES,
        "xl/sharedStrings.xml": f'<sst xmlns="m">{shared}</sst>',
        "xl/worksheets/data.xml":
            f'<worksheet xmlns="m"><sheetData><row r="1">{head}</row><row r="2">{body}</row></sheetData></worksheet>',
    })


HEADER = ["Customer", "Name & co", "Unused", "Opened", "Seen", "Odd", "Balance"]


def _workbooks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        content = [
            b"damaged" if key % 50 == 7 else workbook(HEADER, int(key), name, float(balance))
            for key, name, balance in zip(frame["c_custkey"], frame["c_name"], frame["c_acctbal"])
        ]
        yield pd.DataFrame({"path": "/w/" + frame["c_custkey"].astype(str) + ".xlsx", "content": content})


def workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spread(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal"), "c_custkey")
    return rows.mapInPandas(_workbooks, "path string, content binary")


def xlsx_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filled cells of a workbook per customer; damaged workbooks have none."""
    return workbook_cells(workbook_rows(workbooks(spark, sf_dir)))
