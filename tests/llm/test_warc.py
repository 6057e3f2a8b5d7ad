from __future__ import annotations

import base64
import hashlib

import pytest
import zstandard

from vintara.llm import queries, warc

SF = "/root/testdata/sf0.001"


def _want(pages: list[tuple[int | None, str | None]], least: int = 0) -> list[tuple]:
    top: dict[bytes, int] = {}
    for key, html in pages:
        data = (html or "").encode()
        if key is not None:
            top[data] = max(top.get(data, key), key)
    out = []
    for key, html in pages:
        data = (html or "").encode()
        keeper = top.get(data)
        again = len(data) >= least and keeper is not None and keeper != key
        out.append((key, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "revisit" if again else "response", keeper if again else None))
    return sorted(out, key=str)


def _got(frame) -> list[tuple]:
    rows = frame.collect()
    assert all(r.error is None for r in rows)
    return sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows], key=str)


def test_query_equals_brute_force(spark):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert _got(queries.op2_warc(spark, SF)) == _want(pages)


@pytest.mark.parametrize("least", [0, 3])
def test_copies_nulls_and_repeats(spark, least):
    pages = [(1, "abc"), (2, "abc"), (3, "abc"), (3, "abc"), (4, None), (5, ""), (6, "é" * 100_000), (None, "abc"),
             (None, "lone"), (7, "ab"), (8, "ab"), (3, "other")]
    frame = spark.createDataFrame([(k, "http://x/\r\n%41 é", h, 1) for k, h in pages],
                                  "page_id long, url string, html string, digest int")
    assert _got(warc.pages_round_trip(frame, least=least)) == _want(pages, least)
    assert {r.target_uri for r in warc.pages_round_trip(frame).collect()} == {"http://x/\r\n%41 é"}
    assert warc.pages_round_trip(frame.limit(0)).count() == 0


def test_files_on_disk(spark, tmp_path):
    records = [warc.record(f"urn:{i}", None, b"<p>text of a page</p>" * i, None) for i in range(50)]
    (tmp_path / "a.warc.zst").write_bytes(warc.archive(records))
    read = warc.read_archives(spark.read.format("binaryFile").load(str(tmp_path))).collect()
    assert [r.payload for r in sorted(read, key=lambda r: len(r.payload))] == [b"<p>text of a page</p>" * i for i in range(50)]


def test_damage_is_reported(spark):
    good = warc.archive([warc.record(f"urn:{i}", "u", b"x" * 500, None) for i in range(3)])
    wrong = warc.record("urn:1", "u", b"payload", None).replace(b"payload\r\n\r\n", b"pay1oad\r\n\r\n")
    short = warc.record("urn:1", "u", b"payload", None).replace(b"payload\r\n\r\n", b"payl\r\n\r\n")
    files = [("cut", good[:-20]), ("plain", b"no archive"), ("empty", b""), ("null", None), ("digest", warc.archive([wrong])),
             ("length", warc.archive([short])), ("header", warc.archive([b"WARC/1.1\r\n\r\n"])), ("good", good)]
    read = warc.read_archives(spark.createDataFrame([(n, bytearray(c) if c is not None else None) for n, c in files],
                                                    "path string, content binary")).collect()
    broken = {r.path for r in read if r.error}
    assert broken == {"cut", "plain", "empty", "null", "digest", "length", "header"}
    assert sum(r.path == "good" and r.error is None for r in read) == 3
    assert sum(r.path == "cut" and r.error is None for r in read) == 2


def test_compressed_dictionary():
    content = b"a dictionary of words that records have " * 20
    packed = zstandard.ZstdCompressor().compress(content)
    use = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(content))
    head = (0x184D2A5D).to_bytes(4, "little") + len(packed).to_bytes(4, "little") + packed
    assert list(warc.frames(head + use.compress(b"words that records have") + use.compress(b""))) == [b"words that records have", b""]
