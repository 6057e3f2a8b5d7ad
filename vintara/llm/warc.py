"""WARC archives compressed frame by frame with Zstandard and a dictionary of their own.

An archive is a leading skippable frame that holds the dictionary, then one frame per record.
Archives are rows of (path, content), as Spark's ``binaryFile`` source gives them. Writing fills
archives of bounded size from the rows of a task; reading decodes one frame after the other,
checks every header and length, and reports a damaged record as a row with ``error`` set.

Records of equal payload: the one with the largest id is a response, the others revisit it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintara.llm import common
from vintara.operators.joins import lookup_join
from vintara.session import settle

common.by_value(__name__)

#: Bytes of records, not yet compressed, that make an archive.
ARCHIVE_BYTES = 8 << 20
#: Bytes of the archive's first records that its dictionary is trained on, and of the dictionary.
SAMPLE_BYTES, DICTIONARY_BYTES = 1 << 20, 16 << 10
_SKIPPABLE = 0x184D2A5D
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2020-01-01T00:00:00Z"

ARCHIVES = "path string, content binary"
RECORDS = ("path string, record_id string, record_type string, target_uri string, refers_to string, "
           "payload_bytes long, payload_digest string, payload binary, error string")


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# --- writing -----------------------------------------------------------------------------


def _line(value: str) -> str:
    """A header value on one line; anything a header cannot hold is percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}", value)


def _unline(value: str) -> str:
    return re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), value)


def record(record_id: str, uri: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One record; a revisit keeps the HTTP headers and leaves the payload out."""
    found = digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: <{_line(record_id)}>", f"WARC-Date: {_DATE}"]
    if uri is not None:
        lines.append(f"WARC-Target-URI: {_line(uri)}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: <{_line(refers_to)}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{found}",
              f"WARC-Block-Digest: sha1:{digest(block)}", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def archive(records: list[bytes]) -> bytes:
    """The records compressed one by one, after the dictionary trained on the first of them."""
    sample, held = [], 0
    for one in records:
        piece = one[: max(0, SAMPLE_BYTES - held)]
        if not piece:
            break
        sample += [piece[i:i + 4096] for i in range(0, len(piece), 4096)]
        held += len(piece)
    try:
        trained = zstandard.train_dictionary(DICTIONARY_BYTES, sample).as_bytes()
    except zstandard.ZstdError:  # too little to train on: plain content serves as a dictionary too
        trained = b"".join(sample)[:DICTIONARY_BYTES]
    use = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(trained),
                                   write_content_size=True, write_checksum=True)
    frame = _SKIPPABLE.to_bytes(4, "little") + len(trained).to_bytes(4, "little") + trained
    return frame + b"".join(use.compress(one) for one in records)


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"path": [f"{uuid.uuid4().hex}.warc.zst"], "content": [archive(held)]},
                                          schema=pa.schema([("path", pa.string()), ("content", pa.binary())]))

    held: list[bytes] = []
    size = 0
    for batch in batches:
        columns = (batch.column(n) for n in ("record_id", "uri", "payload", "refers_to"))
        for record_id, uri, payload, refers_to in zip(*columns):
            held.append(record(record_id.as_py(), uri.as_py(), payload.as_py(), refers_to.as_py()))
            size += len(held[-1])
            if size >= ARCHIVE_BYTES:
                yield out()
                held, size = [], 0
    if held:
        yield out()


def write_archives(records: DataFrame) -> DataFrame:
    """(path, content) of archives that hold ``records(record_id, uri, payload, refers_to)``."""
    return common.tuned(records).select("record_id", "uri", "payload", "refers_to").mapInArrow(_write, ARCHIVES)


def with_revisits(pages: DataFrame, page_id: str, payload: str, least: int = 0) -> DataFrame:
    """``page_id``, ``uri``, ``payload`` and ``keeper``: the largest id of the rows with the same
    payload of at least ``least`` bytes, null where the row itself is the response.

    Only ids and digests meet by payload, pre-aggregated; payloads move once, by id. Rows that
    repeat the largest id are responses all; a null id counts as smaller than any other.
    """
    size = F.octet_length("payload")
    rows = pages.select(F.col(page_id).alias("page_id"), "uri", F.coalesce(payload, F.lit(b"")).alias("payload"))
    slim = rows.where(size >= least).select("page_id", F.sha1("payload").alias("digest"))
    keepers = slim.groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
    keepers = keepers.where("n > 1 AND keeper IS NOT NULL").drop("n")
    again = lookup_join(slim.distinct(), keepers, ["digest"], "inner")
    again = again.where(~F.col("page_id").eqNullSafe(F.col("keeper")))
    keyed = rows.withColumn("digest", F.sha1("payload"))
    return keyed.join(again.select(F.col("page_id").alias("_id"), F.col("digest").alias("_digest"), "keeper"),
                      F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
                      & (size >= least), "left").drop("_id", "_digest", "digest")


# --- reading -----------------------------------------------------------------------------


def frames(content: bytes) -> Iterator[bytes]:
    """Records of an archive, one decoded frame each; the dictionary comes first."""
    if len(content) < 8 or int.from_bytes(content[:4], "little") != _SKIPPABLE:
        raise ValueError("no leading dictionary frame")
    end = 8 + int.from_bytes(content[4:8], "little")
    trained = content[8:end]
    if len(trained) != end - 8:
        raise ValueError("dictionary cut short")
    if trained[:4] == zstandard.FRAME_HEADER:  # the dictionary itself may be compressed
        trained = zstandard.ZstdDecompressor().decompressobj().decompress(trained)
    use = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(trained))
    rest = content[end:]
    while rest:
        one = use.decompressobj()
        data = one.decompress(rest)
        if not one.eof:
            raise ValueError("frame cut short")
        yield data
        rest = one.unused_data


def parse(data: bytes) -> dict:
    """Fields of one record; raises ValueError where headers or lengths do not hold."""
    head, blank, body = data.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8").split("\r\n")
    if not blank or not re.fullmatch(r"WARC/1\.[01]", first):
        raise ValueError("no WARC header")
    headers: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or name.lower() in headers:
            raise ValueError(f"bad header line {line[:40]!r}")
        headers[name.lower()] = value.strip()
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length"} - set(headers)
    if missing or not headers["content-length"].isdigit():
        raise ValueError(f"missing headers: {', '.join(sorted(missing)) or 'content-length'}")
    length = int(headers["content-length"])
    if len(body) != length + 4 or body[length:] != b"\r\n\r\n":
        raise ValueError("the block is not as long as its header says")
    block = body[:length]
    if headers.get("warc-block-digest", f"sha1:{digest(block)}") != f"sha1:{digest(block)}":
        raise ValueError("block digest differs")
    http, blank, payload = block.partition(b"\r\n\r\n")
    declared = re.search(rb"(?im)^content-length: *(\d+) *\r?$", http)
    kind, said = headers["warc-type"], headers.get("warc-payload-digest", "").removeprefix("sha1:")
    if not blank or not declared:
        raise ValueError("no HTTP headers in the block")
    size = int(declared[1])
    if kind == "response" and (len(payload) != size or said != digest(payload)):
        raise ValueError("payload differs from its length or digest")
    if kind == "revisit" and (payload or not said or "warc-refers-to" not in headers):
        raise ValueError("a revisit needs a digest and a target, and has no payload")
    return {"record_id": _unline(headers["warc-record-id"][1:-1]), "record_type": kind,
            "target_uri": _unline(headers["warc-target-uri"]) if "warc-target-uri" in headers else None,
            "refers_to": _unline(headers["warc-refers-to"][1:-1]) if kind == "revisit" else None,
            "payload_bytes": size, "payload_digest": said,
            "payload": payload if kind == "response" else None, "error": None}


def _read_one(path: str, content: bytes) -> Iterator[dict]:
    try:
        for data in frames(content):
            try:
                yield {"path": path} | parse(data)
            except ValueError as problem:
                yield {"path": path, "error": str(problem)}
    except (ValueError, zstandard.ZstdError) as problem:  # nothing behind a broken frame can be found
        yield {"path": path, "error": str(problem)}


def _read(payloads: bool):
    schema = pa.schema([(n, pa.int64() if t == "long" else pa.binary() if t == "binary" else pa.string())
                        for n, t in (c.split() for c in RECORDS.split(", "))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size = 0
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                for row in _read_one(path.as_py(), content.as_py() or b""):
                    held.append(row if payloads else row | {"payload": None})
                    size += 200 + len(held[-1].get("payload") or b"")
                    if size >= 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    return read


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """A row per record of ``archives(path, content)``; ``error`` says what is wrong with one.

    Without ``payloads`` the payloads are checked but not returned.
    """
    return common.tuned(archives).select("path", "content").mapInArrow(_read(payloads), RECORDS)


def pages_round_trip(pages: DataFrame, page_id: str = "page_id", uri: str = "url", html: str = "html",
                     least: int = 0) -> DataFrame:
    """Write every page as a record, settle the archives in the shared folder, read them back.

    Null html is an empty payload, a null url no target, a null id stays null. Every row gives a
    record, repeated ones too; other columns are ignored.
    """
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(uri).alias("uri"),
                        F.encode(html, "UTF-8").alias("_payload"))
    marked = with_revisits(rows, "page_id", "_payload", least)
    named = marked.select(
        F.coalesce(F.concat(F.lit("urn:page:"), F.col("page_id").cast("string")), F.lit("urn:page:")).alias("record_id"),
        "uri", "payload",
        F.when(F.col("keeper").isNotNull(), F.concat(F.lit("urn:page:"), F.col("keeper").cast("string"))).alias("refers_to"))
    read = read_archives(settle(write_archives(named)), payloads=False)
    return read.select(F.regexp_extract("record_id", r"(-?\d+)$", 1).try_cast("long").alias("page_id"),
                       "payload_bytes", "payload_digest", "record_type",
                       F.regexp_extract("refers_to", r"(-?\d+)$", 1).try_cast("long").alias("refers_to"),
                       "target_uri", "error")
