"""WARC records and their derivatives.

``responses`` makes response records from pages; ``read_warc`` parses records of archive files; ``derive`` turns each
response into a metadata record (JSON of headers, title and links) and a plain-text conversion record. Both refer to the
response by its record id, keep its target, date and source headers, and carry digests of their own block as well as the
source's payload digest. ``serialize`` gives a record's bytes as they stand in an archive file.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html as entities
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.llm.common import slices, slim

VERSION = "WARC/1.1"
#: Namespace of the record ids that are made from names, so that a rerun gives the same ids.
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:docmill:warc")
RESPONSE_SCHEMA = (
    "page_id long, record_id string, target_uri string, warc_date string, content_type string, http_headers string, "
    "payload string, payload_digest string, block_digest string, content_length long"
)
DERIVED_SCHEMA = (
    "page_id long, warc_type string, record_id string, refers_to string, target_uri string, warc_date string, "
    "content_type string, source_headers string, source_payload_digest string, block_digest string, "
    "content_length long, title string, n_links long, block string"
)

_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.DOTALL)
_HIDDEN = re.compile(r"<(script|style|template|noscript)\b[^>]*>.*?(?:</\1\s*>|\Z)", re.DOTALL | re.IGNORECASE)
_TITLE = re.compile(r"<title\b[^>]*>(.*?)(?:</title\s*>|\Z)", re.DOTALL | re.IGNORECASE)
_LINK = re.compile(r"""<a\b(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.DOTALL | re.IGNORECASE)
_BLOCK = re.compile(
    r"</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|"
    r"section|table|tbody|td|tfoot|th|thead|title|tr|ul|body)\b[^>]*>",
    re.IGNORECASE,
)
_TAG = re.compile(r"</?[A-Za-z!?][^>]*>")
_BLANKS = re.compile(r"[ \t\r\f\v\xa0]+")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, chr(31).join(name))}>"


def plain_text(page: str) -> str:
    """Visible text: comments and hidden elements dropped, block tags as line ends, entities resolved, blanks squeezed."""
    body = _HIDDEN.sub(" ", _COMMENT.sub(" ", page))
    body = _TAG.sub("", _BLOCK.sub("\n", _TITLE.sub(" ", body)))
    lines = (_BLANKS.sub(" ", line).strip() for line in entities.unescape(body).split("\n"))
    return "\n".join(line for line in lines if line)


def title_of(page: str) -> str | None:
    m = _TITLE.search(_COMMENT.sub(" ", page))
    return " ".join(entities.unescape(_TAG.sub("", m[1])).split()) if m else None


def links_of(page: str, base: str) -> list[str]:
    """Absolute targets of anchors in order; a target that cannot be resolved stays as written."""
    out = []
    for m in _LINK.finditer(_HIDDEN.sub(" ", _COMMENT.sub(" ", page))):
        raw = entities.unescape(next(g for g in m.groups() if g is not None)).strip()
        try:
            out.append(urljoin(base, raw))
        except ValueError:
            out.append(raw)
    return out


def make_response(page_id: int | None, url: str | None, page: str | None, date: str) -> tuple:
    url, payload = url or "", (page or "").encode("utf-8", "replace")
    headers = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = headers.encode() + payload
    return (
        page_id, record_id("response", str(page_id), url, digest(payload)), url, date, "application/http; msgtype=response", headers,
        page or "", digest(payload), digest(block), len(block),
    )


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 512) -> Iterator[pa.RecordBatch]:
    part: list[tuple] = []
    for row in rows:
        part.append(row)
        if len(part) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), schema, strict=True)], schema=schema)
            part = []
    if part:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), schema, strict=True)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in ddl.split(", "))])


def responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """A response record for each page; null url and html count as empty. Ids follow from page id, url and payload, so a rerun
    gives the same ones, and repeated rows of a page, being one capture, give equal records."""
    schema = _arrow(RESPONSE_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches((make_response(i, u, h, date) for b in batches for i, u, h in zip(*(c.to_pylist() for c in b.columns), strict=True)), schema)

    source = slim(pages, [id_col, url_col, html_col]).toDF("page_id", "url", "html").withColumn("page_id", F.col("page_id").cast("long"))
    return source.mapInArrow(run, RESPONSE_SCHEMA)


def derive_records(r: dict) -> list[tuple]:
    """The metadata and the conversion record of one response."""
    page, target = r["payload"] or "", r["target_uri"] or ""
    title, links, text = title_of(page), links_of(page, target), plain_text(page)
    names = [h.partition(":") for h in (r["http_headers"] or "").split("\r\n")[1:] if ":" in h]
    envelope = {
        "WARC-Record-ID": r["record_id"], "WARC-Target-URI": target, "WARC-Date": r["warc_date"], "WARC-Payload-Digest": r["payload_digest"],
        "WARC-Block-Digest": r["block_digest"], "Content-Length": r["content_length"], "HTTP-Headers": {n.strip(): v.strip() for n, _, v in names},
        "Title": title, "Links": links,
    }
    out = []
    for kind, mime, block in (("metadata", "application/json", json.dumps(envelope, ensure_ascii=False, sort_keys=True)), ("conversion", "text/plain", text)):
        data = block.encode("utf-8", "replace")
        out.append((
            r["page_id"], kind, record_id(kind, r["record_id"] or ""), r["record_id"], target, r["warc_date"], mime, r["http_headers"],
            r["payload_digest"], digest(data), len(data), title, len(links), block,
        ))
    return out


def derive(response_records: DataFrame) -> DataFrame:
    """Two rows (``metadata``, ``conversion``) for each response; an empty payload gives an empty conversion block."""
    schema, names = _arrow(DERIVED_SCHEMA), [f.split()[0] for f in RESPONSE_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (dict(zip(names, v, strict=True)) for b in batches for v in zip(*(c.to_pylist() for c in b.columns), strict=True))
        yield from _batches((d for r in rows for d in derive_records(r)), schema)

    return slim(response_records, names).mapInArrow(run, DERIVED_SCHEMA)


def derive_pages(pages: DataFrame, date: str = "2024-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """:func:`derive` of :func:`responses` in one pass, so that payloads go to Python once and never come back."""
    schema, names = _arrow(DERIVED_SCHEMA), [f.split()[0] for f in RESPONSE_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = (make_response(i, u, h, date) for b in slices(batches, 64) for i, u, h in zip(*(c.to_pylist() for c in b.columns), strict=True))
        yield from _batches((d for r in made for d in derive_records(dict(zip(names, r, strict=True)))), schema)

    source = slim(pages, [id_col, url_col, html_col]).toDF("page_id", "url", "html").withColumn("page_id", F.col("page_id").cast("long"))
    return source.mapInArrow(run, DERIVED_SCHEMA)


def serialize(headers: dict[str, object], block: bytes, compress: bool = True) -> bytes:
    """One record as it stands in a file, a gzip member of its own if ``compress``."""
    head = "".join(f"{k}: {v}\r\n" for k, v in headers.items() if v is not None)
    raw = f"{VERSION}\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    return gzip.compress(raw, mtime=0) if compress else raw


def serialized(derived: DataFrame, compress: bool = True) -> DataFrame:
    """Rows ``page_id, warc_type, record`` with each derived record's bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.to_pylist()
            made = [
                serialize(
                    {
                        "WARC-Type": r["warc_type"], "WARC-Record-ID": r["record_id"], "WARC-Refers-To": r["refers_to"], "WARC-Target-URI": r["target_uri"],
                        "WARC-Date": r["warc_date"], "WARC-Block-Digest": r["block_digest"], "Content-Type": r["content_type"],
                    }, (r["block"] or "").encode("utf-8", "replace"), compress,
                ) for r in rows
            ]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(made, pa.binary())], names=["page_id", "warc_type", "record"])

    return derived.mapInArrow(run, "page_id long, warc_type string, record binary")


#: Bytes of an archive that are unpacked at a time.
STEP = 1 << 20
Fault = tuple[int, str]


def _unpacked(data: bytes, faults: list[Fault]) -> Iterator[bytes | None]:
    """Content of a file in parts; gzip members one after the other. None stands where damage was skipped: a member that cannot
    be read ends there, and reading goes on at the next member."""
    if data[:2] != b"\x1f\x8b":
        for at in range(0, len(data), STEP):
            yield data[at : at + STEP]
        return
    at = 0
    while at < len(data):
        member, rest = zlib.decompressobj(31), memoryview(data)[at:]
        try:
            while not member.eof and len(rest):
                part = member.decompress(rest[:STEP], STEP)
                rest = rest[STEP:] if not member.unconsumed_tail else rest[len(rest[:STEP]) - len(member.unconsumed_tail) :]
                if part:
                    yield part
            if not member.eof:
                faults.append((at, "cut gzip member"))
                yield None
                return
            at = len(data) - len(rest) - len(member.unused_data)
        except zlib.error as e:
            faults.append((at, f"damaged gzip member: {e}"))
            yield None
            found = data.find(b"\x1f\x8b\x08", at + 1)
            at = found if found >= 0 else len(data)


def parse_warc(data: bytes, faults: list[Fault] | None = None) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of a file, plain or in gzip members of any size.

    Only the record at hand is held unpacked. Damaged members and cut records are skipped to the next member or record, and
    noted in ``faults`` with the byte of the file (for members) or of the unpacked content (for records) where they begin.
    """
    faults = [] if faults is None else faults
    held, gone = bytearray(), 0

    def take(final: bool) -> Iterator[tuple[dict[str, str], bytes]]:
        nonlocal gone
        while True:
            at = held.find(b"WARC/")
            if at < 0:
                drop = len(held) if final else max(0, len(held) - 4)
                del held[:drop]
                gone += drop
                return
            del held[:at]
            gone += at
            end = held.find(b"\r\n\r\n")
            headers = {}
            if end >= 0:
                for line in held[:end].decode("utf-8", "replace").split("\r\n")[1:]:
                    name, _, value = line.partition(":")
                    headers[name.strip().lower()] = value.strip()
            stated = headers.get("content-length", "0")
            size = int(stated) if stated.isdigit() else 0
            if end < 0 or end + 4 + size > len(held):
                if not final:
                    return
                faults.append((gone, "cut record"))
                del held[:5]
                gone += 5
                continue
            yield headers, bytes(held[end + 4 : end + 4 + size])
            del held[: end + 4 + size]
            gone += end + 4 + size

    for part in _unpacked(data, faults):
        if part is not None:
            held += part
        yield from take(part is None)
    yield from take(True)


def _archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Response records of archive files in the form that :func:`derive` takes; page_id is null.

    A file is one task's work and at most 2 GB, as Spark reads it; its records are unpacked one at a time. What is damaged
    is skipped and listed by :func:`archive_faults`.
    """
    schema = _arrow(RESPONSE_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for b in slices(batches, 1):
                for h, block in parse_warc(b.column(0)[0].as_py()):
                    if h.get("warc-type") == "response":
                        head, _, payload = block.partition(b"\r\n\r\n")
                        yield (
                            None, h.get("warc-record-id"), h.get("warc-target-uri"), h.get("warc-date"), h.get("content-type"),
                            head.decode("utf-8", "replace") + "\r\n\r\n", payload.decode("utf-8", "replace"),
                            h.get("warc-payload-digest") or digest(payload), h.get("warc-block-digest") or digest(block), len(block),
                        )

        yield from _batches(rows(), schema, 32)

    return _archives(spark, path).select("content").mapInArrow(run, RESPONSE_SCHEMA)


def archive_faults(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``path, at, fault`` of what :func:`read_warc` skips."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            faults: list[Fault] = []
            for _ in parse_warc(b.column(1)[0].as_py(), faults):
                pass
            name = b.column(0)[0].as_py()
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(faults), pa.string()), pa.array([f[0] for f in faults], pa.int64()), pa.array([f[1] for f in faults], pa.string())], names=["path", "at", "fault"])

    return _archives(spark, path).select("path", "content").mapInArrow(run, "path string, at long, fault string")
