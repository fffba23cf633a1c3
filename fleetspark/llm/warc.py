"""WARC derivatives: from response records to linked metadata and plain-text conversion records.

Records are WARC/1.1 as bytes, one per row. Both derivatives refer to their response by WARC-Refers-To, with its target and
date. The metadata record keeps the response's HTTP status, headers and digests, and the links and title of the page;
the conversion record holds the page's text. Digests are SHA-1 in base 32. One map over the records, no shuffle.

Defined results: a null page has an empty body, a null or empty address gives no WARC-Target-URI; control characters in
header values are percent-encoded; records of other types, and rows that are no record, derive nothing; repeated rows
derive the same records each (ids follow from the content). Bodies are decoded by transfer and content coding, then by
their charset, with replacement characters for what cannot be decoded.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetspark.llm.common import table

DATE = "2024-01-01T00:00:00Z"
RECORD = "record_type string, record_id string, refers_to string, target_uri string, content_length long, block_digest string, record binary"

# Each begins with a plain "<", which the regex engine finds fast; case is ignored inside.
_TAG = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|((?i:script|style|noscript|template))\b(?>[^>\"']+|\"[^\"]*\"|'[^']*'|[\"'])*+>.*?(?:</(?i:\1)\s*>|\Z)"
    r"|(/?[A-Za-z][^\s/>]*)(?>[^>\"']+|\"[^\"]*\"|'[^']*'|[\"'])*+>|[!?][^>]*>)", re.S)
_BREAKS = frozenset("""address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4
h5 h6 header hr html li main nav ol p pre section table tbody td tfoot th thead title tr ul""".split())
_LINK = re.compile(r"""<[aA]\s(?:[^>]*?\s)?(?i:href)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""")
_TITLE = re.compile(r"<(?i:title)\b[^>]*>(.*?)</(?i:title)\s*>", re.S)
_HEAD = re.compile(r"<(?i:head)\b.*?</(?i:head)\s*>", re.S)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: bytes) -> str:
    """A name that follows from the content."""
    joined = b"".join(len(p).to_bytes(8, "big") + p for p in parts)
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(joined).digest()[:16], version=5)}>"


def header_value(value: str) -> str:
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def build_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {header_value(v)}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _fields(data: bytes) -> list[tuple[str, str]]:
    """Header lines with continuations joined."""
    found: list[tuple[str, str]] = []
    for line in data.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and found:
            found[-1] = (found[-1][0], f"{found[-1][1]} {line.strip()}")
        elif ":" in line:
            name, value = line.split(":", 1)
            found.append((name.strip(), value.strip()))
    return found


def parse_record(data: bytes) -> tuple[list[tuple[str, str]], bytes] | None:
    """Headers and block of a record, or None."""
    head, split, rest = data.partition(b"\r\n\r\n")
    if not split or not head.startswith(b"WARC/1."):
        return None
    headers = _fields(head.partition(b"\r\n")[2])
    length = dict((k.lower(), v) for k, v in headers).get("content-length", "")
    return (headers, rest[:int(length)]) if re.fullmatch("[0-9]{1,18}", length) and int(length) <= len(rest) else None


def _unchunked(data: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = data.find(b"\r\n", at)
        size = data[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]+", size) or not int(size, 16):
            return b"".join(out)
        out.append(data[end + 2:end + 2 + int(size, 16)])
        at = end + 4 + int(size, 16)


def http_response(block: bytes) -> tuple[str, list[tuple[str, str]], bytes, str]:
    """Status line, headers, payload as sent, and decoded text."""
    head, _, payload = block.partition(b"\r\n\r\n")
    status, _, rest = head.partition(b"\r\n")
    headers = _fields(rest)
    by = {k.lower(): v.lower() for k, v in headers}
    body = _unchunked(payload) if "chunked" in by.get("transfer-encoding", "") else payload
    try:
        if "gzip" in by.get("content-encoding", ""):
            body = gzip.decompress(body)
        elif "deflate" in by.get("content-encoding", ""):
            body = zlib.decompress(body)
    except (OSError, EOFError, zlib.error):
        pass  # taken as it is
    charset = re.search(r"charset\s*=\s*[\"']?([^\s;\"']+)", by.get("content-type", ""))
    try:
        text = body.decode(charset[1] if charset else "utf-8", "replace")
    except (LookupError, ValueError):  # no such charset, or one that is not for texts
        text = body.decode("utf-8", "replace")
    return status.decode("utf-8", "replace"), headers, payload, text


def plain_text(page: str) -> str:
    """The text of a page: block elements on lines of their own, blanks collapsed, no empty lines."""
    def of(m: re.Match) -> str:
        return "\n" if m[2] and m[2].lstrip("/").lower() in _BREAKS else ""

    flat = _HEAD.sub("", page).replace("\r", " ").replace("\n", " ")
    lines = (" ".join(x.split()) for x in html.unescape(_TAG.sub(of, flat)).split("\n"))
    return "\n".join(x for x in lines if x)


def response_record(page_id, url: str | None, page: str | None, date: str = DATE) -> bytes:
    """A response record for a landed page."""
    body = (page or "").encode()
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: " + str(len(body)).encode() + b"\r\n\r\n" + body)
    target = [("WARC-Target-URI", url)] if url else []
    return build_record(
        [("WARC-Type", "response"), ("WARC-Record-ID", record_id(str(page_id).encode(), (url or "").encode(), body)), ("WARC-Date", date),
         *target, ("WARC-Payload-Digest", digest(body)), ("WARC-Block-Digest", digest(block)),
         ("Content-Type", "application/http; msgtype=response")], block)


def derivatives(record: bytes) -> list[tuple]:
    """The metadata and the conversion record of a response, as rows of RECORD."""
    parsed = parse_record(record)
    by = {k.lower(): v for k, v in parsed[0]} if parsed else {}
    if by.get("warc-type") != "response" or "warc-record-id" not in by:
        return []
    source, block = by["warc-record-id"], parsed[1]
    status, headers, payload, page = http_response(block)
    target, date = by.get("warc-target-uri", ""), by.get("warc-date", DATE)
    title = _TITLE.search(page)
    said = [("source-status", status), *((f"source-header-{k.lower()}", v) for k, v in headers),
            ("source-payload-digest", by.get("warc-payload-digest") or digest(payload)),
            ("source-block-digest", by.get("warc-block-digest") or digest(block))]
    if title:
        said.append(("title", re.sub(r"\s+", " ", html.unescape(title[1])).strip()))
    for m in _LINK.finditer(page):
        link = html.unescape(m[1] if m[1] is not None else m[2] if m[2] is not None else m[3]).strip()
        try:
            said.append(("outlink", urljoin(target, link)))
        except ValueError:  # no valid address
            said.append(("outlink", link))
    out = []
    for kind, content_type, data in (
            ("metadata", "application/warc-fields", "".join(f"{k}: {header_value(v)}\r\n" for k, v in said).encode()),
            ("conversion", "text/plain; charset=utf-8", plain_text(page).encode())):
        name, mark = record_id(source.encode(), kind.encode()), digest(data)
        refers = [("WARC-Refers-To", source), *([("WARC-Refers-To-Target-URI", target)] if target else []), ("WARC-Refers-To-Date", date)]
        made = build_record(
            [("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Date", date), *([("WARC-Target-URI", target)] if target else []),
             *refers, ("WARC-Block-Digest", mark), ("Content-Type", content_type)], data)
        out.append((kind, name, source, target or None, len(data), mark, made))
    return out


def page_responses(pages: DataFrame, id_col: str = "page_id", url: str = "url", page: str = "html", date: str = DATE) -> DataFrame:
    """id and record: a response record per page."""

    def wrap(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for ids, urls, bodies in batches:
            yield pa.array([response_record(i.as_py(), u.as_py(), p.as_py(), date) for i, u, p in zip(ids, urls, bodies)], pa.binary())

    return pages.select(id_col, F.arrow_udf(wrap, "binary")(F.col(id_col), F.col(url), F.col(page)).alias("record"))


def derive_records(responses: DataFrame, id_col: str = "page_id", record: str = "record") -> DataFrame:
    """Two rows per response record: id, record_type, record_id, refers_to, target_uri, content_length, block_digest, record."""
    kinds = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.binary()]
    names = [x.split()[0] for x in RECORD.split(", ")]

    def derive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, *made) for i, r in enumerate(batch.column(1)) for made in (derivatives(r.as_py()) if r.is_valid else [])]
            ids = batch.column(0).take(pa.array([x[0] for x in rows], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array([x[k + 1] for x in rows], kind) for k, kind in enumerate(kinds))], [id_col, *names])

    kind = responses.schema[id_col].dataType.simpleString()
    return responses.select(id_col, record).mapInArrow(derive, f"`{id_col}` {kind}, {RECORD}")


def op5_warc_derivatives(spark, folder):
    made = derive_records(page_responses(table(spark, folder, "pages")))
    return made.select("page_id", "record_type", "record_id", "refers_to", "target_uri", "content_length", "block_digest",
                       F.sha2("record", 256).alias("record_sha256"))
