"""Derived WARC records: from each response a metadata record (headers, title,
links as JSON) and a conversion record (plain text), both referring to it."""

from __future__ import annotations

import base64
import gzip
import hashlib
import html as entities
import json
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalbook.llm.store import slices

VERSION = "WARC/1.1"
_IDS = uuid.UUID("5f7c1c5e-6f57-4d0e-9f0a-6a3f0f0f5a11")
#: Columns of a parsed record; ``headers`` keeps order and spelling.
RECORD = "record_id string, record_type string, target_uri string, date string, headers array<struct<name:string,value:string>>, block binary"
DERIVED = (
    "refers_to string, record_id string, record_type string, target_uri string, date string, content_type string, "
    "content_length long, source_block_digest string, source_payload_digest string, block_digest string, content string"
)
# Elements whose contents are no text of the page; those of them
# whose contents are no markup either; elements that stand on lines of their
# own; attributes that hold an address, with the elements they are read in
# (none: in all).
_HIDDEN = "noscript script style template".split()
_RAW = "script style".split()
_BLOCKS = frozenset(
    "address article aside blockquote body br dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 head header hr "
    "html li main nav ol p pre section table td th title tr ul".split()
)
_ADDRESSES = {
    "action": None, "background": None, "cite": None, "data": "object", "formaction": None, "href": None,
    "imagesrcset": "link", "longdesc": None, "poster": "video", "src": None, "srcset": None,
}
# Both match without going back, so time grows with the length of the page.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)>")
_ATTRIBUTE = re.compile(r"([^\s=>\"'/]++)\s*+(?:=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?+")
_NO_TAG = re.compile(r"<(?:[!?]|/(?![a-zA-Z]))")
_MARK = re.compile(r"<(?=[a-zA-Z/!?])")
_REFRESH = re.compile(r"[\d.\s]*+[;,]?\s*+url\s*+=\s*+[\"']?([^\"'\s]++)", re.I)
_ENDS = {name: re.compile(rf"</{name}\s*+>", re.I) for name in (*_HIDDEN, "title")}


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    """An id that is the same on every run."""
    return f"<urn:uuid:{uuid.uuid5(_IDS, chr(0).join(parts))}>"


class Page:
    """``text``, ``title`` and ``links`` of a page, from one pass over it.

    The text has no markup, scripts, styles, templates or comments, one line
    per block, blanks run together, empty lines dropped.  Links are all
    addresses in attributes, in order, as written, with the element and the
    attribute; those in comments and scripts are none.  What is not closed, be
    it a comment, a script or a tag, reaches to the end of the page, as in
    browsers; a title that is not closed is none, and a quote that is not closed
    is a character like others.  A page may be as long as a column can hold.
    """

    def __init__(self, page: str) -> None:
        self.title: str | None = None
        self.links: list[dict[str, str]] = []
        parts: list[str] = []
        at = hidden = 0  # what lies before ``hidden`` is not shown
        titled = False
        while True:
            mark = _MARK.search(page, at)
            begin = mark.start() if mark else len(page)
            parts.append(page[max(at, hidden) : max(begin, hidden)])
            if mark is None:
                break
            tag, gap, visible = _TAG.match(page, begin), "", begin >= hidden
            if page.startswith("<!--", begin):
                at, gap = self._after(page, "-->", begin + 4), " "
            elif _NO_TAG.match(page, begin):
                at = self._after(page, ">", begin)
            elif tag is None:
                at = len(page)
            else:
                at, name = tag.end(), tag[2].lower()
                gap = "\n" if name in _BLOCKS else ""
                if not tag[1]:
                    self._addresses(name, tag[3])
                    if name in _RAW or (name in _HIDDEN and visible):
                        end = _ENDS[name].search(page, at)
                        hidden, gap = max(hidden, end.end() if end else len(page)), " "
                        at = hidden if name in _RAW else at
                    elif name == "title" and visible and not titled:
                        titled, end = True, _ENDS[name].search(page, at)
                        self.title = entities.unescape(page[at : end.start()]).strip() if end else None
            if visible:
                parts.append(gap)
        lines = (" ".join(line.split()) for line in entities.unescape("".join(parts)).split("\n"))
        self.text = "\n".join(line for line in lines if line)

    @staticmethod
    def _after(page: str, mark: str, at: int) -> int:
        end = page.find(mark, at)
        return len(page) if end < 0 else end + len(mark)

    def _addresses(self, name: str, attributes: str) -> None:
        refresh = name == "meta" and "refresh" in attributes.lower()
        for attribute, *quoted in _ATTRIBUTE.findall(attributes):
            key, value = attribute.lower(), entities.unescape(next((q for q in quoted if q), "")).strip()
            if key in _ADDRESSES and _ADDRESSES[key] in (None, name):
                many = [c.split()[0] for c in value.split(",") if c.strip()] if key.endswith("srcset") else [value]
                self.links += [{"path": f"{name.upper()}@/{key}", "url": url} for url in many]
            elif refresh and key == "content" and (url := _REFRESH.match(value)):
                self.links.append({"path": "META@/content", "url": url[1]})


def plain_text(page: str) -> str:
    """The text of a page, see :class:`Page`."""
    return Page(page).text


def links(page: str) -> list[dict[str, str]]:
    """The links of a page, see :class:`Page`."""
    return Page(page).links


def split_http(block: bytes) -> tuple[str, list[list[str]], bytes]:
    """Status line, headers in order and payload of an HTTP response; a block
    that does not begin as one is all payload."""
    head, mark, body = block.partition(b"\r\n\r\n")
    if not block.startswith(b"HTTP/") or not mark:
        return "", [], block
    status, *lines = head.decode("iso-8859-1").split("\r\n")
    return status, [[n.strip(), v.strip()] for n, c, v in (x.partition(":") for x in lines) if c], body


def _decoded(http: list[list[str]], body: bytes) -> str:
    kind = next((v for n, v in http if n.lower() == "content-type"), "")
    charset = re.search(r"charset=\"?([\w.:-]+)", kind, re.I)
    try:
        return body.decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


def derived(record: dict) -> list[dict]:
    """The metadata and the conversion record of one response."""
    headers = [[h["name"], h["value"]] for h in record["headers"] or []]
    block = record["block"] or b""
    status, http, body = split_http(block)
    page = _decoded(http, body)
    shown = Page(page)
    given = {n.lower(): v for n, v in headers}
    block_digest = given.get("warc-block-digest") or digest(block)
    payload_digest = given.get("warc-payload-digest") or digest(body)
    source, uri, date = record["record_id"], record["target_uri"], record["date"]
    envelope = {
        "WARC-Header-Metadata": headers,
        "Payload-Metadata": {
            "HTTP-Response-Metadata": {
                "Response-Message": status,
                "Headers": http,
                "Entity-Length": len(body),
                "Entity-Digest": payload_digest,
                "HTML-Metadata": {
                    "Title": shown.title,
                    "Links": shown.links,
                },
            }
        },
    }
    contents = (
        ("metadata", "application/json", json.dumps({"Envelope": envelope}, ensure_ascii=False)),
        ("conversion", "text/plain", shown.text),
    )
    out = []
    for kind, content_type, content in contents:
        data = content.encode("utf-8", "replace")
        out.append(
            {
                "refers_to": source,
                "record_id": record_id(kind, source or "", uri or "", block_digest),
                "record_type": kind,
                "target_uri": uri,
                "date": date,
                "content_type": content_type,
                "content_length": len(data),
                "source_block_digest": block_digest,
                "source_payload_digest": payload_digest,
                "block_digest": digest(data),
                "content": data.decode(),
            }
        )
    return out


def _derived_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {"content_length": pa.int64()}
    names = [c.split()[0] for c in DERIVED.split(", ")]
    for batch in slices(batches, "block"):
        rows = [d for record in batch.to_pylist() for d in derived(record)]
        arrays = [pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in names]
        yield pa.record_batch([batch.column("id").take(pa.array([i // 2 for i in range(len(rows))], pa.int64())), *arrays], names=["id", *names])


def derivatives(records: DataFrame, carry: str) -> DataFrame:
    """Two rows per response among ``records`` (columns as ``RECORD`` and
    ``carry``, a long that is handed on), in the columns of ``DERIVED``; records
    of other types give none.

    Digests the response carries are handed on, missing ones computed.  A null
    block is an empty one: no title, no links, no text.  Repeated responses
    give repeated rows, an empty table none; other columns are not read.
    """
    names = [c.split()[0] for c in RECORD.split(", ")]
    responses = records.filter("record_type = 'response'").select(F.col(carry).cast("long").alias("id"), *names)
    return responses.mapInArrow(_derived_rows, f"id long, {DERIVED}").withColumnRenamed("id", carry)


def responses_of(pages: DataFrame, date: str) -> DataFrame:
    """``pages`` (``page_id``, ``url``, ``html``) as response records, with
    their ``page_id``.  A null page is an empty body."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))
        for batch in slices(batches, "html"):
            out: dict[str, list] = {c.split()[0]: [] for c in RECORD.split(", ")}
            for row in batch.to_pylist():
                body = (row["html"] or "").encode()
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n"
                block = http.encode() + body
                own = record_id("response", str(row["page_id"]), row["url"] or "")
                headers = (
                    ("WARC-Type", "response"), ("WARC-Record-ID", own), ("WARC-Date", date),
                    ("WARC-Target-URI", row["url"]), ("Content-Type", "application/http; msgtype=response"),
                    ("WARC-Block-Digest", digest(block)), ("WARC-Payload-Digest", digest(body)),
                    ("Content-Length", str(len(block))),
                )
                values = (own, "response", row["url"], date, [{"name": n, "value": v} for n, v in headers if v is not None], block)
                for column, value in zip(out.values(), values, strict=True):
                    column.append(value)
            arrays = [batch.column("page_id")] + [
                pa.array(v, kind if c == "headers" else pa.binary() if c == "block" else pa.string())
                for c, v in out.items()
            ]
            yield pa.record_batch(arrays, names=["page_id", *out])

    return pages.select("page_id", "url", "html").mapInArrow(rows, f"page_id long, {RECORD}")


def written(record: dict) -> bytes:
    """A derived record in the file format."""
    lines = [
        VERSION, f"WARC-Type: {record['record_type']}", f"WARC-Record-ID: {record['record_id']}",
        f"WARC-Refers-To: {record['refers_to']}", f"WARC-Target-URI: {record['target_uri']}", f"WARC-Date: {record['date']}",
        f"WARC-Block-Digest: {record['block_digest']}", f"Content-Type: {record['content_type']}",
        f"Content-Length: {record['content_length']}",
    ]
    kept = [x for x in lines if not x.endswith(": None")]
    return "\r\n".join(kept).encode() + b"\r\n\r\n" + record["content"].encode() + b"\r\n\r\n"


def parsed(data: bytes) -> Iterator[dict]:
    """The records of a WARC file, plain or gzipped, in the columns of ``RECORD``."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = data.find(b"WARC/")
    while at >= 0:
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        headers = [
            {"name": n.strip(), "value": v.strip()}
            for n, c, v in (x.partition(":") for x in data[at:end].decode("utf-8", "replace").split("\r\n")[1:])
            if c
        ]
        given = {h["name"].lower(): h["value"] for h in headers}
        begin, length = end + 4, int(given.get("content-length", 0))
        yield {
            "record_id": given.get("warc-record-id"), "record_type": given.get("warc-type"),
            "target_uri": given.get("warc-target-uri"), "date": given.get("warc-date"),
            "headers": headers, "block": data[begin : begin + length],
        }
        at = data.find(b"WARC/", begin + length)
