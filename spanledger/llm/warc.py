"""Derived WARC records: linked metadata and plain-text conversion records of responses.

Each response gives two records. The metadata record lists what the page says
about itself and the response's own headers; the conversion record holds its
plain text. Both refer to the response by its identifier, repeat its target,
date and payload digest, and are linked by ``WARC-Concurrent-To``. Identifiers
are derived from the response's, so a task that runs again writes the same.

Defined results: a NULL payload is an empty one; a NULL identifier is derived
from target and payload; repeated responses give repeated records; other
columns are not carried. A header block may end its lines in any way; what
would break a line of a record becomes one space.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanledger.llm.batches import map_batches

DATE = "2024-01-01T00:00:00Z"
SCHEMA = (
    "key bigint, url string, record_type string, record_id string, refers_to string, concurrent_to string, warc_date string, "
    "content_type string, content_length bigint, block_digest string, source_digest string, source_headers string, "
    "text_chars bigint, n_links bigint, record_sha256 string, record string"
)

_INVISIBLE = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|head)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)", re.S | re.I)
_BREAK = re.compile(r"</?(?:p|div|h[1-6]|li|ul|ol|tr|table|br|hr|article|section|header|footer|nav|aside|blockquote|pre|form|dl|dt|dd)\b[^>]*>", re.I)
_TAG = re.compile(r"<[!?/]?[a-zA-Z][^>]*>|<[!?][^>]*>")
_TITLE = re.compile(r"<title[^>]*>(.*?)(?:</title|\Z)", re.S | re.I)
_LANG = re.compile(r"<html[^>]*\blang\s*=\s*[\"']?([\w-]+)", re.I)
_CHARSET = re.compile(r"<meta[^>]*\bcharset\s*=\s*[\"']?([\w-]+)", re.I)
_LINK = re.compile(r"<a\s[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def labelled_digest(data: bytes) -> str:
    """SHA-1 in base 32, as WARC files carry it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def plain_text(html: str) -> str:
    """All visible text, one line for each block."""
    text = _TAG.sub("", _BREAK.sub("\n", _INVISIBLE.sub(" ", html)))
    lines = (" ".join(x.split()) for x in unescape(text).split("\n"))
    return "\n".join(x for x in lines if x)


def _one_line(text: str) -> str:
    return " ".join(text.split())


def _record(headers: list[tuple[str, str]], block: str) -> str:
    head = "".join(f"{k}: {_one_line(v)}\r\n" for k, v in headers if v)
    return f"WARC/1.1\r\n{head}\r\n{block}"


def _header_lines(http: str) -> list[str]:
    """The lines of a header block, whatever its line ends; a line that begins with white space goes on with the one before."""
    lines: list[str] = []
    for line in re.split(r"\r\n|\n|\r", http):
        if lines and line[:1] in (" ", "\t"):
            lines[-1] += line
        elif line.strip():
            lines.append(line)
    return lines


def derive(key: int | None, record_id: str | None, url: str | None, date: str | None, http: str | None, payload: str | None) -> list[dict]:
    """The two records of one response."""
    html, url, date, http = payload or "", _one_line(url or ""), date or DATE, http or ""
    body = html.encode("utf-8", "replace")
    digest = labelled_digest(body)
    source = record_id or f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {digest}')}>"
    ids = {kind: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{source} {kind}')}>" for kind in ("metadata", "conversion")}
    text = plain_text(html)
    links = [unescape(a or b or c) for a, b, c in _LINK.findall(html)]
    first = {name: (m[1] if (m := pattern.search(html)) else "") for name, pattern in (("title", _TITLE), ("language", _LANG), ("charset", _CHARSET))}
    source_lines = _header_lines(http)
    fields = [(f"source-{_one_line(k)}", v) for k, v in (x.split(":", 1) for x in source_lines if ":" in x)]
    fields += [(k, unescape(v)) for k, v in first.items()] + [("outlink", x) for x in links]
    blocks = {
        "metadata": ("application/warc-fields", "".join(f"{k}: {_one_line(v)}\r\n" for k, v in fields if v.strip())),
        "conversion": ("text/plain; charset=utf-8", text),
    }
    out = []
    for kind, other in (("metadata", "conversion"), ("conversion", "metadata")):
        content_type, block = blocks[kind]
        data = block.encode("utf-8", "replace")
        headers = [
            ("WARC-Type", kind), ("WARC-Record-ID", ids[kind]), ("WARC-Target-URI", url), ("WARC-Date", date), ("WARC-Refers-To", source),
            ("WARC-Refers-To-Target-URI", url), ("WARC-Refers-To-Date", date), ("WARC-Concurrent-To", ids[other]),
            ("WARC-Source-Payload-Digest", digest), ("WARC-Block-Digest", labelled_digest(data)), ("Content-Type", content_type),
            ("Content-Length", str(len(data))),
        ]
        record = _record(headers, block)
        out.append(
            {
                "key": key, "url": url, "record_type": kind, "record_id": ids[kind], "refers_to": source, "concurrent_to": ids[other],
                "warc_date": date, "content_type": content_type, "content_length": len(data), "block_digest": labelled_digest(data),
                "source_digest": digest, "source_headers": _one_line("; ".join(source_lines)), "text_chars": len(text),
                "n_links": len(links), "record_sha256": hashlib.sha256(record.encode("utf-8", "replace")).hexdigest(), "record": record,
            }
        )
    return out


def derivatives(responses: DataFrame) -> DataFrame:
    """Two rows per response (``key, record_id, url, date, http_headers, payload``), each with its whole record."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    kinds = pa.schema([(n, pa.int64() if t == "bigint" else pa.string()) for n, t in (x.split() for x in SCHEMA.split(", "))])

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                found = [r for row in zip(*(c.to_pylist() for c in part.columns), strict=True) for r in derive(*row)]
                yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in found], kinds.field(n).type) for n in names], schema=kinds)

    return map_batches(responses.select("key", "record_id", "url", "date", "http_headers", "payload"), batches, SCHEMA)


def responses_of(pages: DataFrame) -> DataFrame:
    """Pages as responses: the headers a server would send, no identifier, the default date."""
    size = F.octet_length(F.coalesce("html", F.lit(""))).cast("string")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size)
    text = F.lit(None).cast("string")
    return pages.select(F.col("page_id").alias("key"), text.alias("record_id"), "url", text.alias("date"), http.alias("http_headers"), F.col("html").alias("payload"))


def write(records: DataFrame, path: str) -> None:
    """WARC files, one per task: a record's text, then the two line ends that close it."""
    records.select("record").write.option("lineSep", "\r\n\r\n").text(path)
