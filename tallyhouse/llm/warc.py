"""Derivatives of web responses: linked metadata and plain-text conversion records.

Every response gives a metadata record (status, source headers, title, language, links,
digests) and, if it is text, a conversion record with its plain text. Both name the
response they come from, keep its target and date, and carry the digest of its payload
beside that of their own block. Records can be written as WARC files and read back; both
go through Spark's own reader and writer, so any store that Spark knows will do.

Defined results: a null block is empty and gives a metadata record with status null and no
conversion; a block without an HTTP head is all body, taken as HTML; bytes that do not fit
the stated character set become replacement characters; a null record id, target or date
stays null, and then so does what refers to it; repeated rows give their records each time,
with the same ids; an empty table gives no records; other columns are not read; pages are
read whole, in time that grows with the page also where tags, titles or quotes are never
closed. The character set is the header's or else the one stated in the first 2 048 bytes
(`CHARSET_BYTES`; browsers look at 1 024), else UTF-8.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import json
import re
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import ship_package

VERSION = "WARC/1.1"
RECORDS = (
    "record_id string, refers_to string, warc_type string, target_uri string, date string, "
    "content_type string, content_length long, block_digest string, "
    "source_payload_digest string, block string"
)
COLUMNS = [c.split(" ")[0] for c in RECORDS.split(", ")]
#: Names of the WARC header lines, in the order they are written.
HEADERS = {
    "warc_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "refers_to": "WARC-Refers-To",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "source_payload_digest": "WARC-Source-Payload-Digest",
    "block_digest": "WARC-Block-Digest",
    "content_type": "Content-Type",
    "content_length": "Content-Length",
}

HIDDEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|title|svg)\b.*?(?:</\1\s*>|\Z)", re.S | re.I
)
BREAKS = re.compile(
    r"</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|"
    r"header|hr|li|main|nav|ol|option|p|pre|section|table|tbody|td|tfoot|th|thead|tr|ul)\b[^<>]*>",
    re.I,
)
OPENING, LOOSE = re.compile(r"<[a-zA-Z/!?]"), re.compile(r"<[a-zA-Z/!?][^<>]*>")
MARKS = re.compile("[>\"']")
TITLE, TITLE_END = re.compile(r"<title\b", re.I), re.compile(r"</title\s*>", re.I)
HTML, LANG = re.compile(r"<html\b", re.I), re.compile(r"\blang\s*=\s*[\"']?([\w-]+)", re.I)
ANCHOR, HREF = re.compile(r"<a\b", re.I), re.compile(r"\bhref\s*=\s*", re.I)
VALUE = re.compile(r"\"([^\"]*)\"|'([^']*)'|([^\s>]+)")
#: A page states its character set at its beginning or not at all.
CHARSET_BYTES = 2048
CHARSET = re.compile(rb"charset\s*=\s*[\"']?([\w-]+)", re.I)


def digest(block: bytes) -> str:
    """A digest as WARC headers write it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def tags(page: str) -> Iterator[tuple[int, int]]:
    """Where tags begin and end, from left to right; a > inside quotes ends none.

    The marks are read once from the right, so that it is known from every mark on where
    a tag ends: time grows with the page, however broken it is.
    """
    marks = [m.start() for m in MARKS.finditer(page)]
    ends: list[int | None] = [None] * (len(marks) + 1)
    after: dict[str, int] = {}  # the next mark of each kind
    for k in range(len(marks) - 1, -1, -1):
        kind = page[marks[k]]
        if kind == ">":
            ends[k] = marks[k] + 1
        elif kind in after:
            ends[k] = ends[after[kind] + 1]
        after[kind] = k
    done = 0
    for opening in OPENING.finditer(page):
        if opening.start() >= done:
            end = ends[bisect_left(marks, opening.end())]
            if end is not None:
                yield opening.start(), end
                done = end


def without_tags(page: str) -> str:
    parts, at = [], 0
    for start, end in tags(page):
        parts.append(page[at:start])
        at = end
    return "".join([*parts, page[at:]])


def title_of(page: str) -> str | None:
    """The first title. If its tag or its end is missing, so are those of all later ones."""
    opening = TITLE.search(page)
    start = page.find(">", opening.end()) if opening else -1
    end = TITLE_END.search(page, start + 1) if start >= 0 else None
    return " ".join(html.unescape(page[start + 1 : end.start()]).split()) if end else None


def lang_of(page: str) -> str | None:
    """The language that the first html tag with one states."""
    ends = [m.start() for m in re.finditer(">", page)]
    found = [*LANG.finditer(page)]
    starts = [m.start() for m in found]
    for opening in HTML.finditer(page):
        k = bisect_left(starts, opening.end())
        if k == len(found):
            return None
        if bisect_left(ends, opening.end()) == bisect_left(ends, starts[k]):
            return found[k][1]
    return None


def links_of(page: str) -> list[str]:
    """The targets of all anchors, in order."""
    ends = [m.start() for m in re.finditer(">", page)]
    hrefs = [*HREF.finditer(page)]
    starts = [m.start() for m in hrefs]
    out, done = [], 0
    for anchor in ANCHOR.finditer(page):
        if anchor.start() < done:
            continue
        last = bisect_left(ends, anchor.end())
        stop = ends[last] if last < len(ends) else len(page)
        for k in range(bisect_left(starts, anchor.end()), bisect_left(starts, stop)):
            # Only before a > or the end of the page there is no value, so this ends soon.
            if value := VALUE.match(page, hrefs[k].end()):
                out.append(html.unescape(value[1] or value[2] or value[3] or ""))
                done = value.end()
                break
    return out


def plain_text(page: str) -> str:
    """The visible text of a page: one line per block, white space collapsed, no empty lines."""
    source = HIDDEN.sub(" ", page).replace("\n", " ").replace("\r", " ")
    shown = BREAKS.sub("\n", source)
    shown = html.unescape(LOOSE.sub("", without_tags(shown)))
    lines = (" ".join(line.split()) for line in shown.split("\n"))
    return "\n".join(line for line in lines if line)


def split_http(block: bytes) -> tuple[int | None, list[tuple[str, str]], bytes]:
    """Status, headers and body; a block that does not begin with HTTP/ is all body."""
    if not block.startswith(b"HTTP/"):
        return None, [], block
    head, _, body = block.partition(b"\r\n\r\n")
    first, *lines = head.decode("latin-1").split("\r\n")
    parts = first.split(" ", 2)
    status = int(parts[1]) if len(parts) > 1 and parts[1].isdigit() else None
    pairs = [line.split(":", 1) for line in lines if ":" in line]
    return status, [(name.strip(), value.strip()) for name, value in pairs], body


def _unchunked(body: bytes) -> bytes:
    out, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0:
        try:
            size = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            return body
        if not size:
            break
        out.append(body[end + 2 : end + 2 + size])
        at = end + 4 + size
    return b"".join(out)


def decoded(headers: list[tuple[str, str]], body: bytes) -> bytes:
    """The body without transfer and content encoding; left as it is if it does not decode."""
    named = {name.lower(): value.lower() for name, value in headers}
    if "chunked" in named.get("transfer-encoding", ""):
        body = _unchunked(body)
    try:
        if named.get("content-encoding") == "gzip":
            return gzip.decompress(body)
        if named.get("content-encoding") == "deflate":
            return zlib.decompress(body)
    except (OSError, EOFError, zlib.error):
        pass
    return body


def _characters(content_type: str, body: bytes) -> str:
    found = CHARSET.search(content_type.encode("latin-1", "replace")) or CHARSET.search(
        body[:CHARSET_BYTES]
    )
    try:
        return body.decode(found[1].decode() if found else "utf-8", "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


def _record(
    kind: str, source: str | None, target: str | None, date: str | None, content_type: str, payload: str, block: str
) -> tuple:
    own = uuid.uuid5(uuid.NAMESPACE_URL, f"{source}#{kind}") if source is not None else None
    raw = block.encode()
    identity = f"<urn:uuid:{own}>" if own else None
    return (identity, source, kind, target, date, content_type, len(raw), digest(raw), payload, block)


def derivatives(
    record_id: str | None, target: str | None, date: str | None, block: bytes | None
) -> list[tuple]:
    """The metadata record of one response and, if it is text, its conversion record."""
    status, headers, raw = split_http(block or b"")
    payload = digest(raw)
    body = decoded(headers, raw)
    content_type = next((v for n, v in headers if n.lower() == "content-type"), "text/html")
    facts: dict = {
        "status": status,
        "headers": [list(h) for h in headers],
        "payload_length": len(raw),
        "payload_digest": payload,
    }
    out = []
    if body and content_type.lower().split(";")[0].strip().startswith(("text/", "application/xhtml")):
        page = _characters(content_type, body)
        if content_type.lower().startswith("text/plain"):
            text = "\n".join(s for line in page.splitlines() if (s := " ".join(line.split())))
        else:
            facts["title"] = title_of(page)
            facts["lang"] = lang_of(page)
            facts["links"] = links_of(page)
            text = plain_text(page)
        facts["text_digest"] = digest(text.encode())
        out.append(_record("conversion", record_id, target, date, "text/plain", payload, text))
    facts_block = json.dumps(facts, ensure_ascii=False, separators=(",", ":"))
    return [
        _record("metadata", record_id, target, date, "application/json", payload, facts_block),
        *out,
    ]


def _derive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(c, pa.int64() if c == "content_length" else pa.string()) for c in COLUMNS])
    for batch in batches:
        columns = [batch.column(c) for c in ("record_id", "target_uri", "date", "block")]
        rows: list[tuple] = []
        for row in zip(*columns, strict=True):
            rows += derivatives(*(value.as_py() for value in row))
            if len(rows) >= 512:
                yield pa.RecordBatch.from_pylist([dict(zip(COLUMNS, r, strict=True)) for r in rows], schema)
                rows = []
        yield pa.RecordBatch.from_pylist([dict(zip(COLUMNS, r, strict=True)) for r in rows], schema)


def derive(responses: DataFrame) -> DataFrame:
    """Records derived from responses (record_id, target_uri, date, block as HTTP bytes)."""
    ship_package(responses.sparkSession)
    named = responses.select(
        F.col("record_id").cast("string").alias("record_id"),
        F.col("target_uri").cast("string").alias("target_uri"),
        F.col("date").cast("string").alias("date"),
        F.col("block").cast("binary").alias("block"),
    )
    return named.mapInArrow(_derive, RECORDS)


def responses_of(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Response records for stored pages (page_id, url, html), as a crawler would keep them."""
    body = F.coalesce(F.col("html"), F.lit(""))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    key = F.md5(F.concat_ws("#", F.col("page_id").cast("string"), F.col("url")).cast("binary"))
    grouped = F.regexp_replace(key, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")
    return pages.select(
        "page_id",
        grouped.alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("date"),
        F.concat(head, body).alias("block"),
    )


def write_warc(records: DataFrame, path: str) -> None:
    """Write records as gzip-compressed WARC files. Line feeds in header values become spaces."""
    lines = [
        F.concat(
            F.lit(f"{label}: "), F.regexp_replace(F.col(name).cast("string"), "[\\r\\n]+", " ")
        )
        for name, label in HEADERS.items()
    ]
    # A header whose value is null is left out.
    head = F.concat_ws("\r\n", F.lit(VERSION), *lines)
    whole = F.concat(head, F.lit("\r\n\r\n"), F.coalesce("block", F.lit("")))
    writer = records.select(whole.alias("value")).write.option("lineSep", "\r\n\r\n")
    writer.option("compression", "gzip").text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Read back what write_warc wrote: the same columns and values."""
    raw = spark.read.option("lineSep", f"\r\n\r\n{VERSION}\r\n").text(path)
    record = F.regexp_replace("value", f"^{VERSION}\r\n", "")
    cut = F.instr(F.col("record"), "\r\n\r\n")
    names = F.transform(
        F.split(F.expr("substring(record, 1, cut - 1)"), "\r\n"),
        lambda line: F.struct(
            F.substring_index(line, ": ", 1).alias("key"),
            line.substr(F.length(F.substring_index(line, ": ", 1)) + 3, F.length(line)).alias("value"),
        ),
    )
    parsed = (
        raw.select(record.alias("record"))
        .withColumn("cut", cut)
        .withColumn("headers", F.map_from_entries(names))
        .withColumn("body", F.expr("substring(record, cut + 4)"))
    )
    length = F.col("headers")[HEADERS["content_length"]].cast("long")
    # The last record of a file keeps the separator behind its block.
    body = F.decode(F.substring(F.encode("body", "UTF-8"), 1, length.cast("int")), "UTF-8")
    fields = [
        F.col("headers")[HEADERS[c]].alias(c) if c != "content_length" else length.alias(c)
        for c in COLUMNS[:-1]
    ]
    return parsed.select(*fields, body.alias("block"))
