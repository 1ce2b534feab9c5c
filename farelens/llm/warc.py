"""WARC derivatives: a metadata and a plain-text conversion record for every response.

``responses`` wraps pages as WARC response records.  ``derive`` turns response records into
two linked records each.  Both keep the response's target, date and id (``WARC-Refers-To``) and
its payload digest; they name each other in ``WARC-Concurrent-To``.  The conversion holds the
page's visible text, one line per block element; the metadata holds the title, the language,
the numbers of links and characters, and the source's HTTP status and headers as they were.
``write`` saves records as WARC files.  Each response is derived in the task that reads it,
without a shuffle; record ids follow from the response's id, so a rerun gives the same ones.

Defined results: a response without a body has an empty text; one without a target has no
``WARC-Target-URI``; a block without an HTTP head is all body; bytes that are not UTF-8 become
replacement characters; without a payload digest the body's is taken; repeated responses give
repeated records; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Elements that start a line, and elements whose content is not text.
BLOCKS = ("address article aside blockquote body br caption dd div dl dt fieldset figcaption "
          "figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol option p pre "
          "section table tbody td tfoot th thead title tr ul").split()
HIDDEN = "script style noscript template".split()

_ATTRIBUTES = r"""(?:"[^"<]*"|'[^'<]*'|[^'">])*+>"""
_MARKUP = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({'|'.join(HIDDEN)})\b[^>]*>.*?(?:</\1\s*>|\Z)"
    rf"|<(/?)(title)\b[^>]*>|<(/?)([a-z][^\s/>]*)(?:{_ATTRIBUTES}|[^>]*>)|<[!?/][^>]*>",
    re.S | re.I)
_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
_LANGUAGE = re.compile(r"""<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z0-9-]+)""", re.I)
_LINK = re.compile(r"<a\s[^>]*\bhref\s*=", re.I)
_BLOCKS = frozenset(BLOCKS)


def visible_text(page: str) -> str:
    """The text of a page without its title, one line per block element."""
    body = _TITLE.sub("\n", page)

    def break_of(found: re.Match) -> str:
        return "\n" if (found[5] or "").lower() in _BLOCKS else ""

    lines = entities.unescape(_MARKUP.sub(break_of, body)).split("\n")
    return "\n".join(x for x in (" ".join(line.split()) for line in lines) if x)


class Head(NamedTuple):
    status: str
    headers: list[tuple[str, str]]
    body: bytes


def split_http(block: bytes) -> Head:
    """Status line, headers and body of an HTTP response."""
    if not block.startswith(b"HTTP/"):
        return Head("", [], block)
    head, _, body = block.partition(b"\r\n\r\n")
    status, *lines = head.decode("utf-8", "replace").split("\r\n")
    return Head(status, [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in lines)],
                body)


def digest(data: bytes) -> str:
    return f"sha256:{hashlib.sha256(data).hexdigest()}"


def header(fields: list[tuple[str, str | None]]) -> str:
    """A WARC header; fields without a value are left out, line ends in values too."""
    lines = [f"{k}: {' '.join(v.split())}" for k, v in fields if v is not None]
    return "\r\n".join(["WARC/1.1", *lines]) + "\r\n\r\n"


def derive_one(record_id: str | None, target: str | None, date: str | None, block: bytes | None,
               payload_digest: str | None) -> list[tuple]:
    """The metadata and the conversion record of a response."""
    source = split_http(block or b"")
    page = source.body.decode("utf-8", "replace")
    payload_digest = payload_digest or digest(source.body)
    ids = {kind: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{record_id}#{kind}')}>"
           for kind in ("metadata", "conversion")}
    text = visible_text(page)
    title = _TITLE.search(page)
    language = _LANGUAGE.search(page)
    fields = [
        ("title", " ".join(entities.unescape(title[1]).split()) if title else ""),
        ("language", language[1].lower() if language else ""),
        ("links", str(len(_LINK.findall(page)))), ("text-characters", str(len(text))),
        ("source-status", source.status),
        *((f"source-header-{k}", v) for k, v in source.headers)]
    blocks = {"metadata": "".join(f"{k}: {v}\r\n" for k, v in fields), "conversion": text}
    types = {"metadata": "application/warc-fields", "conversion": "text/plain; charset=utf-8"}
    out = []
    for kind, other in (("metadata", "conversion"), ("conversion", "metadata")):
        data = blocks[kind].encode("utf-8", "replace")
        shown = header([
            ("WARC-Type", kind), ("WARC-Record-ID", ids[kind]), ("WARC-Date", date),
            ("WARC-Target-URI", target), ("WARC-Refers-To", record_id),
            ("WARC-Concurrent-To", ids[other]), ("WARC-Block-Digest", digest(data)),
            ("WARC-Source-Payload-Digest", payload_digest),
            ("Content-Type", types[kind]), ("Content-Length", str(len(data)))])
        out.append((ids[kind], kind, record_id, ids[other], target, digest(data),
                    payload_digest, len(data), shown, data.decode()))
    return out


RECORDS = ("record_id string, warc_type string, refers_to string, concurrent_to string, "
           "target_uri string, block_digest string, source_digest string, "
           "content_length long, header string, block string")


def responses(pages: DataFrame, date: str = "1970-01-01T00:00:00Z", page_id: str = "page_id",
              url: str = "url", html: str = "html") -> DataFrame:
    """Pages as response records ``record_id, target_uri, date, block, payload_digest``."""
    body = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    name = F.md5(F.concat_ws("\n", F.col(page_id).cast("string"), F.col(url)).cast("binary"))
    parts = [F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                          "Content-Length: "), F.octet_length(body), F.lit("\r\n\r\n"))
    return pages.select(
        F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">")).alias("record_id"),
        F.col(url).alias("target_uri"), F.lit(date).alias("date"),
        F.concat(F.encode(head, "UTF-8"), body).alias("block"),
        F.concat(F.lit("sha256:"), F.sha2(body, 256)).alias("payload_digest"))


def derive(records: DataFrame) -> DataFrame:
    """Two records, in the columns of ``RECORDS``, for every response record."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = RECORDS.split()[::2]
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                columns = [c.slice(at, 256).to_pylist() for c in batch.columns]
                rows = [r for source in zip(*columns) for r in derive_one(*source)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64() if n == "content_length" else pa.string())
                     for n, c in zip(names, zip(*rows))], names=names)

    return records.select("record_id", "target_uri", "date", "block", "payload_digest").mapInArrow(
        run, RECORDS)


def write(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Save ``header, block`` as WARC files, one for each task, each record closed by two line
    ends."""
    records.select(F.concat("header", "block").alias("value")).write.option(
        "lineSep", "\r\n\r\n").option("compression", compression).text(path)
