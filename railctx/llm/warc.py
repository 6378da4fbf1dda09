"""WARC derivative builder.

Response records become two linked records each: metadata (JSON: status, source headers, title,
links, digests) and a plain-text conversion. Both refer to their response, repeat its target
and date, and carry digests of their own; record ids are derived from content, so that a rerun
gives the same ids. Records are rows with their bytes, so any writer or table can hold them.

Defined cases: null html is an empty payload; a null target is left out of the headers; pages that repeat
give records that repeat; broken HTTP heads give status null and no headers, and the whole
block counts as payload; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import io
import json
import re
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railctx.llm.arrow import map_rows, written

VERSION = "WARC/1.1"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the namespace of URLs, fixed by RFC 4122

_SKIPPED = re.compile(r"<!--.*?(?:-->|$)|<(script|style|template|noscript)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|$)", re.S | re.I)
# The end tag of a head may be left out; it ends before the first text or tag that cannot stand in it.
_HEAD = re.compile(
    r"<head(?=[\s/>])[^>]*>(?:\s|<!--.*?(?:-->|$)|<(title|script|style|template|noscript)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|$)"
    r"|<(?:base|link|meta)(?=[\s/>])[^>]*>)*+(?:</head\s*>)?",
    re.S | re.I,
)
_INLINE = re.compile(r"</?(?:a|abbr|b|bdi|bdo|cite|code|dfn|em|font|i|kbd|mark|q|s|samp|small|span|strong|sub|sup|tt|u|var|wbr)\b[^>]*>", re.I)
_TAG = re.compile(r"<[a-zA-Z/!?][^>]*>")
_TITLE = re.compile(r"<title(?=[\s/>])[^>]*>(.*?)</title\s*>", re.S | re.I)
_LINK = re.compile(r"""<(a|link|img|iframe|form)\b[^>]*?\b(?:href|src|action)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, chr(0).join(parts))}>"


def record(kind: str, own_id: str, date: str, target: str | None, content_type: str, block: bytes, **more: str) -> bytes:
    """One record as bytes; header names in ``more`` are written with dashes."""
    head = [
        VERSION,
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {own_id}",
        f"WARC-Date: {date}",
        *([f"WARC-Target-URI: {_line(target)}"] if target is not None else []),
        *(f"{name.replace('_', '-')}: {_line(value)}" for name, value in more.items()),
        f"WARC-Block-Digest: {digest(block)}",
        f"Content-Type: {content_type}",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _line(value: str) -> str:
    return re.sub(r"[\r\n]+", " ", value)


def response(url: str | None, payload: bytes, date: str, content_type: str = "text/html; charset=utf-8") -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: {content_type}\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return record(
        "response",
        record_id("response", url or "", date, digest(payload)),
        date,
        url,
        "application/http; msgtype=response",
        head + payload,
        WARC_Payload_Digest=digest(payload),
    )


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record; compressed members are opened one after the other."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(data)) if data[:2] == b"\x1f\x8b" else io.BytesIO(data))
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not at the head of a record")
        headers: dict[str, str] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers.get("content-length", 0))
        block = stream.read(size)
        if len(block) < size:
            raise ValueError("a record is cut off")
        yield headers, block


def http(block: bytes) -> tuple[int | None, list[tuple[str, str]], bytes]:
    """Status, headers in order and payload of an HTTP response."""
    head, found, payload = block.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    status = re.match(r"HTTP/\S+ (\d{3})", lines[0])
    if not (found and status):
        return None, [], block
    return int(status[1]), [(n.strip(), v.strip()) for n, _, v in (x.partition(":") for x in lines[1:])], payload


def plain_text(page: str) -> str:
    """All visible text: a line per block, white space inside it as one space."""
    page = _TAG.sub("\n", _INLINE.sub("", _SKIPPED.sub("\n", _HEAD.sub("\n", page)).replace("\n", " ")))
    lines = (" ".join(html.unescape(line).split()) for line in page.split("\n"))
    return "\n".join(line for line in lines if line)


def links(page: str) -> list[dict[str, str]]:
    """Links of the whole page in order, those of its head included."""
    page = _SKIPPED.sub(" ", page)
    return [{"tag": m[1].lower(), "url": html.unescape(m[2] or m[3] or m[4] or "")} for m in _LINK.finditer(page)]


def derivatives(data: bytes) -> Iterator[tuple[dict[str, str], str, str, bytes]]:
    """For each response in ``data``: its headers, and kind, id and bytes of the two records made of it."""
    for headers, block in parse(data):
        if headers.get("warc-type") != "response":
            continue
        status, source, payload = http(block)
        page = payload.decode("utf-8", "replace")
        own, target, date = headers["warc-record-id"], headers.get("warc-target-uri"), headers.get("warc-date", "")
        title = _TITLE.search(page)
        meta_id, text_id = record_id("metadata", own), record_id("conversion", own)
        envelope = {
            "refers-to": own,
            "conversion": text_id,
            "target-uri": target,
            "warc-headers": headers,
            "http-status": status,
            "http-headers": source,
            "payload-length": len(payload),
            "payload-digest": digest(payload),
            "title": " ".join(html.unescape(title[1]).split()) if title else None,
            "links": links(page),
        }
        shared = {"WARC_Refers_To": own}
        shared |= {"WARC_Refers_To_Target_URI": target} if target is not None else {}
        shared |= {"WARC_Refers_To_Date": date}
        body = json.dumps(envelope, ensure_ascii=False, sort_keys=True).encode()
        yield headers, "metadata", meta_id, record("metadata", meta_id, date, target, "application/json", body, **shared)
        text = plain_text(page).encode()
        # The digest that the source names is kept; the conversion's own text has a digest of its own.
        source_digest = headers.get("warc-payload-digest") or digest(payload)
        yield (
            headers,
            "conversion",
            text_id,
            record(
                "conversion", text_id, date, target, "text/plain; charset=utf-8", text,
                **shared, WARC_Source_Payload_Digest=source_digest, WARC_Payload_Digest=digest(text),
            ),
        )


def responses(pages: DataFrame, date: str, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """One response record per page: page_id, url, record."""
    plain = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(payload), F.lit("")).alias("html"))
    return map_rows(plain, lambda: lambda row: [(row[0], row[1], response(row[1], row[2].encode(), date))], "page_id long, url string, record binary", 256)


_DERIVED = "page_id long, url string, record_type string, record_id string, refers_to string, payload_digest string, content_length long"


def _derived(row: tuple) -> Iterator[tuple]:
    for source, kind, own, data in derivatives(row[2]):
        headers, _ = next(parse(data))
        payload_digest = headers.get("warc-payload-digest") or headers["warc-block-digest"]
        yield row[0], row[1], kind, own, source["warc-record-id"], payload_digest, int(headers["content-length"]), data


def build(records: DataFrame) -> DataFrame:
    """Derived records of rows ``page_id, url, record``; a row may hold a whole file of records."""
    return map_rows(records.select("page_id", "url", "record"), lambda: _derived, _DERIVED + ", record binary", 256)


def catalogue(pages: DataFrame, date: str, **columns: str) -> DataFrame:
    """What ``responses`` and ``build`` make of pages is written; of that table, a digest in place of each record's bytes."""
    records = written(build(responses(pages, date, **columns)))

    def rows(row):
        return [(*row[:-1], len(row[-1]), hashlib.sha256(row[-1]).hexdigest())]

    return map_rows(records, lambda: rows, _DERIVED + ", n_bytes long, record_sha256 string")
