"""Derivatives of archived responses: linked metadata and plain-text conversion records."""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchwright.llm.blocks import page_blocks, title_and_links
from matchwright.llm.texts import slices

SPACE_ID = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the standard name space for URLs
END = "\r\n"
RECORDS = (
    "page_id long, record_type string, record_id string, refers_to string, target_uri string, date string, content_type string, "
    "content_length long, block_digest string, source_payload_digest string, digests_agree boolean, headers string, block string"
)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE_ID, ' '.join(parts))}>"


def _head(fields: list[tuple[str, str | None]]) -> str:
    """A record's header block; line breaks inside a value would end it and become blanks."""
    lines = [f"{k}: {' '.join(v.splitlines())}" for k, v in fields if v is not None]
    return END.join(["WARC/1.1", *lines, "", ""])


def response_record(page_id: int | None, url: str | None, html: str | None, date: str) -> str:
    """A page as a response record, as a crawler would have stored it."""
    payload = (html or "").encode("utf-8", "surrogatepass")
    http = f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: {len(payload)}{END}{END}"
    block = http.encode() + payload
    fields = [
        ("WARC-Type", "response"),
        ("WARC-Record-ID", _id("response", str(page_id), url or "", digest(payload))),
        ("WARC-Date", date),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", digest(payload)),
        ("WARC-Block-Digest", digest(block)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    return _head(fields) + http + (html or "")


def responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """page_id and `record`, the response record of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                rows = [response_record(*row, date) for row in zip(*(c.to_pylist() for c in part.columns))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, pa.string())], ["page_id", "record"])

    cut = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string").alias("html"))
    return cut.mapInArrow(run, "page_id long, record string")


def fields_of(lines: list[str]) -> list[tuple[str, str]]:
    """Header fields in order; a line that starts with a blank continues the one before."""
    out: list[tuple[str, str]] = []
    for line in lines:
        if line[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}")
        elif ":" in line:
            name, value = line.split(":", 1)
            out.append((name.strip(), value.strip()))
    return out


def derive(page_id: int | None, record: str | None) -> list[tuple]:
    """The metadata and the conversion record of one response record."""
    head, gap, block = (record or "").partition(END + END)
    start, *lines = head.split(END)
    source = fields_of(lines)
    named = {k.lower(): v for k, v in source}
    http_head, http_gap, payload = block.partition(END + END)
    status, *http_lines = http_head.split(END)
    error = None
    if not gap or not start.startswith("WARC/") or named.get("warc-type", "").lower() != "response":
        error = "not a response record"
    elif not http_gap or not status.startswith("HTTP/"):
        error = "no HTTP header"
    if error:
        http_lines, payload, status = [], "", ""
    size = digest(block.encode("utf-8", "surrogatepass")), digest(payload.encode("utf-8", "surrogatepass"))
    agree = error is None and all(
        named.get(k, own) == own for k, own in (("warc-block-digest", size[0]), ("warc-payload-digest", size[1]))
    )
    uri, date, own_id = named.get("warc-target-uri"), named.get("warc-date"), named.get("warc-record-id")
    title, links = title_and_links(payload)
    about = [(f"source-{k}", v) for k, v in source] + [("http-status", status)] + [(f"http-{k}", v) for k, v in fields_of(http_lines)]
    about += [("computed-payload-digest", size[1]), ("digests-agree", str(agree).lower()), ("title", title)]
    about += [("outlink", x) for x in links] + ([("error", error)] if error else [])
    meta = "".join(f"{k}: {' '.join(v.splitlines())}{END}" for k, v in about)
    text = "\n".join(b.text for b in page_blocks(payload))
    out = []
    for kind, content_type, body in (("metadata", "application/warc-fields", meta), ("conversion", "text/plain; charset=utf-8", text)):
        data = body.encode("utf-8", "surrogatepass")
        new_id = _id(kind, own_id or str(page_id), size[1])
        fields = [
            ("WARC-Type", kind),
            ("WARC-Record-ID", new_id),
            ("WARC-Date", date),
            ("WARC-Target-URI", uri),
            ("WARC-Refers-To", own_id),
            ("WARC-Refers-To-Target-URI", uri),
            ("WARC-Refers-To-Date", date),
            ("WARC-Block-Digest", digest(data)),
            ("Content-Type", content_type),
            ("Content-Length", str(len(data))),
        ]
        out.append((page_id, kind, new_id, own_id, uri, date, content_type, len(data), digest(data), size[1], agree, _head(fields), body))
    return out


def derivatives(records: DataFrame) -> DataFrame:
    """Two records per response: metadata (source and HTTP headers, digests, title, outlinks) and conversion (plain text).

    Both name the source record in refers_to and keep its target and date. A record that is
    null, cut off or no response still gives both, with `error` in the metadata and an empty
    text; a digest that does not match shows in digests_agree. Repeated records give repeated
    rows; other columns are not read. One record is one row's work: nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "record"):
                rows = [r for p, x in zip(part.column(0).to_pylist(), part.column(1).to_pylist()) for r in derive(p, x)]
                kinds = (pa.int64(), *[pa.string()] * 6, pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.string(), pa.string())
                names = [f.split()[0] for f in RECORDS.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    cut = records.select(F.col("page_id").cast("long").alias("page_id"), F.col("record").cast("string").alias("record"))
    return cut.mapInArrow(run, RECORDS)


def write(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Records as WARC files, one per partition: a record is its header, its block and two line ends."""
    records.select(F.concat("headers", "block").alias("value")).write.option("lineSep", END + END).option("compression", compression).text(path)
