"""WARC derivatives: every response becomes a metadata record and a plain-text conversion record.

Both refer to the response by ``WARC-Refers-To`` and keep its target and date. The metadata block holds the source's
record id, digests, status line and HTTP headers line by line; the conversion block is the text of the page. Records are made
row by row: nothing is shuffled or gathered.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import map_arrow, slices

_END = "\r\n"
_UNSEEN = re.compile(r"(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>")
#: Tags that end a line; others vanish within it. An unfinished tag at the end of a page is dropped.
_BREAKS = re.compile(r"(?i)</?(p|div|br|li|ul|ol|h[1-6]|title|article|section|header|footer|nav|table|tr|td|th|blockquote|pre)([\s/][^>]*)?(>|$)")
_TAGS = re.compile(r"(?s)<[!/?a-zA-Z][^>]*(>|$)")
_BLANKS = re.compile("[\\t\\r\\f\\v  ]+")
_LINES = re.compile(r" ?\n[ \n]*")

_SCHEMA = (
    "record_id string, warc_type string, refers_to string, target_uri string, warc_date string, content_type string, "
    "content_length long, block_digest string, source_payload_digest string, header string, block string"
)


def sha256(data: bytes) -> str:
    return "sha256:" + hashlib.sha256(data).hexdigest()


def record_urn(name: str) -> str:
    """A record id that depends on the name alone, so that repeated tasks give the same one."""
    h = hashlib.md5(name.encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"


def plain_text(page: str) -> str:
    """Visible text of a page: one line per block, entities decoded, runs of blanks as one space."""
    text = _TAGS.sub("", _BREAKS.sub("\n", _UNSEEN.sub("", page)))
    return _LINES.sub("\n", _BLANKS.sub(" ", html.unescape(text))).strip(" \n")


def _header(fields: list[tuple[str, str | None]]) -> str:
    return "WARC/1.1" + _END + "".join(f"{k}: {' '.join(v.splitlines())}{_END}" for k, v in fields if v is not None)


def _records(record_id: str | None, target: str | None, date: str | None, http: str, payload: str, block_digest: str | None, payload_digest: str | None) -> list[tuple]:
    body = payload.encode()
    payload_digest = payload_digest or sha256(body)
    block_digest = block_digest or sha256(http.encode() + body)
    status, *lines = [x for x in http.splitlines() if x] or [""]
    facts = [("source-record-id", record_id or ""), ("source-block-digest", block_digest), ("source-payload-digest", payload_digest), ("source-status", status)]
    facts += [("source-header", x) for x in lines]
    made = []
    for kind, content_type, block in (
        ("metadata", "application/warc-fields", "".join(f"{k}: {v}{_END}" for k, v in facts)),
        ("conversion", "text/plain; charset=utf-8", plain_text(payload)),
    ):
        data = block.encode()
        own, digest = record_urn(f"{kind}|{record_id or ''}|{target or ''}|{payload_digest}"), sha256(data)
        header = _header([
            ("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Refers-To", record_id), ("WARC-Target-URI", target), ("WARC-Date", date),
            ("WARC-Block-Digest", digest), ("Content-Type", content_type), ("Content-Length", str(len(data))),
        ])
        made.append((own, kind, record_id, target, date, content_type, len(data), digest, payload_digest, header, block))
    return made


def derivatives(responses: DataFrame) -> DataFrame:
    """Two records per response, from columns ``record_id, target_uri, warc_date, http_header, payload`` and, where given,
    ``block_digest`` and ``payload_digest`` (computed where absent or null).

    Null headers and payloads are empty; a null id, target or date leaves its header line out. Repeated responses give
    repeated records with equal ids. Other columns are dropped.
    """
    def text(name: str):
        return F.col(name).cast("string") if name in responses.columns else F.lit(None).cast("string")

    source = responses.select(
        *(text(c).alias(c) for c in ("record_id", "target_uri", "warc_date")), F.coalesce(text("http_header"), F.lit("")).alias("http"),
        F.coalesce(text("payload"), F.lit("")).alias("payload"), text("block_digest").alias("block_digest"), text("payload_digest").alias("payload_digest"),
    )
    names = [c.split()[0] for c in _SCHEMA.split(", ")]
    kinds = [pa.int64() if n == "content_length" else pa.string() for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4):
            rows = [r for given in zip(*(c.to_pylist() for c in batch.columns)) for r in _records(*given)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return map_arrow(source, run, _SCHEMA)


def serialized(records: DataFrame) -> DataFrame:
    """One binary column ``record``: header, empty line, block and two line ends, ready to be concatenated to a WARC file."""
    return records.select(F.encode(F.concat("header", F.lit(_END), "block", F.lit(_END * 2)), "UTF-8").alias("record"))


def write_warc(records: DataFrame, path: str) -> None:
    """WARC files, one per partition, in a shared folder: records stand one after another, each ended by two line ends."""
    records.select(F.concat("header", F.lit(_END), "block").alias("value")).write.option("lineSep", _END * 2).text(path)


def page_responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Responses of a crawl whose table kept only id, url and html: header lines and digests are rebuilt from the html."""
    payload = F.coalesce("html", F.lit(""))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"),
    )
    h = F.md5(F.concat(F.lit("response|"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("|"), F.coalesce("url", F.lit(""))))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return pages.select(
        F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">")).alias("record_id"), F.col("url").alias("target_uri"), F.lit(date).alias("warc_date"),
        http.alias("http_header"), payload.alias("payload"), F.concat(F.lit("sha256:"), F.sha2(payload, 256)).alias("payload_digest"),
    )
