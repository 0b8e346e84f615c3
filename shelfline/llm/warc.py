"""WARC archives: writing with payload deduplication, and a reader that salvages damaged ones."""

import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESPONSE, REVISIT = "response", "revisit"
#: Payloads shorter than this are stored again each time.
LEAST_SHARED_BYTES = 1000
#: An archive is read by one task. It has at most so many records of less than so many bytes, and one of the largest.
ARCHIVES = ((1 << 16, 2000), (1 << 20, 128), (1 << 24, 8), (None, 1))
_END = b"\r\n\r\n"
_VERSION = re.compile(rb"WARC/[0-9]\.[0-9]{1,2}\r\n")
_GZIP = b"\x1f\x8b\x08"
_START = re.compile(rb"WARC/[0-9]\.[0-9]{1,2}\r\n|\x1f\x8b\x08")
_STEP = 1 << 16


def payload_digest(payload: Column) -> Column:
    return F.sha1(payload)


def _record(kind: str, page_id: Column, url: Column, digest: Column, size: Column, refers_to: Column, payload: Column) -> Column:
    """The record's text, without the two line ends that close it. Line ends in a url become %0D and %0A."""
    target = F.regexp_replace(F.regexp_replace(url, "\r", "%0D"), "\n", "%0A")
    optional = [
        F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))
        for name, value in (("WARC-Target-URI", target), ("WARC-Record-ID", F.concat(F.lit("<urn:page:"), page_id.cast("string"), F.lit(">"))))
    ]
    about = F.concat(F.lit("WARC-Refers-To: <urn:page:"), refers_to.cast("string"), F.lit(">\r\n"))
    return F.concat(
        F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\n"),
        *(F.coalesce(x, F.lit("")) for x in [*optional, about]),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z\r\nContent-Type: text/html; charset=utf-8\r\nWARC-Payload-Digest: sha1:"),
        digest,
        F.lit("\r\nWARC-Payload-Length: "),
        size.cast("string"),
        F.lit("\r\nContent-Length: "),
        F.octet_length(payload).cast("string"),
        F.lit("\r\n\r\n"),
        payload,
    )


def write_warc(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Write a record per row of ``pages`` to archives in ``folder``, a path of any Hadoop file system.

    The payload is the html in UTF-8; null counts as empty. Of records whose payloads are equal and at least
    ``LEAST_SHARED_BYTES`` long, the one with the largest key holds the payload as a response and the others
    revisit it; rows without a key, and all shorter payloads, are responses. Rows that repeat a key with an
    equal payload are all responses if that key is the largest. Other columns are left out.

    Payloads are written where they are read and never shuffled: only digests are, and the rows found to be
    revisits meet the pages again in a join that Spark broadcasts as long as they are few.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"digest": payload_digest(F.col("payload")), "size": F.octet_length("payload")})
    long_ones = rows.filter((F.col("size") >= LEAST_SHARED_BYTES) & F.col("key").isNotNull()).select("key", "digest", "size")
    shared = long_ones.groupBy("digest", "size").agg(F.max("key").alias("refers_to"), F.min("key").alias("least")).filter("least < refers_to")
    keyed = long_ones.join(shared.drop("least"), ["digest", "size"]).filter("key < refers_to").distinct()
    staged = f"{folder}-revisits"
    keyed.write.parquet(staged)
    # A size that no record has needs no further pass over the pages.
    most = rows.agg(F.max(F.col("size") + F.coalesce(F.octet_length("url"), F.lit(0)))).first()[0] or 0
    # Read back, so that Spark knows how large it is.
    revisits = pages.sparkSession.read.schema(keyed.schema).parquet(staged)
    marked = rows.join(revisits, ["key", "digest", "size"], "left")
    nothing = F.lit("")
    parts = [F.col("key"), F.col("url"), F.col("digest"), F.col("size"), F.col("refers_to")]
    record = F.when(F.col("refers_to").isNull(), _record(RESPONSE, *parts, F.col("payload"))).otherwise(_record(REVISIT, *parts, nothing))
    bytes_of = F.col("size") + F.coalesce(F.octet_length("url"), F.lit(0))
    at_least = 0
    for below, records in ARCHIVES:
        own = bytes_of >= at_least if below is None else (bytes_of >= at_least) & (bytes_of < below)
        if at_least == 0 or most >= at_least:
            writer = marked.filter(own).select(record.alias("value")).write.mode("append").option("lineSep", _END.decode())
            writer.option("maxRecordsPerFile", records).text(folder)
        at_least = below


class Record(NamedTuple):
    """A record, or with ``gap`` (the check that failed) a stretch of bytes that holds none."""

    start: int
    end: int
    headers: dict[str, str] | None
    payload: bytes | None
    gap: str | None


def _headers(data: bytes, at: int, close: int) -> dict[str, str] | None:
    """The lines behind the version line, up to ``close``; None, and no further look, once a line is no header."""
    found = {}
    at = data.find(b"\r\n", at) + 2
    while at < close:
        end = data.find(b"\r\n", at, close)
        name, colon, value = data[at : end if end >= 0 else close].partition(b":")
        if not colon:
            return None
        found[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
        at = end + 2 if end >= 0 else close
    return found


def _valid(headers: dict[str, str], payload: bytes) -> str | None:
    """What is wrong with the record, if anything. A revisit's digest is that of the payload it leaves out."""
    digest = headers.get("warc-payload-digest", "")
    if headers.get("warc-type") != REVISIT and digest.startswith("sha1:") and hashlib.sha1(payload).hexdigest() != digest[5:].lower():
        return "digest"
    return None


def _record_at(data: bytes, at: int, close: int) -> Record | str:
    """The record that begins at ``at``, or the check that it fails; ``close`` is where its headers end, or negative.

    It has to begin with a version line and headers, be as long as its Content-Length says, be closed by two
    line ends and have the payload that its digest says.
    """
    headers = _headers(data, at, close) if close >= 0 else None
    size = (headers or {}).get("content-length", "")
    if headers is None or not size.isdecimal() or len(size) > 18:
        return "headers"
    start, end = close + 4, close + 4 + int(size)
    if data[end : end + 4] != _END:
        return "length"
    return _valid(headers, data[start:end]) or Record(at, end + 4, headers, data[start:end], None)


def _member(data: bytes, at: int) -> tuple[bytes, int] | None:
    """The gzip member at ``at``, unpacked and checked, with its end; or None."""
    unpack, out, end = zlib.decompressobj(wbits=31), [], at
    try:
        while not unpack.eof and end < len(data):
            out.append(unpack.decompress(data[end : end + _STEP]))
            end += _STEP
    except zlib.error:
        return None
    return (b"".join(out), min(end, len(data)) - len(unpack.unused_data)) if unpack.eof else None


def salvaged(data: bytes) -> Iterator[Record]:
    """Records and gaps of an archive, plain or of gzip members, which may also be mixed.

    After a failed check the search goes on at the next version line or member; what lies between is a gap.
    Records and gaps inside a member have the member's offsets in the archive.
    """
    at, gap, why = 0, 0, ""
    close = data.find(_END)
    while at < len(data):
        found: list[Record] | None = None
        if _VERSION.match(data, at):
            # The same end of headers may serve many version lines before it; it is looked for once.
            if 0 <= close < at:
                close = data.find(_END, at)
            record = _record_at(data, at, close)
            if isinstance(record, str):
                why = why or record
            else:
                found, end = [record], record.end
        elif data.startswith(_GZIP, at):
            member = _member(data, at)
            if member:
                content, end = member
                found = [r._replace(start=at, end=end) for r in salvaged(content)]
            else:
                why = why or "member"
        if found is None:
            start = _START.search(data, at + 1)
            at = start.start() if start else len(data)
            continue
        if at > gap:
            yield Record(gap, at, None, None, why or "no version line")
        yield from found
        at, gap, why = end, end, ""
    if at > gap:
        yield Record(gap, len(data), None, None, why or "no version line")


_READ = "archive string, start_at long, end_at long, gap string, record_type string, record_id string, refers_to string, target_uri string, payload_digest string, payload_bytes long, payload binary"


def read_warc(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """Records and gaps of ``archives`` (path, content), as Spark's binaryFile source has them.

    A row is a record, or a quarantined stretch of bytes whose ``gap`` says which check failed. The payload is
    null for gaps, and for all with ``payloads`` false. Digest and length are those of the full payload, for a
    revisit as its headers have them. A null or empty archive gives no rows. An archive is held by one task.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                rows = []
                for r in salvaged(content or b""):
                    h = r.headers or {}
                    kind, digest = h.get("warc-type"), h.get("warc-payload-digest", "")
                    size = None if r.gap else len(r.payload)
                    if kind == REVISIT and h.get("warc-payload-length", "").isdecimal():
                        size = int(h["warc-payload-length"])
                    rows.append((path, r.start, r.end, r.gap, kind, h.get("warc-record-id"), h.get("warc-refers-to"), h.get("warc-target-uri"), digest.removeprefix("sha1:").lower() or None, size, r.payload if payloads else None))
                names = [f.split()[0] for f in _READ.split(", ")]
                yield pd.DataFrame({n: pd.Series(list(c), dtype=object) for n, c in zip(names, zip(*rows))} if rows else {n: pd.Series(dtype=object) for n in names})

    return archives.select("path", "content").mapInPandas(run, _READ)


def page_of(record_id: Column) -> Column:
    return F.regexp_extract(record_id, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")


def archived(pages: DataFrame, folder: str, **names: str) -> DataFrame:
    """Write ``pages`` to ``folder`` and read all records back, without payloads. What was just written has no gaps; if
    one is read, the query fails rather than to lose a page."""
    write_warc(pages, folder, **names)
    files = pages.sparkSession.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder)
    gap = F.raise_error(F.concat(F.lit("gap in "), F.col("archive"), F.lit(": "), F.col("gap"))).cast("boolean")
    return read_warc(files, payloads=False).filter(F.when(F.col("gap").isNotNull(), gap).otherwise(True))

