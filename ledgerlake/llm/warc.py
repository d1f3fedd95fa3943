"""WARC archives of web pages, and reads of selected records by byte range.

Writing: pages with equal payloads are found by digest first. Each task then appends its pages to
archives of its own, one gzip member per record, and returns the index: archive, offset, length, URL
and digest of each record. Archives are named at random and only the stored index refers to them, so
what a lost or repeated task left behind is never read.

Reading: the selected index rows are dealt out by archive and region and sorted by offset; records
that lie close together are fetched by one read.

A null html is an empty payload. Of equal payloads the record with the largest page_id is the
response and the others revisit it; rows that repeat that page_id are responses all, and a null
page_id comes first. A null or odd URL is left out or escaped. No pages: no records. Only the named
columns are read, so others cannot clash.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.sizes import small_side
from ledgerlake.sources.workspace import fresh_path, written

ARCHIVE_BYTES = 256 << 20
REGION_BYTES = 32 << 20
READ_BYTES = 8 << 20
GAP_BYTES = 64 << 10

_INDEX = ("page_id long, url string, digest string, record_type string, archive string,"
          " offset long, length long")
_READ = ("page_id long, url string, record_type string, refers_to long, payload_digest string,"
         " payload_bytes long")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str,
           refers_to: int | None, date: str) -> bytes:
    """One WARC record. A revisit has the HTTP head of the page without its body."""
    kind = "response" if refers_to is None else "revisit"
    body = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    if refers_to is None:
        body += payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response",
             f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """What a record holds. Raises if its lengths or a response's payload digest don't fit."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:80]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    body = rest[:int(fields["Content-Length"])]
    if rest[len(body):] != b"\r\n\r\n":
        raise ValueError("a record's length does not fit")
    http, _, payload = body.partition(b"\r\n\r\n")
    said = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and digest_of(payload) != digest:
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} is damaged")
    return {"page_id": _number(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"),
            "record_type": fields["WARC-Type"], "refers_to": _number(fields.get("WARC-Refers-To")),
            "payload_digest": digest, "payload_bytes": int(said["Content-Length"]), "payload": payload}


def _number(name: str | None) -> int | None:
    digits = (name or "").removeprefix("<urn:page:").rstrip(">")
    return int(digits) if digits else None


class _Archives:
    """Appends records to archives in a folder; a full one is closed and the next begun."""

    def __init__(self, folder: str):
        self._fs, self._folder = pyarrow.fs.FileSystem.from_uri(folder)
        self._fs.create_dir(self._folder, recursive=True)
        self._uri, self._out = folder, None

    def add(self, raw: bytes) -> tuple[str, int, int]:
        if self._out is None or self._at >= ARCHIVE_BYTES:
            self.close()
            name = f"{uuid.uuid4().hex}.warc.gz"
            self.name, self._at = f"{self._uri}/{name}", 0
            self._out = self._fs.open_output_stream(f"{self._folder}/{name}", compression=None)
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        member = packer.compress(raw) + packer.flush()
        self._out.write(member)
        at, self._at = self._at, self._at + len(member)
        return self.name, at, len(member)

    def close(self) -> None:
        if self._out is not None:
            self._out.close()
            self._out = None


def _writer(folder: str, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives = _Archives(folder)
        try:
            for batch in batches:
                rows = []
                for page, url, html, refers in zip(*(batch.column(i) for i in range(4))):
                    payload = (html.as_py() or "").encode()
                    digest, to = digest_of(payload), refers.as_py()
                    place = archives.add(record(page.as_py(), url.as_py(), payload, digest, to, date))
                    rows.append((page.as_py(), url.as_py(), digest,
                                 "response" if to is None else "revisit", *place))
                names = [c.split()[0] for c in _INDEX.split(", ")]
                kinds = [pa.int64() if c.endswith(" long") else pa.string() for c in _INDEX.split(", ")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)
        finally:
            archives.close()
    return run


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url",
                   html: str = "html", least_bytes: int = 0,
                   date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write the pages and return the stored index. Payloads under `least_bytes` are never revisits."""
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
                        F.coalesce(F.col(html), F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1("html"))
    large = rows.filter(F.octet_length("html") >= least_bytes)
    twice = (large.groupBy("sha").agg(F.max("page_id").alias("newest"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1 AND newest IS NOT NULL").select("sha", "newest"))
    own = F.col("newest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest"))
    own = own & (F.octet_length("html") >= least_bytes)
    dealt = (rows.join(small_side(twice), "sha", "left")
             .select("page_id", "url", "html", F.when(own, F.col("newest")).alias("refers_to")))
    return written(dealt.mapInArrow(_writer(folder, date), _INDEX), "warc-index")


def _reader(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[dict] = []
            held = 0
            for archive, start, parts in _coalesced(zip(*(batch.column(i).to_pylist() for i in range(3)))):
                fs, path = pyarrow.fs.FileSystem.from_uri(archive)
                with fs.open_input_file(path) as f:
                    data = f.read_at(parts[-1][0] + parts[-1][1] - start, start)
                for offset, length in parts:
                    found.append(parse(zlib.decompress(data[offset - start:offset - start + length], 31)))
                    held += len(found[-1]["payload"]) if with_payload else 0
                if held >= READ_BYTES:
                    yield _records(found, with_payload)
                    found, held = [], 0
            if found:
                yield _records(found, with_payload)
    return run


def _coalesced(rows):
    """Sorted (archive, offset, length) as reads: archive, start, and the parts of the read."""
    archive, parts = None, []
    for name, offset, length in rows:
        end = parts[-1][0] + parts[-1][1] if parts else 0
        if parts and (name != archive or not end <= offset <= end + GAP_BYTES
                      or offset + length - parts[0][0] > READ_BYTES):
            yield archive, parts[0][0], parts
            parts = []
        archive = name
        parts.append((offset, length))
    if parts:
        yield archive, parts[0][0], parts


def _records(found: list[dict], with_payload: bool) -> pa.RecordBatch:
    names = [c.split()[0] for c in _READ.split(", ")]
    kinds = [pa.int64() if c.endswith(" long") else pa.string() for c in _READ.split(", ")]
    columns = {n: pa.array([x[n] for x in found], k) for n, k in zip(names, kinds)}
    if with_payload:
        columns["payload"] = pa.array([x["payload"] for x in found], pa.binary())
    return pa.RecordBatch.from_pydict(columns)


def read_records(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records that the index rows name. A revisit has the digest and length, but no payload.

    There are as many tasks as the records' bytes need, however small the index is.
    """
    region = F.floor(F.col("offset") / REGION_BYTES)
    size = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-size // REGION_BYTES), index.sparkSession.sparkContext.defaultParallelism)
    dealt = (index.repartition(int(tasks), "archive", region).sortWithinPartitions("archive", "offset")
             .select("archive", "offset", "length"))
    return dealt.mapInArrow(_reader(with_payload), _READ + (", payload binary" if with_payload else ""))


def archived(pages: DataFrame, **columns) -> DataFrame:
    """Write all pages to archives in the shared folder and read every record back."""
    folder = fresh_path(pages.sparkSession, "warc")
    index = write_archives(pages, folder, **columns)
    return read_records(index, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
