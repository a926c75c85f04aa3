"""WARC archives of web pages: a writer with one gzip member per record, and a sequential reader.

The reader inflates a member step by step, frames the record by its Content-Length, and verifies block
and payload digests. Pages whose payload equals another's are written as revisit records of the
identical-payload profile: the HTTP header without the payload. Archives are cells of a table, so that
executors without a common disk, and stores that only Spark opens, can hold them.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tarnflow.llm.batches import slices
from tarnflow.llm.hot_keys import joined
from tarnflow.session import stage

#: Payloads of fewer bytes are always stored; others refer to an equal one.
REVISIT_LEAST = 1000
#: A new archive begins when one has so many bytes.
ARCHIVE_BYTES = 4_000_000
STEP = 65_536  # bytes of an archive that are inflated at once
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


class DamagedArchive(ValueError):
    """A record that can't be framed, or whose digest doesn't hold."""


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _line(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record_id(page: object, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}:{digest}')}>"


def member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member of its own."""
    lines = ["WARC/1.1", *(f"{k}: {_line(v)}" for k, v in headers), f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + packer.flush()


def page_record(page: int | None, url: str | None, payload: bytes, refers: int | None, is_revisit: bool) -> bytes:
    """A response or revisit record of a page."""
    payload_digest = _digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if is_revisit else http + payload
    headers = [
        ("WARC-Type", "revisit" if is_revisit else "response"),
        ("WARC-Record-ID", record_id(page, payload_digest)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", url or "about:blank"),
        ("WARC-Payload-Digest", payload_digest),
        ("WARC-Block-Digest", _digest(block)),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if page is not None:
        headers.append(("X-Page-Id", str(page)))
    if is_revisit:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers, payload_digest)), ("X-Refers-To-Page-Id", str(refers))]
    return member(headers, block)


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes

    @property
    def kind(self) -> str:
        return self.headers.get("warc-type", "")

    def http(self) -> tuple[dict[str, str], bytes]:
        """The HTTP headers and the payload of a response or revisit."""
        head, gap, payload = self.block.partition(b"\r\n\r\n")
        if not gap:
            raise DamagedArchive("an HTTP header without an end")
        pairs = (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])
        return {k.strip().lower(): v.strip() for k, _, v in pairs}, payload


def read_records(archive: bytes, step: int = STEP) -> Iterator[Record]:
    """The records of an archive in their order; raises DamagedArchive for one that isn't whole and true."""
    view, at = memoryview(archive), 0
    while at < len(view):
        inflate, parts = zlib.decompressobj(31), []
        while not inflate.eof:
            if at >= len(view):
                raise DamagedArchive("the archive ends inside a member")
            chunk = view[at : at + step]
            try:
                parts.append(inflate.decompress(chunk))
            except zlib.error as e:
                raise DamagedArchive(str(e)) from e
            at += len(chunk) - len(inflate.unused_data)
        yield _framed(b"".join(parts))


def _framed(data: bytes) -> Record:
    head, gap, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not gap or not first.startswith("WARC/1."):
        raise DamagedArchive("no record header")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    size = headers.get("content-length", "")
    if not size.isdigit() or rest[int(size) :] != b"\r\n\r\n":
        raise DamagedArchive("the block isn't as long as Content-Length says")
    record = Record(headers, rest[: int(size)])
    if (told := headers.get("warc-block-digest")) and told != _digest(record.block):
        raise DamagedArchive("the block digest doesn't hold")
    if record.kind == "response" and (told := headers.get("warc-payload-digest")) and told != _digest(record.http()[1]):
        raise DamagedArchive("the payload digest doesn't hold")
    return record


def with_references(pages: DataFrame, id_col: str = "page_id", html: str = "html", least: int = REVISIT_LEAST) -> DataFrame:
    """``pages`` with ``__revisit`` and ``__refers``: of equal payloads the largest id is stored, others refer to it.

    Equality is found on digests and ids, those of payloads that very many pages have by broadcast; pages move once, by
    id, to meet their decision.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    sized = pages.select(F.col(id_col).alias("__id"), F.sha1(payload.cast("binary")).alias("__d"), F.octet_length(payload).alias("__n"))
    narrow = stage(sized.where(F.col("__n") >= least).drop("__n"), "warc-digests")
    best = narrow.groupBy("__d").agg(F.max("__id").alias("__refers"), F.count(F.lit(1)).alias("n")).where("n > 1 and __refers is not null")
    others = joined(narrow, stage(best, "warc-equal"), ["__d"], narrow.count()).where(~F.col("__id").eqNullSafe(F.col("__refers"))).select("__id", "__d", "__refers").distinct()
    rows = pages.withColumn("__digest", F.sha1(payload.cast("binary")))
    told = rows.join(others, rows[id_col].eqNullSafe(others["__id"]) & (rows["__digest"] == others["__d"]), "left")
    return told.drop("__id", "__d", "__digest").withColumn("__revisit", F.col("__refers").isNotNull())


def write_archives(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html", size: int = ARCHIVE_BYTES) -> DataFrame:
    """Archives of all pages: ``archive`` (a name) and ``content``, each of about ``size`` bytes at most.

    A null page body is an empty payload, a null URL ``about:blank``. Payloads of at least 1000 bytes that
    equal another's are revisits of the largest id; rows that repeat that id are responses too. Other columns
    are not read; no pages give no archives.
    """
    source = with_references(pages.select(F.col(id_col).alias("id"), F.col(url).alias("url"), F.col(html).alias("html")), "id", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number, held, used = TaskContext.get().partitionId(), 0, [], 0

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f"part-{task:05d}-{number:05d}.warc.gz"]), pa.array([b"".join(held)], pa.binary())], ["archive", "content"])

        for part in slices(batches, "html", size):
            for row in part.to_pylist():
                if not held:
                    held = [member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id("info", f"{task}-{number}")), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")]
                held.append(page_record(row["id"], row["url"], (row["html"] or "").encode(), row["__refers"], row["__revisit"]))
                used += len(held[-1])
                if used >= size:
                    yield made()
                    number, held, used = number + 1, [], 0
        if held:
            yield made()

    return source.mapInArrow(run, "archive string, content binary")


def read_archives(archives: DataFrame, content: str = "content") -> DataFrame:
    """One row per response or revisit record of the archives: ids, sizes, digests and the payload.

    ``payload`` is null for revisits; ``payload_bytes`` and ``payload_digest`` are those of the full payload
    either way. A record that isn't whole, or whose digests don't hold, fails the job. Null archives are empty.
    """
    schema = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
    names = [x.split()[0] for x in schema.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def row(record: Record) -> tuple:
        http, payload = record.http()
        h = record.headers
        digest = base64.b32decode(h["warc-payload-digest"].removeprefix("sha1:")).hex()
        page, refers = h.get("x-page-id"), h.get("x-refers-to-page-id")
        stored = record.kind == "response"
        if stored and int(http["content-length"]) != len(payload):
            raise DamagedArchive("the payload isn't as long as its header says")
        return page and int(page), h.get("warc-target-uri"), record.kind, int(http["content-length"]), digest, refers and int(refers), payload if stored else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in batch.column(0):
                held, used = [], 0
                for record in read_records(cell.as_py() or b""):
                    if record.kind not in ("response", "revisit"):
                        continue
                    held.append(row(record))
                    used += len(record.block)
                    if used > ARCHIVE_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held, strict=True), types, strict=True)], names)
                        held, used = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held, strict=True), types, strict=True)], names)

    return archives.select(content).mapInArrow(run, schema)


def round_trip(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write the archives into the shared folder and read them back, without the payloads themselves.

    Null pages have an empty payload, very long ones are an archive of their own and read in pieces; rows that
    repeat the largest id of a payload are responses too. Repeated rows are a record each, and an empty table gives an
    empty result.
    """
    archives = stage(write_archives(pages, id_col, url, html), "warc")
    return read_archives(archives).select(F.col("page_id").alias(id_col), "payload_bytes", "payload_digest", "record_type", "refers_to")
