"""WARC archives written by shard, and read back.

Pages are put in ranges of their ids whose bounds follow from the pages alone, sorted,
and written record by record, each a gzip member of its own; a file that reaches its
compressed size is closed and the next begins.  Headers and digests are made anew from
the payloads and hold nothing of the run (no clock, no host), so the same pages give the
same bytes.  Files are written under temporary names and named after a manifest (see
``files``).

Of pages with equal payloads of at least ``min_revisit_bytes`` bytes, the one with the
largest id is a response, the others are revisits of it without payload.

Defined results: a null html is an empty payload; a null url is left out of the header;
control characters in a url are percent-encoded; null ids come last and lose to any
other id; of repeated rows (equal id and payload) the first by url is the response if
its id is the largest; an empty table gives an empty archive; other columns play no part.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import files

SHARD_BYTES = 32 << 20  # of payload
ROLL_BYTES = 8 << 20  # compressed
MIN_REVISIT_BYTES = 0
DATE = "1970-01-01T00:00:00Z"
READ_BYTES = 64 << 10

# fixed values of the format
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http; msgtype=response"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _urn(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, repr(parts))}>"


def _http(payload_bytes: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()


def record(kind: str, fields: dict[str, object], block: bytes) -> bytes:
    """One record, compressed; fields that are None are left out."""
    head = {"WARC-Type": kind, **fields, "WARC-Block-Digest": f"sha1:{base32(hashlib.sha1(block).digest())}", "Content-Length": len(block)}
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in head.items() if v is not None)
    return gzip.compress(VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def page_record(page_id: int | None, url: str | None, digest: bytes, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    target = None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    fields = {
        "WARC-Record-ID": _urn(page_id, target, digest.hex()), "WARC-Date": date, "WARC-Target-URI": target, "Page-Id": page_id,
        "Content-Type": HTTP_TYPE, "WARC-Payload-Digest": f"sha1:{base32(digest)}"}
    http = _http(len(payload))
    if not revisit:
        return record("response", fields, http + payload)
    return record("revisit", fields | {"WARC-Profile": REVISIT_PROFILE, "Refers-To-Page-Id": refers_to}, http)


def _shard(page_id: Column, cuts: list[int]) -> Column:
    @F.pandas_udf("int")
    def at(ids: pd.Series) -> pd.Series:
        return pd.Series(files.shard_of(pa.array(ids.astype("Int64"), pa.int64()), cuts).to_numpy())

    return at(page_id)


class _Roll:
    """The file of a shard under construction, and its manifest rows."""

    SCHEMA = "temporary string, file string, shard int, turn int, records long, bytes long, sha1 string"

    def __init__(self, folder: str, shard: int, date: str, roll_bytes: int):
        self.folder, self.shard, self.date, self.roll_bytes, self.turn = folder, shard, date, roll_bytes, -1
        self.rows: list[dict] = []
        self.out = None

    def add(self, data: bytes) -> None:
        if self.out is None:
            self.turn += 1
            self.name = f"{self.shard:06d}-{self.turn:06d}.warc.gz"
            self.temporary = files.temporary(self.folder, self.name)
            self.out, self.digest, self.size, self.records = files.create(self.temporary), hashlib.sha1(), 0, 0
            self._write(record("warcinfo", {"WARC-Record-ID": _urn(self.name), "WARC-Date": self.date, "WARC-Filename": self.name,
                                            "Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n"))
        self._write(data)
        self.records += 1
        if self.size >= self.roll_bytes:
            self.close()

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.digest.update(data)
        self.size += len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None
            self.rows.append({"temporary": self.temporary, "file": self.name, "shard": self.shard, "turn": self.turn,
                              "records": self.records, "bytes": self.size, "sha1": self.digest.hexdigest()})

    def batch(self) -> pa.RecordBatch:
        types = [("temporary", pa.string()), ("file", pa.string()), ("shard", pa.int32()), ("turn", pa.int32()),
                 ("records", pa.int64()), ("bytes", pa.int64()), ("sha1", pa.string())]
        rows, self.rows = self.rows, []
        return pa.RecordBatch.from_pylist(rows, schema=pa.schema(types))


def write(pages: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES, date: str = DATE,
          min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write ``page_id``, ``url``, ``html`` to archives in ``folder``; the manifest, one row a file."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    source = source.withColumn("digest", F.unhex(F.sha1("payload")))
    cuts = files.edges(source.select(F.col("page_id").alias("key"), (F.octet_length("payload") + 512).alias("weight")), shard_bytes)

    # what is a copy of what: only ids and digests move
    light = source.where(F.octet_length("payload") >= min_revisit_bytes).select("page_id", "digest")
    copied = light.groupBy("digest").agg(F.max("page_id").alias("keep"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    marks = light.join(copied, "digest").distinct()
    # a mark travels to its page by sorting before it
    tagged = marks.select("page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "digest",
                          "keep", F.lit(0).alias("tag"))
    rows = tagged.unionByName(source.withColumns({"keep": F.lit(None).cast("long"), "tag": F.lit(1)})).withColumn("shard", _shard(F.col("page_id"), cuts))
    ordered = rows.repartition(len(cuts) + 1, "shard").sortWithinPartitions("shard", F.col("page_id").asc_nulls_last(), "digest", "tag", "url")

    def write_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll, mark, answered = None, None, False
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("shard", "page_id", "url", "payload", "digest", "keep", "tag")]
            for shard, page_id, url, body, digest, keep, tag in zip(*columns):
                if roll is None or roll.shard != shard:
                    if roll is not None:
                        roll.close()
                        yield roll.batch()
                    roll = _Roll(folder, shard, date, roll_bytes)
                if tag == 0:
                    mark, answered = (page_id, digest, keep), False
                    continue
                copy = mark is not None and mark[:2] == (page_id, digest)
                first = copy and page_id == mark[2] and not answered  # the response among the copies
                answered = answered or first
                roll.add(page_record(page_id, url, digest, body, mark[2] if copy else None, copy and not first, date))
        if roll is not None:
            roll.close()
            yield roll.batch()

    return files.publish(ordered.mapInArrow(write_shards, _Roll.SCHEMA), folder)


def records(source: pa.NativeFile) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of every record of an archive."""
    data, member, parts = source.read(READ_BYTES), zlib.decompressobj(31), []
    while data:
        parts.append(member.decompress(data))
        if member.eof:
            whole = b"".join(parts)
            head, _, rest = whole.partition(b"\r\n\r\n")
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            yield fields, rest[:int(fields["Content-Length"])]
            data, member, parts = member.unused_data, zlib.decompressobj(31), []
        else:
            data = b""
        data = data or source.read(READ_BYTES)
    if parts:
        raise ValueError("the archive ends within a record")


READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, file string"


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """Every page record of the archives, its digests checked against its bytes."""
    names = manifest.select("file")

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("file").to_pylist():
                with files.open_file(f"{folder}/{name}") as source:
                    rows = []
                    for fields, block in records(source):
                        kind = fields["WARC-Type"]
                        if kind == "warcinfo":
                            continue
                        if f"sha1:{base32(hashlib.sha1(block).digest())}" != fields["WARC-Block-Digest"]:
                            raise ValueError(f"{name}: block digest of {fields['WARC-Record-ID']}")
                        http, _, body = block.partition(b"\r\n\r\n")
                        digest = fields["WARC-Payload-Digest"].partition(":")[2]
                        if kind == "response" and base32(hashlib.sha1(body).digest()) != digest:
                            raise ValueError(f"{name}: payload digest of {fields['WARC-Record-ID']}")
                        length = int(re.search(rb"Content-Length: (\d+)", http)[1])
                        number = lambda f: int(fields[f]) if f in fields else None
                        rows.append((number("Page-Id"), fields.get("WARC-Target-URI"), length, digest, kind, number("Refers-To-Page-Id"), name))
                        if len(rows) == 4096:
                            yield _batch(rows)
                            rows = []
                    yield _batch(rows)

    count = manifest.count()
    return names.repartition(max(1, count), "file").mapInArrow(pages, READ)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
    columns = list(zip(*rows)) if rows else [()] * len(types)
    names = [field.split()[0] for field in READ.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
