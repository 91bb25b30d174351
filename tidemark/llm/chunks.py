"""Questions that chunks of documents put to buckets of hashes.

Several operators must learn, for each of very many hashes in a corpus, something
that depends on all its occurrences.  Documents are dealt to chunks of a few MB of
text.  A chunk sends each different hash once to the bucket of its leading bits (so a
hash that is everywhere reaches a bucket once per chunk, not once per occurrence), as
arrays and not as rows.  A bucket answers with an array in the same order, and the
chunk, whose documents Spark still has from the first exchange, applies the answers.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20  # text whose hashes one bucket holds, as a mean
NO_ID = np.iinfo(np.int64).max  # stands for a null id: after all others


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts."""
    return docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0


def deal(docs: DataFrame, total: int, doc_id: str = "doc_id", text: str = "text", carry: tuple[str, ...] = (),
         chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``chunk``, ``doc`` (id), ``text`` and the carried columns as ``c0``, ``c1``, ..."""
    n = max(1, math.ceil(total / chunk_bytes))
    chosen = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("text"),
                         *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)))
    return chosen.select(F.pmod(F.xxhash64("doc", "text"), F.lit(n)).cast("int").alias("chunk"), *chosen.columns)


def bucket_bits(total: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Leading bits of a hash that name its bucket."""
    return max(0, math.ceil(math.log2(max(1, total / bucket_bytes))))


def in_order(docs: pa.Table) -> pa.Table:
    """Rows of a chunk by id, nulls last, and by text where ids repeat; the same after any shuffle."""
    return docs.sort_by([("doc", "ascending"), ("text", "ascending")])


def ids(docs: pa.Table) -> np.ndarray:
    return docs.column("doc").fill_null(NO_ID).combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64)


def by_bucket(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, Iterator[tuple[int, slice]]]:
    """An order that gathers the buckets and keeps the order within each; the buckets and their slices."""
    if bits == 0:
        return np.arange(len(hashes)), iter([(0, slice(0, len(hashes)))] if len(hashes) else [])
    bucket = (hashes >> np.uint64(64 - bits)).astype(np.uint16 if bits <= 16 else np.uint32)
    order = np.argsort(bucket, kind="stable")
    found, first = np.unique(bucket[order], return_index=True)
    return order, ((int(b), slice(s, e)) for b, s, e in zip(found, first, [*first[1:], len(bucket)]))


def pack(values: np.ndarray) -> bytes:
    """Integers, compressed by byte planes: small ones, and differences in a sorted list, take little room."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True) if len(values) else b""


def unpack(packed: bytes, kind: type, n: int) -> np.ndarray:
    if not n:
        return np.empty(0, kind)
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(packed, n * size, codec="zstd"), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(kind).reshape(n)


def deltas(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=values[:1] * 0)


ASKED = "chunk int, bucket int, n int, keys binary, payload binary"
ANSWERED = "chunk int, bucket int, n int, answer binary"


def ask(dealt: DataFrame, questions: Callable[[pa.Table], Iterator[tuple[int, int, bytes, bytes]]]) -> DataFrame:
    """What ``questions`` yields for each chunk: bucket, number of hashes, hashes, payload."""

    def of_chunk(docs: pa.Table) -> pa.Table:
        chunk = docs.column("chunk")[0].as_py()
        rows = list(questions(docs))
        return pa.table({
            "chunk": pa.array([chunk] * len(rows), pa.int32()), "bucket": pa.array([r[0] for r in rows], pa.int32()),
            "n": pa.array([r[1] for r in rows], pa.int32()), "keys": pa.array([r[2] for r in rows], pa.binary()),
            "payload": pa.array([r[3] for r in rows], pa.binary())})

    return dealt.groupBy("chunk").applyInArrow(of_chunk, ASKED)


def answer(asked: DataFrame, respond: Callable[[list[dict]], list[bytes]]) -> DataFrame:
    """``respond`` gets all questions of a bucket, in the order of their chunks, and returns an answer to each."""

    def of_bucket(questions: pa.Table) -> pa.Table:
        rows = questions.sort_by("chunk").to_pylist()
        return pa.table({
            "chunk": pa.array([r["chunk"] for r in rows], pa.int32()),
            "bucket": pa.array([r["bucket"] for r in rows], pa.int32()),
            "n": pa.array([r["n"] for r in rows], pa.int32()),
            "answer": pa.array(respond(rows), pa.binary())})

    return asked.groupBy("bucket").applyInArrow(of_bucket, ANSWERED)


def finish(dealt: DataFrame, answered: DataFrame, apply: Callable[[pa.Table, list[dict]], pa.Table], schema: str) -> DataFrame:
    """``apply`` gets the documents of a chunk and its answers by bucket."""

    def of_chunk(docs: pa.Table, answers: pa.Table) -> pa.Table:
        return apply(docs, answers.sort_by("bucket").to_pylist())

    return dealt.groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInArrow(of_chunk, schema)
