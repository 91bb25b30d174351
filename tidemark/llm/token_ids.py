"""Token ids in flat files, with document boundaries in Elias-Fano form.

A shard is three files: all ids one after another in 2 or 4 bytes each, the boundaries
of its documents, and their doc ids.  Boundaries and doc ids ascend, so both are kept as
Elias-Fano sequences: about 2 + log2(range / n) bits each, read by a select over the
upper bits that starts at the nearest of a few sampled ones.

Defined results: a null text is an empty one; documents stand in ascending order of
their ids, null ids after all others, rows with equal ids by their text; repeated rows
are written as often as they stand there; an empty table gives no shards and an empty
result; other columns play no part.
"""

from __future__ import annotations

import math
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import files
from tidemark.llm import words as W

END_ID = 2  # fixed by the contract
SHARD_BYTES = 32 << 20  # of text
KNOWN = 1 << 20  # different pieces a worker keeps
ENCODED_TOGETHER = 1 << 9  # pieces
SAMPLE = 512  # documents between sampled positions


class EliasFano:
    """An ascending sequence of integers from 0, packed."""

    def __init__(self, n: int, low_bits: int, lower: np.ndarray, upper: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.lower, self.upper, self.samples = n, low_bits, lower, upper, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n, top = len(values), int(values[-1]) + 1 if len(values) else 1
        low_bits = max(0, int(math.log2(top / n))) if n else 0
        high = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)  # places of the ones in the upper bits
        upper = np.zeros((int(high[-1]) >> 3) + 1 if n else 0, np.uint8)
        np.bitwise_or.at(upper, high >> 3, (1 << (high & 7)).astype(np.uint8))
        bits = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        lower = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        return cls(n, low_bits, lower, upper, high[::SAMPLE].astype(np.uint32 if len(upper) < 1 << 29 else np.uint64))

    def select(self, begin: int, end: int) -> np.ndarray:
        """The values from position ``begin`` up to ``end``, without reading those far from them."""
        if begin >= end:
            return np.empty(0, np.int64)
        first, last = begin // SAMPLE, (end - 1) // SAMPLE + 1
        byte = int(self.samples[first]) >> 3
        stop = (int(self.samples[last]) >> 3) + 1 if last < len(self.samples) else len(self.upper)
        ones = np.flatnonzero(np.unpackbits(self.upper[byte:stop], bitorder="little")) + 8 * byte
        skip = int(np.searchsorted(ones, int(self.samples[first]))) + begin - first * SAMPLE
        high = ones[skip:skip + end - begin] - np.arange(begin, end)
        if not self.low_bits:
            return high
        bit = begin * self.low_bits
        span = np.unpackbits(self.lower[bit >> 3:(end * self.low_bits + 7) >> 3], bitorder="little")
        bits = span[bit & 7:][:(end - begin) * self.low_bits].reshape(-1, self.low_bits).astype(np.int64)
        return (high << self.low_bits) | (bits @ (np.int64(1) << np.arange(self.low_bits, dtype=np.int64)))

    def tobytes(self) -> bytes:
        head = np.array([self.n, self.low_bits, len(self.lower), len(self.upper), len(self.samples), self.samples.itemsize], "<i8")
        return b"".join(x.tobytes() for x in (head, self.lower, self.upper, self.samples))

    @classmethod
    def frombytes(cls, data: bytes) -> EliasFano:
        n, low_bits, lower, upper, samples, size = np.frombuffer(data, "<i8", 6).tolist()
        at = 48
        return cls(n, low_bits, np.frombuffer(data, np.uint8, lower, at), np.frombuffer(data, np.uint8, upper, at + lower),
                   np.frombuffer(data, f"<u{size}", samples, at + lower + upper))


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


# A space before one of these bytes begins a piece of its own under the tokenizer's
# pattern, whatever stands before it: printable ASCII and letters of two bytes.  No
# white space begins with any of them, so the text can be cut there.
_CUT_BEFORE = np.zeros(256, bool)
_CUT_BEFORE[0x21:0x7F] = True
_CUT_BEFORE[0xC3:0xE0] = True


def _widths(tokenizer) -> np.ndarray:
    """Bytes of text that every token stands for: a byte-level token has one character a byte."""
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    widths = np.zeros(max(vocabulary.values(), default=-1) + 1, np.int64)
    widths[list(vocabulary.values())] = list(map(len, vocabulary))
    for number, added in tokenizer.get_added_tokens_decoder().items():
        widths[number] = len(added.content.encode())
    return widths


class _Known:
    """Ids of the pieces that this worker has met, by hash; when there are too many, those not met again are forgotten."""

    def __init__(self, tokenizer):
        self.tokenizer, self.widths = tokenizer, _widths(tokenizer)
        self.hashes, self.ids = np.empty(0, np.uint64), np.empty(0, np.uint32)
        self.begins, self.sizes = np.empty(0, np.int64), np.empty(0, np.int64)
        self.again = np.empty(0, bool)  # met since it was encoded or last kept

    def forget(self) -> None:
        self.hashes, begins, self.sizes = self.hashes[self.again], self.begins[self.again], self.sizes[self.again]
        bounds = W.sums(self.sizes)
        self.ids = self.ids[np.arange(bounds[-1]) + np.repeat(begins - bounds[:-1], self.sizes)]
        self.begins, self.again = bounds[:-1], np.zeros(len(begins), bool)

    def encode(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where each piece's begin and how many they are, for pieces ascending by hash."""
        if len(self.hashes) > KNOWN:
            self.forget()
        at = np.searchsorted(self.hashes, hashes)
        met = self.hashes[np.minimum(at, len(self.hashes) - 1)] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)
        self.again[at[met]] = True
        new = np.flatnonzero(~met)
        if len(new):
            ids, begins, sizes = self._encode_new(data, starts[new], ends[new])
            self.hashes = np.insert(self.hashes, at[new], hashes[new])
            self.begins = np.insert(self.begins, at[new], begins + len(self.ids))
            self.sizes = np.insert(self.sizes, at[new], sizes)
            self.again = np.insert(self.again, at[new], False)
            self.ids = np.concatenate([self.ids, ids])
            at += W.sums(~met)[:-1]
        return self.ids, self.begins[at], self.sizes[at]

    def _encode_new(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        joins = (data[starts] == 0x20) & _CUT_BEFORE[data[np.minimum(starts + 1, ends - 1)]]  # safe whatever stands before
        order = np.argsort(~joins, kind="stable")
        lists, counts = [], []
        for i in range(0, len(order), ENCODED_TOGETHER):
            part = order[i:i + ENCODED_TOGETHER]
            length = ends[part] - starts[part]
            bounds = W.sums(length)
            raw = data[np.arange(bounds[-1]) + np.repeat(starts[part] - bounds[:-1], length)].tobytes()
            ids, count = (self._joined(raw, bounds) if joins[part].all() else None) or self._apart(raw, bounds)
            lists.append(ids)
            counts.append(count)
        sizes, begins = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        sizes[order] = np.concatenate(counts)
        begins[order] = W.sums(sizes[order])[:-1]
        return np.concatenate(lists), begins, sizes

    def _joined(self, raw: bytes, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of pieces that each begin at a safe cut, encoded as one text; None unless every piece ends where a token does."""
        encoded = self.tokenizer.encode_batch_fast([raw.decode("utf-8", "replace")], add_special_tokens=False)
        ids = np.array(encoded[0].ids, np.uint32)
        stops = W.sums(self.widths[ids])
        at = np.searchsorted(stops, bounds)
        if stops[-1] != bounds[-1] or (stops[at] != bounds).any():
            return None
        return ids, np.diff(at)

    def _apart(self, raw: bytes, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pieces = [raw[s:e].decode("utf-8", "replace") for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(chain.from_iterable(lists), np.uint32, int(counts.sum())), counts


@lru_cache(maxsize=2)
def _known(path: str) -> _Known:
    return _Known(_tokenizer(path))


def encode_texts(known: _Known, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another, and their offsets.

    Each different piece between cuts is encoded once.
    """
    data, offsets = W.buffers(column)
    cut = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        cut[:len(data) - 1] = (data[:-1] == 0x20) & _CUT_BEFORE[data[1:]]
        cut[offsets[1:] - 1] = False  # a space at the end of a text has nothing after it
    cut[offsets] = True
    starts = np.flatnonzero(cut[:-1])
    ends = np.append(starts[1:], len(data))
    coded = pa.array(W.segment_hashes(data, starts, ends)).dictionary_encode()
    hashes, group = coded.dictionary.to_numpy(), coded.indices.to_numpy()
    some = np.empty(len(hashes), np.int64)
    some[group] = np.arange(len(group))  # a place where each different piece stands
    order = np.argsort(hashes)
    begins, lengths = np.empty(len(hashes), np.int64), np.empty(len(hashes), np.int64)
    flat, begins[order], lengths[order] = known.encode(hashes[order], data, starts[some[order]], ends[some[order]])
    size = lengths[group]
    at = W.sums(size)
    ids = flat[np.arange(at[-1]) + np.repeat(begins[group] - at[:-1], size)]
    return ids, at[np.searchsorted(starts, offsets)]


def id_width(tokenizer) -> int:
    return 2 if tokenizer.get_vocab_size() <= 1 << 16 else 4


def write(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES,
          doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode ``docs`` into shards in ``folder``; the manifest, one row a shard."""
    source = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("text"))
    cuts = files.edges(source.select(F.col("doc").alias("key"), (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).alias("weight")), shard_bytes)
    width = id_width(_tokenizer(tokenizer_path))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known(tokenizer_path)
        for batch in batches:
            for part in W.slices(batch, size=2 * W.SLICE):
                ids, offsets = encode_texts(known, part.column("text"))
                n = len(part)
                full = np.full(len(ids) + n, end_id, f"<u{width}")
                word = np.ones(len(full), bool)
                word[offsets[1:] + np.arange(n)] = False
                full[word] = ids
                packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [
                    None, pa.py_buffer(((offsets + np.arange(n + 1)) * width).astype(np.int64)), pa.py_buffer(full)])
                doc = part.column("doc")
                yield pa.RecordBatch.from_arrays([files.shard_of(doc, cuts), doc, packed.cast(pa.binary())], names=["shard", "doc", "ids"])

    def write_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            numbers = batch.column("shard").to_numpy()
            bounds = [0, *(np.flatnonzero(numbers[1:] != numbers[:-1]) + 1), len(numbers)] if len(numbers) else []
            for begin, end in zip(bounds, bounds[1:]):
                if shard is None or shard.number != numbers[begin]:
                    if shard:
                        yield shard.close()
                    shard = _Shard(folder, int(numbers[begin]), width)
                shard.add(batch.slice(begin, end - begin))
        if shard:
            yield shard.close()

    shards = len(cuts) + 1
    ordered = (source.mapInArrow(encode, "shard int, doc long, ids binary").repartition(shards, "shard")
               .sortWithinPartitions("shard", F.col("doc").asc_nulls_last(), "ids"))
    return files.publish(ordered.mapInArrow(write_shards, _Shard.SCHEMA), folder)


class _Shard:
    """The files of a shard under construction."""

    SCHEMA = "temporary string, file string, shard int, width int, docs long, named long, least long, tokens long"

    def __init__(self, folder: str, number: int, width: int):
        self.number, self.width, self.folder = number, width, folder
        self.name = files.temporary(folder, f"{number:06d}")
        self.ids = files.create(f"{self.name}.ids")
        self.lengths: list[np.ndarray] = []
        self.docs: list[np.ndarray] = []
        self.rows = 0

    def add(self, batch: pa.RecordBatch) -> None:
        data, offsets = W.buffers(batch.column("ids"))
        self.ids.write(data.tobytes())
        self.lengths.append(np.diff(offsets) // self.width)
        self.docs.append(batch.column("doc").drop_null().to_numpy())  # null ids come last
        self.rows += len(batch)

    def close(self) -> pa.RecordBatch:
        self.ids.close()
        bounds = W.sums(np.concatenate(self.lengths))
        docs = np.concatenate(self.docs)
        least = int(docs[0]) if len(docs) else 0
        for kind, values in (("bounds", bounds), ("docs", (docs - least).astype(np.uint64))):
            with files.create(f"{self.name}.{kind}") as out:
                out.write(EliasFano.of(values).tobytes())
        kinds = ("ids", "bounds", "docs")
        same = lambda x, t: pa.array([x] * 3, t)
        return pa.RecordBatch.from_arrays(
            [pa.array([f"{self.name}.{k}" for k in kinds]), pa.array([f"{self.number:06d}.{k}" for k in kinds]),
             same(self.number, pa.int32()), same(self.width, pa.int32()), same(self.rows, pa.int64()), same(len(docs), pa.int64()),
             same(least, pa.int64()), same(int(bounds[-1]), pa.int64())],
            names=["temporary", "file", "shard", "width", "docs", "named", "least", "tokens"])


def read(manifest: DataFrame, folder: str, block: int = 4096) -> DataFrame:
    """Every document of the shards: ``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32``."""
    shards = manifest.where("file LIKE '%.ids'").drop("file")
    totals = sorted((r.shard, r.tokens) for r in shards.select("shard", "tokens").collect())  # two numbers a shard
    before = dict(zip((s for s, _ in totals), W.sums(np.array([t for _, t in totals], np.int64)).tolist()))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                name = f"{folder}/{row['shard']:06d}"
                bounds, docs = (EliasFano.frombytes(files.open_file(f"{name}.{k}").readall()) for k in ("bounds", "docs"))
                with files.open_file(f"{name}.ids") as ids:
                    for begin in range(0, row["docs"], block):
                        end = min(begin + block, row["docs"])
                        at = bounds.select(begin, end + 1)
                        named = docs.select(begin, max(begin, min(end, row["named"]))) + row["least"]
                        sums = []
                        for s, e in zip(at[:-1].tolist(), at[1:].tolist()):
                            ids.seek(s * row["width"])
                            sums.append(zlib.crc32(np.frombuffer(ids.read((e - s) * row["width"]), f"<u{row['width']}").astype("<u4").tobytes()))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([*named.tolist(), *[None] * (end - begin - len(named))], pa.int64()), pa.array(at[:-1] + before[row["shard"]]),
                             pa.array(np.diff(at)), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.repartition(max(1, len(totals)), "shard").mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long")
