"""Removal of word passages that repeat across or within documents.

Every window of ``window`` consecutive words gets a Rabin-Karp hash.  Buckets of
hashes count the occurrences in Spark; all but the earliest (smallest id, then
earliest start) are marked, and the marks of one document merge into maximal
intervals of words to remove.

Defined results: a null or empty text has no words and stays as it is; a text shorter
than the window loses nothing; a null id counts as larger than all others; repeated
rows (equal id and text) stand at the same place, so neither is earlier and both keep
what a single one would keep; an empty table gives an empty result; other columns pass
through by ``carry``, whatever their names.

Windows are told apart by 64 bits of hash: among n windows about n*n/2**65 pairs of
different windows are expected to be taken for equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import chunks as C
from tidemark.llm import words as W

WINDOW = 20


class _Chunk:
    """The windows of a chunk's documents, each different hash at its earliest place."""

    def __init__(self, docs: pa.Table, window: int, bits: int):
        self.docs = C.in_order(docs)
        self.words = w = W.split(self.docs.column("text"))
        self.at = w.windows(window)
        hashes = W.window_hashes(w.hashes(), window)[self.at]
        row = np.searchsorted(w.first, self.at, "right") - 1
        self.ids = C.ids(self.docs)
        self.doc, self.start = self.ids[row], (self.at - w.first[row]).astype(np.int32)
        order = np.argsort(hashes, kind="stable")
        new = np.ones(len(order), bool)
        new[1:] = hashes[order[1:]] != hashes[order[:-1]]
        earliest = order[new]
        self.unique = np.sort(earliest)  # in order of place
        place = np.empty(len(order), np.int64)
        place[self.unique] = np.arange(len(self.unique))
        self.group = np.empty(len(order), np.int64)  # of a window: its hash's position in unique
        self.group[order] = place[earliest][np.cumsum(new) - 1]
        self.hashes = hashes[self.unique]
        self.order, self.buckets = C.by_bucket(self.hashes, bits)

    def questions(self) -> Iterator[tuple[int, int, bytes, bytes]]:
        hashes, doc, start = (x[self.order] for x in (self.hashes, self.doc[self.unique], self.start[self.unique]))
        for bucket, part in self.buckets:
            docs, first = np.unique(doc[part], return_index=True)
            head = np.zeros(len(doc[part]), bool)
            head[first] = True
            starts = start[part]
            steps = np.diff(starts, prepend=np.int32(0))
            steps[head] = starts[head]
            counts = np.diff(np.append(first, len(starts))).astype(np.int32)
            fields = [C.pack(C.deltas(docs)), C.pack(counts), C.pack(steps.astype(np.int32))]
            sizes = np.array([len(docs), *map(len, fields)], np.int32)
            yield bucket, len(starts), hashes[part].tobytes(), sizes.tobytes() + b"".join(fields)

    def removed(self, answers: list[dict]) -> np.ndarray:
        """Words covered by a window that also starts earlier."""
        later = np.empty(len(self.unique), bool)
        marks = [np.unpackbits(np.frombuffer(a["answer"], np.uint8), count=a["n"]) for a in answers]
        later[self.order] = np.concatenate(marks).astype(bool) if marks else np.empty(0, bool)
        first = self.unique[self.group]
        gone = later[self.group] | (self.doc != self.doc[first]) | (self.start != self.start[first])
        return self.at[gone]


def _places(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Ids and starts of a question's windows."""
    payload, n = row["payload"], row["n"]
    n_docs, a, b, c = np.frombuffer(payload, np.int32, 4)
    docs = np.cumsum(C.unpack(payload[16:16 + a], np.int64, n_docs))
    counts = C.unpack(payload[16 + a:16 + a + b], np.int32, n_docs)
    steps = C.unpack(payload[16 + a + b:16 + a + b + c], np.int32, n).astype(np.int64)
    total = np.cumsum(steps)
    first = W.sums(counts)[:-1]
    before = total[first] - steps[first]
    return np.repeat(docs, counts), total - np.repeat(before, counts)


def _respond(rows: list[dict]) -> list[bytes]:
    """For each window of a bucket: does its hash occur at an earlier place?"""
    hashes = np.concatenate([np.frombuffer(r["keys"], np.uint64) for r in rows])
    order = np.argsort(hashes)
    ordered = hashes[order]
    same = ordered[1:] == ordered[:-1]
    later = np.zeros(len(hashes), bool)
    if same.any():
        doc, start = (np.concatenate(x) for x in zip(*map(_places, rows)))
        member = np.zeros(len(hashes), bool)
        member[1:] = same
        member[:-1] |= same
        heads = np.ones(len(hashes), bool)
        heads[1:] = ~same
        rows_of = order[member]  # only hashes seen twice or more
        first = np.flatnonzero(heads[member])
        sizes = np.diff(np.append(first, len(rows_of)))
        d, s = doc[rows_of], start[rows_of]
        least_doc = np.repeat(np.minimum.reduceat(d, first), sizes)
        s_least = np.where(d == least_doc, s, np.iinfo(np.int64).max)
        least_start = np.repeat(np.minimum.reduceat(s_least, first), sizes)
        later[rows_of] = (d != least_doc) | (s != least_start)
    bounds = np.cumsum([r["n"] for r in rows])[:-1]
    return [np.packbits(x).tobytes() for x in np.split(later, bounds)]


def _intervals(cover: np.ndarray, w: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of covered words within one text: first word, and the word after the last."""
    edge = np.zeros(len(cover) + 1, bool)
    edge[w.first] = True
    before, after = np.append(False, cover), np.append(cover, False)
    return np.flatnonzero(after & (~before | edge)), np.flatnonzero(before & (~after | edge))


def _cut(w: W.Words, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts without the intervals and the white space after them."""
    keep = np.zeros(len(w.data) + 1, np.int64)
    row = np.searchsorted(w.first, begin, "right") - 1
    last = end == w.first[row + 1]  # up to the end of the text, with the white space before
    head = begin == w.first[row]
    starts = np.where(last & ~head, w.ends[np.maximum(begin - 1, 0)], w.starts[begin])
    stops = np.where(last, w.offsets[row + 1], w.starts[np.minimum(end, len(w.starts) - 1)])
    np.add.at(keep, starts, 1)
    np.add.at(keep, stops, -1)
    kept = np.cumsum(keep[:-1]) == 0
    return w.data[kept], W.sums(kept)[w.offsets]


def dedup(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Every document without its repeated passages.

    Returns ``doc_id``, the carried columns, ``text`` (what is left, its own white space
    kept), ``n_words``, ``n_removed`` and ``spans``, the removed intervals as
    ``array<struct<first, after>>`` of word positions.
    """
    total = C.text_bytes(docs, text)
    bits = C.bucket_bits(total)
    dealt = C.deal(docs, total, doc_id, text, carry)
    asked = C.ask(dealt, lambda rows: _Chunk(rows, window, bits).questions())
    answered = C.answer(asked, _respond)
    types = dict(dealt.dtypes)
    hand_on = [f"c{i}" for i in range(len(carry))]

    def apply(rows: pa.Table, answers: list[dict]) -> pa.Table:
        chunk = _Chunk(rows, window, bits)
        w = chunk.words
        cover = np.zeros(len(w.starts) + 1, np.int64)
        gone = chunk.removed(answers)
        np.add.at(cover, gone, 1)
        np.add.at(cover, gone + window, -1)
        covered = np.cumsum(cover[:-1]) > 0
        begin, end = _intervals(covered, w)
        data, offsets = _cut(w, begin, end)
        left = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(rows), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])
        texts = pa.compute.if_else(chunk.docs.column("text").is_valid(), left.cast(pa.large_string()), None)
        row = np.searchsorted(w.first, begin, "right") - 1
        spans = pa.ListArray.from_arrays(
            pa.array(np.searchsorted(row, np.arange(len(rows) + 1)).astype(np.int32)),
            pa.StructArray.from_arrays([pa.array((begin - w.first[row]).astype(np.int32)),
                                        pa.array((end - w.first[row]).astype(np.int32))], ["first", "after"]))
        return pa.table({
            "doc": chunk.docs.column("doc"), **{c: chunk.docs.column(c) for c in hand_on}, "text": texts.cast(pa.string()),
            "n_words": w.counts.astype(np.int64), "n_removed": w.per_text(covered), "spans": spans})

    schema = ", ".join(["doc long", *(f"{c} {types[c]}" for c in hand_on), "text string", "n_words long",
                        "n_removed long", "spans array<struct<first: int, after: int>>"])
    left = C.finish(dealt, answered, apply, schema)
    return left.select(F.col("doc").alias(doc_id), *(F.col(c).alias(name) for c, name in zip(hand_on, carry)),
                       F.col("text").alias(text), "n_words", "n_removed", "spans")


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents with repeated passages cut out and ``n_chars`` to match; same columns."""
    others = {c: f"keep_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    named = docs.select("doc_id", "text", *(F.col(f"`{c}`").alias(k) for c, k in others.items()))
    clean = dedup(named, window, carry=tuple(others.values()))
    fields = {c: F.col(others.get(c, c)) for c in docs.columns}
    if "n_chars" in fields:
        fields["n_chars"] = F.length("text").cast("long")
    return clean.select(*(value.alias(name) for name, value in fields.items()))
