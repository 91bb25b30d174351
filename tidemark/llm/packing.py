"""Documents packed into sequences of a fixed number of tokens.

Documents are encoded and cut into pieces where Spark reads them.  Only the histogram of
piece lengths, one count a possible length, reaches the driver, which plans on counts and
not on pieces:

1. An index of exact complements holds how many single lengths, pairs and, from both,
   triples of available lengths give each sum.  From the longest length down, a piece
   takes the combination that fills its gap to the last token, as often as the counts
   allow; singles come before pairs and pairs before triples.
2. What has no exact complement is placed best-fit: longest first, into the tightest gap
   that takes it.

Combinations use up short pieces that best-fit may need elsewhere, so the counts are planned
with up to three, two and one pieces a gap, and the plan with the fewest sequences is taken.
Every step uses up a length, a group of equal open sequences or one last part of such a
group, so the plan has a few entries a possible length however many pieces there are.
Equal lengths are interchangeable: the k-th piece of a length (counted by block of pieces,
with one running total per length over the blocks) reads its place from the plan.

Defined results: a null or empty text is one piece, the end id alone; a row is a document,
also where ids repeat or are null; an empty table gives an empty result; a document longer
than a sequence is cut so that only its first piece may be shorter; other columns of the
documents play no part, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import token_ids
from tidemark.llm import words as W

CAPACITY = 2048
END_ID = 0  # fixed by the contract
ENCODED = 4 << 20  # bytes of text whose pieces are one block

PIECES = "block long, doc_id long, piece int, start long, length long, nth long, ids binary"
ADDED = ("sequence_id", "offset")


class Complements:
    """Available lengths, and how many pairs of them have each sum."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.astype(np.int64)
        self.top = len(counts) - 1
        one = (self.left > 0).astype(np.int64)
        both = np.convolve(one, one)[:self.top + 1]  # ordered pairs, and each length with itself
        doubles = np.zeros_like(both)
        doubles[::2] = one[:len(doubles[::2])]
        self.pairs = (both - doubles) // 2
        self.pairs[::2] += (self.left > 1)[:len(doubles[::2])]

    def take(self, length: int, n: int) -> None:
        before, after = self.left[length], self.left[length] - n
        self.left[length] = after
        if before > 1 >= after and 2 * length <= self.top:
            self.pairs[2 * length] -= 1
        if before > 0 and after == 0:
            others = self.left[:self.top - length + 1] > 0
            self.pairs[length:][others] -= 1

    def filling(self, gap: int, most: int = 3) -> tuple[int, ...] | None:
        """One, two or three available lengths (``most`` of them) with this sum; the largest that can be."""
        if gap == 0:
            return ()
        if self.left[gap]:
            return (gap,)
        return (most > 1 and self._pair(gap)) or (most > 2 and self._triple(gap)) or None

    def _pair(self, gap: int) -> tuple[int, int] | None:
        if self.pairs[gap] <= 0:
            return None
        larger = np.arange(gap - 1, (gap - 1) // 2, -1)
        fits = (self.left[larger] > 0) & (self.left[gap - larger] > np.where(2 * larger == gap, 1, 0))
        found = np.flatnonzero(fits)
        return (int(larger[found[0]]), int(gap - larger[found[0]])) if len(found) else None

    def _triple(self, gap: int) -> tuple[int, int, int] | None:
        largest = np.arange(gap - 2, 0, -1)
        for x in largest[(self.left[largest] > 0) & (self.pairs[gap - largest] > 0)].tolist():
            self.left[x] -= 1  # the pair may not use this one again
            pair = self._pair(gap - x)
            self.left[x] += 1
            if pair:
                return (x, *pair)
        return None


class Plan:
    """Where the pieces of every length go: runs of ranks that fill runs of sequences."""

    def __init__(self, counts: np.ndarray, capacity: int, most: int = 3):
        self.used = np.zeros(capacity + 1, np.int64)  # ranks given away
        self.runs: list[tuple[int, int, int, int, int]] = []  # length, first rank, pieces a sequence, first sequence, offset
        self.sequences = 0
        self._best_fit(self._exact(counts, capacity, most), capacity)
        order = sorted(self.runs)
        self.table = np.array(order, np.int64).reshape(-1, 5)
        self.first = np.searchsorted(self.table[:, 0], np.arange(capacity + 2))

    def _put(self, length: int, each: int, sequences: int, first: int, offset: int) -> None:
        self.runs.append((length, int(self.used[length]), each, first, offset))
        self.used[length] += each * sequences

    def _open(self, sequences: int) -> int:
        self.sequences += sequences
        return self.sequences - sequences

    def _exact(self, counts: np.ndarray, capacity: int, most: int) -> np.ndarray:
        """Fill sequences to the last token; the counts that are left."""
        index, rest = Complements(counts), np.zeros(capacity + 1, np.int64)
        for longest in range(capacity, 0, -1):
            while index.left[longest]:
                index.take(longest, 1)
                found = index.filling(capacity - longest, most)
                if found is None:
                    rest[longest] = index.left[longest] + 1
                    index.take(longest, int(index.left[longest]))
                    break
                need = Counter(found)
                whole = need + Counter([longest])
                more = min((int(index.left[x]) - need[x]) // n for x, n in whole.items())
                for x, n in whole.items():
                    index.take(x, need[x] + more * n)
                first, offset = self._open(1 + more), 0
                for x in sorted(whole, reverse=True):
                    self._put(x, whole[x], 1 + more, first, offset)
                    offset += x * whole[x]
        return rest

    def _best_fit(self, rest: np.ndarray, capacity: int) -> None:
        gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # runs of open sequences by what is free
        free = np.zeros(capacity + 1, bool)
        for length in range(capacity, 0, -1):
            left = int(rest[length])
            while left:
                fits = int(np.argmax(free[length:])) + length
                if free[fits]:
                    first, n = gaps[fits].pop()
                    free[fits] = bool(gaps[fits])
                else:
                    fits, n = capacity, -(-left // (capacity // length))
                    first = self._open(n)
                each = min(fits // length, left)
                filled = min(n, left // each)
                self._put(length, each, filled, first, capacity - fits)
                left -= each * filled
                for begin, count, gap in ((first, filled, fits - each * length), (first + filled, n - filled, fits)):
                    if count and gap:
                        gaps[gap].append((begin, count))
                        free[gap] = True

    def place(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the ``ranks``-th pieces of these lengths, from 0."""
        sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        order = np.argsort(lengths, kind="stable")
        found, begin = np.unique(lengths[order], return_index=True)
        for length, rows in zip(found.tolist(), np.split(order, begin[1:])):
            runs = self.table[self.first[length]:self.first[length + 1]]
            at = np.searchsorted(runs[:, 1], ranks[rows], "right") - 1
            _, rank, each, first, start = runs[at].T
            within = ranks[rows] - rank
            sequence[rows], offset[rows] = first + within // each, start + within % each * length
        return sequence, offset


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """The plan with the fewest sequences; of equal ones, that with the largest combinations."""
    return min((Plan(counts, capacity, most) for most in (3, 2, 1)), key=lambda p: p.sequences)


def cut(docs: DataFrame, folder: str, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
        doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and cut ``docs`` into ``folder``: a row a piece with its ids, 4 bytes each, and its number among
    the pieces of its length in its block."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = token_ids._known(tokenizer_path)
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in W.slices(batch, size=ENCODED):
                ids, offsets = token_ids.encode_texts(known, part.column("text"))
                n = len(part)
                full = np.full(len(ids) + n, end_id, "<u4")
                inside = np.ones(len(full), bool)
                inside[offsets[1:] + np.arange(n)] = False
                full[inside] = ids
                tokens = np.diff(offsets) + 1
                pieces = -(-tokens // capacity)
                owner = np.repeat(np.arange(n), pieces)
                number = np.arange(len(owner)) - np.repeat(W.sums(pieces)[:-1], pieces)
                shorter = tokens - (pieces - 1) * capacity  # tokens of the first
                length = np.where(number == 0, shorter[owner], capacity)
                start = np.where(number == 0, 0, shorter[owner] + (number - 1) * capacity)
                order = np.argsort(length, kind="stable")
                alike = np.flatnonzero(np.r_[True, np.diff(length[order]) != 0])
                nth = np.empty(len(owner), np.int64)
                nth[order] = np.arange(len(owner)) - np.repeat(alike, np.diff(np.r_[alike, len(owner)]))
                packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(owner), [
                    None, pa.py_buffer(W.sums(length) * 4), pa.py_buffer(full)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(owner), block)), part.column("doc_id").take(pa.array(owner)), pa.array(number.astype(np.int32)),
                     pa.array(start), pa.array(length), pa.array(nth), packed.cast(pa.binary())],
                    names=["block", "doc_id", "piece", "start", "length", "nth", "ids"])
                block += 1

    source = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    path = f"{folder}/pieces"
    source.mapInArrow(encode, PIECES).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(PIECES).parquet(path)


def histogram(pieces: DataFrame, capacity: int = CAPACITY) -> np.ndarray:
    """Number of pieces by length, from 0 to the capacity."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in pieces.groupBy("length").count().collect():  # a row a length: the capacity at most
        counts[length] = n
    return counts


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; other columns, such as the ids or their checksum, go along."""
    planned = plan(histogram(pieces, capacity), capacity)
    blocks = pieces.groupBy("block", "length").count()
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = blocks.select("block", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    ranked = pieces.join(totals, ["block", "length"]).select(*pieces.columns, (F.col("before") + F.col("nth")).alias("rank"))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = (batch.column(c).to_numpy() for c in ("length", "rank"))
            found = planned.place(lengths, ranks) if len(batch) else (ranks, ranks)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *map(pa.array, found)], names=[*batch.schema.names[:-1], *ADDED])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(assign, f"{kinds}, sequence_id long, offset long").drop("block", "nth")


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences: ids and where each piece begins, a row a sequence (at most ``capacity`` pieces each)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.transform("parts", lambda p: p["offset"]).alias("offsets"),
        F.aggregate("parts", F.lit(b""), lambda ids, p: F.concat(ids, p["ids"])).alias("ids"))
