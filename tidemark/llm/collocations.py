"""Phrases whose words stand together far more often than apart, by language.

SON partitioning.  Documents are dealt to shards of a few MB.  A shard mines all its
phrases: a phrase with the least count over all n shards has at least an n-th of it in
some shard, so phrases that reach this lowered support somewhere are the only possible
ones.  Shards send each different phrase once, as a hash with its count, to the bucket of
the hash; the bucket unites what is locally frequent anywhere and counts exactly that over
all shards.  Where the lowered support is one occurrence (an absolute least count and many
shards), every phrase is locally frequent and the count alone decides.

The answer tells a shard the counts of all its phrases, so the first shard that has a
frequent phrase knows the counts of all its parts too, and spells it out: no phrase travels
as text before it is known to be frequent.  What is left is one row a frequent phrase.

Words are told apart by 64 bits, phrases by 64 bits of the hashes of their words, length and
language; among n different ones about n**2 / 2**65 pairs are taken for equal.  Counts and
scores are exact integers of any size up to their columns of 64 bits.

Defined results: a null text has no words, a null language is ``und``; repeated rows count
as often as they stand there; without candidates, or documents, the result is empty; a
phrase never crosses one of ``.,;:!?``, a line end (``\\x0A-\\x0D``) or a document; other
columns play no part, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import chunks as C
from tidemark.llm import words as W
from tidemark.session import scratch_folder

SHARD_BYTES = 4 << 20  # of text
BUCKET_BYTES = 3 << 20  # of text whose phrases one bucket counts, as a mean
SCALE = 1_000_000  # of scores

_BREAKS = np.zeros(256, bool)
_BREAKS[list(b".,;:!?\n\x0b\x0c\r")] = True
_OUTSIDE = _BREAKS.copy()
_OUTSIDE[list(b" \t")] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32

FOUND = "candidate boolean, lang string, key long, phrase string, a long, l long, r long, n long, score long"


class Shard:
    """The words of a shard's texts, and its different phrases of up to ``longest`` words."""

    def __init__(self, docs: pa.Table, longest: int):
        data, offsets = W.buffers(docs.column("text"))
        self.data, self.longest = data, longest
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = ~_OUTSIDE[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        before, after = inside[:-1], inside[1:]
        self.starts, self.ends = np.flatnonzero(after & (~before | cut)), np.flatnonzero(before & (~after | cut))
        self.words = len(self.starts)
        owner = np.repeat(np.arange(len(docs)), np.diff(np.searchsorted(self.starts, offsets)))
        langs = docs.column("lang").combine_chunks().dictionary_encode()
        self.langs, lang = langs.dictionary, langs.indices.to_numpy()
        bytes_, bounds = W.buffers(self.langs)
        self.lang_hash = W.segment_hashes(bytes_, bounds[:-1], bounds[1:])
        self.lang = lang[owner]  # of every word
        breaks = W.sums(_BREAKS[data])
        self.piece = breaks[self.starts] + owner  # grows at every break and with every text
        hashes = W.segment_hashes(data, self.starts, self.ends, W._FOLDED)
        self.at = {}  # keys of the phrases that begin at every word, by length; 0 where none does
        for size in range(1, longest + 1):
            keys = np.zeros(self.words, np.uint64)
            n = self.words - size + 1
            if n > 0:
                fits = self.piece[:n] == self.piece[size - 1:]
                windows = hashes if size == 1 else W.window_hashes(hashes, size)
                keys[:n] = np.where(fits, np.maximum(W.mix(windows ^ self._mark(size)[self.lang[:n]]), np.uint64(1)), np.uint64(0))
            self.at[size] = keys
        every = np.concatenate([self._mark(0)[self.lang], *self.at.values()])  # the key of a language counts its words
        self.keys, self.first, self.counts = np.unique(every, return_index=True, return_counts=True)
        some = int(len(self.keys) > 0 and self.keys[0] == 0)
        self.keys, self.first, self.counts = self.keys[some:], self.first[some:], self.counts[some:]

    def _mark(self, size: int) -> np.ndarray:
        return W.mix(self.lang_hash + np.uint64(size))

    def by_bucket(self, bits: int) -> Iterator[tuple[int, slice]]:
        edges = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(1, np.uint64)
        at = [*np.searchsorted(self.keys, edges).tolist(), len(self.keys)]
        return ((b, slice(s, e)) for b, (s, e) in enumerate(zip(at, at[1:])) if e > s)

    def spell(self, starts: np.ndarray, size: int) -> pa.Array:
        """The phrases at these words, folded, joined by single spaces."""
        which = (starts[:, None] + np.arange(size)).ravel()
        lengths = self.ends[which] - self.starts[which] + 1
        bounds = W.sums(lengths)
        source = np.arange(bounds[-1]) + np.repeat(self.starts[which] - bounds[:-1], lengths)
        text = _FOLD[self.data[np.minimum(source, len(self.data) - 1)]]
        text[bounds[1:] - 1] = 0x20
        text[bounds[size::size] - 1] = 0
        begins = bounds[::size]
        keep = np.ones(len(text), bool)
        keep[begins[1:] - 1] = False
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(begins - np.arange(len(begins))), pa.py_buffer(text[keep])]).cast(pa.large_string()).cast(pa.string())


def scores(a: np.ndarray, parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``l``, ``r`` and the floor of the scaled score of the cut that scores least; of equal ones the first."""
    square = a.astype(object) ** 2 * SCALE  # Python's integers: products pass 64 bits
    left, right = (x.copy() for x in parts[0])
    score = square // (left.astype(object) * right.astype(object))
    for l, r in parts[1:]:
        other = square // (l.astype(object) * r.astype(object))
        less = (other < score).astype(bool)
        left[less], right[less], score[less] = l[less], r[less], other[less]
    return left, right, score.astype(np.int64)


def counted(docs: DataFrame, longest: int = 3, least: int = 10, absorb: int = 50, text: str = "text", lang: str = "lang",
            shard_bytes: int = SHARD_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Frequent phrases of 2 to ``longest`` words with their score (``candidate``), and the keys of those that a
    longer one absorbs, because it has at least ``absorb`` percent of their count."""
    total = C.text_bytes(docs, text)
    n = max(1, math.ceil(total / shard_bytes))
    support = max(1, math.ceil(least / n))
    bits = C.bucket_bits(total, bucket_bytes)
    chosen = docs.where(F.length(F.col(f"`{text}`")) > 0).select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text}`").alias("text"))
    # equal rows of different input partitions go to different shards
    dealt = chosen.select(F.pmod(F.xxhash64("text", F.spark_partition_id()), F.lit(n)).cast("int").alias("chunk"), "lang", "text")

    def mine(texts: pa.Table) -> Iterator[tuple[int, int, bytes, bytes]]:
        shard = Shard(texts, longest)
        for bucket, part in shard.by_bucket(bits):
            keys, counts = shard.keys[part], shard.counts[part].astype(np.uint32)
            yield bucket, len(keys), C.pack(C.deltas(keys)), C.pack(counts)

    def count(rows: list[dict]) -> list[bytes]:
        keys = np.concatenate([np.cumsum(C.unpack(r["keys"], np.uint64, r["n"])) for r in rows])
        counts = np.concatenate([C.unpack(r["payload"], np.uint32, r["n"]) for r in rows]).astype(np.int64)
        order = np.argsort(keys, kind="stable")  # the shards of a key in ascending order
        begin = np.flatnonzero(np.r_[True, np.diff(keys[order]) != 0])
        united = np.maximum.reduceat(counts[order], begin) >= support
        sums = np.add.reduceat(counts[order], begin)
        sums[~united | (sums < least)] = 0
        answers = np.empty(len(keys), np.int64)
        answers[order] = np.repeat(sums, np.diff(np.r_[begin, len(keys)])) * 2
        answers[order[begin]] += sums > 0  # the first shard that has it
        parts = np.split(answers, np.cumsum([r["n"] for r in rows])[:-1])
        return [C.pack(x) for x in parts]

    def report(texts: pa.Table, answers: list[dict]) -> pa.Table:
        shard = Shard(texts, longest)
        told = np.concatenate([C.unpack(r["answer"], np.int64, r["n"]) for r in answers]) if answers else np.empty(0, np.int64)
        totals, mine_ = told >> 1, (told & 1).astype(bool)
        which = shard.first // max(1, shard.words)  # length of the phrase a key stands for

        def count_of(size: int, starts: np.ndarray) -> np.ndarray:
            return totals[np.searchsorted(shard.keys, shard.at[size][starts])]

        words_of = totals[np.searchsorted(shard.keys, shard._mark(0))] if shard.words else np.zeros(len(shard.langs), np.int64)
        tables = [pa.table({f: pa.array([], t) for f, t in _TYPES.items()})]
        for size in range(2, longest + 1):
            here = np.flatnonzero(mine_ & (which == size))
            if not len(here):
                continue
            starts, a = shard.first[here] - size * shard.words, totals[here]
            parts = [(count_of(k, starts), count_of(size - k, starts + k)) for k in range(1, size)]
            left, right, score = scores(a, parts)
            lang_of = shard.lang[starts]
            tables.append(pa.table({
                "candidate": pa.array(np.ones(len(here), bool)), "lang": shard.langs.take(pa.array(lang_of)),
                "key": pa.array(shard.keys[here].view(np.int64)), "phrase": shard.spell(starts, size), "a": pa.array(a),
                "l": pa.array(left), "r": pa.array(right), "n": pa.array(words_of[lang_of]), "score": pa.array(score)}))
            for inner in range(2, size):
                for shift in range(size - inner + 1):
                    part = starts + shift
                    absorbed = np.unique(shard.at[inner][part[100 * a >= absorb * count_of(inner, part)]])
                    blank = {f: pa.nulls(len(absorbed), t) for f, t in _TYPES.items()}
                    tables.append(pa.table(blank | {"candidate": pa.array(np.zeros(len(absorbed), bool)), "key": pa.array(absorbed.view(np.int64))}))
        return pa.concat_tables(tables)

    return C.finish(dealt, C.answer(C.ask(dealt, mine), count), report, FOUND)


_TYPES = {"candidate": pa.bool_(), "lang": pa.string(), "key": pa.int64(), "phrase": pa.string(), "a": pa.int64(), "l": pa.int64(),
          "r": pa.int64(), "n": pa.int64(), "score": pa.int64()}


def collocations(docs: DataFrame, top: int | None = 2000, **options) -> DataFrame:
    """The ``top`` collocations of each language, or all: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    By score and count descending, then phrase.  ``options`` are those of ``counted``.
    """
    spark = docs.sparkSession
    path = f"{scratch_folder(spark)}/phrases"
    counted(docs, **options).write.parquet(path)
    found = spark.read.parquet(path)
    absorbed = found.where("NOT candidate").select("key").distinct()
    left = found.where("candidate").join(absorbed, "key", "left_anti")
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(best))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
