"""A hidden Markov language model over words, trained by Baum-Welch.

The states emit symbols: the most frequent training words, one symbol each, and
classes of all other words by their last two bytes.  So the model that every task
needs has a fixed size, whatever the vocabulary.  Within a class a word has its share
of the class's training counts, with half a count for every known word and for one
unknown word.  Those counts grow with the corpus and never meet in one place: chunks of
documents ask buckets of words for them (see ``chunks``).

An iteration of Baum-Welch runs over all training documents; each task sums its
expected counts, Spark adds them up by symbol, and the driver gets the model alone.
The forward-backward pass is exact over every text.  Long texts are worked on in segments
of ``SEGMENT`` tokens side by side: a segment is a product of matrices, and the products of
a text give the forward row that enters each of its segments and the backward row that
enters it from behind, so memory is bounded however long a text is.  The score of a document
is the exact scaled forward recursion over all its tokens and one end.

Defined results: words are folded from A-Z to a-z; a null or empty text is the end
alone; a null id counts as the empty text in the choice of the held-out fold; repeated
rows count as often as they stand there; without training documents every word is
unknown; an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import chunks as C
from tidemark.llm import words as W
from tidemark.session import scratch_folder

FOLDS, HELD_OUT = 5, 1
STATES = 8
FREQUENT = 8192  # words with a symbol of their own
CLASSES = 255
ITERATIONS = 5
SEGMENT = 1024
RESCALED = 16  # tokens between two rescalings of a segment's product
TOP_TOGETHER = 32  # lists of frequent words merged by one task
PRIOR = 50.0  # counts of the corpus-wide distribution mixed into each state's
BATCH_TOKENS = 400_000
END = 0


def held_out(ids: pa.ChunkedArray) -> np.ndarray:
    """Documents kept from training: crc32 of the id as text, modulo 5, is 1."""
    names = ("" if i is None else str(i) for i in ids.to_pylist())
    return np.fromiter((zlib.crc32(n.encode()) % FOLDS == HELD_OUT for n in names), bool, len(ids))


def classes(w: W.Words) -> np.ndarray:
    """Class of every word, from its last two bytes."""
    if not len(w.ends):
        return np.empty(0, np.uint8)
    fold = np.arange(256)
    fold[65:91] += 32
    last = fold[w.data[w.ends - 1]]
    before = np.where(w.ends - w.starts > 1, fold[w.data[np.maximum(w.ends - 2, 0)]], 0)
    return (W.mix((before * 256 + last).astype(np.uint64)) % np.uint64(CLASSES)).astype(np.uint8)


class _Chunk:
    """A chunk's documents and its different words, ascending by hash."""

    def __init__(self, docs: pa.Table):
        self.docs = C.in_order(docs)
        self.words = W.split(self.docs.column("text"))
        self.unique, first, self.group = np.unique(self.words.hashes(fold=True), return_index=True, return_inverse=True)
        self.classes = classes(self.words)[first]
        self.held_out = held_out(self.docs.column("doc"))

    def questions(self, bits: int) -> Iterator[tuple[int, int, bytes, bytes]]:
        train = ~self.held_out[self.words.owner()]
        counts = np.bincount(self.group[train], minlength=len(self.unique)).astype(np.int32)
        for bucket, part in C.by_bucket(self.unique, bits)[1]:
            yield (bucket, part.stop - part.start, self.unique[part].tobytes(),
                   self.classes[part].tobytes() + C.pack(counts[part]))


def _count(questions: pa.Table) -> pa.Table:
    """A bucket's answers (training count of each word) and, as chunk -1, its vocabulary by class and top words."""
    rows = questions.sort_by("chunk").to_pylist()
    words = np.concatenate([np.frombuffer(r["keys"], np.uint64) for r in rows])
    kinds = np.concatenate([np.frombuffer(r["payload"], np.uint8, r["n"]) for r in rows])
    counts = np.concatenate([C.unpack(r["payload"][r["n"]:], np.int32, r["n"]) for r in rows])
    unique, first, group = np.unique(words, return_index=True, return_inverse=True)
    total = np.bincount(group, counts, len(unique)).astype(np.int64)
    kind = kinds[first]
    known = total > 0
    top = np.lexsort((unique, -total))[:FREQUENT]
    top = top[total[top] > 0]
    summary = b"".join((
        np.bincount(kind, total, CLASSES).astype(np.int64).tobytes(), np.bincount(kind[known], minlength=CLASSES).astype(np.int64).tobytes(),
        unique[top].tobytes(), total[top].tobytes(), kind[top].tobytes()))
    bounds = np.cumsum([r["n"] for r in rows])[:-1]
    return pa.table({
        "chunk": pa.array([*(r["chunk"] for r in rows), -1], pa.int32()),
        "bucket": pa.array([r["bucket"] for r in rows] + [rows[0]["bucket"]], pa.int32()),
        "n": pa.array([*(r["n"] for r in rows), len(top)], pa.int32()),
        "answer": pa.array([*(C.pack(x) for x in np.split(total[group], bounds)), summary], pa.binary())})


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows from the buckets' summaries: classes (word null) and top words."""
    for batch in batches:
        for row in batch.to_pylist():
            n, data = row["n"], row["answer"]
            totals, types = (np.frombuffer(data, np.int64, CLASSES, 8 * CLASSES * i) for i in range(2))
            at = 16 * CLASSES
            words, counts = np.frombuffer(data, np.int64, n, at), np.frombuffer(data, np.int64, n, at + 8 * n)
            kinds = np.frombuffer(data, np.uint8, n, at + 16 * n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([None] * CLASSES + words.tolist(), pa.int64()), pa.array(np.concatenate([np.arange(CLASSES), kinds]).astype(np.int32)),
                 pa.array(np.concatenate([totals, counts])), pa.array(np.concatenate([types, np.ones(n, np.int64)]))],
                names=["word", "kind", "total", "types"])


_TOP = "word long, kind int, total long"


def _most_frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ``FREQUENT`` words with the largest totals of a partition."""
    best = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if best is None else pa.concat_tables([best, rows])
        best = rows.take(_ranked(rows)[:FREQUENT]).combine_chunks()
    if best is not None:
        yield from best.to_batches()


def _ranked(rows: pa.Table) -> np.ndarray:
    """Rows in the order of descending total, then word."""
    return np.lexsort((rows.column("word").to_numpy(), -rows.column("total").to_numpy()))


@dataclass
class Symbols:
    """The alphabet of the states: the end, the frequent words, the classes."""

    frequent: np.ndarray  # hashes, ascending
    weights: np.ndarray  # training counts of the symbols, smoothed
    class_mass: np.ndarray  # of each class: counts plus half a count for each word and an unknown one
    tokens: int  # N, of the training documents
    types: int  # V
    ends: int

    def of(self, hashes: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        out = len(self.frequent) + 1 + kinds.astype(np.int64)
        if len(self.frequent):
            at = np.minimum(np.searchsorted(self.frequent, hashes), len(self.frequent) - 1)
            out = np.where(self.frequent[at] == hashes, at + 1, out)
        return out.astype(np.uint16)


def _symbols(answered: DataFrame, ends: int) -> Symbols:
    rows = answered.where("chunk = -1").select("n", "answer").mapInArrow(_summaries, "word long, kind int, total long, types long")
    by_class = {r.kind: r for r in rows.where("word IS NULL").groupBy("kind").agg(F.sum("total").alias("total"), F.sum("types").alias("types")).collect()}
    best = rows.where("word IS NOT NULL").drop("types").mapInArrow(_most_frequent, _TOP)
    lists = answered.rdd.getNumPartitions()
    while lists > TOP_TOGETHER:  # a tree, so that no task reads more than a fixed number of lists
        lists = -(-lists // TOP_TOGETHER)
        best = best.repartition(lists).mapInArrow(_most_frequent, _TOP)
    top = best.orderBy(F.desc("total"), "word").limit(FREQUENT).collect()  # a fixed number of words
    totals, types = (np.array([getattr(by_class[k], f) if k in by_class else 0 for k in range(CLASSES)], np.int64) for f in ("total", "types"))
    tokens, vocabulary = int(totals.sum()) + ends, int(types.sum()) + (ends > 0)
    for r in top:
        totals[r.kind] -= r.total
        types[r.kind] -= 1
    words = np.array([r.word for r in top], np.int64).view(np.uint64)
    order = np.argsort(words)
    counts = np.array([r.total for r in top], np.float64)[order]
    mass = totals + 0.5 * (types + 1)
    return Symbols(words[order], np.concatenate([[ends + 0.5], counts, mass]), mass, tokens, vocabulary, ends)


ENCODED = "doc long, held_out boolean, n_tokens long, n_known long, base_score double, within double, symbols binary"


def encode(docs: DataFrame, doc_id: str, text: str, folder: str) -> tuple[DataFrame, Symbols]:
    """Every document as symbols, with all that depends on the counts of its words; written to ``folder``."""
    spark = docs.sparkSession
    total = C.text_bytes(docs, text)
    bits = C.bucket_bits(total)
    dealt = C.deal(docs, total, doc_id, text)
    asked = C.ask(dealt, lambda rows: _Chunk(rows).questions(bits))
    asked.groupBy("bucket").applyInArrow(_count, C.ANSWERED).write.parquet(f"{folder}/counts")
    answered = spark.read.parquet(f"{folder}/counts")
    fold = F.crc32(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).cast("binary")) % FOLDS
    ends = docs.where(fold != HELD_OUT).count()
    symbols = _symbols(answered, ends)
    scale = math.log10(symbols.tokens + 0.5 * (symbols.types + 1))

    def apply(rows: pa.Table, answers: list[dict]) -> pa.Table:
        chunk = _Chunk(rows)
        w = chunk.words
        c = np.concatenate([np.empty(0, np.int64), *(C.unpack(a["answer"], np.int64, a["n"]) for a in answers)])
        symbol = symbols.of(chunk.unique, chunk.classes)
        classed = symbol > len(symbols.frequent)
        within = np.where(classed, np.log10((c + 0.5) / symbols.class_mass[chunk.classes]), 0.0)
        base = np.log10(c + 0.5) - scale
        sums = lambda x: _sums_by(x[chunk.group], w.first)
        of_words, ends_of = symbol[chunk.group], np.arange(1, len(rows) + 1) + w.first[1:] - 1
        tokens = np.full(len(of_words) + len(rows), END, np.uint16)
        is_word = np.ones(len(tokens), bool)
        is_word[ends_of] = False
        tokens[is_word] = of_words
        offsets = np.concatenate([[0], 2 * (ends_of + 1)]).astype(np.int64)
        packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(tokens)])
        return pa.table({
            "doc": chunk.docs.column("doc"), "held_out": pa.array(chunk.held_out), "n_tokens": w.counts.astype(np.int64) + 1,
            "n_known": sums((c > 0).astype(np.float64)).astype(np.int64) + (symbols.ends > 0),
            "base_score": sums(base) + math.log10(symbols.ends + 0.5) - scale, "within": sums(within),
            "symbols": packed.cast(pa.binary())})

    C.finish(dealt, answered.where("chunk >= 0"), apply, ENCODED).write.option("compression", "zstd").parquet(f"{folder}/encoded")
    return spark.read.parquet(f"{folder}/encoded"), symbols


def _sums_by(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the values of each text's words; none are zero."""
    out = np.zeros(len(first) - 1)
    some = first[1:] > first[:-1]
    if some.any():
        out[some] = np.add.reduceat(values, first[:-1][some])
    return out


@dataclass
class Model:
    start: np.ndarray  # S
    step: np.ndarray  # S x S
    emit: np.ndarray  # symbols x S


def first_model(weights: np.ndarray, states: int, seed: int) -> Model:
    """Sticky states whose emissions scatter around the corpus's own distribution."""
    random = np.random.Generator(np.random.PCG64(seed))
    emit = weights[:, None] * np.exp(random.normal(0, 1, (len(weights), states)))
    step = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(step, 0.9 if states > 1 else 1.0)
    return Model(np.full(states, 1 / states), step, emit / emit.sum(0))


def _transfers(tokens: np.ndarray, begin: np.ndarray, size: np.ndarray, model: Model) -> np.ndarray:
    """Of each segment (longest first): emission and step of every token multiplied, up to a factor."""
    states = len(model.start)
    out = np.broadcast_to(np.eye(states), (len(size), states, states)).copy()
    for t in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -t, "left"))
        part = (out[:n] * model.emit[tokens[begin[:n] + t]][:, None, :]).reshape(-1, states) @ model.step
        out[:n] = part.reshape(n, states, states)
        if t % RESCALED == RESCALED - 1:
            out[:n] /= out[:n].sum((1, 2), keepdims=True)
    return out / out.sum((1, 2), keepdims=True)


def _segments(tokens: np.ndarray, offsets: np.ndarray, model: Model) -> tuple[np.ndarray, ...]:
    """Begin, size, first and last of its text, and the rows that enter from before and behind, of every segment."""
    states, lengths = len(model.start), np.diff(offsets)
    pieces = -(-lengths // SEGMENT)
    text = np.repeat(np.arange(len(lengths)), pieces)
    turn = np.arange(len(text)) - np.repeat(W.sums(pieces)[:-1], pieces)
    begin = offsets[text] + turn * SEGMENT
    size = np.minimum(SEGMENT, offsets[text + 1] - begin)
    opening, closing = turn == 0, turn == pieces[text] - 1
    before = np.broadcast_to(model.start, (len(text), states)).copy()
    behind = np.ones((len(text), states))
    many = np.flatnonzero(pieces[text] > 1)
    if len(many):
        order = many[np.argsort(-size[many], kind="stable")]
        product = np.empty((len(text), states, states))
        product[order] = _transfers(tokens, begin[order], size[order], model)
        by_turn = many[np.argsort(turn[many], kind="stable")]
        ends = np.cumsum(np.bincount(turn[many]))
        turns = [by_turn[a:b] for a, b in zip([0, *ends[:-1]], ends)]
        for at in turns[1:]:
            row = (before[at - 1][:, None, :] @ product[at - 1])[:, 0]
            before[at] = row / row.sum(1, keepdims=True)
        for at in turns[:0:-1]:  # what comes behind a segment is its successor's product with what is behind that
            row = (product[at] @ behind[at][:, :, None])[:, :, 0]
            behind[at - 1] = row / row.sum(1, keepdims=True)
    return begin, size, opening, closing, before, behind


def expected_counts(tokens: np.ndarray, offsets: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, steps and emissions of the texts' tokens."""
    states = len(model.start)
    total = np.zeros(states), np.zeros((states, states)), np.zeros_like(model.emit)
    found = _segments(tokens, offsets, model)
    together = W.sums(found[1])
    i = 0
    while i < len(found[0]):  # segments of a bounded number of tokens
        j = max(i + 1, int(np.searchsorted(together, together[i] + BATCH_TOKENS, "right")) - 1)
        order = i + np.argsort(-found[1][i:j], kind="stable")
        for have, more in zip(total, _segment_counts(tokens, model, *(x[order] for x in found))):
            have += more
        i = j
    return total


def _segment_counts(tokens: np.ndarray, model: Model, begin: np.ndarray, size: np.ndarray, opening: np.ndarray, closing: np.ndarray,
                    before: np.ndarray, behind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected counts of segments, longest first, with the steps that lead out of them."""
    states, longest = len(model.start), int(size[0])
    running = [int(np.searchsorted(-size, -t, "left")) for t in range(longest + 1)]  # segments longer than t
    forward, seen = [], []
    for t in range(longest):
        n = running[t]
        alpha = before if t == 0 else forward[-1][:n] @ model.step
        e = model.emit[tokens[begin[:n] + t]]
        alpha = alpha * e
        alpha /= alpha.sum(1, keepdims=True)
        forward.append(alpha)
        seen.append(e)
    starts, steps = np.zeros(states), np.zeros((states, states))
    gammas, symbols = [], []
    beta = np.empty((0, states))
    for t in range(longest - 1, -1, -1):
        n, later = running[t], running[t + 1]
        ahead = behind[:n]
        if later:
            ahead = ahead.copy()
            ahead[:later] = seen[t + 1] * beta
        full = ahead @ model.step.T
        gamma = forward[t] * full
        both = gamma.sum(1, keepdims=True)
        weight = forward[t] / both
        if later < n:
            weight[later:][closing[later:n]] = 0  # nothing follows the end of a text
        steps += weight.T @ ahead * model.step
        gamma /= both
        gammas.append(gamma)
        symbols.append(tokens[begin[:n] + t])
        beta = full / full.sum(1, keepdims=True)
        if t == 0:
            starts = gamma[opening].sum(0)
    emitted = np.zeros_like(model.emit)
    gamma, symbol = np.concatenate(gammas), np.concatenate(symbols)
    for s in range(states):
        emitted[:, s] = np.bincount(symbol, gamma[:, s], len(emitted))
    return starts, steps, emitted


def _texts(batch: pa.RecordBatch, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, slice]]:
    """Tokens and offsets of consecutive rows with about ``most`` tokens at a time."""
    data, offsets = W.buffers(batch.column("symbols"))
    tokens, offsets = np.frombuffer(data.tobytes(), np.uint16), offsets // 2
    i = 0
    while i < len(offsets) - 1:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield tokens[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], slice(i, j)
        i = j


def train(encoded: DataFrame, weights: np.ndarray, states: int = STATES, iterations: int = ITERATIONS, seed: int = 1) -> Model:
    """Baum-Welch over every document of ``encoded`` that is not held out."""
    model = first_model(weights, states, seed)
    names = [f"s{s}" for s in range(states)]
    texts = encoded.where("NOT held_out").select("symbols")
    for _ in range(iterations):
        def expect(batches: Iterator[pa.RecordBatch], model: Model = model) -> Iterator[pa.RecordBatch]:
            total = [np.zeros(states), np.zeros((states, states)), np.zeros_like(model.emit)]
            for batch in batches:
                for tokens, offsets, _ in _texts(batch, BATCH_TOKENS):
                    for have, more in zip(total, expected_counts(tokens, offsets, model)):
                        have += more
            table = np.vstack([total[0][None], total[1], total[2]])
            some = np.flatnonzero(table.any(1))
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *(pa.array(table[some, s]) for s in range(states))],
                                             names=["row", *names])

        summed = (texts.mapInArrow(expect, ", ".join(["row int", *(f"{n} double" for n in names)]))
                  .groupBy("row").agg(*(F.sum(n).alias(n) for n in names)).collect())  # as many rows as the model has
        table = np.zeros((1 + states + len(weights), states))
        for r in sorted(summed):
            table[r[0]] = r[1:]
        starts, steps, emit = table[0] + 1, table[1:1 + states] + 1, table[1 + states:]
        emit = emit + PRIOR * (weights / weights.sum())[:, None]
        model = Model(starts / starts.sum(), steps / steps.sum(1, keepdims=True), emit / emit.sum(0))
    return model


def log10_likelihood(tokens: np.ndarray, offsets: np.ndarray, model: Model) -> np.ndarray:
    """Exact log10 probability of every text's tokens: the scaled forward recursion."""
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    begin, size = offsets[:-1][order], lengths[order]
    out = np.zeros(len(size))
    alpha = np.tile(model.start, (len(size), 1))
    for t in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -t, "left"))
        alpha = (alpha[:n] if t == 0 else alpha[:n] @ model.step) * model.emit[tokens[begin[:n] + t]]
        scale = alpha.sum(1)
        alpha /= scale[:, None]
        out[:n] += np.log10(scale)
    back = np.empty(len(order))
    back[order] = out
    return back


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", states: int = STATES, iterations: int = ITERATIONS, seed: int = 1) -> DataFrame:
    """Train on the training fold and score every document.

    ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``
    (smoothed word frequencies) and ``score`` (the model), both log10 probabilities.
    """
    folder = scratch_folder(docs.sparkSession)
    encoded, symbols = encode(docs, doc_id, text, folder)
    model = train(encoded, symbols.weights, states, iterations, seed)

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tokens, offsets, rows in _texts(batch, 10 * BATCH_TOKENS):
                part = batch.slice(rows.start, rows.stop - rows.start)
                total = log10_likelihood(tokens, offsets, model) + part.column("within").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("doc", "held_out", "n_tokens", "n_known", "base_score")), pa.array(total)],
                    names=["doc", "held_out", "n_tokens", "n_known", "base_score", "score"])

    scored = encoded.mapInArrow(forward, "doc long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select(F.col("doc").alias(doc_id), "held_out", "n_tokens", "n_known",
                         F.lit(symbols.tokens).cast("long").alias("train_tokens"), "base_score", "score")
