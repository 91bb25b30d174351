"""Documents whose sets of word n-grams have a Jaccard similarity of at least a threshold.

The join is exact.  Two steps cut it into searches of bounded size:

1. *Where to search.*  Sets of about the same size are split by hash into a few more
   parts than two linked sets can have different elements, so linked sets agree in at
   least one whole part that is not empty.  Documents that share such a part gather
   around the smallest id among them.  A part is a conjunction of several n-grams: a
   line that many documents share brings few of them together.
2. *T-occurrence search* (DivideSkip) in each gathering: inverted lists over its
   documents; for a query, the short lists are merged and counted, the long ones are
   probed by binary search for the few documents still able to reach the overlap.

Large gatherings are cut into blocks and searched by pairs of blocks, so that no search
holds more than two.

Defined results: words are folded from A-Z to a-z; with fewer words than ``size`` the
whole sequence is the only n-gram; a text without words (or null) has an empty set and
is linked with nothing; rows with equal ids are one document; a row with a null id is
linked with nothing and has a null component; an empty table gives an empty result;
other columns, whatever their names, play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import chunks as C
from tidemark.llm import words as W
from tidemark.llm.components import components
from tidemark.session import scratch_folder

SIZE = 5  # words
PERCENT = 80  # similarity
BAND = 1.5  # largest set by smallest of a band
BLOCK = 400_000  # n-grams in the inverted lists of one search
BATCH = 400_000  # n-grams of the searches that a task call makes


def sets_of(w: W.Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Different n-grams of every text, ascending: hashes, and offsets by text."""
    hashes = w.hashes(fold=True)
    counts = w.counts
    at = w.windows(size)
    grams = [W.window_hashes(hashes, size)[at]]
    rows = [np.searchsorted(w.first, at, "right") - 1]
    for short in range(1, size):
        few = np.flatnonzero(counts == short)
        first = w.first[few]
        whole = np.full(len(few), short, np.uint64)
        for i in range(short):
            whole = W.mix(whole + hashes[first + i])
        grams.append(whole)
        rows.append(few)
    gram, row = np.concatenate(grams), np.concatenate(rows)
    order = np.lexsort((gram, row))
    gram, row = gram[order], row[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (row[1:] != row[:-1])
    return gram[new], np.searchsorted(row[new], np.arange(len(counts) + 1))


@cache
def bands(percent: int, below: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By band: smallest set size, most differences of a linked pair, number of parts.

    A pair belongs to the band of its smaller set.  Sets of m and n elements that are
    linked differ in at most (m + n)(100 - p)/(100 + p).
    """
    low, differ, parts = [], [], []
    at = 1
    while at < below:
        top = max(at, math.ceil(at * BAND) - 1)
        most = (top + top * 100 // percent) * (100 - percent) // (100 + percent)
        k = most + 1
        while k < at and k * (1 - math.exp(-at / k)) < 1.05 * (most + 1) + 1:
            k += 1 + k // 50  # so many that, most likely, more than `most` are not empty
        low.append(at)
        differ.append(most)
        parts.append(k)
        at = top + 1
    return np.array(low), np.array(differ), np.array(parts)


def part_hashes(gram: np.ndarray, offsets: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every part under which linked texts must meet."""
    sizes = np.diff(offsets)
    if not len(gram):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    low, differ, parts = bands(percent, 1 << int(sizes.max()).bit_length())
    own = np.searchsorted(low, sizes, "right") - 1
    least = np.searchsorted(low, -(-sizes * percent // 100), "right") - 1  # band of the smallest partner
    place, weight = W.mix(gram ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(32), W.mix(gram + np.uint64(0x5851F42D4C957F2D))
    owner = np.repeat(np.arange(len(sizes)), sizes)
    found, of = [], []
    step = 0
    while True:
        rows = np.flatnonzero((sizes > 0) & (own - step >= least))
        if not len(rows):
            return np.concatenate(found), np.concatenate(of)
        band = own[rows] - step
        k = parts[band]
        begin = np.zeros(len(sizes), np.int64)
        begin[rows] = W.sums(k)[:-1]
        member = np.zeros(len(sizes), bool)
        member[rows] = True
        chosen = member[owner]
        o = owner[chosen]
        many = np.zeros(len(sizes), np.uint64)
        many[rows] = k.astype(np.uint64)
        slot = begin[o] + ((place[chosen] * many[o]) >> np.uint64(32)).astype(np.int64)
        total = np.zeros(int(k.sum()), np.uint64)
        np.add.at(total, slot, weight[chosen])
        filled = np.bincount(slot, minlength=len(total)) > 0
        row = np.repeat(np.arange(len(rows)), k)
        enough = np.bincount(row[filled], minlength=len(rows)) > differ[band]
        use = filled | ~enough[row]  # too few filled parts: the empty ones count as well
        number = (np.arange(len(total)) - begin[rows][row]).astype(np.uint64)
        name = W.mix(number * np.uint64(0x9E3779B97F4A7C15) + band[row].astype(np.uint64) + np.uint64(1))
        found.append(W.mix(total ^ name)[use])
        of.append(rows[row[use]])
        step += 1


class _Chunk:
    def __init__(self, docs: pa.Table, size: int, percent: int):
        self.docs = C.in_order(docs)
        words = W.split(self.docs.column("text"))
        self.gram, self.offsets = sets_of(words, size)
        parts, row = part_hashes(self.gram, self.offsets, percent)
        named = np.asarray(self.docs.column("doc").is_valid())[row]
        self.parts, self.row = parts[named], row[named]
        self.unique, self.group, times = np.unique(self.parts, return_inverse=True, return_counts=True)
        self.local = times > 1

    def questions(self, bits: int) -> Iterator[tuple[int, int, bytes, bytes]]:
        _, buckets = C.by_bucket(self.unique, bits)  # ascending, so each bucket lies together
        for bucket, part in buckets:
            yield bucket, part.stop - part.start, self.unique[part].tobytes(), np.packbits(self.local[part]).tobytes()

    def gathered(self, answers: list[dict]) -> tuple[np.ndarray, np.ndarray]:
        """The parts that another document has as well, by text: hashes and offsets."""
        marks = [np.unpackbits(np.frombuffer(a["answer"], np.uint8), count=a["n"]) for a in answers]
        shared = np.concatenate(marks).astype(bool)[self.group] if marks else np.zeros(len(self.parts), bool)
        row = self.row[shared]
        order = np.argsort(row, kind="stable")
        return self.parts[shared][order], np.searchsorted(row[order], np.arange(len(self.docs) + 1))

    def keys(self) -> list[bytes | None]:
        """128 bits that name a set."""
        halves = [W.sums(W.mix(self.gram * np.uint64(2 * i + 3) + np.uint64(i))) for i in range(2)]
        a, b = (W.mix((h[self.offsets[1:]] - h[self.offsets[:-1]]) + np.diff(self.offsets).astype(np.uint64)) for h in halves)
        both = np.stack([a, b], 1).tobytes()
        return [both[16 * i:16 * i + 16] if n else None for i, n in enumerate(np.diff(self.offsets))]


def _respond(rows: list[dict]) -> list[bytes]:
    """Which of a bucket's hashes do two documents have?"""
    hashes = np.concatenate([np.frombuffer(r["keys"], np.uint64) for r in rows])
    local = np.concatenate([np.unpackbits(np.frombuffer(r["payload"], np.uint8), count=r["n"]) for r in rows])
    _, group, times = np.unique(hashes, return_inverse=True, return_counts=True)
    bounds = np.cumsum([r["n"] for r in rows])[:-1]
    return [np.packbits(x).tobytes() for x in np.split((times > 1)[group] | (local > 0), bounds)]


def _profile(docs: DataFrame, size: int, percent: int, doc_id: str, text: str) -> DataFrame:
    """By document: set size, key of the set, shared parts, and the text of those that share any."""
    total = C.text_bytes(docs, text)
    bits = C.bucket_bits(total)
    dealt = C.deal(docs, total, doc_id, text)
    answered = C.answer(C.ask(dealt, lambda rows: _Chunk(rows, size, percent).questions(bits)), _respond)

    def apply(rows: pa.Table, answers: list[dict]) -> pa.Table:
        chunk = _Chunk(rows, size, percent)
        parts, offsets = chunk.gathered(answers)
        texts = [None if offsets[i] == offsets[i + 1] else _squeeze(t.as_buffer())
                 for i, t in enumerate(chunk.docs.column("text").cast(pa.binary()))]
        return pa.table({
            "doc": chunk.docs.column("doc"), "n": pa.array(np.diff(chunk.offsets).astype(np.int64)),
            "key": pa.array(chunk.keys(), pa.binary()),
            "parts": pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(parts.view(np.int64))),
            "squeezed": pa.array(texts, pa.binary())})

    return C.finish(dealt, answered, apply, "doc long, n long, key binary, parts array<long>, squeezed binary")


def _squeeze(text: pa.Buffer) -> bytes:
    return len(text).to_bytes(4, "little") + pa.compress(text, codec="zstd", asbytes=True)


def _unsqueeze(data: bytes) -> bytes:
    return pa.decompress(data[4:], int.from_bytes(data[:4], "little"), codec="zstd", asbytes=True)


def divide_skip(tokens: np.ndarray, starts: np.ndarray, postings: np.ndarray, n_docs: int, need: int,
                plausible: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Documents on at least ``need`` of a query's inverted lists, and on how many.

    ``tokens`` names the query's lists.  List i is ``postings[starts[i]:starts[i + 1]]``;
    an entry is ``i * n_docs`` plus the document, so all lists together ascend and a
    probe of any of them is one binary search.  The longest lists are only probed: with
    L of them set aside, a document must be on ``need - L`` of the short ones.
    ``plausible`` marks the documents that may be found at all.
    """
    lengths = starts[tokens + 1] - starts[tokens]
    order = np.argsort(-lengths, kind="stable")
    tokens, lengths = tokens[order], lengths[order]
    longest = int(lengths[0]) if len(lengths) else 0
    long = max(0, min(need - 1, int(need / (0.0085 * math.log2(max(longest, 1)) + 1))))
    short, sizes = tokens[long:], lengths[long:]
    at = np.arange(int(sizes.sum())) + np.repeat(starts[short] - W.sums(sizes)[:-1], sizes)
    merged = postings[at] - np.repeat(short, sizes) * n_docs
    if plausible is not None:
        merged = merged[plausible[merged]]
    merged = np.sort(merged, kind="stable")  # a merge of ascending runs
    if not len(merged):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    first = np.flatnonzero(np.append(True, merged[1:] != merged[:-1]))
    found, count = merged[first], np.diff(np.append(first, len(merged)))
    alive = count >= need - long
    found, count = found[alive], count[alive]
    step, high = 16, long
    while high and len(found):  # from the shortest of the long lists, ever more at a time
        low = max(0, high - step)
        probes = (tokens[low:high, None] * n_docs + found).ravel()
        place = np.minimum(np.searchsorted(postings, probes), len(postings) - 1)
        count = count + (postings[place] == probes).reshape(high - low, -1).sum(0)
        alive = count >= need - low  # as many lists are still to come
        found, count = found[alive], count[alive]
        step, high = 4 * step if len(found) < 64 else step, low
    return found, count


def _search(nodes: np.ndarray, indexed: np.ndarray, gram: np.ndarray, offsets: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that join the documents of one search; those that join nothing new are left out.

    Where some are not indexed, these query the indexed ones, else all query all.
    """
    sizes = np.diff(offsets)
    _, token = np.unique(gram, return_inverse=True)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    listed = indexed[owner]
    postings = np.sort(token[listed] * len(sizes) + owner[listed])  # by token, then by document
    starts = np.searchsorted(postings, np.arange(int(token.max()) + 2) * len(sizes))
    root = list(range(len(sizes)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links = []
    for q in np.flatnonzero(~indexed) if not indexed.all() else range(len(sizes)):
        n = int(sizes[q])
        plausible = (100 * sizes >= percent * n) & (100 * n >= percent * sizes)
        plausible[q] = False
        found, overlap = divide_skip(token[offsets[q]:offsets[q + 1]], starts, postings, len(sizes), -(-n * percent // 100), plausible)
        near = 100 * overlap >= percent * (n + sizes[found] - overlap)
        for other in found[near].tolist():
            a, b = find(q), find(other)
            if a != b:
                root[a] = b
                links.append((int(nodes[q]), int(nodes[other])))
    return links


def _links(members: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Verified links ``a``, ``b`` from gatherings (``center``, ``node``, ``n``)."""
    blocks = members.groupBy("center").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("blocks"))
    weight = members.join(blocks, "center").agg(F.sum(F.col("n") * F.col("blocks"))).first()[0] or 0
    batches = max(1, math.ceil(weight / BATCH))
    searches = (members.join(blocks, "center")
                .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
                .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                .withColumns({"block": F.least("own", "other"), "against": F.greatest("own", "other")})
                .select("center", "block", "against", "node", (F.col("own") == F.col("block")).alias("indexed"),
                        F.pmod(F.xxhash64("center", "block", "against"), F.lit(batches)).cast("int").alias("batch")))

    def of_batch(rows: pa.Table) -> pa.Table:
        search = ("center", "block", "against")
        rows = rows.sort_by([(c, "ascending") for c in (*search, "node", "squeezed")])
        named = [rows.column(c).to_numpy() for c in search]
        node, indexed = (rows.column(c).to_numpy() for c in ("node", "indexed"))
        first = np.flatnonzero(np.append(True, np.any([c[1:] != c[:-1] for c in named], axis=0)))
        known: dict[bytes, int] = {}
        which = np.array([known.setdefault(s, len(known)) for s in rows.column("squeezed").to_pylist()])
        gram, offsets = sets_of(W.split(pa.array(map(_unsqueeze, known), pa.binary())), size)
        links: set[tuple[int, int]] = set()
        for low, high in zip(first, [*first[1:], len(node)]):
            texts_here = which[low:high]
            length = offsets[texts_here + 1] - offsets[texts_here]
            bounds = W.sums(length)
            at = np.arange(bounds[-1]) + np.repeat(offsets[texts_here] - bounds[:-1], length)
            links.update(_search(node[low:high], indexed[low:high].astype(bool), gram[at], bounds, percent))
        return pa.table({"a": pa.array([x[0] for x in links], pa.int64()), "b": pa.array([x[1] for x in links], pa.int64())})

    return searches.join(texts, "node").groupBy("batch").applyInArrow(of_batch, "a long, b long")


def _several(profile: DataFrame) -> DataFrame:
    """The rows of ids that have several different sets."""
    name = F.xxhash64("key")
    ids = (profile.where("doc IS NOT NULL AND key IS NOT NULL").groupBy("doc").agg(F.min(name).alias("_low"), F.max(name).alias("_high"))
           .where("_low < _high").select("doc"))
    return profile.where("key IS NOT NULL").select("doc", "key", "n", "parts").join(ids, "doc")


def _same_id(several: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` from the node of each set that an id has to the smallest of them."""
    of = several.select("doc", "key").distinct().join(nodes.select("key", "node"), "key").select("doc", "node")
    least = of.groupBy("doc").agg(F.min("node").alias("b"))
    return of.join(least, "doc").where("node > b").select(F.col("node").alias("a"), "b").distinct()


def near_duplicates(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row of ``docs``.

    ``component_id`` is the smallest id that links lead to, itself included.
    """
    spark, folder = docs.sparkSession, scratch_folder(docs.sparkSession)
    _profile(docs, size, percent, doc_id, text).write.option("compression", "zstd").parquet(f"{folder}/profile")
    profile = spark.read.parquet(f"{folder}/profile")
    sharing = profile.where("size(parts) > 0")
    # one node for each different set: its smallest id
    several = _several(profile)
    several.write.parquet(f"{folder}/several")
    several = spark.read.parquet(f"{folder}/several")
    known = sharing.select("key", "doc", "n", "parts").unionByName(several.where("size(parts) = 0").select("key", "doc", "n", "parts"))
    nodes = known.groupBy("key").agg(F.min("doc").alias("node"), F.first("n").alias("n"), F.first("parts").alias("parts"))
    nodes.write.parquet(f"{folder}/nodes")
    nodes = spark.read.parquet(f"{folder}/nodes")
    parts = nodes.select("node", "n", F.explode("parts").alias("part"))
    centers = parts.groupBy("part").agg(F.min("node").alias("center"), F.max("node").alias("last")).where("center < last")
    members = parts.join(centers, "part").groupBy("center", "node").agg(F.max("n").alias("n"))
    members.write.parquet(f"{folder}/members")
    members = spark.read.parquet(f"{folder}/members")
    texts = (sharing.select("key", F.col("doc").alias("node"), "squeezed")
             .join(nodes.select("key", "node"), ["key", "node"]).select("node", "squeezed"))
    _links(members, texts, size, percent).unionByName(_same_id(several, nodes)).write.parquet(f"{folder}/links")
    labels = components(spark.read.parquet(f"{folder}/links"), f"{folder}/components")
    named = nodes.select("key", "node").join(labels, "node", "left").select("key", F.coalesce("label", "node").alias("label"))
    # rows with one id are one document, also where their texts differ
    found = profile.select("doc", "n", "key").join(named, "key", "left").withColumn("label", F.least("label", "doc"))
    return found.select(F.col("doc").alias(doc_id), F.col("n").alias("n_shingles"),
                        F.when(F.col("doc").isNotNull(), F.col("label")).alias("component_id"))


def keep_one(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """The documents without those that a smaller id of their component stands for; same columns."""
    found = near_duplicates(docs.select("doc_id", "text"), size, percent)
    extra = found.where("component_id < doc_id").select("doc_id").distinct()
    return docs.join(extra, "doc_id", "left_anti").select(*docs.columns)
