"""SentencePiece-style encoding: the best segmentation of a text into scored pieces.

The pieces of a model file stand in a double-array trie over bytes, in which one byte,
the space, stands for the white-space marker.  A Viterbi pass finds the segmentation
with the largest sum of log scores; characters that no piece covers become byte pieces.
No piece has a marker after another character (checked on loading), so a text falls into
units that begin with spaces, and each different unit is segmented once, many units side
by side.  Where few units have a length, as in text without spaces, the trie is walked from
all positions of a unit side by side instead, and one pass over its positions follows.

The scores are the file's own if it holds a unigram model.  A merge-ranked file holds
ranks instead; they become log probabilities by Zipf's law, p proportional to
1 / (rank + 1).

Decoding joins the pieces, turns markers into spaces and byte pieces into bytes and drops
the one marker put before the text, so it returns every text exactly.  A marker character
in the text itself is encoded in bytes and comes back as it was.

Defined results: a null or empty text has no ids and decodes to an empty text; equal
scores prefer the longer last piece; bytes that are no UTF-8 after decoding become U+FFFD;
repeated rows are encoded each; an empty table gives an empty result; other columns pass
through by ``carry``; ``tokenized`` replaces those that have the names of its three results.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W

MARKER = "▁"
CELLS = 1 << 20  # positions worked on side by side
FEW = 64  # fewer units than these are segmented one after another
WINDOW = 1 << 18  # positions of a unit whose matches are held at once
DECODED_TOGETHER = 1 << 19  # ids
UNKNOWN_PENALTY = 10.0


@dataclass
class Vocabulary:
    """Pieces by id, with log scores, as a double-array trie."""

    scores: np.ndarray
    base: np.ndarray
    check: np.ndarray
    value: np.ndarray  # id of the piece that ends at a trie node, or -1
    byte_ids: np.ndarray  # id of every byte's piece; empty without byte pieces
    unknown: int
    spelled: np.ndarray  # bytes of all pieces one after another
    bounds: np.ndarray


def double_array(keys: list[bytes], values: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base, check and value: the child of node s by byte c is ``base[s] + c + 1`` if its check is s."""
    order = sorted(range(len(keys)), key=lambda i: keys[i])
    keys, values = [keys[i] for i in order], [values[i] for i in order]
    size = 8 * sum(map(len, keys)) + 1024
    base, check, value = [0] * size, [-1] * size, [-1] * size
    check[0] = 0
    free = probe = 257  # nothing is free from here to the first, little to the second
    todo = [(0, 0, len(keys), 0)]
    last = 0
    while todo:
        node, low, high, depth = todo.pop()
        if low < high and len(keys[low]) == depth:
            value[node] = values[low]
            low += 1
        children = []
        while low < high:
            byte, begin = keys[low][depth], low
            while low < high and keys[low][depth] == byte:
                low += 1
            children.append((byte + 1, begin, low))
        if not children:
            continue
        while check[free] >= 0:
            free += 1
        at = begun = free if len(children) == 1 else max(free, probe)
        while True:
            if check[at] < 0:
                b = at - children[0][0]
                if all(check[b + c] < 0 for c, _, _ in children):
                    break
            at += 1
        if len(children) > 1 and at - begun > 32:
            probe = at
        base[node] = b
        for c, begin, end in children:
            check[b + c] = node
            last = max(last, b + c)
            todo.append((b + c, begin, end, depth + 1))
    end = last + 258
    return np.array(base[:end], np.int32), np.array(check[:end], np.int32), np.array(value[:end], np.int32)


def load(model_path: str) -> Vocabulary:
    """The vocabulary of a SentencePiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    n = model.get_piece_size()
    pieces, scores = [model.id_to_piece(i) for i in range(n)], np.array([model.get_score(i) for i in range(n)], np.float64)
    plain = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    for i in plain:
        if MARKER in pieces[i].lstrip(MARKER) or " " in pieces[i]:
            raise ValueError(f"piece {i} has a white-space marker after another character")
    if (scores[plain] == np.round(scores[plain])).all():  # ranks of merges, no logarithms
        rank = np.empty(len(plain))
        rank[np.argsort(-scores[plain], kind="stable")] = np.arange(len(plain))
        scores[plain] = -np.log(rank + 1) - np.log((1 / (1 + np.arange(len(plain)))).sum())
    spelled = [p.replace(MARKER, " ").encode() for p in pieces]
    byte_ids = np.full(256, -1, np.int64)
    for i in range(n):
        if model.is_byte(i):
            byte_ids[int(pieces[i][3:5], 16)] = i
            spelled[i] = bytes([int(pieces[i][3:5], 16)])
        elif model.is_control(i):
            spelled[i] = b""
        elif model.is_unknown(i):
            spelled[i] = "⁇".encode()
    base, check, value = double_array([spelled[i] for i in plain], plain)
    scores[model.unk_id()] = scores[plain].min() - UNKNOWN_PENALTY
    return Vocabulary(scores, base, check, value, byte_ids if (byte_ids >= 0).all() else byte_ids[:0], model.unk_id(),
                      np.frombuffer(b"".join(spelled), np.uint8), W.sums(np.array([len(s) for s in spelled])))


_CHARACTER = np.ones(256, np.int64)  # bytes of a character by its first byte
_CHARACTER[0xC0:0xE0], _CHARACTER[0xE0:0xF0], _CHARACTER[0xF0:] = 2, 3, 4


def segment(v: Vocabulary, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all units one after another, and their offsets."""
    lengths = ends - starts
    order = np.argsort(lengths, kind="stable")
    counts, found = np.zeros(len(starts), np.int64), []
    i = 0
    while i < len(order):
        j = i + 1
        while j < len(order) and (j - i + 1) * int(lengths[order[j]]) <= CELLS and lengths[order[j]] <= lengths[order[i]] + 2 + lengths[order[i]] // 8:
            j = min(len(order), j + max(1, (j - i) // 8))
        while j > i + 1 and (j - i) * int(lengths[order[j - 1]]) > 2 * CELLS:
            j -= 1
        units = order[i:j]
        if len(units) < FEW:
            each = [_one_unit(v, data[starts[u]:ends[u]]) for u in units]
            ids, n = np.concatenate(each), np.array([len(x) for x in each])
        else:
            ids, n = _viterbi(v, data, starts[units], lengths[units])
        counts[units] = n
        found.append((units, ids))
        i = j
    offsets = W.sums(counts)
    out = np.empty(int(offsets[-1]), np.uint32)
    for units, ids in found:
        n = counts[units]
        out[np.arange(len(ids)) + np.repeat(offsets[units] - W.sums(n)[:-1], n)] = ids
    return out, offsets


def _viterbi(v: Vocabulary, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of units of similar length, and how many each has."""
    n, longest = len(starts), int(lengths.max())
    column = np.arange(longest)
    grid = np.where(column < lengths[:, None], data[np.minimum(starts[:, None] + column, len(data) - 1)], 0).astype(np.int64)
    best = np.full((n, longest + 1), -np.inf)
    best[:, 0] = 0
    back = np.zeros((n, longest + 1), np.int32)
    piece = np.full((n, longest + 1), -1, np.int32)
    for i in range(longest):
        rows = np.flatnonzero((best[:, i] > -np.inf) & (lengths > i))
        if not len(rows):
            continue
        character = _CHARACTER[grid[rows, i]]
        covered = np.zeros(len(rows), bool)
        here = best[rows, i]
        live, node = np.arange(len(rows)), np.zeros(len(rows), np.int64)
        for j in range(i, longest):
            step = v.base[node] + grid[rows[live], j] + 1
            ok = (v.check[step] == node) & (lengths[rows[live]] > j) & (step > 0)
            live, node = live[ok], step[ok].astype(np.int64)
            if not len(live):
                break
            ends = v.value[node]
            hit = ends >= 0
            if hit.any():
                which, ids = live[hit], ends[hit]
                covered[which[character[which] == j - i + 1]] = True
                total = here[which] + v.scores[ids]
                better = total > best[rows[which], j + 1]
                r = rows[which[better]]
                best[r, j + 1], back[r, j + 1], piece[r, j + 1] = total[better], i, ids[better]
        lone = np.flatnonzero(~covered)
        if len(lone):
            r = rows[lone]
            to = np.minimum(i + character[lone], lengths[r])
            total = here[lone] + v.scores[v.unknown]
            better = total > best[r, to]
            r, to = r[better], to[better]
            best[r, to] = total[better]
            if len(v.byte_ids):  # one byte after another
                for k in range(1, 5):
                    some = r[i + k <= to]
                    if len(some):
                        back[some, i + k], piece[some, i + k] = i + k - 1, -1
            else:
                back[r, to], piece[r, to] = i, v.unknown
    taken, at = [], lengths.astype(np.int64)
    rows = np.arange(n)
    while len(rows):
        ids = piece[rows, at]
        if len(v.byte_ids):
            ids = np.where(ids < 0, v.byte_ids[grid[rows, at - 1]], ids)
        taken.append((rows, ids))
        at = back[rows, at]
        rows, at = rows[at > 0], at[at > 0]
    counts = np.zeros(n, np.int64)
    for r, _ in taken:
        counts[r] += 1
    offsets = W.sums(counts)
    out = np.empty(int(offsets[-1]), np.uint32)
    for k, (r, ids) in enumerate(taken):  # from the last piece to the first
        out[offsets[r + 1] - 1 - k] = ids
    return out, counts


def _matches(v: Vocabulary, data: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start (from ``low``), length and id of every piece that begins in a window, by start and length."""
    live, node, depth = np.arange(low, high), np.zeros(high - low, np.int64), 0
    found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32))]
    while len(live):
        step = v.base[node] + data[live + depth].astype(np.int64) + 1
        ok = (v.check[step] == node) & (step > 0)
        live, node, depth = live[ok], step[ok], depth + 1
        hit = v.value[node] >= 0
        found.append((live[hit] - low, np.full(int(hit.sum()), depth), v.value[node[hit]]))
        more = live + depth < len(data)
        live, node = live[more], node[more]
    at, size, ids = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(at, kind="stable")
    return at[order], size[order], ids[order]


def _one_unit(v: Vocabulary, data: np.ndarray) -> np.ndarray:
    """Ids of one unit, as ``_viterbi`` finds them."""
    n, widest = len(data), max(4, int(np.diff(v.bounds).max()))
    back, piece = array("i", bytes(4 * (n + 1))), array("i", bytes(4 * (n + 1)))
    unknown, nothing = float(v.scores[v.unknown]), -math.inf
    best = [0.0] + [nothing] * widest
    for low in range(0, n, WINDOW):
        high = min(n, low + WINDOW)
        best += [nothing] * (high - low)
        at, size, ids = _matches(v, data, low, high)
        first = np.searchsorted(at, np.arange(high - low + 1)).tolist()
        scores, size, ids, character = v.scores[ids].tolist(), size.tolist(), ids.tolist(), _CHARACTER[data[low:high]].tolist()
        for i in range(high - low):
            here = best[i]
            if here == nothing:
                continue
            covered = False
            for k in range(first[i], first[i + 1]):
                covered = covered or size[k] == character[i]
                to, total = i + size[k], here + scores[k]
                if total > best[to]:
                    best[to], back[low + to], piece[low + to] = total, size[k], ids[k]
            if not covered:
                to = min(i + character[i], n - low)
                if here + unknown > best[to]:
                    best[to] = here + unknown
                    if len(v.byte_ids):  # one byte after another
                        for k in range(low + i + 1, low + to + 1):
                            back[k], piece[k] = 1, -1
                    else:
                        back[low + to], piece[low + to] = to - i, v.unknown
        best = best[high - low:]
    taken, end = [], n
    while end:
        taken.append(piece[end] if piece[end] >= 0 else int(v.byte_ids[data[end - 1]]))
        end -= back[end]
    return np.array(taken[::-1], np.uint32)


def encode_texts(v: Vocabulary, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another, and their offsets."""
    raw, offsets = W.buffers(column)
    filled = np.diff(offsets) > 0
    data = np.full(len(raw) + int(filled.sum()), 0x20, np.uint8)  # a space before every text
    own = np.ones(len(data), bool)
    shift = W.sums(filled)
    begins = offsets + shift
    own[begins[:-1][filled]] = False
    data[own] = raw
    cut = np.zeros(len(data) + 1, bool)
    cut[:-1] = data == 0x20
    cut[1:-1] &= data[:-1] != 0x20
    cut[begins] = True
    starts = np.flatnonzero(cut[:-1])
    ends = np.append(starts[1:], len(data))
    _, first, group = np.unique(W.segment_hashes(data, starts, ends), return_index=True, return_inverse=True)
    ids, bounds = segment(v, data, starts[first], ends[first])
    size = np.diff(bounds)[group]
    at = W.sums(size)
    full = ids[np.arange(at[-1]) + np.repeat(bounds[:-1][group] - at[:-1], size)]
    return full, at[np.searchsorted(starts, begins)]


def decode_ids(v: Vocabulary, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
    """The texts of ids that stand one after another."""
    size = np.diff(v.bounds)[ids]
    at = W.sums(size)
    data = v.spelled[np.arange(at[-1]) + np.repeat(v.bounds[ids] - at[:-1], size)].tobytes()
    bounds = at[offsets].tolist()
    return [data[s + (data[s:s + 1] == b" "):e].decode("utf-8", "replace") if e > s else "" for s, e in zip(bounds, bounds[1:])]


def _carried(docs: DataFrame, columns: dict[str, str]) -> DataFrame:
    return docs.select(*(F.col(f"`{c}`").alias(a) for a, c in columns.items()))


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns, ``ids`` (the pieces of ``text``) and ``round_trip`` (decoding them returns it); no shuffle."""
    names = {f"c{i}": c for i, c in enumerate(carry)}
    source = _carried(docs, names | {"text": text})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch):
                ids, offsets = encode_texts(vocabulary, part.column("text"))
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32)))
                back = decode_ids(vocabulary, ids.astype(np.int64), offsets)
                same = [a == (b or "") for a, b in zip(back, part.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), lists, pa.array(same, pa.bool_())], names=[*names, "ids", "same"])

    types = dict(source.dtypes)
    coded = source.mapInArrow(run, ", ".join([*(f"{c} {types[c]}" for c in names), "ids array<int>", "same boolean"]))
    return coded.select(*(F.col(a).alias(c) for a, c in names.items()), "ids", F.col("same").alias("round_trip"))


def decode(coded: DataFrame, vocabulary: Vocabulary, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns and ``decoded``, the text of ``ids``; no shuffle."""
    names = {f"c{i}": c for i, c in enumerate(carry)}
    source = _carried(coded, names | {"ids": "ids"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            lists = lists.fill_null([]) if lists.null_count else lists
            offsets = lists.offsets.to_numpy().astype(np.int64)
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            i = 0
            while i < len(batch):
                j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + DECODED_TOGETHER, "right")) - 1)
                some = ids[offsets[i] - offsets[0]:offsets[j] - offsets[0]].astype(np.int64)
                texts = decode_ids(vocabulary, some, offsets[i:j + 1] - offsets[i])
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(texts, pa.string())], names=[*names, "decoded"])
                i = j

    types = dict(source.dtypes)
    texts = source.mapInArrow(run, ", ".join([*(f"{c} {types[c]}" for c in names), "decoded string"]))
    return texts.select(*(F.col(a).alias(c) for a, c in names.items()), "decoded")


def tokenized(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The documents with ``ids``, ``n_tokens`` and ``round_trip`` (does decoding return the text?) in place of any such columns."""
    kept = tuple(c for c in docs.columns if c not in ("ids", "n_tokens", "round_trip"))
    return encode(docs, vocabulary, carry=kept).select(*kept, "ids", F.size("ids").cast("long").alias("n_tokens"), "round_trip")
