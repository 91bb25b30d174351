"""Exact-complement packing against a plain best-fit, its own ids and the tokenizer."""

import zlib
from bisect import bisect_left, insort
from collections import Counter
from unittest.mock import MagicMock

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF
from tidemark.llm import packing, queries

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def best_fit(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        i = bisect_left(gaps, n)
        insort(gaps, (gaps.pop(i) if i < len(gaps) else capacity) - n)
    return len(gaps)


def packed(lengths, capacity):
    """Sequences of a plan; every piece has a place, and sequences have no gaps."""
    lengths = np.asarray(lengths)
    plan = packing.plan(np.bincount(lengths, minlength=capacity + 1), capacity)
    seen, ranks = Counter(), []
    for n in lengths.tolist():
        ranks.append(seen[n])
        seen[n] += 1
    sequence, offset = plan.place(lengths, np.array(ranks, np.int64))
    ends = {}
    for s, o, n in sorted(zip(sequence.tolist(), offset.tolist(), lengths.tolist())):
        assert ends.get(s, 0) == o
        ends[s] = o + n
    assert max(ends.values(), default=0) <= capacity and sorted(ends) == list(range(plan.sequences))
    return plan


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 40).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), min_size=1, max_size=80))))
def test_plans_fill_without_gaps(case):
    capacity, lengths = case
    assert packed(lengths, capacity).sequences <= best_fit(lengths, capacity)


def test_exact_complements_of_one_two_and_three():
    assert packed([6, 4, 7, 3], 10).sequences == 2
    assert packed([7, 2, 1, 5, 3, 2], 10).sequences == 2
    assert packed([4, 3, 2, 1, 4, 3, 2, 1], 10).sequences == 2
    assert packed([4, 4, 1, 1], 10).sequences == 1  # the same length twice in one


@pytest.mark.parametrize("draw", [lambda r: r.integers(1, 2049, 8000), lambda r: r.lognormal(5, 1.2, 20000).astype(int).clip(1, 2048),
                                  lambda r: r.integers(900, 1200, 3000), lambda r: np.full(9000, 3)])
def test_large_plans_stay_small(draw):
    lengths = draw(np.random.default_rng(7))
    plan = packed(lengths, 2048)
    assert plan.sequences <= best_fit(lengths.tolist(), 2048)
    assert len(plan.runs) < 8 * 2048


def test_index_follows_what_is_taken():
    r = np.random.default_rng(3)
    counts = np.r_[0, r.integers(0, 4, 30)]
    index = packing.Complements(counts)
    for _ in range(60):
        have = np.flatnonzero(index.left)
        if not len(have):
            break
        index.take(int(r.choice(have)), 1)
        left = index.left
        for s in range(1, 31):
            assert index.pairs[s] == sum((left[x] > 0 and left[s - x] > 0) if x != s - x else left[x] > 1 for x in range(1, s // 2 + 1))


def ids_of(text):
    return [*packing.token_ids._tokenizer(TOKENIZER).encode(text or "", add_special_tokens=False).ids, 0]


def check(rows, docs, capacity):
    """Pieces of every document against the tokenizer, cut so that only the first may be shorter."""
    want = []
    for doc, text in docs:
        ids = ids_of(text)
        n = -(-len(ids) // capacity)
        cuts = [0, *(len(ids) - k * capacity for k in range(n - 1, -1, -1))]
        for i, (s, e) in enumerate(zip(cuts, cuts[1:])):
            want.append((doc, i, s, e - s, zlib.crc32(np.array(ids[s:e], "<u4").tobytes())))
    assert sorted(map(repr, (r[:5] for r in rows))) == sorted(map(repr, want))
    ends = {}
    for _, _, _, n, _, s, o in sorted(rows, key=lambda r: r[5:]):
        assert ends.get(s, 0) == o
        ends[s] = o + n
    assert all(e <= capacity for e in ends.values())
    assert len(ends) <= best_fit([w[3] for w in want], capacity)
    return len(ends), sum(w[3] for w in want)


def place(frame, tmp_path, capacity):
    pieces = packing.cut(frame, str(tmp_path / "packed"), TOKENIZER, capacity)
    return packing.place(pieces.withColumn("crc", F.crc32("ids")).drop("ids"), capacity).select(
        "doc_id", "piece", "start", "length", "crc", "sequence_id", "offset")


def test_query_on_the_whole_table(spark, texts):
    rows = [tuple(r) for r in queries.op11_best_fit_packing(spark, SF).collect()]
    sequences, tokens = check(rows, texts, 2048)
    assert sequences <= -(-tokens // 2048) + 1


@pytest.mark.parametrize("capacity", [7, 2048])
def test_odd_texts_blocks_and_names(spark, frame, odd, clash, tmp_path, monkeypatch, capacity):
    monkeypatch.setattr(packing, "ENCODED", 1000)  # many blocks
    docs = [(i, t and t[:3000]) for i, t in odd] + [(6, "again")] * 40
    rows = [tuple(r) for r in place(clash(frame(docs)).repartition(3), tmp_path, capacity).collect()]
    check(rows, docs, capacity)


def test_new_pieces_reach_the_tokenizer_together(spark, monkeypatch):
    docs, given, tokenizer = MagicMock(), [], packing.token_ids._tokenizer(TOKENIZER)
    packing.cut(docs, "unused", TOKENIZER)
    encode = docs.select.return_value.mapInArrow.call_args.args[0]
    counting = MagicMock(wraps=tokenizer)
    counting.encode_batch_fast.side_effect = lambda texts, **options: given.extend(texts) or tokenizer.encode_batch_fast(texts, **options)
    monkeypatch.setattr(packing.token_ids, "_known", lambda path: packing.token_ids._Known(counting))
    monkeypatch.setattr(packing.TaskContext, "get", lambda: MagicMock(partitionId=lambda: 0))
    texts = [" ".join(f"w{i}x{j}," for j in range(1000)) for i in range(6)]
    rows = [r for b in encode([pa.RecordBatch.from_pydict({"doc_id": list(range(6)), "text": texts})]) for r in b.to_pylist()]
    for i, text in enumerate(texts):
        assert b"".join(r["ids"] for r in rows if r["doc_id"] == i) == np.array(ids_of(text), "<u4").tobytes()
    assert len(given) < 1000  # of 6,000 different pieces


def test_empty(frame, tmp_path):
    assert place(frame([]), tmp_path, 16).count() == 0


def test_sequences_hold_the_ids(spark, frame, texts, tmp_path):
    pieces = packing.cut(frame(texts[:60]), str(tmp_path / "packed"), TOKENIZER, 64)
    pieces = pieces.cache()
    made = {r.sequence_id: (r.offsets, bytes(r.ids)) for r in packing.sequences(packing.place(pieces, 64)).collect()}
    placed = packing.place(pieces, 64).collect()
    for r in placed:
        offsets, ids = made[r.sequence_id]
        assert r.offset in offsets and ids[4 * r.offset:4 * (r.offset + r.length)] == bytes(r.ids)
    assert sum(len(ids) for _, ids in made.values()) == 4 * sum(r.length for r in placed)
