"""Collocations against plain counting."""

import numpy as np
import pytest

from tests.llm import brute
from tidemark.llm import collocations as K


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("longest, least, absorb, shard", [(3, 10, 50, 4 << 20), (3, 10, 50, 60_000), (5, 4, 80, 150_000)])
def test_small_documents(table, longest, least, absorb, shard):
    docs = table("documents")
    got = K.collocations(docs, longest=longest, least=least, absorb=absorb, shard_bytes=shard, bucket_bytes=50_000)
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert rows_of(got) == brute.collocations(rows, longest, least, absorb)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_lowered_support_loses_nothing(frame):
    # ten occurrences spread so that no shard has two; the support of many shards is one
    rows = [(i, f"red fox {'z' * 50} n{i}") for i in range(10)]
    got = rows_of(K.collocations(frame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string"), shard_bytes=64))
    assert got == brute.collocations([("en", t) for _, t in rows]) and len(got) == 1
    # and nine occurrences are not enough, also where few shards lower it to five
    assert K.collocations(frame([(i, t, "en") for i, t in rows[:9]], "doc_id long, text string, lang string"), shard_bytes=400).count() == 0


def test_languages_breaks_ties_and_odd_rows(frame, clash):
    rows = [(None, None, None), (1, "", "en"), (2, " \t\n", "en"), (3, "A b.c D " * 12, None), (4, "a b\nc d\r" * 12, "und"),
            (5, "x y z " * 11, "fr"), (6, "é É k, " * 15, "fr"), (7, "p q; P Q! " * 6, "de"), (8, "q p : " * 11, "de")]
    rows += [(9, "same row here . " * 2, "en")] * 20
    rows += [(10, "long " * 30_000 + "tail", "xx")]
    got = rows_of(K.collocations(clash(frame(rows, "doc_id long, text string, lang string")), shard_bytes=200, bucket_bytes=100))
    assert got == brute.collocations([(lang, t) for _, t, lang in rows])
    assert {r[0] for r in got} == {"und", "fr", "de", "en", "xx"}


def test_top_is_by_language(frame):
    rows = [(i, f"a{i % 7} b{i % 7} . " * 2, f"l{i % 2}") for i in range(140)]
    docs = frame(rows, "doc_id long, text string, lang string")
    assert rows_of(K.collocations(docs, top=3)) == brute.collocations([(lang, t) for _, t, lang in rows], top=3)
    assert K.collocations(docs, top=None).count() == 14


def test_empty(frame):
    assert K.collocations(frame([], "doc_id long, text string, lang string")).count() == 0


def test_scores_beyond_64_bits():
    a = np.array([3 << 40, 10], np.int64)
    parts = [(np.array([7 << 40, 10]), np.array([5 << 41, 10])), (np.array([3 << 40, 10]), np.array([3 << 40, 11]))]
    left, right, score = K.scores(a, parts)
    assert score.tolist() == [(3 << 40) ** 2 * 10**6 // ((7 << 40) * (5 << 41)), 10**8 // 110]
    assert left.tolist() == [7 << 40, 10] and right.tolist() == [5 << 41, 11]


def test_equal_cuts_take_the_first():
    a, parts = np.array([10]), [(np.array([20]), np.array([30])), (np.array([30]), np.array([20]))]
    assert K.scores(a, parts)[0].tolist() == [20]
