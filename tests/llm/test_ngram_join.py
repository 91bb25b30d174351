import random

import __spark_entry__ as contract
import numpy as np
import pytest

from tests.conftest import SF
from tests.llm import brute
from tidemark.llm import ngram_join
from tidemark.llm.components import components
from tidemark.session import scratch_folder


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect() if r.doc_id is not None}


def test_query_matches_brute_force(spark, texts):
    got = contract.queries()["op4_ngram_jaccard_join"](spark, SF)
    assert found(got) == brute.groups(texts, 3, 90)


def variants(seed, texts):
    """Near copies of all degrees, so that many pairs lie close to the threshold."""
    rng, rows = random.Random(seed), []
    for i in range(12):
        base = [f"v{rng.randrange(300)}" for _ in range(rng.choice((3, 8, 30, 90, 200)))]
        for _ in range(12):
            w = list(base)
            for _ in range(rng.randrange(0, max(2, len(w) // 25))):
                w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
            rows.append((len(rows) * 7 % 1009, " ".join(w[rng.randrange(0, 3):])))
    return rows


@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80), (1, 50)])
def test_near_copies(frame, texts, size, percent):
    rows = variants(size, texts)
    assert found(ngram_join.near_duplicates(frame(rows), size, percent)) == brute.groups(rows, size, percent)


def test_blocks_of_a_large_gathering(frame, texts, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 200)
    monkeypatch.setattr(ngram_join, "BATCH", 500)
    rows = variants(11, texts)
    assert found(ngram_join.near_duplicates(frame(rows), 3, 90)) == brute.groups(rows, 3, 90)


def test_odd_rows_and_names(frame, odd, clash):
    rows = [*odd, (12, "ONE TWO THREE four five"), (13, "one"), (14, "one two"), (15, None)]
    got = ngram_join.near_duplicates(clash(frame(rows)), 3, 90)
    assert got.count() == len(rows)
    assert found(got) == brute.groups(rows, 3, 90)
    assert {r.component_id for r in got.where("doc_id IS NULL").collect()} == {None}


def test_rows_of_one_id_are_one_document(frame):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    got = ngram_join.near_duplicates(frame([(3, a), (3, b), (4, a), (5, b), (6, "c d e f")]), 3, 90)
    assert sorted((r.doc_id, r.component_id) for r in got.collect()) == [(3, 3), (3, 3), (4, 3), (5, 3), (6, 6)]


def test_an_id_joins_its_sets_wherever_it_stands(frame):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(30)) for x in "abcd")
    got = ngram_join.near_duplicates(frame([(3, a), (5, a), (5, b), (7, b), (7, c), (8, d), (9, d), (9, d)]), 3, 90)
    assert sorted((r.doc_id, r.component_id) for r in got.collect()) == [(3, 3), (5, 3), (5, 3), (7, 3), (7, 3), (8, 8), (9, 8), (9, 8)]


def test_one_of_each_group_stays(frame, texts, clash):
    docs = clash(frame(variants(5, texts)))
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    groups = brute.groups([(r.doc_id, r.text) for r in docs.collect()], 5, 80)
    assert {r.doc_id for r in kept.collect()} == {c for _, c in groups.values()}


def test_empty(frame):
    assert ngram_join.near_duplicates(frame([])).count() == 0
    assert ngram_join.keep_one(frame([])).count() == 0


def test_divide_skip_counts_exactly():
    rng = np.random.default_rng(3)
    lists = [np.flatnonzero(rng.random(60) < p) for p in rng.random(25)]
    starts, postings = np.concatenate([[0], np.cumsum([len(x) for x in lists])]), np.concatenate([60 * i + x for i, x in enumerate(lists)])
    times = np.bincount(np.concatenate(lists), minlength=60)
    for need in range(1, 26):
        which, count = ngram_join.divide_skip(np.arange(25), starts, postings, 60, need)
        assert which.tolist() == np.flatnonzero(times >= need).tolist()
        assert (count == times[which]).all()


def test_long_paths_are_joined(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 100), (200, 201)], "a long, b long")
    got = {r.node: r.label for r in components(links, scratch_folder(spark)).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 200: 200, 201: 200}
