import itertools
import math

import __spark_entry__ as contract
import numpy as np
import pytest

from tests.conftest import SF
from tests.llm import brute
from tidemark.llm import hmm
from tidemark.session import scratch_folder


def compare(got, rows):
    want = brute.base_scores(rows)
    got = {r.doc_id: r for r in got}
    assert len(got) == len(want)
    for i, (held, tokens, known, n, base) in want.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, tokens, known, n)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score < 0 and math.isfinite(r.score)


def test_query(spark, texts):
    got = contract.queries()["op7_hmm_score"](spark, SF).collect()
    compare(got, texts)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > 0.95 * sum(r.base_score for r in held)  # better on unseen text


def random_model(states, symbols, seed=1):
    rng = np.random.default_rng(seed)
    part = lambda *s: (lambda x: x / x.sum(-1, keepdims=True))(rng.random(s) + 0.05)
    return hmm.Model(part(states), part(states, states), part(states, symbols).T.copy())


def paths(tokens, m):
    """Probability of every path through the states."""
    for path in itertools.product(range(len(m.start)), repeat=len(tokens)):
        p = m.start[path[0]] * m.emit[tokens[0], path[0]]
        for a, b, x in zip(path, path[1:], tokens[1:]):
            p *= m.step[a, b] * m.emit[x, b]
        yield path, p


TRAINED = [i for i in range(60) if not brute.base_scores([(i, "")])[i][0]][:3]
SEQUENCES = ([1, 2, 0], [0], [3, 3, 1, 2, 4, 0], [2, 0])


def test_likelihood_is_the_sum_over_all_paths():
    m = random_model(3, 5)
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in SEQUENCES])])
    got = hmm.log10_likelihood(np.concatenate(SEQUENCES), offsets, m)
    assert got == pytest.approx([math.log10(sum(p for _, p in paths(s, m))) for s in SEQUENCES])


def test_expected_counts_are_those_of_all_paths():
    m = random_model(3, 5, 2)
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in SEQUENCES])])
    starts, steps, emitted = hmm.expected_counts(np.concatenate(SEQUENCES), offsets, m)
    a, b, c = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for s in SEQUENCES:
        total = sum(p for _, p in paths(s, m))
        for path, p in paths(s, m):
            a[path[0]] += p / total
            for i, j in zip(path, path[1:]):
                b[i, j] += p / total
            for x, i in zip(s, path):
                c[x, i] += p / total
    assert starts == pytest.approx(a) and steps == pytest.approx(b) and emitted == pytest.approx(c)


def unsegmented(tokens, m):
    """The textbook recursions over one text."""
    n, states = len(tokens), len(m.start)
    a, b = np.empty((n, states)), np.ones((n, states))
    for t, x in enumerate(tokens):
        a[t] = (m.start if t == 0 else a[t - 1] @ m.step) * m.emit[x]
        a[t] /= a[t].sum()
    steps, emitted = np.zeros_like(m.step), np.zeros_like(m.emit)
    for t in range(n - 2, -1, -1):
        b[t] = m.step @ (m.emit[tokens[t + 1]] * b[t + 1])
        b[t] /= b[t].sum()
        pair = a[t][:, None] * m.step * (m.emit[tokens[t + 1]] * b[t + 1])
        steps += pair / pair.sum()
    gamma = a * b / (a * b).sum(1, keepdims=True)
    np.add.at(emitted, tokens, gamma)
    return gamma[0], steps, emitted


@pytest.mark.parametrize("segment,batch", [(7, 10), (128, 300), (1024, 400_000), (1000, 5)])
def test_segments_pass_their_rows_on(monkeypatch, segment, batch):
    m = random_model(3, 6, 3)
    monkeypatch.setattr(hmm, "SEGMENT", segment)
    monkeypatch.setattr(hmm, "BATCH_TOKENS", batch)
    rng = np.random.default_rng(0)
    texts = [rng.integers(0, 6, n) for n in (1000, 1, 7, 512, 513, 1024, 50)]
    got = hmm.expected_counts(np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])]), m)
    for have, want in zip(got, map(sum, zip(*(unsegmented(t, m) for t in texts)))):
        assert have == pytest.approx(want, rel=1e-9)


def test_frequent_words_merge_as_a_tree(frame, texts, spark, monkeypatch):
    _, whole = hmm.encode(frame(texts), "doc_id", "text", scratch_folder(spark))
    for together in (1 << 20, 2):
        monkeypatch.setattr(hmm, "FREQUENT", 50)
        monkeypatch.setattr(hmm, "TOP_TOGETHER", together)
        _, few = hmm.encode(frame(texts), "doc_id", "text", scratch_folder(spark))
        assert set(few.frequent) <= set(whole.frequent)
        assert sorted(few.weights[1:51]) == sorted(whole.weights[1:len(whole.frequent) + 1])[-50:]


def test_training_raises_the_likelihood(frame, texts, spark):
    encoded, symbols = hmm.encode(frame(texts), "doc_id", "text", scratch_folder(spark))
    encoded.cache()
    rows = [np.frombuffer(r.symbols, np.uint16) for r in encoded.where("NOT held_out").collect()]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    totals = [hmm.log10_likelihood(np.concatenate(rows), offsets, hmm.train(encoded, symbols.weights, 4, n)).sum() for n in (1, 3, 6)]
    assert totals[0] < totals[1] < totals[2]
    assert sum((r == hmm.END).sum() for r in rows) == len(rows)


def test_probabilities_add_up(frame, spark):
    """Over all words of a small vocabulary and the unknown ones of each class, first tokens have probability 1."""
    rows = list(zip(TRAINED, ("aa bb aa cc", "bb dd ee", "aa ff gg hh aa")))
    _, symbols = hmm.encode(frame(rows), "doc_id", "text", scratch_folder(spark))
    m = hmm.train(hmm.encode(frame(rows), "doc_id", "text", scratch_folder(spark))[0], symbols.weights, 2, 2)
    assert m.emit.sum(0) == pytest.approx([1, 1]) and m.step.sum(1) == pytest.approx([1, 1]) and m.start.sum() == pytest.approx(1)
    assert symbols.tokens == 15 and symbols.types == 9 and len(symbols.frequent) == 8


def test_odd_rows_and_names(frame, odd, clash):
    rows = [r for r in odd if r[0] is not None] + [(None, "no id here")]
    compare(hmm.score(clash(frame(rows)), states=3, iterations=2).collect(), rows)


def test_repeated_rows_count_each(frame):
    got = hmm.score(frame(list(zip((TRAINED[0], TRAINED[0], TRAINED[1]), ("a b", "a b", "c")))), states=2, iterations=1).collect()
    assert {r.train_tokens for r in got} == {8} and len(got) == 3


def test_no_training_rows_and_empty(frame):
    held = [i for i in range(60) if brute.base_scores([(i, "a b")])[i][0]][:3]
    rows = [(i, "a b") for i in held]
    compare(hmm.score(frame(rows), states=2, iterations=1).where("base_score <= 0").collect(), rows)
    assert hmm.score(frame([]), states=2, iterations=1).count() == 0
