import math
import random
import struct
import time

import __spark_entry__ as contract
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from tests.conftest import SF
from tidemark.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load(MODEL)


def encode(v, texts):
    ids, offsets = pieces.encode_texts(v, pa.array(texts, pa.string()))
    assert pieces.decode_ids(v, ids.astype(np.int64), offsets) == [t or "" for t in texts]
    return [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]


def small(scores):
    """A vocabulary of the given pieces, without byte pieces."""
    names = ["⁇", *scores]
    base, check, value = pieces.double_array([n.replace("▁", " ").encode() for n in scores], list(range(1, len(names))))
    spelled = [n.replace("▁", " ").encode() for n in names]
    return pieces.Vocabulary(np.array([-100.0, *scores.values()]), base, check, value, np.empty(0, np.int64), 0,
                             np.frombuffer(b"".join(spelled), np.uint8), np.concatenate([[0], np.cumsum([len(s) for s in spelled])]))


def best(text, scores):
    """Largest score of any segmentation."""
    table = [0.0] + [-math.inf] * len(text)
    for i in range(len(text)):
        for j in range(i + 1, len(text) + 1):
            table[j] = max(table[j], table[i] + scores.get(text[i:j], -100.0 if j == i + 1 else -math.inf))
    return table[-1]


@pytest.mark.parametrize("count", [0, 64, 1 << 30])
def test_viterbi_is_optimal(monkeypatch, count):
    monkeypatch.setattr(pieces, "FEW", count)
    rng = random.Random(5)
    letters = "abcé"
    scores = {c: -9 - rng.random() for c in "▁ab"}
    for _ in range(40):
        scores["".join(rng.choice(letters) for _ in range(rng.randint(2, 5)))] = -1 - 8 * rng.random()
        scores["▁" + "".join(rng.choice(letters) for _ in range(rng.randint(1, 3)))] = -1 - 8 * rng.random()
    v = small(scores)
    texts = [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(1, 5))) for _ in range(300)]
    ids, offsets = pieces.encode_texts(v, pa.array(texts))
    for i, text in enumerate(texts):
        got = sum(v.scores[k] for k in ids[offsets[i]:offsets[i + 1]])
        marked = "▁" + text.replace(" ", "▁") if text else ""
        assert got == pytest.approx(best(marked, scores))


def few(monkeypatch, count, window=1 << 18):
    monkeypatch.setattr(pieces, "FEW", count)
    monkeypatch.setattr(pieces, "WINDOW", window)


def test_one_unit_finds_what_many_side_by_side_find(vocabulary, texts, odd, monkeypatch):
    rng = random.Random(3)
    some = [t for _, t in texts][:12] + [t for _, t in odd if len(t or "") < 2000] + ["x" * 90, "你好世界" * 20, "é\U0001F468" * 9, "\u2581" * 5]
    some += ["".join(rng.choice("aetins你的é=/") for _ in range(rng.randint(1, 150))) for _ in range(15)]
    few(monkeypatch, 0)
    side_by_side = encode(vocabulary, some)
    for window in (1 << 18, 7):
        few(monkeypatch, 1 << 30, window)
        assert encode(vocabulary, some) == side_by_side


def test_long_text_without_spaces(vocabulary):
    rng = random.Random(4)
    for letters in ("x", "abcdefghij", "的一是不了人我在有他这"):
        text = "".join(rng.choice(letters) for _ in range(80_000))
        start = time.process_time()
        encode(vocabulary, [text])
        assert time.process_time() - start < 4  # 30 s with one round per position and depth


def _fields(data):
    i = 0

    def number():
        nonlocal i
        out = shift = 0
        while True:
            c = data[i]
            i += 1
            out |= (c & 127) << shift
            shift += 7
            if c < 128:
                return out

    while i < len(data):
        key = number()
        kind = key & 7
        size = number() if kind == 2 else {5: 4, 1: 8}.get(kind)
        if kind == 0:
            yield key, number()
        else:
            yield key, data[i:i + size]
            i += size


def _number(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def _field(key, value):
    if key & 7 == 2:
        return _number(key) + _number(len(value)) + value
    return _number(key) + (_number(value) if key & 7 == 0 else value)


def unigram(v):
    """The library's own model of the same pieces with our scores."""
    out, at = b"", 0
    for key, value in _fields(open(MODEL, "rb").read()):
        if key >> 3 == 1:
            score = struct.pack("<f", v.scores[at])
            value = b"".join(_field(k, score if k >> 3 == 2 and v.scores[at] < 0 and at else x) for k, x in _fields(value))
            at += 1
        elif key >> 3 == 2:
            value = b"".join(_field(k, 1 if k >> 3 == 3 else x) for k, x in _fields(value))
        out += _field(key, value)
    return sentencepiece.SentencePieceProcessor(model_proto=out)


def test_agrees_with_the_library(vocabulary, texts):
    model, same = unigram(vocabulary), 0
    some = [t for _, t in texts] + ["x" * 50, "你好 world", "  a  b "]
    for text, ids in zip(some, encode(vocabulary, some)):
        theirs = model.encode(text)
        same += theirs == ids  # else an equal score, up to the library's single precision
        assert sum(vocabulary.scores[theirs]) == pytest.approx(sum(vocabulary.scores[ids]), rel=1e-6)
    assert same >= 0.9 * len(some)


def test_round_trip_of_odd_texts(vocabulary, odd):
    texts = [t for _, t in odd] + [" ", "▁", "a▁ b", "\u0000\x1f", "\U0001F468‍👩", "é" * 3000, "\r\n\t ", "⁇"]
    ids = encode(vocabulary, texts)
    assert ids[0] == [] and ids[1] == []
    assert all(vocabulary.byte_ids[b] in encode(vocabulary, ["▁"])[0] for b in "▁".encode())


def test_double_array():
    rng = random.Random(1)
    keys = sorted({bytes(rng.choices(b"abcdef\xff\x00", k=rng.randint(1, 6))) for _ in range(500)})
    base, check, value = pieces.double_array(keys, list(range(len(keys))))

    def walk(key):
        node = 0
        for c in key:
            step = base[node] + c + 1
            if step >= len(check) or check[step] != node:
                return -1
            node = step
        return value[node]

    assert [walk(k) for k in keys] == list(range(len(keys)))
    assert walk(b"zz") == -1 and walk(b"") == -1


def test_query(spark, texts):
    got = {r.doc_id: r for r in contract.queries()["op6_sentencepiece"](spark, SF).collect()}
    v = pieces.load(MODEL)
    assert all(r.round_trip for r in got.values())
    for (i, _), ids in zip(texts, encode(v, [t for _, t in texts])):
        assert got[i].n_tokens == len(ids) and got[i].n_byte_tokens == np.isin(ids, v.byte_ids).sum()


def test_frames(frame, odd, clash, vocabulary):
    rows = [*odd, odd[6]]
    docs = clash(frame(rows))
    got = pieces.tokenized(docs, vocabulary)
    assert got.columns == [c for c in docs.columns if c != "ids"] + ["ids", "n_tokens", "round_trip"]
    assert got.count() == len(rows) and got.where("NOT round_trip").count() == 0
    assert pieces.tokenized(frame([]), vocabulary).count() == 0
    texts = pieces.decode(got, vocabulary, carry=("doc_id", "text", "decoded"))
    assert texts.columns[:2] == ["doc_id", "text"] and texts.drop("decoded").count() == len(rows)
    plain = pieces.decode(pieces.encode(frame(rows), vocabulary, carry=("doc_id", "text")), vocabulary, carry=("doc_id", "text"))
    assert plain.where("decoded <> coalesce(text, '')").count() == 0
