import zlib

import __spark_entry__ as contract
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.conftest import SF
from tidemark.llm import token_ids
from tidemark.session import scratch_folder

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def expected(tokenizer, rows):
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query(spark, texts, tokenizer):
    got = contract.queries()["op10_token_ids"](spark, SF).collect()
    assert sorted(map(tuple, got)) == expected(tokenizer, texts)


def test_odd_rows_and_names(spark, frame, odd, clash, tokenizer):
    rows = [r for r in odd if r[0] is not None] + [(-5, "minus"), (2**62, "far"), (4, "one"), (None, "no id")]
    folder = scratch_folder(spark)
    manifest = token_ids.write(clash(frame(rows)), folder, PATH, shard_bytes=50_000)
    got = token_ids.read(manifest, folder, block=3)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, got.collect()), key=key) == expected(tokenizer, rows)
    assert manifest.count() > 3


def test_empty(spark, frame):
    folder = scratch_folder(spark)
    assert token_ids.read(token_ids.write(frame([]), folder, PATH), folder).count() == 0


TEXTS = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "a\n\n b", "a  b", "a  b", "a   b", "it's we'll 's", " 's", "x　 y 　z",
         "tab\t b", "\x85 a \x85b", "<|endoftext|>", "a <|endoftext|> b", "é É ß", "你好 世界 ok", "\U0001F600 \U0001F600", "1 22 3a", "... ?! ,", "\x1c a\x1c b", "a\x00 b"]


def test_pieces_encode_like_whole_texts(tokenizer):
    known = token_ids._Known(tokenizer)
    for batch in (TEXTS, TEXTS[::-1], [" ".join(TEXTS), None, "\n".join(TEXTS)]):
        ids, offsets = token_ids.encode_texts(known, pa.array(batch, pa.string()))
        for i, text in enumerate(batch):
            assert ids[offsets[i]:offsets[i + 1]].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids, repr(text)


def test_known_pieces_are_forgotten(tokenizer, monkeypatch):
    monkeypatch.setattr(token_ids, "KNOWN", 5)
    monkeypatch.setattr(token_ids, "ENCODED_TOGETHER", 3)
    known = token_ids._Known(tokenizer)
    for text in ("a b c d e f g h", "h g f x y z", "a b c"):
        ids, _ = token_ids.encode_texts(known, pa.array([text]))
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


class Counting:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def __getattr__(self, name):
        return getattr(self.tokenizer, name)

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_new_pieces_are_encoded_together(tokenizer):
    counting = Counting(tokenizer)
    texts = [" ".join(f"w{i}x{j}," for j in range(1000)) for i in range(6)]
    ids, offsets = token_ids.encode_texts(token_ids._Known(counting), pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[offsets[i]:offsets[i + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert counting.texts < 1000  # of 6,000 different pieces


@pytest.mark.parametrize("together", [1, 2, 7, 512])
def test_joined_pieces_encode_like_whole_texts(tokenizer, monkeypatch, together):
    monkeypatch.setattr(token_ids, "ENCODED_TOGETHER", together)
    texts = [*TEXTS, *(f" {a} {b}" for a in TEXTS for b in ("z", "'s", "\n", "ß", "<|endoftext|>", "1,  "))]
    ids, offsets = token_ids.encode_texts(token_ids._Known(tokenizer), pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[offsets[i]:offsets[i + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_pieces_are_encoded_apart_where_tokens_do_not_tell_their_bytes(tokenizer):
    known = token_ids._Known(tokenizer)
    known.widths = known.widths + 1
    broken = [b"a b \xff c", b"\xe4\xbd d"]  # not UTF-8: a replacement has other bytes
    for texts in ([" ".join(TEXTS)], broken):
        ids, offsets = token_ids.encode_texts(known, pa.array(texts))
        for i, text in enumerate(texts):
            text = text if isinstance(text, str) else text.decode("utf-8", "replace")
            assert ids[offsets[i]:offsets[i + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    known = token_ids._Known(tokenizer)
    ids, offsets = token_ids.encode_texts(known, pa.array(broken))
    assert ids[:offsets[1]].tolist() == tokenizer.encode(broken[0].decode("utf-8", "replace"), add_special_tokens=False).ids


def test_pieces_met_again_are_kept(tokenizer, monkeypatch):
    monkeypatch.setattr(token_ids, "KNOWN", 5)
    counting = Counting(tokenizer)
    known = token_ids._Known(counting)
    for text in ("a b c d", "a b c e f g", "h"):
        token_ids.encode_texts(known, pa.array([text]))
    before = counting.texts
    ids, _ = token_ids.encode_texts(known, pa.array(["a b c"]))
    assert counting.texts == before
    assert ids.tolist() == tokenizer.encode("a b c", add_special_tokens=False).ids


@pytest.mark.parametrize("n,top", [(1, 1), (5, 3), (1000, 100), (5000, 10**9), (3000, 3000), (2000, 2**40)])
def test_elias_fano(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n))
    packed = token_ids.EliasFano.of(values).tobytes()
    sequence = token_ids.EliasFano.frombytes(packed)
    assert (sequence.select(0, n) == values).all()
    for i in rng.integers(0, n, 60).tolist():
        j = min(n, i + int(rng.integers(0, 1500)))
        assert (sequence.select(i, j) == values[i:j]).all()
    assert 8 * (len(packed) - 48) <= n * (2.2 + max(0, np.log2(top / n)) + 1) + 64


def test_elias_fano_of_nothing():
    assert len(token_ids.EliasFano.frombytes(token_ids.EliasFano.of(np.empty(0, int)).tobytes()).select(0, 0)) == 0
