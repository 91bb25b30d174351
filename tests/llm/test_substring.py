import __spark_entry__ as contract
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tests.llm import brute
from tidemark.llm import chunks, substring


def digest(df):
    kept = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return {r.doc_id: (r.n_words, r.n_removed, r.d) for r in df.withColumn("d", F.sha2(kept, 256)).collect()}


@pytest.fixture
def many_chunks(monkeypatch):
    monkeypatch.setattr(chunks.deal, "__defaults__", (*chunks.deal.__defaults__[:-1], 20_000))
    monkeypatch.setattr(chunks.bucket_bits, "__defaults__", (30_000,))


def test_query_matches_brute_force(spark, texts):
    got = contract.queries()["op8_substring_dedup"](spark, SF).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == brute.repeats(texts, 20)


def test_many_chunks(frame, texts, many_chunks):
    assert digest(substring.dedup(frame(texts), 9)) == brute.repeats(texts, 9)


def test_intervals_are_maximal(frame, texts):
    for r in substring.dedup(frame(texts), 12).collect():
        assert sum(s.after - s.first for s in r.spans) == r.n_removed
        assert all(a.after < b.first for a, b in zip(r.spans, r.spans[1:]))


def test_odd_rows_and_names(frame, odd, clash, many_chunks):
    rows = [r for r in odd if r[0] is not None] + [(None, "a b c d e f g h i j " * 3)]
    got = substring.dedup(clash(frame(rows)), 10, carry=("chunk", "doc", "c0"))
    assert got.columns[:5] == ["doc_id", "chunk", "doc", "c0", "text"]
    assert digest(got) == brute.repeats(rows, 10)
    assert got.where("doc_id = 1").first().text is None


def test_repeated_rows_stand_together(frame):
    text = " ".join(f"w{i}" for i in range(40))
    got = substring.dedup(frame([(5, text), (5, text), (6, text)]), 20).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(5, 0), (5, 0), (6, 40)]


def test_untouched_text_keeps_its_white_space(frame):
    head, passage = "  First\tline\n\n second ", " ".join(f"p{i}" for i in range(25))
    rows = [(1, passage), (2, head + passage + "\nlast  words\n"), (3, passage + " end"), (4, "start " + passage)]
    got = {r.doc_id: r.text for r in substring.remove_repeats(frame(rows)).collect()}
    assert got == {1: passage, 2: head + "last  words\n", 3: "end", 4: "start"}


def test_stage_keeps_columns(spark, frame, texts, clash):
    docs = clash(frame(texts)).withColumn("n_chars", F.length("text").cast("long"))
    clean = substring.remove_repeats(docs)
    assert clean.columns == docs.columns and clean.count() == len(texts)
    assert clean.where("n_chars <> length(text)").count() == 0


def test_empty(frame):
    assert substring.dedup(frame([])).count() == 0


def test_packed_numbers():
    for kind in (np.int64, np.int32):
        values = np.random.default_rng(1).integers(-2**30, 2**30, 1000).astype(kind)
        assert (chunks.unpack(chunks.pack(values), kind, 1000) == values).all()
    assert len(chunks.unpack(b"", np.int32, 0)) == 0
