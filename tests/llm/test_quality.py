import __spark_entry__ as contract
from pyspark.sql import functions as F

from tests.conftest import SF
from tests.llm import brute
from tidemark.llm import quality

COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_query_matches_brute_force(spark, texts):
    got = {r.doc_id: r for r in contract.queries()["op9_quality_ledger"](spark, SF).collect()}
    assert len(got) == len(texts)
    for i, text in texts:
        m = brute.measures(text)
        assert tuple(got[i][c] for c in COLUMNS) == m
        assert got[i].base_failed == (m[0] < 20 or 100 * m[4] > 30 * m[0])
        assert not (got[i].kept and got[i].base_failed)


def test_odd_rows_and_names(frame, odd, clash):
    rows = [*odd, odd[5], (12, "same line\nsame line\n\nsame line \n#$ <|> ÄÖ")]
    got = quality.ledger(clash(frame(rows)))
    assert sorted(map(repr, ((r.doc_id, *(r[c] for c in COLUMNS)) for r in got.collect()))) == sorted(
        map(repr, ((i, *brute.measures(t)) for i, t in rows)))


def test_empty(frame):
    empty = frame([])
    assert quality.ledger(empty).count() == 0
    assert quality.keep_good(empty).columns == empty.columns
    assert sum(r.failed for r in quality.ablation(quality.ledger(empty)).collect()) == 0


def test_filter_keeps_columns(frame, texts, clash):
    docs = clash(frame(texts))
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    verdict = quality.apply_policy(quality.ledger(docs)).where("kept").count()
    assert 0 < kept.count() == verdict < len(texts)
    assert kept.exceptAll(docs).count() == 0


def test_policies_and_ablation(frame, texts):
    ledger = quality.ledger(frame(texts)).cache()
    every = quality.mask_of(quality.POLICIES["web-1"])
    rows = [r.fail_mask & every for r in ledger.collect()]
    for r in quality.ablation(ledger).collect():
        bit = 1 << next(x.bit for x in quality.RULES if x.name == r.rule)
        assert r.failed == sum(m & bit > 0 for m in rows)
        assert r.only_this == sum(m == bit for m in rows)
        assert r.kept_without == sum(m & ~bit == 0 for m in rows)
    base = quality.apply_policy(ledger, "base-1").where("kept").count()
    assert base >= quality.apply_policy(ledger, "web-1").where("kept").count()
    assert len({r.bit for r in quality.RULES}) == len(quality.RULES)
    wide = quality.failures().alias("m")
    assert ledger.select(wide, "fail_mask").where(F.col("m") != F.col("fail_mask")).count() == 0
