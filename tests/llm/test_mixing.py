import __spark_entry__ as contract
import duckdb
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tests.llm import brute
from tidemark.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def fill(budget, limits, weights):
    """Water filling by bisection."""
    if sum(limits[k] for k in limits if weights[k] > 0) <= budget:
        return {k: float(limits[k]) if weights[k] > 0 else 0.0 for k in limits}
    low, high = 0.0, 1e12
    for _ in range(200):
        rate = (low + high) / 2
        low, high = (rate, high) if sum(min(limits[k], rate * weights[k]) for k in limits) <= budget else (low, rate)
    return {k: min(limits[k], low * weights[k]) for k in limits}


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = contract.queries()["op5_source_mixing"](spark, SF)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, con.execute(contract.oracle_sql()["op5_source_mixing"]).fetchall()))


@pytest.mark.parametrize("total,weights", [(None, {}), (3000.0, {"source": {"src3": 5.0, "src4": 0.0}}), (10.0**9, {"lang": {"en": 0.25}})])
def test_budgets(spark, table, total, weights):
    docs = mixing.with_domain(table("documents")).withColumn("t", F.regexp_count("text", F.lit(mixing.WORD)))
    tokens = {(r.domain, r.lang, r.source): r.t for r in docs.groupBy("domain", "lang", "source").agg(F.sum("t").alias("t")).collect()}
    budget = {(): float(total or sum(tokens.values()))}
    for depth, level in enumerate(mixing.LEVELS):
        given = {}
        for parent, amount in budget.items():
            kids = {}
            for path, t in tokens.items():
                if path[:depth] == parent:
                    kids[path[:depth + 1]] = kids.get(path[:depth + 1], 0) + 2 * t
            given |= fill(amount, kids, {k: weights.get(level, {}).get(k[-1], 1.0) for k in kids})
        budget = given
    held = mixing.ledger(docs, total=total, weights=weights)
    got = {(r.domain, r.lang, r.source): r for r in held.groupBy("domain", "lang", "source").agg(
        F.sum(F.col("mix_tokens") * F.col("mix_copies")).alias("t"), F.max("mix_tokens").alias("most")).collect()}
    for path, amount in budget.items():
        assert amount + 1e-3 >= got[path].t > amount - 1 - got[path].most


def test_whole_passes_then_a_prefix(spark, table):
    held = mixing.ledger(mixing.with_domain(table("documents")))
    spread = held.groupBy("domain", "lang", "source").agg((F.max("mix_copies") - F.min("mix_copies")).alias("d"))
    assert spread.where("d > 1").count() == 0
    again = mixing.ledger(mixing.with_domain(table("documents")))
    other = mixing.ledger(mixing.with_domain(table("documents")), seed=2)
    assert held.exceptAll(again).count() == 0 and held.exceptAll(other).count() > 0


def test_odd_rows_and_names(spark, odd, clash):
    rows = [(i, t, (None, "en", "de")[k % 3], (None, "src1", "src12", "web", "")[k % 5], 0) for k, (i, t) in enumerate(odd[:7] + odd[10:])]
    rows += [rows[5], (5, "other text for five", "en", "src1", 0)]
    docs = clash(spark.createDataFrame(rows, SCHEMA))
    held = mixing.ledger(mixing.with_domain(docs))
    assert held.count() == len(rows)
    tokens = sorted(len(brute.words(r[1])) for r in rows)
    assert sorted(r.mix_tokens for r in held.collect()) == tokens
    mixed = mixing.mixture(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == held.agg(F.sum("mix_copies")).first()[0]


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.ledger(mixing.with_domain(empty)).count() == 0
    assert mixing.mixture(empty).columns == empty.columns and mixing.mixture(empty).count() == 0


@pytest.mark.parametrize("source", ["src99999999999999999999", "src" + "9" * 60, "no number"])
def test_any_source_name(spark, source):
    docs = spark.createDataFrame([(1, "a b", "en", source), (2, "d e", "en", "src1")], "doc_id long, text string, lang string, source string")
    assert {r.doc_id for r in mixing.mixture(docs).collect()} == {1, 2}
    assert mixing.with_domain(docs).where("doc_id = 2").first().domain == "domain0"


def test_any_column_name(spark):
    rows = [(i, f"w{i} x y", "en", f"src{i % 3}", "a", "b", "c", "d", "e", "own") for i in range(9)]
    names = ["doc_id", "text", "lang", "source", "mix_copies", "mix_id", "a.b", "mix_hash", "row", "domain"]
    docs = spark.createDataFrame(rows, names)
    mixed = mixing.mixture(docs)
    assert mixed.columns == names and {tuple(r) for r in mixed.collect()} <= set(rows)
    plain = mixing.mixture(docs.select(*names[:4]))
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(r.doc_id for r in plain.collect())
    own = mixing.mixture(docs, domain="domain", weights={"domain": {"own": 1.0}})
    assert own.columns == names and own.count() > 0
