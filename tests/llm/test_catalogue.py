"""The registered queries against their SQL, and the pipeline against its parts."""

import importlib.util
import re
import shutil
import subprocess
import sys

import __spark_entry__ as contract
import corpus_pipeline
import duckdb
import pytest

from tests.conftest import ROOT, SF
from tests.llm import brute
from tidemark.llm import oracle


@pytest.mark.parametrize("name", sorted(oracle.statements()))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    result = con.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    got = contract.queries()[name](spark, SF)
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(map(repr, result.fetchall()))


def test_one_query_per_operator():
    names = [n for n in contract.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert "pipeline" in contract.queries()


def test_the_rest_imports_without_the_subpackage(tmp_path):
    for part in ("tidemark", "__spark_entry__.py"):
        source = ROOT / part
        (shutil.copytree if source.is_dir() else shutil.copy)(source, tmp_path / part)
    shutil.rmtree(tmp_path / "tidemark" / "llm")
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and 'pipeline' not in q and set(e.oracle_sql()) <= set(q)"
    assert importlib.util.find_spec("tidemark.llm")
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})


def test_pipeline_stages(spark, table, tmp_path):
    docs = table("documents")
    columns, made = docs.columns, []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        assert docs.columns[:len(columns)] == columns
        assert i == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
        made.append({(r.doc_id, r.text) for r in docs.collect()})
    good, single, clean, mixed, coded = made
    verdicts = {i: brute.measures(t) for i, t in ((r.doc_id, r.text) for r in table("documents").collect())}
    assert all(not (verdicts[i][0] < 20 or 100 * verdicts[i][4] > 30 * verdicts[i][0]) for i, _ in good)
    groups = brute.groups(sorted(good), 5, 80)
    assert {i for i, _ in single} == {c for _, c in groups.values()}
    left = brute.repeats(sorted(single), 20)
    assert {i: len(brute.words(t)) for i, t in clean} == {i: n - gone for i, (n, gone, _) in left.items()}
    assert mixed <= clean and coded == mixed
    assert docs.where("NOT round_trip").count() == 0


def test_pipeline_runs(spark):
    assert corpus_pipeline.ORACLE_SQL is None
    assert corpus_pipeline.run(spark, SF).count() > 0
