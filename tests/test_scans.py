"""Long keys in composed blocks, against one step after another."""

import random
from datetime import timedelta

import pytest

from tests.test_streaming import T0, fold, mart
from tidemark.operators import quality, revenue, scans
from tidemark.streaming import effects


@pytest.mark.parametrize("bits", [2, 12])
def test_smoothing_of_a_long_series(spark, monkeypatch, bits):
    monkeypatch.setattr(scans, "BLOCK_BITS", bits)
    r = random.Random(bits)
    series = {"long": [r.random() * 100 for _ in range(3000)], "short": [5.0, 7.0], "one": [3.5]}
    rows = [(k, i, v) for k, vs in series.items() for i, v in enumerate(vs)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "k STRING, t INT, v DOUBLE").repartition(5)
    got = {x.k: (x.points, x.smoothed) for x in revenue.exponential_smoothing(df, "k", "t", "v", 0.3, 6).collect()}
    for k, vs in series.items():
        level = vs[0]
        for v in vs[1:]:
            level = level * 0.7 + v * 0.3
        assert got[k][0] == len(vs) and got[k][1] == pytest.approx(level, abs=1e-5)


@pytest.mark.parametrize("drain_order", [False, True])
def test_a_hot_second_is_composed_in_parts(spark, monkeypatch, drain_order):
    """Two thousand events of one account at one instant, among events of others."""
    monkeypatch.setattr(scans, "BLOCK_BITS", 3)
    r = random.Random(4)
    kinds = [("product.events", None), ("support.events", "high"), ("support.events", "medium"), ("billing.events", "failed"),
             ("subscription.events", "churned")]
    sent = [("hot", *r.choices(kinds, [60, 1, 2, 1, 1])[0], T0, f"e{i:05}") for i in range(2000)]
    sent += [("x", *r.choice(kinds), T0 + timedelta(seconds=i), f"x{i:05}") for i in range(50)]
    data = [(topic, e, a, v if topic == "support.events" else None, v if topic != "support.events" else "open", t) for a, topic, v, t, e in sent]
    events = spark.createDataFrame(data, "_topic STRING, event_id STRING, account_id STRING, severity STRING, status STRING, timestamp TIMESTAMP")
    got = {x.account_id: x for x in effects.replay_health(mart(spark, ("hot", 60), ("x", 90)), events, drain_order).collect()}
    rank = {t: i for i, t in enumerate(effects.TOPICS)}
    order = (lambda x: (rank[x[1]], x[3], x[4])) if drain_order else (lambda x: (x[3], rank[x[1]], x[4]))
    for account, score in (("hot", 60), ("x", 90)):
        expected = fold(score, [(topic, v) for a, topic, v, _, _ in sorted(sent, key=order) if a == account])
        assert (got[account].health_score, got[account].health_tier, got[account].events_last_30d - 10) == expected[:3]


def test_checks_in_one_pass_are_the_checks(spark, rows):
    accounts = spark.createDataFrame([("a",), ("a",), ("b",)], "account_id STRING")
    users = spark.createDataFrame([("u", "a"), ("v", "z"), ("w", None), ("x", "z")], "user_id STRING, account_id STRING")
    usage = spark.createDataFrame([(f"e{i // 2}",) for i in range(9)], "usage_id STRING")
    health = spark.createDataFrame([("a", 50.0, "A", 1.0), ("b", 120.0, None, -1.0)], "account_id STRING, health_score DOUBLE, company_name STRING, mrr DOUBLE")
    one = quality.pass_results(quality.standard_passes(accounts, users, usage, health))
    each = quality.check_results(quality.standard_checks(accounts, users, usage, health))
    assert rows(one, *quality.RESULT) == rows(each, *quality.RESULT)
    assert {r[0]: r[1] for r in rows(one, "test_name", "failed_count")}["dim_user_account_referential_integrity"] == 3

    def broken(*_):
        raise RuntimeError("no such table")
    passes = quality.standard_passes(accounts, users, usage, health)
    passes[1] = (passes[1][0], broken)
    failed = {r[0]: r[1] for r in rows(quality.run_passes(spark, passes), "test_name", "error")}
    assert len(failed) == 6 and [n for n, e in failed.items() if e] == ["fact_usage_uniqueness", "telemetry_volume_threshold"]
