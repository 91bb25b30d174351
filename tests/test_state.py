"""Health as stream state, against composed effects and the replay of all events."""

from pyspark.sql import functions as F

from tests.test_streaming import NOW, Feed, billing, fold, mart, product, subscription, support
from tidemark.streaming import effects, events as E, state as keyed
from tidemark.streaming.live import LiveJob
from tidemark.streaming.state import HealthState

SHOWN = ("account_id", "health_score", "health_tier", "events_last_30d", "payment_status", "last_updated_at")


def test_state_follows_batches_and_survives_a_restart(spark, tmp_path, rows):
    base = mart(spark, ("a", 50), ("b", 99.9), ("c", 90), ("quiet", 60))
    feed = Feed(spark, tmp_path)
    state = HealthState(spark, feed.job, str(tmp_path / "state"))
    feed.send(product=[product(1), product(2, "b")], billing=[billing(3)], support=[support(4, "high", "nobody")])
    state.start(base).awaitTermination()
    assert rows(state.current_health(base), *SHOWN) == rows(feed.job.current_health(base), *SHOWN)
    feed.send(subscription=[subscription(20, "cancelled", "c")], product=[product(21), product(1)])
    feed.send(support=[support(30, "medium")], billing=[billing(31, "b")])
    again = HealthState(spark, LiveJob(spark, feed.job.root, clock=lambda: NOW), str(tmp_path / "state"))   # two batches, one trigger
    again.start(base).awaitTermination()
    got = rows(again.current_health(base), *SHOWN)
    assert got == rows(feed.job.current_health(base), *SHOWN)
    assert {r[0]: r[1:3] for r in got} == {"a": (20.2, "Critical"), "b": (75.0, "Healthy"), "c": (60.0, "Critical"), "quiet": (60.0, "At Risk")}

    # batch 0 is written once more by a retry; its effects are known
    source = spark.read.schema(E.EVENT_DDL)
    batch = E.normalise(source.json(f"{tmp_path}/in/product.events/0001.json"), "product.events").unionByName(
        E.normalise(source.json(f"{tmp_path}/in/billing.events/0001.json"), "billing.events"))
    feed.job.process(batch, 0)
    again.start(base).awaitTermination()
    assert rows(again.current_health(base), *SHOWN) == got


def test_state_equals_the_replay(spark, tmp_path, rows):
    """Events in time order over two batches; one account has most of them."""
    base, feed, sent = mart(spark, ("hot", 80), ("x", 30)), Feed(spark, tmp_path), []
    state = HealthState(spark, feed.job, str(tmp_path / "state"))
    for n in range(2):
        batch = [product(100 * n + i, "hot") for i in range(40)] + [product(100 * n + 50, "x")]
        bills, tickets = [billing(100 * n + 60, "hot")], [support(100 * n + 70 + i, "medium", "hot") for i in range(3)]
        feed.send(product=batch, billing=bills, support=tickets)
        sent += [("product.events", None)] * 40 + [("billing.events", "failed")] + [("support.events", "medium")] * 3
    state.start(base).awaitTermination()
    later = HealthState(spark, feed.job, str(tmp_path / "later"))
    later.start(base, after_batch=0).awaitTermination()
    assert rows(later.current_health(base), *SHOWN) == rows(feed.job.current_health(base, 0), *SHOWN)
    got = {r.account_id: r for r in state.current_health(base).collect()}
    events = None
    for topic in E.TOPICS[:1] + E.TOPICS[2:]:
        part = E.normalise(spark.read.schema(E.EVENT_DDL).json(f"{tmp_path}/in/{topic}"), topic)
        events = part if events is None else events.unionByName(part)
    replayed = effects.replay_health(base, events)
    assert rows(state.current_health(base), *SHOWN) == rows(replayed, *SHOWN)
    assert (got["hot"].health_score, got["hot"].events_last_30d - 10) == (fold(80, sent)[0], 80)
    assert spark.read.parquet(f"{feed.job.root}/health_effects").where("account_id = 'hot'").count() == 2   # a row a batch


def test_state_is_one_value_a_group(spark, tmp_path, rows, monkeypatch):
    """30 accounts in eight groups, some with nulls; a later run keeps to the groups of the first."""
    monkeypatch.setattr(keyed, "GROUP", 4, raising=False)
    known = lambda column, account: F.when(F.col("account_id") != account, F.col(column))
    base = mart(spark, *[(f"a{i}", 3 * i) for i in range(30)]).withColumns(
        {"payment_status": known("payment_status", "a1"), "last_updated_at": known("last_updated_at", "a2"), "events_last_30d": known("events_last_30d", "a29")})
    feed = Feed(spark, tmp_path)
    feed.send(product=[product(i, f"a{i}") for i in range(20)] + [product(40, "nobody")], billing=[billing(50, "a3")])
    state = HealthState(spark, feed.job, str(tmp_path / "state"))
    first = state.start(base)
    first.awaitTermination()
    assert first.lastProgress["stateOperators"][0]["numRowsTotal"] <= 8
    assert rows(state.current_health(base), *SHOWN) == rows(feed.job.current_health(base), *SHOWN)
    feed.send(product=[product(100 + i, f"a{i}") for i in range(1, 29, 3)], subscription=[subscription(90, "cancelled", "a28")])
    again = HealthState(spark, feed.job, str(tmp_path / "state"))
    later = again.start(base.where("account_id < 'a2'"))
    later.awaitTermination()
    assert later.lastProgress["stateOperators"][0]["numRowsTotal"] == first.lastProgress["stateOperators"][0]["numRowsTotal"]
    assert rows(again.current_health(base), *SHOWN) == rows(feed.job.current_health(base), *SHOWN)
