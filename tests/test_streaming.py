import json
import os
import random
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.sources import storage
from tidemark.streaming import effects, events as E, live, windows
from tidemark.streaming.live import LiveJob

T0 = datetime(2024, 1, 31, tzinfo=timezone.utc)
NOW = datetime(2024, 2, 10, tzinfo=timezone.utc)


def at(seconds):
    return (T0 + timedelta(seconds=seconds)).isoformat()


def product(i, account="a", user="u", seconds=None, **extra):
    return {"event_id": f"p{i}", "account_id": account, "user_id": user, "feature": "f",
            "timestamp": at(i if seconds is None else seconds), **extra}


def billing(i, account="a", status="failed", **extra):
    return {"event_id": f"b{i}", "account_id": account, "invoice_id": "i", "amount": 5.0, "status": status,
            "timestamp": at(i), **extra}


def support(i, severity, account="a", **extra):
    return {"event_id": f"s{i}", "ticket_id": "t", "account_id": account, "severity": severity, "status": "open",
            "timestamp": at(i), **extra}


def subscription(i, status, account="a", **extra):
    return {"event_id": f"c{i}", "account_id": account, "status": status, "timestamp": at(i), **extra}


def mart(spark, *accounts):
    """(account, score[, payment]) rows as a health mart."""
    data = []
    for account, score in accounts:
        tier = "Healthy" if score >= 75 else "At Risk" if score >= 50 else "Critical"
        data.append((account, account, "i", "Starter", Decimal("299"), "o", float(score), tier, 10, 1, 0, 0, 100.0,
                     S.GOOD_STANDING, 0.1, 0.1, False, T0))
    return spark.createDataFrame(data, S.WAREHOUSE["mrt_customer_health"])


class Feed:
    """Writes events to topic folders and runs the job until they are drained."""

    def __init__(self, spark, tmp_path, **job):
        self.spark, self.path, self.n = spark, tmp_path, 0
        for topic in E.TOPICS:
            (tmp_path / "in" / topic).mkdir(parents=True)
        self.job = LiveJob(spark, str(tmp_path / "out"), clock=lambda: NOW, **job)

    def send(self, **topics):
        self.n += 1
        for name, events in topics.items():
            folder = self.path / "in" / f"{name}.events"
            (folder / f"{self.n:04}.json").write_text("".join(json.dumps(e) + "\n" for e in events))
        query = self.job.start(live.read_topics(self.spark, str(self.path / "in")), str(self.path / "checkpoint"))
        query.awaitTermination()

    def health(self, frame):
        return {r.account_id: r for r in self.job.current_health(frame).collect()}

    def letters(self):
        rows = self.spark.read.parquet(f"{self.path}/out/dead_letters").collect()
        return {r.event_id: r for r in rows}


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_score_changes(feed, spark):
    base = mart(spark, ("gain", 99.9), ("top", 100), ("low", 20), ("lost", 90), ("crit", 90), ("quiet", 60))
    feed.send(
        product=[product(1, "top"), product(2, "gain"), product(3, "lost")],
        billing=[billing(4, "low"), billing(5, "quiet", "paid")],
        support=[support(6, "critical", "crit"), support(7, "medium", "top"), support(8, "high", "nobody")],
        subscription=[subscription(9, "cancelled", "lost")],
    )
    got = feed.health(base)
    assert got["gain"].health_score == 100.0 and got["gain"].events_last_30d == 11
    assert got["top"].health_score == 95.0                       # 100 + 0.1 capped, then -5
    assert (got["low"].health_score, got["low"].payment_status) == (0.0, S.PAYMENT_TROUBLE)
    assert (got["lost"].health_score, got["lost"].health_tier) == (60.1, "Critical")
    assert got["crit"].health_score == 90.0                      # critical severity costs nothing
    assert got["quiet"].health_score == 60.0 and got["quiet"].last_updated_at == T0.replace(tzinfo=None)
    assert set(got) == {"gain", "top", "low", "lost", "crit", "quiet"}
    feed.send(product=[product(20, "lost")])
    assert (feed.health(base)["lost"].health_score, feed.health(base)["lost"].health_tier) == (60.2, "At Risk")


def test_copies_in_batch_across_batches_and_after_restart(feed, spark):
    base = mart(spark, ("a", 50))
    feed.send(product=[product(1), product(1), product(2)], billing=[billing(3), billing(3)])
    feed.send(product=[product(1), product(4)], billing=[billing(3)])
    restarted = LiveJob(spark, feed.job.root, clock=lambda: NOW)
    feed.job = restarted
    feed.send(product=[product(2), product(1, feature="other")])   # same id, other content: the fact exists
    row = feed.health(base)["a"]
    assert row.events_last_30d == 13 and row.health_score == 25.3 and row.health_tier == "Critical"
    assert sorted(r.usage_id for r in feed.job.usage().collect()) == ["p1", "p2", "p4"]
    totals = {r.topic: (r.received, r.consumed, r.duplicates_dropped) for r in feed.job.metrics().collect()}
    assert totals == {"product.events": (7, 4, 3), "billing.events": (3, 1, 2)}


@pytest.mark.parametrize("topic, field", [(t, f) for t, fs in E.REQUIRED.items() for f in fs if f not in ("event_id", "timestamp")])
def test_first_missing_field(spark, topic, field):
    make = {"product.events": product(1), "billing.events": billing(1), "support.events": support(1, "low"),
            "subscription.events": subscription(1, "active")}[topic]
    event = {**make, field: None}
    df = spark.read.schema(E.EVENT_DDL).json(spark.sparkContext.parallelize([json.dumps(event)]))
    checked = E.with_error(E.with_envelope(E.normalise(df, topic), NOW)).first()
    assert checked["_error"] == f"{E.LABELS[topic]} event missing required field: {field}"


def test_envelope_fills_id_and_time(spark):
    lines = [json.dumps({"account_id": "a", "status": "active"})] * 2
    df = spark.read.schema(E.EVENT_DDL).json(spark.sparkContext.parallelize(lines))
    filled = E.with_envelope(E.normalise(df, "subscription.events"), NOW)
    a, b = filled.collect()
    assert a.event_id == b.event_id and a.event_id.startswith("evt_") and a.timestamp == NOW.replace(tzinfo=None)
    assert (a["_retry_count"], a["_max_retries"]) == (0, 3)
    assert E.with_error(filled).where("_error IS NOT NULL").count() == 0
    unknown = E.with_error(filled.withColumn("_topic", E.F.lit("other.events"))).first()["_error"]
    assert unknown == "Unknown topic: other.events"


def test_dead_letters_and_redrive(spark, tmp_path):
    accounts = spark.createDataFrame([("a",)], "account_id STRING")
    users = spark.createDataFrame([("u",)], "user_id STRING")
    feed = Feed(spark, tmp_path, known=lambda: {"account_id": accounts, "user_id": users})
    feed.send(product=[product(1), product(2, account="new"), product(2, account="new"), product(3, user="who"), product(4, feature=None)],
              billing=[billing(5, "elsewhere")])
    letters = feed.letters()
    assert {k: r["_fatal_error"] for k, r in letters.items()} == {
        "p2": "Unknown account_id: new", "p3": "Unknown user_id: who", "p4": "Product event missing required field: feature"}
    assert letters["p2"]["_retry_count"] == 3 and letters["p2"]["_dead_lettered_at"] == NOW.replace(tzinfo=None)
    more = accounts.unionByName(spark.createDataFrame([("new",)], "account_id STRING"))
    stored = spark.read.parquet(f"{tmp_path}/out/dead_letters")
    valid, kept = E.redrive(stored, {"account_id": more, "user_id": users})
    assert [r.event_id for r in valid.collect()] == ["p2"]
    assert {r.event_id: r["_redrive_count"] for r in kept.collect()} == {"p3": 1, "p4": 1}
    for _ in range(3):
        valid, kept = E.redrive(kept, {"account_id": more, "user_id": users})
    everyone = users.unionByName(spark.createDataFrame([("who",)], "user_id STRING"))
    valid, kept = E.redrive(kept, {"account_id": more, "user_id": everyone})
    assert valid.count() == 0 and kept.count() == 2            # attempts used up


def test_unknown_keys(spark, rows):
    data = [("product.events", f"e{i}", a, None) for i, a in enumerate(["a", "x", "y", None, "x"])] + [("billing.events", "b", "x", None)]
    df = spark.createDataFrame(data, "_topic STRING, event_id STRING, account_id STRING, _error STRING")
    known = {"account_id": spark.createDataFrame([("a",)], "account_id STRING")}
    got = rows(E.reject_unknown(df, known), "event_id", "_error")
    assert got == [("b", None), ("e0", None), ("e1", "Unknown account_id: x"), ("e2", "Unknown account_id: y"),
                   ("e3", None), ("e4", "Unknown account_id: x")]


def test_redrive_job_sends_letters_back_once(spark, tmp_path, rows):
    known = {"accounts": ["a"]}
    feed = Feed(spark, tmp_path, known=lambda: {
        "account_id": spark.createDataFrame([(a,) for a in known["accounts"]], "account_id STRING")})
    feed.send(product=[product(1), product(2, account="new", seconds=2.123456), product(3, account="never")])
    feed.send(product=[product(2, account="new", seconds=2.123456)])                  # still unknown: one letter is enough
    assert len(feed.letters()) == 2 and spark.read.parquet(f"{tmp_path}/out/dead_letters").count() == 2
    source = str(tmp_path / "in")
    assert rows(feed.job.redrive(0, source), "republished") == [(False,), (False,)]
    known["accounts"].append("new")
    assert rows(feed.job.redrive(1, source), "republished") == [(False,), (True,)]
    assert rows(feed.job.redrive(2, source), "republished") == [(False,)]
    assert rows(feed.job.redrive(3, source), "republished") == []    # tried three times
    feed.send()
    assert sorted(r.usage_id for r in feed.job.usage().collect()) == ["p1", "p2"]
    assert feed.job.usage().where("usage_id = 'p2'").first().event_timestamp.microsecond == 123456


def test_replayed_batch_changes_nothing(feed, spark):
    base = mart(spark, ("a", 50))
    feed.send(product=[product(1), product(2)], billing=[billing(3)], support=[support(4, "high")])
    before = feed.health(base)
    batch = spark.read.schema(E.EVENT_DDL).json(f"{feed.path}/in/product.events")
    again = E.normalise(batch, "product.events")
    for topic in E.TOPICS[1:]:
        again = again.unionByName(E.normalise(spark.read.schema(E.EVENT_DDL).json(f"{feed.path}/in/{topic}"), topic))
    feed.job.process(again, 0)
    assert feed.health(base) == before and feed.job.usage().count() == 2


def test_late_events_dates_and_subscribers(spark, tmp_path):
    received = []
    feed = Feed(spark, tmp_path, subscribers=[lambda df, n: received.append((n, df.count()))])
    feed.send(product=[product(1, seconds=4 * 3600)])
    feed.send(product=[product(2, seconds=2 * 3600), product(3, seconds=2 * 3600 - 1), product(4, seconds=-86400)])
    late = {r.event_id for r in feed.job.late_events().collect()}
    assert late == {"p3", "p4"} and feed.job.usage().count() == 4
    assert [str(r[0]) for r in feed.job.dates_to_restate().orderBy("event_date").collect()] == ["2024-01-30", "2024-01-31"]
    dates = spark.read.parquet(f"{tmp_path}/out/dim_date")
    assert sorted((r.date_key, r.batch_id) for r in dates.collect()) == [("2024-01-30", 1), ("2024-01-31", 0)]
    assert received == [(0, 1), (1, 3)]


def fold(score, events):
    """One event after another, in whole tenths."""
    score, tier, n, payment = round(score * 10), None, 0, None
    for topic, value in events:
        if topic == "product.events":
            score, n, tier = min(1000, score + 1), n + 1, None
        elif topic == "billing.events" and value == "failed":
            score, payment, tier = max(0, score - 250), S.PAYMENT_TROUBLE, None
        elif topic == "support.events" and value in ("high", "medium"):
            score, tier = max(0, score - (150 if value == "high" else 50)), None
        elif topic == "subscription.events" and value in ("cancelled", "churned"):
            score, tier = max(0, score - 300), "Critical"
    tier = tier or ("Healthy" if score >= 750 else "At Risk" if score >= 500 else "Critical")
    return score / 10, tier, n, payment


@pytest.mark.parametrize("drain_order", [False, True])
def test_composed_replay_equals_one_by_one(spark, drain_order):
    rng = random.Random(11)
    accounts = [(f"a{i}", rng.randrange(0, 1001) / 10) for i in range(8)]
    # One account holds most events.
    sent = []
    for i in range(600):
        account = "a0" if rng.random() < 0.6 else rng.choice(accounts)[0]
        topic = rng.choices(E.TOPICS, [12, 1, 2, 3])[0]
        value = {"product.events": None, "subscription.events": rng.choice(["active", "cancelled", "churned"]),
                 "billing.events": rng.choice(["paid", "failed"]),
                 "support.events": rng.choice(["low", "medium", "high", "critical"])}[topic]
        sent.append((account, topic, value, T0 + timedelta(seconds=rng.randrange(4 * 86400) // 30 * 30), f"e{i:04}"))
    data = [(topic, e, a, value if topic == "support.events" else None,
             value if topic != "support.events" else "open", t) for a, topic, value, t, e in sent]
    events = spark.createDataFrame(data, "_topic STRING, event_id STRING, account_id STRING, severity STRING, status STRING, timestamp TIMESTAMP")
    got = {r.account_id: r for r in effects.replay_health(mart(spark, *accounts), events, drain_order).collect()}
    rank = {t: i for i, t in enumerate(E.TOPICS)}
    order = (lambda x: (rank[x[1]], x[3], x[4])) if drain_order else (lambda x: (x[3], rank[x[1]], x[4]))
    for account, score in accounts:
        mine = [(topic, value) for a, topic, value, _, _ in sorted(sent, key=order) if a == account]
        expected = fold(score, mine)
        row = got[account]
        assert (row.health_score, row.health_tier, row.events_last_30d - 10) == expected[:3]
        assert (row.payment_status == S.PAYMENT_TROUBLE) == (expected[3] is not None)


def test_more_gain_than_the_scale(spark):
    """1,500 gains over two days reach the top; what came before them no longer matters."""
    data = [("product.events", f"e{i:05}", None, "open", T0 + timedelta(minutes=i + 1)) for i in range(1500)]
    data += [("billing.events", "b1", None, "failed", T0), ("support.events", "s1", "high", "open", T0 + timedelta(days=3))]
    events = spark.createDataFrame(data, "_topic STRING, event_id STRING, severity STRING, status STRING, timestamp TIMESTAMP")
    row = effects.replay_health(mart(spark, ("a", 10)), events.withColumn("account_id", E.F.lit("a"))).first()
    assert (row.health_score, row.events_last_30d) == (85.0, 1510)


def test_penalties_can_be_changed(spark):
    df = E.normalise(spark.read.schema(E.EVENT_DDL).json(spark.sparkContext.parallelize([json.dumps(support(1, "critical"))])), "support.events")
    row = effects.replay_health(mart(spark, ("a", 90)), df, support_penalty={"critical": -20.0}).first()
    assert (row.health_score, row.health_tier) == (70.0, "At Risk")
    with pytest.raises(ValueError):
        effects.event_effects(df, {"critical": -0.55})


def test_windows_on_a_stream(spark, tmp_path):
    (tmp_path / "in" / "product.events").mkdir(parents=True)
    for topic in E.TOPICS[1:]:
        (tmp_path / "in" / topic).mkdir()

    def feed_file(n, *seconds):
        (tmp_path / "in" / "product.events" / f"{n}.json").write_text(
            "".join(json.dumps(product(f"{n}{i}", seconds=s)) + "\n" for i, s in enumerate(seconds)))

    feed_file(1, 10, 20, 3700)
    feed_file(2, 6 * 3600)
    feed_file(3, 7 * 3600)
    feed_file(4, 30, 12 * 3600)              # 30 s is behind the watermark now
    for n in (1, 2, 3, 4):
        os.utime(tmp_path / "in" / "product.events" / f"{n}.json", (n, n))
    stream = live.read_topics(spark, f"{tmp_path}/in", files_per_batch=1)
    outputs = {"tumbling": windows.windowed_usage(stream), "sessions": windows.session_usage(stream),
               "sliding": windows.windowed_usage(stream, "2 hours", "1 hour")}
    got = {}
    for name, df in outputs.items():
        query = (df.writeStream.format("parquet").option("path", f"{tmp_path}/{name}").outputMode("append")
                 .option("checkpointLocation", f"{tmp_path}/cp_{name}").trigger(availableNow=True).start())
        query.awaitTermination()
        got[name] = sorted((r.window_start.hour, r.event_count) for r in spark.read.parquet(f"{tmp_path}/{name}").collect())
    assert got["tumbling"][:2] == [(0, 2), (1, 1)]
    assert got["sessions"][:2] == [(0, 2), (1, 1)]
    assert (0, 3) in got["sliding"] and (23, 2) in got["sliding"]


def test_kafka_shapes(spark):
    options = live.kafka_options("broker:9092", max_offsets=10)
    assert options["subscribe"].split(",") == list(E.TOPICS) and options["maxOffsetsPerTrigger"] == "10"
    with pytest.raises(ValueError):
        live.kafka_options("broker:9092", ["other.events"])
    records = spark.createDataFrame([("billing.events", bytearray(json.dumps(billing(1)).encode()))], "topic STRING, value BINARY")
    row = live.from_kafka(records).first()
    assert (row["_topic"], row.event_id, row.amount) == ("billing.events", "b1", Decimal("5.00"))


def test_unreadable_lines_are_letters_of_their_own(spark, tmp_path):
    good = {"event_id": "b1", "account_id": "a", "invoice_id": "i", "amount": 5, "status": "paid", "timestamp": "2024-01-02T00:00:00Z"}
    bad = ["{not json", "{neither", json.dumps({**good, "event_id": "b2", "timestamp": "31/01/2024 noon"}), json.dumps({**good, "event_id": "b3", "amount": "five"})]
    folder = tmp_path / "in" / "billing.events"
    folder.mkdir(parents=True)
    (folder / "1.json").write_text("\n".join([json.dumps(good), *bad, bad[0]]))
    job = live.LiveJob(spark, str(tmp_path / "live"), clock=lambda: NOW)
    job.start(live.read_topics(spark, str(tmp_path / "in"), 1, ["billing.events"]), str(tmp_path / "cp")).awaitTermination()
    letters = job.table("dead_letters", job.LETTERS).collect()
    assert sorted(r["_raw"] for r in letters) == sorted(bad) and {r["_fatal_error"] for r in letters} == {"Malformed record"}
    totals = job.metrics().first()
    assert (totals.received, totals.consumed, totals.dead_lettered, totals.duplicates_dropped) == (6, 1, 4, 1)
    records = spark.createDataFrame([("billing.events", x.encode()) for x in (json.dumps(good), *bad)], "topic string, value binary")
    assert sorted(r["_raw"] for r in live.from_kafka(records).where("_raw IS NOT NULL").collect()) == sorted(bad)


def test_no_earlier_key_is_lost_when_batches_are_compacted(spark, tmp_path):
    """Copies of every earlier batch are dropped, before and after its keys are gathered."""
    feed = Feed(spark, tmp_path, compact_every=2)
    day = 86400
    for n in range(4):
        feed.send(product=[product(n, seconds=n * day), product(100 + n, seconds=0), product(200 + n, feature=None, seconds=0)],
                  billing=[billing(n)])
    state = storage.published(spark, f"{feed.job.root}/keys")
    assert int(state.marks["compacted"]) == 1 and len(storage.published_dates(state, "keys")) == 2
    feed.send(product=[product(n, seconds=n * day) for n in range(4)] + [product(100 + n, seconds=0) for n in range(4)]
              + [product(200 + n, feature=None, seconds=0) for n in range(4)], billing=[billing(n) for n in range(4)])
    totals = {r.topic: (r.received, r.consumed, r.dead_lettered, r.duplicates_dropped) for r in feed.job.metrics().collect()}
    assert totals == {"product.events": (24, 8, 4, 12), "billing.events": (8, 4, 0, 4)}
    assert feed.job.usage().count() == 8


def test_files_opened_for_a_batch_do_not_grow(spark, tmp_path):
    """Same dates again and again: what a batch reads of earlier ones is bounded by the compaction."""
    feed, opened = Feed(spark, tmp_path, compact_every=1), []
    for n in range(6):
        feed.send(product=[product(n, seconds=n)])
        opened.append(len(feed.job.keys("event", ["2024-01-31"], n + 1).inputFiles()))
    assert max(opened[3:]) <= max(opened[:3]) <= 3
    assert feed.job.keys("event", ["2024-01-31"], 6).count() == 6
    assert feed.job.keys("event", ["2023-01-01"], 6).count() == 0
    feed.job.compact(6)
    feed.job.compact(6)                                              # once more changes nothing
    assert [feed.job.keys(kind, None, 6).count() for kind in ("event", "usage", "letter")] == [6, 6, 0]


def test_no_job_only_counts(spark, tmp_path):
    """The log follows from rows observed while they are written."""
    feed = Feed(spark, tmp_path)
    feed.send(product=[product(1), product(1), product(2, feature=None)], support=[support(3, "low")])
    log = {r.topic: r for r in feed.job.table("batch_log", feed.job.LOG).collect()}
    assert (log["product.events"].received, log["product.events"].consumed, log["product.events"].dead_lettered) == (3, 1, 1)
    assert log["support.events"].max_ts == (T0 + timedelta(seconds=3)).replace(tzinfo=None) and set(log) == {"product.events", "support.events"}


def test_effects_of_batches_the_mart_holds_do_not_count_again(spark, tmp_path):
    root = str(tmp_path / "wh")
    feed = Feed(spark, tmp_path, warehouse=root)
    feed.send(billing=[billing(1)])
    feed.send(billing=[billing(2)])
    assert feed.health(mart(spark, ("a", 90)))["a"].health_score == 40.0
    storage.publish(spark, root, "r", [], NOW, marks={"live_batch": 0})
    assert feed.health(mart(spark, ("a", 65)))["a"].health_score == 40.0
    assert feed.job.finished() == 1 and feed.job.included() == 0


def test_copies_are_told_apart_without_the_envelope(spark, tmp_path):
    events = E.normalise(spark.createDataFrame(
        [("e1", "a", "high", T0), ("e1", "a", "medium", T0), ("e2", "b", "high", T0), (None, None, None, T0)],
        "event_id STRING, account_id STRING, severity STRING, timestamp TIMESTAMP"), "support.events")
    job = LiveJob(spark, str(tmp_path))
    narrow = events.withColumn("_error", F.lit(None).cast("string"))
    first = job._first_copies(narrow, "event", [], 0, storage.Published(), NOW)
    assert not {"_event_hash", "_published_at", "_retry_count", "_max_retries"} & set(first.columns)
    want = E.drop_copies(E.with_envelope(events, NOW))
    got = live._enveloped(first.drop("_error"), NOW)
    columns = sorted(want.columns)
    assert sorted(map(repr, got.select(columns).collect())) == sorted(map(repr, want.select(columns).collect()))


def test_unknown_keys_are_written_before_they_are_joined(spark, tmp_path):
    job = LiveJob(spark, str(tmp_path), known=lambda: {"account_id": spark.createDataFrame([("a",)], "account_id STRING")})
    events = E.normalise(spark.createDataFrame(
        [("e1", "a", "u", "f", T0), ("e2", "z", "u", "f", T0)],
        "event_id STRING, account_id STRING, user_id STRING, feature STRING, timestamp TIMESTAMP"), "product.events")
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    job.process(events, 0)
    assert [r.account_id for r in spark.read.parquet(f"{tmp_path}/unknown_account_id/batch_id=0").collect()] == ["z"]
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == split
    inbox = set(spark.read.parquet(f"{tmp_path}/inbox/batch_id=0").columns)
    assert inbox == {*E.EVENT_FIELDS, "_topic", "_raw", "_error"}
    assert [(r.event_id, r._event_hash) for r in job.table("accepted", job.ACCEPTED).collect()] == [
        (r.event_id, r._event_hash) for r in E.with_envelope(events, T0).where("event_id = 'e1'").collect()]
    assert [r._fatal_error for r in job.table("dead_letters", job.LETTERS).collect()] == ["Unknown account_id: z"]
