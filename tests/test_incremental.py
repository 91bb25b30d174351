"""Incremental runs against a full rebuild over everything that has arrived."""

import random
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.test_streaming import Feed
from tidemark import schemas as S
from tidemark.operators import usage
from tidemark.plans import daily, incremental
from tidemark.sources import storage

T = datetime(2024, 1, 31, tzinfo=timezone.utc)
N = 12


def ago(days, hours=0.0):
    return T - timedelta(days=days, hours=hours)


def frame(spark, name, rows, at):
    """Rows of a dataset with the time they were ingested."""
    schema = S.struct(S.BRONZE[name])
    data = [tuple(r.get(f) for f in schema.fieldNames()) for r in rows]
    return spark.createDataFrame(data, schema).withColumn("_ingested_at", F.lit(at).cast("timestamp"))


def event(i, account, when):
    return dict(event_id=f"e{i}", user_id=f"u{account}", account_id=f"acc_{account}", feature=f"f{i % 3}", timestamp=when)


def first_day():
    return dict(
        accounts=[dict(account_id=f"acc_{i}", company_name=f"C{i}", industry="x", size="1-50", region="EMEA", owner="Kim",
                       created_at=ago(90), cohort="healthy") for i in range(N)],
        users=[dict(user_id=f"u{i}", account_id=f"acc_{i}", email=f"u@{i}", role="admin", created_at=ago(80)) for i in range(N)],
        subscriptions=[dict(subscription_id=f"s{i}", account_id=f"acc_{i}", plan="Starter", start_date=ago(90), status="active", mrr=Decimal(299))
                       for i in range(N)],
        invoices=[dict(invoice_id=f"i{i}", account_id=f"acc_{i}", amount=Decimal(299), due_date=ago(1, 12 * (i % 2)), status="open") for i in range(N)],
        support_tickets=[dict(ticket_id=f"t{i}", account_id=f"acc_{i}", severity="Critical" if i < 3 else "Low", status="open", created_at=ago(4 + i))
                         for i in range(6)],
        product_events=[event(100 * a + i, a, ago(2 + i % 18, i % 7)) for a in range(N) for i in range(40)])


def second_day():
    """Later events, late ones, copies, new versions of a ticket, an invoice and a subscription, and a new account."""
    old = first_day()
    return dict(
        accounts=[dict(old["accounts"][0], account_id="acc_new", company_name="New")],
        users=[], subscriptions=[dict(old["subscriptions"][1], status="past_due")],
        invoices=[dict(old["invoices"][2], status="paid", paid_at=ago(0, 5))],
        support_tickets=[dict(old["support_tickets"][0], status="resolved", resolved_at=ago(0, 3)),
                         dict(ticket_id="t9", account_id="acc_new", severity="Critical", status="open", created_at=ago(0, 30))],
        product_events=[event(9000 + i, 3, ago(0, 1 + i * 0.4)) for i in range(20)] + [event(9100, 4, ago(6, 2)), event(9101, "new", ago(0, 2))]
        + old["product_events"][:7])


MARTS = ("mrt_customer_health", "mrt_revenue_summary", "usage_anomalies", "fact_billing", "dim_account", "alerts_fired")


def same(spark, rows, root, whole, drop=("calculated_at",)):
    for name in MARTS:
        a, b = (storage.read_published(spark, r, name) for r in (root, whole))
        columns = [c for c in a.columns if c not in drop]
        assert rows(a, *columns) == rows(b, *columns), name
    facts = storage.read_published(spark, whole, "fact_usage")
    columns = facts.columns
    assert rows(storage.read_dates(spark, root, "fact_usage", incremental.USAGE), *columns) == rows(facts, *columns)
    tickets = storage.read_published(spark, whole, "fact_support")
    assert rows(storage.read_dates(spark, root, "fact_support", incremental.SUPPORT, by="created_month"), *tickets.columns) == rows(tickets, *tickets.columns)
    hours = ("feature", "window_start", "window_end", "event_count")
    assert rows(storage.read_dates(spark, root, "usage_hours", incremental.HOURS), *hours) == rows(usage.tumbling(facts), *hours)
    spans = ("user_id", "session_start", "session_end", "event_count")
    assert rows(storage.read_dates(spark, root, "usage_sessions", incremental.SESSIONS, by="start_date"), *spans) == rows(usage.sessions(facts), *spans)


def rebuilt(spark, tmp_path, *days):
    """A full run over the newest version of every record."""
    newest = {}
    for day in days:
        for name, found in day.items():
            for r in found:
                key = r[S.BRONZE_KEYS[name]]
                if name != "product_events" or key not in newest.setdefault(name, {}):
                    newest.setdefault(name, {})[key] = r
    raw = {name: frame(spark, name, list(found.values()), T).drop("_ingested_at") for name, found in newest.items()}
    whole = str(tmp_path / "whole")
    daily.run_daily(spark, raw, whole, "all", "2024-01-31 00:00:00", train_churn=False)
    return whole


def test_second_day_writes_its_dates_and_equals_a_rebuild(spark, tmp_path, rows):
    root, one, two = str(tmp_path / "wh"), first_day(), second_day()
    first = {name: frame(spark, name, found, "2024-01-30 00:00:00") for name, found in one.items()}
    incremental.run_increment(spark, first, root, "day1", "2024-01-30 00:00:00")
    before = storage.published(spark, root)
    # the landing still holds the first day; the mark leaves it out
    both = {name: first[name].unionByName(frame(spark, name, two[name], "2024-01-31 00:00:00")) for name in one}
    out = incremental.run_increment(spark, both, root, "day2", "2024-01-31 00:00:00")
    after = storage.published(spark, root)
    touched = [d for d in storage.published_dates(after, "fact_usage") if after.runs[f"fact_usage/{d}"] == "day2"]
    assert touched == ["2024-01-24", "2024-01-30"] and len(storage.published_dates(after, "fact_usage")) == 20
    assert all(after.runs[n] == before.runs[n] for n in before.runs if n.startswith(("fact_usage/", "usage_days/")) and n[-10:] not in touched)
    assert after.runs["dim_user"] == "day2" and out["quality"]["total_checks"] == 6
    assert spark.read.parquet(f"{root}/run_id=day2/arrived_product_events").count() == 29
    same(spark, rows, root, rebuilt(spark, tmp_path, one, two))
    # nothing new: no date is written; and a run that began before another one ended is not published over it
    late = incremental.Increment(spark, root, "late", "2024-01-31 00:00:00", None)
    late.state = before
    late.tables = ["fact_usage/2024-01-24"]
    with pytest.raises(storage.PublishConflict):
        late.finish(T, {})
    incremental.run_increment(spark, both, root, "day3", "2024-01-31 00:00:00")
    assert "day3" not in {r for n, r in storage.published(spark, root).runs.items() if "/" in n and not n.startswith(("fact_support", "support_counts"))}


def test_late_live_events_restate_their_dates(spark, tmp_path, rows):
    """Live facts join the warehouse; late ones rebuild the dates they fell into, and count once."""
    root, one = str(tmp_path / "wh"), first_day()
    first = {name: frame(spark, name, found, "2024-01-30 00:00:00") for name, found in one.items()}
    incremental.run_increment(spark, first, root, "day1", "2024-01-30 00:00:00")
    feed = Feed(spark, tmp_path, warehouse=root)
    shown = lambda e: {**e, "timestamp": e["timestamp"].isoformat()}
    now, late = [event(9000 + i, 3, ago(0, 20 - i * 0.5)) for i in range(20)], [event(9100, 4, ago(6, 2)), event(9101, 5, ago(9, 1))]
    feed.send(product=[shown(e) for e in now])
    feed.send(product=[shown(e) for e in late])
    assert [str(r[0]) for r in feed.job.dates_to_restate().orderBy("event_date").collect()] == ["2024-01-21", "2024-01-24"]
    incremental.run_increment(spark, {}, root, "day2", "2024-01-31 00:00:00", live=feed.job)
    runs = storage.published(spark, root).runs
    assert [n[-10:] for n, r in sorted(runs.items()) if n.startswith("fact_usage/") and r == "day2"] == ["2024-01-21", "2024-01-24", "2024-01-30"]
    same(spark, rows, root, rebuilt(spark, tmp_path, one, {"product_events": now + late}))
    assert feed.job.included() == 1 and feed.job.dates_to_restate().count() == 0
    mart = storage.read_published(spark, root, "mrt_customer_health")
    assert rows(feed.job.current_health(mart), "account_id", "events_last_30d") == rows(mart, "account_id", "events_last_30d")


@pytest.mark.parametrize("seed", [1, 2])
def test_sessions_merge_as_if_built_at_once(spark, rows, seed):
    r = random.Random(seed)
    events = [(r.choice("abc"), T + timedelta(minutes=r.randrange(0, 4000))) for _ in range(300)]
    events += [("a", T), ("a", T + timedelta(hours=1)), ("a", T + timedelta(minutes=59, seconds=59))]
    r.shuffle(events)
    df = lambda part: spark.createDataFrame(part, "user_id STRING, event_timestamp TIMESTAMP")
    columns = ("user_id", "session_start", "session_end", "event_count")
    stored = usage.sessions(df(events[:100])).select(*columns)
    for part in (events[100:103], events[103:]):
        merged, hit = incremental.merge_sessions(stored, usage.sessions(df(part)).select(*columns))
        left = stored.join(hit, ["user_id", "session_start"], "left_anti").unionByName(merged)
        stored = spark.createDataFrame(left.collect(), stored.schema)
    assert rows(stored, *columns) == rows(usage.sessions(df(events)), *columns)


def test_only_months_whose_breaches_may_differ_are_judged_again(spark, tmp_path, rows):
    root = str(tmp_path / "wh")
    ticket = lambda i, severity, created, resolved=None: dict(
        ticket_id=f"t{i}", account_id="a", severity=severity, status="resolved" if resolved else "open", created_at=created, resolved_at=resolved)
    landed = [ticket(1, "Critical", ago(100)), ticket(2, "Low", ago(99), ago(98)), ticket(3, "Low", ago(1)), ticket(4, "High", ago(60), ago(58)),
              ticket(5, "Low", None)]

    def judged(run_id, days_later, tickets=None):
        run = incremental.Increment(spark, root, run_id, (T + timedelta(days=days_later)).strftime("%Y-%m-%d %H:%M:%S"), None)
        run._support(tickets)
        storage.publish(spark, root, run_id, run.tables, T)
        return rows(storage.read_dates(spark, root, "fact_support", incremental.SUPPORT, by="created_month"), "ticket_id", "sla_breached"), {
            n.split("/")[1][:7] for n, r in storage.published(spark, root).runs.items() if n.startswith("fact_support/") and r == run_id}

    first = [("t1", True), ("t2", False), ("t3", False), ("t4", True), ("t5", None)]
    assert judged("day1", 0, frame(spark, "support_tickets", landed, T))[0] == first
    assert judged("day2", 1) == (first, {"2024-01"})  # t1 and t4 are breached for good
    third = [(n, b or n == "t3") if b is not None else (n, b) for n, b in first]
    assert judged("day3", 3) == (third, {"2024-01"})
    assert judged("day4", 9) == (third, set())
    assert judged("back", -1) == (first, {"2023-10", "2024-01"})  # at an earlier time than the last
    assert judged("day5", 9, frame(spark, "support_tickets", [dict(landed[0], resolved_at=ago(99.9), status="resolved")], T))[0] == [("t1", False), *third[1:]]


def test_rows_without_copies_are_not_ranked(spark, tmp_path, rows):
    accounts = frame(spark, "accounts", first_day()["accounts"], T)
    invoice = lambda i, account, amount: dict(invoice_id=i, account_id=account, amount=Decimal(amount), status="open")
    old = [invoice("i1", "acc_1", 1), invoice("i2", "acc_2", 2), invoice("i3", "nobody", 3), invoice("i4", None, 4), invoice(None, "acc_3", 5)]
    new = [invoice("i1", "acc_1", 9), invoice("i1", "acc_1", 9), invoice(None, "acc_4", 6)]
    run = incremental.Increment(spark, str(tmp_path / "wh"), "r", "2024-01-31 00:00:00", None)
    arrived = {"accounts": accounts, "invoices": frame(spark, "invoices", old, ago(1)).unionByName(frame(spark, "invoices", new, T)),
               "users": frame(spark, "users", [], T)}
    one = run._one_a_key(arrived)
    assert spark.read.parquet(f"{run.root}/run_id=r/repeated_keys").count() == 2
    assert rows(one["invoices"], "invoice_id", "amount") == sorted(
        [("i1", Decimal(9)), ("i2", Decimal(2)), ("i3", Decimal(3)), ("i4", Decimal(4)), (None, Decimal(6))], key=repr)
    known = run._of_accounts({"invoices": one["invoices"]}, arrived, accounts)["invoices"]
    assert known.columns == arrived["invoices"].columns
    assert rows(known, "invoice_id") == sorted([("i1",), ("i2",), (None,)], key=repr)
    assert rows(spark.read.parquet(f"{run.root}/run_id=r/unknown_accounts")) == [("nobody",)]
