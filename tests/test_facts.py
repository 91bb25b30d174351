from datetime import datetime, timezone
from decimal import Decimal

import pytest

from tidemark.operators import facts, keyed
from tidemark.sources import bronze


def ts(text):
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


TICKETS = "ticket_id STRING, account_id STRING, severity STRING, status STRING, created_at TIMESTAMP, resolved_at TIMESTAMP"


def test_sla_boundaries(spark):
    start = ts("2024-01-01 00:00:00")
    data = [
        ("exact", "a", "critical", "resolved", start, ts("2024-01-01 12:00:00")),
        ("over", "a", "critical", "resolved", start, ts("2024-01-01 12:00:00.000001")),
        ("unknown_ok", "a", "urgent", "resolved", start, ts("2024-01-03 00:00:00")),
        ("unknown_over", "a", "urgent", "resolved", start, ts("2024-01-03 00:00:01")),
        ("upper", "a", "HIGH", "resolved", start, ts("2024-01-02 00:00:01")),
        ("open_young", "a", "low", "open", ts("2024-01-28 00:00:00"), None),
        ("open_old", "a", "low", "open", ts("2024-01-27 23:59:59"), None),
    ]
    out = facts.fact_support(spark.createDataFrame(data, TICKETS), "2024-01-31 00:00:00")
    breached = {r.ticket_id: (r.resolution_time_hours, r.sla_breached) for r in out.collect()}
    assert breached["exact"] == (12.0, False)
    assert breached["over"][1] is True and breached["over"][0] > 12.0
    assert breached["unknown_ok"] == (48.0, False)
    assert breached["unknown_over"][1] is True
    assert breached["upper"][1] is True
    assert breached["open_young"] == (None, False)
    assert breached["open_old"] == (None, True)


def test_overdue_and_days(spark):
    ddl = "invoice_id STRING, account_id STRING, amount DECIMAL(10,2), due_date TIMESTAMP, status STRING, paid_at TIMESTAMP"
    due, later = ts("2024-01-01 00:00:00"), ts("2024-02-10 00:00:00")
    data = [("i1", "a", Decimal("5"), due, "open", None), ("i2", "a", Decimal("5"), later, "open", None),
            ("i3", "a", Decimal("5"), later, "failed", None), ("i4", "a", Decimal("5"), due, "paid", due)]
    billing = facts.fact_billing(spark.createDataFrame(data, ddl), "2024-01-31 00:00:00")
    days = {r.invoice_id: (r.is_overdue, r.days_overdue)
            for r in facts.fact_billing_overdue_days(billing, "2024-01-31 00:00:00").collect()}
    assert days == {"i1": (True, 30), "i2": (False, 0), "i3": (True, 0), "i4": (False, 0)}


def test_keep_first_takes_arrival_order_and_groups_nulls(spark, rows):
    df = spark.createDataFrame([(1, "k", "b"), (0, "k", "a"), (2, None, "x"), (3, None, "y")], "_seq INT, id STRING, v STRING")
    assert rows(keyed.keep_first(df, ["id"], ["_seq"]), "id", "v") == [("k", "a"), (None, "x")]


def test_dedup_cuts_copies_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 3 AS k", "id AS v")
    plan = keyed.keep_first(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("spread", [None, ["id"]])
def test_foreign_keys(spark, rows, spread):
    events = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "id INT, account_id STRING")
    accounts = spark.createDataFrame([("a",), ("a",), ("c",)], "account_id STRING")
    assert rows(keyed.with_known_key(events, accounts, "account_id", spread_by=spread), "id") == [(1,), (2,)]
    assert rows(keyed.with_unknown_key(events, accounts, "account_id", spread_by=spread), "id") == [(3,), (4,)]


def test_attributes(spark, rows):
    events = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "id INT, account_id STRING")
    accounts = spark.createDataFrame([("a", "A"), ("c", "C")], "account_id STRING, name STRING")
    assert rows(keyed.with_attributes(events, accounts, "account_id", ["id"])) == [(1, "a", "A"), (2, "a", "A")]
    left = keyed.with_attributes(events, accounts, "account_id", ["id"], "left")
    assert rows(left, "id", "name") == [(1, "A"), (2, "A"), (3, None), (4, None)]


def test_upserts(spark, rows):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id INT, p STRING, q STRING")
    new = spark.createDataFrame([(2, "B", None), (3, "C", "Z")], "id INT, p STRING, q STRING")
    assert rows(keyed.insert_ignore(old, new, ["id"])) == [(1, "a", "x"), (2, "b", "y"), (3, "C", "Z")]
    assert rows(keyed.replace_rows(old, new, ["id"])) == [(1, "a", "x"), (2, "B", None), (3, "C", "Z")]
    assert rows(keyed.update_columns(old, new, ["id"], ["q"])) == [(1, "a", "x"), (2, "b", None), (3, "C", "Z")]


def test_high_water_mark(spark, rows):
    source = spark.createDataFrame([(1,), (2,), (3,)], "t INT")
    assert rows(keyed.above_high_water_mark(source, source.where("t < 3"), "t")) == [(3,)]
    assert rows(keyed.above_high_water_mark(source, source.where("t < 0"), "t")) == [(1,), (2,), (3,)]


def test_clean_drops_orphans_and_copies(spark, rows, tmp_path):
    accounts = '[{"account_id":"a","company_name":"A","created_at":"2024-01-01T00:00:00.000001+00:00"},{"account_id":"a","company_name":"later"}]'
    users = '[{"user_id":"u1","account_id":"a"},{"user_id":"u2","account_id":"zz"},{"user_id":"u3"}]'
    (tmp_path / "accounts.json").write_text(accounts)
    (tmp_path / "users.json").write_text(users)
    raw = {n: bronze.read_json_array_checked(spark, f"{tmp_path}/{n}.json", n).drop("_source_file", "_corrupt_record")
           for n in ("accounts", "users")}
    silver = facts.clean(raw)
    assert rows(silver["accounts"], "account_id", "company_name") == [("a", "A")]
    assert rows(silver["users"], "user_id") == [("u1",)]
    assert facts.dim_account(silver["accounts"]).first()["cohort"] == "healthy"


def test_quarantine_marks_only_the_bad_record(spark, rows, tmp_path):
    (tmp_path / "subs.json").write_text(
        '[\n  {"subscription_id":"s1",\n"account_id":"a","mrr":299.0},{"subscription_id":"s2","mrr":"abc"},\n'
        '{"subscription_id":"s3","mrr":999.00,"start_date":"2024-01-01T02:00:00+02:00"},{"account_id":"a"}]')
    parsed = bronze.read_json_array_checked(spark, f"{tmp_path}/subs.json", "subscriptions")
    good, bad = bronze.split_quarantine(parsed, "subscription_id")
    assert rows(good, "subscription_id", "mrr", "_seq") == [("s1", Decimal("299.00"), 0), ("s3", Decimal("999.00"), 2)]
    assert rows(bad, "_seq", "_reason") == [(1, "malformed record"), (3, "missing subscription_id")]
    assert good.where("subscription_id = 's3'").first()["start_date"] == datetime(2024, 1, 1)


def test_unreadable_file_is_quarantined(spark, rows, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "ok.json").write_text('[\n{"subscription_id":"s1"}\n]')
    (tmp_path / "in" / "none.json").write_text("[]")
    (tmp_path / "in" / "cut.json").write_text('[{"subscription_id":"s2"},\n{"subscri')
    parsed = bronze.read_json_array_checked(spark, f"{tmp_path}/in", "subscriptions")
    good, bad = bronze.split_quarantine(parsed, "subscription_id")
    assert rows(good, "subscription_id") == [("s1",)]
    (broken,) = bad.collect()
    assert broken["_reason"] == "malformed record" and broken["_source_file"].endswith("cut.json")


def test_json_lines_and_plain_array_agree(spark, rows, tmp_path):
    (tmp_path / "a.json").write_text('[{"account_id":"a","size":"1-50"},\n{"account_id":"b","size":"1000+"}]')
    (tmp_path / "a.jsonl").write_text('{"account_id":"a","size":"1-50"}\n\n{"account_id":"b","size":"1000+"}\n{broken\n')
    plain = bronze.read_json_array(spark, f"{tmp_path}/a.json", "accounts")
    lines, bad = bronze.split_quarantine(bronze.read_json_lines(spark, f"{tmp_path}/a.jsonl", "accounts"), "account_id")
    assert rows(plain, "account_id", "size") == rows(lines, "account_id", "size") == [("a", "1-50"), ("b", "1000+")]
    assert rows(bad, "_corrupt_record") == [("{broken",)]


def test_audit_columns_hash_the_content(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "k STRING, v INT")
    out = bronze.with_audit_columns(df, "2024-01-31 00:00:00", "crm").collect()
    assert out[0]["_raw_payload_hash"] == out[1]["_raw_payload_hash"] != out[2]["_raw_payload_hash"]
    assert out[0]["_source_channel"] == "crm"


def test_dim_date(spark):
    df = spark.createDataFrame([(ts("2024-03-02 23:00:00"),), (ts("2024-03-02 01:00:00"),), (None,)], "t TIMESTAMP")
    (row,) = facts.dim_date(df, "t").collect()
    assert (row.date_key, row.quarter, row.day_of_week, row.is_weekend) == ("2024-03-02", 1, 5, True)
