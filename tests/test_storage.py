import csv
import json
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal
from types import SimpleNamespace

import __spark_entry__ as contract
import pytest

from tests.conftest import SF
from tidemark import schemas as S
from tidemark.plans import daily
from tidemark.session import scratch_folder
from tidemark.sources import bronze, storage

T = datetime(2024, 1, 31, tzinfo=timezone.utc)


def test_create_tables_once(spark, tmp_path):
    assert set(storage.create_tables(spark, str(tmp_path))) == set(S.WAREHOUSE)
    assert storage.create_tables(spark, str(tmp_path)) == []
    assert spark.read.parquet(f"{tmp_path}/automation_alerts").schema["audit_history"].dataType.typeName() == "array"


def test_overwrite_and_partitions(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "date_add(DATE'2024-01-01', CAST(id % 3 AS INT)) AS event_date")
    path = f"{tmp_path}/t"
    storage.overwrite(df, path, "event_date")
    storage.overwrite(df.where("id < 4"), path, "event_date")
    back = spark.read.parquet(path)
    assert back.count() == 4
    plan = back.where("event_date = DATE'2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_csv_reads_back_by_plain_rules(spark, tmp_path):
    data = [("a", 'say "hi", ok', None, T), ("b", "", Decimal("1.50"), None), ("c", "line\nbreak", Decimal("2"), T)]
    df = spark.createDataFrame(data, "id STRING, text STRING, amount DECIMAL(10,2), at TIMESTAMP").coalesce(1)
    storage.export_csv(df, f"{tmp_path}/csv")
    (part,) = (tmp_path / "csv").glob("part-*")
    text = part.read_text()
    with part.open(newline="") as handle:
        rows = list(csv.reader(handle))
    assert rows == [["a", 'say "hi", ok', "", "2024-01-31T00:00:00.000000Z"], ["b", "", "1.50", ""],
                    ["c", "line\nbreak", "2.00", "2024-01-31T00:00:00.000000Z"]]
    assert 'b,"",1.50,\n' in text                                   # empty text is not null


def test_publish_is_all_or_nothing(spark, tmp_path, rows):
    root = str(tmp_path)
    one = lambda v: spark.createDataFrame([(v,)], "v INT")
    storage.stage(one(1), root, "r1", "x")
    storage.stage(one(2), root, "r1", "y")
    assert storage.read_published(spark, root, "x") is None
    storage.publish(spark, root, "r1", ["x", "y"], T)
    storage.stage(one(10), root, "r2", "x")                          # a run that never finishes
    assert rows(storage.read_published(spark, root, "x")) == [(1,)]
    storage.publish(spark, root, "r2", ["x"], T + timedelta(days=1))
    storage.register_published(spark, root)
    assert spark.sql("SELECT (SELECT v FROM x), (SELECT v FROM y)").first()[:] == (10, 2)


def test_jdbc_options():
    options = storage.jdbc_options("jdbc:postgresql://h/db", "t", column="id", lower=0, upper=100, partitions=4)
    assert options["numPartitions"] == "4" and options["partitionColumn"] == "id"
    with pytest.raises(ValueError):
        storage.jdbc_options("u", "t", column="id", lower=0, upper=1, partitions=0)


def session(shared, master):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: shared if key == "spark.checkpoint.dir" else default),
                           sparkContext=SimpleNamespace(master=master))


def test_scratch_folder(spark):
    assert scratch_folder(spark) != scratch_folder(spark)
    assert scratch_folder(session("hdfs://shared/", "yarn")).startswith("hdfs://shared/tidemark-")
    with pytest.raises(ValueError):
        scratch_folder(session(None, "yarn"))


def landing(root):
    """Twelve accounts; account 0 is in trouble, account 1 is near its quota."""
    when = lambda days, hours=0: (T - timedelta(days=days, hours=hours)).isoformat()
    n = 12
    accounts = [dict(account_id=f"acc_{i}", company_name=f"Company {i}", industry="x", size="1-50", region="EMEA",
                     owner="Kim", created_at=when(90), cohort="healthy") for i in range(n)]
    users = [dict(user_id=f"u{i}", account_id=f"acc_{i}", email=f"U@Acc{i}.com", role="admin", created_at=when(80))
             for i in range(n)] + [dict(user_id="stray", account_id="nobody")]
    subs = [dict(subscription_id=f"s{i}", account_id=f"acc_{i}", plan="Starter", start_date=when(90),
                 status="past_due" if i == 0 else "active", mrr=299.0) for i in range(n)]
    invoices = [dict(invoice_id=f"i{i}", account_id=f"acc_{i}", amount=299.0, due_date=when(5),
                     status="failed" if i == 0 else "paid", paid_at=when(6)) for i in range(n)]
    tickets = [dict(ticket_id=f"t{i}", account_id="acc_0", severity="Critical", status="open", created_at=when(3))
               for i in range(2)]
    events = [dict(event_id=f"e{a}_{i}", user_id=f"u{a}", account_id=f"acc_{a}", feature="api_call", timestamp=when(1 + i % 20, 1))
              for a in range(1, n) for i in range(250)]
    for name, rows in dict(accounts=accounts + accounts[:1], users=users, subscriptions=subs, invoices=invoices,
                           support_tickets=tickets, product_events=events + events[:5]).items():
        if name == "invoices":
            rows = rows + [{"invoice_id": "bad", "amount": "n/a"}]
        (root / f"{name}.json").write_text(json.dumps(rows, indent=1))


def test_daily_run_end_to_end(spark, tmp_path, rows):
    raw_dir, root = tmp_path / "raw", str(tmp_path / "wh")
    raw_dir.mkdir()
    landing(raw_dir)
    raw, rejected = bronze.read_landing(spark, str(raw_dir), lines=False)
    out = daily.run_daily(spark, raw, root, "run1", "2024-01-31 00:00:00", rejected)
    assert out["records_processed"] == 12 + 12 + 2 + 2750
    assert out["quality"]["status"] == "PASSED" and out["training"]["status"] == "trained"
    published = lambda name: storage.read_published(spark, root, name)
    assert rows(published("quarantine_invoices"), "_reason") == [("malformed record",)]
    assert rows(published("fact_usage").agg({"usage_id": "count"})) == [(2750,)]
    trouble = published("mrt_customer_health").where("account_id = 'acc_0'").first()
    assert (trouble.health_score, trouble.health_tier, trouble.critical_tickets) == (0.0, "Critical", 2)
    alerts = {r.alert_id for r in published("automation_alerts").collect()}
    assert alerts == {"alt_health_acc_0", "alt_bill_i0", "alt_sup_acc_0"}
    revenue = published("mrt_revenue_summary").first()
    assert (revenue.total_mrr, revenue.logo_churn_rate, revenue.active_accounts) == (Decimal("3289.00"), 8.33, 11)

    requests = spark.createDataFrame([("alt_bill_i0", "Kim", None), ("gone", "Kim", None)],
                                     "alert_id STRING, acknowledged_by STRING, notes STRING")
    errors = daily.acknowledge(spark, root, requests, "ack1", "2024-02-01 00:00:00")
    assert rows(errors, "alert_id") == [("gone",)]
    daily.run_daily(spark, raw, root, "run2", "2024-02-01 00:00:00", train_churn=False)
    state = {r.alert_id: (r.status, len(r.audit_history)) for r in published("automation_alerts").collect()}
    assert state["alt_bill_i0"] == ("acknowledged", 2) and state["alt_health_acc_0"] == ("open", 1)

    # a change made from alerts that are no longer the published ones is made again from those
    more = spark.createDataFrame([("alt_bill_i0", "Lee", None)], "alert_id STRING, acknowledged_by STRING, notes STRING")
    late = daily.Run(spark, root, "ack2")
    late.tables.append("automation_alerts")
    daily._publish_alerts(late, lambda x: daily.rules.acknowledge(x, more, "2024-02-02 00:00:00"), "run1")
    state = {r.alert_id: [e.acknowledged_by for e in r.audit_history] for r in published("automation_alerts").collect()}
    assert state["alt_bill_i0"] == [None, "Kim", "Lee"] and storage.current_runs(spark, root)["automation_alerts"] == "ack2"

    broken = {**raw, "accounts": raw["accounts"].drop("cohort")}
    with pytest.raises(Exception):
        daily.run_daily(spark, broken, root, "run3", "2024-02-02 00:00:00")
    assert set(storage.current_runs(spark, root).values()) == {"run1", "run2", "ack2"}
    audit = {r.run_id: (r.status, r.records_processed) for r in spark.read.parquet(f"{root}/{storage.RUN_AUDIT}").collect()}
    assert audit["run1"] == ("SUCCESS", 2776) and audit["run3"][0] == "FAILED"


def test_publishes_of_different_tables_do_not_undo_each_other(spark, tmp_path):
    root, at = str(tmp_path), datetime(2024, 1, 1, tzinfo=timezone.utc)
    storage.publish(spark, root, "a", ["x", "y"], at)
    storage.publish(spark, root, "b", ["y"], at + timedelta(hours=2), {"y": "a"})
    storage.publish(spark, root, "c", ["x"], at + timedelta(hours=1))
    assert storage.current_runs(spark, root) == {"x": "c", "y": "b"}
    with pytest.raises(storage.PublishConflict):
        storage.publish(spark, root, "d", ["y"], at + timedelta(hours=3), {"y": "a"})
    assert storage.current_runs(spark, root)["y"] == "b"


def test_of_two_writers_of_one_entry_one_publishes_again(spark, tmp_path, monkeypatch):
    """The second writer has read the log before the first one's entry; both are kept."""
    root = str(tmp_path)
    storage.publish(spark, root, "a", ["x", "y"], T, marks={"live": 1})
    create, other = storage.create_new, []

    def interleaved(spark, path, text):
        if not other:
            other.append(True)
            storage.publish(spark, root, "first", ["x"], T, {"x": "a"}, {"live": 2})
        return create(spark, path, text)

    monkeypatch.setattr(storage, "create_new", interleaved)
    assert storage.publish(spark, root, "second", ["y"], T, {"y": "a"}) == 2
    assert storage.published(spark, root) == storage.Published(2, {"x": "first", "y": "second"}, {"live": "2"})
    with pytest.raises(storage.PublishConflict):                      # both change the same table
        storage.publish(spark, root, "third", ["x"], T, {"x": "a"})
    assert storage.current_runs(spark, root)["x"] == "first"


def test_an_entry_is_created_once(spark, tmp_path):
    path = f"{tmp_path}/log/0.json"
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda i: storage.create_new(spark, path, f"writer {i}"), range(8)))
    assert made.count(True) == 1 and (tmp_path / "log" / "0.json").read_text() == f"writer {made.index(True)}"
    assert [p.name for p in (tmp_path / "log").iterdir() if not p.name.startswith(".")] == ["0.json"]


def test_dated_tables_write_their_dates_only(spark, tmp_path, rows):
    root, schema = str(tmp_path), "id BIGINT, event_date DATE"
    frame = lambda *r: spark.createDataFrame([(i, date.fromisoformat(d)) for i, d in r], schema)
    assert storage.read_dates(spark, root, "t", schema).count() == 0
    names = storage.stage_dates(frame((1, "2024-01-01"), (2, "2024-01-02")), root, "r1", "t")
    assert names == ["t/2024-01-01", "t/2024-01-02"]
    storage.publish(spark, root, "r1", names, T)
    names = storage.stage_dates(frame((2, "2024-01-02"), (3, "2024-01-02")), root, "r2", "t")
    assert rows(storage.read_dates(spark, root, "t", schema), "id") == [(1,), (2,)]   # not published yet
    storage.publish(spark, root, "r2", names, T)
    assert rows(storage.read_dates(spark, root, "t", schema), "id") == [(1,), (2,), (3,)]
    assert rows(storage.read_dates(spark, root, "t", schema, ["2024-01-02", "2024-01-09"]), "id") == [(2,), (3,)]
    files = storage.read_dates(spark, root, "t", schema, ["2024-01-02"]).inputFiles()
    assert files and all("run_id=r2/event_date=2024-01-02" in f for f in files)
    storage.publish(spark, root, "r3", [], T, removed=["t/2024-01-01"])
    assert storage.published_dates(storage.published(spark, root), "t") == ["2024-01-02"]


def test_partitioned_write_is_checked_on_every_date(spark, monkeypatch):
    whole = storage.overwrite
    monkeypatch.setattr(storage, "overwrite", lambda df, path, by: whole(df.where("event_date <> DATE'2024-01-03'"), path, by))
    with pytest.raises(ValueError, match="is not what was written"):
        contract.queries()["write_partitioned"](spark, SF)
