import json
from datetime import datetime
from decimal import Decimal

from tidemark import schemas as S
from tidemark.operators import quality, rules
from tidemark.operators.churn import churn_risk_tiers, train_churn_model, FEATURES

AS_OF, LATER = "2024-01-31 00:00:00", "2024-02-01 00:00:00"
HEALTH = "account_id STRING, company_name STRING, csm_owner STRING, plan STRING, health_score DOUBLE, events_last_30d BIGINT, critical_tickets BIGINT"


def fired(spark):
    mart = spark.createDataFrame([("a", "Acme", "Kim", "Starter", 45.0, 4250, 2), ("b", "Bolt", "Lee", "Starter", 50.0, 4249, 1)], HEALTH)
    billing = spark.createDataFrame([("i1", "a", Decimal("7499"), None, None, "failed", True)], S.WAREHOUSE["fact_billing"])
    accounts = mart.select("account_id", "company_name")
    plans = spark.createDataFrame([("Starter", Decimal("299"), 5, 50_000)], S.WAREHOUSE["dim_plan"])
    return rules.evaluate(mart, billing, accounts, plans, AS_OF)


def test_rules(spark):
    got = {r.alert_id: r for r in fired(spark).collect()}
    assert set(got) == {"alt_health_a", "alt_bill_i1", "alt_upsell_a", "alt_sup_a"}
    assert got["alt_health_a"].trigger_reason == "Account health score deteriorated to 45.0 (Critical tier)."
    assert got["alt_bill_i1"].trigger_reason == "Invoice i1 for $7,499.00 failed to clear."
    assert got["alt_bill_i1"].audit_history[0].detail == "Automated billing workflow triggered for $7499.00"
    assert got["alt_sup_a"].trigger_reason == "Account has 2 unresolved critical support incidents."
    assert got["alt_sup_a"].audit_history[0].detail == "2 critical unresolved tickets"
    assert {r.owner for r in got.values()} == {"Kim", "Finance Operations", "Account Executive Team"}


def requests(spark, *data):
    return spark.createDataFrame(list(data), "alert_id STRING, acknowledged_by STRING, notes STRING")


def test_acknowledgement_survives_a_refire(spark):
    stored = fired(spark).select(*rules.ALERT_COLUMNS)
    batch = requests(spark, ("alt_health_a", "Kim", "called"), ("alt_sup_a", "", ""), ("nope", "Kim", None))
    once = rules.acknowledge(stored, batch, LATER)
    assert [r.alert_id for r in rules.acknowledge_errors(stored, batch).collect()] == ["nope"]
    rows = {r.alert_id: r for r in once.collect()}
    assert rows["alt_health_a"].status == "acknowledged" and rows["alt_upsell_a"].status == "open"
    entry = rows["alt_sup_a"].audit_history[-1]
    assert (entry.acknowledged_by, entry.detail, entry.notes) == ("CSM Agent", "Alert acknowledged by CSM Agent", None)
    twice = rules.acknowledge(once, requests(spark, ("alt_health_a", "Lee", None)), LATER)
    refired = rules.upsert_alerts(twice, fired(spark).withColumn("trigger_reason", rules.F.lit("new")))
    row = refired.where("alert_id = 'alt_health_a'").first()
    assert (row.status, row.trigger_reason) == ("acknowledged", "new")
    assert [e.action for e in row.audit_history] == ["TRIGGERED", "ACKNOWLEDGED", "ACKNOWLEDGED"]
    assert refired.count() == 4


def test_history_json(spark):
    text = rules.history_to_json(fired(spark).where("alert_id = 'alt_health_a'"))
    assert "notes" not in json.loads(text.first().audit_history)[0]
    back = rules.history_from_json(text).first().audit_history
    assert back[0].action == "TRIGGERED" and back[0].timestamp == datetime(2024, 1, 31)
    broken = rules.history_from_json(text.withColumn("audit_history", rules.F.lit("{not json")))
    assert broken.first().audit_history == []
    again = rules.acknowledge(broken, requests(spark, ("alt_health_a", "Kim", None)), LATER)
    assert len(again.first().audit_history) == 1


def test_outbox(spark):
    lists = {"health_alert": rules.parse_recipients(" x@e.com, ,y@e.com "), "upsell": ["z@e.com"]}
    out = [(r.alert_id, r.kind, r.target, r.title, r.colour, r.status) for r in rules.notification_outbox(fired(spark), lists, True).collect()]
    assert ("alt_health_a", "slack", "#csm-urgent-retention", "[CRITICAL] Health Alert: Acme", "#e01e5a", "DISPATCHED") in out
    assert ("alt_upsell_a", "teams", "expansion-desk", "Upsell Opportunity: Acme", None, "DISPATCHED") in out
    assert ("alt_health_a", "email", "y@e.com", "Health Alert: Acme", None, "SIMULATED") in out
    assert ("alt_bill_i1", "email", None, "Billing Failure: Acme", None, "SKIPPED") in out
    assert len(out) == 4 + 2 + 1 + 1 + 1
    off = rules.notification_outbox(fired(spark), lists).where("kind = 'email' AND status = 'DISABLED'")
    assert off.count() == 3


def test_quality_isolates_a_broken_check(spark):
    accounts = spark.createDataFrame([("a",), ("a",)], "account_id STRING")
    checks = [
        ("dup", "Uniqueness", lambda: quality.unique(accounts, "account_id", "dup", "d")),
        ("broken", "Completeness", lambda: quality.not_null(accounts, ["missing_column"], "broken", "d")),
        ("fails_late", "Volume", lambda: quality.in_range(accounts, rules.F.raise_error(rules.F.lit("boom")).cast("boolean"), "fails_late", "d")),
        ("volume", "Volume", lambda: quality.min_rows(accounts, 1, "volume")),
    ]
    results = quality.run_checks(spark, checks)
    got = {r.test_name: r for r in results.collect()}
    assert (got["dup"].passed, got["dup"].failed_count) == (False, 1)
    assert not got["broken"].passed and "missing_column" in got["broken"].error
    assert not got["fails_late"].passed and "boom" in got["fails_late"].error
    assert got["volume"].passed and got["volume"].details == "Fact usage table contains 2 events (target > 1)"
    report = quality.report(results, AS_OF).first()
    assert (report.status, report.total_checks, report.passed_checks, report.failed_checks) == ("WARNING", 4, 1, 3)


def test_quality_all_pass_on_empty(spark):
    empty = spark.createDataFrame([], "account_id STRING, status STRING")
    checks = [("u", "U", lambda: quality.unique(empty, "account_id", "u", "")),
              ("r", "R", lambda: quality.references(empty, "account_id", empty, "account_id", "r", "")),
              ("v", "V", lambda: quality.accepted_values(empty, "status", ("x",), "v"))]
    assert quality.report(quality.run_checks(spark, checks), AS_OF).first().status == "PASSED"


def features(spark, n, positives):
    data = [(f"a{i}", 100 if i < positives else 900, 3, i % 4, 0, 100.0, 299.0, 0, int(i < positives)) for i in range(n)]
    ddl = "account_id STRING, events_last_30d BIGINT, active_users_30d BIGINT, open_tickets BIGINT, critical_tickets BIGINT, sla_compliance_rate DOUBLE, mrr DOUBLE, is_payment_failed INT, churn_label INT"
    return spark.createDataFrame(data, ddl)


def test_churn_training(spark):
    assert train_churn_model(features(spark, 9, 3))[1]["reason"] == "not enough rows"
    assert train_churn_model(features(spark, 20, 0))[1]["reason"] == "only one class"
    model, report = train_churn_model(features(spark, 100, 40), trees=5)
    assert model is not None and report["roc_auc"] == 1.0 and report["accuracy"] == 1.0
    assert report["tp"] == 8 and report["tn"] == 12
    assert max(report["feature_importances"], key=report["feature_importances"].get) == FEATURES[0]


def test_risk_tiers(spark):
    df = spark.createDataFrame([("a", 0.7), ("b", 0.6999), ("c", 0.4), ("d", 0.39), ("e", None)], "account_id STRING, churn_probability DOUBLE")
    got = {r.account_id: (r.risk_tier, r.recommended_action) for r in churn_risk_tiers(df).collect()}
    assert got == {"a": ("High", "Schedule Executive Retention Review"), "b": ("Medium", "Schedule Customer Success Check-in"),
                   "c": ("Medium", "Schedule Customer Success Check-in"), "d": ("Low", "Continue Monitoring"),
                   "e": ("Unknown", "Train churn model first")}


def test_every_request_for_an_alert_is_kept(spark):
    from datetime import datetime
    stored = spark.createDataFrame([("alt_1", "open", None, None), ("alt_2", "open", None, None)],
                                   f"alert_id STRING, status STRING, acknowledged_at TIMESTAMP, audit_history ARRAY<{rules._ENTRY}>")
    batch = spark.createDataFrame([("alt_1", "Lee", "second", datetime(2024, 2, 1, 9)), ("alt_1", "Kim", "first", datetime(2024, 2, 1, 8)),
                                   ("alt_1", None, None, None)], "alert_id STRING, acknowledged_by STRING, notes STRING, requested_at TIMESTAMP")
    got = {r.alert_id: r for r in rules.acknowledge(stored, batch, "2024-02-01 08:30:00").collect()}
    assert [(e.acknowledged_by, e.notes) for e in got["alt_1"].audit_history] == [("Kim", "first"), ("CSM Agent", None), ("Lee", "second")]
    assert got["alt_1"].acknowledged_at == datetime(2024, 2, 1, 9) and got["alt_2"].status == "open"
