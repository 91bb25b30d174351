"""Decision rules, the alert lifecycle and the notification outbox."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators.keyed import update_columns, with_attributes

# Fixed values.
HEALTH_ALERT_BELOW = 50.0
QUOTA_SHARE = 0.85
EVENT_SCALE = 10
CRITICAL_TICKETS_FROM = 2

ALERT_COLUMNS = (
    "alert_id", "account_id", "alert_type", "severity", "trigger_reason", "status", "owner",
    "created_at", "acknowledged_at", "audit_history",
)

_ENTRY = (
    "struct<action:string,timestamp:timestamp,acknowledged_by:string,detail:string,notes:string>"
)


def _history_entry(action: str, at: Column, by: Column, detail: Column, notes: Column) -> Column:
    return F.struct(F.lit(action).alias("action"), at.alias("timestamp"), by.alias("acknowledged_by"),
                    detail.alias("detail"), notes.alias("notes")).cast(_ENTRY)


def _alerts(rows: DataFrame, as_of, *, alert_id: Column, alert_type: str, severity: str, reason: Column,
            owner: Column, detail: Column) -> DataFrame:
    at, none = C.as_timestamp(as_of), F.lit(None).cast("string")
    return rows.select(
        alert_id.alias("alert_id"), "account_id", F.lit(alert_type).alias("alert_type"),
        F.lit(severity).alias("severity"), reason.alias("trigger_reason"), F.lit("open").alias("status"),
        owner.alias("owner"), at.alias("created_at"), F.lit(None).cast("timestamp").alias("acknowledged_at"),
        F.array(_history_entry("TRIGGERED", at, none, detail, none)).alias("audit_history"),
        F.col("company_name"),
    )


def rule_health_drop(health: DataFrame, as_of, below: float = HEALTH_ALERT_BELOW) -> DataFrame:
    return _alerts(
        health.where(F.col("health_score") < below), as_of,
        alert_id=F.concat(F.lit("alt_health_"), F.col("account_id")),
        alert_type="CSM Alert", severity="critical",
        reason=F.concat(F.lit("Account health score deteriorated to "), F.col("health_score").cast("string"),
                        F.lit(" (Critical tier).")),
        owner=F.col("csm_owner"), detail=F.lit("Automated rule evaluated: health score < 50"),
    )


def rule_payment_failure(billing: DataFrame, accounts: DataFrame, as_of) -> DataFrame:
    failed = billing.where(F.col("status") == "failed").select("invoice_id", "account_id", "amount")
    named = with_attributes(failed, accounts.select("account_id", "company_name"), "account_id", ["invoice_id"])
    return _alerts(
        named, as_of,
        alert_id=F.concat(F.lit("alt_bill_"), F.col("invoice_id")),
        alert_type="Payment Failure", severity="high",
        reason=F.concat(F.lit("Invoice "), F.col("invoice_id").cast("string"), F.lit(" for "),
                        C.money_text(F.col("amount")), F.lit(" failed to clear.")),
        owner=F.lit("Finance Operations"),
        detail=F.concat(F.lit("Automated billing workflow triggered for "), C.plain_money_text(F.col("amount"))),
    )


def rule_upsell(health: DataFrame, plans: DataFrame, as_of, quota_share: float = QUOTA_SHARE) -> DataFrame:
    quota = plans.select(F.col("plan_name").alias("plan"), "event_quota")
    near_quota = health.join(quota, "plan").where(
        F.col("events_last_30d") * EVENT_SCALE >= F.col("event_quota") * F.lit(quota_share))
    return _alerts(
        near_quota, as_of,
        alert_id=F.concat(F.lit("alt_upsell_"), F.col("account_id")),
        alert_type="Upsell Recommendation", severity="medium",
        reason=F.concat(F.lit("Account telemetry exceeded 85% of plan quota ("), F.col("plan"),
                        F.lit("). Prime candidate for plan upgrade.")),
        owner=F.lit("Account Executive Team"),
        detail=F.lit("Telemetry usage threshold breached quota limit"),
    )


def rule_support(health: DataFrame, as_of, critical_from: int = CRITICAL_TICKETS_FROM) -> DataFrame:
    count = F.col("critical_tickets").cast("string")
    return _alerts(
        health.where(F.col("critical_tickets") >= critical_from), as_of,
        alert_id=F.concat(F.lit("alt_sup_"), F.col("account_id")),
        alert_type="Support Deterioration", severity="critical",
        reason=F.concat(F.lit("Account has "), count, F.lit(" unresolved critical support incidents.")),
        owner=F.col("csm_owner"), detail=F.concat(count, F.lit(" critical unresolved tickets")),
    )


def rule_critical_backlog(support: DataFrame, accounts: DataFrame, as_of, more_than: int = 3,
                          hours: float = 48.0) -> DataFrame:
    """Accounts with more than ``more_than`` critical tickets open for over ``hours``."""
    age = C.hours_between(F.col("created_at"), C.as_timestamp(as_of))
    stuck = support.where((F.col("severity") == "critical") & F.col("resolved_at").isNull() & (age > hours))
    counts = stuck.groupBy("account_id").agg(F.count(F.lit(1)).alias("critical_backlog")).where(
        F.col("critical_backlog") > more_than)
    return counts.join(accounts.select("account_id", "company_name", "csm_owner"), "account_id")


def backlog_alerts(support: DataFrame, accounts: DataFrame, as_of, more_than: int = 3, hours: float = 48.0) -> DataFrame:
    """An alert for every account with such a backlog."""
    count = F.col("critical_backlog").cast("string")
    return _alerts(
        rule_critical_backlog(support, accounts, as_of, more_than, hours), as_of,
        alert_id=F.concat(F.lit("alt_backlog_"), F.col("account_id")),
        alert_type="Support Deterioration", severity="critical",
        reason=F.concat(F.lit("Account has "), count, F.lit(f" critical tickets unresolved for over {hours:g} hours.")),
        owner=F.col("csm_owner"), detail=F.concat(count, F.lit(" critical tickets in the backlog")),
    )


def drop_alerts(drops: DataFrame, accounts: DataFrame, as_of) -> DataFrame:
    """An alert for every account day of ``health.health_drops``."""
    named = drops.join(accounts.select("account_id", "company_name", "csm_owner"), "account_id")
    day = F.date_format("date_key", "yyyy-MM-dd")
    return _alerts(
        named, as_of,
        alert_id=F.concat(F.lit("alt_drop_"), F.col("account_id"), F.lit("_"), day),
        alert_type="CSM Alert", severity="high",
        reason=F.concat(F.lit("Account health score fell by "), F.col("drop_pct").cast("string"), F.lit("% within a week to "),
                        F.col("health_score").cast("string"), F.lit(".")),
        owner=F.col("csm_owner"), detail=F.concat(F.lit("Weekly fall seen on "), day),
    )


def evaluate(health: DataFrame, billing: DataFrame, accounts: DataFrame, plans: DataFrame, as_of) -> DataFrame:
    """Alerts of all four rules."""
    return reduce(DataFrame.unionByName, [
        rule_health_drop(health, as_of), rule_payment_failure(billing, accounts, as_of),
        rule_upsell(health, plans, as_of), rule_support(health, as_of),
    ])


# ------------------------------------------------------------ alert lifecycle

def upsert_alerts(stored: DataFrame, fired: DataFrame) -> DataFrame:
    """Add new alerts; a re-fired one only renews severity and reason, so an
    acknowledgement and its history survive."""
    return update_columns(stored.select(*ALERT_COLUMNS), fired.select(*ALERT_COLUMNS), ["alert_id"],
                          ["severity", "trigger_reason"])


def acknowledge(stored: DataFrame, requests: DataFrame, as_of) -> DataFrame:
    """Apply a batch of (alert_id, acknowledged_by, notes) to the alert table.

    Every request adds a history entry, in the order of their times; a request
    without ``requested_at`` counts as made at ``as_of``.  Requests of one time
    follow by name and notes.
    """
    at = C.as_timestamp(as_of)
    made = F.coalesce(C.as_timestamp(F.col("requested_at")), at) if "requested_at" in requests.columns else at
    by = F.coalesce(C.blank_to_null(F.col("acknowledged_by")), F.lit("CSM Agent"))
    single = requests.select("alert_id", F.struct(made.alias("at"), by.alias("by"), C.blank_to_null(F.col("notes")).alias("notes")).alias("_one"))
    grouped = single.groupBy("alert_id").agg(F.sort_array(F.collect_list("_one")).alias("_requests"))
    entries = F.transform("_requests", lambda r: _history_entry(
        "ACKNOWLEDGED", r["at"], r["by"], F.concat(F.lit("Alert acknowledged by "), r["by"]), r["notes"]))
    history = F.coalesce(F.col("audit_history"), F.array().cast(f"array<{_ENTRY}>"))
    hit = F.col("_requests").isNotNull()
    return stored.join(grouped, "alert_id", "left").select(*[
        F.when(hit, F.lit("acknowledged")).otherwise(F.col("status")).alias("status") if c == "status"
        else F.when(hit, F.element_at("_requests", -1)["at"]).otherwise(F.col(c)).alias(c) if c == "acknowledged_at"
        else F.when(hit, F.concat(history, entries)).otherwise(F.col(c)).alias(c) if c == "audit_history"
        else F.col(c)
        for c in stored.columns
    ])


def acknowledge_errors(stored: DataFrame, requests: DataFrame) -> DataFrame:
    """Requests for alerts that do not exist."""
    return requests.join(stored.select("alert_id"), "alert_id", "left_anti").withColumn(
        "error", F.lit("Alert not found"))


def history_to_json(alerts: DataFrame) -> DataFrame:
    """Audit history as JSON text; absent notes are left out."""
    return alerts.withColumn("audit_history", F.to_json("audit_history"))


def history_from_json(alerts: DataFrame) -> DataFrame:
    """Parse stored JSON history; malformed text becomes an empty history."""
    parsed = F.from_json("audit_history", f"array<{_ENTRY}>")
    return alerts.withColumn("audit_history", F.coalesce(parsed, F.array().cast(f"array<{_ENTRY}>")))


# -------------------------------------------------------------------- outbox

# Alert type, chat target, title prefix, e-mail list.
ROUTES = (
    ("CSM Alert", "slack", "#csm-urgent-retention", "Health Alert: ", "health_alert"),
    ("Payment Failure", "slack", "#billing-dunning-ops", "Billing Failure: ", "payment_failure"),
    ("Upsell Recommendation", "teams", "expansion-desk", "Upsell Opportunity: ", "upsell"),
    ("Support Deterioration", "slack", "#support-escalations", "Support Deterioration: ", "support_escalation"),
)
COLOURS = {"critical": "#e01e5a", "high": "#ecb22e"}
OTHER_COLOUR = "#2eb886"


def parse_recipients(text: str | None) -> list[str]:
    """Addresses of a comma-separated setting."""
    return [part.strip() for part in (text or "").split(",") if part.strip()]


def notification_outbox(alerts: DataFrame, recipients: Mapping[str, Sequence[str]] | None = None,
                        email_enabled: bool = False) -> DataFrame:
    """Messages to send for fired alerts: one chat row and one e-mail row per
    recipient (a single SKIPPED row without recipients)."""
    recipients = recipients or {}
    spark = alerts.sparkSession
    routes = spark.createDataFrame(
        [(*r[:4], list(recipients.get(r[4], []))) for r in ROUTES],
        "alert_type string, chat string, channel string, prefix string, mail_to array<string>")
    routed = alerts.join(F.broadcast(routes), "alert_type")  # four rows
    title = F.concat("prefix", "company_name")
    is_slack = F.col("chat") == "slack"
    chat = F.struct(
        F.col("chat").alias("kind"), F.col("channel").alias("target"),
        F.when(is_slack, F.concat(F.lit("["), F.upper("severity"), F.lit("] "), title)).otherwise(title).alias("title"),
        F.when(is_slack, C.lookup(F.col("severity"), COLOURS, OTHER_COLOUR)).alias("colour"),
        F.lit("DISPATCHED").alias("status"),
    )

    def mail(to: Column, status: str) -> Column:
        return F.struct(F.lit("email").alias("kind"), to.cast("string").alias("target"), title.alias("title"),
                        F.lit(None).cast("string").alias("colour"), F.lit(status).alias("status"))

    sent = "SIMULATED" if email_enabled else "DISABLED"
    mails = F.when(F.size("mail_to") == 0, F.array(mail(F.lit(None), "SKIPPED"))).otherwise(
        F.transform("mail_to", lambda to: mail(to, sent)))
    return routed.select("alert_id", "alert_type", "severity", "trigger_reason",
                         F.explode(F.concat(F.array(chat), mails)).alias("m")).select(
        "alert_id", "alert_type", "severity", F.col("m.kind").alias("kind"), F.col("m.target").alias("target"),
        F.col("m.title").alias("title"), F.col("m.colour").alias("colour"),
        F.col("trigger_reason").alias("message"), F.col("m.status").alias("status"))
