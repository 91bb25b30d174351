"""Table schemas, accepted values and thresholds of the subscription domain."""

from __future__ import annotations

from pyspark.sql.types import StructType

# ---------------------------------------------------------------- raw inputs
BRONZE = {
    "accounts": (
        "account_id STRING, company_name STRING, industry STRING, size STRING, region STRING, "
        "owner STRING, created_at TIMESTAMP, cohort STRING"
    ),
    "users": "user_id STRING, account_id STRING, email STRING, role STRING, created_at TIMESTAMP",
    "subscriptions": (
        "subscription_id STRING, account_id STRING, plan STRING, start_date TIMESTAMP, "
        "status STRING, mrr DECIMAL(10,2)"
    ),
    "invoices": (
        "invoice_id STRING, account_id STRING, amount DECIMAL(10,2), due_date TIMESTAMP, "
        "status STRING, paid_at TIMESTAMP"
    ),
    "support_tickets": (
        "ticket_id STRING, account_id STRING, severity STRING, status STRING, "
        "created_at TIMESTAMP, resolved_at TIMESTAMP"
    ),
    "product_events": (
        "event_id STRING, user_id STRING, account_id STRING, feature STRING, timestamp TIMESTAMP"
    ),
}

BRONZE_KEYS = {
    "accounts": "account_id",
    "users": "user_id",
    "subscriptions": "subscription_id",
    "invoices": "invoice_id",
    "support_tickets": "ticket_id",
    "product_events": "event_id",
}

# ----------------------------------------------------------------- warehouse
AUDIT_ENTRY = (
    "STRUCT<action: STRING, timestamp: TIMESTAMP, acknowledged_by: STRING, detail: STRING, notes: STRING>"
)

WAREHOUSE = {
    "dim_account": (
        "account_id STRING, company_name STRING, industry STRING, company_size STRING, "
        "region STRING, csm_owner STRING, created_at TIMESTAMP, cohort STRING"
    ),
    "dim_user": "user_id STRING, account_id STRING, email STRING, role STRING, created_at TIMESTAMP",
    "dim_plan": "plan_name STRING, base_mrr DECIMAL(10,2), seat_limit INT, event_quota INT",
    "dim_date": (
        "date_key STRING, full_date DATE, year INT, quarter INT, month INT, day INT, "
        "day_of_week INT, is_weekend BOOLEAN"
    ),
    "fact_subscription": (
        "subscription_id STRING, account_id STRING, plan_name STRING, start_date TIMESTAMP, "
        "status STRING, mrr DECIMAL(10,2), arr DECIMAL(12,2)"
    ),
    "fact_billing": (
        "invoice_id STRING, account_id STRING, amount DECIMAL(10,2), due_date TIMESTAMP, "
        "paid_at TIMESTAMP, status STRING, is_overdue BOOLEAN"
    ),
    "fact_support": (
        "ticket_id STRING, account_id STRING, severity STRING, status STRING, created_at TIMESTAMP, "
        "resolved_at TIMESTAMP, resolution_time_hours DOUBLE, sla_breached BOOLEAN"
    ),
    "fact_usage": (
        "usage_id STRING, account_id STRING, user_id STRING, feature STRING, "
        "event_timestamp TIMESTAMP, event_date DATE"
    ),
    "mrt_customer_health": (
        "account_id STRING, company_name STRING, industry STRING, plan STRING, mrr DECIMAL(10,2), "
        "csm_owner STRING, health_score DOUBLE, health_tier STRING, events_last_30d BIGINT, "
        "active_users_30d BIGINT, open_tickets BIGINT, critical_tickets BIGINT, "
        "sla_compliance_rate DOUBLE, payment_status STRING, churn_risk_score DOUBLE, "
        "expansion_score DOUBLE, anomaly_detected BOOLEAN, last_updated_at TIMESTAMP"
    ),
    "mrt_revenue_summary": (
        "id BIGINT, total_mrr DECIMAL(20,2), total_arr DECIMAL(22,2), "
        "paid_invoices_amount DECIMAL(22,2), unpaid_invoices_amount DECIMAL(22,2), "
        "active_accounts BIGINT, past_due_accounts BIGINT, net_retention_rate DOUBLE, "
        "logo_churn_rate DOUBLE, revenue_churn_rate DOUBLE, expansion_rate DOUBLE, "
        "calculated_at TIMESTAMP"
    ),
    "automation_alerts": (
        "alert_id STRING, account_id STRING, alert_type STRING, severity STRING, "
        "trigger_reason STRING, status STRING, owner STRING, created_at TIMESTAMP, "
        f"acknowledged_at TIMESTAMP, audit_history ARRAY<{AUDIT_ENTRY}>"
    ),
    "audit_pipeline_runs": (
        "run_id STRING, layer STRING, status STRING, records_processed BIGINT, duration_ms BIGINT, "
        "error_message STRING, started_at TIMESTAMP, completed_at TIMESTAMP"
    ),
}

# Rebuilt by every daily run; alerts and the run audit are never dropped.
REBUILT_TABLES = (
    "dim_account", "dim_user", "dim_plan", "dim_date",
    "fact_subscription", "fact_billing", "fact_support", "fact_usage",
    "mrt_customer_health", "mrt_revenue_summary",
)

HEALTH_COLUMNS = [column.split(" ")[0] for column in WAREHOUSE["mrt_customer_health"].split(", ")]

# Fixed values: (plan name, monthly price, seat limit, event quota).
PLANS = (
    ("Starter", 299, 5, 50_000),
    ("Professional", 999, 25, 250_000),
    ("Enterprise", 3_499, 100, 1_000_000),
    ("Enterprise Plus", 7_499, 500, 5_000_000),
)

# The plan offered next; any other plan is offered DEFAULT_UPGRADE.
NEXT_PLAN = {
    "Starter": "Professional",
    "Professional": "Enterprise",
    "Enterprise": "Enterprise Plus",
    "Enterprise Plus": "Custom Dedicated Cluster",
}
DEFAULT_UPGRADE = "Enterprise"

# Hours to resolve by severity; any other severity gets DEFAULT_SLA_HOURS.
SLA_HOURS = {"critical": 12.0, "high": 24.0, "medium": 48.0, "low": 72.0}
DEFAULT_SLA_HOURS = 48.0

# Accepted labels.
ACCEPTED_VALUES = {
    "subscription_status": ("active", "past_due", "cancelled", "trial"),
    "invoice_status": ("paid", "open", "failed", "void"),
    "ticket_severity": ("low", "medium", "high", "critical"),
    "ticket_status": ("open", "in_progress", "resolved", "closed"),
    "alert_status": ("open", "acknowledged", "resolved"),
}

GOOD_STANDING = "Good Standing"
PAYMENT_TROUBLE = "Failed / Overdue"

HEALTHY_FROM = 75.0
AT_RISK_FROM = 50.0

# Three separate risk scales: heuristic-score bands, the high-risk list, and
# the tiers of the trained model's probability.
BAND_HIGH_FROM, BAND_MODERATE_FROM = 0.60, 0.30
HIGH_RISK_LIST_FROM = 0.50
MODEL_HIGH_FROM, MODEL_MEDIUM_FROM = 0.70, 0.40


def struct(ddl: str) -> StructType:
    """Schema of a DDL text; needs an active session."""
    return StructType.fromDDL(ddl)
