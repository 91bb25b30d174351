"""Cleaned datasets to dimension and fact tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions import columns as C
from tidemark.operators.keyed import keep_first, with_known_key


def clean(raw: dict[str, DataFrame], order: dict[str, list[str]] | None = None) -> dict[str, DataFrame]:
    """Deduplicate the six raw datasets and drop rows of unknown accounts.

    ``order`` gives the columns that rank copies of a key; by default the
    arrival number ``_seq`` where present, then every column.
    """
    out = {}
    for name, df in raw.items():
        key = S.BRONZE_KEYS[name]
        ranked_by = (order or {}).get(name) or (["_seq"] if "_seq" in df.columns else []) + sorted(
            c for c in df.columns if c not in (key, "_seq")
        )
        out[name] = keep_first(df, [key], ranked_by)
    accounts = out["accounts"]
    for name in out:
        if name != "accounts":
            out[name] = with_known_key(out[name], accounts, "account_id", spread_by=[S.BRONZE_KEYS[name]])
    if "support_tickets" in out:
        out["support_tickets"] = out["support_tickets"].withColumn("severity", F.lower("severity"))
    return out


def dim_account(accounts: DataFrame) -> DataFrame:
    return accounts.select(
        "account_id", "company_name", "industry", F.col("size").alias("company_size"), "region",
        F.col("owner").alias("csm_owner"), "created_at", F.coalesce("cohort", F.lit("healthy")).alias("cohort"),
    )


def dim_user(users: DataFrame) -> DataFrame:
    return users.select("user_id", "account_id", "email", "role", "created_at")


def dim_user_domain(users: DataFrame) -> DataFrame:
    return dim_user(users).withColumn("email_domain", C.email_domain(F.col("email")))


def dim_plan(spark: SparkSession, plans=S.PLANS) -> DataFrame:
    rows = ", ".join(f"('{n}', {m}, {s}, {q})" for n, m, s, q in plans)
    return spark.sql(
        f"SELECT n AS plan_name, CAST(m AS DECIMAL(10,2)) AS base_mrr, s AS seat_limit, q AS event_quota "
        f"FROM VALUES {rows} AS t(n, m, s, q)"
    )


def dim_date(dates: DataFrame, column: str) -> DataFrame:
    """Calendar attributes of the distinct dates of ``column``."""
    d = F.col("full_date")
    return (
        dates.select(F.to_date(column).alias("full_date")).where(d.isNotNull()).distinct()
        .select(
            F.date_format(d, "yyyy-MM-dd").alias("date_key"), d,
            F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
            F.dayofmonth(d).alias("day"), F.weekday(d).alias("day_of_week"),
            (F.weekday(d) >= 5).alias("is_weekend"),
        )
    )


def fact_subscription(subscriptions: DataFrame) -> DataFrame:
    return subscriptions.select(
        "subscription_id", "account_id", F.col("plan").alias("plan_name"), "start_date", "status", "mrr",
        (F.col("mrr") * 12).cast("decimal(12,2)").alias("arr"),
    )


def fact_billing(invoices: DataFrame, as_of) -> DataFrame:
    overdue = (F.col("status") == "failed") | (
        (F.col("status") == "open") & (F.col("due_date") < C.as_timestamp(as_of))
    )
    return invoices.select(
        "invoice_id", "account_id", "amount", "due_date", "paid_at", "status",
        F.coalesce(overdue, F.lit(False)).alias("is_overdue"),
    )


def fact_billing_overdue_days(billing: DataFrame, as_of) -> DataFrame:
    """Whole days past due; 0 for an invoice that is not overdue."""
    late = F.date_diff(C.as_timestamp(as_of).cast("date"), F.col("due_date").cast("date"))
    return billing.withColumn("days_overdue", F.when(F.col("is_overdue"), F.greatest(late, F.lit(0))).otherwise(0))


def fact_support(tickets: DataFrame, as_of) -> DataFrame:
    """Resolution hours and breach of the severity's limit.

    An unresolved ticket has no resolution time and is measured by its age at
    ``as_of``; exactly reaching the limit is not a breach.
    """
    hours = C.hours_between(F.col("created_at"), F.coalesce(F.col("resolved_at"), C.as_timestamp(as_of)))
    return tickets.select(
        "ticket_id", "account_id", "severity", "status", "created_at", "resolved_at",
        F.when(F.col("resolved_at").isNotNull(), hours).alias("resolution_time_hours"),
        (hours > C.sla_limit_hours(F.col("severity"))).alias("sla_breached"),
    )


def fact_usage(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("usage_id"), "account_id", "user_id", "feature",
        F.col("timestamp").alias("event_timestamp"), F.to_date("timestamp").alias("event_date"),
    )
