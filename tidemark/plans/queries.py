"""Catalogue of the operators over the driver tables, one entry per query."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions import columns as C
from tidemark.operators import (
    anomaly, churn, evaluation, expansion, facts, forecast, health, keyed, quality, revenue, rules, serving, sketches, usage,
)
from tidemark.plans import binding as B, incremental
from tidemark.plans.binding import Domain
from tidemark.session import scratch_folder
from tidemark.sources import bronze, storage
from tidemark.streaming import effects, events as stream, windows
from tidemark.streaming.live import LiveJob, read_topics
from tidemark.streaming.state import HealthState

_CATALOGUE: dict[str, Callable[[Domain], DataFrame]] = {}


def query(build: Callable[[Domain], DataFrame]) -> Callable[[Domain], DataFrame]:
    _CATALOGUE[build.__name__] = build
    return build


def catalogue() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build):
        return lambda spark, folder: build(Domain(spark, folder))

    return {name: bind(build) for name, build in _CATALOGUE.items()}


def _money(df: DataFrame, *columns: str) -> DataFrame:
    """Decimal money as double, the form results are compared in."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


# ------------------------------------------------------- dimensions and facts

@query
def dim_plan(d: Domain) -> DataFrame:
    """Plan rows with the number of accounts on each."""
    on_plan = d.subscription_facts.groupBy("plan_name").agg(F.count(F.lit(1)).alias("accounts"))
    return _money(d.dim_plan.join(on_plan, "plan_name", "left").fillna(0, ["accounts"]), "base_mrr")


@query
def dim_account(d: Domain) -> DataFrame:
    return d.dim_account


@query
def dim_user(d: Domain) -> DataFrame:
    return d.dim_user


@query
def dim_user_domain(d: Domain) -> DataFrame:
    return facts.dim_user_domain(d.users).select("user_id", "account_id", "email_domain")


@query
def dim_date(d: Domain) -> DataFrame:
    return facts.dim_date(d.events, "timestamp").drop("full_date")


@query
def fact_subscription(d: Domain) -> DataFrame:
    return _money(d.subscription_facts, "mrr", "arr")


@query
def fact_billing(d: Domain) -> DataFrame:
    return _money(d.billing, "amount")


@query
def fact_billing_overdue_days(d: Domain) -> DataFrame:
    return facts.fact_billing_overdue_days(d.billing, B.BILLING_AS_OF).select(
        "invoice_id", "is_overdue", "days_overdue")


@query
def fact_support(d: Domain) -> DataFrame:
    return d.support


@query
def fact_usage(d: Domain) -> DataFrame:
    return d.usage.withColumn("event_date", F.date_format("event_date", "yyyy-MM-dd"))


@query
def dedup_keep_first(d: Domain) -> DataFrame:
    return d.tickets


@query
def dedup_keep_latest(d: Domain) -> DataFrame:
    lines = d.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
                                       "l_quantity", "l_shipdate")
    return keyed.keep_latest(lines, ["l_orderkey", "l_linenumber"], "l_shipdate",
                             ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"])


@query
def bitemporal_as_of(d: Domain) -> DataFrame:
    lines = d.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
                                       "l_quantity", "l_shipdate")
    return keyed.as_of_version(lines, ["l_orderkey", "l_linenumber"], "l_shipdate", "1998-12-31 00:00:00",
                               ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"])


@query
def ref_integrity_filter(d: Domain) -> DataFrame:
    """Invoices of the accounts that have users."""
    return _money(keyed.with_known_key(d.invoices, d.dim_user, "account_id", spread_by=["invoice_id"]), "amount")


@query
def fk_quarantine(d: Domain) -> DataFrame:
    """Invoices of accounts without users, with the reason."""
    orphans = keyed.with_unknown_key(d.invoices, d.dim_user, "account_id", spread_by=["invoice_id"])
    return orphans.select("invoice_id", "account_id", F.concat(
        F.lit("Unknown account_id: "), F.col("account_id").cast("string")).alias("reason"))


# -------------------------------------------------------------- upserts, loads

def _invoice_loads(d: Domain) -> tuple[DataFrame, DataFrame]:
    """A loaded table (due before 1999, still open) and an overlapping new load."""
    columns = ("invoice_id", "account_id", "amount", "status", "due_date")
    due = F.col("due_date")
    loaded = d.invoices.where(due < F.lit("1999-01-01").cast("timestamp")).withColumn("status", F.lit("open"))
    incoming = d.invoices.where(due >= F.lit("1998-01-01").cast("timestamp")).withColumn("amount", (
        F.col("amount") + 1).cast("decimal(10,2)"))
    return loaded.select(*columns), incoming.select(*columns)


@query
def upsert_insert_ignore(d: Domain) -> DataFrame:
    return _money(keyed.insert_ignore(*_invoice_loads(d), ["invoice_id"]), "amount")


@query
def upsert_update_columns(d: Domain) -> DataFrame:
    return _money(keyed.update_columns(*_invoice_loads(d), ["invoice_id"], ["status"]), "amount")


@query
def upsert_replace(d: Domain) -> DataFrame:
    return _money(keyed.replace_rows(*_invoice_loads(d), ["invoice_id"]), "amount")


@query
def incremental_load(d: Domain) -> DataFrame:
    loaded = d.usage.where(F.col("event_timestamp") < F.lit("2024-01-20").cast("timestamp"))
    fresh = keyed.above_high_water_mark(d.usage, loaded, "event_timestamp")
    return fresh.select("usage_id", "account_id", "feature", "event_timestamp")


@query
def normalise_nulls(d: Domain) -> DataFrame:
    """Blank text and NaN as null: lone 'O' status letters and zero discounts blanked first."""
    nan = F.when(F.col("l_discount") == 0, F.lit(float("nan"))).otherwise(F.col("l_discount"))
    blank = F.when(F.col("l_linestatus") == "O", F.lit("  ")).otherwise(F.col("l_linestatus"))
    cleaned = d.table("lineitem").select(C.nan_to_null(nan).alias("discount"), C.blank_to_null(blank).alias("linestatus"))
    return cleaned.groupBy("linestatus").agg(
        F.count(F.lit(1)).alias("rows"), F.count("discount").alias("with_discount"),
        F.sum(F.col("discount").cast("decimal(10,2)")).cast("double").alias("sum_discount"))


@query
def parameterised_lookup(d: Domain) -> DataFrame:
    return serving.parameterised(
        d.spark,
        "SELECT invoice_id, account_id, CAST(amount AS DOUBLE) AS amount FROM {billing} "
        "WHERE status = :status AND amount >= :minimum",
        {"status": "failed", "minimum": 250000}, billing=d.billing)


# ------------------------------------------------- files written and read back

_JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


@query
def scan_bronze(d: Domain) -> DataFrame:
    """Accounts landed as JSON Lines and scanned with the raw schema."""
    path = f"{scratch_folder(d.spark)}/accounts.jsonl"
    d.accounts.write.option("timestampFormat", _JSON_TIME).json(path)
    return bronze.split_quarantine(bronze.read_json_lines(d.spark, path, "accounts"), "account_id")[0].drop("_source_file")


@query
def scan_bronze_quarantine(d: Domain) -> DataFrame:
    """Invoices landed with an unreadable amount where the payment failed."""
    path = f"{scratch_folder(d.spark)}/invoices.jsonl"
    amount = F.when(F.col("status") == "failed", "n/a").otherwise(F.col("amount").cast("string"))
    d.invoices.withColumn("amount", amount).write.option("timestampFormat", _JSON_TIME).json(path)
    good, bad = bronze.split_quarantine(bronze.read_json_lines(d.spark, path, "invoices"), "invoice_id")
    columns = ("invoice_id", "account_id", "status", "amount")
    rows = good.select(*columns, F.lit(None).cast("string").alias("reason")).unionByName(
        bad.select(*columns, F.col("_reason").alias("reason")))
    return _money(rows, "amount")


@query
def bronze_audit_columns(d: Domain) -> DataFrame:
    rows = d.table("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return bronze.with_audit_columns(rows, B.USAGE_AS_OF, "crm").select(
        "c_custkey", "_ingested_at", "_source_channel", "_raw_payload_hash")


@query
def sink_overwrite(d: Domain) -> DataFrame:
    """A table written twice; only the second write remains."""
    path = f"{scratch_folder(d.spark)}/fact_subscription"
    storage.overwrite(d.subscription_facts, path)
    storage.overwrite(d.subscription_facts.where(F.col("status") == "active"), path)
    return _money(d.spark.read.parquet(path), "mrr", "arr")


@query
def sink_csv(d: Domain) -> DataFrame:
    """Invoices exported for bulk loading and read back by the same rules."""
    path = f"{scratch_folder(d.spark)}/fact_billing"
    storage.export_csv(d.billing, path)
    back = d.spark.read.schema(S.WAREHOUSE["fact_billing"]).option("escape", '"').csv(path)
    return _money(back, "amount")


@query
def write_partitioned(d: Domain) -> DataFrame:
    """Usage written by date, with every date checked; the filter reads only the folders it needs."""
    path = f"{scratch_folder(d.spark)}/fact_usage"
    storage.overwrite(d.usage, path, "event_date")
    back = d.spark.read.parquet(path)
    storage.check_same(usage.daily_usage_by_account(d.usage), usage.daily_usage_by_account(back), path)
    recent = back.where(F.col("event_date") >= F.lit("2024-01-20").cast("date"))
    return _date_text(usage.daily_usage_by_account(recent))


@query
def publish_snapshot(d: Domain) -> DataFrame:
    """A published run, and a later one that was never published."""
    root = scratch_folder(d.spark)
    storage.stage(d.billing, root, "run1", "fact_billing")
    at = datetime.fromisoformat(B.USAGE_AS_OF).replace(tzinfo=timezone.utc)
    storage.publish(d.spark, root, "run1", ["fact_billing"], at)
    storage.stage(d.billing.where(F.col("is_overdue")), root, "run2", "fact_billing")
    return _money(storage.read_published(d.spark, root, "fact_billing"), "amount")


@query
def sink_audit_append(d: Domain) -> DataFrame:
    """The run audit after three runs; every run adds a row with the records that it wrote."""
    root, at = scratch_folder(d.spark), datetime.fromisoformat(B.USAGE_AS_OF).replace(tzinfo=timezone.utc)
    for run, (layer, df) in enumerate((("bronze", d.invoices), ("silver", d.subscriptions), ("gold", d.usage))):
        written = Observation()
        storage.overwrite(df.observe(written, F.count(F.lit(1)).alias("rows")), f"{root}/{layer}")
        storage.append_run_audit(d.spark, root, run_id=f"run{run}", layer=layer, status="SUCCESS", records=storage.observed(written).get("rows", 0),
                                 started_at=at, completed_at=at + timedelta(seconds=90))
    audit = d.spark.read.schema(S.WAREHOUSE[storage.RUN_AUDIT]).parquet(f"{root}/{storage.RUN_AUDIT}")
    return audit.select("run_id", "layer", "status", "records_processed", "duration_ms", "error_message")


@query
def create_tables(d: Domain) -> DataFrame:
    """Subscriptions appended to the typed empty table of the warehouse."""
    root = scratch_folder(d.spark)
    storage.create_tables(d.spark, root)
    path = f"{root}/fact_subscription"
    empty = d.spark.read.parquet(path)
    storage.append(d.subscription_facts.select(*[F.col(f.name).cast(f.dataType) for f in empty.schema]), path)
    return _money(d.spark.read.parquet(path), "mrr", "arr")


# --------------------------------------------------------- account aggregates

@query
def usage_30d_by_account(d: Domain) -> DataFrame:
    return usage.trailing_usage(d.usage, B.USAGE_AS_OF)


@query
def support_by_account(d: Domain) -> DataFrame:
    return health.support_by_account(d.support)


@query
def billing_by_account(d: Domain) -> DataFrame:
    return health.billing_by_account(d.billing)


@query
def mrt_customer_health(d: Domain) -> DataFrame:
    return _money(d.health, "mrr")


@query
def mrt_revenue_summary(d: Domain) -> DataFrame:
    return _money(d.revenue, "total_mrr", "total_arr", "paid_invoices_amount", "unpaid_invoices_amount")


@query
def latest_revenue(d: Domain) -> DataFrame:
    """The newest of two runs, the first of which saw only the older invoices."""
    earlier = d.billing.where(F.col("due_date") < F.lit("1999-01-01").cast("timestamp"))
    first = revenue.revenue_summary(d.dim_account, d.subscription_facts, earlier, "2024-01-30 00:00:00")
    newest = forecast.latest_revenue(first.unionByName(d.revenue))
    return _money(newest, "total_mrr", "total_arr", "paid_invoices_amount", "unpaid_invoices_amount")


# -------------------------------------------------------------- usage metrics

@query
def usage_totals(d: Domain) -> DataFrame:
    return usage.usage_totals(d.usage)


@query
def top_features(d: Domain) -> DataFrame:
    return usage.top_features(d.usage)


@query
def feature_share_of_max(d: Domain) -> DataFrame:
    return usage.feature_share_of_max(d.usage)


def _date_text(df: DataFrame, column: str = "event_date") -> DataFrame:
    return df.withColumn(column, F.date_format(column, "yyyy-MM-dd"))


@query
def daily_usage_trend(d: Domain) -> DataFrame:
    return _date_text(usage.daily_usage_trend(d.usage))


@query
def daily_usage_by_account(d: Domain) -> DataFrame:
    return _date_text(usage.daily_usage_by_account(d.usage))


@query
def usage_tumbling(d: Domain) -> DataFrame:
    return usage.tumbling(d.usage)


@query
def usage_sliding(d: Domain) -> DataFrame:
    return usage.sliding(d.usage)


@query
def usage_session(d: Domain) -> DataFrame:
    return usage.sessions(d.usage)


@query
def dau_mau(d: Domain) -> DataFrame:
    return _date_text(usage.dau_mau(d.usage))


@query
def feature_adoption(d: Domain) -> DataFrame:
    return usage.feature_adoption(d.usage, B.USAGE_AS_OF)


@query
def feature_adoption_weekly(d: Domain) -> DataFrame:
    return _date_text(usage.feature_adoption_weekly(d.usage), "week_start")


@query
def sla_breach_rate(d: Domain) -> DataFrame:
    return health.sla_breach_rate(d.support)


@query
def health_daily(d: Domain) -> DataFrame:
    return _date_text(health.health_daily(d.usage, d.support, d.standing), "date_key")


@query
def rule_health_drop_wow(d: Domain) -> DataFrame:
    """Weekly falls on all days of the orders, which stand in for usage in the years of the tickets."""
    return _date_text(health.health_drops(health.health_daily(d.order_usage, d.support, d.standing, runs=True)), "date_key")


@query
def standing_history(d: Domain) -> DataFrame:
    """Intervals of payment and subscription status, from month-end snapshots."""
    return _date_text(_date_text(health.standing_history(d.month_ends), "valid_from"), "valid_to")


@query
def health_daily_as_of(d: Domain) -> DataFrame:
    """Accounts and summed health by day and standing, each day with the standing known then."""
    runs = health.health_daily(d.order_usage, d.support, health.standing_history(d.month_ends), runs=True)
    daily = health.totals_by_day(runs, "payment_status", {
        "score_sum": F.col("health_score").cast("decimal(10,1)"), "open_tickets": F.col("open_tickets_count")})
    return _date_text(daily.withColumn("score_sum", F.col("score_sum").cast("double")), "date_key")


# ------------------------------------------------------------------- serving

@query
def account_health_lookup(d: Domain) -> DataFrame:
    return _money(serving.account_health_lookup(d.health, 7), "mrr")


@query
def customer_search(d: Domain) -> DataFrame:
    return serving.customer_search(d.health, "R#00000004", "At Risk").select(
        "account_id", "company_name", "csm_owner", "health_tier")


@query
def churn_risk_accounts(d: Domain) -> DataFrame:
    return _money(serving.churn_risk_accounts(d.health), "mrr")


@query
def churn_risk_bands(d: Domain) -> DataFrame:
    return serving.churn_risk_bands(d.health)


@query
def high_risk_accounts(d: Domain) -> DataFrame:
    return _money(serving.high_risk_accounts(d.health), "mrr")


@query
def top_risk_accounts(d: Domain) -> DataFrame:
    return _money(serving.top_risk_accounts(d.health), "mrr")


@query
def health_distribution(d: Domain) -> DataFrame:
    return serving.health_distribution(d.health)


@query
def recent_events(d: Domain) -> DataFrame:
    return serving.recent_events(d.usage)


_ALERT_VIEW = ("alert_id", "account_id", "alert_type", "severity", "trigger_reason", "status", "owner", "created_at")


@query
def recent_open_alerts(d: Domain) -> DataFrame:
    return serving.recent_open_alerts(d.alerts)


@query
def alerts_by_status(d: Domain) -> DataFrame:
    return serving.alerts_by_status(_acknowledged(d), "acknowledged").select(*_ALERT_VIEW)


# ------------------------------------------------------------------- scoring

@query
def expansion_scores(d: Domain) -> DataFrame:
    return _money(expansion.expansion_scores(d.health, d.dim_plan), "current_mrr")


@query
def usage_anomalies(d: Domain) -> DataFrame:
    daily = usage.daily_usage_by_account(d.usage)
    return _date_text(anomaly.usage_anomalies(daily, keep_normal=True))


@query
def forecast_scenarios(d: Domain) -> DataFrame:
    rates = forecast.forecast_scenarios(d.revenue)
    return rates.select("scenario", "label", "starting_mrr", "starting_arr",
                        F.round("annual_growth", 6).alias("annual_growth"),
                        F.round("monthly_growth", 8).alias("monthly_growth"))


@query
def revenue_forecast(d: Domain) -> DataFrame:
    return forecast.revenue_forecast(d.revenue, 12)


@query
def forecast_at_month(d: Domain) -> DataFrame:
    return forecast.forecast_at_month(d.revenue, 12)


@query
def forecast_from_movements(d: Domain) -> DataFrame:
    """Twelve periods ahead at the observed churn and expansion of the last complete year."""
    last_day = d.table("orders").agg(F.max(F.to_date("o_orderdate"))).scalar()
    observed = forecast.summary_from_movements(_movements(d), last_day)
    return forecast.forecast_at_month(observed, 12)


@query
def churn_features(d: Domain) -> DataFrame:
    return churn.churn_features(d.health)


@query
def churn_risk_tiers(d: Domain) -> DataFrame:
    return churn.churn_risk_tiers(d.health, "churn_risk_score")


@query
def churn_model_scores(d: Domain) -> DataFrame:
    model, _ = churn.train_churn_model(churn.churn_features(d.health))
    return churn.score_accounts(model, d.health)


@query
def classification_metrics(d: Domain) -> DataFrame:
    return evaluation.classification_metrics(d.labelled, "score", "label", 0.5)


@query
def cost_confusion(d: Domain) -> DataFrame:
    return evaluation.cost_confusion(d.labelled, "score", "label", 0.6, 50_000.0, 25.0)


@query
def roc_auc(d: Domain) -> DataFrame:
    return evaluation.roc_auc(d.labelled, "score", "label")


@query
def pr_auc(d: Domain) -> DataFrame:
    return evaluation.pr_auc(d.labelled, "score", "label")


@query
def recall_top_decile(d: Domain) -> DataFrame:
    return evaluation.recall_top_share(d.labelled, "score", "label", 0.10)


@query
def out_of_time_split(d: Domain) -> DataFrame:
    split = evaluation.out_of_time_split(d.usage, "event_timestamp", "2024-01-22 00:00:00")
    return split.groupBy("split", "feature").agg(F.count(F.lit(1)).alias("rows"))


@query
def drift_psi(d: Domain) -> DataFrame:
    return evaluation.drift_psi(
        d.table("events").select("event_type", "value", "ts"), "event_type", "value",
        F.col("ts") >= F.lit("2024-01-16").cast("timestamp"), [2.0, 5.0, 10.0, 15.0, 20.0, 30.0, 50.0, 80.0])


# --------------------------------------------------------------------- rules

@query
def rule_health_drop(d: Domain) -> DataFrame:
    return rules.rule_health_drop(d.health, B.USAGE_AS_OF).select(*_ALERT_VIEW)


@query
def rule_payment_failure(d: Domain) -> DataFrame:
    fired = rules.rule_payment_failure(d.billing, d.dim_account, B.USAGE_AS_OF)
    return fired.select(*_ALERT_VIEW, F.col("audit_history")[0]["detail"].alias("detail"))


@query
def rule_upsell(d: Domain) -> DataFrame:
    return rules.rule_upsell(d.health, d.small_quota_plans, B.USAGE_AS_OF).select(*_ALERT_VIEW)


@query
def rule_support(d: Domain) -> DataFrame:
    return rules.rule_support(d.health, B.USAGE_AS_OF).select(*_ALERT_VIEW)


@query
def rule_critical_backlog(d: Domain) -> DataFrame:
    return rules.rule_critical_backlog(d.backlog, d.dim_account, B.SUPPORT_AS_OF)


@query
def backlog_alerts(d: Domain) -> DataFrame:
    return rules.backlog_alerts(d.backlog, d.dim_account, B.SUPPORT_AS_OF).select(*_ALERT_VIEW)


@query
def health_drop_alerts(d: Domain) -> DataFrame:
    """Alerts of the weekly falls."""
    drops = health.health_drops(health.health_daily(d.order_usage, d.support, d.standing, runs=True))
    return rules.drop_alerts(drops, d.dim_account, B.SUPPORT_AS_OF).select(*_ALERT_VIEW)


@query
def all_alerts(d: Domain) -> DataFrame:
    return d.alerts.select(*_ALERT_VIEW)


@query
def alert_history_json(d: Domain) -> DataFrame:
    """Alert histories as JSON text and back; every third text is spoilt and becomes an empty history."""
    spoilt = F.crc32("alert_id") % 3 == 0
    stored = rules.history_to_json(d.alerts).withColumn("audit_history", F.when(spoilt, F.lit("[{")).otherwise(F.col("audit_history")))
    return rules.history_from_json(stored).select(
        "alert_id", F.size("audit_history").alias("entries"), F.get("audit_history", F.lit(0))["action"].alias("action"),
        F.get("audit_history", F.lit(0))["timestamp"].alias("at"))


def _acknowledged(d: Domain) -> DataFrame:
    return rules.acknowledge(d.alerts.select(*rules.ALERT_COLUMNS), _requests(d), "2024-02-01 00:00:00")


def _requests(d: Domain) -> DataFrame:
    """Finance acknowledges every urgent invoice, the account team before it; most never raised an alert."""
    urgent = d.table("orders").where(F.col("o_orderpriority") == "1-URGENT")
    finance = F.struct(F.lit("Finance").alias("acknowledged_by"), F.when(F.col("o_totalprice") > 100000, "call first").alias("notes"),
                       F.lit("2024-02-01 00:00:00").cast("timestamp").alias("requested_at"))
    team = F.struct(F.lit("Account team").alias("acknowledged_by"), F.lit(None).cast("string").alias("notes"),
                    F.lit("2024-01-31 18:00:00").cast("timestamp").alias("requested_at"))
    both = urgent.select(F.concat(F.lit("alt_bill_"), F.col("o_orderkey")).alias("alert_id"), F.explode(F.array(finance, team)).alias("r"))
    return both.select("alert_id", "r.*")


@query
def alerts_acknowledge(d: Domain) -> DataFrame:
    last = F.element_at("audit_history", -1)
    return _acknowledged(d).select(
        "alert_id", "status", "acknowledged_at", F.size("audit_history").alias("entries"),
        F.array_join(F.transform("audit_history", lambda e: F.coalesce(e["acknowledged_by"], F.lit("-"))), " > ").alias("actors"),
        last["action"].alias("last_action"), last["acknowledged_by"].alias("last_by"),
        last["notes"].alias("last_notes"))


@query
def alerts_acknowledge_errors(d: Domain) -> DataFrame:
    return rules.acknowledge_errors(d.alerts, _requests(d)).select("alert_id", "error")


@query
def alerts_upsert(d: Domain) -> DataFrame:
    """Acknowledged alerts of a first run, re-fired by a run with a stricter score limit."""
    fired = rules.rule_health_drop(d.health, "2024-02-02 00:00:00", 60.0).unionByName(
        rules.rule_payment_failure(d.billing, d.dim_account, "2024-02-02 00:00:00"))
    return rules.upsert_alerts(_acknowledged(d), fired).select(
        "alert_id", "severity", "trigger_reason", "status", "created_at", "acknowledged_at")


@query
def notification_outbox(d: Domain) -> DataFrame:
    lists = {"health_alert": rules.parse_recipients("csm@example.com, manager@example.com"),
             "payment_failure": rules.parse_recipients("billing@example.com")}
    return rules.notification_outbox(d.alerts, lists)


# ------------------------------------------------------------------- quality

_CHECK = ("test_name", "category", "passed", "failed_count", "details")


def _check(d: Domain, *names: str) -> DataFrame:
    checks = [c for c in quality.standard_checks(d.dim_account, d.dim_user, d.usage, d.health) if c[0] in names]
    return quality.check_results(checks).select(*_CHECK)


@query
def dq_uniqueness(d: Domain) -> DataFrame:
    """The two standard checks, and one that fails: delivered tickets repeat ids."""
    copies = quality.unique(d.ticket_copies, "ticket_id", "ticket_copies_uniqueness", "Delivered tickets")
    return _check(d, "dim_account_uniqueness", "fact_usage_uniqueness").unionByName(copies.select(*_CHECK))


@query
def dq_not_null(d: Domain) -> DataFrame:
    """The standard check, and one that fails: unpaid invoices have no payment time."""
    unpaid = quality.not_null(d.billing, ["paid_at", "amount"], "billing_not_null", "Paid invoices")
    return _check(d, "mrt_customer_health_not_null").unionByName(unpaid.select(*_CHECK))


@query
def dq_referential_integrity(d: Domain) -> DataFrame:
    """The standard check, and one that fails: most invoiced accounts have no users."""
    orphans = quality.references(d.billing, "account_id", d.dim_user, "account_id", "billing_user_integrity",
                                 "Invoiced accounts have users")
    return _check(d, "dim_user_account_referential_integrity").unionByName(orphans.select(*_CHECK))


@query
def dq_range(d: Domain) -> DataFrame:
    """The standard check, and one that fails: invoices above 400,000."""
    large = quality.in_range(d.billing, F.col("amount") > 400000, "billing_range", "Invoices up to 400,000")
    return _check(d, "health_score_and_mrr_range").unionByName(large.select(*_CHECK))


@query
def dq_volume(d: Domain) -> DataFrame:
    return _check(d, "telemetry_volume_threshold")


@query
def dq_report(d: Domain) -> DataFrame:
    passes = quality.standard_passes(d.dim_account, d.dim_user, d.usage, d.health)
    return quality.report(quality.pass_results(passes), B.USAGE_AS_OF)


@query
def dq_checks(d: Domain) -> DataFrame:
    """All standard checks, each table read once."""
    return quality.pass_results(quality.standard_passes(d.dim_account, d.dim_user, d.usage, d.health)).select(*_CHECK)


@query
def dq_error_isolation(d: Domain) -> DataFrame:
    """The checks where one table lacks a column: its checks fail with an error, all others run."""
    passes = quality.standard_passes(d.dim_account, d.dim_user, d.usage.drop("usage_id"), d.health)
    return quality.run_passes(d.spark, passes).select("test_name", "passed", "failed_count", F.col("error").isNotNull().alias("has_error"))


@query
def dq_freshness(d: Domain) -> DataFrame:
    return quality.freshness_minutes(d.usage, "event_timestamp", B.USAGE_AS_OF)


@query
def dq_accepted_values(d: Domain) -> DataFrame:
    accepted = S.ACCEPTED_VALUES
    parts = [
        quality.accepted_values(d.subscription_facts, "status", accepted["subscription_status"], "subscription_status"),
        quality.accepted_values(d.billing, "status", accepted["invoice_status"], "invoice_status"),
        quality.accepted_values(d.support, "severity", ("low", "medium", "high"), "ticket_severity"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("test_name", "passed", "failed_count")


@query
def dq_null_pct(d: Domain) -> DataFrame:
    return quality.null_percentages(d.support, ["ticket_id", "severity", "resolved_at", "resolution_time_hours"])


@query
def dq_row_variance(d: Domain) -> DataFrame:
    loads = _date_text(usage.daily_counts(d.usage)).select("event_date", F.col("daily_events").alias("rows"))
    return quality.row_variance(loads, "event_date")


# ------------------------------------------------------- documented metrics

def _movements(d: Domain) -> DataFrame:
    return revenue.revenue_movements(d.yearly_payments, "year", "amount")


_MOVES = ("beginning_mrr", "new_mrr", "expansion_mrr", "contraction_mrr", "churn_mrr", "ending_mrr", "net_new_mrr")


@query
def mrr_movements(d: Domain) -> DataFrame:
    return _money(_movements(d), *_MOVES)


@query
def net_dollar_retention(d: Domain) -> DataFrame:
    return _money(revenue.net_dollar_retention(_movements(d)),
                  "beginning_mrr", "expansion_mrr", "contraction_mrr", "churn_mrr")


@query
def net_revenue_churn(d: Domain) -> DataFrame:
    return _money(revenue.net_revenue_churn(_movements(d)), "beginning_mrr", "expansion_mrr", "churn_mrr")


@query
def logo_retention(d: Domain) -> DataFrame:
    return revenue.logo_retention(_movements(d))


@query
def cohort_retention(d: Domain) -> DataFrame:
    return revenue.cohort_retention(d.monthly_payments, "month_number")


@query
def churn_yoy(d: Domain) -> DataFrame:
    return revenue.churn_year_over_year(d.monthly_payments, "month_number")


@query
def trend_residual(d: Domain) -> DataFrame:
    daily = d.usage.groupBy("feature", "event_date").agg(F.count(F.lit(1)).alias("daily_events"))
    return _date_text(revenue.trend_residual(daily, "feature", "event_date", "daily_events"))


def _yearly_by_account(d: Domain) -> DataFrame:
    return d.yearly_payments.groupBy("account_id", "year").agg(F.sum("amount").alias("amount"))


@query
def linear_trend(d: Domain) -> DataFrame:
    monthly = d.monthly_payments.withColumn("quarter_of_year", F.floor(F.col("month_number") % 12 / 3)).groupBy(
        "quarter_of_year", "month_number").agg(F.sum("amount").alias("amount"))
    return revenue.linear_trend(monthly, "quarter_of_year", "month_number", "amount")


@query
def exp_smoothing(d: Domain) -> DataFrame:
    return revenue.exponential_smoothing(_yearly_by_account(d), "account_id", "year", "amount", digits=8)


# -------------------------------------------------------------- stream twins

def _published(d: Domain) -> DataFrame:
    return stream.with_envelope(d.stream_events, B.USAGE_AS_OF)


@query
def event_hash_dedup(d: Domain) -> DataFrame:
    """Idempotency keys of the support events, one row each."""
    support = _published(d).where(F.col("_topic") == "support.events")
    return stream.drop_copies(support).select("event_id", "account_id", "_event_hash", "severity", "status")


@query
def stream_metrics(d: Domain) -> DataFrame:
    return stream.topic_metrics(_published(d))


@query
def stream_dead_letters(d: Domain) -> DataFrame:
    failed = stream.with_error(_published(d)).where(F.col("_error").isNotNull())
    letters = stream.dead_letters(stream.drop_copies(failed), B.USAGE_AS_OF)
    return letters.select("_topic", "event_id", "account_id", "_retry_count", "_fatal_error")


@query
def stream_envelope(d: Domain) -> DataFrame:
    product = _published(d).where(F.col("_topic") == "product.events")
    return product.select("event_id", "account_id", "_published_at", "_retry_count", "_max_retries", "_event_hash")


@query
def stream_validate(d: Domain) -> DataFrame:
    checked = stream.with_error(_published(d))
    return checked.groupBy("_topic", "_error").agg(F.count(F.lit(1)).alias("events"))


@query
def stream_dedup(d: Domain) -> DataFrame:
    return stream.drop_copies(_published(d)).select("_topic", "event_id", "account_id")


def _keyless(d: Domain) -> DataFrame:
    """Valid billing events, checked against the accounts that have users."""
    billing = stream.with_error(_published(d)).where((F.col("_topic") == "billing.events") & F.col("_error").isNull())
    return stream.reject_unknown(billing, {"account_id": d.dim_user}, ["billing.events"])


@query
def stream_fk_quarantine(d: Domain) -> DataFrame:
    return _keyless(d).where(F.col("_error").isNotNull()).select("event_id", "account_id", "_error")


@query
def dlq_redrive(d: Domain) -> DataFrame:
    """Key failures tried again once the accounts with an active subscription are known."""
    letters = stream.dead_letters(_keyless(d).where(F.col("_error").isNotNull()), B.USAGE_AS_OF)
    active = d.subscriptions.where(F.col("status") == "active")
    valid, kept = stream.redrive(letters, {"account_id": active}, topics=["billing.events"])
    return valid.select("event_id", F.lit("republished").alias("outcome"), F.lit(0).alias("attempts")).unionByName(
        kept.select("event_id", F.lit("kept").alias("outcome"), F.col("_redrive_count").alias("attempts")))


@query
def health_replay(d: Domain) -> DataFrame:
    """The health mart after all four topics' valid, deduplicated events."""
    clean = stream.drop_copies(stream.with_error(_published(d)).where(F.col("_error").isNull()))
    return effects.replay_health(d.health, clean).select(
        "account_id", "health_score", "health_tier", "events_last_30d", "payment_status", "last_updated_at")


@query
def health_replay_drain_order(d: Domain) -> DataFrame:
    """The health mart after the events of whole topics, one topic after another."""
    clean = stream.drop_copies(stream.with_error(_published(d)).where(F.col("_error").isNull()))
    return effects.replay_health(d.health, clean, drain_order=True).select("account_id", "health_score", "events_last_30d", "payment_status")


@query
def stream_unknown_topic(d: Domain) -> DataFrame:
    """Events of a topic that is none are rejected, those of the others are not."""
    renamed = _published(d).withColumn("_topic", F.when(F.col("_topic") == "support.events", "tickets").otherwise(F.col("_topic")))
    return stream.with_error(renamed).groupBy("_topic", "_error").agg(F.count(F.lit(1)).alias("events"))


# ------------------------------------------------------------ live stream job

PARTS = 3  # micro-batches
_DRAINED: dict[tuple, LiveJob] = {}


def _clock() -> datetime:
    return datetime.fromisoformat(B.USAGE_AS_OF).replace(tzinfo=timezone.utc)


def _as_events(events: DataFrame) -> DataFrame:
    return events.withColumn("account_id", F.col("account_id").cast("string"))


def _in_parts(events: DataFrame, n: int = PARTS) -> list[DataFrame]:
    """Events in ``n`` parts of about equal size, one time after another; written once, and each part is read from there."""
    events = storage.stage(events, scratch_folder(events.sparkSession), "events", "stream_events")
    at = F.unix_micros("timestamp")
    cuts = events.agg(F.percentile_approx(at, [i / n for i in range(1, n)], 1000)).first()[0]
    part = sum(((at > F.lit(c)).cast("int") for c in cuts), F.lit(0))
    return [events.where(part == i) for i in range(n)]


def _drain(d: Domain, parts: list[DataFrame], **options) -> LiveJob:
    """A live job that has taken ``parts`` in, a micro-batch each."""
    root = scratch_folder(d.spark)
    accounts = d.dim_account.select(F.col("account_id").cast("string").alias("account_id"))
    job = LiveJob(d.spark, f"{root}/live", known=lambda: {"account_id": accounts}, clock=_clock, **options)
    for part in parts:
        part.write.mode("append").parquet(f"{root}/in")
        arriving = d.spark.readStream.schema(part.schema).parquet(f"{root}/in")
        job.start(arriving, f"{root}/checkpoint").awaitTermination()
    return job


def _live(d: Domain) -> LiveJob:
    """The live job after three micro-batches of all topics; drained once for a state of the tables' files."""
    files = [tuple(sorted(d.table(name).select("_metadata.file_path", "_metadata.file_size", F.unix_micros("_metadata.file_modification_time"))
                          .distinct().collect())) for name in ("customer", "orders", "lineitem", "events")]
    key = (d.spark.sparkContext.applicationId, *files)
    if key not in _DRAINED:
        _DRAINED[key] = _drain(d, _in_parts(_as_events(d.stream_events)))
    return _DRAINED[key]


def _drained(d: Domain, stream_result: DataFrame) -> tuple[DataFrame, str]:
    """Rows a watermarked stream has emitted after draining its input, and its watermark."""
    root = scratch_folder(d.spark)
    query = (stream_result.writeStream.format("parquet").outputMode("append").option("path", f"{root}/rows")
             .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    return d.spark.read.schema(stream_result.schema).parquet(f"{root}/rows"), windows.watermark_of(query)


def _long_account(df: DataFrame) -> DataFrame:
    return df.withColumn("account_id", F.col("account_id").cast("bigint"))


def _written_mart(d: Domain) -> DataFrame:
    """The health mart with ids as text, written once."""
    mart = d.health.withColumn("account_id", F.col("account_id").cast("string"))
    return storage.stage(mart, scratch_folder(d.spark), "mart", "mrt_customer_health")


_HEALTH_VIEW = ("account_id", "health_score", "health_tier", "events_last_30d", "payment_status", "last_updated_at")


@query
def stream_health(d: Domain) -> DataFrame:
    """Customer health kept by the live job."""
    mart = d.health.withColumn("account_id", F.col("account_id").cast("string"))
    return _long_account(_live(d).current_health(mart)).select(*_HEALTH_VIEW)


@query
def stream_state_health(d: Domain) -> DataFrame:
    """Customer health as keyed state of a stream that follows the live job."""
    mart, state = _written_mart(d), HealthState(d.spark, _live(d), scratch_folder(d.spark))
    state.start(mart).awaitTermination()
    return _long_account(state.current_health(mart)).select(*_HEALTH_VIEW)


@query
def stream_insert_ignore(d: Domain) -> DataFrame:
    """Usage facts appended by the live job."""
    return _date_text(_long_account(_live(d).usage()))


@query
def stream_dlq(d: Domain) -> DataFrame:
    job = _live(d)
    return _long_account(job.table("dead_letters", job.LETTERS)).select(
        "_topic", "event_id", "account_id", "_retry_count", "_fatal_error")


@query
def stream_dim_date(d: Domain) -> DataFrame:
    job = _live(d)
    return job.table("dim_date", job.DATES).drop("full_date", "batch_id")


@query
def stream_job_metrics(d: Domain) -> DataFrame:
    return _live(d).metrics()


def _landing(raw: dict[str, DataFrame], keep: dict, at: str) -> dict[str, DataFrame]:
    """The rows of the raw datasets that ``keep`` names a filter for, ingested at a time."""
    return {name: raw[name].where(rows).withColumn("_ingested_at", F.lit(at).cast("timestamp")) for name, rows in keep.items()}


@query
def daily_incremental(d: Domain) -> DataFrame:
    """Health figures after three incremental runs: a first load with half of the tickets unresolved, more
    events, and the rest with late events and the resolved tickets."""
    root, day = scratch_folder(d.spark), F.dayofmonth("timestamp")
    # two of the runs take tickets, so the landing of these is written once
    raw = {**d.raw, "support_tickets": storage.stage(d.raw["support_tickets"], scratch_folder(d.spark), "landing", "support_tickets")}
    late, even = F.crc32("event_id") % 40 == 0, F.crc32("ticket_id") % 2 == 0
    first = _landing(raw, dict(accounts="true", users="true", subscriptions="true", invoices="true", support_tickets="true",
                             product_events=~late & (day <= 10)), "2024-01-11 00:00:00")
    tickets = first["support_tickets"]
    first["support_tickets"] = tickets.withColumns({
        "status": F.when(even, "open").otherwise(F.col("status")), "resolved_at": F.when(~even, F.col("resolved_at"))})
    incremental.run_increment(d.spark, first, root, "day1", "2024-01-11 00:00:00")
    incremental.run_increment(d.spark, _landing(raw, dict(product_events=~late & day.between(11, 20)), "2024-01-21 00:00:00"), root, "day2", "2024-01-21 00:00:00")
    rest = dict(product_events=late | (day > 20), support_tickets=even)
    incremental.run_increment(d.spark, _landing(raw, rest, B.USAGE_AS_OF), root, "day3", B.USAGE_AS_OF)
    mart = storage.read_published(d.spark, root, "mrt_customer_health")
    return _long_account(mart).select("account_id", "plan", "events_last_30d", "active_users_30d", "open_tickets", "critical_tickets")


@query
def stream_late_events(d: Domain) -> DataFrame:
    """Hourly usage of a warehouse that has taken in a first load, two micro-batches and the late events of a third."""
    root, usage_events = scratch_folder(d.spark), _as_events(d.stream_events).where(F.col("_topic") == "product.events")
    day, late = F.dayofmonth("timestamp"), F.crc32("event_id") % 25 == 0
    loaded = dict(accounts="true", users="true", subscriptions="true", invoices="true", support_tickets="true",
                  product_events=(F.crc32(F.concat(F.lit("p"), F.col("event_id"))) % 25 != 0) & (day <= 10))
    first = _landing(d.raw, loaded, "2024-01-11 00:00:00")
    first["product_events"] = first["product_events"].withColumn("event_id", F.concat(F.lit("p"), F.col("event_id")))
    incremental.run_increment(d.spark, first, root, "day1", "2024-01-11 00:00:00")
    parts = [usage_events.where(~late & day.between(8, 20)), usage_events.where(~late & (day > 20)), usage_events.where(late)]
    job = _drain(d, parts, warehouse=root)
    incremental.run_increment(d.spark, {}, root, "day2", B.USAGE_AS_OF, live=job)
    return storage.read_dates(d.spark, root, "usage_hours", incremental.HOURS).drop("event_date")


def _feed(d: Domain) -> LiveJob:
    """Billing events as lines of text, in three files and a fourth with a tenth of
    them again, drained one file a batch.  Some lines are cut off, some have a
    time that is none, some no status."""
    root, at = scratch_folder(d.spark), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    priority, amount = F.col("o_orderpriority"), F.col("o_totalprice").cast("decimal(10,2)").cast("string")
    status = F.when(priority == "4-NOT SPECIFIED", "").otherwise('"status":"paid",')
    time = F.when(priority == "3-MEDIUM", "noon").otherwise(at)
    line = F.concat(F.lit('{"event_id":"b'), "o_orderkey", F.lit('","account_id":"'), "o_custkey", F.lit('","invoice_id":"'), "o_orderkey",
                    F.lit('","amount":'), amount, F.lit(","), status, F.lit('"timestamp":"'), time, F.lit('"'))
    lines = d.table("orders").select("o_orderkey", F.concat(line, F.when(priority == "5-LOW", "").otherwise("}")).alias("value"))
    lines.select("value").repartition(3).write.text(f"{root}/in/billing.events")
    lines.where("o_orderkey % 10 = 0").select("value").coalesce(1).write.mode("append").text(f"{root}/in/billing.events")
    job = LiveJob(d.spark, f"{root}/live", clock=_clock)
    job.start(read_topics(d.spark, f"{root}/in", 1, ["billing.events"]), f"{root}/checkpoint").awaitTermination()
    return job


@query
def stream_malformed(d: Domain) -> DataFrame:
    """Dead letters of a feed with unreadable lines, with their text."""
    job = _feed(d)
    return job.table("dead_letters", job.LETTERS).select(
        F.col("_fatal_error").alias("reason"), F.coalesce("_raw", "invoice_id").alias("record"))


@query
def stream_malformed_metrics(d: Domain) -> DataFrame:
    """What became of every line of that feed."""
    return _feed(d).metrics()


@query
def stream_windowed_usage(d: Domain) -> DataFrame:
    """Hourly counts: those the watermark has closed, and the open ones; whether the users are counted closely enough."""
    hourly, mark = _drained(d, windows.windowed_usage(d._events(d.arriving("events"))))
    complete = windows.with_open_windows(hourly, d.events, mark)
    exact = d.events.groupBy("feature", F.window("timestamp", "1 hour").alias("w")).agg(F.count_distinct("user_id").alias("users"))
    both = complete.join(exact.select("feature", F.col("w.start").alias("window_start"), "users"), ["feature", "window_start"])
    off = F.abs(F.col("approx_users") - F.col("users"))
    return both.select("feature", "window_start", "window_end", "event_count",
                       (off <= F.greatest(F.lit(1.0), 4 * windows.USERS_ERROR * F.col("users"))).alias("users_close"))


@query
def stream_sessions(d: Domain) -> DataFrame:
    """User sessions: those the watermark has closed, and the open ones."""
    sessions, _ = _drained(d, windows.session_usage(d._events(d.arriving("events"))))
    return windows.with_open_sessions(sessions, d.events)


# ------------------------------------------------------------------- sketches

@query
def usage_sketches(d: Domain) -> DataFrame:
    """Users of every feature from one stored sketch a day, and whether each estimate is within its error."""
    path = f"{scratch_folder(d.spark)}/usage_users"
    storage.overwrite(sketches.daily_users(d.usage, ["feature"]), path)
    found = sketches.united(d.spark.read.parquet(path), ["feature"])
    exact = d.usage.groupBy("feature").agg(F.count_distinct("user_id").alias("users"))
    return found.join(exact, "feature").select("feature", "events", sketches.close_to(F.col("approx_users"), F.col("users")).alias("close"))


@query
def dau_mau_sketches(d: Domain) -> DataFrame:
    """Daily and trailing active users from one sketch a day, against the exact numbers."""
    found = sketches.active_users(sketches.daily_users(d.usage)).join(usage.dau_mau(d.usage), "event_date")
    return _date_text(found.select(
        "event_date", sketches.close_to(F.col("approx_dau"), F.col("dau")).alias("dau_close"),
        sketches.close_to(F.col("approx_mau"), F.col("mau")).alias("mau_close")))
