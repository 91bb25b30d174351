"""The daily batch: raw landings to a published warehouse run."""

from __future__ import annotations

from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators import anomaly, churn, expansion, facts, forecast, health, quality, revenue, rules, usage
from tidemark.sources import storage

# Tables whose rows count as processed records.
COUNTED_TABLES = ("fact_usage", "dim_account", "fact_billing", "fact_support")


def run_daily(spark: SparkSession, raw: dict[str, DataFrame], root: str, run_id: str, as_of,
              quarantined: dict[str, DataFrame] | None = None, recipients: dict | None = None,
              train_churn: bool = True, documented_rules: bool = False, detected_anomalies: bool = False) -> dict:
    """Build, check and publish all tables of one run; returns a small summary.

    Every table is written once and read back, so later steps start from files
    instead of repeating the cleaning.  Alerts carry over from the published
    run with their acknowledgements.  If a step fails nothing is published and
    the failure is recorded in the run audit.  ``quarantined`` rows are kept with
    the run.  ``documented_rules`` adds the alerts of weekly falls and of critical
    backlogs; with ``detected_anomalies`` the mart's flag comes from the usage
    anomalies instead of the cohort.
    """
    started = datetime.now(timezone.utc)
    run = Run(spark, root, run_id)
    with audited(spark, root, run_id, started):
        for name, rejected in (quarantined or {}).items():
            run.put(f"quarantine_{name}", rejected)
        summary = _build(run, raw, as_of, recipients, train_churn, documented_rules, detected_anomalies)
    return run.finish(started, summary)


@contextmanager
def audited(spark: SparkSession, root: str, run_id: str, started: datetime):
    """Record a failure in the run audit and pass it on."""
    try:
        yield
    except Exception as problem:
        storage.append_run_audit(spark, root, run_id=run_id, layer="gold", status="FAILED", records=0,
                                 started_at=started, completed_at=datetime.now(timezone.utc), error=str(problem))
        raise


class Run:
    """Writes the tables of one run and remembers which."""

    def __init__(self, spark: SparkSession, root: str, run_id: str):
        self.spark, self.root, self.run_id = spark, root, run_id
        self.tables: list[str] = []  # written; of dated tables, name/date
        self.removed: list[str] = []
        self.based_on: dict[str, str | None] = {}  # runs of the published tables that were merged into
        self.marks: dict[str, object] = {}
        self.counts: dict[str, Observation] = {}
        self.fired: DataFrame | None = None
        self.alerts_from: str | None = None

    def put(self, name: str, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        if name in COUNTED_TABLES:  # counted while they are written
            self.counts[name] = Observation()
            df = df.observe(self.counts[name], F.count(F.lit(1)).alias("rows"))
        written = storage.stage(df, self.root, self.run_id, name, partition_by)
        self.tables.append(name)
        return written

    def finish(self, started: datetime, summary: dict) -> dict:
        """Record the run and make its tables the current ones."""
        records = sum(storage.observed(count).get("rows", 0) for count in self.counts.values())
        storage.append_run_audit(self.spark, self.root, run_id=self.run_id, layer="gold", status="SUCCESS", records=records,
                                 started_at=started, completed_at=datetime.now(timezone.utc))
        _publish_alerts(self, lambda stored: rules.upsert_alerts(stored, self.fired), self.alerts_from)
        return {"run_id": self.run_id, "records_processed": records, **summary}


def _build(run: Run, raw: dict[str, DataFrame], as_of, recipients: dict | None, train_churn: bool,
           documented_rules: bool, detected_anomalies: bool) -> dict:
    put = run.put

    # The accounts are read by every foreign-key filter, so they are written first.
    silver = facts.clean(raw)
    accounts = put("dim_account", facts.dim_account(silver["accounts"]))
    users = put("dim_user", facts.dim_user(silver["users"]))
    plans = put("dim_plan", facts.dim_plan(run.spark))
    subscriptions = put("fact_subscription", facts.fact_subscription(silver["subscriptions"]))
    billing = put("fact_billing", facts.fact_billing(silver["invoices"], as_of))
    support = put("fact_support", facts.fact_support(silver["support_tickets"], as_of))
    events = put("fact_usage", facts.fact_usage(silver["product_events"]), "event_date")
    put("dim_date", facts.dim_date(events, "event_date"))
    mart = health.customer_health(accounts, subscriptions, events, support, billing, as_of)
    falls = None
    if documented_rules:
        to = as_of[:10] if isinstance(as_of, str) else as_of.date().isoformat()
        standing = health.account_standing(accounts, subscriptions, billing)
        falls = health.health_drops(health.health_daily(events, support, standing, last_day=to)).where(F.col("date_key") == F.lit(to).cast("date"))
    return build_marts(run, mart, accounts=accounts, users=users, plans=plans, subscriptions=subscriptions, billing=billing,
                       daily_usage=usage.daily_usage_by_account(events), checked_usage=events, open_tickets=support, as_of=as_of,
                       recipients=recipients, train_churn=train_churn, falls=falls, documented_rules=documented_rules,
                       detected_anomalies=detected_anomalies)


def build_marts(run: Run, mart: DataFrame, *, accounts: DataFrame, users: DataFrame, plans: DataFrame, subscriptions: DataFrame,
                billing: DataFrame, daily_usage: DataFrame, checked_usage: DataFrame, open_tickets: DataFrame, as_of,
                recipients: dict | None, train_churn: bool, falls: DataFrame | None = None, documented_rules: bool = False,
                detected_anomalies: bool = False) -> dict:
    """What follows from the facts: marts, scores, alerts, checks.

    ``checked_usage`` are the facts that the checks look at, ``open_tickets`` at least all unresolved ones.
    """
    spark, root, put = run.spark, run.root, run.put
    anomalies = put("usage_anomalies", anomaly.usage_anomalies(daily_usage))
    mart = put("mrt_customer_health", health.flag_anomalies(mart, anomalies) if detected_anomalies else mart)
    summary = put("mrt_revenue_summary", revenue.revenue_summary(accounts, subscriptions, billing, as_of))
    put("expansion_opportunities", expansion.expansion_scores(mart, plans))
    put("revenue_forecast", forecast.revenue_forecast(summary))

    alerts = rules.evaluate(mart, billing, accounts, plans, as_of)
    if documented_rules:
        alerts = alerts.unionByName(rules.backlog_alerts(open_tickets, accounts, as_of))
        if falls is not None:
            alerts = alerts.unionByName(rules.drop_alerts(falls, accounts, as_of))
    run.fired = fired = put("alerts_fired", alerts)
    run.alerts_from, stored = _stored_alerts(spark, root)
    put("automation_alerts", rules.upsert_alerts(stored, fired))
    put("notification_outbox", rules.notification_outbox(fired, recipients))

    training = None
    if train_churn:
        model, training = churn.train_churn_model(churn.churn_features(mart))
        put("churn_scores", churn.score_accounts(model, mart))
        if model is not None:
            model.write().overwrite().save(f"{root}/run_id={run.run_id}/churn_model")

    checks = quality.run_passes(spark, quality.standard_passes(accounts, users, checked_usage, mart))
    put("data_quality_checks", checks)
    report = quality.report(checks, as_of).first().asDict()
    return {"quality": report, "training": training}


def acknowledge(spark: SparkSession, root: str, requests: DataFrame, run_id: str, as_of) -> DataFrame:
    """Apply acknowledgements to the published alerts and publish the result.

    Returns the requests for alerts that do not exist.
    """
    seen, stored = _stored_alerts(spark, root)
    if seen is None:
        raise ValueError("no published alerts")
    run = Run(spark, root, run_id)
    run.put("automation_alerts", rules.acknowledge(stored, requests, as_of))
    _publish_alerts(run, lambda alerts: rules.acknowledge(alerts, requests, as_of), seen)
    return rules.acknowledge_errors(_stored_alerts(spark, root)[1], requests)


def _stored_alerts(spark: SparkSession, root: str) -> tuple[str | None, DataFrame]:
    """The published alerts and the run they are from."""
    seen = storage.current_runs(spark, root).get("automation_alerts")
    if seen is None:
        return None, spark.createDataFrame([], S.struct(S.WAREHOUSE["automation_alerts"]))
    return seen, spark.read.parquet(f"{root}/run_id={seen}/automation_alerts")


def _publish_alerts(run: Run, change, seen: str | None) -> None:
    """Publish a run; where the alerts were published anew meanwhile, apply ``change`` to those first.

    A conflict on any other table that the run was merged into is passed on: the run has to be made again.
    """
    while True:
        try:
            storage.publish(run.spark, run.root, run.run_id, run.tables, datetime.now(timezone.utc),
                            {**run.based_on, "automation_alerts": seen}, run.marks, run.removed)
            return
        except storage.PublishConflict:
            now = storage.current_runs(run.spark, run.root)
            if any(now.get(name) != found for name, found in run.based_on.items()):
                raise
            seen, stored = _stored_alerts(run.spark, run.root)
            storage.stage(change(stored), run.root, run.run_id, "automation_alerts")
