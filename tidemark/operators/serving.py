"""Read queries behind the dashboard, risk, usage and alert views.

Sorts end in the primary key, so results at ties are fixed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas as S


def parameterised(spark: SparkSession, text: str, args: dict, **tables: DataFrame) -> DataFrame:
    """SQL text with bound values; ``{name}`` in the text refers to a passed frame."""
    return spark.sql(text, args=args, **tables)


def account_health_lookup(health: DataFrame, account_id) -> DataFrame:
    """The account's row, or no row when it is unknown."""
    return health.where(F.col("account_id") == F.lit(account_id))


def customer_search(health: DataFrame, text: str = "", tier: str = "ALL") -> DataFrame:
    """Case-insensitive part of the company, id or owner, within one tier."""
    needle = F.lit(text.lower())
    hit = F.lit(False)
    for column in ("company_name", "account_id", "csm_owner"):
        hit = hit | F.coalesce(F.lower(F.col(column).cast("string")).contains(needle), F.lit(False))
    found = health.where(hit)
    return found if tier == "ALL" else found.where(F.col("health_tier") == tier)


CHURN_COLUMNS = (
    "account_id", "company_name", "industry", "plan", "mrr", "csm_owner", "health_score", "health_tier",
    "churn_risk_score", "open_tickets", "critical_tickets", "payment_status",
)


def _riskiest_first(health: DataFrame) -> DataFrame:
    return health.orderBy(F.col("churn_risk_score").desc(), "account_id")


def churn_risk_accounts(health: DataFrame) -> DataFrame:
    return _riskiest_first(health.select(*CHURN_COLUMNS))


def churn_risk_bands(health: DataFrame) -> DataFrame:
    score = F.col("churn_risk_score")
    return health.agg(
        F.count_if(score >= S.BAND_HIGH_FROM).alias("high_risk_count"),
        F.count_if((score >= S.BAND_MODERATE_FROM) & (score < S.BAND_HIGH_FROM)).alias("moderate_risk_count"),
        F.count_if(score < S.BAND_MODERATE_FROM).alias("low_risk_count"),
        F.count(F.lit(1)).alias("total_evaluated"),
    )


def high_risk_accounts(health: DataFrame, score_from: float = S.HIGH_RISK_LIST_FROM) -> DataFrame:
    listed = health.where(F.col("churn_risk_score") >= score_from)
    return _riskiest_first(listed.select(
        "account_id", "company_name", "mrr", "health_score", "churn_risk_score", "open_tickets", "payment_status"))


def top_risk_accounts(health: DataFrame, n: int = 5) -> DataFrame:
    critical = health.where(F.col("health_tier") == "Critical")
    return _riskiest_first(critical.select(
        "account_id", "company_name", "mrr", "health_score", "churn_risk_score", "csm_owner")).limit(n)


def health_distribution(health: DataFrame) -> DataFrame:
    return health.groupBy("health_tier").agg(F.count(F.lit(1)).alias("accounts"))


def health_distribution_map(health: DataFrame) -> DataFrame:
    """The distribution as one map, with 0 for a tier nobody is in."""
    tiers = ("Healthy", "At Risk", "Critical")
    counts = [F.count_if(F.col("health_tier") == t).alias(t) for t in tiers]
    pairs = [x for t in tiers for x in (F.lit(t), F.col(f"`{t}`"))]
    return health.agg(*counts).select(F.create_map(*pairs).alias("health_distribution"))


def recent_events(usage: DataFrame, limit: int = 25) -> DataFrame:
    if not 1 <= limit <= 100:
        raise ValueError("limit must be between 1 and 100")
    return usage.select(F.col("usage_id").alias("event_id"), "account_id", "user_id", "feature",
                        "event_timestamp").orderBy(F.col("event_timestamp").desc(), "event_id").limit(limit)


def alerts_by_status(alerts: DataFrame, status: str | None = None) -> DataFrame:
    chosen = alerts if status is None else alerts.where(F.col("status") == status)
    return chosen.orderBy(F.col("created_at").desc(), "alert_id")


def recent_open_alerts(alerts: DataFrame, n: int = 5) -> DataFrame:
    return alerts_by_status(alerts, "open").select(
        "alert_id", "account_id", "alert_type", "severity", "trigger_reason", "status", "created_at").limit(n)
