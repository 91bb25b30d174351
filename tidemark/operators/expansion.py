"""Expansion opportunities from seat and quota utilisation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions import columns as C

# Fixed values.
SEAT_WEIGHT, EVENT_WEIGHT, HEALTH_WEIGHT = 0.40, 0.35, 0.25
HIGH_FROM, MODERATE_FROM = 0.75, 0.45
POTENTIAL_SHARE = 0.80
EVENT_SCALE = 10


def expansion_scores(health: DataFrame, plans: DataFrame) -> DataFrame:
    """Score every account on a known plan, best opportunity first."""
    one = F.lit(1)
    seats = F.least(F.lit(1.0), F.col("active_users_30d") / F.greatest(one, F.col("seat_limit")))
    events = F.least(F.lit(1.0), F.col("events_last_30d") * EVENT_SCALE / F.greatest(one, F.col("event_quota")))
    wellness = C.clamp(F.col("health_score") / 100.0, 0.0, 1.0)
    score = F.round(C.clamp(
        F.col("_seats") * SEAT_WEIGHT + F.col("_events") * EVENT_WEIGHT + wellness * HEALTH_WEIGHT, 0.01, 0.99), 3)
    plan_rows = plans.select(F.col("plan_name").alias("plan"), "seat_limit", "event_quota")
    rated = (
        health.drop("expansion_score").join(plan_rows, "plan")
        .withColumn("_seats", seats).withColumn("_events", events).withColumn("expansion_score", score)
    )
    return rated.select(
        "account_id", "company_name", F.col("plan").alias("current_plan"), F.col("mrr").alias("current_mrr"),
        F.round(F.col("_seats") * 100.0, 1).alias("seat_utilization"),
        F.round(F.col("_events") * 100.0, 1).alias("event_utilization"),
        F.round("health_score", 1).alias("health_score"), "expansion_score",
        F.when(F.col("expansion_score") >= HIGH_FROM, "High")
        .when(F.col("expansion_score") >= MODERATE_FROM, "Moderate").otherwise("Low").alias("opportunity_tier"),
        C.lookup(F.col("plan"), S.NEXT_PLAN, S.DEFAULT_UPGRADE).alias("recommended_plan"),
        F.round(F.col("mrr").cast("double") * POTENTIAL_SHARE, 2).alias("potential_mrr_expansion"),
    ).orderBy(F.col("expansion_score").desc(), "account_id")


def top_opportunities(scores: DataFrame, n: int = 10) -> DataFrame:
    return scores.orderBy(F.col("expansion_score").desc(), "account_id").limit(n)
