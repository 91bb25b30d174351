"""Product-usage aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators.ranking import presence_changes

def trailing_usage(usage: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Events and distinct users per account since ``as_of - days`` (inclusive).

    Counted per (account, user) first, so no task holds all rows of one account.
    """
    since = C.as_timestamp(as_of) - F.make_dt_interval(F.lit(days))
    recent = usage.where(F.col("event_timestamp") >= since)
    per_user = recent.groupBy("account_id", "user_id").agg(F.count("usage_id").alias("n"))
    return per_user.groupBy("account_id").agg(
        F.sum("n").alias("events_last_30d"), F.count("user_id").alias("active_users_30d")
    )


def usage_totals(usage: DataFrame, approximate: bool = False) -> DataFrame:
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return usage.agg(F.count(F.lit(1)).alias("total_events"), distinct("user_id").alias("active_users"))


def feature_counts(usage: DataFrame) -> DataFrame:
    return usage.groupBy("feature").agg(F.count(F.lit(1)).alias("event_count"))


def top_features(usage: DataFrame, n: int = 10) -> DataFrame:
    return feature_counts(usage).orderBy(F.col("event_count").desc(), "feature").limit(n)


def feature_share_of_max(usage: DataFrame) -> DataFrame:
    """Each feature's count as a whole percentage of the largest count."""
    counts = feature_counts(usage)
    largest = counts.agg(F.max("event_count")).scalar()
    return counts.withColumn("share_of_max", F.round(F.col("event_count") * 100.0 / largest).cast("int"))


def daily_counts(usage: DataFrame) -> DataFrame:
    return usage.groupBy("event_date").agg(F.count(F.lit(1)).alias("daily_events"))


def daily_usage_trend(usage: DataFrame, days: int = 30) -> DataFrame:
    """The latest ``days`` observed dates, oldest first."""
    return daily_counts(usage).orderBy(F.col("event_date").desc()).limit(days).orderBy("event_date")


def daily_usage_by_account(usage: DataFrame) -> DataFrame:
    return usage.groupBy("account_id", "event_date").agg(F.count(F.lit(1)).alias("daily_events"))


# ------------------------------------------------------------- time windows

def tumbling(usage: DataFrame, width: str = "1 hour", by: str = "feature") -> DataFrame:
    return (
        usage.groupBy(by, F.window("event_timestamp", width).alias("w"))
        .agg(F.count(F.lit(1)).alias("event_count"))
        .select(by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_count")
    )


def sliding(usage: DataFrame, width: str = "1 day", slide: str = "1 hour", by: str = "feature") -> DataFrame:
    """Sliding counts; events are counted per slide first and only those counts
    are repeated over the windows that contain them."""
    slots = tumbling(usage, slide, by)
    return (
        slots.groupBy(by, F.window("window_start", width, slide).alias("w"))
        .agg(F.sum("event_count").alias("event_count"))
        .select(by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_count")
    )


def sessions(usage: DataFrame, gap_seconds: int = 3600, by: str = "user_id") -> DataFrame:
    """Activity sessions: an event within ``gap_seconds`` of the last one extends it.

    Events are first counted per slot of one gap width: two events of one slot
    are always closer than the gap, so a slot never spans a session break and
    only the slot summaries go through the per-user window.
    """
    gap = gap_seconds * 1_000_000
    slots = usage.groupBy(by, C.slot_start(F.unix_micros("event_timestamp"), gap).alias("_slot")).agg(
        F.min("event_timestamp").alias("_from"), F.max("event_timestamp").alias("_to"),
        F.count(F.lit(1)).alias("_n"),
    )
    in_time = Window.partitionBy(by).orderBy("_slot")
    idle = F.unix_micros("_from") - F.unix_micros(F.lag("_to").over(in_time))
    numbered = slots.withColumn("_starts", F.when(idle.isNull() | (idle >= gap), 1).otherwise(0)).withColumn(
        "session_no", F.sum("_starts").over(in_time.rowsBetween(Window.unboundedPreceding, 0))
    )
    return numbered.groupBy(by, "session_no").agg(
        F.min("_from").alias("session_start"), F.max("_to").alias("session_end"), F.sum("_n").alias("event_count")
    )


# ------------------------------------------------------- stickiness, adoption

def dau_mau(usage: DataFrame, days: int = 30) -> DataFrame:
    """Daily active users, users active in the trailing ``days``, and their ratio."""
    seen = usage.select("user_id", F.unix_date("event_date").alias("_day"))
    changes = presence_changes(seen, [], "user_id", "_day", {"mau": days})
    per_day = changes.groupBy("_day").agg(F.sum("members").alias("dau"), F.sum("mau").alias("mau"))
    # One row per calendar day, hence the unpartitioned window.
    upto = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, 0)
    return per_day.withColumn("mau", F.sum("mau").over(upto)).where("dau > 0").select(
        F.date_from_unix_date("_day").alias("event_date"), "dau", "mau",
        F.round(C.ratio(F.col("dau"), F.col("mau")), 4).alias("stickiness"),
    )


def feature_adoption(usage: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Share of the accounts active in the trailing window that used each feature."""
    since = C.as_timestamp(as_of) - F.make_dt_interval(F.lit(days))
    used = usage.where(F.col("event_timestamp") >= since).select("feature", "account_id").distinct()
    active = used.agg(F.count_distinct("account_id")).scalar()
    return used.groupBy("feature").agg(F.count("account_id").alias("adopting_accounts")).select(
        "feature", "adopting_accounts", active.alias("active_accounts"),
        C.percent(F.col("adopting_accounts"), active).alias("adoption_pct"),
    )


def feature_adoption_weekly(usage: DataFrame) -> DataFrame:
    """Per ISO week and feature: adopting accounts, active accounts, events."""
    week = F.date_trunc("week", "event_timestamp").cast("date").alias("week_start")
    counted = usage.groupBy(week, "feature", "account_id").agg(F.count(F.lit(1)).alias("n"))
    per_feature = counted.groupBy("week_start", "feature").agg(
        F.count("account_id").alias("adopting_accounts"), F.sum("n").alias("event_count")
    )
    per_week = counted.groupBy("week_start").agg(F.count_distinct("account_id").alias("active_accounts"))
    return per_feature.join(per_week, "week_start").select(
        "week_start", "feature", "adopting_accounts", "active_accounts", "event_count",
        C.percent(F.col("adopting_accounts"), F.col("active_accounts")).alias("adoption_pct"),
    )
