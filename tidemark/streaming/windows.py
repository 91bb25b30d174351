"""Event-time windows on a usage stream, with a watermark for late data.

Rows later than the watermark are dropped by these aggregates; the live job marks
them, and an incremental run restates their dates.  A stream emits what the watermark
has closed; ``with_open_windows`` and ``with_open_sessions`` add what it has not, from
the newest events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

WATERMARK = "2 hours"
USERS_ERROR = 0.05  # standard error of approx_users


def _counts(grouped) -> DataFrame:
    # Exact distinct counts are not available on streams.
    return grouped.agg(F.count(F.lit(1)).alias("event_count"),
                       F.approx_count_distinct("user_id").alias("approx_users"))


def windowed_usage(events: DataFrame, width: str = "1 hour", slide: str | None = None, by: str = "feature",
                   time: str = "timestamp", watermark: str = WATERMARK) -> DataFrame:
    """Tumbling (no ``slide``) or sliding counts per ``by``."""
    window = F.window(time, width, slide) if slide else F.window(time, width)
    counted = _counts(events.withWatermark(time, watermark).groupBy(by, window.alias("w")))
    return counted.select(by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                          "event_count", "approx_users")


def session_usage(events: DataFrame, gap: str = "1 hour", by: str = "user_id", time: str = "timestamp",
                  watermark: str = WATERMARK) -> DataFrame:
    """Sessions per ``by``; runs in append mode."""
    grouped = events.withWatermark(time, watermark).groupBy(by, F.session_window(time, gap).alias("w"))
    counted = grouped.agg(F.count(F.lit(1)).alias("event_count"))
    return counted.select(by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_count")


def drop_repeats(events: DataFrame, time: str = "timestamp", watermark: str = WATERMARK) -> DataFrame:
    """Deduplicate ahead of a windowed aggregate, within the watermark."""
    return events.withWatermark(time, watermark).dropDuplicatesWithinWatermark(["_event_hash"])


def watermark_of(query: StreamingQuery) -> str:
    """The watermark that the last finished trigger of a query ended with, as an instant."""
    marks = [p["eventTime"]["watermark"] for p in query.recentProgress if "watermark" in (p.get("eventTime") or {})]
    return max(marks, default="1970-01-01T00:00:00.000Z")


def with_open_windows(emitted: DataFrame, events: DataFrame, watermark: str, width: str = "1 hour", by: str = "feature",
                      time: str = "timestamp") -> DataFrame:
    """Emitted tumbling windows and those the watermark has not closed; the events read are those since it, less one width."""
    mark = F.lit(watermark).cast("timestamp")
    recent = events.where(F.col(time) >= mark - F.expr(f"INTERVAL {width}"))
    still_open = _counts(recent.groupBy(by, F.window(time, width).alias("w"))).select(
        by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_count", "approx_users")
    return emitted.unionByName(still_open.where(F.col("window_end") > mark))


def with_open_sessions(emitted: DataFrame, events: DataFrame, gap: str = "1 hour", by: str = "user_id", time: str = "timestamp") -> DataFrame:
    """Emitted sessions and those still open: of the events after each user's last emitted session."""
    over = emitted.groupBy(by).agg(F.max("window_end").alias("_over"))
    left = events.join(over, by, "left").where(F.col("_over").isNull() | (F.col(time) >= F.col("_over")))
    still_open = left.groupBy(by, F.session_window(time, gap).alias("w")).agg(F.count(F.lit(1)).alias("event_count")).select(
        by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_count")
    return emitted.unionByName(still_open)
