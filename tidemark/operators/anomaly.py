"""Usage anomalies of each account's latest observed day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import columns as C

# Fixed values.
BASELINE_DAYS = 14
Z_LIMIT = 2.5
Z_SEVERE = 3.0
WEEKLY_DROP = 0.65
DROP_ACTION = "Trigger CSM check-in on possible product blockage"
SPIKE_ACTION = "Review increased product adoption for expansion opportunity"


def usage_anomalies(daily: DataFrame, calendar: bool = False, keep_normal: bool = False) -> DataFrame:
    """Compare the latest day with the 14 before it, and the last 7 with the 7 before.

    ``daily`` has one row per (account, event_date).  By default days are the
    account's observed days; with ``calendar`` they are calendar days and a day
    without events counts as zero.  Accounts with less history are left out.
    ``keep_normal`` also returns accounts without an anomaly.
    """
    newest_first = Window.partitionBy("account_id").orderBy(F.col("event_date").desc())
    if calendar:
        every = Window.partitionBy("account_id")
        age = F.date_diff(F.max("event_date").over(every), F.col("event_date")) + 1
        dated = daily.withColumn("_age", age).withColumn("_span", F.max("_age").over(every))
    else:
        dated = daily.withColumn("_age", F.row_number().over(newest_first)).withColumn("_span", F.col("_age"))
    recent = dated.where(F.col("_age") <= BASELINE_DAYS + 1)

    # Decimal, so that squares of very large daily counts do not overflow.
    n, age = F.col("daily_events").cast("decimal(18,0)"), F.col("_age")

    def total(low: int, high: int, value=n):
        return F.coalesce(F.sum(F.when(age.between(low, high), value)), F.lit(0))

    sums = recent.groupBy("account_id").agg(
        F.max("event_date").alias("event_date"), F.max("_span").alias("_span"),
        total(1, 1).alias("latest_daily_events"),
        total(2, BASELINE_DAYS + 1).alias("_s1"), total(2, BASELINE_DAYS + 1, n * n).alias("_s2"),
        total(1, 7).alias("_last7"), total(8, 14).alias("_prior7"),
    ).where(F.col("_span") > BASELINE_DAYS)

    # Whole-number moments: the deviation is exactly zero for a constant baseline.
    days = F.lit(BASELINE_DAYS)
    mean = F.col("_s1").cast("double") / days
    deviation = F.sqrt((days * F.col("_s2") - F.col("_s1") * F.col("_s1")).cast("double")) / days
    gap = F.col("latest_daily_events").cast("double") - F.col("_mean")
    spread = F.when(F.col("_std") > 0, F.col("_std")).otherwise(F.col("_mean"))
    weekly = C.ratio(F.col("_last7") - F.col("_prior7"), F.col("_prior7"))
    measured = (
        sums.withColumn("_mean", mean).withColumn("_std", deviation)
        .withColumn("_z", C.ratio(gap, spread, 0.0)).withColumn("_wow", weekly)
    )
    z = F.col("_z")
    dropped = (z < -Z_LIMIT) | F.coalesce(F.col("_wow") <= -WEEKLY_DROP, F.lit(False))
    spiked = z > Z_LIMIT
    kind = F.col("anomaly_type")
    result = measured.withColumn(
        "anomaly_type", F.when(dropped, "Severe Usage Drop").when(spiked, "Usage Spike")
    ).select(
        "account_id", "event_date", F.col("latest_daily_events").cast("bigint").alias("latest_daily_events"),
        F.round("_mean", 2).alias("historical_mean"), F.round("_std", 2).alias("historical_std"),
        F.round("_z", 2).alias("z_score"), F.round(F.col("_wow") * 100.0, 2).alias("wow_change_pct"), kind,
        F.when(kind.isNotNull(), F.when(
            F.when(dropped, z < -Z_SEVERE).otherwise(z > Z_SEVERE), "high").otherwise("medium")).alias("severity"),
        F.when(kind == "Severe Usage Drop", DROP_ACTION).when(kind == "Usage Spike", SPIKE_ACTION)
        .alias("suggested_action"),
    )
    return result if keep_normal else result.where(kind.isNotNull())
