"""Distinct users from sketches that merge.

A sketch of each day's (or account's, or feature's) users is stored once; a window or a
total unites stored sketches instead of reading the events again.  They are HyperLogLog
sketches of 2 ** ``lg_k`` registers: the standard error is about 0.83 / sqrt(2 ** lg_k)
(1.3 % at the default), and small sets are counted exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 12
STANDARD_ERROR = 0.83 / 2 ** (LG_K / 2)


def daily_users(usage: DataFrame, by: Sequence[str] = (), lg_k: int = LG_K) -> DataFrame:
    """``events`` and a sketch ``users`` of every day, or of every day and ``by``."""
    per_user = usage.groupBy(*by, "event_date", "user_id").agg(F.count(F.lit(1)).alias("_n"))
    user = F.col("user_id").cast("string")
    return per_user.groupBy(*by, "event_date").agg(F.sum("_n").alias("events"), F.hll_sketch_agg(user, F.lit(lg_k)).alias("users"))


def united(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Events and distinct users of groups of stored sketches."""
    return sketches.groupBy(*by).agg(
        F.sum("events").alias("events"), F.hll_sketch_estimate(F.hll_union_agg("users")).alias("approx_users"))


def active_users(daily: DataFrame, days: int = 30) -> DataFrame:
    """Daily and trailing active users from one sketch a day; each is repeated over the ``days`` windows that hold it."""
    last = daily.agg(F.max(F.unix_date("event_date"))).scalar()
    day = F.unix_date("event_date")
    spread = daily.select("users", F.explode(F.sequence(day, F.least(day + F.lit(days - 1), last))).alias("_day"))
    trailing = spread.groupBy("_day").agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias("approx_mau"))
    own = daily.select(day.alias("_day"), "event_date", F.hll_sketch_estimate("users").alias("approx_dau"))
    return own.join(trailing, "_day").select("event_date", "approx_dau", "approx_mau")


def close_to(estimate, exact, errors: float = 4.0):
    """Whether an estimate lies within so many standard errors, and 1, of the exact number."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), F.lit(errors * STANDARD_ERROR) * exact)
