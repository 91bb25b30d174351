"""Effect of stream events on customer health.

An event changes a score x to clamp(x + d, 0, 100).  Such functions compose to
functions of the same form, clamp(x + d, lo, hi), so the events of one account
can be combined in parts - blocks of consecutive events, runs of blocks, then in
total - and no task has to hold all events of a busy account or second.  Scores are
kept in whole tenths, which makes the result exact and the same whatever the parts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions import columns as C
from tidemark.operators.scans import blocks_of_blocks, in_blocks
from tidemark.streaming.events import TOPICS

FULL = 1000  # 100.0 in tenths

# Score changes.
PRODUCT_GAIN = 0.1
FAILED_PAYMENT = -25.0
LOST_SUBSCRIPTION = -30.0
SUPPORT_PENALTY = {"high": -15.0, "medium": -5.0}
LOST_STATUSES = ("cancelled", "churned")

def _tenths(points: float) -> int:
    scaled = round(points * 10)
    if abs(scaled - points * 10) > 1e-9:
        raise ValueError(f"score changes are whole tenths, got {points}")
    return scaled


def event_effects(events: DataFrame, support_penalty: Mapping[str, float] = SUPPORT_PENALTY) -> DataFrame:
    """Rows that change health, as (account, order columns, d, lo, hi, marks).

    ``support_penalty`` is by severity; a severity it does not name costs
    nothing.  Statuses without an effect are left out.
    """
    topic, status = F.col("_topic"), F.col("status")
    penalty = C.lookup(F.col("severity"), {k: _tenths(v) for k, v in support_penalty.items()}, 0)
    is_product = topic == "product.events"
    failed = (topic == "billing.events") & (status == "failed")
    lost = (topic == "subscription.events") & status.isin(*LOST_STATUSES)
    change = (
        F.when(is_product, _tenths(PRODUCT_GAIN)).when(failed, _tenths(FAILED_PAYMENT))
        .when(lost, _tenths(LOST_SUBSCRIPTION)).when((topic == "support.events") & (penalty != 0), penalty)
    )
    rank = C.lookup(topic, {t: i for i, t in enumerate(TOPICS)}, len(TOPICS))
    return events.select(
        "account_id", rank.alias("topic_rank"), F.unix_micros("timestamp").alias("at"),
        F.col("event_id").cast("string").alias("event_id"), change.cast("int").alias("d"),
        F.lit(0).alias("lo"), F.lit(FULL).alias("hi"), is_product.cast("bigint").alias("product_events"),
        F.coalesce(failed, F.lit(False)).alias("payment_failed"), F.coalesce(lost, F.lit(False)).alias("forced"),
    ).where(F.col("d").isNotNull() & F.col("account_id").isNotNull())


def _within(x: Column, lo: Column, hi: Column) -> Column:
    return F.greatest(lo, F.least(hi, x))


def compose(effects: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One effect per ``keys``, equal to applying the rows in ``order`` one by one."""
    step = F.struct(*order, "d", "lo", "hi")
    grouped = effects.groupBy(*keys).agg(
        F.sort_array(F.collect_list(step)).alias("_steps"), F.max(F.struct(*order, "forced", "last_at")).alias("_last"),
        F.sum("product_events").alias("product_events"), F.bool_or("payment_failed").alias("payment_failed"),
    )

    def after(f: Column, g: Column) -> Column:
        # A change of more than the whole scale is the same as the whole scale.
        return F.struct(_within(f["d"] + g["d"], F.lit(-FULL), F.lit(FULL)).alias("d"),
                        _within(f["lo"] + g["d"], g["lo"], g["hi"]).alias("lo"),
                        _within(f["hi"] + g["d"], g["lo"], g["hi"]).alias("hi"))

    same = F.struct(F.lit(0).alias("d"), F.lit(0).alias("lo"), F.lit(FULL).alias("hi"))
    return grouped.withColumn("_f", F.aggregate("_steps", same, after)).select(
        *keys, "_f.d", "_f.lo", "_f.hi", "product_events", "payment_failed", "_last.forced", "_last.last_at")


def account_effects(effects: DataFrame, drain_order: bool = False) -> DataFrame:
    """One effect per account, in event-time order (ties: topic, event id).

    With ``drain_order`` whole topics are applied one after another, each in
    event-time order.
    """
    topic = ["topic_rank"] if drain_order else []
    order = ["at", "topic_rank", "event_id"]
    blocked = in_blocks(effects.withColumn("last_at", F.col("at")), ["account_id", *topic], order)
    per_block = compose(blocked, ["account_id", *topic, "_block"], order)
    per_run = compose(per_block.withColumn("_run", blocks_of_blocks()), ["account_id", *topic, "_run"], ["_block"])
    return compose(per_run, ["account_id"], [*topic, "_run"])


def apply_effects(health: DataFrame, effects: DataFrame) -> DataFrame:
    """Health mart after one composed effect per account.

    Accounts without an effect, and effects of unknown accounts, change nothing.
    A lost subscription as the last effect leaves the tier at Critical.
    """
    tenths = F.round(F.col("health_score") * 10).cast("int")
    score = _within(tenths + F.col("d"), F.col("lo"), F.col("hi")) / F.lit(10.0)
    hit = F.col("d").isNotNull()
    changed = {
        "health_score": score,
        "health_tier": F.when(F.col("forced"), "Critical").otherwise(C.health_tier(score)),
        "events_last_30d": F.col("events_last_30d") + F.col("product_events"),
        "payment_status": F.when(F.col("payment_failed"), S.PAYMENT_TROUBLE).otherwise(F.col("payment_status")),
        "last_updated_at": F.timestamp_micros("last_at"),
    }
    one = effects.select("account_id", "d", "lo", "hi", "product_events", "payment_failed", "forced", "last_at")
    return health.join(one, "account_id", "left").select(*[
        F.when(hit, changed[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c) for c in health.columns
    ])


def replay_health(health: DataFrame, events: DataFrame, drain_order: bool = False,
                  support_penalty: Mapping[str, float] = SUPPORT_PENALTY) -> DataFrame:
    """Batch replay of clean events on a health snapshot."""
    return apply_effects(health, account_effects(event_effects(events, support_penalty), drain_order))
