"""Stream-event operators shared by the live job, the batch replay and redrive.

All topics are normalised to one row shape (``EVENT_FIELDS``), so validation,
deduplication and dead-lettering are written once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators.keyed import keep_first, with_attributes

# Topics in drain order and the fields each must carry.
REQUIRED = {
    "product.events": ("event_id", "account_id", "user_id", "feature", "timestamp"),
    "subscription.events": ("event_id", "account_id", "status", "timestamp"),
    "billing.events": ("event_id", "account_id", "invoice_id", "amount", "status", "timestamp"),
    "support.events": ("event_id", "ticket_id", "account_id", "severity", "status", "timestamp"),
}
TOPICS = tuple(REQUIRED)
LABELS = {"product.events": "Product", "subscription.events": "Subscription",
          "billing.events": "Billing", "support.events": "Support"}
# Topics whose events are stored as facts and must refer to known keys.
KEYED_TOPICS = ("product.events",)
MAX_RETRIES = 3

EVENT_TYPES = {
    "event_id": "STRING", "account_id": "STRING", "user_id": "STRING", "feature": "STRING",
    "ticket_id": "STRING", "invoice_id": "STRING", "amount": "DECIMAL(10,2)", "severity": "STRING",
    "status": "STRING", "timestamp": "TIMESTAMP",
}
EVENT_FIELDS = tuple(EVENT_TYPES)
# The fields two events with one idempotency key can differ in.
COPY_ORDER = ("_topic", "severity", "status", "amount", "invoice_id", "ticket_id", "user_id")
EVENT_DDL = ", ".join(f"{name} {kind}" for name, kind in EVENT_TYPES.items()) + (
    ", payload STRUCT<session_duration_ms: INT, client_ip: STRING>")
# A line that does not parse, or a field that does not have its type, is kept whole.
READ_DDL = f"{EVENT_DDL}, _corrupt_record STRING"


def normalise(events: DataFrame, topic: str) -> DataFrame:
    """Bring one topic to the common shape; fields it lacks become null.

    ``_raw`` is the text of a record that could not be read as such, else null.
    """
    raw = F.col("_corrupt_record") if "_corrupt_record" in events.columns else F.lit(None).cast("string")
    return events.select(
        F.lit(topic).alias("_topic"), raw.alias("_raw"),
        *[(F.col(f) if f in events.columns else F.lit(None).cast(kind)).alias(f) for f, kind in EVENT_TYPES.items()],
    )


def with_envelope(events: DataFrame, published_at, max_retries: int = MAX_RETRIES) -> DataFrame:
    """Fill a missing id and timestamp and add the delivery columns.

    The id is derived from the content, the text of an unreadable record included,
    so delivering an event twice gives the same id and the copy is recognised.
    """
    at = C.as_timestamp(published_at)
    content = F.sha2(F.to_json(F.struct("_topic", "_raw", *EVENT_FIELDS)), 256)
    return (
        events.withColumn("event_id", F.coalesce(
            F.col("event_id").cast("string"), F.concat(F.lit("evt_"), content)))
        .withColumn("timestamp", F.coalesce("timestamp", at))
        .withColumn("_published_at", at)
        .withColumn("_retry_count", F.lit(0))
        .withColumn("_max_retries", F.lit(max_retries))
        .withColumn("_event_hash", C.event_hash(
            F.col("event_id"), F.col("account_id"), F.col("feature"), C.iso_text(F.col("timestamp"))))
    )


def with_error(events: DataFrame) -> DataFrame:
    """Add ``_error``: unknown topic, unreadable record, or the first required field that is missing."""
    error = F.when(~F.col("_topic").isin(*TOPICS) | F.col("_topic").isNull(),
                   F.concat(F.lit("Unknown topic: "), F.coalesce("_topic", F.lit(""))))
    error = error.when(F.col("_raw").isNotNull(), "Malformed record")
    for topic, fields in REQUIRED.items():
        missing = C.first_missing(fields)
        error = error.when((F.col("_topic") == topic) & missing.isNotNull(),
                           F.concat(F.lit(f"{LABELS[topic]} event missing required field: "), missing))
    return events.withColumn("_error", error)


def drop_copies(events: DataFrame, order: Sequence[str] = COPY_ORDER) -> DataFrame:
    """One row per idempotency key; copies that differ are ranked by ``order``."""
    return keep_first(events, ["_event_hash"], order)


def dead_letters(failed: DataFrame, at) -> DataFrame:
    """Rows with ``_error`` in dead-letter form.

    A validation failure repeats on every retry, so it arrives with its retries
    used up; ``redrive`` gives key failures another chance.
    """
    return (
        failed.withColumn("_last_error", F.col("_error")).withColumn("_fatal_error", F.col("_error"))
        .withColumn("_retry_count", F.col("_max_retries"))
        .withColumn("_dead_lettered_at", C.as_timestamp(at)).drop("_error")
    )


def redrive(letters: DataFrame, known: Mapping[str, DataFrame], max_retries: int = MAX_RETRIES,
            attempts: str = "_redrive_count", topics: Sequence[str] = KEYED_TOPICS) -> tuple[DataFrame, DataFrame]:
    """Check dead letters again: (events that are valid now, letters to keep).

    ``known`` maps a key column to the frame of its present values.  Kept
    letters carry one more attempt; at ``max_retries`` they are not tried again.
    """
    counted = letters if attempts in letters.columns else letters.withColumn(attempts, F.lit(0))
    checked = reject_unknown(with_error(counted), known, topics)
    open_again = F.col(attempts) < max_retries
    valid = checked.where(F.col("_error").isNull() & open_again).drop(
        "_error", "_last_error", "_fatal_error", "_dead_lettered_at", attempts)
    kept = checked.where(F.col("_error").isNotNull() | ~open_again).withColumn(
        "_last_error", F.coalesce("_error", "_last_error")).withColumn(
        attempts, F.least(F.col(attempts) + 1, F.lit(max_retries))).drop("_error")
    return valid, kept


def reject_unknown(events: DataFrame, known: Mapping[str, DataFrame], topics: Sequence[str] = KEYED_TOPICS,
                   stage: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """Set ``_error`` on rows of ``topics`` whose key is not in ``known``.

    The check runs on distinct keys; the events are then joined with the unknown
    ones, which Spark broadcasts while their measured size allows it, each key
    spread over several tasks.  ``stage`` writes the unknown values of a key and reads them
    again: without it Spark estimates their size from that of all events.
    """
    out = events
    for key, frame in known.items():
        used = events.where(F.col("_topic").isin(*topics)).select(key).where(F.col(key).isNotNull()).distinct()
        unknown = used.join(frame.select(key), key, "left_anti")
        unknown = (stage(unknown, key) if stage else unknown).withColumn("_unknown", F.lit(True))
        missing = F.when(F.col("_topic").isin(*topics) & F.col("_unknown"),
                         F.concat(F.lit(f"Unknown {key}: "), F.col(key).cast("string")))
        joined = with_attributes(out, unknown, key, ["event_id"], "left")
        out = joined.withColumn("_error", F.coalesce("_error", missing)).drop("_unknown")
    return out


def topic_metrics(events: DataFrame) -> DataFrame:
    """Published, dropped and dead-lettered counts per topic.

    Rows without ``_error``; copies are counted per idempotency key.
    """
    per_key = with_error(events).groupBy("_topic", "_event_hash").agg(
        F.count(F.lit(1)).alias("copies"), F.max("_error").alias("_error"))
    return per_key.groupBy(F.col("_topic").alias("topic")).agg(
        F.sum("copies").alias("received"), F.count(F.lit(1)).alias("published"),
        F.sum(F.col("copies") - 1).alias("duplicates_dropped"),
        F.count_if(F.col("_error").isNotNull()).alias("dead_lettered"),
        F.count_if(F.col("_error").isNull()).alias("consumed"))
