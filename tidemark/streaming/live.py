"""The live job: topics in; facts, dead letters and health effects out.

Each micro-batch writes its rows to ``<table>/batch_id=<n>`` and reads only the
batches before it, so a batch that is run again after a failure replaces its own
output and changes nothing else.  Customer health is the published mart plus the
composed effects of the batches since (``current_health``): a batch writes one
small row per account it touched and never rewrites the mart.

What a batch must know of earlier ones are keys: idempotency keys and ids of stored
facts, by date.  Keys of finished batches are gathered every ``compact_every`` batches,
one version a date (a dated table with its own log), so a batch opens the files of its
own dates and of a bounded number of recent batches, however old the job is.

Counts are observed on the rows while they are written; no job runs only to count.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import facts
from tidemark.operators.keyed import keep_first
from tidemark.sources import storage
from tidemark.streaming import effects, events as E

LATE_AFTER = "2 hours"
FILES_PER_BATCH = 1_000
OFFSETS_PER_BATCH = 10_000_000
COMPACT_EVERY = 16
# Rows are sorted as they are read, and take ten times their stored size or more: a task reads this much of a
# file, so that it sorts in memory; row groups are what a file can be divided at.
SPLIT_BYTES = 16 * 1024 * 1024
ROW_GROUP_BYTES = 8 * 1024 * 1024
_SPLIT_CONF = "spark.sql.files.maxPartitionBytes"


# ----------------------------------------------------------------- sources

def read_topics(spark: SparkSession, root: str, files_per_batch: int = FILES_PER_BATCH,
                topics: Sequence[str] = E.TOPICS) -> DataFrame:
    """The topics as one stream, from ``<root>/<topic>`` folders of JSON Lines.

    A batch takes up to ``files_per_batch`` files of each topic, so a backlog is
    worked off in batches of bounded size.
    """
    def topic(name: str) -> DataFrame:
        reader = spark.readStream.schema(E.READ_DDL).option("columnNameOfCorruptRecord", "_corrupt_record")
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
        return E.normalise(reader.json(f"{root}/{name}"), name)

    return reduce(DataFrame.unionByName, [topic(name) for name in topics])


def kafka_options(servers: str, topics: Sequence[str] = E.TOPICS, max_offsets: int = OFFSETS_PER_BATCH) -> dict[str, str]:
    """Options of ``spark.readStream.format("kafka")``; parse with ``from_kafka``."""
    unknown = set(topics) - set(E.TOPICS)
    if unknown:
        raise ValueError(f"Unknown topic: {sorted(unknown)}")
    options = {"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics), "failOnDataLoss": "true"}
    options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def from_kafka(records: DataFrame) -> DataFrame:
    """Kafka records (topic, value) to the common event shape."""
    text = F.col("value").cast("string")
    parsed = records.select(F.col("topic").alias("_topic"), F.from_json(
        text, E.READ_DDL, {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("e"))
    return parsed.select("_topic", F.col("e._corrupt_record").alias("_raw"), *[F.col(f"e.{f}").alias(f) for f in E.EVENT_FIELDS])


# ---------------------------------------------------------------- the job

NO_DATE = "__HIVE_DEFAULT_PARTITION__"  # the folder of rows without a date
_LOGGED = (*E.TOPICS, "unknown")


def _utc_now() -> datetime:
    return datetime.now(timezone.utc)


def _enveloped(rows: DataFrame, at) -> DataFrame:
    """Rows of ``_first_copies`` with their delivery columns."""
    return E.with_envelope(rows, at).withColumn("_event_hash", F.lower(F.hex("_key"))).drop("_key")


def _by_topic(name: str, greatest: str | None = None) -> list[Column]:
    """Observed counts, or the greatest time in microseconds, of each topic and of rows of no known one."""
    topic = F.coalesce("_topic", F.lit(""))
    is_topic = [*(topic == t for t in E.TOPICS), ~topic.isin(*E.TOPICS)]
    return [(F.max(F.when(here, F.unix_micros(greatest))) if greatest else F.count_if(here)).alias(f"{name}_{i}") for i, here in enumerate(is_topic)]


def _upto(gathered: storage.Published) -> int:
    """The batches up to this one have their keys in the dated table."""
    return int(gathered.marks.get("compacted", -1))


@dataclass
class LiveJob:
    """The live tables and how a batch is applied to them.

    ``known`` returns, per key column, the frame of values product events may
    refer to; it is called for every batch, so new accounts count at once.
    ``warehouse`` is the root whose daily run takes the live facts in.
    """

    spark: SparkSession
    root: str
    known: Callable[[], dict[str, DataFrame]] = dict
    support_penalty: dict[str, float] = field(default_factory=lambda: dict(effects.SUPPORT_PENALTY))
    clock: Callable[[], datetime] = _utc_now
    subscribers: list[Callable[[DataFrame, int], None]] = field(default_factory=list)
    warehouse: str | None = None
    compact_every: int = COMPACT_EVERY

    def start(self, stream: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        """``trigger`` defaults to draining what is there (``availableNow``);
        pass ``{"processingTime": "60 seconds"}`` for a continuous job."""
        return (stream.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"availableNow": True})).start())

    # ------------------------------------------------------------- tables
    def _write(self, df: DataFrame, table: str, batch_id: int, partition_by: str | None = None,
               sort_by: str | None = None, finish: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """Replace the batch's part of a table; ``finish`` adds what need not be moved to its file.

        Of a table partitioned by date, rows of one date are brought together first, so a batch that
        spans many dates still writes few files; of a sorted one, row groups are pruned by their statistics.
        """
        if partition_by:
            df = df.hint("rebalance", F.col(partition_by))
        if partition_by or sort_by:
            df = df.sortWithinPartitions(partition_by or sort_by)
        writer = (finish(df) if finish else df).write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer = writer.option("parquet.block.size", ROW_GROUP_BYTES).option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(f"{self.root}/{table}/batch_id={batch_id}")

    def table(self, name: str, schema: str, before: int | None = None) -> DataFrame:
        """Rows of the finished batches, of those before ``before`` if given."""
        path = f"{self.root}/{name}"
        if not storage.table_exists(self.spark, path):
            return self.spark.createDataFrame([], f"{schema}, batch_id BIGINT")
        rows = self.spark.read.schema(f"{schema}, batch_id BIGINT").parquet(path)
        return rows if before is None else rows.where(F.col("batch_id") < before)

    def _part(self, name: str, schema: str, batch_id: int) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}/batch_id={batch_id}")

    USAGE = ("usage_id STRING, account_id STRING, user_id STRING, feature STRING, event_timestamp TIMESTAMP, "
             "event_date DATE")
    EFFECTS = ("account_id STRING, d INT, lo INT, hi INT, product_events BIGINT, payment_failed BOOLEAN, "
               "forced BOOLEAN, last_at BIGINT")
    LOG = ("topic STRING, received BIGINT, published BIGINT, duplicates_dropped BIGINT, dead_lettered BIGINT, "
           "consumed BIGINT, max_ts TIMESTAMP")
    ENVELOPED = (", ".join(f"{n} {t}" for n, t in E.EVENT_TYPES.items())
                 + ", _topic STRING, _raw STRING, _event_hash STRING, event_date DATE, _published_at TIMESTAMP, _retry_count INT, "
                   "_max_retries INT")
    # The envelope follows from these, so it is not stored or moved with them.
    CHECKED = ", ".join(f"{n} {t}" for n, t in E.EVENT_TYPES.items()) + ", _topic STRING, _raw STRING, _error STRING"
    ACCEPTED = f"{ENVELOPED}, late BOOLEAN"
    LETTERS = f"{ENVELOPED}, _last_error STRING, _fatal_error STRING, _dead_lettered_at TIMESTAMP"
    REDRIVES = "_event_hash STRING, republished BOOLEAN"
    DATES = ("date_key STRING, full_date DATE, year INT, quarter INT, month INT, day INT, day_of_week INT, "
             "is_weekend BOOLEAN")
    KEYS = "kind STRING, key STRING, event_date DATE"
    # Where the keys of recent batches are: table, its schema and the column that is the key.
    KEYED = {"event": ("accepted", ACCEPTED, "_event_hash"), "letter": ("dead_letters", LETTERS, "_event_hash"),
             "usage": ("fact_usage", USAGE, "usage_id")}

    # -------------------------------------------------------------- batch
    def process(self, batch: DataFrame, batch_id: int) -> None:
        before = self.spark.conf.get(_SPLIT_CONF)
        self.spark.conf.set(_SPLIT_CONF, SPLIT_BYTES)
        try:
            self._process(batch, batch_id)
        finally:
            self.spark.conf.set(_SPLIT_CONF, before)

    def _process(self, batch: DataFrame, batch_id: int) -> None:
        at = self.clock()
        # A stream's session has it off; the work below is ordinary batch work.
        batch.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
        gathered = storage.published(self.spark, self._keys_root())
        if batch_id - _upto(gathered) > self.compact_every:
            gathered = self.compact(batch_id, gathered)

        filled = E.with_envelope(batch, at).select(*batch.columns, F.to_date("timestamp").alias("event_date"))
        checked = E.reject_unknown(E.with_error(filled), self.known(), stage=lambda unknown, key: self._staged(unknown, f"unknown_{key}", batch_id))
        arrived = Observation()
        days = F.sort_array(F.collect_set(F.coalesce(F.col("event_date").cast("string"), F.lit(NO_DATE))))  # the calendar's at most
        stored = [c.split(" ")[0] for c in self.CHECKED.split(", ")]
        self._write(checked.observe(arrived, days.alias("days"), *_by_topic("received")).select(*stored), "inbox", batch_id)
        inbox = self._part("inbox", self.CHECKED, batch_id)
        days = storage.observed(arrived).get("days", [])

        newest = self.table("batch_log", self.LOG, batch_id).agg(F.max("max_ts")).first()[0]  # a few rows a batch
        late = F.col("timestamp") < F.lit(newest) - F.expr(f"INTERVAL {LATE_AFTER}") if newest else F.lit(False)
        fresh = self._first_copies(inbox.where("_error IS NULL").drop("_error"), "event", days, batch_id, gathered, at)
        consumed, dead = Observation(), Observation()
        self._write(fresh.observe(consumed, *_by_topic("consumed"), *_by_topic("max_ts", "timestamp")), "accepted", batch_id,
                    sort_by="event_date", finish=lambda rows: _enveloped(rows, at).withColumn("late", late))
        fresh = self._part("accepted", self.ACCEPTED, batch_id)

        failed = self._first_copies(inbox.where("_error IS NOT NULL"), "letter", days, batch_id, gathered, at)
        self._write(failed.observe(dead, *_by_topic("dead_lettered")), "dead_letters", batch_id, sort_by="event_date",
                    finish=lambda rows: E.dead_letters(_enveloped(rows, at), at))

        product = keep_first(fresh.where(F.col("_topic") == "product.events"), ["event_id"], ["timestamp", "_event_hash"])
        inserted = self._unseen(product, "usage", "event_id", days, batch_id, gathered)
        self._write(facts.fact_usage(inserted), "fact_usage", batch_id, "event_date")
        stored = self._part("fact_usage", self.USAGE, batch_id).select(
            F.col("usage_id").alias("event_id"), "account_id", F.lit("product.events").alias("_topic"),
            F.lit(None).cast("string").alias("severity"), F.lit(None).cast("string").alias("status"), F.col("event_timestamp").alias("timestamp"))
        self._write(self._effects(fresh, stored), "health_effects", batch_id)
        known_dates = self.table("dim_date", self.DATES, batch_id).select("date_key")
        self._write(facts.dim_date(fresh, "timestamp").join(known_dates, "date_key", "left_anti"), "dim_date", batch_id)
        for subscriber in self.subscribers:
            subscriber(fresh.drop("late"), batch_id)
        # Last: a batch is finished when it is logged.
        self._write(self._log(*map(storage.observed, (arrived, consumed, dead))), "batch_log", batch_id)

    def _first_copies(self, rows: DataFrame, kind: str, days: Sequence[str], batch_id: int, gathered: storage.Published, at) -> DataFrame:
        """One row per idempotency key that no earlier batch has; ``_key`` is the key in half the bytes of its text."""
        keyed = E.with_envelope(rows, at).select(*rows.columns, F.to_date("timestamp").alias("event_date"), F.unhex("_event_hash").alias("_key"))
        earlier = self.keys(kind, days, batch_id, gathered).select(F.unhex("key").alias("_key"))
        return keep_first(keyed, ["_key"], E.COPY_ORDER).join(earlier, "_key", "left_anti")

    def _staged(self, df: DataFrame, table: str, batch_id: int) -> DataFrame:
        """Written and read again, so that its size is known where it is joined."""
        self._write(df, table, batch_id)
        return self._part(table, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields), batch_id)

    def _unseen(self, rows: DataFrame, kind: str, key: str, days: Sequence[str], batch_id: int, gathered: storage.Published) -> DataFrame:
        """Rows whose key is not among those of the earlier batches, which are read for the dates of this one."""
        earlier = self.keys(kind, days, batch_id, gathered).select(F.col("key").alias(key))
        return rows.join(earlier, key, "left_anti").select(*rows.columns)

    def _effects(self, fresh: DataFrame, stored: DataFrame) -> DataFrame:
        """Composed effects; only product events that became facts count."""
        needed = ("event_id", "account_id", "_topic", "severity", "status", "timestamp")
        counted = fresh.where(F.col("_topic") != "product.events").select(*needed).unionByName(stored)
        columns = [c.split(" ")[0] for c in self.EFFECTS.split(", ")]
        return effects.account_effects(effects.event_effects(counted, self.support_penalty)).select(*columns)

    def _log(self, arrived: dict, consumed: dict, dead: dict) -> DataFrame:
        rows = []
        for i, topic in enumerate(_LOGGED):
            received, taken, lost = (counts.get(f"{name}_{i}") or 0 for counts, name in (
                (arrived, "received"), (consumed, "consumed"), (dead, "dead_lettered")))
            if received:
                rows.append((topic, received, taken + lost, received - taken - lost, lost, taken, consumed.get(f"max_ts_{i}")))
        logged = self.spark.createDataFrame(rows, self.LOG.replace("TIMESTAMP", "BIGINT")).coalesce(1)
        return logged.withColumn("max_ts", F.timestamp_micros("max_ts"))

    # --------------------------------------------------------------- keys
    def _keys_root(self) -> str:
        return f"{self.root}/keys"

    def keys(self, kind: str, days: Sequence[str] | None, before: int, gathered: storage.Published | None = None) -> DataFrame:
        """``key`` and ``event_date`` of a kind in the batches before ``before``; ``days`` leaves out other dates."""
        state = gathered or storage.published(self.spark, self._keys_root())
        older = storage.read_dates(self.spark, self._keys_root(), "keys", self.KEYS, days, state).where(F.col("kind") == kind)
        recent = self._recent(kind, _upto(state), before)
        if days is not None:
            real = ", ".join(f"DATE'{d}'" for d in days if d != NO_DATE)  # one expression, however many they are
            in_days = F.expr(f"event_date IN ({real})") if real else F.lit(False)
            recent = recent.where(in_days | F.col("event_date").isNull() if NO_DATE in days else in_days)
        return older.unionByName(recent).select("key", "event_date")

    def _recent(self, kind: str, after: int, before: int) -> DataFrame:
        """Keys of the batches between two; only their folders are listed."""
        name, schema, key = self.KEYED[kind]
        folders = [f"{self.root}/{name}/batch_id={n}" for n in range(after + 1, before)]
        folders = [f for f in folders if storage.table_exists(self.spark, f)]
        rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}").parquet(*folders) if folders else (
            self.spark.createDataFrame([], schema))
        return rows.select(F.lit(kind).alias("kind"), F.col(key).alias("key"), "event_date")

    def compact(self, before: int, gathered: storage.Published | None = None) -> storage.Published:
        """Gather the keys of the batches before ``before`` in the dated table: their dates are written anew, no others."""
        root = self._keys_root()
        state = gathered or storage.published(self.spark, root)
        if before - 1 <= _upto(state):
            return state
        recent = reduce(DataFrame.unionByName, [self._recent(kind, _upto(state), before) for kind in self.KEYED])
        day = F.coalesce(F.col("event_date").cast("string"), F.lit(NO_DATE))
        days = [r[0] for r in recent.select(day).distinct().collect()]  # the calendar's at most
        older = storage.read_dates(self.spark, root, "keys", self.KEYS, days, state)
        run = f"upto{before - 1}"
        names = storage.stage_dates(older.unionByName(recent), root, run, "keys")
        storage.publish(self.spark, root, run, names, self.clock(), {n: state.runs.get(n) for n in names}, {"compacted": before - 1})
        return storage.published(self.spark, root)

    # ------------------------------------------------------------- redrive
    def redrive(self, run: int, topics_root: str) -> DataFrame:
        """Send dead letters that are valid by now back to their topics.

        Each letter is tried at most ``MAX_RETRIES`` times over the runs; a
        letter sent back is not tried again.  Returns the log of this run.
        Running it twice is harmless: the live job drops the copies.
        """
        tried = self.table("redrives", self.REDRIVES, run).groupBy("_event_hash").agg(
            F.count(F.lit(1)).alias("_redrive_count"), F.bool_or("republished").alias("_sent"))
        pending = self.table("dead_letters", self.LETTERS).join(tried, "_event_hash", "left").fillna(
            0, ["_redrive_count"]).where("_sent IS NOT TRUE").drop("_sent")
        valid, kept = E.redrive(pending.where(F.col("_redrive_count") < E.MAX_RETRIES), self.known())
        for topic in E.TOPICS:
            (valid.where(F.col("_topic") == topic).select(*E.EVENT_FIELDS).write.mode("append")
             .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(f"{topics_root}/{topic}"))
        log = valid.select("_event_hash", F.lit(True).alias("republished")).unionByName(
            kept.select("_event_hash", F.lit(False).alias("republished")))
        self._write(log, "redrives", run)
        return self.table("redrives", self.REDRIVES).where(F.col("batch_id") == run)

    # ------------------------------------------------------------- results
    def included(self) -> int:
        """The last batch whose facts the published warehouse holds."""
        return int(storage.published(self.spark, self.warehouse).marks.get("live_batch", -1)) if self.warehouse else -1

    def finished(self) -> int:
        """The last batch that is logged."""
        newest = self.table("batch_log", self.LOG).agg(F.max("batch_id")).first()[0]
        return -1 if newest is None else newest

    def current_health(self, mart: DataFrame, after_batch: int | None = None) -> DataFrame:
        """The mart with the effects of the batches after ``after_batch``: by default those it does not hold yet."""
        after = self.included() if after_batch is None else after_batch
        since = self.table("health_effects", self.EFFECTS).where(F.col("batch_id") > after)
        return effects.apply_effects(mart, effects.compose(since, ["account_id"], ["batch_id"]))

    def usage(self, after_batch: int = -1, upto: int | None = None) -> DataFrame:
        rows = self.table("fact_usage", self.USAGE, None if upto is None else upto + 1)
        return rows.where(F.col("batch_id") > after_batch).drop("batch_id")

    def metrics(self) -> DataFrame:
        """Totals per topic over all batches."""
        names = ("received", "published", "duplicates_dropped", "dead_lettered", "consumed")
        return self.table("batch_log", self.LOG).groupBy("topic").agg(*[F.sum(n).alias(n) for n in names])

    @staticmethod
    def backlog(query: StreamingQuery) -> dict[str, str | None]:
        """Waiting input per source, as reported by the last finished batch."""
        progress = query.lastProgress or {"sources": []}
        return {s["description"]: (s.get("metrics") or {}).get("numFilesOutstanding") or s.get("latestOffset")
                for s in progress["sources"]}

    def late_events(self) -> DataFrame:
        """Events older than the newest earlier event by more than the allowed delay."""
        return self.table("accepted", self.ACCEPTED).where("late")

    def dates_to_restate(self, after_batch: int | None = None) -> DataFrame:
        """Dates that late events fell into since ``after_batch``, by default since the published warehouse;
        ``incremental.run_increment`` builds them anew."""
        after = self.included() if after_batch is None else after_batch
        return self.late_events().where(F.col("batch_id") > after).select("event_date").distinct()
