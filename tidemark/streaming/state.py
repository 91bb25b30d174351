"""Customer health as the state of a stream, kept for groups of accounts.

The live job composes the effects of a micro-batch to one row an account before
anything is keyed (``effects.account_effects``), so an account that sends a third of all
events sends one row a batch here.  The processor applies these rows to the state in the
order of the batches; a batch that was written twice is applied once.  The state starts
from a published mart and is kept in a state store, so a restart goes on where the last
finished batch ended.

A Python processor pays for every key, every call to the state store and every cell, not for what
a value or a cell holds.  The key is therefore a group of some ``GROUP`` accounts, by hash, whose health is one
value; seeds come and changes go as one row a group, effects as one array a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidemark import schemas as S
from tidemark.sources import storage
from tidemark.streaming.live import LiveJob

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# A batch that touches one account of a group writes all of it again, which takes about as long as the calls for one key.
GROUP = 256
KINDS = {"account_id": "STRING", "tenths": "INT", "forced": "BOOLEAN", "tier": "STRING", "events": "BIGINT", "payment": "STRING",
         "last_at": "BIGINT", "batch": "BIGINT"}  # times in microseconds
EFFECT = ("batch_id", "d", "lo", "hi", "product_events", "payment_failed", "forced", "last_at")  # as an array
STATE = ", ".join(f"{name} ARRAY<{kind}>" for name, kind in KINDS.items())
CURRENT = ("account_id STRING, health_score DOUBLE, health_tier STRING, events_last_30d BIGINT, payment_status STRING, "
           "last_updated_at TIMESTAMP, batch BIGINT")


class Health(NamedTuple):
    """An account's health: ``KINDS`` without the id."""

    tenths: int
    forced: bool
    tier: str
    events: int
    payment: str
    last_at: int
    batch: int

    def after(self, effect: list[int]) -> Health:
        """The health after the effects of a batch."""
        batch, d, lo, hi, product_events, payment_failed, forced, last_at = effect
        tenths = max(lo, min(hi, self.tenths + d))
        score = tenths / 10
        tier = "Critical" if forced else "Healthy" if score >= S.HEALTHY_FROM else "At Risk" if score >= S.AT_RISK_FROM else "Critical"
        return Health(tenths, bool(forced), tier, self.events + product_events, S.PAYMENT_TROUBLE if payment_failed else self.payment,
                      last_at, batch)


def _packed(accounts: dict[str, Health]) -> tuple[list, ...]:
    """The columns of ``STATE``."""
    return [*accounts], *map(list, zip(*accounts.values()))


class HealthProcessor(StatefulProcessor):
    """Applies composed effects to the health of a group's accounts; accounts that the mart does not name change nothing."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.health = handle.getValueState("health", STATE)

    def handleInitialState(self, key, row, timerValues) -> None:
        self.health.update(tuple(row[name] for name in KINDS))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if not self.health.exists():
            return
        ids, *columns = self.health.get()
        accounts = dict(zip(ids, map(Health._make, zip(*columns))))
        changed = {}
        for account_id, effect in sorted(((row.account_id, row.effect) for row in rows), key=lambda r: r[1][0]):
            health = accounts.get(account_id)
            if health is not None and effect[0] > health.batch:  # else of a batch that was written again
                accounts[account_id] = changed[account_id] = health.after(effect)
        if changed:
            self.health.update(_packed(accounts))
            yield Row(**dict(zip(KINDS, _packed(changed))))


@dataclass
class HealthState:
    """The stateful twin of ``LiveJob.current_health``: reads the job's effects as a stream.

    ``root`` gets the checkpoint, the number of groups and the changed accounts of every batch.  ``mart``
    seeds the state in the first run; a mart that has been built anew needs a new ``root``.
    """

    spark: SparkSession
    job: LiveJob
    root: str

    def start(self, mart: DataFrame, trigger: dict | None = None, after_batch: int | None = None) -> StreamingQuery:
        """Follow the effects of the batches after ``after_batch`` (by default those the mart does not hold)."""
        after = self.job.included() if after_batch is None else after_batch
        self.spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        seed = mart.select(
            "account_id", F.rint(F.col("health_score") * 10).cast("int").alias("tenths"), F.lit(False).alias("forced"),
            F.col("health_tier").alias("tier"), F.col("events_last_30d").cast("bigint").alias("events"), F.col("payment_status").alias("payment"),
            F.unix_micros("last_updated_at").alias("last_at"), F.lit(after).cast("bigint").alias("batch"))
        group = F.pmod(F.xxhash64("account_id"), F.lit(self._groups(mart))).alias("_group")
        seeds = seed.groupBy(group).agg(F.sort_array(F.collect_list(F.struct(*KINDS))).alias("_all")).select(
            "_group", *[F.col(f"_all.{name}").alias(name) for name in KINDS])
        arriving = self.spark.readStream.schema(f"{LiveJob.EFFECTS}, batch_id BIGINT").parquet(f"{self.job.root}/health_effects")
        effect = F.array(*[F.col(name).cast("bigint") for name in EFFECT]).alias("effect")
        changed = arriving.select(group, "account_id", effect).groupBy("_group").transformWithState(
            HealthProcessor(), STATE, "Update", "None", initialState=seeds.groupBy("_group"))
        return (changed.writeStream.outputMode("update").foreachBatch(self._keep).option("checkpointLocation", f"{self.root}/checkpoint")
                .trigger(**(trigger or {"availableNow": True})).start())

    def _groups(self, mart: DataFrame) -> int:
        """The number of groups: follows from the mart's size in the first run, and stays as the state is keyed by it."""
        path = f"{self.root}/groups"
        if not storage.table_exists(self.spark, f"{self.root}/checkpoint"):
            storage.overwrite(self.spark.createDataFrame([(mart.count() // GROUP + 1,)], "groups BIGINT"), path)
        return self.spark.read.schema("groups BIGINT").parquet(path).first()[0]

    def _keep(self, changed: DataFrame, batch_id: int) -> None:
        changed = changed.select(F.inline(F.arrays_zip(*KINDS))).select(
            "account_id", (F.col("tenths") / F.lit(10.0)).alias("health_score"), F.col("tier").alias("health_tier"),
            F.col("events").alias("events_last_30d"), F.col("payment").alias("payment_status"),
            F.timestamp_micros("last_at").alias("last_updated_at"), "batch")
        changed.write.mode("overwrite").parquet(f"{self.root}/changed/trigger={batch_id}")

    def current_health(self, mart: DataFrame) -> DataFrame:
        """The mart with the newest state of every account that has changed."""
        path = f"{self.root}/changed"
        if not storage.table_exists(self.spark, path):
            return mart
        columns = [c.split(" ")[0] for c in CURRENT.split(", ")][1:-1]
        newest = (self.spark.read.schema(CURRENT).parquet(path).groupBy("account_id")
                  .agg(F.max_by(F.struct(*columns), "batch").alias("now")))
        return mart.join(newest, "account_id", "left").select(*[
            F.when(F.col("now").isNotNull(), F.col(f"now.{c}").cast(mart.schema[c].dataType)).otherwise(F.col(c)).alias(c)
            if c in columns else F.col(c) for c in mart.columns])
