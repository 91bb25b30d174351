"""The daily run on what is new: touched dates are written, everything else stays.

A run takes the records that arrived after the last one (by ``_ingested_at``, whose
newest value is a mark in the publish log), and the facts and late events of the live
job, and merges them into dated tables:

* ``fact_usage`` by event date; an id that its date holds already is ignored;
* ``usage_days``, ``usage_hours`` and ``usage_users`` (counts by account and day, by
  feature and hour, and a sketch of the users of a day), built anew for the same dates;
* ``usage_sessions`` by the date they begin; sessions are summaries that merge, so new
  events are made to sessions of their own and joined with those they touch;
* ``fact_support`` by the month of creation, with the newest version of a ticket, and
  ``support_counts``; months with tickets that are neither resolved nor breached are
  refreshed too, because a breach depends on the time of the run.

Accounts, users, subscriptions and invoices are replaced by key.  The marts follow from
the summaries and from the last days' facts, not from all facts.  One entry of the
publish log makes all of it visible.

An event belongs to the date of its own time: a copy of it carries the same time, and is
looked for in that date alone.

Of the rows that arrived, only those whose key comes twice are ranked, and accounts that are
not known are listed before rows are filtered by them.  Both lists are short as a rule, so
the rows are not moved for them; long ones are joined by a shuffle.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions import columns as C
from tidemark.operators import facts, health, sketches, usage
from tidemark.operators.keyed import keep_first, keep_latest, replace_rows, with_unknown_key
from tidemark.plans.daily import Run, audited, build_marts
from tidemark.sources import storage
from tidemark.streaming.live import LiveJob

USAGE = S.WAREHOUSE["fact_usage"]
SUPPORT = S.WAREHOUSE["fact_support"] + ", created_month DATE"
SUPPORT_COUNTS = ("account_id STRING, total_tickets BIGINT, open_tickets BIGINT, critical_tickets BIGINT, critical_open_tickets BIGINT, "
                "sla_breached_count BIGINT, unresolved BIGINT, pending BIGINT, judged_at TIMESTAMP, created_month DATE")
DAYS = "account_id STRING, daily_events BIGINT, event_date DATE"
HOURS = "feature STRING, window_start TIMESTAMP, window_end TIMESTAMP, event_count BIGINT, event_date DATE"
USERS = "events BIGINT, users BINARY, event_date DATE"
SESSIONS = "user_id STRING, session_start TIMESTAMP, session_end TIMESTAMP, event_count BIGINT, start_date DATE"
SESSION_GAP = 3600  # seconds
MERGED = ("dim_account", "dim_user", "fact_subscription", "fact_billing")  # whole tables that new rows are merged into


def run_increment(spark: SparkSession, raw: dict[str, DataFrame], root: str, run_id: str, as_of, live: LiveJob | None = None,
                  recipients: dict | None = None, train_churn: bool = False) -> dict:
    """Merge what is new into the published warehouse and publish the result; returns a small summary.

    ``raw`` holds the datasets that have arrived (any of the six, whole or in part).  With ``_ingested_at``
    only rows above the mark are taken.  Copies are told apart as in the full run, but a newer version of
    an account, user, subscription, invoice or ticket replaces the stored one.  ``live`` gives the facts of
    the batches that finished since the last run, late ones included.
    """
    started = datetime.now(timezone.utc)
    with audited(spark, root, run_id, started):
        run = Increment(spark, root, run_id, as_of, live)
        summary = run.build(raw, recipients, train_churn)
    return run.finish(started, summary)


class Increment(Run):
    """One incremental run: what it has read, and what it writes."""

    def __init__(self, spark: SparkSession, root: str, run_id: str, as_of, live: LiveJob | None):
        super().__init__(spark, root, run_id)
        self.as_of, self.live = as_of, live
        self.state = storage.published(spark, root)
        self.marks = {}

    def finish(self, started: datetime, summary: dict) -> dict:
        """Publish, unless another run has changed meanwhile what this one was merged into."""
        self.based_on = {n: self.state.runs.get(n) for n in (*self.tables, *self.removed) if "/" in n or n in MERGED}
        return super().finish(started, summary)

    # ------------------------------------------------------------ tables
    def stored(self, name: str, schema: str | None = None) -> DataFrame:
        """A whole table as published, or empty."""
        found = self.state.runs.get(name)
        if found is None:
            return self.spark.createDataFrame([], schema or S.WAREHOUSE[name])
        return self.spark.read.parquet(f"{self.root}/run_id={found}/{name}")

    def dated(self, name: str, schema: str, by: str = "event_date", dates=None) -> DataFrame:
        """A dated table with the dates this run has written so far."""
        return storage.read_dates(self.spark, self.root, name, schema, dates, self.now(), by)

    def now(self) -> storage.Published:
        return replace(self.state, runs={**self.state.runs, **{n: self.run_id for n in self.tables}})

    def put_dates(self, df: DataFrame, name: str, by: str = "event_date") -> list[str]:
        """Write the dates of ``df`` and return them; the table follows this run's version of them from now on."""
        names = storage.stage_dates(df, self.root, self.run_id, name, by)
        self.tables += names
        return [n[len(name) + 1:] for n in names]

    def arrived(self, df: DataFrame, name: str) -> DataFrame:
        """Rows above the mark, written once; their newest time becomes the next mark."""
        if "_ingested_at" in df.columns:
            mark = self.state.marks.get(f"ingested_{name}")
            if mark is not None:
                df = df.where(F.unix_micros("_ingested_at") > F.lit(int(mark)))
            newest = Observation()
            df = df.observe(newest, F.max(F.unix_micros("_ingested_at")).alias("newest"), F.count(F.lit(1)).alias("rows"))
        staged = storage.stage(df, self.root, self.run_id, f"arrived_{name}")
        if "_ingested_at" in df.columns:
            found = storage.observed(newest).get("newest")
            if found is not None:
                self.marks[f"ingested_{name}"] = found
        return staged

    # ------------------------------------------------------------- build
    def build(self, raw: dict[str, DataFrame], recipients: dict | None, train_churn: bool) -> dict:
        arrived = {name: self.arrived(df, name) for name, df in raw.items()}
        new = self._one_a_key(arrived)
        accounts = self._replaced("dim_account", "account_id", facts.dim_account(new["accounts"]) if "accounts" in new else None)

        known = self._of_accounts({name: df for name, df in new.items() if name != "accounts"}, arrived, accounts)
        made = {name: known.get(name) for name in S.BRONZE_KEYS if name != "accounts"}
        users = self._replaced("dim_user", "user_id", made["users"] and facts.dim_user(made["users"]))
        plans = self.put("dim_plan", facts.dim_plan(self.spark))
        subscriptions = self._replaced("fact_subscription", "subscription_id", made["subscriptions"] and facts.fact_subscription(made["subscriptions"]))
        billing = self._billing(made["invoices"])
        self._support(made["support_tickets"])
        touched = self._usage(made["product_events"])

        since = (_as_datetime(self.as_of) - timedelta(days=30)).date().isoformat()
        window = [d for d in storage.published_dates(self.now(), "fact_usage") if d >= since]
        recent = self.dated("fact_usage", USAGE, dates=window)
        days = self.dated("support_counts", SUPPORT_COUNTS, "created_month")
        tickets = days.groupBy("account_id").agg(*[F.sum(c).alias(c) for c in health.TICKET_COUNTS])
        mart = health.assemble_health(accounts, subscriptions, usage.trailing_usage(recent, self.as_of),
                                      health.with_compliance(tickets), health.billing_by_account(billing), self.as_of)
        return build_marts(
            self, mart, accounts=accounts, users=users, plans=plans, subscriptions=subscriptions, billing=billing,
            daily_usage=self.dated("usage_days", DAYS), checked_usage=self.dated("fact_usage", USAGE, dates=touched) if touched else recent,
            open_tickets=self.dated("fact_support", SUPPORT, "created_month", dates=self._unresolved_months()),
            as_of=self.as_of, recipients=recipients, train_churn=train_churn)

    def _one_a_key(self, arrived: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """One row a key of every dataset.  Keys are told apart by their hash first; only rows whose hash comes twice are ranked."""
        if not arrived:
            return {}
        marked = {name: df.withColumn("_key", F.xxhash64(F.lit(name), S.BRONZE_KEYS[name])) for name, df in arrived.items()}
        keys = reduce(DataFrame.unionByName, [df.select("_key") for df in marked.values()])
        repeated = storage.stage(keys.groupBy("_key").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1").select("_key"),
                                 self.root, self.run_id, "repeated_keys")

        def one(name: str) -> DataFrame:
            single, copies = (marked[name].join(repeated, "_key", how).select(*arrived[name].columns) for how in ("left_anti", "left_semi"))
            return single.unionByName(_newest(copies, name))

        return {name: one(name) for name in arrived}

    def _of_accounts(self, new: dict[str, DataFrame], arrived: dict[str, DataFrame], accounts: DataFrame) -> dict[str, DataFrame]:
        """Rows of known accounts."""
        if not new:
            return {}
        named = reduce(DataFrame.unionByName, [arrived[name].select("account_id") for name in new]).where("account_id IS NOT NULL").distinct()
        unknown = storage.stage(named.join(accounts.select("account_id"), "account_id", "left_anti"), self.root, self.run_id, "unknown_accounts")
        return {name: with_unknown_key(df.where("account_id IS NOT NULL"), unknown, "account_id", spread_by=[S.BRONZE_KEYS[name]])
                for name, df in new.items()}

    def _replaced(self, name: str, key: str, new: DataFrame | None) -> DataFrame:
        if new is None and name in self.state.runs:
            return self.stored(name)  # stays at the run it is
        old = self.stored(name)
        return self.put(name, old if new is None else replace_rows(old, new.select(*old.columns), [key]))

    def _billing(self, invoices: DataFrame | None) -> DataFrame:
        """All invoices with ``is_overdue`` as of this run."""
        old = self.stored("fact_billing")
        base = [c for c in old.columns if c != "is_overdue"]
        rows = old.select(*base)
        if invoices is not None:
            rows = replace_rows(rows, invoices.select(*base), ["invoice_id"])
        return self.put("fact_billing", facts.fact_billing(rows, self.as_of))

    def _unresolved_months(self) -> list[str]:
        """Months with unresolved tickets, from the summaries: the calendar's at most."""
        days = self.dated("support_counts", SUPPORT_COUNTS, "created_month")
        return [str(r[0]) for r in days.where("unresolved > 0").select("created_month").distinct().collect()]

    def _due_months(self) -> list[str]:
        """Months where a breach may differ at the time of this run: an unresolved ticket that was none may have become one,
        and at an earlier time than the last it may not be one yet."""
        days = self.dated("support_counts", SUPPORT_COUNTS, "created_month")
        due = (F.col("pending") > 0) | (F.col("judged_at") > C.as_timestamp(self.as_of))
        return [str(r[0]) for r in days.where((F.col("unresolved") > 0) & F.coalesce(due, F.lit(True))).select("created_month").distinct().collect()]

    def _support(self, tickets: DataFrame | None) -> None:
        base = [c for c in S.struct(S.WAREHOUSE["fact_support"]).fieldNames() if c not in ("resolution_time_hours", "sla_breached")]
        fresh = None if tickets is None else tickets.withColumn("severity", F.lower("severity")).select(*base, _month("created_at").alias("created_month"))
        if not storage.published_dates(self.state, "fact_support"):  # nothing to merge with
            if fresh is not None:
                self._judged(fresh.drop("created_month"))
            return
        dates = set(self._due_months())
        new = None
        if fresh is not None:
            changed, months = self._staged(fresh, "changed_tickets", SUPPORT, "created_month")
            dates |= set(months)
            new = changed.select(*base)
        if not dates:
            return
        rows = self.dated("fact_support", SUPPORT, "created_month", dates).select(*base)
        if new is not None:
            rows = replace_rows(rows, new, ["ticket_id"])
        self._judged(rows)

    def _judged(self, tickets: DataFrame) -> None:
        """Write whole months of tickets, with breaches as of this run, and their counts."""
        judged = facts.fact_support(tickets, self.as_of).withColumn("created_month", _month("created_at"))
        written = self.put_dates(judged, "fact_support", "created_month")
        if not written:
            return
        rows = self.dated("fact_support", SUPPORT, "created_month", written)
        pending = F.count_if(F.col("resolved_at").isNull() & ~F.col("sla_breached"))
        counted = health.ticket_counts(rows, "account_id", "created_month", more=[pending.alias("pending")])
        self.put_dates(counted.withColumn("judged_at", C.as_timestamp(self.as_of)), "support_counts", "created_month")

    def _usage(self, events: DataFrame | None) -> list[str]:
        """Merge new events, from the landing and the live job; the dates that changed."""
        arrivals = None if events is None else facts.fact_usage(events)
        if self.live is not None:
            upto = self.live.finished()
            from_live = self.live.usage(int(self.state.marks.get("live_batch", -1)), upto)
            arrivals = from_live if arrivals is None else arrivals.unionByName(from_live)
            self.marks["live_batch"] = upto
        if arrivals is None:
            return []
        changes, dates = self._staged(arrivals, "usage_arrivals", USAGE)
        stored = set(storage.published_dates(self.state, "fact_usage")).intersection(dates)
        if self.live is not None or stored:  # else events of the landing, one a key, of dates that hold none yet
            if self.live is not None:
                changes = keep_first(changes, ["usage_id"], ["event_timestamp", "account_id", "user_id", "feature"])
            old = self.dated("fact_usage", USAGE, dates=dates)
            fresh = changes.join(old.select("usage_id"), "usage_id", "left_anti").select(*old.columns)
            changes, dates = self._staged(fresh, "usage_changes", USAGE)
        if not dates:
            return []
        merged = self.dated("fact_usage", USAGE, dates=dates).unionByName(changes)
        self.put_dates(merged, "fact_usage")
        rebuilt = self.dated("fact_usage", USAGE, dates=dates)
        self.put_dates(usage.daily_usage_by_account(rebuilt), "usage_days")
        self.put_dates(usage.tumbling(rebuilt).withColumn("event_date", F.to_date("window_start")), "usage_hours")
        self.put_dates(sketches.daily_users(rebuilt), "usage_users")
        self._sessions(changes, dates)
        self.put("dim_date", facts.dim_date(self.dated("usage_days", DAYS), "event_date"))
        return dates

    def _staged(self, df: DataFrame, name: str, schema: str, by: str = "event_date") -> tuple[DataFrame, list[str]]:
        """Rows written by date that are not published themselves, and their dates."""
        names = storage.stage_dates(df, self.root, self.run_id, name, by)
        read = storage.read_dates(self.spark, self.root, name, schema, None, storage.Published(runs=dict.fromkeys(names, self.run_id)), by)
        return read, [n.split("/", 1)[1] for n in names]

    def _sessions(self, changes: DataFrame, dates: list[str]) -> None:
        """Join the sessions of new events with the stored ones they touch; only the dates of these are written."""
        fresh = storage.stage(usage.sessions(changes, SESSION_GAP).select(*[c.split(" ")[0] for c in SESSIONS.split(", ")[:-1]]),
                              self.root, self.run_id, "new_sessions")
        longest = int(self.state.marks.get("longest_session_days", 0))
        near = _days_around(dates, before=longest + 1, after=1)
        published = set(storage.published_dates(self.state, "usage_sessions"))
        span = Observation()

        def observed(sessions: DataFrame) -> DataFrame:
            both = sessions.withColumn("start_date", F.to_date("session_start"))
            return both.observe(span, F.max(F.date_diff(F.to_date("session_end"), F.to_date("session_start"))).alias("days"))

        if published.isdisjoint(near) and published.isdisjoint(dates):  # nothing to join them with
            self.put_dates(observed(fresh), "usage_sessions", "start_date")
            self.marks["longest_session_days"] = max(longest, storage.observed(span).get("days") or 0)
            return
        stored = self.dated("usage_sessions", SESSIONS, "start_date", near)
        merged, touched = merge_sessions(stored.drop("start_date"), fresh, SESSION_GAP)
        touched = storage.stage(touched, self.root, self.run_id, "touched_sessions")
        changed, names = self._staged(observed(merged), "session_changes", SESSIONS, "start_date")
        self.marks["longest_session_days"] = max(longest, storage.observed(span).get("days") or 0)
        # a session that was joined to an earlier one leaves the date it began on
        left = [str(r[0]) for r in touched.select(F.to_date("session_start")).distinct().collect()]  # of the dates around
        dates = sorted({*names, *left})
        kept = self.dated("usage_sessions", SESSIONS, "start_date", dates).join(touched, ["user_id", "session_start"], "left_anti")
        written = set(self.put_dates(kept.unionByName(changed), "usage_sessions", "start_date"))
        self.removed += [f"usage_sessions/{d}" for d in left if d not in written]


def merge_sessions(stored: DataFrame, fresh: DataFrame, gap_seconds: int = SESSION_GAP) -> tuple[DataFrame, DataFrame]:
    """(sessions after the fresh ones are joined with the stored ones they touch, keys of those stored ones).

    Two sessions are one where less than the gap lies between them.  Both sides are sessions of their own
    events, so nothing is read again but their ends.
    """
    gap = gap_seconds * 1_000_000
    s, f = stored.alias("s"), fresh.alias("f")
    at = lambda c: F.unix_micros(c)
    close = ((F.col("s.user_id") == F.col("f.user_id")) & (at("f.session_start") < at("s.session_end") + gap)
             & (at("s.session_start") < at("f.session_end") + gap))
    hit = s.join(f, close, "left_semi")
    parts = hit.select(*fresh.columns).unionByName(fresh)
    by_user = Window.partitionBy("user_id").orderBy("session_start", "session_end")
    reach = F.max("session_end").over(by_user.rowsBetween(Window.unboundedPreceding, -1))
    begins = reach.isNull() | (at("session_start") - at(reach) >= gap)
    numbered = parts.withColumn("_begins", begins.cast("int")).withColumn(
        "_no", F.sum("_begins").over(by_user.rowsBetween(Window.unboundedPreceding, 0)))
    merged = numbered.groupBy("user_id", "_no").agg(
        F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"), F.sum("event_count").alias("event_count"))
    return merged.drop("_no").select(*fresh.columns), hit.select("user_id", "session_start")


def _newest(df: DataFrame, name: str) -> DataFrame:
    """One row a key: the newest version, of events the first."""
    key = S.BRONZE_KEYS[name]
    rest = (["_seq"] if "_seq" in df.columns else []) + sorted(c for c in df.columns if c not in (key, "_seq") and not c.startswith("_"))
    if name == "product_events" or "_ingested_at" not in df.columns:
        return keep_first(df, [key], rest)
    return keep_latest(df, [key], "_ingested_at", rest)


def _month(time: str):
    return F.trunc(F.to_date(time), "month")


def _as_datetime(as_of) -> datetime:
    return datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of


def _days_around(dates: list[str], before: int, after: int) -> list[str]:
    days = {datetime.fromisoformat(d).date() for d in dates if d[:1].isdigit()}
    return sorted({(d + timedelta(days=n)).isoformat() for d in days for n in range(-before, after + 1)})
