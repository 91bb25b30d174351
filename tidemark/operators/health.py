"""Per-account aggregates and the customer-health marts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions import columns as C
from tidemark.operators.keyed import keep_latest, with_known_key
from tidemark.operators.ranking import presence_changes
from tidemark.operators.usage import trailing_usage


TICKET_COUNTS = ("total_tickets", "open_tickets", "critical_tickets", "critical_open_tickets", "sla_breached_count", "unresolved")


def ticket_counts(support: DataFrame, *keys: str, more: Sequence[Column] = ()) -> DataFrame:
    """Ticket counts by ``keys``, with ``more`` aggregates; counts of parts add up.

    ``critical_tickets`` counts them whatever their status, which is what health
    and the support rule use; ``critical_open_tickets`` only those still open.
    """
    critical = F.col("severity") == "critical"
    return support.groupBy(*keys).agg(
        F.count("ticket_id").alias("total_tickets"),
        F.count_if(F.col("status") == "open").alias("open_tickets"),
        F.count_if(critical).alias("critical_tickets"),
        F.count_if(critical & (F.col("status") == "open")).alias("critical_open_tickets"),
        F.count_if("sla_breached").alias("sla_breached_count"),
        F.count_if(F.col("resolved_at").isNull()).alias("unresolved"), *more,
    )


def with_compliance(counts: DataFrame) -> DataFrame:
    breached_pct = C.ratio(F.col("sla_breached_count"), F.col("total_tickets"), 0.0) * 100.0
    return counts.withColumn("sla_compliance_rate", F.round(100.0 - breached_pct, 2))


def support_by_account(support: DataFrame) -> DataFrame:
    """Ticket counts and SLA compliance per account."""
    return with_compliance(ticket_counts(support, "account_id").drop("unresolved"))


def billing_by_account(billing: DataFrame) -> DataFrame:
    flags = billing.groupBy("account_id").agg(
        F.coalesce(F.bool_or(F.col("status") == "failed"), F.lit(False)).alias("has_failed"),
        F.bool_or("is_overdue").alias("has_open_overdue"),
    )
    return flags.withColumn(
        "payment_status",
        F.when(F.col("has_failed") | F.col("has_open_overdue"), S.PAYMENT_TROUBLE).otherwise(S.GOOD_STANDING),
    )


def sla_breach_rate(support: DataFrame) -> DataFrame:
    """Breached share of tickets, per severity."""
    counts = support.groupBy("severity").agg(
        F.count("ticket_id").alias("tickets"), F.count_if("sla_breached").alias("breached")
    )
    return counts.withColumn("breach_rate_pct", C.percent(F.col("breached"), F.col("tickets")))


def customer_health(accounts: DataFrame, subscriptions: DataFrame, usage: DataFrame,
                    support: DataFrame, billing: DataFrame, as_of) -> DataFrame:
    """The health mart: one row per account."""
    return assemble_health(accounts, subscriptions, trailing_usage(usage, as_of), support_by_account(support),
                           billing_by_account(billing), as_of)


def assemble_health(accounts: DataFrame, subscriptions: DataFrame, usage_30d: DataFrame,
                    tickets: DataFrame, payments: DataFrame, as_of) -> DataFrame:
    """The health mart from inputs of one row per account.

    An account with several subscriptions is represented by the latest one.
    """
    plan = keep_latest(subscriptions, ["account_id"], "start_date", ["subscription_id"]).select(
        "account_id", F.col("plan_name").alias("plan"), "mrr", F.col("status").alias("subscription_status")
    )
    joined = (
        accounts.join(plan, "account_id", "left")
        .join(usage_30d, "account_id", "left")
        .join(tickets, "account_id", "left")
        .join(payments.select("account_id", "payment_status"), "account_id", "left")
        .fillna({
            "events_last_30d": 0, "active_users_30d": 0, "open_tickets": 0, "critical_tickets": 0,
            "sla_compliance_rate": 100.0, "payment_status": S.GOOD_STANDING,
        })
    )
    return score_health(joined, as_of)


def score_health(joined: DataFrame, as_of) -> DataFrame:
    raw = C.health_score(
        F.col("events_last_30d"), F.col("open_tickets"), F.col("critical_tickets"),
        F.col("payment_status"), F.col("subscription_status"),
    )
    score = F.col("health_score")
    propensity = F.col("events_last_30d") / F.lit(1000.0) * F.when(score >= S.HEALTHY_FROM, 0.8).otherwise(0.2)
    return (
        joined.withColumn("_raw", raw)
        .withColumn("health_score", F.round("_raw", 1))
        .withColumn("health_tier", C.health_tier(F.col("_raw")))
        .withColumn("churn_risk_score", F.round(F.greatest(F.lit(0.02), (100.0 - score) / 100.0), 3))
        .withColumn("expansion_score", F.round(F.least(F.lit(0.95), propensity), 3))
        .withColumn("anomaly_detected", F.coalesce(F.col("cohort") == "churn_risk", F.lit(False)))
        .withColumn("last_updated_at", C.as_timestamp(as_of))
        .select(*S.HEALTH_COLUMNS)
    )


def flag_anomalies(health: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Health mart with ``anomaly_detected`` taken from detected usage anomalies."""
    found = anomalies.where("anomaly_type IS NOT NULL").select("account_id", F.lit(True).alias("_found"))
    return health.join(found, "account_id", "left").withColumn(
        "anomaly_detected", F.coalesce("_found", F.lit(False))
    ).select(*health.columns)


# -------------------------------------------------------------- daily history

def account_standing(accounts: DataFrame, subscriptions: DataFrame, billing: DataFrame) -> DataFrame:
    """Payment and subscription status of every account; the sources keep no history of them."""
    plan = keep_latest(subscriptions, ["account_id"], "start_date", ["subscription_id"]).select(
        "account_id", F.col("status").alias("subscription_status"))
    paid = billing_by_account(billing).select("account_id", "payment_status")
    return (accounts.select("account_id").join(plan, "account_id", "left").join(paid, "account_id", "left")
            .fillna({"payment_status": S.GOOD_STANDING}))


STANDING = ("payment_status", "subscription_status")


def standing_history(snapshots: DataFrame) -> DataFrame:
    """Validity intervals of successive daily snapshots (``day`` and the standing of every account on it).

    ``valid_to`` is the day of the next change, null where it still holds.  A snapshot equal to the one
    before adds nothing.
    """
    by_day = Window.partitionBy("account_id").orderBy("day")
    standing = F.struct(*STANDING)
    before = F.lag(standing).over(by_day)
    changes = snapshots.withColumn("_new", before.isNull() | ~standing.eqNullSafe(before)).where("_new")
    return changes.select("account_id", *STANDING, F.col("day").alias("valid_from"), F.lead("day").over(by_day).alias("valid_to"))


def extend_history(history: DataFrame, snapshot: DataFrame, day) -> DataFrame:
    """The history after one more snapshot, taken on a day not before the last; running it again changes nothing."""
    day = F.lit(day).cast("date")
    # a run that is repeated takes its own day back first
    earlier = history.where(F.col("valid_from") < day).withColumn("valid_to", F.when(F.col("valid_to") < day, F.col("valid_to")))
    now = snapshot.select("account_id", *[F.col(c).alias(f"_{c}") for c in STANDING], F.lit(True).alias("_seen"))
    current = earlier.where("valid_to IS NULL").join(now, "account_id", "full_outer")
    same = F.struct(*STANDING).eqNullSafe(F.struct(*[F.col(f"_{c}") for c in STANDING]))
    changed = F.col("_seen") & (F.col("valid_from").isNull() | ~same)
    old = current.where("valid_from IS NOT NULL").select("account_id", *STANDING, "valid_from", F.when(changed, day).alias("valid_to"))
    new = current.where(changed).select("account_id", *[F.col(f"_{c}").alias(c) for c in STANDING], day.alias("valid_from"),
                                        F.lit(None).cast("date").alias("valid_to"))
    return earlier.where("valid_to IS NOT NULL").unionByName(old).unionByName(new)


def health_daily(usage: DataFrame, support: DataFrame, standing: DataFrame,
                 first_day: str | None = None, last_day: str | None = None, runs: bool = False) -> DataFrame:
    """Health per account of ``standing`` and calendar day between two dates (inclusive).

    Without a date, the range begins or ends with the days of ``usage``.
    An account without usage has a row for every day as well.  Events, user presence,
    ticket backlog and the calendar itself are all expressed as changes on an
    (account, day); one aggregation sums them and one window accumulates them,
    so nothing is joined day by day.

    ``standing`` is a history (``standing_history``), whose state of each day counts, or one row an
    account, which counts for every day.  Before an account's first known state it is in good standing.

    With ``runs`` there is one row per account and run of days on which score, tickets and standing stay
    the same, from ``date_key`` to the day before ``until``: rows grow with the changes, not with the days.
    Rows that are ``listed`` are of accounts that ``standing`` does not name, which have no calendar.
    """
    first = F.lit(first_day).cast("date") if first_day else usage.agg(F.min("event_date")).scalar()
    last = F.lit(last_day).cast("date") if last_day else usage.agg(F.max("event_date")).scalar()
    first_no, last_no = F.unix_date(first), F.unix_date(last)
    in_range = usage.where(F.col("event_date").between(first, last)).select(
        "account_id", "user_id", F.unix_date("event_date").alias("_day"))
    dated = "valid_from" in standing.columns
    accounts = standing.select("account_id").distinct() if dated else standing.select("account_id")

    # A ticket opens and closes its place in the backlog; changes before the
    # range are booked on its first day.
    is_p1 = (F.col("severity") == "critical").cast("int")
    moves = F.array(F.struct(F.col("created_at").alias("at"), F.lit(1).alias("n")),
                    F.struct(F.col("resolved_at").alias("at"), F.lit(-1).alias("n")))
    tickets = (
        with_known_key(support, accounts, "account_id", spread_by=["ticket_id"])
        .select("account_id", is_p1.alias("_p1"), F.explode(moves).alias("m"))
        .where(F.to_date("m.at") <= last)
        .select("account_id", F.greatest(F.unix_date(F.to_date("m.at")), first_no).alias("_day"),
                F.col("m.n").alias("open_tickets_count"), (F.col("m.n") * F.col("_p1")).alias("unresolved_p1_tickets"))
    )
    # A state begins on its first day; of those before the range the newest holds on the first.
    begun = F.unix_date("valid_from") if dated else first_no
    states = standing.where(begun <= last_no).groupBy("account_id", F.greatest(begun, first_no).alias("_day")).agg(
        F.max_by(F.struct(*STANDING), begun).alias("_standing"))
    if not runs:
        calendar = accounts.select("account_id", F.explode(F.sequence(first_no, last_no)).alias("_day"))
        return _by_day([calendar, *_activity(in_range), tickets, states], last_no)
    named = _by_run(in_range, accounts, tickets, states, first_no, last_no)
    # rows of accounts without a calendar are on the days of their own changes
    listed = in_range.join(accounts.select(F.col("account_id").alias("_named")), F.col("account_id").eqNullSafe(F.col("_named")), "left_anti")
    return named.withColumn("listed", F.lit(False)).unionByName(
        _by_day(_activity(listed), last_no).withColumn("until", F.date_add("date_key", 1)).withColumn("listed", F.lit(True))
        .select(*named.columns, "listed"))


_SUMMED = ("events", "active_users_7d", "active_users_30d", "open_tickets_count", "unresolved_p1_tickets")


def _activity(in_range: DataFrame) -> list[DataFrame]:
    """Events and changes of the present users by account and day."""
    events = in_range.groupBy("account_id", "_day").agg(F.count(F.lit(1)).alias("events"))
    users = presence_changes(in_range, ["account_id"], "user_id", "_day",
                             {"active_users_7d": 7, "active_users_30d": 30}).drop("members")
    return [events, users]


def _stacked(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _scored(df: DataFrame) -> DataFrame:
    """``payment_status`` and the unrounded ``_score`` from the accumulated counts and the standing."""
    known = df.withColumns({"payment_status": F.coalesce("_standing.payment_status", F.lit(S.GOOD_STANDING)),
                            "subscription_status": F.col("_standing.subscription_status")})
    return known.withColumn("_score", C.health_score(
        F.col("_events_30d"), F.col("open_tickets_count"), F.col("unresolved_p1_tickets"),
        F.col("payment_status"), F.col("subscription_status")))


def _by_day(parts: list[DataFrame], last_no: Column) -> DataFrame:
    """Health on every (account, day) that ``parts`` have; trailing counts are of the rows before."""
    stacked = _stacked(parts)
    if "_standing" not in stacked.columns:
        stacked = stacked.withColumns({"open_tickets_count": F.lit(0), "unresolved_p1_tickets": F.lit(0), "_standing": F.lit(None).cast(
            "struct<payment_status: string, subscription_status: string>")})
    daily = stacked.where(F.col("_day") <= last_no).groupBy("account_id", "_day").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _SUMMED], F.any_value("_standing", True).alias("_standing"))

    by_day = Window.partitionBy("account_id").orderBy("_day")
    upto = by_day.rowsBetween(Window.unboundedPreceding, 0)
    daily = _scored(daily.withColumns({
        **{c: F.sum(c).over(upto) for c in _SUMMED[1:]},
        "total_events_7d": F.sum("events").over(by_day.rowsBetween(-6, 0)),
        "_prior_7d": F.sum("events").over(by_day.rowsBetween(-13, -7)),
        "_events_30d": F.sum("events").over(by_day.rowsBetween(-29, 0)),
        "_standing": F.last("_standing", True).over(upto),
    }))
    shown = F.round("_score", 1)
    growth = C.ratio(F.col("total_events_7d") - F.col("_prior_7d"), F.col("_prior_7d"))
    return daily.select(
        "account_id", F.date_from_unix_date("_day").alias("date_key"), "active_users_7d", "active_users_30d",
        "total_events_7d", F.round(growth, 4).alias("event_growth_wow"),
        "open_tickets_count", "unresolved_p1_tickets", "payment_status", shown.alias("health_score"),
        F.round(F.greatest(F.lit(0.02), (100.0 - shown) / 100.0), 3).alias("churn_risk_score"),
    )


def _by_run(in_range: DataFrame, accounts: DataFrame, tickets: DataFrame, states: DataFrame,
            first_no: Column, last_no: Column) -> DataFrame:
    """Health of ``accounts`` by runs of days: a row begins where an event, a ticket or a state begins or ends."""
    begin = accounts.select("account_id", first_no.alias("_day"), F.lit(True).alias("_named"))
    # an event counts for 30 days
    moves = F.array(F.struct(F.col("_day").alias("at"), F.col("n")), F.struct((F.col("_day") + 30).alias("at"), (-F.col("n")).alias("n")))
    events = in_range.groupBy("account_id", "_day").agg(F.count(F.lit(1)).alias("n")).select("account_id", F.explode(moves).alias("m")).select(
        "account_id", F.col("m.at").alias("_day"), F.col("m.n").alias("_events_30d"))
    summed = ("_events_30d", "open_tickets_count", "unresolved_p1_tickets")
    changes = _stacked([begin, events, tickets, states]).where(F.col("_day") <= last_no).groupBy("account_id", "_day").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in summed], F.any_value("_standing", True).alias("_standing"),
        F.any_value("_named", True).alias("_named"))
    by_day = Window.partitionBy("account_id").orderBy("_day")
    upto = by_day.rowsBetween(Window.unboundedPreceding, 0)
    # the first row of an account in ``accounts`` is its beginning
    held = changes.withColumns({
        **{c: F.sum(c).over(upto) for c in summed}, "_standing": F.last("_standing", True).over(upto),
        "_named": F.first("_named").over(upto), "_until": F.coalesce(F.lead("_day").over(by_day), last_no + 1)}).where("_named")
    return _scored(held).select(
        "account_id", F.date_from_unix_date("_day").alias("date_key"), F.date_from_unix_date("_until").alias("until"),
        "open_tickets_count", "unresolved_p1_tickets", "payment_status", F.round("_score", 1).alias("health_score"))


def totals_by_day(runs: DataFrame, by: str, totals: dict[str, Column]) -> DataFrame:
    """``accounts`` and sums of ``totals`` of every day and value of ``by``, from runs of days (``health_daily``).

    A run adds on its first day and takes away after its last, so no account has a row a day.
    """
    def change(at: str, sign: int) -> Column:
        return F.struct(F.col(at).alias("_at"), F.lit(sign).alias("accounts"), *[(sign * c).alias(n) for n, c in totals.items()])

    names = ("accounts", *totals)
    moved = runs.select(by, F.explode(F.array(change("date_key", 1), change("until", -1))).alias("m")).select(by, "m.*")
    per_day = moved.groupBy(by, "_at").agg(*[F.sum(n).alias(n) for n in names])
    # the days of the calendar and the values of ``by`` at most
    in_time = Window.partitionBy(by).orderBy("_at")
    upto = in_time.rowsBetween(Window.unboundedPreceding, 0)
    held = per_day.withColumns({**{n: F.sum(n).over(upto) for n in names}, "_next": F.lead("_at").over(in_time)}).where("accounts > 0")
    return held.withColumn("date_key", F.explode(F.sequence("_at", F.date_sub("_next", 1)))).select("date_key", by, *names)


def health_drops(daily: DataFrame, drop: float = 0.20, days: int = 7) -> DataFrame:
    """Account days whose score fell by more than ``drop`` against ``days`` earlier; ``daily`` may be runs of days."""
    if "until" in daily.columns:
        return _run_drops(daily.where("NOT listed"), drop, days).unionByName(
            health_drops(daily.where("listed").drop("until", "listed"), drop, days))
    before = F.lag("health_score", days).over(Window.partitionBy("account_id").orderBy("date_key"))
    return _fallen(daily.withColumn("previous_score", before), drop)


def _fallen(compared: DataFrame, drop: float) -> DataFrame:
    fall = C.ratio(F.col("previous_score") - F.col("health_score"), F.col("previous_score"))
    return (
        compared.withColumn("drop_pct", F.round(fall * 100.0, 2))
        .where(fall > drop).select("account_id", "date_key", "previous_score", "health_score", "drop_pct")
    )


def _run_drops(runs: DataFrame, drop: float, days: int) -> DataFrame:
    """The drops of runs of days: a score counts from its first day on, and as the earlier one ``days`` later."""
    by_day = Window.partitionBy("account_id").orderBy("date_key")
    upto = by_day.rowsBetween(Window.unboundedPreceding, 0)
    end = F.max("until").over(Window.partitionBy("account_id"))
    other = ~F.col("health_score").eqNullSafe(F.lag("health_score").over(by_day))
    scores = runs.withColumns({"_end": end, "_other": F.lag("health_score").over(by_day).isNull() | other}).where("_other")
    none = F.lit(None).cast("double")
    moves = F.array(F.struct(F.col("date_key"), F.col("health_score"), none.alias("previous_score")),
                    F.struct(F.date_add("date_key", days).alias("date_key"), none.alias("health_score"), F.col("health_score").alias("previous_score")))
    changes = scores.select("account_id", "_end", F.explode(moves).alias("m")).select("account_id", "_end", "m.*").where(
        F.col("date_key") < F.col("_end")).groupBy("account_id", "date_key").agg(
        F.max("_end").alias("_end"), F.max("health_score").alias("health_score"), F.max("previous_score").alias("previous_score"))
    held = changes.withColumns({
        "health_score": F.last("health_score", True).over(upto), "previous_score": F.last("previous_score", True).over(upto),
        "_until": F.coalesce(F.lead("date_key").over(by_day), F.col("_end"))})
    fallen = _fallen(held.withColumn("_from", F.col("date_key")).withColumn("date_key", F.struct("_from", "_until")), drop)
    days_of = F.sequence(F.col("date_key._from"), F.date_sub("date_key._until", 1))
    return fallen.withColumn("date_key", F.explode(days_of))
