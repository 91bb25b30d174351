"""The subscription domain, read from the general-purpose driver tables.

Customers are accounts, orders are invoices, line items are support
tickets and ``events`` is product telemetry.  Schemas are given, not inferred,
so filters and column lists reach the Parquet scan unchanged.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators import facts, health, revenue, rules
from tidemark.operators.keyed import keep_first
from tidemark.streaming.events import normalise

SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "orders": ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
               "o_orderdate TIMESTAMP, o_orderpriority STRING"),
    "lineitem": ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                 "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                 "l_linestatus STRING, l_shipdate TIMESTAMP"),
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}

USAGE_AS_OF = "2024-01-31 00:00:00"
BILLING_AS_OF = "1995-07-01 00:00:00"
SUPPORT_AS_OF = "2001-12-31 00:00:00"
# Line items of this quantity are grave tickets, which may stay open; smaller ones are always resolved.
GRAVE_FROM_QUANTITY = 49
BACKLOG_FROM_QUANTITY = 40

# Quotas low enough for the telemetry at hand to reach them.
SMALL_QUOTAS = (
    ("Starter", 299, 5, 2_300), ("Professional", 999, 25, 2_400),
    ("Enterprise", 3_499, 100, 2_500), ("Enterprise Plus", 7_499, 500, 2_600),
)


class Domain:
    """Lazy domain frames over one table folder; nothing runs until an action."""

    def __init__(self, spark: SparkSession, folder: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.folder = spark, folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def arriving(self, name: str) -> DataFrame:
        """The table as a stream of its files (a file or a folder of them)."""
        return self.spark.readStream.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parque[t]")

    # ------------------------------------------------------------ raw inputs
    @cached_property
    def accounts(self) -> DataFrame:
        key, balance = F.col("c_custkey"), F.col("c_acctbal")
        digit = key % 10
        return (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                key.alias("account_id"), F.col("c_name").alias("company_name"),
                F.col("c_mktsegment").alias("industry"),
                F.when(balance < 0, "1-50").when(balance < 2500, "51-200").when(balance < 7500, "201-1000")
                .otherwise("1000+").alias("size"),
                F.col("r_name").alias("region"), F.col("n_name").alias("owner"),
                F.timestamp_add("DAY", (key % 365).cast("int"), F.lit("1994-01-01").cast("timestamp")).alias("created_at"),
                F.when(digit < 6, "healthy").when(digit < 8, "churn_risk").when(digit == 8, "expansion_ready")
                .otherwise("underutilized").alias("cohort"),
            )
        )

    @cached_property
    def subscriptions(self) -> DataFrame:
        return self._subscriptions(self.table("customer"))

    @staticmethod
    def _subscriptions(customers: DataFrame) -> DataFrame:
        key = F.col("c_custkey")
        slot = (key % 4).cast("int")
        plan = F.lit(S.PLANS[3][0])
        price = F.lit(S.PLANS[3][1])
        for i, (name, mrr, _, _) in reversed(list(enumerate(S.PLANS[:3]))):
            plan = F.when(slot == i, name).otherwise(plan)
            price = F.when(slot == i, mrr).otherwise(price)
        return customers.select(
            key.alias("subscription_id"), key.alias("account_id"), plan.alias("plan"),
            F.timestamp_add("DAY", (key % 365).cast("int"), F.lit("1994-01-01").cast("timestamp")).alias("start_date"),
            F.when(F.col("c_acctbal") < 0, "past_due").otherwise("active").alias("status"),
            price.cast("decimal(10,2)").alias("mrr"),
        )

    @cached_property
    def invoices(self) -> DataFrame:
        failed = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
        status = F.when(failed, "failed").when(F.col("o_orderstatus") == "O", "open").otherwise("paid")
        days = lambda n: F.timestamp_add("DAY", F.lit(n), F.col("o_orderdate"))
        return self.table("orders").select(
            F.col("o_orderkey").alias("invoice_id"), F.col("o_custkey").alias("account_id"),
            F.col("o_totalprice").cast("decimal(10,2)").alias("amount"), days(15).alias("due_date"),
            status.alias("status"), F.when(status == "paid", days(10)).alias("paid_at"),
        )

    @cached_property
    def ticket_copies(self) -> DataFrame:
        """Tickets as delivered; ids repeat."""
        return self._ticket_copies(self.table("lineitem"))

    def _ticket_copies(self, lines: DataFrame, grave_from: int = GRAVE_FROM_QUANTITY) -> DataFrame:
        shipped, ordered = F.col("l_shipdate"), F.col("o_orderdate")
        grave = F.col("l_quantity") >= grave_from
        resolved = ~grave | (F.col("l_linestatus") == "F") & (shipped >= ordered)
        flag, odd = F.when(grave, F.col("l_returnflag")), F.col("l_linenumber") % 2 == 1
        lines = lines.select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag",
            "l_linestatus", "l_shipdate", "l_quantity")
        return lines.join(
            self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate"),
            F.col("l_orderkey") == F.col("o_orderkey"),
        ).select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ticket_id"), F.col("o_custkey").alias("account_id"),
            F.when(flag == "A", "critical").when(flag == "R", "high").when(odd, "medium").otherwise("low")
            .alias("severity"),
            F.when(resolved, "resolved").otherwise("open").alias("status"), ordered.alias("created_at"),
            F.when(resolved, F.greatest(shipped, ordered)).alias("resolved_at"),
            "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate",
        )

    TICKET_ORDER = ("l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")

    @cached_property
    def tickets(self) -> DataFrame:
        return keep_first(self.ticket_copies, ["ticket_id"], self.TICKET_ORDER).drop(*self.TICKET_ORDER)

    @cached_property
    def backlog(self) -> DataFrame:
        """Support facts with more grave tickets, so that accounts have backlogs."""
        copies = self._ticket_copies(self.table("lineitem"), BACKLOG_FROM_QUANTITY)
        return facts.fact_support(keep_first(copies, ["ticket_id"], self.TICKET_ORDER), SUPPORT_AS_OF)

    @cached_property
    def events(self) -> DataFrame:
        return self._events(self.table("events"))

    @staticmethod
    def _events(events: DataFrame) -> DataFrame:
        return events.select(
            "event_id", "user_id", F.expr("user_id DIV 3").alias("account_id"),
            F.col("event_type").alias("feature"), F.col("ts").alias("timestamp"),
        )

    @cached_property
    def users(self) -> DataFrame:
        uid = F.col("user_id")
        first = self.table("events").groupBy("user_id").agg(F.min("ts").alias("created_at"))
        account = F.expr("user_id DIV 3")
        return first.select(
            "user_id", account.alias("account_id"),
            F.concat(F.lit("user"), uid, F.lit("@Account"), account, F.lit(".example.com")).alias("email"),
            F.when(uid % 3 == 0, "admin").when(uid % 3 == 1, "developer").otherwise("viewer").alias("role"),
            "created_at",
        )

    # ------------------------------------------------------------- warehouse
    @cached_property
    def dim_account(self) -> DataFrame:
        return facts.dim_account(self.accounts)

    @cached_property
    def dim_user(self) -> DataFrame:
        return facts.dim_user(self.users)

    @cached_property
    def dim_plan(self) -> DataFrame:
        return facts.dim_plan(self.spark)

    @cached_property
    def small_quota_plans(self) -> DataFrame:
        return facts.dim_plan(self.spark, SMALL_QUOTAS)

    @cached_property
    def subscription_facts(self) -> DataFrame:
        return facts.fact_subscription(self.subscriptions)

    @cached_property
    def billing(self) -> DataFrame:
        return facts.fact_billing(self.invoices, BILLING_AS_OF)

    @cached_property
    def support(self) -> DataFrame:
        return facts.fact_support(self.tickets, SUPPORT_AS_OF)

    @cached_property
    def usage(self) -> DataFrame:
        return facts.fact_usage(self.events)

    @cached_property
    def health(self) -> DataFrame:
        return health.customer_health(
            self.dim_account, self.subscription_facts, self.usage, self.support, self.billing, USAGE_AS_OF)

    @cached_property
    def standing(self) -> DataFrame:
        return health.account_standing(self.dim_account, self.subscription_facts, self.billing)

    @cached_property
    def revenue(self) -> DataFrame:
        return revenue.revenue_summary(self.dim_account, self.subscription_facts, self.billing, USAGE_AS_OF)

    @cached_property
    def alerts(self) -> DataFrame:
        return rules.evaluate(self.health, self.billing, self.dim_account, self.small_quota_plans, USAGE_AS_OF)

    # --------------------------------------------------------------- derived
    @cached_property
    def yearly_payments(self) -> DataFrame:
        return self.invoices_by(F.year("o_orderdate"), "year")

    @cached_property
    def monthly_payments(self) -> DataFrame:
        return self.invoices_by(F.year("o_orderdate") * 12 + F.month("o_orderdate") - 1, "month_number")

    def invoices_by(self, period, name: str) -> DataFrame:
        return self.table("orders").select(
            F.col("o_custkey").alias("account_id"), period.alias(name),
            F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))

    @cached_property
    def order_usage(self) -> DataFrame:
        """Orders in the shape of usage, for the years the tickets are from."""
        return self.table("orders").select(
            F.col("o_custkey").alias("account_id"), F.col("o_custkey").alias("user_id"),
            F.col("o_orderdate").alias("event_timestamp"), F.to_date("o_orderdate").alias("event_date"))

    @cached_property
    def labelled(self) -> DataFrame:
        """Heuristic risk score against the past-due label."""
        late = self.subscriptions.select("account_id", F.when(F.col("status") == "past_due", 1).otherwise(0).alias("label"))
        return self.health.select("account_id", F.col("churn_risk_score").alias("score")).join(late, "account_id")

    @cached_property
    def stream_events(self) -> DataFrame:
        return self._topics(self.table)

    @cached_property
    def arriving_events(self) -> DataFrame:
        return self._topics(self.arriving)

    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        """The six raw datasets with ids as text, as a landing has them."""
        frames = {"accounts": self.accounts, "users": self.users, "subscriptions": self.subscriptions, "invoices": self.invoices,
                  "support_tickets": self.tickets, "product_events": self.events}
        return {name: df.withColumns({c: F.col(c).cast("string") for c in df.columns if c.endswith("_id")}).select(
            *S.struct(S.BRONZE[name]).fieldNames()) for name, df in frames.items()}

    @cached_property
    def month_ends(self) -> DataFrame:
        """Standing of every account at the end of each month of orders, from the invoices known by then."""
        first, last = self.order_usage.agg(F.min("event_date")).scalar(), self.order_usage.agg(F.max("event_date")).scalar()
        months = F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("INTERVAL 1 MONTH"))
        known = self.table("orders").select("o_orderkey", F.to_date("o_orderdate").alias("_known")).join(
            self.invoices, F.col("o_orderkey") == F.col("invoice_id"))
        # the first day an account is in trouble: a failed invoice at once, an open one after it is due
        trouble = known.select("account_id", F.when(F.col("status") == "failed", F.col("_known")).when(
            F.col("status") == "open", F.greatest("_known", F.date_add(F.to_date("due_date"), 1))).alias("_since")).groupBy(
            "account_id").agg(F.min("_since").alias("_since"))
        status = self.subscriptions.select("account_id", F.col("status").alias("_status"), F.to_date("start_date").alias("_start"))
        per_account = self.dim_account.select("account_id").join(trouble, "account_id", "left").join(status, "account_id")
        return per_account.withColumn("month", F.explode(months)).withColumn("day", F.last_day("month")).select(
            "account_id", "day", F.when(F.col("_since") <= F.col("day"), S.PAYMENT_TROUBLE).otherwise(S.GOOD_STANDING).alias("payment_status"),
            F.when(F.col("_start") <= F.col("day"), F.col("_status")).alias("subscription_status"))

    def _topics(self, source) -> DataFrame:
        """All four topics in the common event shape; a '4-NOT SPECIFIED' order
        gives a billing event without status."""
        unstated = F.col("o_orderpriority") == "4-NOT SPECIFIED"
        failed = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
        billing = source("orders").select(
            F.concat(F.lit("b"), F.col("o_orderkey")).alias("event_id"), F.col("o_custkey").alias("account_id"),
            F.col("o_orderkey").cast("string").alias("invoice_id"),
            F.col("o_totalprice").cast("decimal(10,2)").alias("amount"),
            F.when(unstated, F.lit(None)).when(failed, "failed").otherwise("paid").alias("status"),
            F.col("o_orderdate").alias("timestamp"))
        support = self._ticket_copies(source("lineitem")).select(
            F.concat(F.lit("s"), F.col("ticket_id")).alias("event_id"), "account_id",
            F.col("ticket_id").cast("string").alias("ticket_id"), "severity", "status",
            F.col("created_at").alias("timestamp"))
        subscription = self._subscriptions(source("customer")).select(
            F.concat(F.lit("c"), F.col("account_id")).alias("event_id"), "account_id",
            F.when(F.col("status") == "past_due", "cancelled").otherwise("active").alias("status"),
            F.col("start_date").alias("timestamp"))
        product = self._events(source("events")).select(
            F.concat(F.lit("p"), F.col("event_id")).alias("event_id"), "account_id",
            F.col("user_id").cast("string").alias("user_id"), "feature", "timestamp")
        topics = {"product.events": product, "subscription.events": subscription,
                  "billing.events": billing, "support.events": support}
        shaped = [normalise(frame, topic) for topic, frame in topics.items()]
        return reduce(DataFrame.unionByName, shaped)
