"""Revenue summary and recurring-revenue movements."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators.scans import blocks_of_blocks, in_blocks


def _sum_if(condition: Column, value: str) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col(value))), F.lit(0))


def revenue_summary(accounts: DataFrame, subscriptions: DataFrame, billing: DataFrame, as_of) -> DataFrame:
    """One row of company-wide revenue figures; each input is scanned once.

    From a single snapshot retention is measured against itself, so it is 100
    (0 without active revenue) and expansion is 0; ``revenue_movements`` gives
    the period-over-period figures.
    """
    active, past_due = F.col("status") == "active", F.col("status") == "past_due"
    parts = [
        subscriptions.agg(
            _sum_if(active, "mrr").alias("active_mrr"), _sum_if(past_due, "mrr").alias("past_due_mrr"),
            F.coalesce(F.sum("mrr"), F.lit(0)).alias("all_mrr"),
            F.count_if(active).alias("active_accounts"), F.count_if(past_due).alias("past_due_accounts"),
        ),
        billing.agg(
            _sum_if(F.col("status") == "paid", "amount").alias("paid"),
            _sum_if(F.col("status") != "paid", "amount").alias("unpaid"),
        ),
        accounts.agg(F.count(F.lit(1)).alias("accounts")),
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    one = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
    return one.select(
        F.unix_micros(C.as_timestamp(as_of)).alias("id"),
        F.col("active_mrr").cast("decimal(20,2)").alias("total_mrr"),
        (F.col("active_mrr") * 12).cast("decimal(22,2)").alias("total_arr"),
        F.col("paid").cast("decimal(22,2)").alias("paid_invoices_amount"),
        F.col("unpaid").cast("decimal(22,2)").alias("unpaid_invoices_amount"),
        "active_accounts", "past_due_accounts",
        C.percent(F.col("active_mrr"), F.col("active_mrr")).alias("net_retention_rate"),
        C.percent(F.col("past_due_accounts"), F.col("accounts")).alias("logo_churn_rate"),
        C.percent(F.col("past_due_mrr"), F.col("all_mrr")).alias("revenue_churn_rate"),
        F.lit(0.0).alias("expansion_rate"),
        C.as_timestamp(as_of).alias("calculated_at"),
    )


# ---------------------------------------------------------------- movements

def revenue_movements(payments: DataFrame, period: str, amount: str, account: str = "account_id") -> DataFrame:
    """Beginning, new, expansion, contraction, churn and ending revenue.

    One row per account and period over the whole range of integer periods, so
    an account that stops paying shows up as churn.
    """
    paid = payments.groupBy(account, F.col(period).alias("period")).agg(F.sum(amount).alias("_paid"))
    low, high = paid.agg(F.min("period")).scalar(), paid.agg(F.max("period")).scalar()
    spine = paid.select(account).distinct().select(account, F.explode(F.sequence(low, high)).alias("period"))
    in_order = Window.partitionBy(account).orderBy("period")
    zero = F.lit(0).cast("decimal(18,2)")
    before, now = F.col("beginning_mrr"), F.col("ending_mrr")
    rise = F.greatest(now - before, zero)
    fall = F.greatest(before - now, zero)
    return (
        spine.join(paid, [account, "period"], "left")
        .withColumn("ending_mrr", F.coalesce("_paid", zero).cast("decimal(18,2)"))
        .withColumn("_before", F.lag("ending_mrr").over(in_order))
        .withColumn("beginning_mrr", F.coalesce("_before", zero).cast("decimal(18,2)"))
        .select(
            account, "period", before,
            F.when(before == 0, rise).otherwise(zero).alias("new_mrr"),
            F.when((before > 0) & (now > before), rise).otherwise(zero).alias("expansion_mrr"),
            F.when((now > 0) & (now < before), fall).otherwise(zero).alias("contraction_mrr"),
            F.when((now == 0) & (before > 0), fall).otherwise(zero).alias("churn_mrr"),
            now, (now - before).alias("net_new_mrr"),
            F.when(F.col("_before").isNull(), "opening").when((before == 0) & (now > 0), "new")
            .when((before > 0) & (now == 0), "churn").when(now > before, "expansion")
            .when(now < before, "contraction").otherwise("unchanged").alias("change_type"),
        )
    )


def _later_periods(movements: DataFrame) -> DataFrame:
    """Movements of all periods that have a period before them."""
    return movements.where(F.col("change_type") != "opening")


def net_dollar_retention(movements: DataFrame) -> DataFrame:
    sums = _later_periods(movements).groupBy("period").agg(
        *[F.sum(f"{c}_mrr").alias(f"{c}_mrr") for c in ("beginning", "expansion", "contraction", "churn")])
    kept = F.col("beginning_mrr") + F.col("expansion_mrr") - F.col("contraction_mrr") - F.col("churn_mrr")
    return sums.withColumn("ndr_pct", C.percent(kept, F.col("beginning_mrr"), default=None))


def net_revenue_churn(movements: DataFrame) -> DataFrame:
    sums = _later_periods(movements).groupBy("period").agg(
        *[F.sum(f"{c}_mrr").alias(f"{c}_mrr") for c in ("beginning", "expansion", "churn")])
    return sums.withColumn("net_revenue_churn_pct", C.percent(
        F.col("churn_mrr") - F.col("expansion_mrr"), F.col("beginning_mrr"), default=None))


def logo_retention(movements: DataFrame) -> DataFrame:
    counts = _later_periods(movements).groupBy("period").agg(
        F.count_if(F.col("beginning_mrr") > 0).alias("starting_accounts"),
        F.count_if(F.col("ending_mrr") > 0).alias("ending_accounts"),
        F.count_if(F.col("change_type") == "new").alias("new_accounts"),
        F.count_if(F.col("change_type") == "churn").alias("churned_accounts"),
    )
    start = F.col("starting_accounts")
    return counts.withColumn(
        "logo_retention_pct", C.percent(F.col("ending_accounts") - F.col("new_accounts"), start, default=None)
    ).withColumn("logo_churn_pct", C.percent(F.col("churned_accounts"), start, default=None))


def cohort_retention(payments: DataFrame, period: str, account: str = "account_id") -> DataFrame:
    """Accounts still paying, by first paying period and age in periods."""
    active = payments.select(account, F.col(period).alias("period")).distinct()
    first = F.min("period").over(Window.partitionBy(account))
    aged = active.withColumn("cohort_period", first).withColumn("age", F.col("period") - F.col("cohort_period"))
    counts = aged.groupBy("cohort_period", "age").agg(F.count(F.lit(1)).alias("active_accounts"))
    size = counts.where("age = 0").select("cohort_period", F.col("active_accounts").alias("cohort_size"))
    return counts.join(size, "cohort_period").withColumn(
        "retention_pct", C.percent(F.col("active_accounts"), F.col("cohort_size")))


def churn_year_over_year(payments: DataFrame, month_number: str, account: str = "account_id") -> DataFrame:
    """Accounts lost per month against the same month one year earlier.

    ``month_number`` counts months (year * 12 + month - 1); an account is lost
    in the month after one it paid in when it does not pay again at once.
    """
    m = F.col("_m")
    paying = payments.select(account, F.col(month_number).alias("_m")).distinct()
    last_month = paying.agg(F.max("_m")).scalar()
    following = F.lead("_m").over(Window.partitionBy(account).orderBy("_m"))
    stays = paying.withColumn("_lost", F.when(following.isNull() | (following > m + 1), 1).otherwise(0))
    monthly = stays.where(m < last_month).groupBy((m + 1).alias("month_number")).agg(
        F.count(F.lit(1)).alias("starting_accounts"), F.sum("_lost").alias("churned_accounts"),
    ).withColumn("churn_pct", C.percent(F.col("churned_accounts"), F.col("starting_accounts")))
    earlier = monthly.select(
        (F.col("month_number") + 12).alias("month_number"), F.col("churn_pct").alias("churn_pct_year_ago"))
    return monthly.join(earlier, "month_number", "left").withColumn(
        "yoy_change", F.round(F.col("churn_pct") - F.col("churn_pct_year_ago"), 2))


# --------------------------------------------------------------------- trends

def trend_residual(series: DataFrame, group: str, order: str, value: str, half_width: int = 3) -> DataFrame:
    """Centred moving average and what is left; ends use the values they have."""
    centred = Window.partitionBy(group).orderBy(order).rowsBetween(-half_width, half_width)
    mean = F.sum(value).over(centred) / F.count(value).over(centred)
    return series.withColumn("trend", F.round(mean, 4)).withColumn("residual", F.round(F.col(value) - mean, 4))


def linear_trend(series: DataFrame, group: str, x: str, y: str) -> DataFrame:
    """Least-squares line of ``y`` over ``x`` per group."""
    return series.groupBy(group).agg(
        F.count(F.lit(1)).alias("points"),
        F.round(F.regr_slope(F.col(y).cast("double"), F.col(x).cast("double")), 2).alias("slope"),
        F.round(F.regr_intercept(F.col(y).cast("double"), F.col(x).cast("double")), 2).alias("intercept"),
    )


def exponential_smoothing(series: DataFrame, group: str, order: str, value: str, alpha: float = 0.3,
                          digits: int = 2) -> DataFrame:
    """Last smoothed level per group; the series has one row per period.

    A point changes the level x to a + b x, and such changes compose: a block of consecutive points is
    one change, runs of blocks are one, and no task holds a whole series.
    """
    keep, take = F.lit(1.0 - alpha), F.lit(alpha)
    points = in_blocks(series.select(group, order, F.col(value).cast("double").alias("_v")), [group], [order])
    sorted_points = F.array_sort(F.collect_list(F.struct(F.col(order), "_v")))

    def smooth(start: Column, ps: Column) -> Column:
        return F.aggregate(ps, start, lambda level, p: level * keep + p["_v"] * take)

    def rest(xs: Column) -> Column:
        return F.slice(xs, F.lit(2), F.size(xs))

    blocks = points.groupBy(group, "_block").agg(sorted_points.alias("_p")).select(
        group, "_block", F.size("_p").cast("bigint").alias("n"), smooth(F.col("_p")[0]["_v"], rest(F.col("_p"))).alias("own"),
        smooth(F.lit(0.0), F.col("_p")).alias("a"), F.pow(keep, F.size("_p")).alias("b"))

    def composed(parts: DataFrame, *keys: str) -> DataFrame:
        """``own`` begins at the first point of the parts, ``a`` and ``b`` are the change they make together."""
        first = F.col("_s")[0]
        state = F.struct(first["own"].alias("own"), first["a"].alias("a"), first["b"].alias("b"))
        after = F.aggregate(rest(F.col("_s")), state, lambda s, p: F.struct(
            (p["a"] + p["b"] * s["own"]).alias("own"), (p["a"] + p["b"] * s["a"]).alias("a"), (p["b"] * s["b"]).alias("b")))
        steps = F.array_sort(F.collect_list(F.struct("_block", "own", "a", "b")))
        return parts.groupBy(*keys).agg(F.min("_block").alias("_block"), F.sum("n").alias("n"), steps.alias("_s")).withColumn(
            "_f", after).select(*keys, "_block", "n", "_f.own", "_f.a", "_f.b")

    runs = composed(blocks.withColumn("_run", blocks_of_blocks()), group, "_run")
    return composed(runs.drop("_run"), group).select(group, F.col("n").alias("points"), F.round("own", digits).alias("smoothed"))
