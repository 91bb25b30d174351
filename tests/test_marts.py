from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import __spark_entry__ as contract
import duckdb
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tidemark import schemas as S
from tidemark.operators import anomaly, expansion, facts, forecast, health, revenue, serving, usage
from tidemark.plans.binding import Domain

AS_OF = "2024-01-31 00:00:00"
UTC = timezone.utc


def joined(spark, **overrides):
    base = dict(account_id="a", company_name="A", industry="i", plan="Starter", mrr=Decimal("299"), csm_owner="o",
                events_last_30d=1000, active_users_30d=3, open_tickets=0, critical_tickets=0, sla_compliance_rate=100.0,
                payment_status=S.GOOD_STANDING, subscription_status="active", cohort="healthy")
    base.update(overrides)
    ddl = ("account_id STRING, company_name STRING, industry STRING, plan STRING, mrr DECIMAL(10,2), csm_owner STRING, "
           "events_last_30d BIGINT, active_users_30d BIGINT, open_tickets BIGINT, critical_tickets BIGINT, "
           "sla_compliance_rate DOUBLE, payment_status STRING, subscription_status STRING, cohort STRING")
    return spark.createDataFrame([tuple(base.values())], ddl)


@pytest.mark.parametrize("overrides, score, tier", [
    ({}, 100.0, "Healthy"),
    ({"events_last_30d": 49}, 70.0, "At Risk"), ({"events_last_30d": 50}, 85.0, "Healthy"),
    ({"events_last_30d": 199}, 85.0, "Healthy"), ({"events_last_30d": 200}, 100.0, "Healthy"),
    ({"open_tickets": 5}, 75.0, "Healthy"), ({"open_tickets": 6}, 75.0, "Healthy"),
    ({"critical_tickets": 2}, 70.0, "At Risk"), ({"critical_tickets": 3}, 70.0, "At Risk"),
    ({"payment_status": S.PAYMENT_TROUBLE}, 75.0, "Healthy"),
    ({"payment_status": S.PAYMENT_TROUBLE, "open_tickets": 5}, 50.0, "At Risk"),
    ({"payment_status": S.PAYMENT_TROUBLE, "open_tickets": 9, "critical_tickets": 9, "events_last_30d": 0}, 0.0, "Critical"),
    ({"subscription_status": "past_due"}, 80.0, "Healthy"), ({"subscription_status": None}, 100.0, "Healthy"),
])
def test_health_score(spark, overrides, score, tier):
    row = health.score_health(joined(spark, **overrides), AS_OF).first()
    assert (row.health_score, row.health_tier) == (score, tier)
    assert row.churn_risk_score == max(0.02, round((100 - score) / 100, 3))


def test_bare_account_and_two_subscriptions(spark):
    accounts = facts.dim_account(spark.createDataFrame(
        [("bare", "B", "i", "1-50", "EMEA", "o", None, None), ("two", "T", "i", "1-50", "EMEA", "o", None, "churn_risk")],
        S.BRONZE["accounts"]))
    t = lambda d: datetime(2024, 1, d, tzinfo=UTC)
    subs = facts.fact_subscription(spark.createDataFrame(
        [("s1", "two", "Starter", t(1), "past_due", Decimal("299")), ("s2", "two", "Enterprise", t(5), "active", Decimal("3499"))],
        S.BRONZE["subscriptions"]))
    empty = lambda name: spark.createDataFrame([], S.struct(S.WAREHOUSE[name]))
    mart = health.customer_health(accounts, subs, empty("fact_usage"), empty("fact_support"), empty("fact_billing"), AS_OF)
    got = {r.account_id: r for r in mart.collect()}
    assert len(got) == 2
    assert (got["bare"].health_score, got["bare"].payment_status, got["bare"].sla_compliance_rate) == (70.0, S.GOOD_STANDING, 100.0)
    assert (got["two"].plan, got["two"].health_score, got["two"].anomaly_detected) == ("Enterprise", 70.0, True)


def test_recency_boundary_and_users(spark, rows):
    cutoff = datetime(2024, 1, 1, tzinfo=UTC)
    df = spark.createDataFrame(
        [("e1", "a", "u", "f", cutoff, None), ("e2", "a", "u", "f", cutoff - timedelta(microseconds=1), None),
         ("e3", "a", None, "f", cutoff + timedelta(days=1), None)], S.WAREHOUSE["fact_usage"])
    assert rows(usage.trailing_usage(df, AS_OF)) == [("a", 2, 1)]


def daily(spark, counts, account="a", start=date(2024, 1, 1), gaps=()):
    days = [start + timedelta(days=i) for i in range(len(counts) + len(gaps)) if i not in gaps]
    return spark.createDataFrame([(account, d, n) for d, n in zip(days, counts)],
                                 "account_id STRING, event_date DATE, daily_events BIGINT")


@pytest.mark.parametrize("counts, kind, severity", [
    ([10] * 14, None, None),                                # too little history
    ([10] * 15, "normal", None),
    ([10] * 14 + [36], "Usage Spike", "medium"),            # constant baseline: z = 2.6
    ([10] * 14 + [35], "normal", None),                     # z = 2.5 is not above the limit
    ([10] * 14 + [41], "Usage Spike", "high"),
    ([9, 11] * 7 + [7], "Severe Usage Drop", "medium"),     # z = -3 is not below -3
    ([9, 11] * 7 + [6], "Severe Usage Drop", "high"),
    ([9, 11] * 7 + [12], "normal", None),
    ([20] * 8 + [7] * 7, "Severe Usage Drop", "medium"),    # week over week exactly -0.65
    ([20] * 8 + [7] * 6 + [8], "normal", None),
])
def test_anomalies(spark, counts, kind, severity):
    found = anomaly.usage_anomalies(daily(spark, counts), keep_normal=True).collect()
    if kind is None:
        assert found == []
    else:
        assert (found[0].anomaly_type or "normal", found[0].severity) == (kind, severity)


def test_anomaly_of_very_large_counts(spark):
    row = anomaly.usage_anomalies(daily(spark, [9 * 10**10, 11 * 10**10] * 7 + [6 * 10**10])).first()
    assert (row.z_score, row.historical_std, row.severity) == (-4.0, 1e10, "high")


def test_gap_days(spark):
    counts = [10] * 15
    assert anomaly.usage_anomalies(daily(spark, counts, gaps=(5,)), keep_normal=True).first().historical_std == 0.0
    filled = anomaly.usage_anomalies(daily(spark, counts, gaps=(5,)), calendar=True, keep_normal=True).first()
    assert filled.historical_mean == round(130 / 14, 2)


def plan_health(spark, **overrides):
    return health.score_health(joined(spark, **overrides), AS_OF)


def test_expansion_boundaries(spark):
    plans = spark.createDataFrame([("Starter", Decimal("1"), 0, 0), ("Odd", Decimal("1"), 10, 10000)], S.WAREHOUSE["dim_plan"])
    full = expansion.expansion_scores(plan_health(spark), plans).first()
    assert (full.expansion_score, full.opportunity_tier, full.recommended_plan) == (0.99, "High", "Professional")
    assert full.potential_mrr_expansion == 239.2
    odd = expansion.expansion_scores(plan_health(spark, plan="Odd", active_users_30d=5, events_last_30d=0), plans).first()
    # 0.4 * 0.5 + 0.25 * 0.70 = 0.375
    assert (odd.expansion_score, odd.opportunity_tier, odd.recommended_plan) == (0.375, "Low", "Enterprise")
    mid = expansion.expansion_scores(plan_health(spark, plan="Odd", active_users_30d=5, events_last_30d=200), plans).first()
    # 0.4 * 0.5 + 0.35 * 0.2 + 0.25 = 0.52
    assert (mid.expansion_score, mid.opportunity_tier, mid.event_utilization) == (0.52, "Moderate", 20.0)
    assert expansion.expansion_scores(plan_health(spark, plan="None such"), plans).count() == 0


def summary(spark, mrr="1000", churn=3.07, growth=0.0):
    row = (1, Decimal(mrr), Decimal("0"), Decimal("0"), Decimal("0"), 1, 0, 100.0, 0.0, churn, growth,
           datetime(2024, 1, 1, tzinfo=UTC))
    return spark.createDataFrame([row], S.WAREHOUSE["mrt_revenue_summary"])


def test_forecast(spark):
    base = forecast.revenue_forecast(summary(spark, "151553.00"), 12).where("month_index = 12").first()
    assert base.mrr_base == 146900.32 and base.period == "Month +12"
    rates = {r.scenario: round(r.annual_growth, 4) for r in forecast.forecast_scenarios(summary(spark)).collect()}
    assert rates == {"base": -0.0307, "bull": -0.0107, "bear": -0.0507}
    lost = forecast.revenue_forecast(summary(spark, churn=100.0), 1).first()
    assert lost.mrr_base == 0.0 and lost.mrr_bear == 0.0 and lost.mrr_bull > 0
    assert forecast.served_forecast(summary(spark), 24).count() == 24
    for bad in (0, -1):
        with pytest.raises(ValueError):
            forecast.revenue_forecast(summary(spark), bad)
    with pytest.raises(ValueError):
        forecast.served_forecast(summary(spark), 25)


def test_empty_revenue(spark):
    empty = lambda name: spark.createDataFrame([], S.struct(S.WAREHOUSE[name]))
    row = revenue.revenue_summary(empty("dim_account"), empty("fact_subscription"), empty("fact_billing"), AS_OF).first()
    assert (row.total_mrr, row.net_retention_rate, row.logo_churn_rate, row.revenue_churn_rate) == (0, 0.0, 0.0, 0.0)


def test_movements_add_up(spark):
    paid = spark.createDataFrame([("a", 1, Decimal("10")), ("a", 2, Decimal("15")), ("a", 4, Decimal("5")), ("b", 2, Decimal("7")),
                                  ("b", 3, Decimal("4")), ("b", 4, Decimal("4"))], "account_id STRING, period INT, amount DECIMAL(18,2)")
    moves = revenue.revenue_movements(paid, "period", "amount")
    classes = {(r.account_id, r.period): r.change_type for r in moves.collect()}
    assert classes == {("a", 1): "opening", ("a", 2): "expansion", ("a", 3): "churn", ("a", 4): "new",
                       ("b", 1): "opening", ("b", 2): "new", ("b", 3): "contraction", ("b", 4): "unchanged"}
    broken = moves.where("beginning_mrr + new_mrr + expansion_mrr - contraction_mrr - churn_mrr <> ending_mrr "
                         "OR net_new_mrr <> new_mrr + expansion_mrr - contraction_mrr - churn_mrr")
    assert broken.count() == 0


def test_sessions_split_at_the_gap(spark, rows):
    t = datetime(2024, 1, 1, tzinfo=UTC)
    at = [t, t + timedelta(minutes=59, seconds=59), t + timedelta(hours=1, minutes=59, seconds=59)]
    df = spark.createDataFrame([(f"e{i}", "a", "u", "f", x, None) for i, x in enumerate(at)], S.WAREHOUSE["fact_usage"])
    assert rows(usage.sessions(df), "session_no", "event_count") == [(1, 2), (2, 1)]


def test_rolling_users_against_brute_force(spark):
    import random

    rng = random.Random(5)
    seen = {(rng.randrange(6), rng.randrange(40)) for _ in range(60)}
    df = spark.createDataFrame(
        [("e", "a", str(u), "f", None, date(2024, 1, 1) + timedelta(days=d)) for u, d in seen], S.WAREHOUSE["fact_usage"])
    for width in (1, 3, 30):
        got = {r.event_date: (r.dau, r.mau) for r in usage.dau_mau(df, width).collect()}
        for day in {d for _, d in seen}:
            expected = (len({u for u, d in seen if d == day}), len({u for u, d in seen if day - width < d <= day}))
            assert got[date(2024, 1, 1) + timedelta(days=day)] == expected


def test_serving_arguments(spark):
    frame = spark.createDataFrame([], S.struct(S.WAREHOUSE["fact_usage"]))
    for bad in (0, 101):
        with pytest.raises(ValueError):
            serving.recent_events(frame, bad)
    mart = plan_health(spark)
    assert serving.health_distribution_map(mart).first()[0] == {"Healthy": 1, "At Risk": 0, "Critical": 0}
    assert serving.account_health_lookup(mart, "nobody").count() == 0
    assert serving.customer_search(mart, "A").count() == 1 and serving.customer_search(mart, "a", "Critical").count() == 0


def test_anomaly_flag_from_detection(spark):
    mart = plan_health(spark, cohort="churn_risk")
    found = spark.createDataFrame([], "account_id STRING, anomaly_type STRING")
    assert mart.first().anomaly_detected and not health.flag_anomalies(mart, found).first().anomaly_detected


@pytest.mark.parametrize("last, mrr", [(datetime(2003, 12, 31), 121.0), (datetime(2003, 8, 1), 125.0)])
def test_forecast_starts_from_the_last_complete_year(spark, tmp_path, last, mrr):
    paid = [(datetime(2001, 3, 1), 80.0), (datetime(2002, 3, 1), 100.0), (last, 110.0)]
    orders = [(i, 7, amount, at) for i, (at, amount) in enumerate(paid)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp").write.parquet(f"{tmp_path}/orders.parquet")
    got = contract.queries()["forecast_from_movements"](spark, str(tmp_path)).where("scenario = 'base'").collect()
    assert [r.mrr for r in got] == [mrr]


def test_health_drops_over_the_whole_table(spark):
    d = Domain(spark, SF)
    drops = health.health_drops(health.health_daily(d.order_usage, d.support, d.standing))
    sql = contract.oracle_sql()["rule_health_drop_wow"].replace("1998-01-01", "1995-01-01").replace("1998-03-31", "2001-08-01")
    duck = duckdb.connect()
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    want = duck.execute(sql)
    columns = [c[0] for c in want.description]
    got = drops.withColumn("date_key", F.date_format("date_key", "yyyy-MM-dd")).select(*columns).collect()
    assert sorted(tuple(r) for r in got) == sorted(want.fetchall())
    assert any(r.date_key < "1998" for r in got) and any(r.date_key > "1998-03-31" for r in got)


def _days(runs):
    """Runs of days as a row a day."""
    return runs.withColumn("date_key", F.explode(F.sequence("date_key", F.date_sub("until", 1))))


def test_health_runs_equal_the_days(spark, rows):
    import random

    rng, day0 = random.Random(7), date(2024, 1, 1)
    owners = ["a", "b", "c", None, "stray"]
    used = [(rng.choice(owners), "u", day0 + timedelta(days=rng.randrange(60))) for _ in range(250)] + [("stray", "u", day0)] * 220
    used += [("b", "u", day0 + timedelta(days=1))] * 220
    usage = spark.createDataFrame(used, "account_id STRING, user_id STRING, event_date DATE")
    at = lambda n: datetime(2024, 1, 1, tzinfo=UTC) + timedelta(days=n)
    tickets = [(f"t{i}", rng.choice(owners), rng.choice(["critical", "low"]), at(rng.randrange(-5, 50)), rng.choice([None, at(rng.randrange(50, 70))]))
               for i in range(60)]
    support = spark.createDataFrame(tickets, "ticket_id STRING, account_id STRING, severity STRING, created_at TIMESTAMP, resolved_at TIMESTAMP")
    now = spark.createDataFrame([("a", "Failed / Overdue", None), ("b", "Good Standing", "past_due"), ("c", "Good Standing", None), (None, "Good Standing", None)],
                                "account_id STRING, payment_status STRING, subscription_status STRING")
    dated = spark.createDataFrame([("a", "Good Standing", None, day0, day0 + timedelta(days=20)), ("a", "Failed / Overdue", None, day0 + timedelta(days=20), None),
                                   ("b", "Good Standing", "past_due", day0 + timedelta(days=30), None)],
                                  "account_id STRING, payment_status STRING, subscription_status STRING, valid_from DATE, valid_to DATE")
    for standing in (now, dated):
        daily, runs = (health.health_daily(usage, support, standing, runs=r) for r in (False, True))
        columns = ("account_id", "date_key", "open_tickets_count", "unresolved_p1_tickets", "payment_status", "health_score")
        assert rows(_days(runs), *columns) == rows(daily, *columns)
        drops = rows(health.health_drops(daily))
        assert drops and rows(health.health_drops(runs)) == drops
        summed = daily.groupBy("date_key", "payment_status").agg(
            F.count(F.lit(1)).alias("accounts"), F.sum("open_tickets_count").alias("tickets"))
        totals = health.totals_by_day(runs, "payment_status", {"tickets": F.col("open_tickets_count")})
        assert rows(totals, "date_key", "payment_status", "accounts", "tickets") == rows(summed, "date_key", "payment_status", "accounts", "tickets")


def test_health_runs_grow_with_the_changes_not_with_the_days(spark):
    d = Domain(spark, SF)
    runs = health.health_daily(d.order_usage, d.support, d.standing, runs=True)
    days = runs.select(F.sum(F.date_diff("until", "date_key")).alias("days"), F.count(F.lit(1)).alias("runs")).first()
    span = d.order_usage.agg(F.date_diff(F.max("event_date"), F.min("event_date"))).first()[0] + 1
    assert days.days == d.accounts.count() * span
    assert days.runs < days.days / 10
