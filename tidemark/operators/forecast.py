"""Recurring-revenue projections under three growth scenarios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import columns as C

# Scenario, shift of the annual growth, label.
SCENARIOS = (
    ("base", 0.0, "Base Case (Current Warehouse Trend)"),
    ("bull", 0.02, "Bull Case (Improved Growth)"),
    ("bear", -0.02, "Bear Case (Higher Pressure)"),
)
MAX_SERVED_MONTHS = 24


def latest_revenue(summaries: DataFrame) -> DataFrame:
    return summaries.orderBy(F.col("calculated_at").desc(), F.col("id").desc()).limit(1)


def forecast_scenarios(summaries: DataFrame) -> DataFrame:
    """Starting revenue and growth rates per scenario, from the latest summary."""
    growth = (F.coalesce("expansion_rate", F.lit(0.0)) - F.coalesce("revenue_churn_rate", F.lit(0.0))) / 100.0
    options = F.array(*[
        F.struct(F.lit(name).alias("scenario"), F.lit(shift).alias("shift"), F.lit(label).alias("label"))
        for name, shift, label in SCENARIOS
    ])
    return (
        latest_revenue(summaries)
        .select(F.coalesce(F.col("total_mrr").cast("double"), F.lit(0.0)).alias("starting_mrr"),
                growth.alias("_growth"), F.explode(options).alias("o"))
        .select(F.col("o.scenario").alias("scenario"), F.col("o.label").alias("label"), "starting_mrr",
                (F.col("starting_mrr") * 12.0).alias("starting_arr"),
                (F.col("_growth") + F.col("o.shift")).alias("annual_growth"))
        .withColumn("monthly_growth", C.annual_to_monthly(F.col("annual_growth")))
    )


def summary_from_movements(movements: DataFrame, last_day: Column | None = None) -> DataFrame:
    """Revenue summary of the latest period, with the churn and expansion that
    were observed, as input of the forecast.

    With ``last_day``, the newest day of the payments, periods are years and the
    latest is the last that is over by then: revenue of a part of a year against
    a whole one would count as contraction and churn.
    """
    if last_day is not None:
        movements = movements.where(F.col("period") < F.year(F.date_add(last_day, 1)))
    totals = movements.where(F.col("change_type") != "opening").groupBy("period").agg(
        *[F.sum(f"{c}_mrr").alias(c) for c in ("beginning", "expansion", "churn", "ending")])
    return totals.orderBy(F.col("period").desc()).limit(1).select(
        F.col("period").alias("id"), F.col("ending").alias("total_mrr"),
        C.percent(F.col("churn"), F.col("beginning")).alias("revenue_churn_rate"),
        C.percent(F.col("expansion"), F.col("beginning")).alias("expansion_rate"),
        F.col("period").alias("calculated_at"),
    )


def project_long(scenarios: DataFrame, horizon_months: int) -> DataFrame:
    """One row per scenario and month."""
    if horizon_months <= 0:
        raise ValueError("horizon_months must be greater than 0")
    months = scenarios.withColumn("month_index", F.explode(F.sequence(F.lit(1), F.lit(horizon_months))))
    mrr = F.col("starting_mrr") * F.pow(1.0 + F.col("monthly_growth"), F.col("month_index"))
    return months.select(
        "scenario", "month_index", F.concat(F.lit("Month +"), F.col("month_index")).alias("period"),
        F.round(mrr, 2).alias("mrr"), F.round(mrr * 12.0, 2).alias("arr"),
    )


def revenue_forecast(summaries: DataFrame, horizon_months: int = 12) -> DataFrame:
    """One row per month with MRR and ARR columns for every scenario."""
    long = project_long(forecast_scenarios(summaries), horizon_months)
    picks = []
    for name, _, _ in SCENARIOS:
        chosen = F.col("scenario") == name
        picks += [F.max(F.when(chosen, F.col("mrr"))).alias(f"mrr_{name}"),
                  F.max(F.when(chosen, F.col("arr"))).alias(f"arr_{name}")]
    return long.groupBy("period", "month_index").agg(*picks).orderBy("month_index")


def served_forecast(summaries: DataFrame, months: int = 12) -> DataFrame:
    """The forecast with the horizon limits of the published query."""
    if not 1 <= months <= MAX_SERVED_MONTHS:
        raise ValueError(f"months must be between 1 and {MAX_SERVED_MONTHS}")
    return revenue_forecast(summaries, months)


def forecast_at_month(summaries: DataFrame, month: int = 12) -> DataFrame:
    return project_long(forecast_scenarios(summaries), month).where(F.col("month_index") == month)
