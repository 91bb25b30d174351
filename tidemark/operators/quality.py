"""Data-quality checks; each returns one row per check."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import columns as C

RESULT = ("test_name", "category", "passed", "failed_count", "details", "error")
RESULT_DDL = "test_name string, category string, passed boolean, failed_count bigint, details string, error string"


def _result(counted: DataFrame, name: str, category: str, details: Column | str) -> DataFrame:
    """``counted`` is one row with the number of offending items in ``n``."""
    text = F.lit(details) if isinstance(details, str) else details
    return counted.select(
        F.lit(name).alias("test_name"), F.lit(category).alias("category"), (F.col("n") == 0).alias("passed"),
        F.col("n").cast("bigint").alias("failed_count"), text.alias("details"),
        F.lit(None).cast("string").alias("error"))


def unique(df: DataFrame, key: str, name: str, details: str) -> DataFrame:
    """Counts the keys that occur more than once."""
    repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    return _result(repeated.agg(F.count(F.lit(1)).alias("n")), name, "Uniqueness", details)


def not_null(df: DataFrame, columns: Sequence[str], name: str, details: str) -> DataFrame:
    bad = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    return _result(df.agg(F.count_if(bad).alias("n")), name, "Completeness", details)


def references(df: DataFrame, key: str, parent: DataFrame, parent_key: str, name: str, details: str) -> DataFrame:
    """Counts rows without a parent; keys are grouped before the join."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    orphans = per_key.join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")
    return _result(orphans.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")), name, "Referential Integrity", details)


def in_range(df: DataFrame, violation: Column, name: str, details: str) -> DataFrame:
    return _result(df.agg(F.count_if(violation).alias("n")), name, "Business Rules", details)


def min_rows(df: DataFrame, more_than: int, name: str, subject: str = "Fact usage table") -> DataFrame:
    counted = df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.when(F.col("rows") > more_than, 0).otherwise(1).alias("n"),
        F.concat(F.lit(f"{subject} contains "), F.col("rows"), F.lit(f" events (target > {more_than})")).alias("d"))
    return _result(counted, name, "Volume", F.col("d"))


def accepted_values(df: DataFrame, column: str, values: Sequence[str], name: str) -> DataFrame:
    bad = F.col(column).isNull() | ~F.col(column).isin(*values)
    return _result(df.agg(F.count_if(bad).alias("n")), name, "Accepted Values",
                   f"Ensures {column} is one of: {', '.join(values)}")


# ------------------------------------------------------------------ monitors

def freshness_minutes(df: DataFrame, time: str, as_of) -> DataFrame:
    newest = F.max(time)
    minutes = (F.unix_micros(C.as_timestamp(as_of)) - F.unix_micros(newest)) / F.lit(6e7)
    return df.agg(newest.alias("newest"), F.round(minutes, 2).alias("minutes_since_newest"))


def null_percentages(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column, from one scan."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows")) for c in columns]))
    return counts.select("_rows", pairs.alias("p")).select(
        F.col("p.column_name").alias("column_name"), F.col("p.null_rows").alias("null_rows"),
        F.col("_rows").alias("total_rows"), C.percent(F.col("p.null_rows"), F.col("_rows")).alias("null_pct"))


def row_variance(counts: DataFrame, order: str, previous: str = "rows") -> DataFrame:
    """Change of each run's row count against the run before; one row per run."""
    before = F.lag(previous).over(Window.orderBy(order))  # a run log: one small row per run
    return counts.withColumn("previous_rows", before).withColumn(
        "change_pct", C.percent(F.col(previous) - F.col("previous_rows"), F.col("previous_rows"), default=None))


# -------------------------------------------------------------------- report

def standard_checks(accounts: DataFrame, users: DataFrame, usage: DataFrame,
                    health: DataFrame) -> list[tuple[str, str, Callable[[], DataFrame]]]:
    score, mrr = F.col("health_score"), F.col("mrr")
    return [
        ("dim_account_uniqueness", "Uniqueness", lambda: unique(
            accounts, "account_id", "dim_account_uniqueness", "Ensures no duplicate account_id in dim_account")),
        ("fact_usage_uniqueness", "Uniqueness", lambda: unique(
            usage, "usage_id", "fact_usage_uniqueness", "Ensures no duplicate usage_id in fact_usage")),
        ("mrt_customer_health_not_null", "Completeness", lambda: not_null(
            health, ["health_score", "company_name", "mrr"], "mrt_customer_health_not_null",
            "Ensures critical columns in mrt_customer_health are not null")),
        ("dim_user_account_referential_integrity", "Referential Integrity", lambda: references(
            users, "account_id", accounts, "account_id", "dim_user_account_referential_integrity",
            "Ensures all users belong to valid existing accounts")),
        ("health_score_and_mrr_range", "Business Rules", lambda: in_range(
            health, (score < 0) | (score > 100) | (mrr < 0), "health_score_and_mrr_range",
            "Health score must be between 0 and 100, MRR >= 0")),
        ("telemetry_volume_threshold", "Volume", lambda: min_rows(usage, 1000, "telemetry_volume_threshold")),
    ]


Pass = tuple[list[tuple[str, str]], Callable[[], DataFrame]]


def _split(counted: DataFrame, checks: Sequence[tuple[str, str, str, Column]]) -> DataFrame:
    """Result rows from one row of counts: (name, category, column of the count, details)."""
    rows = F.array(*[F.struct(
        F.lit(name).alias("test_name"), F.lit(category).alias("category"), (F.col(n) == 0).alias("passed"),
        F.col(n).cast("bigint").alias("failed_count"), details.alias("details"), F.lit(None).cast("string").alias("error"))
        for name, category, n, details in checks])
    return counted.select(F.explode(rows).alias("r")).select("r.*")


def standard_passes(accounts: DataFrame, users: DataFrame, usage: DataFrame, health: DataFrame, more_than: int = 1000) -> list[Pass]:
    """The standard checks as passes over their tables: each table is read once, whatever is checked on it."""
    score, mrr = F.col("health_score"), F.col("mrr")
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in ("health_score", "company_name", "mrr")])

    def of_accounts() -> DataFrame:
        known = accounts.groupBy("account_id").agg(F.count(F.lit(1)).alias("copies"))
        used = users.groupBy("account_id").agg(F.count(F.lit(1)).alias("rows"))
        both = known.join(used, known["account_id"].eqNullSafe(used["account_id"]) & used["account_id"].isNotNull(), "full_outer")
        counted = both.agg(F.count_if(F.col("copies") > 1).alias("repeated"),
                           F.coalesce(F.sum(F.when(F.col("copies").isNull(), F.col("rows"))), F.lit(0)).alias("orphans"))
        return _split(counted, [
            ("dim_account_uniqueness", "Uniqueness", "repeated", F.lit("Ensures no duplicate account_id in dim_account")),
            ("dim_user_account_referential_integrity", "Referential Integrity", "orphans", F.lit("Ensures all users belong to valid existing accounts"))])

    def of_usage() -> DataFrame:
        per_key = usage.groupBy("usage_id").agg(F.count(F.lit(1)).alias("copies"))
        counted = per_key.agg(F.count_if(F.col("copies") > 1).alias("repeated"), F.coalesce(F.sum("copies"), F.lit(0)).alias("rows")).withColumn(
            "short", F.when(F.col("rows") > more_than, 0).otherwise(1))
        return _split(counted, [
            ("fact_usage_uniqueness", "Uniqueness", "repeated", F.lit("Ensures no duplicate usage_id in fact_usage")),
            ("telemetry_volume_threshold", "Volume", "short", F.concat(
                F.lit("Fact usage table contains "), F.col("rows").cast("string"), F.lit(f" events (target > {more_than})")))])

    def of_health() -> DataFrame:
        counted = health.agg(F.count_if(missing).alias("missing"), F.count_if((score < 0) | (score > 100) | (mrr < 0)).alias("outside"))
        return _split(counted, [
            ("mrt_customer_health_not_null", "Completeness", "missing", F.lit("Ensures critical columns in mrt_customer_health are not null")),
            ("health_score_and_mrr_range", "Business Rules", "outside", F.lit("Health score must be between 0 and 100, MRR >= 0"))])

    return [
        ([("dim_account_uniqueness", "Uniqueness"), ("dim_user_account_referential_integrity", "Referential Integrity")], of_accounts),
        ([("fact_usage_uniqueness", "Uniqueness"), ("telemetry_volume_threshold", "Volume")], of_usage),
        ([("mrt_customer_health_not_null", "Completeness"), ("health_score_and_mrr_range", "Business Rules")], of_health)]


def pass_results(passes: Iterable[Pass]) -> DataFrame:
    """All check rows of the passes as one lazy frame."""
    return reduce(DataFrame.unionByName, [build() for _, build in passes])


def run_passes(spark: SparkSession, passes: Iterable[Pass]) -> DataFrame:
    """Run each pass by itself; the checks of one that raises are recorded as failed."""
    rows = []
    for checks, build in passes:
        try:
            rows += [tuple(r) for r in build().select(*RESULT).collect()]  # a row a check
        except Exception as problem:  # noqa: BLE001 - any failure is a check result
            rows += [(name, category, False, None, None, str(problem)) for name, category in checks]
    return spark.createDataFrame(rows, RESULT_DDL)


def check_results(checks: Iterable[tuple[str, str, Callable[[], DataFrame]]]) -> DataFrame:
    """All check rows as one lazy frame."""
    return reduce(DataFrame.unionByName, [build() for _, _, build in checks])


def run_checks(spark: SparkSession, checks: Iterable[tuple[str, str, Callable[[], DataFrame]]]) -> DataFrame:
    """Run each check by itself; one that raises is recorded as failed.

    Only the one-row results reach the driver.
    """
    rows = []
    for name, category, build in checks:
        try:
            rows.append(tuple(build().select(*RESULT).first()))
        except Exception as problem:  # noqa: BLE001 - any failure is a check result
            rows.append((name, category, False, None, None, str(problem)))
    return spark.createDataFrame(rows, RESULT_DDL)


def report(results: DataFrame, executed_at) -> DataFrame:
    total, passed = F.col("total_checks"), F.col("passed_checks")
    return results.agg(
        F.count(F.lit(1)).alias("total_checks"), F.count_if("passed").alias("passed_checks"),
    ).select(
        F.when(total == passed, "PASSED").otherwise("WARNING").alias("status"), total, passed,
        (total - passed).alias("failed_checks"), C.as_timestamp(executed_at).alias("executed_at"))
