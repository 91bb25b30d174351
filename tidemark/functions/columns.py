"""Small column expressions; each takes and returns ``Column``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import schemas as S


def as_timestamp(value) -> Column:
    """Literal instant from an ISO string, a datetime or a Column."""
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def clamp(value: Column, low: float, high: float) -> Column:
    """Bound ``value``; null stays null (least/greatest alone would skip it)."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def ratio(numerator: Column, denominator: Column, default: float | None = None) -> Column:
    """Division as double; a zero or null denominator gives ``default``."""
    safe = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return safe if default is None else F.coalesce(safe, F.lit(default))


def percent(numerator: Column, denominator: Column, digits: int = 2, default: float | None = 0.0) -> Column:
    return F.round(ratio(numerator, denominator, None) * 100.0, digits) if default is None else F.coalesce(
        F.round(ratio(numerator, denominator) * 100.0, digits), F.lit(default)
    )


def lookup(key: Column, table: Mapping, default) -> Column:
    """Dictionary lookup with a default, as a CASE chain."""
    items = iter(table.items())
    first_key, first_value = next(items)
    expr = F.when(key == F.lit(first_key), F.lit(first_value))
    for k, v in items:
        expr = expr.when(key == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default))


def hours_between(start: Column, end: Column) -> Column:
    """Fractional hours from ``start`` to ``end`` with microsecond precision."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(3.6e9)


def slot_start(micros: Column, width: int) -> Column:
    """Start of the ``width``-microsecond slot an instant falls in."""
    return micros - F.pmod(micros, F.lit(width))


def sla_limit_hours(severity: Column) -> Column:
    return lookup(F.lower(severity), S.SLA_HOURS, S.DEFAULT_SLA_HOURS)


def health_tier(score: Column) -> Column:
    return (
        F.when(score >= S.HEALTHY_FROM, F.lit("Healthy"))
        .when(score >= S.AT_RISK_FROM, F.lit("At Risk"))
        .otherwise(F.lit("Critical"))
    )


def health_score(
    events_30d: Column, open_tickets: Column, critical_tickets: Column,
    payment_status: Column, subscription_status: Column,
) -> Column:
    """Unrounded 0..100 customer health."""
    usage = F.when(events_30d < 50, 30.0).when(events_30d < 200, 15.0).otherwise(0.0)
    tickets = F.least(F.lit(25.0), open_tickets * 5.0) + F.least(F.lit(30.0), critical_tickets * 15.0)
    payment = F.when(payment_status != S.GOOD_STANDING, 25.0).otherwise(0.0)
    standing = F.when(subscription_status == "past_due", 20.0).otherwise(0.0)
    return clamp(F.lit(100.0) - usage - tickets - payment - standing, 0.0, 100.0)


def money_text(amount: Column) -> Column:
    """``$7,499.00`` style text."""
    return F.concat(F.lit("$"), F.format_number(amount, 2))


def plain_money_text(amount: Column) -> Column:
    """Amount with two decimals and no grouping, ``$7499.00``."""
    return F.concat(F.lit("$"), amount.cast("decimal(18,2)").cast("string"))


def annual_to_monthly(annual_rate: Column) -> Column:
    """Compound monthly rate of an annual rate; a loss of all or more gives -1."""
    return F.when(annual_rate <= -1.0, F.lit(-1.0)).otherwise(
        F.pow(F.lit(1.0) + annual_rate, F.lit(1.0 / 12.0)) - 1.0
    )


def blank_to_null(value: Column) -> Column:
    return F.nullif(F.trim(value), F.lit(""))


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def email_domain(email: Column) -> Column:
    return F.lower(F.substring_index(email, "@", -1))


def event_hash(event_id: Column, account_id: Column, feature: Column, timestamp: Column) -> Column:
    """Idempotency key of a stream event; an absent part counts as empty text."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (event_id, account_id, feature, timestamp)]
    return F.sha2(F.concat(parts[0], F.lit(":"), parts[1], F.lit(":"), parts[2], F.lit(":"), parts[3]), 256)


def iso_text(ts: Column) -> Column:
    """UTC instant as ISO-8601 text with microseconds and offset."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def first_missing(fields: Sequence[str]) -> Column:
    """Name of the first null field, in the given order; null when all are set."""
    return F.coalesce(*[F.when(F.col(f).isNull(), F.lit(f)) for f in fields])
