"""Running totals and trailing distinct counts that stay spread over tasks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_totals(df: DataFrame, order: str, totals: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Add ``cum_<c>``: the sum of ``c`` over rows with ``order`` strictly above.

    ``df`` has one row per non-null ``order`` value.  Rows are cut into value ranges at
    approximate quantiles, each range is accumulated on its own, and the totals
    of the ranges above are added.  The cut points only balance the work; the
    result is exact wherever they fall.  By default there are as many ranges as
    the session has shuffle partitions, which follow the size of the job.
    """
    buckets = buckets or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    steps = [i / buckets for i in range(1, buckets)]
    cuts = df.agg(F.percentile_approx(order, steps, 1000)).scalar()
    value = F.col(order)
    # Place of the value among the cut points, so it grows with the value.
    ranged = df.withColumn("_range", F.array_position(F.sort_array(F.array_append(cuts, value)), value))
    per_range = ranged.groupBy("_range").agg(*[F.sum(c).alias(f"_sum_{c}") for c in totals])
    above = Window.orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    # At most ``buckets`` rows, hence the unpartitioned window.
    offsets = per_range.select(
        "_range", *[F.coalesce(F.sum(f"_sum_{c}").over(above), F.lit(0)).alias(f"_off_{c}") for c in totals]
    )
    inside = Window.partitionBy("_range").orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.join(F.broadcast(offsets), "_range")
        .select(
            *df.columns,
            *[(F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"_off_{c}")).alias(f"cum_{c}") for c in totals],
        )
    )


def presence_changes(seen: DataFrame, groups: Sequence[str], member: str, slot: str,
                     widths: Mapping[str, int]) -> DataFrame:
    """Changes of the number of members present in trailing windows.

    ``seen`` has integer ``slot`` numbers.  A member counts in a window of
    ``width`` slots from each appearance until ``width`` slots after it, so its
    appearances are merged into intervals, +1 where one opens and -1 where it
    closes: at most ``1 + len(widths)`` rows per appearance, whatever the widths.
    Summing a column of the result over ``(groups, slot)`` and accumulating over
    the slots gives the distinct members of each trailing window;
    ``members`` sums to the distinct members of the slot itself.
    """
    keys = [*groups, member, slot]
    once = seen.select(*keys).where(F.col(member).isNotNull() & F.col(slot).isNotNull()).distinct()
    by_member = Window.partitionBy(*groups, member).orderBy(slot)
    here = F.col(slot)
    gapped = once.withColumn("_since", here - F.lag(slot).over(by_member)).withColumn(
        "_until", F.lead(slot).over(by_member) - here)

    def opens(width: int):
        return F.when(F.col("_since").isNull() | (F.col("_since") > width), 1).otherwise(0)

    def closes(width: int):
        return F.when(F.col("_until").isNull() | (F.col("_until") > width), -1).otherwise(0)

    def change(at, members: int, values: Mapping) -> Column:
        return F.struct(at.alias("at"), F.lit(members).alias("members"), *[v.alias(n) for n, v in values.items()])

    zero = F.lit(0)
    rows = [change(here, 1, {n: opens(w) for n, w in widths.items()})]
    for name, width in widths.items():
        rows.append(change(here + width, 0, {n: closes(width) if n == name else zero for n in widths}))
    return gapped.select(*groups, F.explode(F.array(*rows)).alias("_c")).select(
        *groups, F.col("_c.at").alias(slot), *[F.col(f"_c.{n}").alias(n) for n in ("members", *widths)],
    ).where(F.greatest("members", *[F.abs(F.col(n)) for n in widths]) > 0)
