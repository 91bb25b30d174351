"""Key-based row selection, foreign-key filters and upserts.

All of them stay balanced when one key holds a large part of the rows: the
deduplication filters ``row_number() = 1``, which Spark also applies before the
shuffle (WindowGroupLimit), so each map task sends one row per key; the
foreign-key joins can spread a hot key over ``salts`` sub-keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_SALTS = 8


def _pick_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in ``order`` (give a total order); null keys form one group."""
    return _pick_one(df, keys, [F.col(c).asc_nulls_last() for c in order])


def keep_latest(df: DataFrame, keys: Sequence[str], version: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """Row with the greatest ``version`` per key."""
    order = [F.col(version).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie_break]]
    return _pick_one(df, keys, order)


def as_of_version(df: DataFrame, keys: Sequence[str], recorded_at: str, as_of, tie_break: Sequence[str] = ()) -> DataFrame:
    """The store as known at ``as_of``: latest version per key recorded by then."""
    known = df.where(F.col(recorded_at) <= F.lit(as_of).cast("timestamp"))
    return keep_latest(known, keys, recorded_at, tie_break)


def _spread_join(rows: DataFrame, reference: DataFrame, key: str, how: str,
                 spread_by: Sequence[str] | None, salts: int) -> DataFrame:
    """Join on ``key``; with ``spread_by`` on (key, salt), the reference repeated per salt."""
    if not spread_by or salts <= 1:
        return rows.join(reference, key, how)
    salted_reference = reference.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted_rows = rows.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    added = [c for c in reference.columns if c != key] if how in ("inner", "left") else []
    return salted_rows.join(salted_reference, [key, "_salt"], how).select(*rows.columns, *added)


def with_known_key(rows: DataFrame, reference: DataFrame, key: str, ref_key: str | None = None,
                   spread_by: Sequence[str] | None = None, salts: int = DEFAULT_SALTS) -> DataFrame:
    """Rows whose ``key`` exists in ``reference``; null keys are dropped.

    ``spread_by`` names near-unique columns of ``rows``; with it a hot key is
    spread over ``salts`` join sub-keys and the key list is repeated per salt.
    """
    keys = reference.select(F.col(ref_key or key).alias(key))
    return _spread_join(rows, keys, key, "left_semi", spread_by, salts)


def with_unknown_key(rows: DataFrame, reference: DataFrame, key: str, ref_key: str | None = None,
                     spread_by: Sequence[str] | None = None, salts: int = DEFAULT_SALTS) -> DataFrame:
    """Rows whose ``key`` is null or missing from ``reference``."""
    keys = reference.select(F.col(ref_key or key).alias(key))
    return _spread_join(rows, keys, key, "left_anti", spread_by, salts)


def with_attributes(rows: DataFrame, reference: DataFrame, key: str, spread_by: Sequence[str],
                    how: str = "inner", salts: int = DEFAULT_SALTS) -> DataFrame:
    """Rows with the other columns of ``reference`` (unique on ``key``)."""
    return _spread_join(rows, reference, key, how, spread_by, salts)


def insert_ignore(target: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Target plus the incoming rows whose key it does not hold yet."""
    fresh = keep_first(incoming, keys, list(order) or list(keys))
    return target.unionByName(fresh.join(target.select(*keys), list(keys), "left_anti").select(*target.columns))


def replace_rows(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows win as a whole; ``incoming`` is unique on ``keys``."""
    kept = target.join(incoming.select(*keys), list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(incoming.select(*target.columns))


def update_columns(target: DataFrame, incoming: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Insert new keys; on a match take only ``columns`` from ``incoming``.

    Both sides are unique on ``keys``.  A matched null overwrites, as in SQL.
    """
    old = target.withColumn("_old", F.lit(True)).alias("o")
    new = incoming.withColumn("_new", F.lit(True)).alias("n")
    both = old.join(new, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys], "full_outer")
    matched, inserted = F.col("n._new").isNotNull(), F.col("o._old").isNull()

    def value(name: str) -> Column:
        if name in keys:
            return F.coalesce(F.col(f"o.{name}"), F.col(f"n.{name}"))
        if name in columns:
            return F.when(matched, F.col(f"n.{name}")).otherwise(F.col(f"o.{name}"))
        return F.when(inserted, F.col(f"n.{name}")).otherwise(F.col(f"o.{name}"))

    return both.select(*[value(c).alias(c) for c in target.columns])


def above_high_water_mark(source: DataFrame, loaded: DataFrame, column: str) -> DataFrame:
    """Source rows newer than anything loaded; everything when nothing is loaded."""
    mark = loaded.agg(F.max(column)).scalar()
    return source.where(mark.isNull() | (F.col(column) > mark))
