"""Ordered work on keys that may hold a large part of all rows.

Where a result needs the rows of a key in their order, no task has to hold them all: the
rows are sorted by range, so a key may lie in many partitions, and cut into blocks of
consecutive rows.  A block of a key becomes one value that composes with the next, and the
values of a key are few.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 12  # rows of a block: 2 ** 12 at most


def in_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str], bits: int | None = None) -> DataFrame:
    """``_block``: a number that grows with ``keys`` and ``order`` (give a total order); rows of a block are consecutive."""
    by = [*keys, *order]
    placed = df.repartitionByRange(*by).sortWithinPartitions(*by)
    return placed.withColumn("_block", F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS if bits is None else bits))


def blocks_of_blocks(bits: int | None = None):
    """The number of the run of blocks that a block belongs to."""
    return F.shiftright(F.col("_block"), BLOCK_BITS if bits is None else bits)
