"""Files that tasks write side by side, and the order of shards they stand in.

A task writes under a temporary name of its own and reports it in a manifest row.
Spark writes the manifest, so of several attempts at one task exactly one reports; its
files then get their final names.  What other attempts left stays temporary.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 4096
TEMPORARY = "_temporary"


def store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a shared folder or file."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def temporary(folder: str, name: str) -> str:
    """A name for one attempt at a file."""
    return f"{folder}/{TEMPORARY}/{name}-{uuid4().hex}"


def create(uri: str) -> pa.NativeFile:
    where, path = store(uri)
    where.create_dir(path.rpartition("/")[0], recursive=True)
    return where.open_output_stream(path, compression=None)


def open_file(uri: str) -> pa.NativeFile:
    where, path = store(uri)
    return where.open_input_file(path)


def publish(rows: DataFrame, folder: str) -> DataFrame:
    """Write the manifest ``rows`` (columns ``temporary`` and ``file`` among others), name the files, return the manifest.

    Naming may run twice: a file that has its name already is left alone.
    """
    spark = rows.sparkSession
    rows.write.parquet(f"{folder}/{TEMPORARY}/manifest")
    manifest = spark.read.parquet(f"{folder}/{TEMPORARY}/manifest")

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                where, final = store(f"{folder}/{row['file']}")
                if where.get_file_info(final).type == fs.FileType.NotFound:
                    try:
                        where.move(store(row["temporary"])[1], final)
                    except OSError:
                        if where.get_file_info(final).type == fs.FileType.NotFound:
                            raise
            yield batch

    # the manifest gets its place after all files have theirs
    manifest.mapInArrow(name, manifest.schema).drop("temporary").write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def edges(rows: DataFrame, target: int) -> list[int]:
    """Smallest keys of the shards 1, 2, ... that cut ``rows`` (``key``, ``weight``) into about ``target`` each.

    They follow from the rows alone, whatever their order or partitions.  The weights are
    summed in equal bins of the key range; a bin beyond the target is divided again, some
    bins in each round, until none is left but bins of one key.
    """
    rows = rows.where("key IS NOT NULL").select(F.col("key").cast("decimal(20,0)").alias("key"), "weight")
    low, high = rows.agg(F.min("key"), F.max("key")).first()
    if low is None:
        return []
    heavy, found = [(int(low), int(high) + 1)], {}
    while heavy:
        now, heavy = heavy[:BINS // 64], heavy[BINS // 64:]
        spans = {i: (lo, hi, max(1, -(-(hi - lo) // BINS))) for i, (lo, hi) in enumerate(now)}
        bin_of, within = F.lit(None).cast("decimal(20,0)"), F.lit(None).cast("int")
        for i, (lo, hi, width) in spans.items():
            here = (F.col("key") >= F.lit(lo).cast("decimal(20,0)")) & (F.col("key") < F.lit(hi).cast("decimal(20,0)"))
            within = F.when(here, F.lit(i)).otherwise(within)
            bin_of = F.when(here, F.floor((F.col("key") - F.lit(lo).cast("decimal(20,0)")) / F.lit(width).cast("decimal(20,0)"))).otherwise(bin_of)
        sums = (rows.select(within.alias("span"), bin_of.cast("int").alias("bin"), "weight").where("span IS NOT NULL")
                .groupBy("span", "bin").agg(F.sum("weight").alias("weight")).collect())  # BINS rows a span at most
        for span, part, weight in sorted(map(tuple, sums)):
            lo, hi, width = spans[span]
            begin, end = lo + part * width, min(hi, lo + (part + 1) * width)
            if weight > target and end - begin > 1:
                heavy.append((begin, end))
            else:
                found[begin] = weight
    cuts, full = [], 0
    for begin in sorted(found):
        if full and full + found[begin] > target:
            cuts.append(begin)
            full = 0
        full += found[begin]
    return cuts


def shard_of(keys: pa.ChunkedArray | pa.Array, cuts: list[int]) -> pa.Array:
    """Shard of every key; a null key goes to the last."""
    valid = np.asarray(keys.is_valid())
    at = np.searchsorted(np.array(cuts, np.int64), keys.fill_null(0).to_numpy(zero_copy_only=False), "right")
    return pa.array(np.where(valid, at, len(cuts)).astype(np.int32))
