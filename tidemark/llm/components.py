"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(links: DataFrame, folder: str) -> DataFrame:
    """``node`` and ``label``, the smallest node it is connected with, from links ``a``, ``b``.

    Every round takes the least label among the neighbours and then that label's own
    label, so the number of rounds grows with the logarithm of the longest path.  A
    round is written to ``folder``, which executors share, and read again; so the
    lineage stays short and a lost executor costs one round at most.
    """
    spark = links.sparkSession
    both = links.where("a <> b").select("a", "b").union(links.where("a <> b").select("b", "a")).distinct()
    both.write.parquet(f"{folder}/edges")
    edges = spark.read.parquet(f"{folder}/edges")
    edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")).write.parquet(f"{folder}/0")
    turn = 0
    while True:
        labels = spark.read.parquet(f"{folder}/{turn}")
        near = (edges.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node"))
                .agg(F.min("label").alias("least")))
        own = labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "least").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        own.join(jump, "label").select("node", "was", F.least("label", "next").alias("label")).write.parquet(f"{folder}/{turn + 1}")
        turn += 1
        after = spark.read.parquet(f"{folder}/{turn}")
        if not after.where("label <> was").limit(1).count():
            return after.select("node", "label")
