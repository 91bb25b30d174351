"""Session settings the jobs rely on, and the shared scratch location."""

from __future__ import annotations

from tempfile import mkdtemp
from uuid import uuid4

from pyspark.sql import SparkSession

# AQE re-plans shuffles from measured sizes: it coalesces small partitions,
# splits skewed ones and broadcasts a side only when its measured size is
# under the threshold.  forceOptimizeSkewedJoin lets it split a hot key even
# when the split costs one more exchange further up the plan.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def size_settings(shuffled_gb: float, cores: int) -> dict[str, str]:
    """Shuffle settings for a job whose largest exchange moves ``shuffled_gb``.

    Starts with partitions of about 128 MB, at least two per core; AQE joins the
    small ones and splits the skewed ones from there.
    """
    partitions = max(2 * cores, int(shuffled_gb * 8))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.files.maxPartitionBytes": "256m",
    }


def build_session(app_name: str = "tidemark", master: str | None = None, **settings: str) -> SparkSession:
    """Create a session with the settings above; ``settings`` use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession) -> str:
    """A new folder name in the shared folder that ``spark.checkpoint.dir`` names.

    Only a local session, where driver and executors are one machine, falls back
    to a temporary folder when the session names none.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/tidemark-{uuid4().hex}"
    if spark.sparkContext.master.startswith("local"):
        return mkdtemp(prefix="tidemark-")
    raise ValueError("spark.checkpoint.dir must name a folder all executors can reach")
