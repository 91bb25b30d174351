"""Table writes, snapshot publishing and external database options."""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas as S

PUBLISH_LOG = "publish_log"
DATED = "dated"
RUN_AUDIT = "audit_pipeline_runs"


def create_tables(spark: SparkSession, root: str) -> list[str]:
    """Write each missing warehouse table as an empty one; returns those created."""
    created = []
    for name, ddl in S.WAREHOUSE.items():
        if not table_exists(spark, f"{root}/{name}"):
            spark.createDataFrame([], S.struct(ddl)).write.parquet(f"{root}/{name}")
            created.append(name)
    return created


def table_exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def overwrite(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Replace a table.  A partition column gets its rows together first, so each
    partition is written by few tasks; AQE splits a partition that is too large."""
    if partition_by:
        df = df.hint("rebalance", F.col(partition_by))
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def check_same(written: DataFrame, back: DataFrame, path: str) -> None:
    """Stop where what was read back differs from what was written (a row per key on both sides)."""
    by = lambda df, n: df.withColumn("_side", F.lit(n))
    differ = by(written, 1).unionByName(by(back, 2)).groupBy(*written.columns).agg(F.sum("_side").alias("_sides")).where("_sides <> 3")
    found = differ.drop("_sides").limit(5).collect()
    if found:
        raise ValueError(f"{path} is not what was written: {found}")


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def append_run_audit(spark: SparkSession, root: str, *, run_id: str, layer: str, status: str,
                     records: int, started_at: datetime, completed_at: datetime, error: str | None = None) -> None:
    duration = int((completed_at - started_at).total_seconds() * 1000)
    row = [(run_id, layer, status, records, duration, error, started_at, completed_at)]
    append(spark.createDataFrame(row, S.struct(S.WAREHOUSE[RUN_AUDIT])), f"{root}/{RUN_AUDIT}")


def export_csv(df: DataFrame, path: str) -> None:
    """Minimal quoting, no header, empty field for null, doubled quotes: the form
    bulk loaders of relational databases take."""
    (df.write.mode("overwrite").option("header", False).option("nullValue", "").option("emptyValue", '""')
     .option("escape", '"').option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").csv(path))


def observed(counts: Observation) -> dict:
    """What was observed of rows that have been written; nothing where Spark found beforehand that there are none."""
    try:
        return counts.get
    except Py4JJavaError as problem:
        if "AssertionError" not in str(problem):
            raise
        return {}


# ------------------------------------------------------------ snapshot publish

def stage(df: DataFrame, root: str, run_id: str, name: str, partition_by: str | None = None) -> DataFrame:
    """Write a table of a run that is not visible yet and read it back."""
    path = f"{root}/run_id={run_id}/{name}"
    overwrite(df, path, partition_by)
    return df.sparkSession.read.parquet(path)


class PublishConflict(RuntimeError):
    """A table that a run was built from has been published anew meanwhile."""


@dataclass(frozen=True)
class Published:
    """What the newest entry of the publish log says."""

    number: int = -1
    runs: Mapping[str, str] = field(default_factory=dict)  # of every table, and of every date of a dated one
    marks: Mapping[str, str] = field(default_factory=dict)


def _file_system(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file under a name that is not taken yet, whole or not at all; False where it is taken.

    The file is written under a name of its own first.  A link (local files) or a rename that
    does not overwrite (other file systems) then gives it the name: of several writers one succeeds.
    """
    files, final = _file_system(spark, path)
    own = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid4().hex}.tmp")
    files.mkdirs(final.getParent())
    out = files.create(own, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    try:
        if files.getScheme() == "file":
            os.link(own.toUri().getPath(), final.toUri().getPath())
        else:
            hadoop = spark._jvm.org.apache.hadoop.fs
            none = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
            none[0] = getattr(hadoop, "Options$Rename").NONE
            hadoop.FileContext.getFileContext(final.toUri(), spark._jsc.hadoopConfiguration()).rename(own, final, none)
        return True
    except FileExistsError:
        return False
    except Exception:
        if files.exists(final) and files.exists(own):  # another writer's; this one was not renamed
            return False
        raise
    finally:
        files.delete(own, False)


def _names(spark: SparkSession, path: str) -> list[str]:
    files, folder = _file_system(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(folder)) if files.exists(folder) else []


def published(spark: SparkSession, root: str) -> Published:
    """The newest log entry; each holds the state as a whole, so no other is read."""
    numbers = [int(n[:-5]) for n in _names(spark, f"{root}/{PUBLISH_LOG}") if n.endswith(".json")]
    if not numbers:
        return Published()
    text = spark.read.text(f"{root}/{PUBLISH_LOG}/{max(numbers):012d}.json", wholetext=True).first()[0]
    entry = json.loads(text)
    return Published(max(numbers), entry["runs"], entry["marks"])


def publish(spark: SparkSession, root: str, run_id: str, tables: Sequence[str], published_at: datetime,
            based_on: Mapping[str, str | None] | None = None, marks: Mapping[str, object] | None = None,
            removed: Sequence[str] = ()) -> int:
    """Make fully written tables of a run the current ones; the number of the log entry.

    One log entry names the tables of the run; all others stay at the run they
    were, whoever publishes them meanwhile.  Either all tables of the run become
    visible or none does.  ``based_on`` names the runs that published tables were
    read from; if one has changed since, nothing is published.  ``marks`` are kept
    beside the tables, ``removed`` names tables or dates that are no more.

    The entry is created under the next number.  Where another writer has taken it,
    its entry is read and everything is checked again, so no publish is lost.
    """
    while True:
        now = published(spark, root)
        changed = sorted(name for name, run in (based_on or {}).items() if now.runs.get(name) != run)
        if changed:
            raise PublishConflict(f"published anew meanwhile: {', '.join(changed)}")
        runs = {n: r for n, r in now.runs.items() if n not in removed} | {name: run_id for name in tables}
        entry = {"run": run_id, "published_at": published_at.isoformat(), "runs": runs,
                 "marks": {**now.marks, **{n: str(v) for n, v in (marks or {}).items()}}}
        if create_new(spark, f"{root}/{PUBLISH_LOG}/{now.number + 1:012d}.json", json.dumps(entry, sort_keys=True)):
            return now.number + 1


def current_runs(spark: SparkSession, root: str) -> dict[str, str]:
    """Run of each published table; a dated table has one a date, as ``name/date``."""
    return dict(published(spark, root).runs)


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """A table as last published; ``None`` before the first publish."""
    run_id = published(spark, root).runs.get(name)
    return spark.read.parquet(f"{root}/run_id={run_id}/{name}") if run_id else None


def register_published(spark: SparkSession, root: str) -> None:
    """Temporary views over the published tables, for SQL by table name."""
    for name, run_id in current_runs(spark, root).items():
        if "/" not in name:
            spark.read.parquet(f"{root}/run_id={run_id}/{name}").createOrReplaceTempView(name)


# ------------------------------------------------------------------ dated tables

def _dated(root: str, name: str) -> str:
    return f"{root}/{DATED}/{name}"


def stage_dates(df: DataFrame, root: str, run_id: str, name: str, by: str = "event_date") -> list[str]:
    """Write the dates of ``df`` as a run's version of them; the names to publish.

    Only these dates are written; all others stay where earlier runs wrote them.
    """
    path = f"{_dated(root, name)}/run_id={run_id}"
    overwrite(df, path, by)
    prefix = f"{by}="
    return [f"{name}/{n[len(prefix):]}" for n in _names(df.sparkSession, path) if n.startswith(prefix)]


def read_dates(spark: SparkSession, root: str, name: str, schema: str, dates: Iterable[str] | None = None,
               state: Published | None = None, by: str = "event_date") -> DataFrame:
    """Published dates of a dated table: all, or those named.  Lists the folders of these dates only."""
    runs = (state or published(spark, root)).runs
    wanted = None if dates is None else {str(x) for x in dates}
    paths = [f"{_dated(root, name)}/run_id={run}/{by}={day}" for day, run in (
        (key[len(name) + 1:], run) for key, run in sorted(runs.items()) if key.startswith(f"{name}/")) if wanted is None or day in wanted]
    if not paths:
        return spark.createDataFrame([], schema)
    read = spark.read.schema(f"{schema}, run_id STRING").option("basePath", _dated(root, name)).parquet(*paths)
    return read.drop("run_id")


def published_dates(state: Published, name: str) -> list[str]:
    return sorted(key[len(name) + 1:] for key in state.runs if key.startswith(f"{name}/"))


# ------------------------------------------------------------ external database

def jdbc_options(url: str, table: str, *, column: str, lower: int | str, upper: int | str,
                 partitions: int, fetch_size: int = 10_000) -> dict[str, str]:
    """Options of a partitioned read: ``spark.read.format("jdbc").options(**...)``."""
    if partitions < 1:
        raise ValueError("partitions must be at least 1")
    return {
        "url": url, "dbtable": table, "partitionColumn": column, "lowerBound": str(lower),
        "upperBound": str(upper), "numPartitions": str(partitions), "fetchsize": str(fetch_size),
    }
