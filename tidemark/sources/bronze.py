"""Raw JSON landings with fixed schemas, quarantine and audit columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions import columns as C

CORRUPT = "_corrupt_record"


def read_json_array(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """Files that each hold one array of flat objects.

    Such a file cannot be split, so it is one task; land large inputs as JSON
    Lines.
    """
    return spark.read.schema(S.BRONZE[dataset]).option("multiLine", True).json(path)


def _parsed(text: Column, dataset: str) -> Column:
    return F.from_json(text, f"{S.BRONZE[dataset]}, {CORRUPT} STRING", {"columnNameOfCorruptRecord": CORRUPT})


def read_json_lines(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """One object per line, read in parallel; a malformed line keeps its text in
    ``_corrupt_record``."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(_parsed(F.col("value"), dataset).alias("r"), F.col("_metadata.file_path").alias("_source_file")
                        ).select("r.*", "_source_file")


def read_json_array_checked(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """Array files parsed element by element, so one malformed element does not
    spoil its file; ``_seq`` is the position in the file.

    A file that is no JSON array at all becomes one malformed row.
    """
    whole = spark.read.text(path, wholetext=True)
    elements = whole.select(
        F.col("_metadata.file_path").alias("_source_file"), "value",
        F.from_json("value", "array<string>").alias("_elements"),
    ).select(
        "_source_file", F.when(F.col("_elements").isNull(), F.col("value")).alias("_unreadable"),
        F.posexplode_outer("_elements").alias("_seq", "element"),
    ).where("element IS NOT NULL OR _unreadable IS NOT NULL")
    fields = [f for f in S.struct(f"{S.BRONZE[dataset]}, {CORRUPT} STRING").fieldNames() if f != CORRUPT]
    return elements.withColumn("r", _parsed(F.col("element"), dataset)).select(
        *[F.col(f"r.{f}").alias(f) for f in fields],
        F.coalesce(f"r.{CORRUPT}", "_unreadable").alias(CORRUPT), "_source_file", "_seq")


def split_quarantine(parsed: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(usable rows, quarantined rows with a reason).

    A row is quarantined when it did not parse or has no key.
    """
    reason = F.when(F.col(CORRUPT).isNotNull(), "malformed record").when(F.col(key).isNull(), f"missing {key}")
    marked = parsed.withColumn("_reason", reason)
    return marked.where("_reason IS NULL").drop(CORRUPT, "_reason"), marked.where("_reason IS NOT NULL")


def with_audit_columns(df: DataFrame, ingested_at, channel: str) -> DataFrame:
    """Add load time, source channel and a hash of the row's content."""
    return df.withColumns({
        "_ingested_at": C.as_timestamp(ingested_at), "_source_channel": F.lit(channel),
        "_raw_payload_hash": F.sha2(F.to_json(F.struct(*df.columns)), 256)})


def read_landing(spark: SparkSession, root: str, lines: bool = True) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """All six datasets under ``root``: (usable rows, quarantined rows) by name.

    Reads the splittable ``<name>.jsonl``; without ``lines`` array files ``<name>.json``,
    each of which is one task.
    """
    usable, quarantined = {}, {}
    for name, key in S.BRONZE_KEYS.items():
        parsed = (read_json_lines(spark, f"{root}/{name}.jsonl", name) if lines
                  else read_json_array_checked(spark, f"{root}/{name}.json", name))
        good, quarantined[name] = split_quarantine(parsed, key)
        usable[name] = good.drop("_source_file")
    return usable, quarantined
