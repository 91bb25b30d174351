"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import ann, collocations, conversations, hmm, html, mixing, ngram_join, packing, pieces, quality, substring, token_ids, warc
from tidemark.session import scratch_folder

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest vectors of every 50th."""
    return ann.neighbours(_table(spark, folder, "embeddings"), F.col("id") % 50 == 0)


def op2_warc_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Every page as it is read back from the archives."""
    shared = scratch_folder(spark)
    found = warc.read(warc.write(_table(spark, folder, "pages"), shared), shared)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "file")


def op3_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """The article text of every page."""
    return html.extract(_table(spark, folder, "pages"))


def op4_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Set size and component of every document: 3-word shingles, similarity of 0.9 or more."""
    return ngram_join.near_duplicates(_table(spark, folder, "documents"), size=3, percent=90)


def op5_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How often every document stands in a mixture with equal weights and as many tokens as there are."""
    mixed = mixing.ledger(mixing.with_domain(_table(spark, folder, "documents")))
    return mixed.select("doc_id", "domain", "lang", "source", F.col("mix_tokens").alias("n_tokens"),
                        F.col("mix_copies").cast("long").alias("copies"))


def op6_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of every document, and whether decoding them returns the text."""
    import public_tokenizers

    vocabulary = pieces.load(public_tokenizers.path("piece_bpe_32k.model"))
    coded = pieces.tokenized(_table(spark, folder, "documents").select("doc_id", "text"), vocabulary)
    low, high = int(vocabulary.byte_ids.min()), int(vocabulary.byte_ids.max())
    return coded.select("doc_id", "n_tokens",
                        F.size(F.filter("ids", lambda i: i.between(low, high))).cast("long").alias("n_byte_tokens"),
                        F.xxhash64("ids").alias("ids_hash"), "round_trip")


def op7_hmm_score(spark: SparkSession, folder: str) -> DataFrame:
    """Likelihood of every document under word frequencies and under the trained model."""
    return hmm.score(_table(spark, folder, "documents"))


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words removed from every document, and the digest of the words that are left."""
    left = substring.dedup(_table(spark, folder, "documents"))
    kept = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return left.select("doc_id", "n_words", "n_removed", F.sha2(kept, 256).alias("kept_sha256"))


def _ledger(spark: SparkSession, folder: str) -> DataFrame:
    return quality.stored(quality.ledger(_table(spark, folder, "documents")), f"{scratch_folder(spark)}/ledger")


def op9_quality_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Measurements, failed rules and the verdict of every document."""
    judged = quality.apply_policy(_ledger(spark, folder))
    base = F.col("fail_mask").bitwiseAND(F.lit(quality.mask_of(quality.BASE))) != 0
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         base.alias("base_failed"), "kept", "fail_mask", "n_lines", "n_upper")


def quality_ablation(spark: SparkSession, folder: str) -> DataFrame:
    """By policy and rule: documents that fail it, that it alone rejects, and that would be kept without it."""
    ledger = _ledger(spark, folder)
    each = (quality.ablation(ledger, p).select(F.lit(p).alias("policy"), "*") for p in quality.POLICIES)
    return reduce(DataFrame.unionByName, each)


def op10_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Place, length and checksum of every document's ids, read back from the files."""
    import public_tokenizers

    shared = scratch_folder(spark)
    return token_ids.read(token_ids.write(_table(spark, folder, "documents"), shared, public_tokenizers.path("byte_bpe_50k.json")), shared)


def op11_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of 2,048 tokens."""
    import public_tokenizers

    pieces_ = packing.cut(_table(spark, folder, "documents"), scratch_folder(spark), public_tokenizers.path("byte_bpe_50k.json"))
    placed = packing.place(pieces_.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The best 2,000 collocations of two or three words of each language."""
    return collocations.collocations(_table(spark, folder, "documents"))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults and cheapest edits of every conversation, after damage."""
    found = conversations.repair(conversations.damage(_table(spark, folder, "conversations")), scratch_folder(spark))
    return found.withColumnRenamed("conv", "conv_id")


def catalogue() -> dict[str, Query]:
    return {
        "op1_nearest_vectors": op1_nearest_vectors,
        "op10_token_ids": op10_token_ids,
        "op11_best_fit_packing": op11_best_fit_packing,
        "op12_collocations": op12_collocations,
        "op13_conversation_repair": op13_conversation_repair,
        "op2_warc_archives": op2_warc_archives,
        "op3_main_text": op3_main_text,
        "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
        "op5_source_mixing": op5_source_mixing,
        "op6_sentencepiece": op6_sentencepiece,
        "op7_hmm_score": op7_hmm_score,
        "op8_substring_dedup": op8_substring_dedup,
        "op9_quality_ledger": op9_quality_ledger,
        "quality_ablation": quality_ablation,
    }
