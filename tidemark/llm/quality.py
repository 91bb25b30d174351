"""Quality rules kept as a ledger: every rule judged once, one bit each.

``ledger`` measures a text once and puts the measurements beside a mask of the
rules it fails; ``stored`` keeps that as a table.  Policies (named, versioned sets of rules) and ablations are then
bit operations on the mask and never read a text again.

Defined results: a null text counts as empty; a null id stays null; repeated rows
are judged one by one; other columns are passed over, whatever their names; an
empty table gives an empty ledger.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W

REPEAT_WINDOW = 8
SYMBOLS = b"#*$%&|<>"  # fixed by the contract

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")


@dataclass(frozen=True)
class Rule:
    """A document fails where ``fails`` (SQL over the measurements) is true."""

    bit: int
    name: str
    fails: str


#: A rule keeps its bit for good; a changed threshold is a new rule with a new bit.
RULES = (
    Rule(0, "too_few_words", "n_words < 20"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 30 * n_words"),
    Rule(2, "short_words", "word_chars < 2 * n_words"),
    Rule(3, "long_words", "word_chars > 25 * n_words"),
    Rule(4, "symbols", "n_symbols > n_words"),
    Rule(5, "repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule(6, "shouting", "2 * n_upper > word_chars"),
)
BASE = ("too_few_words", "repeated_words")
POLICIES = {
    "base-1": BASE,
    "web-1": tuple(r.name for r in RULES),
}
DEFAULT_POLICY = "web-1"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def mask_of(names: tuple[str, ...]) -> int:
    """The bits of the named rules."""
    bits = {r.name: r.bit for r in RULES}
    return sum(1 << bits[n] for n in set(names))


def measure(text: pa.Array | pa.ChunkedArray) -> dict[str, np.ndarray]:
    """All measurements of every text."""
    w = W.split(text)
    n, data, counts = len(w.offsets) - 1, w.data, w.counts
    span = lambda prefix: prefix[w.offsets[1:]] - prefix[w.offsets[:-1]]
    points = W.sums((data & 0xC0) != 0x80)
    lines, filled = _lines(w)
    return {
        "n_words": counts,
        "word_chars": w.per_text(points[w.ends] - points[w.starts]),
        "n_symbols": span(W.sums(_SYMBOL[data])),
        "n_dup_lines": filled - _distinct(*lines, n),
        "n_repeat_words": _repeated(w),
        "n_lines": filled,
        "n_upper": span(W.sums((data >= 65) & (data <= 90))),
    }


def _lines(w: W.Words) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """Hash and text of every line that has a word; the number of those by text."""
    breaks = np.flatnonzero(w.data == 10)
    bounds = np.union1d(breaks + 1, w.offsets)
    starts, ends = bounds[:-1], bounds[1:].copy()
    starts, ends = starts[starts < ends], ends[starts < ends]
    has = np.searchsorted(w.starts, ends) > np.searchsorted(w.starts, starts)
    starts, ends = starts[has], ends[has]
    ends = ends - (w.data[ends - 1] == 10)
    owner = np.searchsorted(w.offsets, starts, "right") - 1
    return (W.segment_hashes(w.data, starts, ends), owner), np.bincount(owner, minlength=len(w.offsets) - 1)


def _distinct(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Different hashes by text."""
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    return np.bincount(o[new], minlength=n)


def _repeated(w: W.Words) -> np.ndarray:
    """Words by text in windows that the text holds twice or more."""
    at = w.windows(REPEAT_WINDOW)
    hashes = W.window_hashes(w.hashes(), REPEAT_WINDOW)[at]
    owner = np.searchsorted(w.first, at, "right") - 1
    keys = W.mix(hashes ^ W.mix(owner.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(w.starts) + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + REPEAT_WINDOW, -1)
    return w.per_text(np.cumsum(cover[:-1]) > 0)


def failures(rules: tuple[Rule, ...] = RULES) -> Column:
    """The mask of failed rules, from the measurements."""
    mask = F.lit(0).cast("long")
    for rule in rules:
        mask = mask.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long"))
    return mask


def ledger(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, measurements and ``fail_mask`` of every document, in one pass without a shuffle."""
    source = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch):
                measured = measure(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), *(pa.array(measured[m].astype(np.int64)) for m in MEASURES)], names=["id", *MEASURES])

    schema = ", ".join([f"id {dict(source.dtypes)['id']}", *(f"{m} long" for m in MEASURES)])
    return source.mapInArrow(judge, schema).select(F.col("id").alias(doc_id), *MEASURES, failures().alias("fail_mask"))


def stored(entries: DataFrame, path: str) -> DataFrame:
    """The ledger written to ``path`` and read from there, for any number of policies and ablations."""
    entries.write.parquet(path)
    return entries.sparkSession.read.schema(entries.schema).parquet(path)


def apply_policy(entries: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """``kept``: no rule of the policy failed."""
    return entries.withColumn("kept", F.col("fail_mask").bitwiseAND(F.lit(mask_of(POLICIES[policy]))) == 0)


def ablation(entries: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """By rule of a policy: documents that fail it, and those that only this rule rejects.

    One aggregate over the masks: each mask is first counted, so the rules are
    expanded on the few different masks and not on the documents.
    """
    whole = mask_of(POLICIES[policy])
    masks = entries.groupBy(F.col("fail_mask").bitwiseAND(F.lit(whole)).alias("mask")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*(F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit"))
                      for r in RULES if r.name in POLICIES[policy]))
    each = masks.select("mask", "n", F.explode(rules).alias("r")).select("mask", "n", "r.*")
    hit = F.col("mask").bitwiseAND(F.col("bit")) != 0
    return each.groupBy("rule").agg(
        F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("failed"),
        F.coalesce(F.sum(F.when(F.col("mask") == F.col("bit"), F.col("n"))), F.lit(0)).alias("only_this"),
        F.coalesce(F.sum(F.when(F.col("mask").bitwiseAND(F.lit(whole) - F.col("bit")) == 0, F.col("n"))), F.lit(0))
        .alias("kept_without"))


def keep_good(docs: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """The documents that the policy keeps, with their columns."""
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("document"), "text")
    return apply_policy(ledger(whole, doc_id="document"), policy).where("kept").select("document.*")
