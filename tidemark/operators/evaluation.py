"""Quality of a score against a 0/1 label, and drift between two samples.

Rank-based measures work on one row per distinct score and accumulate over
value ranges, so neither a hot score nor many scores land in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators.ranking import running_totals


def confusion(scored: DataFrame, score: str, label: str, threshold: float) -> DataFrame:
    flagged, positive = F.col(score) >= threshold, F.col(label) == 1
    return scored.agg(
        F.count_if(flagged & positive).alias("tp"), F.count_if(flagged & ~positive).alias("fp"),
        F.count_if(~flagged & positive).alias("fn"), F.count_if(~flagged & ~positive).alias("tn"),
    )


def classification_metrics(scored: DataFrame, score: str, label: str, threshold: float = 0.5) -> DataFrame:
    """Accuracy, precision, recall and F1; an undefined ratio is 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    r4 = lambda n, d: F.round(C.ratio(n, d, 0.0), 4)
    return confusion(scored, score, label, threshold).select(
        "tp", "fp", "fn", "tn", r4(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        r4(tp, tp + fp).alias("precision"), r4(tp, tp + fn).alias("recall"),
        r4(tp * 2, tp * 2 + fp + fn).alias("f1_score"),
    )


def cost_confusion(scored: DataFrame, score: str, label: str, threshold: float,
                   missed_cost: float, false_alarm_cost: float) -> DataFrame:
    """Cost of missed churners and needless interventions at a threshold."""
    missed, alarms = F.col("fn") * F.lit(missed_cost), F.col("fp") * F.lit(false_alarm_cost)
    return confusion(scored, score, label, threshold).select(
        "tp", "fp", "fn", "tn", F.round(missed, 2).alias("missed_cost"),
        F.round(alarms, 2).alias("false_alarm_cost"), F.round(missed + alarms, 2).alias("total_cost"),
    )


def _per_score(scored: DataFrame, score: str, label: str) -> DataFrame:
    counts = scored.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    return running_totals(counts, "score", ["pos", "neg"])


def roc_auc(scored: DataFrame, score: str, label: str) -> DataFrame:
    """Area under the ROC curve; tied scores count half (null with one class)."""
    ranked = _per_score(scored, score, label)
    # Positives strictly above each negative, plus half of the tied ones.
    neg = F.col("neg").cast("decimal(18,0)")  # a product of two counts can pass 64 bits
    wins = F.sum(neg * (F.col("cum_pos") * 2 + F.col("pos")).cast("decimal(18,0)"))
    sums = ranked.agg(wins.alias("_wins"), F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))
    area = C.ratio(F.col("_wins"), F.col("positives").cast("double") * F.col("negatives") * 2)
    return sums.select("positives", "negatives", F.round(area, 4).alias("roc_auc"))


def pr_auc(scored: DataFrame, score: str, label: str) -> DataFrame:
    """Average precision: precision at each distinct score times its recall step."""
    ranked = _per_score(scored, score, label)
    found = F.col("cum_pos") + F.col("pos")
    shown = found + F.col("cum_neg") + F.col("neg")
    sums = ranked.agg(F.sum(F.col("pos") * C.ratio(found, shown)).alias("_area"), F.sum("pos").alias("positives"))
    return sums.select("positives", F.round(C.ratio(F.col("_area"), F.col("positives")), 4).alias("pr_auc"))


def recall_top_share(scored: DataFrame, score: str, label: str, share: float = 0.10) -> DataFrame:
    """Recall among the rows whose percent rank, best score first, is within ``share``.

    Equal scores share a rank, so a tie at the border is taken as a whole.
    """
    ranked = _per_score(scored, score, label)
    rows = scored.where(F.col(score).isNotNull()).agg(F.count(F.lit(1))).scalar()
    above = F.col("cum_pos") + F.col("cum_neg")
    top = C.ratio(above, rows - 1, 0.0) <= share
    sums = ranked.agg(
        F.sum(F.when(top, F.col("pos") + F.col("neg")).otherwise(0)).alias("top_rows"),
        F.sum(F.when(top, F.col("pos")).otherwise(0)).alias("top_positives"), F.sum("pos").alias("positives"))
    return sums.withColumn("recall", F.round(C.ratio(F.col("top_positives"), F.col("positives"), 0.0), 4))


def out_of_time_split(rows: DataFrame, time: str, cutoff, until=None) -> DataFrame:
    """Add ``split``: ``train`` before the cutoff, ``test`` from it (to ``until``)."""
    t, cut = F.col(time), C.as_timestamp(cutoff)
    within = F.lit(True) if until is None else t < C.as_timestamp(until)
    return rows.withColumn("split", F.when(t < cut, "train").when(within, "test")).where("split IS NOT NULL")


def drift_psi(rows: DataFrame, group: str, value: str, is_current: Column, edges: Sequence[float],
              floor: float = 1e-4) -> DataFrame:
    """Population stability index per group over fixed bins.

    Empty bins enter with a share of ``floor``.
    """
    bin_no = sum((F.when(F.col(value) >= e, 1).otherwise(0) for e in edges), F.lit(0))
    counts = rows.where(F.col(value).isNotNull()).groupBy(group, bin_no.alias("bin")).agg(
        F.count_if(~is_current).alias("n_base"), F.count_if(is_current).alias("n_now"))
    totals = counts.groupBy(group).agg(F.sum("n_base").alias("base_rows"), F.sum("n_now").alias("current_rows"))
    share = lambda n, d: F.greatest(C.ratio(F.col(n), F.col(d), 0.0), F.lit(floor))
    p, q = share("n_base", "base_rows"), share("n_now", "current_rows")
    # Bins without rows on either side add nothing: both shares are ``floor``.
    return counts.join(totals, group).groupBy(group, "base_rows", "current_rows").agg(
        F.round(F.sum((q - p) * F.ln(q / p)), 4).alias("psi"))
