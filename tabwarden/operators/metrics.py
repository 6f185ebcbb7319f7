"""Classification metrics over scored rows, grouped by model.

One rule for all of them: a row counts if its score is a number and its label is 0 or 1. Other rows
are in no metric; ``class_metrics`` says how many there are. A NULL group is a group like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwarden import fixed
from tabwarden.functions import cells, sizing, stats
from tabwarden.functions.ordered import running_totals


def predicted(p: Column, threshold: float = fixed.DECISION_THRESHOLD) -> Column:
    return (p >= threshold).cast("int")


def counts(label: Column, p: Column) -> Column:
    """Whether a row enters the metrics."""
    return F.coalesce(label.isin(0, 1) & ~F.isnan(p.cast("double")) & p.isNotNull(), F.lit(False))


def confusion_cells(label: Column, yhat: Column) -> list[Column]:
    return [
        F.count_if((label == 0) & (yhat == 0)).alias("tn"),
        F.count_if((label == 0) & (yhat == 1)).alias("fp"),
        F.count_if((label == 1) & (yhat == 0)).alias("fn"),
        F.count_if((label == 1) & (yhat == 1)).alias("tp"),
    ]


def confusion(
    scored: DataFrame, by: Sequence[str], label: str = "label", p: str = "p", threshold: float = fixed.DECISION_THRESHOLD
) -> DataFrame:
    known = F.when(counts(F.col(label), F.col(p)), F.col(p))
    return scored.groupBy(*by).agg(*confusion_cells(F.col(label), predicted(known, threshold)))


def rates(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 of confusion counts; an empty denominator gives 0."""
    tp, fp, fn, tn = (F.col(n) for n in ("tp", "fp", "fn", "tn"))
    return counts.withColumns(
        {
            "accuracy": F.round(cells.safe_ratio(tp + tn, tp + fp + fn + tn), 6),
            "precision": F.round(cells.safe_ratio(tp, tp + fp), 6),
            "recall": F.round(cells.safe_ratio(tp, tp + fn), 6),
            "f1": F.round(cells.safe_ratio(tp * 2, tp * 2 + fp + fn), 6),
        }
    )


def score_counts(scored: DataFrame, by: Sequence[str], label: str = "label", p: str = "p") -> DataFrame:
    """One row per distinct score: positives and negatives. Ties collapse before any order.

    Rows that do not count share a row without a score. The table is stored, as it is read several
    times and far smaller than its input: one scan of the input for all that follows.
    """
    known = counts(F.col(label), F.col(p))
    table = scored.groupBy(*by, F.when(known, F.col(p)).alias("score")).agg(
        F.count_if(known & (F.col(label) == 1)).alias("pos"), F.count_if(known & (F.col(label) == 0)).alias("neg"), F.count_if(~known).alias("unscored")
    )
    return sizing.cut_lineage(table, "score-counts")


def roc_auc(scored: DataFrame, by: Sequence[str], label: str = "label", p: str = "p") -> DataFrame:
    """Mann-Whitney form of the area under the ROC curve, ties at half weight."""
    ranked = running_totals(score_counts(scored, by, label, p), by, "score", {"neg": "neg_through"})
    wins = F.col("pos").cast("double") * (F.col("neg_through") - F.col("neg") / 2)
    out = ranked.groupBy(*by).agg(F.sum(wins).alias("_u"), F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    pairs = F.col("_p").cast("double") * F.col("_n")
    return out.select(*by, F.round(F.try_divide(F.col("_u"), pairs), 6).alias("roc_auc"))


def average_precision(scored: DataFrame, by: Sequence[str], label: str = "label", p: str = "p") -> DataFrame:
    """Step-wise area under the precision-recall curve."""
    counted = score_counts(scored, by, label, p).withColumn("n", F.col("pos") + F.col("neg"))
    ranked = running_totals(counted, by, "score", {"pos": "ctp", "n": "cn"}, descending=True)
    step = F.try_divide(F.col("pos").cast("double") * F.col("ctp"), F.col("cn").cast("double"))
    out = ranked.groupBy(*by).agg(F.sum(step).alias("_s"), F.sum("pos").alias("_p"))
    return out.select(*by, F.round(F.try_divide(F.col("_s"), F.col("_p").cast("double")), 6).alias("pr_auc"))


def log_loss(scored: DataFrame, by: Sequence[str], label: str = "label", p: str = "p") -> DataFrame:
    known = counts(F.col(label), F.col(p))
    return scored.groupBy(*by).agg(F.round(F.avg(F.when(known, stats.log_loss_term(F.col(label), F.col(p)))), 6).alias("log_loss"))


def class_metrics(
    scored: DataFrame,
    by: Sequence[str],
    label: str = "label",
    p: str = "p",
    threshold: float = fixed.DECISION_THRESHOLD,
) -> DataFrame:
    """Every metric in one row per model, from one shuffle on (model, score).

    Rows collapse to one per distinct score. Confusion counts, log loss and both areas are all
    functions of that smaller table, so the input is read and shuffled once. ``n_samples`` are the
    rows that count, ``n_unscored`` the others.
    """
    counted = score_counts(scored, by, label, p).withColumn("n", F.col("pos") + F.col("neg"))
    ranked = running_totals(counted, by, "score", {"pos": "ctp", "n": "cn"}, descending=True)
    s, pos, neg = F.col("score"), F.col("pos"), F.col("neg")
    hit = s >= threshold
    one, zero = F.lit(1), F.lit(0)
    # Scores descending: each positive of this score beats every negative not yet passed.
    passed_neg = F.col("cn") - F.col("ctp")
    out = ranked.groupBy(*by).agg(
        F.sum("n").alias("n_samples"),
        F.sum("unscored").alias("n_unscored"),
        F.sum(F.when(hit, zero).otherwise(neg)).alias("tn"),
        F.sum(F.when(hit, neg).otherwise(zero)).alias("fp"),
        F.sum(F.when(hit, zero).otherwise(pos)).alias("fn"),
        F.sum(F.when(hit, pos).otherwise(zero)).alias("tp"),
        F.sum(pos).alias("_p"),
        F.sum(neg).alias("_n"),
        F.sum(pos.cast("double") * (passed_neg - neg / 2)).alias("_lost"),
        F.sum(F.try_divide(pos.cast("double") * F.col("ctp"), F.col("cn").cast("double"))).alias("_ap"),
        F.sum(
            pos * stats.log_loss_term(one, s) + neg * stats.log_loss_term(zero, s)
        ).alias("_ll"),
    )
    pairs = F.col("_p").cast("double") * F.col("_n")
    return rates(out).withColumns(
        {
            "threshold": F.lit(float(threshold)),
            "roc_auc": F.round(F.try_divide(pairs - F.col("_lost"), pairs), 6),
            "pr_auc": F.round(F.try_divide(F.col("_ap"), F.col("_p").cast("double")), 6),
            "log_loss": F.round(F.try_divide(F.col("_ll"), F.col("n_samples").cast("double")), 6),
        }
    ).drop("_p", "_n", "_lost", "_ap", "_ll")


def fold_summary(fold_scores: DataFrame, by: Sequence[str], score: str = "score") -> DataFrame:
    """Mean and population deviation of a score over folds.

    Rounded to 12 places first: sums of doubles depend on the order of tasks in their last
    bits, which must not decide a tie of the final rounding.
    """
    return fold_scores.groupBy(*by).agg(
        F.round(F.round(F.avg(score), 12), 6).alias("mean_score"),
        F.round(F.round(F.stddev_pop(score), 12), 6).alias("std_score"),
    )
