"""Queries: classification metrics, candidate selection, champion decision."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwarden.catalog import frames as fr
from tabwarden.operators import decide, lineage, metrics, registry

MODEL = ["model"]


def confusion_by_model(spark, d):
    return metrics.confusion(fr.scored_documents(spark, d), MODEL)


def class_metrics(spark, d):
    return metrics.class_metrics(fr.scored_documents(spark, d), MODEL)


def class_metrics_null_scores(spark, d):
    """Scores and labels missing, and a model without a name: such rows are counted apart."""
    i = F.col("doc_id")
    rows = fr.scored_documents(spark, d).withColumns({
        "label": F.when(i % 13 > 0, F.col("label")), "p": F.when(i % 7 > 0, F.col("p")), "model": F.when(F.col("model") != "middle", F.col("model"))
    })
    return metrics.class_metrics(rows, MODEL)


def roc_auc(spark, d):
    return metrics.roc_auc(fr.scored_documents(spark, d), MODEL)


def average_precision(spark, d):
    return metrics.average_precision(fr.scored_documents(spark, d), MODEL)


def log_loss(spark, d):
    return metrics.log_loss(fr.scored_documents(spark, d), MODEL)


def threshold_predictions(spark, d):
    scored = fr.scored_documents(spark, d)
    return scored.select("doc_id", "model", metrics.predicted(F.col("p")).alias("predicted"))


def fold_scores(spark, d):
    """Recall per language as if languages were folds, then its mean and deviation per model."""
    per_fold = metrics.rates(metrics.confusion(fr.scored_documents(spark, d), ["model", "lang"]))
    return metrics.fold_summary(per_fold, MODEL, "recall")


def _by_language(spark, d):
    return metrics.rates(metrics.confusion(fr.scored_documents(spark, d), ["lang", "model"]))


def rank_candidates(spark, d):
    """Every (model, language) pair as a candidate, best recall first."""
    candidates = _by_language(spark, d).withColumn("candidate", F.concat_ws("-", "model", "lang"))
    return decide.rank_candidates(candidates, "candidate").select("candidate", "recall", "precision")


def select_candidate(spark, d):
    # A wide tolerance makes the precision rule take part.
    return decide.select_candidate(_by_language(spark, d), by=["lang"], tolerance=0.3)


def champion_decision(spark, d):
    """Best candidate per language against the champion, which exists for some of them."""
    per = _by_language(spark, d)
    champion = per.where((F.col("model") == "middle") & F.col("lang").isin("en", "fr", "de"))
    best = decide.select_candidate(per, by=["lang"])
    return decide.champion_decision(best, champion, on=["lang"])


def lineage_evaluate(spark, d):
    found = metrics.rates(metrics.confusion(fr.scored_documents(spark, d), MODEL))
    champion = found.where("model = 'middle'")
    return lineage.evaluation(found, decide.champion_decision(decide.select_candidate(found), champion))


def registry_version_metrics(spark, d):
    """The metrics that would be stored with the chosen version."""
    return registry.version_metrics(lineage_evaluate(spark, d)).drop("approved", "reason")


QUERIES = {
    f.__name__: f
    for f in (
        confusion_by_model, class_metrics, class_metrics_null_scores, roc_auc, average_precision, log_loss, threshold_predictions, fold_scores,
        rank_candidates, select_candidate, champion_decision, lineage_evaluate, registry_version_metrics,
    )
}

_BY_MODEL = f"WITH RECURSIVE {fr.SCORED_SQL}, {fr.CONFUSION_SQL.format(by='model')}"
_BY_LANG = f"WITH RECURSIVE {fr.SCORED_SQL}, {fr.CONFUSION_SQL.format(by='lang, model')}"

_AUC = """auc AS (
  SELECT model, round(sum(CASE WHEN label = 1 THEN below + ties / 2.0::DOUBLE END) / (sum(label) * sum(1 - label))::DOUBLE, 6) AS roc_auc
  FROM (SELECT model, label,
          sum(1 - label) OVER (PARTITION BY model ORDER BY p RANGE UNBOUNDED PRECEDING) - sum(1 - label) OVER (PARTITION BY model, p) AS below,
          sum(1 - label) OVER (PARTITION BY model, p) AS ties FROM scored) GROUP BY model)"""
_AP = """ap AS (
  SELECT model, round(sum(pos * (ctp / cn::DOUBLE)) / sum(pos)::DOUBLE, 6) AS pr_auc
  FROM (SELECT model, pos, sum(pos) OVER w AS ctp, sum(n) OVER w AS cn
        FROM (SELECT model, p, sum(label) AS pos, count(*) AS n FROM scored GROUP BY model, p)
        WINDOW w AS (PARTITION BY model ORDER BY p DESC)) GROUP BY model)"""
_EPS = "2.220446049250313e-16::DOUBLE"
_LL = f"""ll AS (
  SELECT model, round(avg(CASE WHEN label = 1 THEN -ln(q) ELSE -ln(1.0::DOUBLE - q) END), 6) AS log_loss
  FROM (SELECT model, label, least(greatest(p, {_EPS}), 1.0::DOUBLE - {_EPS}) AS q FROM scored) GROUP BY model)"""


def _walk(tolerance: float, source: str = "rates", by: str = "lang") -> str:
    """The walk along falling recall, as recursion."""
    return f"""ordered AS (SELECT {by}, model, recall, precision, row_number() OVER (PARTITION BY {by} ORDER BY recall DESC, model) AS i FROM {source}),
walk AS (
  SELECT {by}, i, model, recall, precision FROM ordered WHERE i = 1
  UNION ALL
  SELECT o.{by}, o.i,
    CASE WHEN abs(round(w.recall - o.recall, 6)) <= {tolerance} AND o.precision > w.precision THEN o.model ELSE w.model END,
    CASE WHEN abs(round(w.recall - o.recall, 6)) <= {tolerance} AND o.precision > w.precision THEN o.recall ELSE w.recall END,
    CASE WHEN abs(round(w.recall - o.recall, 6)) <= {tolerance} AND o.precision > w.precision THEN o.precision ELSE w.precision END
  FROM walk w JOIN ordered o ON o.{by} = w.{by} AND o.i = w.i + 1),
best AS (SELECT {by}, arg_max(model, i) AS best_model, arg_max(recall, i) AS recall, arg_max(precision, i) AS precision FROM walk GROUP BY {by})"""


_DECISION = """CASE WHEN champion_recall IS NULL THEN 'approved: no champion'
    WHEN round(recall - champion_recall, 6) >= 0.01::DOUBLE THEN 'approved: enough gain' ELSE 'rejected: gain below threshold' END AS reason,
  champion_recall IS NULL OR round(recall - champion_recall, 6) >= 0.01::DOUBLE AS approved"""

ORACLES = {
    "registry_version_metrics": f"""{_BY_MODEL}, every AS (SELECT 1 AS g, * FROM rates), {_walk(0.005, 'every', 'g')}
        SELECT model, r.recall, r.precision, f1 FROM rates r JOIN best ON best_model = model""",
    "confusion_by_model": f"{_BY_MODEL} SELECT model, tn, fp, fn, tp FROM cells",
    "class_metrics": f"""{_BY_MODEL}, {_AUC}, {_AP}, {_LL}
        SELECT model, n_samples, 0::BIGINT AS n_unscored, tn, fp, fn, tp, accuracy, precision, recall, f1, 0.5::DOUBLE AS threshold, roc_auc, pr_auc, log_loss
        FROM rates JOIN auc USING (model) JOIN ap USING (model) JOIN ll USING (model)""",
    "class_metrics_null_scores": f"""WITH {fr.SCORED_SQL.replace('scored AS (', 'every AS (', 1)},
        holes AS (SELECT CASE WHEN doc_id % 13 > 0 THEN label END AS label, CASE WHEN doc_id % 7 > 0 THEN p END AS p, CASE model WHEN 'middle' THEN '~' ELSE model END AS model FROM every),
        scored AS (SELECT * FROM holes WHERE label IS NOT NULL AND p IS NOT NULL), {fr.CONFUSION_SQL.format(by='model')}, {_AUC}, {_AP}, {_LL},
        lost AS (SELECT model, count(*) FILTER (label IS NULL OR p IS NULL) AS n_unscored FROM holes GROUP BY model)
        SELECT nullif(model, '~') AS model, n_samples, n_unscored, tn, fp, fn, tp, accuracy, precision, recall, f1, 0.5::DOUBLE AS threshold, roc_auc, pr_auc, log_loss
        FROM rates JOIN auc USING (model) JOIN ap USING (model) JOIN ll USING (model) JOIN lost USING (model)""",
    "roc_auc": f"WITH {fr.SCORED_SQL}, {_AUC} SELECT * FROM auc",
    "average_precision": f"WITH {fr.SCORED_SQL}, {_AP} SELECT * FROM ap",
    "log_loss": f"WITH {fr.SCORED_SQL}, {_LL} SELECT * FROM ll",
    "threshold_predictions": f"WITH {fr.SCORED_SQL} SELECT doc_id, model, (p >= 0.5)::INTEGER AS predicted FROM scored",
    "fold_scores": f"{_BY_LANG} SELECT model, round(avg(recall)::DECIMAL(18, 12), 6)::DOUBLE AS mean_score, round(stddev_pop(recall)::DECIMAL(18, 12), 6)::DOUBLE AS std_score FROM rates GROUP BY model",
    "rank_candidates": f"{_BY_LANG} SELECT model || '-' || lang AS candidate, recall, precision FROM rates",
    "select_candidate": f"{_BY_LANG}, {_walk(0.3)} SELECT * FROM best",
    "champion_decision": f"""{_BY_LANG}, {_walk(0.005)}, c AS (SELECT lang, recall AS champion_recall FROM rates WHERE model = 'middle' AND lang IN ('en', 'fr', 'de'))
        SELECT lang, best_model, recall, precision, champion_recall, round(recall - champion_recall, 6) AS gain, {_DECISION}
        FROM best LEFT JOIN c USING (lang)""",
    "lineage_evaluate": f"""{_BY_MODEL}, every AS (SELECT 1 AS g, * FROM rates), {_walk(0.005, 'every', 'g')},
        d AS (SELECT best_model, {_DECISION} FROM best, (SELECT recall AS champion_recall FROM rates WHERE model = 'middle'))
        SELECT model, recall, precision, f1, best_model IS NOT NULL AS is_best, approved, reason FROM rates LEFT JOIN d ON best_model = model""",
}
