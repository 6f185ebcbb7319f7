"""Queries: delayed labels, label performance, curated sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwarden.catalog import frames as fr
from tabwarden.operators import labels as lab
from tabwarden.operators import metrics


def new_labels(spark, d):
    """Labels not yet processed; an earlier run has seen the English documents."""
    processed = fr.table(spark, d, "documents").where("lang = 'en'").select("doc_id")
    return lab.new_labels(fr.table(spark, d, "labels"), processed, ["doc_id"])


def label_counts(spark, d):
    fresh = new_labels(spark, d)
    total = fr.table(spark, d, "labels").agg(F.count(F.lit(1))).scalar()
    return fresh.agg(F.count(F.lit(1)).alias("unprocessed_labels")).withColumn("all_labels", total)


def _joined(spark, d):
    """Purchases and errors as late labels of the last view of the same user."""
    e = fr.table(spark, d, "events")
    facts = e.where(F.col("event_type").isin("purchase", "error")).select(
        "user_id", "ts", "event_id", (F.col("event_type") == "purchase").cast("int").alias("label")
    )
    history = e.where("event_type = 'view'").select("user_id", "ts", F.least(F.col("value") / 100.0, F.lit(1.0)).alias("p"))
    return lab.latest_before(facts, history, ["user_id"], "ts", "p")


def labelled_predictions(spark, d):
    return _joined(spark, d)


def labelled_predictions_null_keys(spark, d):
    """The same with users and times missing on either side: no label is lost."""
    e = fr.table(spark, d, "events")
    i = F.col("event_id")
    e = e.withColumn("user_id", F.when(i % 5 > 0, F.col("user_id"))).withColumn("ts", F.when(i % 11 > 0, F.col("ts")))
    facts = e.where(F.col("event_type").isin("purchase", "error")).select("user_id", "ts", "event_id")
    history = e.where("event_type = 'view'").select("user_id", "ts", F.col("value").alias("p"))
    return lab.latest_before(facts, history, ["user_id"], "ts", "p")


def delayed_label_performance(spark, d):
    known = _joined(spark, d).where("p IS NOT NULL").withColumn("model", F.lit("live"))
    rates = metrics.rates(metrics.confusion(known, ["model"]))
    return lab.performance_gate(rates, 0.5)


def curated_set(spark, d):
    """Old training documents and newly labelled ones; a text in both keeps its new label."""
    docs = fr.table(spark, d, "documents").select("doc_id", "lang", F.md5("text").alias("text_md5"))
    rows = fr.table(spark, d, "labels").join(docs, "doc_id").select("text_md5", "doc_id", "quality", "toxic", "lang")
    old, new = rows.where("lang = 'en'"), rows.where("lang <> 'en'")
    return lab.curate(old.drop("lang"), new.drop("lang"), ["text_md5"])


QUERIES = {
    f.__name__: f for f in (new_labels, label_counts, labelled_predictions, labelled_predictions_null_keys, delayed_label_performance, curated_set)
}

_NEW = "SELECT l.doc_id, quality, toxic FROM labels l WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en')"
_JOINED = """h AS (SELECT user_id, ts, least(value / 100.0::DOUBLE, 1.0::DOUBLE) AS p FROM events WHERE event_type = 'view'),
  f AS (SELECT user_id, ts, event_id, (event_type = 'purchase')::INTEGER AS label FROM events WHERE event_type IN ('purchase', 'error')),
  joined AS (SELECT f.user_id, f.ts, event_id, label, p FROM f ASOF LEFT JOIN h ON f.user_id = h.user_id AND f.ts >= h.ts)"""

ORACLES = {
    "new_labels": _NEW,
    "label_counts": f"SELECT count(*) AS unprocessed_labels, (SELECT count(*) FROM labels) AS all_labels FROM ({_NEW})",
    "labelled_predictions": f"WITH {_JOINED} SELECT * FROM joined",
    "labelled_predictions_null_keys": """WITH e AS (SELECT event_id, event_type, value, CASE WHEN event_id % 5 > 0 THEN user_id ELSE -1 END AS u, CASE WHEN event_id % 11 > 0 THEN ts END AS ts FROM events),
        h AS (SELECT u, ts, value AS p FROM e WHERE event_type = 'view' AND ts IS NOT NULL),
        f AS (SELECT u, ts, event_id FROM e WHERE event_type IN ('purchase', 'error')),
        j AS (SELECT f.u, f.ts, event_id, p FROM (SELECT * FROM f WHERE ts IS NOT NULL) f ASOF LEFT JOIN h ON f.u = h.u AND f.ts >= h.ts
          UNION ALL SELECT u, ts, event_id, NULL FROM f WHERE ts IS NULL)
        SELECT nullif(u, -1) AS user_id, ts, event_id, p FROM j""",
    "delayed_label_performance": f"""WITH {_JOINED}, scored AS (SELECT 'live' AS model, label, p FROM joined WHERE p IS NOT NULL),
        {fr.CONFUSION_SQL.format(by='model')} SELECT model, tn, fp, fn, tp, accuracy, precision, recall, f1, f1 < 0.5::DOUBLE AS retraining_required FROM rates""",
    "curated_set": """SELECT text_md5, doc_id, quality, toxic FROM (
        SELECT md5(text) AS text_md5, doc_id, quality, toxic,
          row_number() OVER (PARTITION BY md5(text) ORDER BY lang <> 'en' DESC, doc_id DESC) AS rn
        FROM labels JOIN documents USING (doc_id)) WHERE rn = 1""",
}
