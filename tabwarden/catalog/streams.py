"""Queries that run a stream to the end of the given events and return what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwarden.catalog import frames as fr
from tabwarden.catalog import profiling
from tabwarden.catalog.lifecycle import FIRES_SQL, HISTORY_SQL, verdict_history
from tabwarden.functions import sizing
from tabwarden.operators import profile
from tabwarden.operators.clean import CleanSpec
from tabwarden.operators.contract import from_dict
from tabwarden.streaming import jobs, windows

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
DELAY = "1 hour"

EVENT_CONTRACT = from_dict(
    {
        "columns": {
            "event_id": {"required": True, "nullable": False},
            "event_type": {"required": True, "nullable": False, "allowed_values": ["view", "click", "purchase", "signup"]},
            "value": {"nullable": False, "min": 1.0, "max": 200.0},
        }
    }
)


def _stream(spark, d):
    return spark.readStream.schema(EVENT_SCHEMA).parquet(f"{d}/events.parquet*")  # one file or a folder of parts


def stream_windows(spark, d):
    """Statistics of closed daily windows, each written once."""
    out, checkpoint = jobs.folders(fr.table(spark, d, "events"), "windows")
    jobs.run_to_end(
        jobs.window_stats_job(_stream(spark, d), "ts", ["event_type"], ["value"], "1 day", None, DELAY, out, checkpoint)
    )
    stats = spark.read.option("basePath", out).parquet(f"{out}/batch=*").drop("batch")
    return stats.withColumn("total", F.round("total", 2))


def stream_drift(spark, d):
    """Closed sliding windows judged against the first half of the events."""
    first, _ = fr.halves(fr.table(spark, d, "events"), "ts", fr.EVENT_CUT)
    shares = sizing.cut_lineage(profile.value_distribution(first, ["event_type"]), "shares")
    means = sizing.cut_lineage(profile.numeric_summary(first, ["value"]), "means")
    out, checkpoint = jobs.folders(first, "drift")
    jobs.run_to_end(
        jobs.drift_job(
            _stream(spark, d), "ts", shares, means, ["event_type"], ["value"], "7 days", "1 day", DELAY, out, checkpoint
        )
    )
    return spark.read.option("basePath", out).parquet(f"{out}/batch=*").drop("batch")


def stream_window_drift(spark, d):
    """Closed daily windows, each judged against the day before it."""
    out, checkpoint = jobs.folders(fr.table(spark, d, "events"), "window-drift")
    jobs.run_to_end(
        jobs.window_drift_job(_stream(spark, d), "ts", ["event_type"], ["value"], "1 day", None, "1 DAY", DELAY, out, f"{checkpoint}-state", checkpoint)
    )
    return spark.read.option("basePath", out).parquet(f"{out}/batch=*").drop("batch")


def stream_labelled_predictions(spark, d):
    """Purchases and errors as late labels of the last view of the same user within a day."""
    kinds = F.col("event_type")
    facts = _stream(spark, d).where(kinds.isin("purchase", "error")).select("user_id", "ts", "event_id", (kinds == "purchase").cast("int").alias("label"))
    views = _stream(spark, d).where(kinds == "view").select("user_id", "ts", F.least(F.col("value") / 100.0, F.lit(1.0)).alias("p"))
    out, checkpoint = jobs.folders(fr.table(spark, d, "events"), "labelled")
    joined = jobs.labelled_predictions(facts, views, ["user_id"], "ts", "p", "1 DAY", DELAY)
    jobs.run_to_end(jobs.append_job(joined, out, checkpoint))
    return spark.read.option("basePath", out).parquet(f"{out}/batch=*").drop("batch")


def stream_unmatched_labels(spark, d):
    """Labels of either class that found no prediction."""
    return stream_labelled_predictions(spark, d).groupBy("label").agg(F.count(F.lit(1)).alias("n_labels"), F.count_if(~F.col("matched")).alias("n_unmatched"))


def stream_logged_once(spark, d):
    """Events that are delivered in order of time in three files, and a fourth time in part: each is logged once."""
    path, events = sizing.run_dir(spark, "deliveries"), fr.table(spark, d, "events").drop("props")
    third = F.dayofmonth("ts") % 31 / 11
    for part in (third < 1, (third >= 1) & (third < 2), third >= 2, F.col("event_id") % 3 == 0):
        events.where(part).coalesce(1).write.mode("append").parquet(path)
    out, checkpoint = jobs.folders(events, "once")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)
    jobs.run_to_end(jobs.append_job(jobs.once(stream, ["event_id"], "ts", "60 days"), out, checkpoint))
    return spark.read.option("basePath", out).parquet(f"{out}/batch=*").select("event_id", "ts", "user_id")


def stream_score_dlq(spark, d):
    """Micro-batches validated and scored by a formula; both branches side by side."""
    base = sizing.run_dir(spark, "stream-scoring")
    jobs.run_to_end(
        jobs.scoring_job(
            _stream(spark, d).drop("props"), EVENT_CONTRACT, CleanSpec(), lambda df: df.withColumn("p", F.col("value") / 200.0),
            f"{base}/scored", f"{base}/dead", f"{base}/checkpoint", allowed_values=True,
        )
    )
    scored = spark.read.parquet(f"{base}/scored/batch=*").select("event_id", F.lit("scored").alias("branch"), F.lit(0).alias("n_errors"))
    dead = spark.read.parquet(f"{base}/dead/batch=*").select("event_id", F.lit("dead").alias("branch"), F.size("errors").alias("n_errors"))
    return scored.unionByName(dead)


def stream_cooldown(spark, d):
    """The verdict history as a stream through the cooldown: healthy verdicts, and drift that the watermark has passed."""
    verdicts = verdict_history(spark, d)
    path = sizing.run_dir(spark, "verdicts")
    verdicts.write.parquet(path)
    stream = spark.readStream.schema(verdicts.schema).parquet(path)
    out, checkpoint = jobs.folders(verdicts, "cooldown")
    jobs.run_to_end(jobs.append_job(jobs.cooldown_actions(stream, "monitor", "at", "drifted", DELAY), out, checkpoint, rocksdb=True))
    return spark.read.parquet(f"{out}/batch=*").withColumn("at", windows.wall_time(F.col("at")))


QUERIES = {f.__name__: f for f in (stream_windows, stream_drift, stream_score_dlq, stream_cooldown, stream_logged_once, stream_window_drift, stream_labelled_predictions, stream_unmatched_labels)}

_LABELLED = """l AS (SELECT user_id, ts, event_id, (event_type = 'purchase')::INTEGER AS label FROM events WHERE event_type IN ('purchase', 'error')),
  v AS (SELECT user_id, ts, least(value / 100.0::DOUBLE, 1.0::DOUBLE) AS p FROM events WHERE event_type = 'view'),
  joined AS (SELECT l.*, arg_max(v.p, v.ts) AS p, count(v.ts) > 0 AS matched FROM l LEFT JOIN v ON l.user_id = v.user_id AND v.ts <= l.ts AND v.ts >= l.ts - INTERVAL 1 DAY GROUP BY ALL),
  closed AS (SELECT * FROM joined WHERE ts <= least((SELECT max(ts) FROM l), (SELECT max(ts) FROM v)) - INTERVAL 1 HOUR - INTERVAL 1 DAY)"""
_CLOSED = "window_start + INTERVAL {size} DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"

ORACLES = {
    "stream_windows": f"""WITH w AS (SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, event_type, value FROM events),
        s AS (SELECT window_start, 'event_type' AS feature, false AS "numeric", event_type AS value, count(*) AS n, NULL::DOUBLE AS total FROM w GROUP BY ALL
          UNION ALL SELECT window_start, 'value', true, NULL, count(value), round(sum(value), 2) FROM w GROUP BY window_start)
        SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, feature, "numeric", value, n, total FROM s WHERE {_CLOSED.format(size=1)}""",
    "stream_drift": f"""WITH w AS (SELECT date_trunc('day', ts)::TIMESTAMP - to_days(i::INT) AS window_start, event_type, value FROM events, range(7) AS r(i)),
        closed AS (SELECT * FROM w WHERE {_CLOSED.format(size=7)}),
        early AS (SELECT * FROM events WHERE ts < TIMESTAMP '{fr.EVENT_CUT}'),
        base AS (SELECT event_type, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS r FROM early GROUP BY event_type),
        share AS (SELECT window_start, event_type, count(*) / CAST(sum(count(*)) OVER (PARTITION BY window_start) AS DOUBLE) AS r FROM closed GROUP BY window_start, event_type),
        grid AS (SELECT window_start, event_type FROM (SELECT DISTINCT window_start FROM closed), (SELECT event_type FROM base UNION SELECT event_type FROM share)),
        psi AS (SELECT window_start, round(sum((a - e) * ln(a / e)), 4) AS score FROM (
            SELECT g.window_start, greatest(coalesce(b.r, 0), 1e-4::DOUBLE) AS e, greatest(coalesce(s.r, 0), 1e-4::DOUBLE) AS a
            FROM grid g LEFT JOIN base b USING (event_type) LEFT JOIN share s USING (window_start, event_type)
            WHERE b.r IS NOT NULL OR s.r IS NOT NULL) GROUP BY window_start),
        shift AS (SELECT window_start, round(CASE WHEN e <> 0 THEN abs(a - e) / abs(e) ELSE abs(a) END, 4) AS score
            FROM (SELECT window_start, avg(value) AS a FROM closed GROUP BY window_start), (SELECT avg(value) AS e FROM early))
        SELECT window_start, 'event_type' AS feature, 'categorical' AS type, 'psi' AS metric, score, score > 0.2 AS is_drifted FROM psi
        UNION ALL SELECT window_start, 'value', 'numerical', 'relative_mean_shift', score, score > 0.1 FROM shift""",
    "stream_score_dlq": """WITH e AS (SELECT event_id, ((value < 1)::INT + (value > 200)::INT + (event_type = 'error')::INT)::INTEGER AS n_errors FROM events)
        SELECT event_id, CASE WHEN n_errors = 0 THEN 'scored' ELSE 'dead' END AS branch, n_errors FROM e""",
    "stream_logged_once": "SELECT event_id, ts, user_id FROM events",
    "stream_window_drift": f"SELECT * FROM ({profiling.ORACLES['window_over_window_drift']}) WHERE {_CLOSED.format(size=1)}",
    "stream_labelled_predictions": f"WITH {_LABELLED} SELECT * FROM closed",
    "stream_unmatched_labels": f"WITH {_LABELLED} SELECT label, count(*) AS n_labels, count(*) FILTER (NOT matched) AS n_unmatched FROM closed GROUP BY label",
    "stream_cooldown": f"""WITH RECURSIVE {HISTORY_SQL}, {FIRES_SQL}
        SELECT monitor, h."at", CASE WHEN NOT drifted THEN 'healthy' WHEN f."at" IS NULL THEN 'suppressed' ELSE 'fire' END AS action
        FROM history h LEFT JOIN (SELECT DISTINCT monitor, "at" FROM fires) f USING (monitor, "at")
        WHERE NOT drifted OR h."at" <= (SELECT max("at") FROM history) - INTERVAL 1 HOUR""",
}
