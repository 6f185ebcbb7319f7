"""Queries: registry, triggers, lineage of ingest and transformation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwarden.catalog import frames as fr
from tabwarden.catalog import profiling
from tabwarden.functions import sizing
from tabwarden.functions.stats import mean_shift
from tabwarden.operators import clean, encode, lineage, profile, registry, split, trigger
from tabwarden.plans import monitoring
from tabwarden.sources import claims


def _registry(spark, d):
    """A registry made of the orders: one name per priority, one version per month.

    A month is promoted if more than a third of its orders are finished.
    """
    month = F.date_trunc("MONTH", "o_orderdate").cast("timestamp_ntz")
    number = (F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate")
    rows = fr.table(spark, d, "orders").groupBy(
        F.col("o_orderpriority").alias("name"), F.concat(F.lit("v"), number.cast("string")).alias("version"), month.alias("registered_at")
    ).agg((F.count_if(F.col("o_orderstatus") == "F") * 3 > F.count(F.lit(1))).alias("promoted"), F.count(F.lit(1)).alias("n_samples"))
    folder = F.concat(F.lit("./registry/"), "name", F.lit("/"), "version")
    return rows.select(
        "name", "version", "promoted", "registered_at", "n_samples",
        F.concat(folder, F.lit("/model")).alias("model_path"),
        F.concat(folder, F.lit("/baseline")).alias("baseline_path"),
        F.concat(folder, F.lit("/metrics")).alias("metrics_path"),
        F.lit(None).cast("string").alias("checksum"),
    )


def registry_next_version(spark, d):
    """Next version of every priority and of every market segment, which has none yet."""
    names = fr.table(spark, d, "orders").select(F.col("o_orderpriority").alias("name")).union(
        fr.table(spark, d, "customer").select("c_mktsegment")
    )
    return registry.next_version(_registry(spark, d), names)


def registry_pointer(spark, d):
    return registry.pointer(_registry(spark, d))


def registry_version_artifacts(spark, d):
    """Pointers resolved to their artifacts; versions of one priority lost their metadata."""
    rows = _registry(spark, d)
    versions = rows.where(F.col("name") != "5-LOW")
    return registry.resolve(registry.pointer(rows), versions, "model_path", "baseline_path", "metrics_path", "n_samples")


def registry_register(spark, d):
    """Approved segments are appended to a stored registry, read back with their pointers."""
    path = sizing.run_dir(spark, "registry")
    columns = [f.name for f in registry.SCHEMA.fields]
    registry.append(path, registry.empty(spark))
    registry.append(path, _registry(spark, d).select(*columns))
    stored = spark.read.schema(registry.SCHEMA).parquet(path)
    decisions = (
        fr.table(spark, d, "customer").groupBy(F.col("c_mktsegment").alias("segment"))
        .agg((F.avg("c_acctbal") > 4500).alias("approved"))
        .withColumn("name", F.when(F.col("segment") == "BUILDING", "1-URGENT").otherwise(F.col("segment")))
        .select(
            "name", "approved", F.lit("2002-01-01 00:00:00").cast("timestamp_ntz").alias("registered_at"),
            *[F.lit(None).cast("string").alias(c) for c in ("model_path", "baseline_path", "metrics_path", "checksum")],
        )
    )
    registry.append(path, sizing.cut_lineage(registry.register(stored, decisions).select(*columns), "rows"))
    return registry.pointer(spark.read.schema(registry.SCHEMA).parquet(path))


def registry_stored_baseline(spark, d):
    """Baselines of two versions stored; the one behind the pointer comes back."""
    path = sizing.run_dir(spark, "baselines")
    halves = fr.halves(fr.table(spark, d, "orders"), "o_orderdate", fr.ORDER_CUT)
    for version, rows in zip(("v1", "v2"), halves):
        frame = rows.select("o_totalprice", "o_orderpriority", "o_orderstatus")
        registry.store_artifact(profile.baseline_report(frame, target="o_orderstatus", percentiles=False), path, "orders", version)
    versions = fr.table(spark, d, "orders").select(
        F.lit("orders").alias("name"),
        F.when(F.col("o_orderdate") < F.lit(fr.ORDER_CUT).cast("timestamp_ntz"), "v1").otherwise("v2").alias("version"),
        F.lit(True).alias("promoted"), F.col("o_orderdate").alias("registered_at"),
    )
    return registry.load_artifact(path, registry.pointer(versions)).withColumn("number", F.round("number", 6))


STEP = "6 hours"


def verdict_history(spark, d):
    """Drift verdict per event type and six-hour window: mean value against the overall mean."""
    e = fr.table(spark, d, "events")
    overall = e.groupBy("event_type").agg(F.avg("value").alias("expected"))
    per = e.groupBy("event_type", F.window("ts", STEP)["start"].alias("at")).agg(F.avg("value").alias("actual"))
    return per.join(overall, "event_type").select(
        F.col("event_type").alias("monitor"), "at", (F.round(mean_shift(F.col("expected"), F.col("actual")), 4) > 0.1).alias("drifted")
    )


def registry_claims(spark, d):
    """A version claimed by each of two writers for every order priority."""
    path = sizing.run_dir(spark, "claims")
    names = [r[0] for r in fr.table(spark, d, "orders").select("o_orderpriority").distinct().collect()]  # a few models
    rows = [(n, claims.claim_version(spark, path, n, owner)) for owner in ("one", "two") for n in names]
    return spark.createDataFrame(rows, "name string, version string")


def trigger_cooldown(spark, d):
    return trigger.replay(verdict_history(spark, d), ["monitor"])


def trigger_decide(spark, d):
    """The last verdict of every monitor against stored trigger times."""
    verdicts = verdict_history(spark, d)
    latest = verdicts.groupBy("monitor").agg(F.max(F.struct("at", "drifted")).alias("l")).select("monitor", "l.*")
    before = verdicts.where("drifted").join(latest.select("monitor", F.col("at").alias("now")), "monitor").where("at < now")
    state = before.groupBy("monitor").agg(F.max("at").alias("last_trigger"))
    return trigger.decide(latest, state, ["monitor"], days=2)


def monitoring_decision(spark, d):
    """Whole monitoring run over events: drift summary, trigger table, decision."""
    first, second = fr.halves(fr.events(spark, d), "ts", fr.EVENT_CUT)
    run = monitoring.compare_windows(first, second, exclude=["event_id", "ts", "user_id"], shift_threshold=0.001)
    fired = fr.table(spark, d, "events").where("event_type = 'error'").select(F.col("ts").alias("fired_at"))
    return monitoring.decide(run.summary, fired, "2024-01-31 12:00:00")


def lineage_ingest(spark, d):
    """Orders without their id, duplicates removed, split by status: the whole lineage row set."""
    raw = fr.table(spark, d, "orders").select(*fr.ORDER_COLUMNS)
    columns = [c for c in fr.ORDER_COLUMNS if c != "o_orderkey"]
    cleaned = sizing.cut_lineage(clean.distinct_rows(raw.drop("o_orderkey")), "cleaned")
    parts = split.stratified_split(cleaned, "o_orderstatus", columns)
    return lineage.ingestion(raw, parts, "split", columns, "o_orderstatus")


def lineage_transform(spark, d):
    frame = fr.churn(spark, d)
    widths = encode.cardinality(encode.fit_categories(frame, fr.CATEGORICAL))
    return lineage.transformation(frame, fr.NUMERIC, fr.CATEGORICAL, widths)


QUERIES = {
    f.__name__: f
    for f in (
        registry_next_version, registry_pointer, registry_version_artifacts, registry_register, registry_stored_baseline, registry_claims, trigger_cooldown, trigger_decide,
        monitoring_decision, lineage_ingest, lineage_transform,
    )
}

_REG = """reg AS (
  SELECT o_orderpriority AS name, (year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS num,
         date_trunc('month', o_orderdate)::TIMESTAMP AS registered_at, count(*) FILTER (o_orderstatus = 'F') * 3 > count(*) AS promoted, count(*) AS n_samples
  FROM orders GROUP BY ALL)"""
HISTORY_SQL = """history AS (
  SELECT event_type AS monitor, "at", round(CASE WHEN e <> 0 THEN abs(a - e) / abs(e) ELSE abs(a) END, 4) > 0.1 AS drifted
  FROM (SELECT event_type, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS "at", avg(value) AS a FROM events GROUP BY ALL)
  JOIN (SELECT event_type, avg(value) AS e FROM events GROUP BY event_type) USING (event_type))"""
FIRES_SQL = """fires AS (
  SELECT monitor, min("at") AS "at" FROM history WHERE drifted GROUP BY monitor
  UNION ALL
  SELECT f.monitor, min(h."at") FROM fires f JOIN history h ON h.monitor = f.monitor AND h.drifted AND h."at" >= f."at" + INTERVAL 1 DAY GROUP BY f.monitor, f."at")"""

ORACLES = {
    "registry_stored_baseline": f"""WITH {profiling.ORDERS}, b AS ({profiling.union([
        profiling.long_numeric_sql("late", ["o_totalprice"], {k: v for k, v in profiling.STATS.items() if not k.startswith("p")}),
        profiling.long_shares_sql("late", ["o_orderpriority"]),
        profiling.long_shares_sql("late", ["o_orderstatus"], "target")])})
        SELECT 'orders' AS name, 'v2' AS version, * FROM b""",
    "registry_next_version": f"""WITH {_REG}, names AS (SELECT DISTINCT o_orderpriority AS name FROM orders UNION SELECT c_mktsegment FROM customer)
        SELECT name, 'v' || (coalesce(max(num), 0) + 1)::VARCHAR AS next_version FROM names LEFT JOIN reg USING (name) GROUP BY name""",
    "registry_pointer": f"WITH {_REG} SELECT name, 'v' || max(num)::VARCHAR AS version FROM reg WHERE promoted GROUP BY name",
    "registry_version_artifacts": f"""WITH {_REG}, p AS (SELECT name, max(num) AS num FROM reg WHERE promoted GROUP BY name)
        SELECT name, 'v' || num::VARCHAR AS version, name <> '5-LOW' AS resolved, CASE WHEN name <> '5-LOW' THEN n_samples END AS n_samples,
          CASE WHEN name <> '5-LOW' THEN 'registry/' || name || '/v' || num::VARCHAR || '/model' END AS model_path,
          CASE WHEN name <> '5-LOW' THEN 'registry/' || name || '/v' || num::VARCHAR || '/baseline' END AS baseline_path,
          CASE WHEN name <> '5-LOW' THEN 'registry/' || name || '/v' || num::VARCHAR || '/metrics' END AS metrics_path
        FROM p JOIN reg USING (name, num)""",
    "registry_register": f"""WITH {_REG}, a AS (
          SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN '1-URGENT' ELSE c_mktsegment END AS name FROM customer GROUP BY c_mktsegment HAVING avg(c_acctbal) > 4500)
        SELECT name, 'v' || num::VARCHAR AS version FROM (
          SELECT name, max(num) AS num FROM reg WHERE promoted AND name NOT IN (SELECT name FROM a) GROUP BY name
          UNION ALL SELECT name, coalesce((SELECT max(num) FROM reg r WHERE r.name = a.name), 0) + 1 FROM a)""",
    "registry_claims": "SELECT DISTINCT o_orderpriority AS name, version FROM orders, (VALUES ('v1'), ('v2')) AS t(version)",
    "trigger_cooldown": f"""WITH RECURSIVE {HISTORY_SQL}, {FIRES_SQL}
        SELECT monitor, h."at", drifted, CASE WHEN NOT drifted THEN 'healthy' WHEN f."at" IS NULL THEN 'suppressed' ELSE 'fire' END AS action,
          CASE WHEN drifted AND f."at" IS NOT NULL THEN 'Data Drift Detected' END AS reason
        FROM history h LEFT JOIN (SELECT DISTINCT monitor, "at" FROM fires) f USING (monitor, "at")""",
    "trigger_decide": f"""WITH {HISTORY_SQL}, latest AS (SELECT monitor, max("at") AS "at", arg_max(drifted, "at") AS drifted FROM history GROUP BY monitor),
        state AS (SELECT h.monitor, max(h."at") AS last_trigger FROM history h JOIN latest l ON h.monitor = l.monitor AND h."at" < l."at" WHERE h.drifted GROUP BY h.monitor)
        SELECT monitor, "at", drifted, last_trigger, CASE WHEN NOT drifted THEN 'healthy' WHEN "at" < last_trigger + INTERVAL 2 DAY THEN 'suppressed' ELSE 'fire' END AS action
        FROM latest LEFT JOIN state USING (monitor)""",
    "monitoring_decision": f"""WITH {profiling.EV}, v AS (SELECT score > CASE type WHEN 'numerical' THEN 0.001 ELSE 0.2 END AS is_drifted FROM ({profiling.EVENT_VERDICTS}))
        SELECT count(*) AS total_features_evaluated, count(*) FILTER (is_drifted) AS drifted_features_count, 0::BIGINT AS features_not_judged, bool_or(is_drifted) AS drift_detected,
          (SELECT max(ts) FROM events WHERE event_type = 'error') AS last_trigger,
          CASE WHEN NOT bool_or(is_drifted) THEN 'healthy'
               WHEN TIMESTAMP '2024-01-31 12:00:00' < (SELECT max(ts) FROM events WHERE event_type = 'error') + INTERVAL 1 DAY THEN 'suppressed' ELSE 'fire' END AS action
        FROM v""",
    "lineage_ingest": f"""WITH c AS (SELECT DISTINCT {', '.join(fr.ORDER_COLUMNS[1:])} FROM orders),
        r AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5('42|' || {" || '|' || ".join(c + '::VARCHAR' for c in fr.ORDER_COLUMNS[1:])})) - 1 AS r,
                count(*) OVER (PARTITION BY o_orderstatus) AS n FROM c),
        parts AS (SELECT CASE WHEN r < n * 70 // 100 THEN 'train' WHEN r < n * 85 // 100 THEN 'validation' ELSE 'test' END AS dataset, o_orderstatus,
                {fr.row_hash_sql(fr.ORDER_COLUMNS[1:])} AS h FROM r),
        per_class AS (SELECT dataset, o_orderstatus, count(*) AS n FROM parts GROUP BY ALL),
        classes AS (SELECT dataset, list(o_orderstatus || '=' || n::VARCHAR ORDER BY o_orderstatus) AS target_counts FROM per_class GROUP BY dataset
          UNION ALL SELECT 'cleaned', list(o_orderstatus || '=' || n::VARCHAR ORDER BY o_orderstatus)
            FROM (SELECT o_orderstatus, CAST(sum(n) AS BIGINT) AS n FROM per_class GROUP BY o_orderstatus)),
        found AS (SELECT 'raw' AS dataset, {fr.HASH_SUMS_SQL}, NULL::DOUBLE AS ratio FROM (SELECT {fr.row_hash_sql(fr.ORDER_COLUMNS)} AS h FROM orders)
        UNION ALL SELECT 'cleaned', {fr.HASH_SUMS_SQL}, NULL FROM parts
        UNION ALL SELECT dataset, {fr.HASH_SUMS_SQL}, round(count(*) / CAST((SELECT count(*) FROM parts) AS DOUBLE), 4) FROM parts GROUP BY dataset)
        SELECT * FROM found LEFT JOIN classes USING (dataset)""",
    "lineage_transform": f"""WITH {fr.CHURN_SQL}, w AS (SELECT count(DISTINCT c_mktsegment) + count(DISTINCT n_name) + count(DISTINCT last_priority) AS t FROM churn)
        SELECT {fr.HASH_SUMS_SQL}, 4 AS numeric_features, 3 AS categorical_features, max(t) + 1 AS linear_width, max(t) + 4 AS tree_width
        FROM (SELECT {fr.row_hash_sql([*fr.NUMERIC, *fr.CATEGORICAL])} AS h FROM churn), w""",
}
