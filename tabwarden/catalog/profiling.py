"""Queries: profiles, baselines, drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwarden import fixed
from tabwarden.catalog import frames as fr
from tabwarden.functions import sizing
from tabwarden.functions.stats import psi_term
from tabwarden.operators import drift, profile, states
from tabwarden.plans import monitoring
from tabwarden.streaming import windows

LINE_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_CATEGORICAL = ["l_returnflag", "l_linestatus"]


def _rounded(df, digits, *columns):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _first_lines(spark, d):
    return fr.halves(fr.table(spark, d, "lineitem"), "l_shipdate", fr.SHIP_CUT)[0]


def _orders_report(df):
    frame = df.select("o_totalprice", "o_orderpriority", "o_orderstatus")
    return profile.baseline_report(frame, target="o_orderstatus")


def table_shape(spark, d):
    return profile.table_shape(fr.table(spark, d, "lineitem"))


def null_counts(spark, d):
    return profile.null_counts(fr.churn(spark, d))


def column_profile(spark, d):
    stored = sizing.cut_lineage(fr.churn(spark, d), "churn")  # a join that the profile would run three times
    return _rounded(profile.column_profile(stored), 6, "mean", "median")


def numeric_profile(spark, d):
    return _rounded(profile.numeric_profile(fr.table(spark, d, "lineitem"), LINE_NUMERIC), 6, "mean", "median")


def distinct_counts(spark, d):
    return profile.distinct_counts(fr.table(spark, d, "lineitem"), ["l_partkey", "l_suppkey", "l_returnflag", "l_linenumber"])


def baseline_numeric(spark, d):
    out = profile.numeric_baseline(_first_lines(spark, d), LINE_NUMERIC)
    return _rounded(out, 6, "missing_ratio", "mean", "std", *fixed.QUANTILES)


def baseline_categorical(spark, d):
    return _rounded(profile.categorical_baseline(_first_lines(spark, d), LINE_CATEGORICAL), 8, "ratio")


def baseline_target(spark, d):
    first, _ = fr.halves(fr.table(spark, d, "orders"), "o_orderdate", fr.ORDER_CUT)
    return _rounded(profile.target_baseline(first, "o_orderstatus"), 8, "ratio")


def baseline_report(spark, d):
    first, _ = fr.halves(fr.table(spark, d, "orders"), "o_orderdate", fr.ORDER_CUT)
    return _rounded(_orders_report(first), 6, "number")


def current_stats(spark, d):
    _, second = fr.halves(fr.events(spark, d), "ts", fr.EVENT_CUT)
    live = profile.placeholder_target(second, "label")
    return _rounded(profile.baseline_report(live, target="label", exclude=["event_id", "ts", "user_id"]), 6, "number")


def value_counts(spark, d):
    """Categories of a column by falling frequency."""
    lines = fr.table(spark, d, "lineitem")
    return profile.value_counts(lines, ["l_partkey"]).select("value", "n").orderBy(F.desc("n"), "value")


def psi_by_feature(spark, d):
    lines = fr.table(spark, d, "lineitem")
    late = F.col("l_shipdate") >= F.lit(fr.SHIP_CUT).cast("timestamp_ntz")
    both = drift.tagged_distribution(lines, [*LINE_CATEGORICAL, "l_linenumber"], late)
    return both.groupBy("feature").agg(F.round(F.sum(psi_term(F.col("expected"), F.col("actual"))), 4).alias("score"))


def mean_shift_by_feature(spark, d):
    """Both halves in one scan: a summary grouped by half, then a join of the two rows."""
    lines = fr.table(spark, d, "lineitem")
    late = F.col("l_shipdate") >= F.lit(fr.SHIP_CUT).cast("timestamp_ntz")
    means = profile.numeric_summary(lines.withColumn("late", late), LINE_NUMERIC, by=["late"]).select("late", "feature", "mean")
    return drift.mean_shift(means.where(~F.col("late")).drop("late"), means.where("late").drop("late"))


def _event_run(spark, d):
    first, second = fr.halves(fr.events(spark, d), "ts", fr.EVENT_CUT)
    return monitoring.compare_windows(first, second, exclude=["event_id", "ts", "user_id"])


def drift_report(spark, d):
    return _event_run(spark, d).verdicts


def drift_summary(spark, d):
    return _event_run(spark, d).summary


def drift_against_stored(spark, d):
    """Lines against a baseline that was written under its version and read back."""
    keep = [*LINE_NUMERIC, *LINE_CATEGORICAL]
    first, second = fr.halves(fr.table(spark, d, "lineitem"), "l_shipdate", fr.SHIP_CUT)
    stored = sizing.cut_lineage(profile.baseline_report(first.select(*keep), percentiles=False), "baseline")
    return monitoring.against_stored(stored, second.select(*keep)).verdicts


def missing_ratio_drift(spark, d):
    """Shares of missing cells, which the late events have more of."""
    first, second = fr.halves(fr.events(spark, d), "ts", fr.EVENT_CUT)
    i = F.col("event_id")
    second = second.withColumns({"value": F.when(i % 4 > 0, F.col("value")), "event_type": F.when(i % 25 > 0, F.col("event_type"))})
    run = monitoring.compare_windows(first, second, exclude=["event_id", "ts", "user_id"], missing_threshold=0.1)
    return run.verdicts.where("metric = 'missing_ratio_shift'")


def skipped_features(spark, d):
    """Baseline features that the live half no longer delivers."""
    first, second = fr.halves(fr.events(spark, d), "ts", fr.EVENT_CUT)
    base = profile.baseline_report(first, exclude=["event_id", "ts", "user_id"], percentiles=False)
    live = profile.baseline_report(second, exclude=["event_id", "ts", "user_id", "k"], percentiles=False)
    return drift.skipped_features(base, live)


def target_drift(spark, d):
    first, second = fr.halves(fr.table(spark, d, "orders"), "o_orderdate", fr.ORDER_CUT)
    return drift.detect(_orders_report(first), _orders_report(second), section="target")


def sliding_window_distribution(spark, d):
    stats = windows.windowed_stats(fr.table(spark, d, "events"), "ts", ["event_type"], ["value"], "7 days", "1 day")
    return _rounded(stats, 2, "total")


def window_over_window_drift(spark, d):
    stats = windows.windowed_stats(fr.table(spark, d, "events"), "ts", ["event_type"], ["value"], "1 day")
    return windows.drift_against_previous(stats, "1 DAY")


def fast_lane_summary(spark, d):
    """One row per daily window: features analysed and whether any drifted."""
    found = drift.summary(window_over_window_drift(spark, d), by=["window_start"])
    return found.select(
        "window_start", (F.col("window_start") + F.expr("INTERVAL 1 DAY")).alias("window_end"),
        F.col("total_features_evaluated").alias("features_analyzed"), "drift_detected",
    )


def _event_states(spark, d):
    """Daily states of the events, stored."""
    path = sizing.run_dir(spark, "states")
    states.store(states.daily(fr.table(spark, d, "events"), "ts", ["value"], ["event_type"]), path)
    return path


def window_from_states(spark, d):
    """Seven days put together from daily states; estimates left out."""
    state = states.merged(states.window(spark, _event_states(spark, d), "2024-01-10", "2024-01-16"))
    known = states.report(state).where(~F.col("stat").isin(*fixed.QUANTILES, "unique_values"))
    return _rounded(known, 6, "number")


def window_percentiles_refined(spark, d):
    """Percentiles of these days, bracketed by the merged sketch and settled by one scan."""
    state = states.merged(states.window(spark, _event_states(spark, d), "2024-01-10", "2024-01-16"))
    rows = fr.table(spark, d, "events").where(F.to_date("ts").between("2024-01-10", "2024-01-16"))
    return _rounded(states.refined(state, rows), 6, *fixed.QUANTILES)


def drift_from_states(spark, d):
    """Seven days against the seven before them, from states alone."""
    path = _event_states(spark, d)
    old, new = (states.report(states.merged(states.window(spark, path, a, b))) for a, b in (("2024-01-03", "2024-01-09"), ("2024-01-10", "2024-01-16")))
    return drift.detect(old, new)


QUERIES = {
    f.__name__: f
    for f in (
        table_shape, null_counts, column_profile, numeric_profile, distinct_counts, baseline_numeric, baseline_categorical,
        baseline_target, baseline_report, current_stats, value_counts, psi_by_feature, mean_shift_by_feature, drift_report,
        drift_summary, drift_against_stored, missing_ratio_drift, skipped_features, target_drift, sliding_window_distribution, window_over_window_drift, fast_lane_summary,
        window_from_states, window_percentiles_refined, drift_from_states,
    )
}


def union(parts):
    return " UNION ALL ".join(parts)


def _profile_sql(source, columns, key="\"column\""):
    return union(
        f"SELECT '{c}' AS {key}, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, round(avg({c}), 6) AS mean, "
        f"round(quantile_cont({c}::DOUBLE, 0.5), 6) AS median FROM {source}"
        for c in columns
    )


def _summary_sql(source, columns):
    q = ", ".join(f"round(quantile_cont({{c}}::DOUBLE, {p}), 6) AS {n}" for n, p in fixed.QUANTILES.items())
    return union(
        (
            f"SELECT '{c}' AS feature, round(avg(({c} IS NULL)::INT), 6) AS missing_ratio, round(avg({c}), 6) AS mean, "
            f"round(stddev_samp({c}), 6) AS std, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, " + q.format(c=c) + f" FROM {source}"
        )
        for c in columns
    )


def _shares_sql(source, columns):
    return union(
        f"SELECT '{c}' AS feature, {c}::VARCHAR AS value, count(*) AS n, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 8) AS ratio "
        f"FROM {source} GROUP BY {c}"
        for c in columns
    )


def long_numeric_sql(source, columns, stats):
    return union(
        f"SELECT 'features' AS section, '{c}' AS feature, 'numerical' AS feature_type, '{name}' AS stat, NULL::VARCHAR AS value, "
        f"round(({expr.format(c=c)})::DOUBLE, 6) AS number FROM {source}"
        for c in columns
        for name, expr in stats.items()
    )


def long_shares_sql(source, columns, section="features"):
    return union(
        f"SELECT '{section}' AS section, '{c}' AS feature, 'categorical' AS feature_type, 'ratio' AS stat, {c}::VARCHAR AS value, "
        f"round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS number FROM {source} GROUP BY {c}"
        for c in columns
    )


STATS = {
    "missing_ratio": "avg(({c} IS NULL)::INT)", "mean": "avg({c})", "std": "stddev_samp({c})", "min": "min({c})", "max": "max({c})",
    **{n: f"quantile_cont({{c}}::DOUBLE, {p})" for n, p in fixed.QUANTILES.items()},
}


def _psi_sql(columns, expected, actual):
    return union(
        f"""SELECT '{c}' AS feature, round(sum((a - e) * ln(a / e)), 4) AS score FROM (
          SELECT greatest(coalesce(x.r, 0), 1e-4::DOUBLE) AS e, greatest(coalesce(y.r, 0), 1e-4::DOUBLE) AS a
          FROM (SELECT {c} AS v, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS r FROM {expected} GROUP BY {c}) x
          FULL JOIN (SELECT {c} AS v, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS r FROM {actual} GROUP BY {c}) y
          ON x.v IS NOT DISTINCT FROM y.v)"""
        for c in columns
    )


def _shift_sql(columns, expected, actual):
    return union(
        f"""SELECT '{c}' AS feature, round(CASE WHEN e <> 0 THEN abs(a - e) / abs(e) ELSE abs(a) END, 4) AS score
          FROM (SELECT (SELECT avg({c}) FROM {expected}) AS e, (SELECT avg({c}) FROM {actual}) AS a)"""
        for c in columns
    )


def _verdict_sql(categorical, numeric, expected, actual):
    return f"""SELECT feature, 'categorical' AS type, 'psi' AS metric, score, score > 0.2 AS is_drifted FROM ({_psi_sql(categorical, expected, actual)})
      UNION ALL SELECT feature, 'numerical', 'relative_mean_shift', score, score > 0.1 FROM ({_shift_sql(numeric, expected, actual)})"""


_LINES = f"""early AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '{fr.SHIP_CUT}'),
  late AS (SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '{fr.SHIP_CUT}')"""
ORDERS = f"""early AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{fr.ORDER_CUT}'),
  late AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '{fr.ORDER_CUT}')"""
EV = f"""{fr.EVENTS_SQL}, early AS (SELECT * FROM ev WHERE ts < TIMESTAMP '{fr.EVENT_CUT}'),
  late AS (SELECT * FROM ev WHERE ts >= TIMESTAMP '{fr.EVENT_CUT}')"""
EVENT_VERDICTS = _verdict_sql(["event_type"], ["value", "k"], "early", "late")
_CHURN_TYPES = [
    ("c_custkey", "bigint", True), ("c_acctbal", "double", True), ("n_orders", "bigint", True), ("total_price", "double", True),
    ("avg_price", "double", True), ("c_mktsegment", "string", False), ("n_name", "string", False), ("last_priority", "string", False),
    ("churn", "int", True),
]


def _column_profile_sql():
    parts = []
    for c, t, numeric in _CHURN_TYPES:
        stats = (
            f"min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, round(avg({c}), 6) AS mean, round(quantile_cont({c}::DOUBLE, 0.5), 6) AS median"
            if numeric
            else "NULL::DOUBLE AS min, NULL::DOUBLE AS max, NULL::DOUBLE AS mean, NULL::DOUBLE AS median"
        )
        parts.append(
            f"SELECT '{c}' AS \"column\", '{t}' AS dtype, bool_or({c} IS NULL) AS nullable, count(DISTINCT {c}) AS unique_values, {stats} FROM churn"
        )
    return f"WITH {fr.CHURN_SQL} " + union(parts)


_LINE_TYPES = [
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"), ("l_quantity", "double"),
    ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"), ("l_linestatus", "string"),
    ("l_shipdate", "timestamp_ntz"),
]

ORACLES = {
    "table_shape": union(
        f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count(*) AS n_rows, {len(_LINE_TYPES)}::BIGINT AS n_columns FROM lineitem" for c, t in _LINE_TYPES
    ),
    "null_counts": f"WITH {fr.CHURN_SQL} "
    + union(f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls FROM churn" for c, _, _ in _CHURN_TYPES),
    "column_profile": _column_profile_sql(),
    "numeric_profile": _profile_sql("lineitem", LINE_NUMERIC),
    "distinct_counts": union(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS unique_values FROM lineitem"
        for c in ["l_partkey", "l_suppkey", "l_returnflag", "l_linenumber"]
    ),
    "baseline_numeric": f"WITH {_LINES} " + _summary_sql("early", LINE_NUMERIC),
    "baseline_categorical": f"WITH {_LINES} " + _shares_sql("early", LINE_CATEGORICAL),
    "baseline_target": f"WITH {ORDERS} " + _shares_sql("early", ["o_orderstatus"]),
    "baseline_report": f"WITH {ORDERS} "
    + union([
        long_numeric_sql("early", ["o_totalprice"], STATS),
        long_shares_sql("early", ["o_orderpriority"]),
        long_shares_sql("early", ["o_orderstatus"], "target"),
    ]),
    "current_stats": f"WITH {EV} " + union([
        long_numeric_sql("late", ["value", "k"], STATS),
        long_shares_sql("late", ["event_type"]),
        long_shares_sql("(SELECT 'Inference_Unlabelled' AS label FROM late)", ["label"], "target"),
    ]),
    "value_counts": "SELECT l_partkey::VARCHAR AS value, count(*) AS n FROM lineitem GROUP BY l_partkey",
    "psi_by_feature": f"WITH {_LINES} " + _psi_sql([*LINE_CATEGORICAL, "l_linenumber"], "early", "late"),
    "mean_shift_by_feature": f"WITH {_LINES} " + _shift_sql(LINE_NUMERIC, "early", "late"),
    "drift_report": f"WITH {EV} {EVENT_VERDICTS}",
    "drift_summary": f"""WITH {EV} SELECT count(*) AS total_features_evaluated, count(*) FILTER (is_drifted) AS drifted_features_count,
        count(*) FILTER (score IS NULL) AS features_not_judged, bool_or(is_drifted) AS drift_detected FROM ({EVENT_VERDICTS})""",
    "drift_against_stored": f"WITH {_LINES} " + _verdict_sql(LINE_CATEGORICAL, LINE_NUMERIC, "early", "late"),
    "missing_ratio_drift": f"""WITH {fr.EVENTS_SQL},
        m AS (SELECT ts >= TIMESTAMP '{fr.EVENT_CUT}' AS late, CASE WHEN ts < TIMESTAMP '{fr.EVENT_CUT}' OR event_id % 4 > 0 THEN value END AS value,
            CASE WHEN ts < TIMESTAMP '{fr.EVENT_CUT}' OR event_id % 25 > 0 THEN event_type END AS event_type, k FROM ev),
        r AS (SELECT late, avg((value IS NULL)::INT) AS v, avg((event_type IS NULL)::INT) AS t, avg((k IS NULL)::INT) AS k FROM m GROUP BY late),
        s AS (SELECT abs(b.v - a.v) AS v, abs(b.t - a.t) AS t, abs(b.k - a.k) AS k FROM r a, r b WHERE NOT a.late AND b.late)
        SELECT 'value' AS feature, 'numerical' AS type, 'missing_ratio_shift' AS metric, round(v, 4) AS score, round(v, 4) > 0.1 AS is_drifted FROM s
        UNION ALL SELECT 'event_type', 'categorical', 'missing_ratio_shift', round(t, 4), round(t, 4) > 0.1 FROM s
        UNION ALL SELECT 'k', 'numerical', 'missing_ratio_shift', round(k, 4), round(k, 4) > 0.1 FROM s""",
    "skipped_features": "SELECT 'k' AS feature FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL GROUP BY 1",
    "target_drift": f"""WITH {ORDERS} SELECT feature, 'categorical' AS type, 'psi' AS metric, score, score > 0.2 AS is_drifted
        FROM ({_psi_sql(["o_orderstatus"], "early", "late")})""",
    "sliding_window_distribution": """WITH w AS (
          SELECT date_trunc('day', ts)::TIMESTAMP - to_days(i::INT) AS window_start, event_type, value FROM events, range(7) AS r(i)),
        s AS (SELECT window_start, 'event_type' AS feature, false AS "numeric", event_type AS value, count(*) AS n, NULL::DOUBLE AS total FROM w GROUP BY ALL
          UNION ALL SELECT window_start, 'value', true, NULL, count(value), round(sum(value), 2) FROM w GROUP BY window_start)
        SELECT window_start, window_start + INTERVAL 7 DAY AS window_end, feature, "numeric", value, n, total FROM s""",
    "window_over_window_drift": """WITH day AS (SELECT date_trunc('day', ts)::TIMESTAMP AS d, event_type, value FROM events),
        share AS (SELECT d, event_type, count(*) / CAST(sum(count(*)) OVER (PARTITION BY d) AS DOUBLE) AS r FROM day GROUP BY d, event_type),
        psi AS (SELECT d, round(sum((a - e) * ln(a / e)), 4) AS score FROM (
            SELECT coalesce(y.d, x.d + INTERVAL 1 DAY) AS d, greatest(coalesce(x.r, 0), 1e-4::DOUBLE) AS e, greatest(coalesce(y.r, 0), 1e-4::DOUBLE) AS a
            FROM share x FULL JOIN share y ON y.d = x.d + INTERVAL 1 DAY AND x.event_type = y.event_type)
          WHERE d IN (SELECT d FROM share) AND d - INTERVAL 1 DAY IN (SELECT d FROM share) GROUP BY d),
        m AS (SELECT d, avg(value) AS m FROM day GROUP BY d),
        shift AS (SELECT y.d, round(CASE WHEN x.m <> 0 THEN abs(y.m - x.m) / abs(x.m) ELSE abs(y.m) END, 4) AS score
          FROM m y JOIN m x ON x.d = y.d - INTERVAL 1 DAY)
        SELECT d AS window_start, 'event_type' AS feature, 'categorical' AS type, 'psi' AS metric, score, score > 0.2 AS is_drifted FROM psi
        UNION ALL SELECT d, 'value', 'numerical', 'relative_mean_shift', score, score > 0.1 FROM shift""",
}

ORACLES["fast_lane_summary"] = f"""SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, count(*) AS features_analyzed,
    bool_or(is_drifted) AS drift_detected FROM ({ORACLES["window_over_window_drift"]}) GROUP BY window_start"""

_DAYS = "e AS (SELECT event_type, value FROM events WHERE ts::DATE BETWEEN DATE '{}' AND DATE '{}')"
ORACLES["window_from_states"] = f"""WITH {_DAYS.format("2024-01-10", "2024-01-16")}, s AS (
        SELECT avg((value IS NULL)::INT)::DOUBLE AS missing_ratio, avg(value) AS mean, stddev_samp(value) AS std, min(value)::DOUBLE AS min, max(value)::DOUBLE AS max FROM e),
      u AS (UNPIVOT s ON missing_ratio, mean, std, min, max INTO NAME stat VALUE number)
    SELECT 'features' AS section, 'value' AS feature, 'numerical' AS feature_type, stat, NULL::VARCHAR AS value, round(number, 6) AS number FROM u
    UNION ALL SELECT 'features', 'event_type', 'categorical', 'ratio', event_type, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) FROM e GROUP BY event_type"""
ORACLES["window_percentiles_refined"] = (
    f"WITH {_DAYS.format('2024-01-10', '2024-01-16')} SELECT 'value' AS feature, "
    + ", ".join(f"round(quantile_cont(value::DOUBLE, {p}), 6) AS {n}" for n, p in fixed.QUANTILES.items())
    + " FROM e"
)
ORACLES["drift_from_states"] = f"""WITH {_DAYS.format("2024-01-03", "2024-01-09").replace("e AS", "old AS")}, {_DAYS.format("2024-01-10", "2024-01-16").replace("e AS", "new AS")},
      x AS (SELECT event_type, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS r FROM old GROUP BY event_type),
      y AS (SELECT event_type, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS r FROM new GROUP BY event_type),
      p AS (SELECT round(sum((a - e) * ln(a / e)), 4) AS score FROM (
        SELECT greatest(coalesce(x.r, 0), 1e-4::DOUBLE) AS e, greatest(coalesce(y.r, 0), 1e-4::DOUBLE) AS a FROM x FULL JOIN y USING (event_type))),
      m AS (SELECT round(CASE WHEN e <> 0 THEN abs(a - e) / abs(e) ELSE abs(a) END, 4) AS score FROM (SELECT avg(value) AS e FROM old), (SELECT avg(value) AS a FROM new))
    SELECT 'event_type' AS feature, 'categorical' AS type, 'psi' AS metric, score, score > 0.2 AS is_drifted FROM p
    UNION ALL SELECT 'value', 'numerical', 'relative_mean_shift', score, score > 0.1 FROM m"""
