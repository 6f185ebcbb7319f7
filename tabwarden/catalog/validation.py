"""Queries: contract checks, row rules, scoring batches with dead letters."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwarden.catalog import frames as fr
from tabwarden.functions import sizing
from tabwarden.operators import contract, profile, rules, score
from tabwarden.operators import clean as cleaning
from tabwarden.plans import scoring
from tabwarden.sources import readers, writers

CHURN_CONTRACT = contract.from_dict(
    {
        "enforcement_mode": "strict",
        "dataset": {"target_column": "churn"},
        "dataset_constraints": {
            "min_rows": 1000,
            "max_missing_ratio": 0.05,
            "expected_feature_count": 9,
            "target_distribution": {"allowed_range": {0: [0.60, 0.90], 1: [0.10, 0.42]}},
        },
        "dtype_mapping": {"string": ["object", "string"], "integer": ["int64", "int32"], "floating": ["float64", "float32"]},
        "columns": {
            "c_acctbal": {"expected_dtype": "floating", "required": True, "nullable": False, "min": 100.0, "max": 5000.0, "severity": "warning"},
            "n_orders": {"expected_dtype": "floating", "required": True, "nullable": False, "min": 0, "severity": "error"},
            "total_price": {"expected_dtype": "floating", "nullable": False, "min": 0.0, "severity": "error"},
            "avg_price": {"expected_dtype": "floating", "nullable": False, "min": 50000.0, "max": 1000000.0, "severity": "error"},
            "c_mktsegment": {"expected_dtype": "string", "required": True, "nullable": False, "severity": "warning"},
            "n_name": {"expected_dtype": "string", "nullable": False, "severity": "warning"},
            "tenure": {"expected_dtype": "integer", "required": True, "nullable": False, "severity": "error"},
            "phone": {"expected_dtype": "string", "nullable": True, "severity": "warning"},
            "churn": {"expected_dtype": "integer", "nullable": False, "severity": "error"},
        },
    }
)

ASOF = "2024-01-31 00:00:00"


def _checks(spark, d):
    stored = sizing.cut_lineage(fr.churn(spark, d), "churn")
    return contract.check_profile(profile.column_profile(stored), CHURN_CONTRACT)


def contract_check(spark, d):
    return _checks(spark, d).withColumn("details", F.concat_ws("; ", "details"))


def contract_summary(spark, d):
    return contract.summarize(_checks(spark, d))


def dataset_constraints(spark, d):
    return contract.check_dataset(fr.churn(spark, d), CHURN_CONTRACT).withColumn("observed", F.round("observed", 6))


def _annotated(spark, d):
    cleaned = cleaning.clean(fr.dirty(spark, d).drop("source_note"), fr.DIRTY_SPEC, "score")
    return rules.annotate(cleaned, fr.BATCH_CONTRACT, allowed_values=True)


def row_violations(spark, d):
    return rules.error_details(_annotated(spark, d), ["customer_id"])


def valid_rows(spark, d):
    return rules.valid_rows(_annotated(spark, d))


def dlq_rows(spark, d):
    rejected = rules.invalid_rows(_annotated(spark, d))
    reasons = F.concat_ws("; ", F.array_sort(F.transform("errors", lambda e: e["error_reason"])))
    return rejected.select("customer_id", F.size("errors").alias("n_errors"), reasons.alias("reasons"))


def batch_summary(spark, d):
    return rules.batch_summary(_annotated(spark, d))


def _formula(df):
    """A fixed score in place of a model."""
    return df.withColumn("p", F.col("balance") / 8191.0)


def _logged(spark, d):
    base = sizing.run_dir(spark, "scoring")
    features = ["segment", "balance", "senior"]
    scoring.run(
        fr.dirty(spark, d).drop("source_note"), fr.BATCH_CONTRACT, fr.DIRTY_SPEC, _formula,
        F.lit("req-1"), F.lit("v1"), F.lit(ASOF).cast("timestamp_ntz"),
        features, "customer_id", f"{base}/log", f"{base}/dead", allowed_values=True,
    )
    return base


def prediction_log(spark, d):
    documents = readers.read_documents(spark, "parquet", f"{_logged(spark, d)}/log")
    return score.flatten(documents, "raw_features", "prediction_output").withColumn("balance", F.round("balance", 6))


def dead_letter_log(spark, d):
    documents = readers.read_documents(spark, "parquet", f"{_logged(spark, d)}/dead")
    return documents.select("request_id", "timestamp_utc", "raw_features.key", F.inline("errors"))


def live_snapshot(spark, d):
    """Trailing window of the stored log, features only, kept as a snapshot under a run id."""
    base = _logged(spark, d)
    window = readers.trailing_window(spark.read.parquet(f"{base}/log"), "timestamp_utc", "2024-02-02 00:00:00")
    writers.snapshot(window.select("raw_features.*"), f"{base}/snapshots", "run1")
    return spark.read.parquet(f"{base}/snapshots").groupBy("run_id", "senior").agg(F.count(F.lit(1)).alias("n"))


def output_violations(spark, d):
    """Probabilities outside [0, 1]: a formula that is not bounded, over all cleaned rows."""
    cleaned = cleaning.clean(fr.dirty(spark, d).drop("source_note"), fr.DIRTY_SPEC, "score")
    return score.output_violations(_formula(cleaned)).select("customer_id", F.round("p", 6).alias("p"))


RULES_CONTRACT = contract.from_dict(
    {
        "ingestion_rules": {"allow_type_coercion": True, "drop_unknown_columns": True, "case_sensitive_values": False},
        "columns": {
            "customer_id": {"expected_dtype": "integer"},
            "segment": {"expected_dtype": "string", "allowed_values": ["Building", "Machinery", "Furniture"]},
            "balance": {"expected_dtype": "floating"},
        },
    }
)


def ingestion_rules(spark, d):
    """Undeclared columns dropped, text numbers coerced, case folded to declared categories."""
    rows = fr.dirty(spark, d).withColumns({"customer_id": F.col("customer_id").cast("string"), "segment": F.trim("segment")})
    return contract.apply_ingestion_rules(rows, RULES_CONTRACT)


QUERIES = {
    f.__name__: f
    for f in (
        contract_check, contract_summary, dataset_constraints, row_violations, valid_rows, dlq_rows, batch_summary,
        prediction_log, dead_letter_log, live_snapshot, output_violations, ingestion_rules,
    )
}

_DTYPE = "Invalid dtype ''{0}'', expected semantic type ''{1}''"
_NULL = "Null values present in non-nullable column"
_CHECKS_SQL = f"""WITH {fr.CHURN_SQL}, s AS (
  SELECT bool_or(c_acctbal IS NULL) AS z, min(c_acctbal) AS lo, max(c_acctbal) AS hi,
         min(avg_price) AS alo, max(avg_price) AS ahi FROM churn),
checks AS (
  SELECT 'c_acctbal' AS "column", CASE WHEN z OR lo < 100 OR hi > 5000 THEN 'warning' ELSE 'pass' END AS status,
    concat_ws('; ', CASE WHEN z THEN '{_NULL}' END, CASE WHEN lo < 100 THEN 'Observed min below expected min' END,
      CASE WHEN hi > 5000 THEN 'Observed max above expected max' END) AS details FROM s
  UNION ALL SELECT 'n_orders', 'error', '{_DTYPE.format("bigint", "floating")}' FROM s
  UNION ALL SELECT 'total_price', 'pass', '' FROM s
  UNION ALL SELECT 'avg_price', CASE WHEN alo < 50000 OR ahi > 1000000 THEN 'warning' ELSE 'pass' END,
    concat_ws('; ', CASE WHEN alo < 50000 THEN 'Observed min below expected min' END, CASE WHEN ahi > 1000000 THEN 'Observed max above expected max' END) FROM s
  UNION ALL SELECT 'c_mktsegment', 'pass', '' FROM s
  UNION ALL SELECT 'n_name', 'pass', '' FROM s
  UNION ALL SELECT 'tenure', 'error', 'Missing required column' FROM s
  UNION ALL SELECT 'phone', 'warning', 'Missing optional column' FROM s
  UNION ALL SELECT 'churn', 'pass', '' FROM s
  UNION ALL SELECT 'c_custkey', 'warning', 'Unexpected column not defined in reference schema' FROM s
  UNION ALL SELECT 'last_priority', 'warning', 'Unexpected column not defined in reference schema' FROM s)"""

_LOGGED_SQL = fr.ERRORS_SQL + """, good AS (SELECT * FROM cleaned WHERE customer_id NOT IN (SELECT customer_id FROM found))"""

ORACLES = {
    "ingestion_rules": f"""WITH {fr.DIRTY_SQL}, t AS (SELECT customer_id, trim(segment, ' ') AS segment, balance FROM dirty)
        SELECT customer_id, CASE lower(segment) WHEN 'building' THEN 'Building' WHEN 'machinery' THEN 'Machinery'
            WHEN 'furniture' THEN 'Furniture' ELSE segment END AS segment,
          CASE WHEN regexp_matches(balance, {fr.NUMERIC_SQL}) THEN TRY_CAST(trim(balance) AS DOUBLE) END AS balance FROM t""",
    "contract_check": f"{_CHECKS_SQL} SELECT * FROM checks",
    "contract_summary": f"""{_CHECKS_SQL} SELECT count(*) FILTER (status = 'error') AS errors, count(*) FILTER (status = 'warning') AS warnings,
        count(*) FILTER (status = 'error') = 0 AS passed FROM checks""",
    "dataset_constraints": f"""WITH {fr.CHURN_SQL}, s AS (SELECT count(*)::DOUBLE AS n, round(avg((c_acctbal IS NULL)::INT), 6) AS z, round(avg(churn), 6) AS t FROM churn)
        SELECT 'feature_count' AS rule, 8.0::DOUBLE AS observed, 9.0::DOUBLE AS lo, 9.0::DOUBLE AS hi, 'warning' AS status FROM s
        UNION ALL SELECT 'min_rows', n, 1000, NULL, CASE WHEN n >= 1000 THEN 'pass' ELSE 'error' END FROM s
        UNION ALL SELECT 'missing_ratio', z, NULL, 0.05, CASE WHEN z <= 0.05 THEN 'pass' ELSE 'error' END FROM s
        UNION ALL SELECT 'target_share_0', round(1 - t, 6), 0.6, 0.9, CASE WHEN 1 - t BETWEEN 0.6 AND 0.9 THEN 'pass' ELSE 'error' END FROM s
        UNION ALL SELECT 'target_share_1', t, 0.1, 0.42, CASE WHEN t BETWEEN 0.1 AND 0.42 THEN 'pass' ELSE 'error' END FROM s""",
    "row_violations": f"WITH {fr.ERRORS_SQL} SELECT * FROM found",
    "valid_rows": f"""WITH {_LOGGED_SQL} SELECT customer_id, segment, balance, senior, "left" FROM good""",
    "dlq_rows": f"""WITH {fr.ERRORS_SQL} SELECT customer_id, count(*)::INTEGER AS n_errors,
        string_agg(error_reason, '; ' ORDER BY error_reason) AS reasons FROM found GROUP BY customer_id""",
    "batch_summary": f"""WITH {fr.ERRORS_SQL} SELECT (SELECT count(*) FROM cleaned) AS total_rows_received,
        (SELECT count(*) FROM cleaned) - count(DISTINCT customer_id) AS total_success, count(DISTINCT customer_id) AS total_failed_rows,
        count(*) AS total_errors FROM found""",
    "prediction_log": f"""WITH {_LOGGED_SQL} SELECT 'req-1' AS request_id, 'v1' AS model_version, TIMESTAMP '{ASOF}' AS timestamp_utc,
        segment, round(balance, 6) AS balance, senior, customer_id::VARCHAR AS key, round(balance / 8191.0::DOUBLE, 4) AS probability,
        CASE WHEN balance / 8191.0::DOUBLE >= 0.5 THEN 'Yes' ELSE 'No' END AS decision FROM good""",
    "dead_letter_log": f"""WITH {fr.ERRORS_SQL} SELECT 'req-1' AS request_id, TIMESTAMP '{ASOF}' AS timestamp_utc,
        customer_id::VARCHAR AS key, "column", error_reason FROM found""",
    "live_snapshot": f"WITH {_LOGGED_SQL} SELECT 'run1' AS run_id, senior, count(*) AS n FROM good GROUP BY senior",
    "output_violations": f"""WITH {fr.SCORE_SQL} SELECT customer_id, round(balance / 8191.0::DOUBLE, 6) AS p FROM cleaned
        WHERE balance IS NULL OR balance < 0 OR balance / 8191.0::DOUBLE > 1""",
}
