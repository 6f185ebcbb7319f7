"""Input frames that several queries share, with the SQL text of the same frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwarden.operators.clean import CleanSpec
from tabwarden.operators.contract import Contract, from_dict


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]

HASH_SUMS_SQL = "count(*) AS n_rows, CAST(sum(h::HUGEINT) AS VARCHAR) AS hash_sum, bit_xor(h) AS hash_xor"


def row_hash_sql(columns: list[str]) -> str:
    """SQL of ``fingerprint.row_hash``; doubles below ten million have one text form in both engines."""
    text = " || ".join(f"coalesce(length({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '~')" for c in columns)
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


# --- one row per customer, with a label -------------------------------------------------

LABEL_CUT = "2001-01-01 00:00:00"
NUMERIC = ["c_acctbal", "n_orders", "total_price", "avg_price"]
CATEGORICAL = ["c_mktsegment", "n_name", "last_priority"]
LABEL = "churn"
KEY = "c_custkey"


def churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer features; the label says that the last order lies before the cut.

    A negative balance counts as missing.
    """
    orders = table(spark, sf_dir, "orders")
    per_customer = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.round(F.sum("o_totalprice"), 2).alias("total_price"),
        F.round(F.avg("o_totalprice"), 7).alias("avg_price"),
        F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("last_priority"),
        (F.max("o_orderdate") < F.lit(LABEL_CUT).cast("timestamp_ntz")).cast("int").alias(LABEL),
    )
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(per_customer, F.col("c_custkey") == F.col("o_custkey"))
        .select(
            KEY,
            F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"),
            "n_orders", "total_price", "avg_price", "c_mktsegment", "n_name", "last_priority", LABEL,
        )
    )


CHURN_SQL = f"""churn AS (
  SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal,
         n_orders, total_price, avg_price, c_mktsegment, n_name, last_priority, churn
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  JOIN (SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total_price,
               round(avg(o_totalprice), 7) AS avg_price,
               max(CASE WHEN rn = 1 THEN o_orderpriority END) AS last_priority,
               CAST(max(o_orderdate) < TIMESTAMP '{LABEL_CUT}' AS INTEGER) AS churn
        FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
              FROM orders)
        GROUP BY o_custkey) ON c_custkey = o_custkey)"""

# --- customers with dirty cells ---------------------------------------------------------

DIRTY_SPEC = CleanSpec(
    drop=("source_note",),
    numeric_text=("balance",),
    value_maps={"senior": {1: "Yes", 0: "No"}},
    target="left",
    target_map={"Yes": 1, "No": 0},
)


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers whose cells carry blanks, null tokens and bad numbers, depending on their values."""
    c = table(spark, sf_dir, "customer")
    bal, nat = F.col("c_acctbal"), F.col("c_nationkey")
    segment = (
        F.when(bal < 0, "na").when(bal > 9500, " ").when(bal > 9000, "")
        .otherwise(F.concat(F.lit("\t "), "c_mktsegment", F.lit("  ")))
    )
    balance = (
        F.when(nat == 3, "1d").when(nat == 4, " ").when(nat == 5, "1_000").when(nat == 6, "na").when(nat == 7, "1e3")
        .otherwise(F.concat(F.lit(" "), bal.cast("string"), F.lit(" ")))
    )
    senior = F.when(nat < 8, "1").when(nat < 16, "0").when(nat < 20, "Yes").otherwise("maybe")
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        segment.alias("segment"),
        balance.alias("balance"),
        senior.alias("senior"),
        F.when(bal > 4500, "Yes").otherwise("No").alias("left"),
        F.lit("crm").alias("source_note"),
    )


DIRTY_SQL = r"""dirty AS (
  SELECT c_custkey AS customer_id,
         CASE WHEN c_acctbal < 0 THEN 'na' WHEN c_acctbal > 9500 THEN ' ' WHEN c_acctbal > 9000 THEN ''
              ELSE chr(9) || ' ' || c_mktsegment || '  ' END AS segment,
         CASE c_nationkey WHEN 3 THEN '1d' WHEN 4 THEN ' ' WHEN 5 THEN '1_000' WHEN 6 THEN 'na' WHEN 7 THEN '1e3'
              ELSE ' ' || CAST(c_acctbal AS VARCHAR) || ' ' END AS balance,
         CASE WHEN c_nationkey < 8 THEN '1' WHEN c_nationkey < 16 THEN '0' WHEN c_nationkey < 20 THEN 'Yes' ELSE 'maybe' END AS senior,
         CASE WHEN c_acctbal > 4500 THEN 'Yes' ELSE 'No' END AS "left"
  FROM customer)"""

NUMERIC_SQL = r"'^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$'"

SCORE_SQL = DIRTY_SQL + rf""", cleaned AS (
  SELECT customer_id,
         CASE WHEN segment IN ('na', '', ' ') THEN NULL ELSE segment END AS segment,
         CASE WHEN regexp_matches(balance, {NUMERIC_SQL}) THEN TRY_CAST(trim(balance) AS DOUBLE) END AS balance,
         CASE senior WHEN '1' THEN 'Yes' WHEN '0' THEN 'No' ELSE senior END AS senior, "left"
  FROM dirty)"""

# --- the contract of those customers ----------------------------------------------------

BATCH_CONTRACT: Contract = from_dict(
    {
        "columns": {
            "customer_id": {"expected_dtype": "integer", "required": True, "nullable": False, "severity": "error"},
            "segment": {"expected_dtype": "string", "required": True, "nullable": False, "severity": "warning"},
            "balance": {"expected_dtype": "floating", "nullable": False, "min": 500.0, "max": 8000.0, "severity": "error"},
            "senior": {"expected_dtype": "string", "nullable": False, "allowed_values": ["Yes", "No"], "severity": "error"},
        }
    }
)

ERRORS_SQL = SCORE_SQL + """, found AS (
  SELECT customer_id, 'segment' AS "column", 'Column ''segment'' contains null/missing values.' AS error_reason FROM cleaned WHERE segment IS NULL
  UNION ALL SELECT customer_id, 'balance', 'Column ''balance'' contains null/missing values.' FROM cleaned WHERE balance IS NULL
  UNION ALL SELECT customer_id, 'balance', 'Column ''balance'' value falls below minimum (500.0).' FROM cleaned WHERE balance < 500
  UNION ALL SELECT customer_id, 'balance', 'Column ''balance'' value exceeds maximum (8000.0).' FROM cleaned WHERE balance > 8000
  UNION ALL SELECT customer_id, 'senior', 'Column ''senior'' is not allowed' FROM cleaned WHERE senior NOT IN ('Yes', 'No'))""".replace(
    "Column ''senior'' is not allowed", "Column ''senior'' value is not an allowed category."
)

# --- labelled documents scored by three fixed formulas ----------------------------------


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, lang, model, label, p)``: three formulas stand in for three models."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.col("n_chars").cast("double").alias("n"))
    rows = table(spark, sf_dir, "labels").join(docs, "doc_id")
    n = F.col("n")
    models = [
        ("length", F.least(n, F.lit(5000.0)) / 5000.0),
        ("brevity", 1000.0 / (n + 1000.0)),
        ("middle", F.when(n < 2000, n / 2000.0).otherwise(2000.0 / n)),
    ]
    cells = F.array(*[F.struct(F.lit(m).alias("model"), p.alias("p")) for m, p in models])
    return rows.select("doc_id", "lang", F.col("quality").alias("label"), F.inline(cells))


SCORED_SQL = """scored AS (
  SELECT doc_id, lang, quality AS label, model,
         CASE model WHEN 'length' THEN least(n, 5000.0::DOUBLE) / 5000.0::DOUBLE
                    WHEN 'brevity' THEN 1000.0::DOUBLE / (n + 1000.0::DOUBLE)
                    ELSE CASE WHEN n < 2000 THEN n / 2000.0::DOUBLE ELSE 2000.0::DOUBLE / n END END AS p
  FROM (SELECT l.doc_id, d.lang, l.quality, CAST(d.n_chars AS DOUBLE) AS n FROM labels l JOIN documents d USING (doc_id)),
       (VALUES ('length'), ('brevity'), ('middle')) AS m(model))"""

CONFUSION_SQL = """cells AS (
  SELECT {by}, count(*) AS n_samples,
         count(*) FILTER (label = 0 AND p < 0.5) AS tn, count(*) FILTER (label = 0 AND p >= 0.5) AS fp,
         count(*) FILTER (label = 1 AND p < 0.5) AS fn, count(*) FILTER (label = 1 AND p >= 0.5) AS tp
  FROM scored GROUP BY {by}),
rates AS (
  SELECT *, round((tp + tn) / (tp + fp + fn + tn)::DOUBLE, 6) AS accuracy,
         CASE WHEN tp + fp = 0 THEN 0.0::DOUBLE ELSE round(tp / (tp + fp)::DOUBLE, 6) END AS precision,
         CASE WHEN tp + fn = 0 THEN 0.0::DOUBLE ELSE round(tp / (tp + fn)::DOUBLE, 6) END AS recall,
         CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0::DOUBLE ELSE round(2 * tp / (2 * tp + fp + fn)::DOUBLE, 6) END AS f1
  FROM cells)"""

# --- event halves -----------------------------------------------------------------------

EVENT_CUT = "2024-01-16 00:00:00"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the number inside ``props`` as a column."""
    e = table(spark, sf_dir, "events")
    return e.withColumn("k", F.from_json("props", "k INT")["k"]).drop("props")


def halves(df: DataFrame, at: str, cut: str) -> tuple[DataFrame, DataFrame]:
    mark = F.lit(cut).cast("timestamp_ntz")
    return df.where(F.col(at) < mark), df.where(F.col(at) >= mark)


EVENTS_SQL = "ev AS (SELECT event_id, ts, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"
SHIP_CUT = "1998-07-01 00:00:00"
ORDER_CUT = "1998-04-01 00:00:00"
