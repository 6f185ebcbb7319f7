"""Queries: scans, sinks, cleaning, splits, fingerprints."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwarden import fixed
from tabwarden.catalog import frames as fr
from tabwarden.functions import sizing
from tabwarden.operators import clean, fingerprint, rules, split, versions
from tabwarden.operators.contract import from_dict
from tabwarden.sources import claims, readers, writers

ASOF = "2024-01-31 00:00:00"
ORDER_SCHEMA = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
)


def scan_window_flatten(spark, d):
    window = readers.trailing_window(fr.table(spark, d, "events"), "ts", ASOF)
    return readers.json_fields(window, "props", "k INT").select("event_id", "event_type", "value", "k")


def io_roundtrip(spark, d):
    base = sizing.run_dir(spark, "io")
    writers.write_csv(fr.table(spark, d, "orders"), f"{base}/csv")
    readers.read_batch(spark, f"{base}/csv", ORDER_SCHEMA).write.parquet(f"{base}/parquet")
    spark.read.parquet(f"{base}/parquet").write.json(f"{base}/json")
    return readers.read_documents(spark, "json", f"{base}/json", ORDER_SCHEMA)


def csv_reordered_batch(spark, d):
    """Customers written in another column order than the declared one."""
    path = sizing.run_dir(spark, "reordered")
    writers.write_csv(fr.table(spark, d, "customer").select("c_acctbal", "c_name", "c_mktsegment", "c_custkey"), path)
    return readers.read_batch(spark, path, "c_custkey bigint, c_mktsegment string, c_acctbal double")


def _three_headers(spark, d):
    """Customers in files of two column orders, and files that lack the balance."""
    path, customer = sizing.run_dir(spark, "headers"), fr.table(spark, d, "customer")
    for k, columns in enumerate((["c_custkey", "c_mktsegment", "c_acctbal"], ["c_acctbal", "c_name", "c_custkey", "c_mktsegment"], ["c_mktsegment", "c_custkey"])):
        customer.where(F.col("c_custkey") % 3 == k).select(*columns).write.mode("append").option("header", True).csv(path)
    return readers.read_files(spark, path, "c_custkey bigint, c_mktsegment string, c_acctbal double", required=["c_acctbal"])


def csv_header_per_file(spark, d):
    """Each file goes by its own header; those without a required column are refused alone."""
    return _three_headers(spark, d)[0]


def csv_refused_files(spark, d):
    """What the refused files lack."""
    return _three_headers(spark, d)[1].select(F.explode("missing").alias("missing")).distinct()


def csv_first_file(spark, d):
    """A folder with a file a segment, of which the alphabetically first is the batch."""
    path = sizing.run_dir(spark, "first-file")
    fr.table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment").repartition("c_mktsegment").write.partitionBy("c_mktsegment").option("header", True).csv(path)
    return readers.read_csv(spark, path, "c_custkey bigint, c_acctbal double", first_file=True)


def csv_null_tokens(spark, d):
    """Every missing token in turn as segment, and one text that only looks like a token."""
    path = sizing.run_dir(spark, "tokens")
    texts = [*fixed.CSV_NULL_TOKENS, "na"]
    turn = F.col("c_custkey") % 25
    written = F.when(turn < len(texts), F.element_at(F.array(*map(F.lit, texts)), (turn + 1).cast("int"))).otherwise(F.col("c_mktsegment"))
    writers.write_csv(fr.table(spark, d, "customer").select(written.alias("segment"), "c_custkey"), path)
    return readers.read_batch(spark, path, "c_custkey bigint, segment string")


def batch_missing_column(spark, d):
    """A batch whose header lacks a required column is refused as a whole."""
    path = sizing.run_dir(spark, "lacking")
    writers.write_csv(fr.table(spark, d, "customer").select("c_mktsegment", "c_custkey"), path)
    batch = readers.read_batch(spark, path, "c_custkey bigint, c_acctbal double, c_mktsegment string")
    try:
        rules.require_columns(batch, from_dict({"columns": {"c_acctbal": {"required": True}}}))
        refused = False
    except ValueError:
        refused = True
    return batch.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("refused", F.lit(refused))


def report_roundtrip(spark, d):
    """A report written as one JSON file and read back with its schema."""
    base = sizing.run_dir(spark, "report")
    report = fr.table(spark, d, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_orders"))
    writers.write_report(report, base)
    return readers.read_report(spark, base, "o_orderpriority string, n_orders bigint")


def load_overwrite_append(spark, d):
    """Customers loaded twice; the counts returned by the loads next to the stored rows."""
    path = sizing.run_dir(spark, "load")
    customers = fr.table(spark, d, "customer").withColumn("row_id", F.col("c_custkey").cast("string"))
    n1 = writers.load_table(clean.add_lineage(customers, "first", ASOF), path, replace=True)
    n2 = writers.load_table(clean.add_lineage(customers.where("c_acctbal < 0"), "second", ASOF), path, replace=False)
    loaded = F.when(F.col("data_source") == "first", F.lit(n1)).otherwise(F.lit(n2)).cast("bigint")
    stored = readers.read_documents(spark, "parquet", path)
    return (
        stored.groupBy("data_source", "ingested_at_utc")
        .agg(F.count("row_id").alias("stored_rows"))
        .withColumn("inserted_rows", loaded)
    )


def split_part_train(spark, d):
    """The stored training part of a split, read back as one partition."""
    path = sizing.run_dir(spark, "parts")
    orders = fr.table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    writers.write_parts(split.stratified_split(orders, "o_orderstatus", ["o_orderkey"]), path)
    return readers.read_part(spark, path, "train")


def table_reload(spark, d):
    """Customers reloaded behind a pointer: the second load is what a reader gets."""
    path, customer = sizing.run_dir(spark, "reload"), fr.table(spark, d, "customer").select("c_custkey", "c_acctbal")
    claims.reload_table(customer, path)
    claims.reload_table(customer.where("c_acctbal > 0"), path)
    return claims.read_table(spark, path)


def clean_customer_train(spark, d):
    cleaned = clean.clean(clean.strip_strings(fr.dirty(spark, d)), fr.DIRTY_SPEC, "train")
    return clean.require_target(cleaned, "left")


def clean_customer_score(spark, d):
    return clean.clean(fr.dirty(spark, d), fr.DIRTY_SPEC, "score").drop("source_note")


def dedupe_rows(spark, d):
    orders = fr.table(spark, d, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority")
    return clean.distinct_rows(orders)


def dedupe_on_key(spark, d):
    """One row per distinct text: exact copies collapse to their smallest document."""
    docs = fr.table(spark, d, "documents").select("doc_id", "lang", F.md5("text").alias("text_md5"))
    return clean.distinct_rows(docs, on=["text_md5"])


def duplicate_count(spark, d):
    return clean.duplicate_count(fr.table(spark, d, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority"))


def dataset_fingerprint(spark, d):
    """Every cell of customers and orders, prices and dates included."""
    c, o = (fingerprint.fingerprint(fr.table(spark, d, t)) for t in ("customer", "orders"))
    return c.select(F.lit("customer").alias("dataset"), "*").unionByName(o.select(F.lit("orders").alias("dataset"), "*"))


def changed_rows(spark, d):
    """Orders against a later version: prices changed, orders removed and orders added."""
    orders, k = fr.table(spark, d, "orders"), F.col("o_orderkey")
    later = orders.where(k % 101 > 0).withColumn("o_totalprice", F.when(k % 97 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    later = later.unionByName(orders.where(k % 103 == 0).withColumn("o_orderkey", k + 1_000_000_000))
    old, new = sizing.run_dir(spark, "version"), sizing.run_dir(spark, "version")
    versions.store(orders, ["o_orderkey"], old)
    versions.store(later, ["o_orderkey"], new)
    return versions.changed_rows(spark, old, new, ["o_orderkey"])


SAMPLE = {"F": 0.5, "O": 0.2, "P": 0.1}


def stratified_sample(spark, d):
    orders = fr.table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return split.stratified_sample(orders, "o_orderstatus", ["o_orderkey"], SAMPLE)


def stratified_split(spark, d):
    orders = fr.table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return split.stratified_split(orders, "o_orderstatus", ["o_orderkey"])


def stratified_folds(spark, d):
    orders = fr.table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return split.stratified_folds(orders, "o_orderstatus", ["o_orderkey"])


def _churn_split(spark, d):
    """Customers are stored first: the split scans its input several times."""
    stored = sizing.cut_lineage(fr.churn(spark, d).select(fr.KEY, fr.LABEL), "churn")
    return split.stratified_split(stored, fr.LABEL, [fr.KEY])


def split_counts(spark, d):
    return split.split_counts(_churn_split(spark, d))


def target_distribution(spark, d):
    return split.target_distribution(_churn_split(spark, d), fr.LABEL)


def class_gate(spark, d):
    return split.require_two_classes(fr.churn(spark, d), fr.LABEL)


def union_documents(spark, d):
    """Two writers of event documents, one of which never learned the nested number."""
    events = fr.table(spark, d, "events")
    old = events.where("event_type IN ('view', 'click')").select("event_id", "event_type", "value")
    new = readers.json_fields(events.where("event_type NOT IN ('view', 'click')"), "props", "k INT").select("event_id", "event_type", "k")
    return readers.union_documents(old, new)


QUERIES = {
    f.__name__: f
    for f in (
        scan_window_flatten, io_roundtrip, csv_reordered_batch, csv_header_per_file, csv_refused_files, csv_first_file, csv_null_tokens, batch_missing_column, report_roundtrip, load_overwrite_append, table_reload, split_part_train,
        clean_customer_train, clean_customer_score, dedupe_rows, dedupe_on_key, duplicate_count, dataset_fingerprint, changed_rows,
        stratified_sample, stratified_split, stratified_folds, split_counts, target_distribution, class_gate, union_documents,
    )
}


def _fingerprint_sql(dataset: str, columns: list[str]) -> str:
    return f"SELECT '{dataset}' AS dataset, {fr.HASH_SUMS_SQL} FROM (SELECT {fr.row_hash_sql(columns)} AS h FROM {dataset})"


_RANKED = """ranked AS (
  SELECT {key}, {stratum},
         row_number() OVER (PARTITION BY {stratum} ORDER BY md5('{seed}|' || {key}::VARCHAR)) - 1 AS r,
         count(*) OVER (PARTITION BY {stratum}) AS n FROM {source})"""
_PART = "CASE WHEN r < n * 70 // 100 THEN 'train' WHEN r < n * 85 // 100 THEN 'validation' ELSE 'test' END"
_ORDERS = _RANKED.format(key="o_orderkey", stratum="o_orderstatus", seed=42, source="orders")
_CHURN = fr.CHURN_SQL + ", " + _RANKED.format(key="c_custkey", stratum="churn", seed=42, source="churn")

ORACLES = {
    "csv_header_per_file": "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_custkey % 3 < 2",
    "csv_refused_files": "SELECT DISTINCT 'c_acctbal' AS missing FROM customer WHERE c_custkey % 3 = 2",
    "changed_rows": """SELECT o_orderkey, CASE WHEN o_orderkey % 101 = 0 THEN 'removed' ELSE 'changed' END AS change FROM orders WHERE o_orderkey % 101 = 0 OR o_orderkey % 97 = 0
        UNION ALL SELECT o_orderkey + 1000000000, 'added' FROM orders WHERE o_orderkey % 103 = 0""",
    "table_reload": "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0",
    "csv_first_file": "SELECT c_custkey, c_acctbal FROM customer WHERE c_mktsegment = (SELECT min(c_mktsegment) FROM customer)",
    "union_documents": """SELECT event_id, event_type, CASE WHEN event_type IN ('view', 'click') THEN value END AS value,
        CASE WHEN event_type NOT IN ('view', 'click') THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k FROM events""",
    "scan_window_flatten": f"""SELECT event_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
        FROM events WHERE ts >= TIMESTAMP '{ASOF}' - INTERVAL 7 DAY AND ts < TIMESTAMP '{ASOF}'""",
    "io_roundtrip": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders",
    "csv_reordered_batch": "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer",
    "csv_null_tokens": f"""SELECT c_custkey, CASE WHEN c_custkey % 25 > {len(fixed.CSV_NULL_TOKENS)} THEN c_mktsegment
        WHEN c_custkey % 25 = {len(fixed.CSV_NULL_TOKENS)} THEN 'na' END AS segment FROM customer""",
    "batch_missing_column": "SELECT count(*) AS n_rows, true AS refused FROM customer",
    "report_roundtrip": "SELECT o_orderpriority, count(*) AS n_orders FROM orders GROUP BY o_orderpriority",
    "load_overwrite_append": f"""SELECT data_source, TIMESTAMP '{ASOF}' AS ingested_at_utc, count(*) AS stored_rows, count(*) AS inserted_rows
        FROM (SELECT 'first' AS data_source FROM customer UNION ALL SELECT 'second' FROM customer WHERE c_acctbal < 0) GROUP BY data_source""",
    "split_part_train": f"WITH {_ORDERS} SELECT o_orderkey, o_orderstatus FROM ranked WHERE {_PART} = 'train'",
    "clean_customer_train": rf"""WITH {fr.DIRTY_SQL}, stripped AS (
        SELECT customer_id, regexp_replace(regexp_replace(segment, '^\s+', ''), '\s+$', '') AS segment,
               regexp_replace(regexp_replace(balance, '^\s+', ''), '\s+$', '') AS balance, senior, "left" FROM dirty)
        SELECT customer_id, nullif(segment, 'na') AS segment,
               CASE WHEN regexp_matches(balance, {fr.NUMERIC_SQL}) THEN TRY_CAST(balance AS DOUBLE) END AS balance,
               CASE senior WHEN '1' THEN 'Yes' WHEN '0' THEN 'No' END AS senior,
               CASE "left" WHEN 'Yes' THEN 1 ELSE 0 END AS "left" FROM stripped""",
    "clean_customer_score": f"""WITH {fr.SCORE_SQL} SELECT customer_id, segment, balance, senior, "left" FROM cleaned""",
    "dedupe_rows": "SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders",
    "dedupe_on_key": """SELECT doc_id, lang, text_md5 FROM (
        SELECT doc_id, lang, md5(text) AS text_md5, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""",
    "duplicate_count": """SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS distinct_rows, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows
        FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey, o_orderstatus, o_orderpriority)""",
    "dataset_fingerprint": _fingerprint_sql("customer", fr.CUSTOMER_COLUMNS)
    + " UNION ALL "
    + _fingerprint_sql("orders", fr.ORDER_COLUMNS),
    "stratified_sample": """SELECT o_orderkey, o_orderstatus FROM orders
        WHERE ('0x' || substr(md5('42|' || o_orderkey::VARCHAR), 1, 8))::BIGINT % 1000000
              < CASE o_orderstatus WHEN 'F' THEN 500000 WHEN 'O' THEN 200000 WHEN 'P' THEN 100000 ELSE 0 END""",
    "stratified_split": f"WITH {_ORDERS} SELECT o_orderkey, o_orderstatus, {_PART} AS split FROM ranked",
    "stratified_folds": f"""WITH {_ORDERS} SELECT o_orderkey, o_orderstatus,
        CAST((r >= n * 1 // 5)::INT + (r >= n * 2 // 5)::INT + (r >= n * 3 // 5)::INT + (r >= n * 4 // 5)::INT AS INTEGER) AS fold FROM ranked""",
    "split_counts": f"""WITH {_CHURN} SELECT split, count(*) AS n, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 4) AS ratio
        FROM (SELECT {_PART} AS split FROM ranked) GROUP BY split""",
    "target_distribution": f"""WITH {_CHURN} SELECT split, churn, count(*) AS n,
        round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY split) AS DOUBLE), 4) AS ratio
        FROM (SELECT churn, {_PART} AS split FROM ranked) GROUP BY split, churn""",
    "class_gate": f"WITH {fr.CHURN_SQL} SELECT count(DISTINCT churn) AS classes, count(DISTINCT churn) >= 2 AS splittable FROM churn",
}
