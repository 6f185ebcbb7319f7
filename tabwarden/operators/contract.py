"""Declared contracts: loading, checking a profile, checking dataset constraints."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

import yaml
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwarden import fixed
from tabwarden.functions import cells

LEVELS = ["pass", "warning", "error"]

#: Physical names under which contracts may list a Spark type.
PHYSICAL_NAMES = {
    "string": ["string", "object"],
    "bigint": ["bigint", "long", "int64", "integer"],
    "int": ["int", "int32", "integer"],
    "smallint": ["smallint", "int16", "integer"],
    "double": ["double", "float64", "floating"],
    "float": ["float", "float32", "floating"],
    "tinyint": ["tinyint", "int8", "integer"],
    "decimal": ["decimal", "numeric", "floating"],
    "boolean": ["boolean", "bool"],
}


@dataclass(frozen=True)
class Contract:
    columns: Mapping[str, Mapping[str, Any]]
    dtype_mapping: Mapping[str, Sequence[str]] = field(default_factory=dict)
    target: str | None = None
    constraints: Mapping[str, Any] = field(default_factory=dict)
    mode: str = "strict"
    ingestion: Mapping[str, Any] = field(default_factory=dict)

    @property
    def target_ranges(self) -> Mapping:
        return self.constraints.get("target_distribution", {}).get("allowed_range", {})

    def required(self) -> list[str]:
        return [c for c, r in self.columns.items() if r.get("required", False)]


def from_dict(doc: Mapping[str, Any]) -> Contract:
    return Contract(
        columns=doc["columns"],
        dtype_mapping=doc.get("dtype_mapping", {}),
        target=doc.get("dataset", {}).get("target_column"),
        constraints=doc.get("dataset_constraints", {}),
        mode=doc.get("enforcement_mode", "strict"),
        ingestion=doc.get("ingestion_rules", {}),
    )


def load(path: str) -> Contract:
    """Read a YAML contract."""
    with open(path, encoding="utf-8") as handle:
        return from_dict(yaml.safe_load(handle))


RULE_SCHEMA = T.StructType(
    [
        T.StructField("column", T.StringType()),
        T.StructField("required", T.BooleanType()),
        T.StructField("expected_dtype", T.StringType()),
        T.StructField("allowed_dtypes", T.ArrayType(T.StringType())),
        T.StructField("not_null", T.BooleanType()),
        T.StructField("lo", T.DoubleType()),
        T.StructField("hi", T.DoubleType()),
        T.StructField("severity", T.StringType()),
    ]
)


def allowed_spark_types(semantic: str | None, mapping: Mapping[str, Sequence[str]]) -> list[str] | None:
    if semantic is None:
        return None
    listed = set(mapping.get(semantic, [])) if mapping else {semantic}
    return sorted(t for t, names in PHYSICAL_NAMES.items() if listed & set(names))


def rule_frame(spark: SparkSession, contract: Contract) -> DataFrame:
    """One row per declared column: as small as the contract file."""
    rows = []
    for name, r in contract.columns.items():
        lo, hi = r.get("min"), r.get("max")
        rows.append(
            (
                name,
                bool(r.get("required", False)),
                r.get("expected_dtype"),
                allowed_spark_types(r.get("expected_dtype"), contract.dtype_mapping),
                r.get("nullable") is False,
                None if lo is None else float(lo),
                None if hi is None else float(hi),
                r.get("severity", "error"),
            )
        )
    return spark.createDataFrame(rows, RULE_SCHEMA)


def _worst(*checks: tuple[Column, Column]) -> Column:
    """Highest severity among failed checks; 0 if none failed."""
    return F.greatest(*[F.when(F.coalesce(bad, F.lit(False)), level).otherwise(0) for bad, level in checks], F.lit(0))


def check_profile(profile: DataFrame, contract: Contract) -> DataFrame:
    """``(column, status, details)`` for declared and for undeclared columns.

    ``status`` is the worst of all failed rules. Both sides have one row per column, so the
    joins are broadcasts of metadata.
    """
    spark = profile.sparkSession
    rules = F.broadcast(rule_frame(spark, contract)).alias("r")
    p = profile.alias("p")
    j = rules.join(p, F.col("r.column") == F.col("p.column"), "left")
    absent = F.col("p.column").isNull()
    severity = F.when(F.col("r.severity") == "error", 2).otherwise(1)
    bad_type = ~absent & ~F.array_contains("r.allowed_dtypes", F.regexp_replace("p.dtype", r"^decimal\(.*", "decimal"))
    bad_null = ~absent & F.col("r.not_null") & F.col("p.nullable")
    low = F.col("p.min") < F.col("r.lo")
    high = F.col("p.max") > F.col("r.hi")
    level = _worst(
        (absent & F.col("r.required"), F.lit(2)),
        (absent & ~F.col("r.required"), F.lit(1)),
        (bad_type, severity),
        (bad_null, severity),
        (low, F.lit(1)),
        (high, F.lit(1)),
    )
    details = F.array_compact(
        F.array(
            F.when(absent & F.col("r.required"), F.lit(fixed.MISSING_REQUIRED)),
            F.when(absent & ~F.col("r.required"), F.lit("Missing optional column")),
            F.when(bad_type, _dtype_text(F.col("p.dtype"), F.col("r.expected_dtype"))),
            F.when(bad_null, F.lit(fixed.NULLS_PRESENT)),
            F.when(low, F.lit("Observed min below expected min")),
            F.when(high, F.lit("Observed max above expected max")),
        )
    )
    declared = j.select(F.col("r.column").alias("column"), _status(level).alias("status"), details.alias("details"))
    unknown = p.join(F.broadcast(rule_frame(spark, contract)).alias("r"), F.col("r.column") == F.col("p.column"), "left_anti")
    extra = unknown.select(
        F.col("p.column").alias("column"),
        F.lit("error" if _forbids_unknown(contract) else "warning").alias("status"),
        F.array(F.lit(fixed.UNEXPECTED_COLUMN)).alias("details"),
    )
    return declared.unionByName(extra)


def _dtype_text(found: Column, expected: Column) -> Column:
    """The fixed message with its two places filled in."""
    head, rest = fixed.INVALID_DTYPE.split("{found}")
    middle, tail = rest.split("{expected}")
    return F.concat(F.lit(head), found, F.lit(middle), expected, F.lit(tail))


def _forbids_unknown(contract: Contract) -> bool:
    return bool(contract.ingestion.get("reject_unknown_columns", False))


def _status(level: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in LEVELS]), (level + 1).cast("int"))


def summarize(checks: DataFrame) -> DataFrame:
    """Counts of column statuses and the gate. The dataset rules are not counted."""
    return checks.agg(
        F.count_if(F.col("status") == "error").alias("errors"),
        F.count_if(F.col("status") == "warning").alias("warnings"),
    ).withColumn("passed", F.col("errors") == 0)


def check_dataset(df: DataFrame, contract: Contract) -> DataFrame:
    """Dataset-level rules ``(rule, observed, lo, hi, status)`` in one aggregate pass.

    Covers the feature count, the minimum number of rows, the missing ratio of the worst
    column and the share of every target class.
    """
    target = contract.target
    c = contract.constraints
    # Strict mode turns a violated constraint into an error; the feature count only ever warns.
    level = "error" if contract.mode == "strict" else "warning"
    features = [n for n in df.columns if n != target]
    rules: list[Column] = []
    aggs = [F.count(F.lit(1)).alias("n")]

    def rule(name: str, observed: Column, lo, hi, status: str) -> None:
        rules.append(
            F.struct(
                F.lit(name).alias("rule"),
                observed.cast("double").alias("observed"),
                F.lit(lo).cast("double").alias("lo"),
                F.lit(hi).cast("double").alias("hi"),
                F.lit(status).alias("_level"),
            )
        )

    if "expected_feature_count" in c:
        want = c["expected_feature_count"]
        rule("feature_count", F.lit(len(features)), want, want, "warning")
    if "min_rows" in c:
        rule("min_rows", F.col("n"), c["min_rows"], None, level)
    if "max_missing_ratio" in c:
        aggs += [F.avg(F.col(name).isNull().cast("int")).alias(f"z{i}") for i, name in enumerate(df.columns)]
        worst = [F.col(f"z{i}") for i in range(len(df.columns))]
        rule("missing_ratio", F.greatest(*worst) if len(worst) > 1 else worst[0], None, c["max_missing_ratio"], level)
    for i, (label, (lo, hi)) in enumerate(contract.target_ranges.items()):
        aggs.append(F.avg(F.when(F.col(target) == label, 1).otherwise(0)).alias(f"t{i}"))
        rule(f"target_share_{label}", F.col(f"t{i}"), lo, hi, level)
    out = df.agg(*aggs).select(F.inline(F.array(*rules)))
    inside = F.coalesce(F.col("observed") >= F.col("lo"), F.lit(True)) & F.coalesce(F.col("observed") <= F.col("hi"), F.lit(True))
    return out.withColumn("status", F.when(inside, F.lit("pass")).otherwise(F.col("_level"))).drop("_level")


def apply_ingestion_rules(df: DataFrame, contract: Contract) -> DataFrame:
    """Drop undeclared columns, coerce declared numbers and fold case, as the contract says."""
    rules = contract.ingestion
    out = df
    if rules.get("drop_unknown_columns", False):
        out = out.select(*[c for c in out.columns if c in contract.columns])
    changes: dict[str, Column] = {}
    for name, rule in contract.columns.items():
        if name not in out.columns:
            continue
        is_text = isinstance(out.schema[name].dataType, T.StringType)
        kind = rule.get("expected_dtype")
        if is_text and kind in ("floating", "integer") and rules.get("allow_type_coercion", True):
            number = cells.to_number(F.col(name))
            whole = F.when(number == F.floor(number), number.try_cast("bigint"))
            changes[name] = number if kind == "floating" else whole
        elif is_text and rule.get("allowed_values") and not rules.get("case_sensitive_values", True):
            text = F.lower(F.col(name))
            kept = F.col(name)
            for value in rule["allowed_values"]:
                kept = F.when(text == str(value).lower(), F.lit(str(value))).otherwise(kept)
            changes[name] = kept
    return out.withColumns(changes) if changes else out
