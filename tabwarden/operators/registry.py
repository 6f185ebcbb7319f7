"""Model versions as an append-only table.

A registry row is ``(name, version, promoted, registered_at, …)``. Nothing is updated in
place: the production pointer of a name is its latest promoted row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwarden.functions.cells import clean_path

SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("promoted", T.BooleanType()),
        T.StructField("registered_at", T.TimestampNTZType()),
        T.StructField("model_path", T.StringType()),
        T.StructField("baseline_path", T.StringType()),
        T.StructField("metrics_path", T.StringType()),
        T.StructField("checksum", T.StringType()),
    ]
)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def version_number(version: Column) -> Column:
    return F.substring(version, 2, 18).try_cast("int")


def next_version(registry: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """``(name, next_version)``: one above the highest number, ``v1`` for a new name."""
    top = registry.groupBy("name").agg(F.max(version_number(F.col("version"))).alias("top"))
    if names is not None:
        top = names.select("name").distinct().join(top, "name", "left")
    return top.select("name", F.concat(F.lit("v"), (F.coalesce(F.col("top"), F.lit(0)) + 1).cast("string")).alias("next_version"))


def register(registry: DataFrame, approved: DataFrame) -> DataFrame:
    """Rows to append for decisions ``(name, approved, registered_at, …)``.

    Rejected decisions give nothing. Version numbers continue each name's own count.
    """
    accepted = approved.where("approved").drop("approved")
    versions = next_version(registry, accepted)
    rows = accepted.join(versions, "name").withColumnRenamed("next_version", "version").withColumn("promoted", F.lit(True))
    return refuse_existing(registry, rows)


def refuse_existing(registry: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows, if none of their (name, version) is registered yet; else an error."""
    known = rows.join(registry.select("name", "version"), ["name", "version"], "left_semi").select("name", "version").take(5)
    if known:
        raise ValueError(f"already registered: {[tuple(r) for r in known]}")
    return rows


def pointer(registry: DataFrame) -> DataFrame:
    """Production version per name."""
    order = F.struct("registered_at", version_number(F.col("version")))
    return registry.where("promoted").groupBy("name").agg(F.max_by("version", order).alias("version"))


def resolve(pointers: DataFrame, versions: DataFrame, *columns: str) -> DataFrame:
    """Version metadata behind each pointer; ``resolved`` is false where it is missing."""
    found = versions.select("name", "version", *columns, F.lit(True).alias("_hit"))
    out = pointers.join(found, ["name", "version"], "left")
    cleaned = {c: clean_path(F.col(c)) for c in columns if c.endswith("_path")}
    out = out.withColumns(cleaned) if cleaned else out
    return out.withColumn("resolved", F.coalesce(F.col("_hit"), F.lit(False))).drop("_hit")


def append(registry_path: str, rows: DataFrame) -> None:
    rows.write.mode("append").parquet(registry_path)


def version_metrics(evaluation: DataFrame) -> DataFrame:
    """The metrics that go with a version: those of the chosen candidate."""
    return evaluation.where("is_best").drop("is_best")


def store_artifact(df: DataFrame, path: str, name: str, version: str) -> None:
    """Write a baseline or metrics table under its model name and version."""
    df.write.mode("errorifexists").parquet(f"{path}/name={name}/version={version}")


def load_artifact(path: str, pointers: DataFrame) -> DataFrame:
    """Artifact rows of the versions that pointers name; a pointer without rows is an error.

    Names and versions are partitions. Pointers are one row per model, so they become literals
    and only the partitions they name are read.
    """
    named = pointers.select("name", "version").distinct().collect()
    stored = pointers.sparkSession.read.parquet(path)
    stored = stored.where(F.col("name").isin([r["name"] for r in named]) & F.col("version").isin([r["version"] for r in named]))
    wanted = pointers.sparkSession.createDataFrame(named, "name string, version string")
    out = stored.join(F.broadcast(wanted), ["name", "version"])
    missing = pointers.join(stored.select("name", "version").distinct(), ["name", "version"], "left_anti")
    if not missing.isEmpty():
        raise ValueError(f"no stored artifact for {[tuple(r) for r in missing.select('name', 'version').take(5)]}")
    return out
