"""Sinks: tables, partitioned splits, reports and snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def load_table(df: DataFrame, path: str, replace: bool = True, fmt: str = "parquet") -> int:
    """Write rows and return how many; counted while writing, not by a second job."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("n"))
    counted.write.mode("overwrite" if replace else "append").format(fmt).save(path)
    return int(seen.get["n"])


def write_parts(df: DataFrame, path: str, *columns: str, fmt: str = "parquet") -> None:
    """All parts of a split in one write, one directory per part (and fold)."""
    df.write.mode("overwrite").partitionBy(*(columns or ("split",))).format(fmt).option("header", True).save(path)


def write_csv(df: DataFrame, path: str, replace: bool = True) -> None:
    df.write.mode("overwrite" if replace else "errorifexists").option("header", True).option("emptyValue", '""').csv(path)


def write_report(df: DataFrame, path: str, replace: bool = True) -> None:
    """A report-sized frame as one JSON file."""
    df.coalesce(1).write.mode("overwrite" if replace else "errorifexists").json(path)


def append_log(documents: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    documents.write.mode("append").partitionBy(*partition_by).parquet(path)


def snapshot(df: DataFrame, path: str, run_id: str) -> None:
    """The rows a run looked at, under its id."""
    df.write.mode("overwrite").parquet(f"{path}/run_id={run_id}")
