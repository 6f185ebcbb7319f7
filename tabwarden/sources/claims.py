"""Writes that hold when several writers are at work: claimed versions and tables behind a pointer.

Both rest on what a file system does in one step: a folder that is not empty is renamed to a name that
is free for one writer only. A marker is such a folder, with its owner inside; who finds another
owner under the name has lost. It goes through Spark's own file system layer, wherever the path is;
a store without such renames cannot carry it.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

_POINTER = "_current"


def _files(spark: SparkSession, path: str):
    """The path in Spark's file system layer, and its file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _write(spark: SparkSession, path: str, text: str) -> None:
    at, fs = _files(spark, path)
    out = fs.create(at, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _read(spark: SparkSession, path: str) -> str:
    at, fs = _files(spark, path)
    source = fs.open(at)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def versions(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers of a name's versions that are claimed."""
    at, fs = _files(spark, f"{path}/{name}")
    found = [re.fullmatch(r"v(\d+)\.claim", s.getPath().getName()) for s in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(int(m[1]) for m in found if m)


def claim_version(spark: SparkSession, path: str, name: str, owner: str = "") -> str:
    """The next version of a name, claimed for one writer by its marker; who loses a race takes the one after."""
    me, base = uuid.uuid4().hex, f"{path}/{name}"
    mine, number = f"{base}/_{me}", max(versions(spark, path, name), default=0)
    _write(spark, f"{mine}/owner", f"{me}\n{owner}")
    while True:
        number += 1
        marker = f"{base}/v{number}.claim"
        (source, fs), (target, _) = _files(spark, mine), _files(spark, marker)
        fs.rename(source, target)
        if _read(spark, f"{marker}/owner").split("\n", 1)[0] == me:
            return f"v{number}"
        inside = f"{marker}/_{me}"  # a rename to a folder that is there moves into it
        mine = inside if fs.exists(_files(spark, inside)[0]) else mine


def owner_of(spark: SparkSession, path: str, name: str, version: int) -> str:
    return _read(spark, f"{path}/{name}/v{version}.claim/owner").split("\n", 1)[1]


def reload_table(df: DataFrame, path: str) -> str:
    """Write rows to a fresh folder and turn the table's pointer to it in one step.

    The pointer is the highest claimed version of ``_current``, whose owner is the folder. Readers see the
    old rows or the new ones, whole. Old folders stay for readers that are still at them; clear them by age.
    """
    folder = f"data-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    claim_version(df.sparkSession, path, _POINTER, folder)
    return folder


def current_folder(spark: SparkSession, path: str) -> str:
    return owner_of(spark, path, _POINTER, versions(spark, path, _POINTER)[-1])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows that the pointer stands at now."""
    return spark.read.parquet(f"{path}/{current_folder(spark, path)}")
