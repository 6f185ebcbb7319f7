"""Stored versions of a table with a hash tree, so that two of them are compared from the root down.

A row belongs to the leaf that its key's hash begins with. A leaf has the count, sum and xor of its row
hashes; a node above has those of its children. Two versions agree below a node whose figures agree, so
only children of nodes that differ are looked at, and only rows of leaves that differ are read: rows
lie in a folder for each of the first hash digits, and sorted by leaf inside it.

Keys may hold NULLs and may repeat: rows of one key are compared as a bag.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwarden.functions import cells, sizing
from tabwarden.operators.fingerprint import row_hash

#: Hexadecimal digits of a leaf and of a folder.
LEAF_DIGITS, FOLDER_DIGITS = 4, 1
#: Rows that one task sorts or groups.
PIECE_ROWS = 250_000
_NODE = "level int, prefix string, n bigint, s decimal(38,0), x bigint"


def _figures(n: Column, s: Column, x: Column) -> list[Column]:
    return [F.sum(n).alias("n"), F.sum(s).cast("decimal(38,0)").alias("s"), F.bit_xor(x).alias("x")]


def _pieces(rows: int) -> int:
    return max(1, -(-rows // PIECE_ROWS))


def store(df: DataFrame, key: Sequence[str], path: str, digits: int = LEAF_DIGITS) -> None:
    """Write a version: ``path/rows`` and ``path/nodes``."""
    spark, columns = df.sparkSession, list(df.columns)
    h = F.md5(cells.canonical_text([F.col(k) for k in key]))
    rows = df.withColumns({"_leaf": F.substring(h, 1, digits), "_folder": F.substring(h, 1, FOLDER_DIGITS), "_row": row_hash([F.col(c) for c in columns])})
    rows.repartitionByRange(_pieces(df.count()), "_folder", "_leaf").sortWithinPartitions("_folder", "_leaf").write.partitionBy("_folder").parquet(f"{path}/rows")
    written = spark.read.schema(rows.schema).parquet(f"{path}/rows")
    nodes = written.groupBy(F.lit(digits).alias("level"), F.col("_leaf").alias("prefix")).agg(*_figures(F.lit(1), F.col("_row").cast("decimal(38,0)"), F.col("_row")))
    leaves = sizing.cut_lineage(nodes, "leaves")
    tree = leaves
    for level in range(digits):  # leaves are few: every level is summed from them
        up = leaves.groupBy(F.lit(level).alias("level"), F.substring("prefix", 1, level).alias("prefix"))
        tree = tree.unionByName(up.agg(*_figures(F.col("n"), F.col("s"), F.col("x"))))
    tree.write.partitionBy("level").parquet(f"{path}/nodes")


def _nodes(spark: SparkSession, path: str, level: int) -> DataFrame:
    return spark.read.schema(_NODE).parquet(f"{path}/nodes").where(F.col("level") == level).drop("level")


def changed_leaves(spark: SparkSession, old: str, new: str, digits: int = LEAF_DIGITS) -> DataFrame:
    """``prefix`` of the leaves that differ, found from the root down."""
    open_ = None
    for level in range(digits + 1):
        a, b = _nodes(spark, old, level), _nodes(spark, new, level)
        if open_ is not None:
            parent = F.substring("prefix", 1, level - 1)
            a, b = (x.withColumn("up", parent).join(open_.withColumnRenamed("prefix", "up"), "up", "left_semi").drop("up") for x in (a, b))
        # Both sides stacked: a node that only one side has, or whose figures differ, is no pair of equals.
        pairs = a.unionByName(b).groupBy("prefix", "n", "s", "x").agg(F.count(F.lit(1)).alias("sides"))
        open_ = sizing.cut_lineage(pairs.where("sides = 1").select("prefix").distinct(), "changed-nodes")
        if open_.isEmpty():
            break
    return open_


def changed_rows(spark: SparkSession, old: str, new: str, key: Sequence[str], digits: int = LEAF_DIGITS) -> DataFrame:
    """``key…``, ``change``: keys that were added, removed or changed between two stored versions."""
    leaves = changed_leaves(spark, old, new, digits)
    folders = [r[0] for r in leaves.select(F.substring("prefix", 1, FOLDER_DIGITS)).distinct().collect()]  # 16 at most

    stored = _nodes(spark, old, digits).unionByName(_nodes(spark, new, digits))
    size = stored.join(leaves, "prefix", "left_semi").agg(F.sum("n")).first()[0] or 0

    def side(path: str, name: str) -> DataFrame:
        rows = spark.read.parquet(f"{path}/rows").where(F.col("_folder").cast("string").isin(folders))
        rows = rows.join(leaves, rows["_leaf"] == leaves["prefix"], "left_semi")
        return rows.select(F.struct(*key).alias("_k"), F.lit(name).alias("_side"), "_row")

    # Both sides of a key meet in one task, which has about PIECE_ROWS rows whatever the size.
    both = side(old, "old").unionByName(side(new, "new")).repartition(_pieces(size), "_k")
    figures = []
    for name in ("old", "new"):
        row = F.when(F.col("_side") == name, F.col("_row"))
        figures.append(F.struct(F.count(row), F.sum(row.cast("decimal(38,0)")), F.bit_xor(row)).alias(f"_{name}"))
    both = both.groupBy("_k").agg(*figures)
    n_old, n_new = F.col("_old.col1"), F.col("_new.col1")
    change = F.when(n_old == 0, "added").when(n_new == 0, "removed").when(~F.col("_old").eqNullSafe(F.col("_new")), "changed")
    return both.select("_k.*", change.alias("change")).where("change IS NOT NULL")
