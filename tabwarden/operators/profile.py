"""Column profiles and baselines. One implementation serves training and live data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwarden import fixed
from tabwarden.functions import sizing
from tabwarden.operators.clean import feature_groups
from tabwarden.operators.percentiles import exact_percentiles, percentiles_and


def _rows(wide: DataFrame, per_column: dict[str, dict[str, Column]], by: Sequence[str] = (), key: str = "feature") -> DataFrame:
    """Turn one wide aggregate row (per group) into one row per column."""
    structs = [F.struct(F.lit(c).alias(key), *[e.alias(n) for n, e in cells.items()]) for c, cells in per_column.items()]
    return wide.select(*by, F.inline(F.array(*structs)))


def table_shape(df: DataFrame) -> DataFrame:
    """One row per column with its type, next to the row and column counts."""
    wide = df.agg(F.count(F.lit(1)).alias("_n"))
    cells = {
        f.name: {
            "dtype": F.lit(f.dataType.simpleString()),
            "n_rows": F.col("_n"),
            "n_columns": F.lit(len(df.columns)).cast("bigint"),
        }
        for f in df.schema.fields
    }
    return _rows(wide, cells, key="column")


def null_counts(df: DataFrame) -> DataFrame:
    """Missing cells per column, one pass for all columns."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(df.columns)])
    return _rows(wide, {c: {"nulls": F.col(f"_{i}")} for i, c in enumerate(df.columns)}, key="column")


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column.

    The exact form is one shuffle of distinct (column, value) pairs for all columns together.
    """
    if approximate:
        wide = df.agg(*[F.approx_count_distinct(c).alias(f"_{i}") for i, c in enumerate(columns)])
        return _rows(wide, {c: {"unique_values": F.col(f"_{i}")} for i, c in enumerate(columns)}, key="column")
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    pairs = text.unpivot([], list(columns), "column", "value").groupBy("column", "value").agg(F.lit(1).alias("_"))
    return pairs.groupBy("column").agg(F.count("value").alias("unique_values"))


def _with_percentiles(df: DataFrame, stats: list[Column], cells: dict[str, dict[str, Column]], columns: Sequence[str], probs, key: str) -> DataFrame:
    """``stats`` and exact percentiles, from two scans."""
    points, row = percentiles_and(df, columns, probs, stats)
    schema = df.agg(*stats).schema
    wide = df.sparkSession.createDataFrame([tuple(row[n] for n in schema.names)], schema)
    # One row per column on both sides.
    return _rows(wide, cells, key=key).join(F.broadcast(points.withColumnRenamed("feature", key)), key, "left")


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Min, max, mean and exact median of numeric columns."""
    stats = []
    for i, c in enumerate(columns):
        v = F.col(c).cast("double")
        stats += [F.min(v).alias(f"a{i}"), F.max(v).alias(f"b{i}"), F.avg(v).alias(f"m{i}")]
    cells = {c: {"min": F.col(f"a{i}"), "max": F.col(f"b{i}"), "mean": F.col(f"m{i}")} for i, c in enumerate(columns)}
    return _with_percentiles(df, stats, cells, columns, {"median": 0.5}, "column")


def column_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """The generated schema: type, nullability, distinct count and numeric range per column."""
    numeric, _ = feature_groups(df)
    stats, cells = [], {}
    for i, f in enumerate(df.schema.fields):
        stats.append(F.coalesce(F.bool_or(F.col(f.name).isNull()), F.lit(False)).alias(f"z{i}"))
        cells[f.name] = {"dtype": F.lit(f.dataType.simpleString()), "nullable": F.col(f"z{i}")}
        if f.name in numeric:
            v = F.col(f.name).cast("double")
            stats += [F.min(v).alias(f"a{i}"), F.max(v).alias(f"b{i}"), F.avg(v).alias(f"m{i}")]
        none = F.lit(None).cast("double")
        for name, short in (("min", "a"), ("max", "b"), ("mean", "m")):
            cells[f.name][name] = F.col(f"{short}{i}") if f.name in numeric else none
    profile = (
        _with_percentiles(df, stats, cells, numeric, {"median": 0.5}, "column")
        if numeric
        else _rows(df.agg(*stats), cells, key="column").withColumn("median", F.lit(None).cast("double"))
    )
    # One row per column on both sides.
    counts = F.broadcast(distinct_counts(df, df.columns, approximate))
    return profile.join(counts, "column", "left").select(
        "column", "dtype", "nullable", "unique_values", "min", "max", "mean", "median"
    )


def _summary_stats(columns: Sequence[str]) -> tuple[list[Column], dict[str, dict[str, Column]]]:
    stats, cells = [], {}
    for i, c in enumerate(columns):
        v = F.col(c).cast("double")
        stats += [
            F.avg(F.col(c).isNull().cast("int")).alias(f"z{i}"),
            F.avg(v).alias(f"m{i}"),
            F.stddev_samp(v).alias(f"s{i}"),
            F.min(v).alias(f"a{i}"),
            F.max(v).alias(f"b{i}"),
        ]
        names = {"missing_ratio": "z", "mean": "m", "std": "s", "min": "a", "max": "b"}
        cells[c] = {n: F.col(f"{short}{i}") for n, short in names.items()}
    return stats, cells


def numeric_summary(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Missing ratio, mean, sample deviation, min and max; one pass, any grouping."""
    stats, cells = _summary_stats(columns)
    return _rows(df.groupBy(*by).agg(*stats) if by else df.agg(*stats), cells, by)


def numeric_baseline(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``numeric_summary`` plus exact percentiles, one row per column."""
    stats, cells = _summary_stats(columns)
    return _with_percentiles(df, stats, cells, columns, fixed.QUANTILES, "feature")


def long_cells(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows ``(by…, feature, value)`` of all cells, values as text.

    Companion columns ride inside the unpivoted cell: identifier columns of an unpivot keep two
    uses of the same counts from sharing one shuffle.
    """
    cells = [F.struct(F.col(c).cast("string").alias("v"), *by).alias(c) for c in columns]
    long = df.select(*cells).unpivot([], list(columns), "feature", "_cell")
    return long.select(*[F.col(f"_cell.{b}").alias(b) for b in by], "feature", F.col("_cell.v").alias("value"))


def value_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows ``(by…, feature, value, n)``, the missing value included as NULL.

    One shuffle for all columns; tasks first count their own values, so a value that fills a
    third of the table travels as one row per task. No value is cut off: a column of ids makes
    a long table, never a big task.
    """
    return long_cells(df, columns, by).groupBy(*by, "feature", "value").agg(F.count(F.lit(1)).alias("n"))


def value_distribution(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``value_counts`` with the share of each value as ``ratio``.

    Totals are summed from the counts, whose shuffle is reused: no second scan of the table.
    """
    counts = value_counts(df, columns, by)
    if not by:
        # Missing cells are counted, so every column has the same total.
        total = counts.agg(F.expr(f"sum(n) div {len(columns)}")).scalar()
        return counts.withColumn("ratio", F.col("n") / total)
    totals = counts.groupBy(*[F.col(b).alias(f"_{b}") for b in by], F.col("feature").alias("_f")).agg(
        F.sum("n").alias("_total")
    )
    on = F.col("feature") == F.col("_f")
    for b in by:
        on = on & F.col(b).eqNullSafe(F.col(f"_{b}"))
    joined = counts.join(totals, on)
    return joined.select(*by, "feature", "value", "n", (F.col("n") / F.col("_total")).alias("ratio"))


def categorical_baseline(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distribution rows; the allowed values of a feature are its non-null ``value`` rows."""
    return value_distribution(df, columns)


def _require(df: DataFrame, target: str) -> None:
    if target not in df.columns:
        raise ValueError(f"target column {target} not found")


def target_baseline(df: DataFrame, target: str) -> DataFrame:
    _require(df, target)
    return value_distribution(df, [target])


def placeholder_target(df: DataFrame, target: str) -> DataFrame:
    """Live rows have no label yet: one constant class stands for it in a report."""
    return df.withColumn(target, F.lit(fixed.UNLABELLED))


#: One long shape for every statistic, so a stored baseline needs one table.
BASELINE_COLUMNS = ["section", "feature", "feature_type", "stat", "value", "number"]


def baseline_report(
    df: DataFrame, target: str | None = None, exclude: Sequence[str] = (), percentiles: bool = True
) -> DataFrame:
    """The full baseline: numeric statistics, category shares and the target, long format.

    ``stat`` names the statistic; category shares have ``stat='ratio'`` and their category in
    ``value``. Live statistics are the same call on live data, the target left out. All but the
    percentiles come from one scan, whose result is stored; no rows are an error (``NoRows``).
    """
    if not df.columns:
        raise ValueError("baseline of a frame without columns")
    if target:
        _require(df, target)
    keep = [c for c in df.columns if c not in exclude]
    frame = df.select(*keep)
    numeric, categorical = feature_groups(frame, exclude=[target] if target else [])
    told = sizing.cut_lineage(_told(frame, numeric, [*categorical, *([target] if target else [])]), "statistics")
    if told.isEmpty():
        raise NoRows("baseline of no rows")
    parts = []
    if numeric:
        summary = told.where("numeric").select("feature", *SUMMARY)
        if percentiles:
            # One row per column on both sides.
            summary = summary.join(F.broadcast(exact_percentiles(frame, numeric, fixed.QUANTILES)), "feature")
        stats = [c for c in summary.columns if c != "feature"]
        long = summary.unpivot(["feature"], stats, "stat", "number")
        parts.append(_section(long, "features", "numerical", F.lit(None).cast("string")))
    shares = told.where("NOT numeric")
    total = shares.agg(F.expr(f"sum(n) div {max(1, len(categorical) + bool(target))}")).scalar()  # missing cells are counted: every column has it
    for section, is_target in (("features", False), ("target", True)):
        if target if is_target else categorical:
            of = shares.where((F.col("feature") == F.lit(target)) == F.lit(is_target) if target else F.lit(True))
            rows = of.select("feature", "value", F.lit("ratio").alias("stat"), (F.col("n") / total).alias("number"))
            parts.append(_section(rows, section, "categorical", F.col("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class NoRows(ValueError):
    """Statistics were asked of no rows."""


SUMMARY = ("missing_ratio", "mean", "std", "min", "max")


def _told(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """One row per value of a categorical column, with its count, and one per numeric column, with its summary."""
    none = F.lit(None)
    cells = [F.struct(F.lit(c).alias("feature"), F.lit(True).alias("numeric"), none.cast("string").alias("value"), F.col(c).cast("double").alias("x")) for c in numeric]
    cells += [F.struct(F.lit(c).alias("feature"), F.lit(False).alias("numeric"), F.col(c).cast("string").alias("value"), none.cast("double").alias("x")) for c in categorical]
    x = F.col("x")
    figures = (F.avg(x.isNull().cast("int")), F.avg(x), F.stddev_samp(x), F.min(x), F.max(x))
    long = df.select(F.inline(F.array(*cells))).groupBy("feature", "numeric", "value")
    return long.agg(F.count(F.lit(1)).alias("n"), *[f.alias(n) for f, n in zip(figures, SUMMARY)])


def _section(df: DataFrame, section: str, kind: str, value: Column) -> DataFrame:
    return df.select(
        F.lit(section).alias("section"), "feature", F.lit(kind).alias("feature_type"), "stat", value.alias("value"), "number"
    )
