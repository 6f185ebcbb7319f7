"""Feature preparation: exact median imputation, scaling, one-hot encoding."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwarden.operators.percentiles import percentiles_and

#: Name of the category that stands for a missing value; it sorts last. A text that reads so is quoted.
MISSING = "nan"
_QUOTED = f"^('*{MISSING}'*)$"


def category(column: str) -> Column:
    """A cell as the name of its category: missing cells and the text ``nan`` are two categories."""
    text = F.col(f"`{column}`").cast("string")
    return F.coalesce(F.regexp_replace(text, _QUOTED, "'$1'"), F.lit(MISSING))


def unquoted(name: str) -> str:
    """The text behind the name of a category."""
    return name[1:-1] if re.fullmatch(f"'('*{MISSING}'*)'", name) else name


def fit_numeric(df: DataFrame, columns: Sequence[str]) -> dict[str, dict[str, float]]:
    """Median, and mean and population deviation after imputation, per column.

    Imputation adds copies of the median, so both follow from the moments of the present
    values: no pass over imputed rows, and two scans in all.
    """
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        v = F.col(c).cast("double")
        aggs += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"m{i}"), F.var_pop(v).alias(f"v{i}")]
    points, row = percentiles_and(df, columns, {"median": 0.5}, aggs)
    medians = {r["feature"]: r["median"] for r in points.collect()}
    fits = {}
    for i, c in enumerate(columns):
        n, rows, mid = row[f"n{i}"], row["rows"], medians[c]
        if not n:
            fits[c] = {"median": None, "mean": None, "std": None}
            continue
        gaps = rows - n
        mean = (n * row[f"m{i}"] + gaps * mid) / rows
        spread = n * (row[f"v{i}"] + (row[f"m{i}"] - mean) ** 2) + gaps * (mid - mean) ** 2
        fits[c] = {"median": mid, "mean": mean, "std": math.sqrt(spread / rows)}
    return fits


def imputed(column: str, fit: dict[str, float]) -> Column:
    return F.coalesce(F.col(column).cast("double"), F.lit(fit["median"]).cast("double"))


def scaled(column: str, fit: dict[str, float]) -> Column:
    """Standard score with the population deviation; a constant column becomes 0."""
    if fit["mean"] is None:
        return imputed(column, fit)
    # Moments of a constant column may leave dust behind.
    spread = fit["std"] if fit["std"] > 1e-12 * max(1.0, abs(fit["mean"])) else 1.0
    return (imputed(column, fit) - F.lit(fit["mean"])) / F.lit(spread)


def impute_and_scale(df: DataFrame, columns: Sequence[str], fits: dict[str, dict[str, float]]) -> DataFrame:
    return df.withColumns({c: scaled(c, fits[c]) for c in columns})


def fit_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, category)``: the distinct values of each column, the missing one included."""
    text = df.select(*[category(c).alias(c) for c in columns])
    return text.unpivot([], list(columns), "feature", "category").distinct()


def _sort_key() -> Column:
    text = F.regexp_replace("category", f"^'('*{MISSING}'*)'$", "$1")
    return F.struct((F.col("category") == MISSING).alias("last"), text.alias("text"), F.col("category").alias("category"))


def encoded_categories(categories: DataFrame, drop_first: bool) -> DataFrame:
    """Categories that get an output: all of them, or all but the first of each feature."""
    if not drop_first:
        return categories
    first = categories.groupBy("feature").agg(F.min(_sort_key())["category"].alias("_first"))
    return (
        categories.join(F.broadcast(first), "feature").where(F.col("category") != F.col("_first")).drop("_first")
    )


def one_hot_rows(df: DataFrame, key: Sequence[str], columns: Sequence[str], categories: DataFrame, drop_first: bool) -> DataFrame:
    """Sparse one-hot encoding: one row ``(key…, output, value)`` per non-zero cell.

    Works for any number of categories. A category that was not fitted gives no row, which is
    the all-zeros encoding.
    """
    outputs = encoded_categories(categories, drop_first)
    text = df.select(*key, *[category(c).alias(c) for c in columns])
    long = text.unpivot(list(key), list(columns), "feature", "category")
    return long.join(outputs, ["feature", "category"]).select(
        *key, F.concat_ws("_", "feature", "category").alias("output"), F.lit(1.0).alias("value")
    )


def cardinality(categories: DataFrame) -> DataFrame:
    """Categories per feature and outputs of both encodings."""
    return categories.groupBy("feature").agg(F.count(F.lit(1)).alias("categories")).select(
        "feature", "categories", (F.col("categories") - 1).alias("linear_outputs"), F.col("categories").alias("tree_outputs")
    )


def output_names(numeric: Sequence[str], categories: DataFrame, drop_first: bool) -> DataFrame:
    """``(block, feature, output)`` for every encoded feature, numeric block first."""
    spark = categories.sparkSession
    cat = encoded_categories(categories, drop_first).select(
        F.lit(1).alias("block"), "feature", F.concat_ws("_", "feature", "category").alias("output")
    )
    if not numeric:
        return cat
    num = spark.createDataFrame([(0, n, n) for n in numeric], "block int, feature string, output string")
    return num.unionByName(cat)


class _EncoderParams(Params):
    numericCols = Param(Params._dummy(), "numericCols", "numeric inputs", TypeConverters.toListString)
    categoricalCols = Param(Params._dummy(), "categoricalCols", "categorical inputs", TypeConverters.toListString)
    scale = Param(Params._dummy(), "scale", "standardize numeric inputs", TypeConverters.toBoolean)
    dropFirst = Param(Params._dummy(), "dropFirst", "drop the first category", TypeConverters.toBoolean)
    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)


class TabularEncoder(Estimator, _EncoderParams, DefaultParamsReadable, DefaultParamsWritable):
    """Numeric block, then one-hot block, as one sparse vector; refits with its pipeline.

    The model holds a name per category. ``one_hot_rows`` encodes without a model in memory.
    """

    @keyword_only
    def __init__(self, numericCols=None, categoricalCols=None, scale=False, dropFirst=False, outputCol="features"):
        super().__init__()
        self._setDefault(scale=False, dropFirst=False, outputCol="features")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> "TabularEncoderModel":
        numeric = self.getOrDefault("numericCols")
        categorical = self.getOrDefault("categoricalCols")
        levels: dict[str, list[str]] = {c: [] for c in categorical}
        kept = encoded_categories(fit_categories(dataset, categorical), self.getOrDefault("dropFirst"))
        for r in kept.collect():  # a name per output of the model, which holds them anyway
            levels[r["feature"]].append(r["category"])
        for c in categorical:
            levels[c].sort(key=lambda v: (v == MISSING, unquoted(v)))
        # A column without any value has no median and gives no output.
        fits = {c: f for c, f in fit_numeric(dataset, numeric).items() if f["median"] is not None}
        model = TabularEncoderModel()
        model._set(
            state=json.dumps({"numeric": fits, "levels": levels}),
            scale=self.getOrDefault("scale"),
            outputCol=self.getOrDefault("outputCol"),
        )
        return model


class TabularEncoderModel(Model, _EncoderParams, DefaultParamsReadable, DefaultParamsWritable):
    state = Param(Params._dummy(), "state", "fitted values as JSON", TypeConverters.toString)

    def __init__(self):
        super().__init__()

    def fitted(self) -> dict:
        return json.loads(self.getOrDefault("state"))

    def for_linear(self) -> "TabularEncoderModel":
        """The same fit with scaled numbers and without the first category of each feature."""
        fit = self.fitted()
        model = TabularEncoderModel()
        state = {"numeric": fit["numeric"], "levels": {c: v[1:] for c, v in fit["levels"].items()}}
        model._set(state=json.dumps(state), scale=True, outputCol=self.getOrDefault("outputCol"))
        return model

    def output_names(self) -> list[str]:
        fit = self.fitted()
        return list(fit["numeric"]) + [f"{c}_{v}" for c, vs in fit["levels"].items() for v in vs]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fit = self.fitted()
        missing = [c for c in [*fit["numeric"], *fit["levels"]] if c not in dataset.columns]
        if missing:
            raise ValueError(f"columns missing for this model: {missing}")
        number = scaled if self.getOrDefault("scale") else imputed
        cells = [number(c, f) for c, f in fit["numeric"].items()]
        names = [f"_f{i}" for i in range(len(cells))]
        wide = dataset.select("*", *[c.alias(n) for c, n in zip(cells, names)])
        marks = [f"{i}:{v}" for i, values in enumerate(fit["levels"].values()) for v in values]
        if marks:
            held = [F.concat(F.lit(f"{i}:"), category(c)) for i, c in enumerate(fit["levels"])]
            one_hot = CountVectorizerModel.from_vocabulary(marks, inputCol="_marks", outputCol="_one_hot")
            wide = one_hot.setBinary(True).transform(wide.withColumn("_marks", F.array(*held))).drop("_marks")
            names.append("_one_hot")
        return VectorAssembler(inputCols=names, outputCol=self.getOrDefault("outputCol")).transform(wide).drop(*names)
