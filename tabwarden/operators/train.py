"""Training candidates with stratified cross-validation."""

from __future__ import annotations

import itertools
import json
import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwarden import fixed
from tabwarden.operators import grid, metrics
from tabwarden.operators.encode import TabularEncoder, TabularEncoderModel

def draw_parameters(grid: Mapping[str, Sequence], n: int, seed: int = fixed.SEED) -> list[dict[str, Any]]:
    """``n`` different random draws of a parameter grid."""
    names = list(grid)
    points = [dict(zip(names, values)) for values in itertools.product(*grid.values())]
    return random.Random(seed).sample(points, min(n, len(points)))


def is_linear(name: str) -> bool:
    """Linear models get scaled inputs without the first category, trees plain ones with every category."""
    return name == "logistic_regression"


#: Fitted encoders by (linear, the fold left out or None for all rows).
Encoders = Mapping[tuple[bool, int | None], TabularEncoderModel]


def fit_encoders(
    train: DataFrame, names: Sequence[str], numeric, categorical, fold: str, folds: int, parallelism: int = 4
) -> Encoders:
    """The encoders that all candidates share: one per kind of model and fold left out.

    Both kinds have the same medians and categories, so a fold is fitted once.
    """

    def one(k):
        part = train if k is None else train.where(F.col(fold) != k)
        return TabularEncoder(numericCols=list(numeric), categoricalCols=list(categorical)).fit(part)

    parts, kinds = [*range(folds), None], sorted({is_linear(n) for n in names} | {False})
    with ThreadPool(max(1, min(parallelism, len(parts)))) as pool:
        fitted = dict(zip(parts, pool.map(inheritable_thread_target(train.sparkSession)(one), parts)))
    return {(linear, k): model.for_linear() if linear else model for k, model in fitted.items() for linear in kinds}


def scored(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Kept columns and the probability of the positive class as ``p``."""
    return model.transform(df).select(*keep, vector_to_array("probability")[1].alias("p"))


@dataclass
class Candidate:
    """A candidate's best draw, fitted on all training rows, and its recall per fold."""

    name: str
    params: dict[str, Any]
    model: PipelineModel
    fold_scores: list[tuple[int, float]] = field(default_factory=list)


def search(
    train: DataFrame,
    grids: Mapping[str, Mapping[str, Sequence]],
    encoders: Encoders,
    label: str,
    fold: str = "fold",
    folds: int = fixed.N_FOLDS,
    draws: int = 1,
    seed: int = fixed.SEED,
) -> list[Candidate]:
    """Random search over each grid by cross-validated recall; the best draw comes fitted on all rows.

    All fits of all candidates run together: see ``grid``.
    """
    unknown = set(grids) - set(grid.CANDIDATES)
    if unknown:
        raise ValueError(f"unknown candidate: {', '.join(sorted(unknown))}")
    table = grid.store(train, encoders[False, None], label, fold)
    points = {name: draw_parameters(g, draws, seed) for name, g in grids.items()}
    jobs = [(name, i, k) for name, own in points.items() for i in range(len(own)) for k in [*range(folds), None]]
    fits = [grid.Fit(slot, name, points[name][i], k, encoders[is_linear(name), k].fitted(), seed) for slot, (name, i, k) in enumerate(jobs)]
    found = grid.run(table, fits)
    recall = {(name, i, k): _recall(found[slot][1]) for slot, (name, i, k) in enumerate(jobs) if k is not None}
    candidates = []
    for name, own in points.items():
        scores = [[(k, recall[name, i, k]) for k in range(folds)] for i in range(len(own))]
        best = max(range(len(own)), key=lambda i: sum(s for _, s in scores[i]))
        whole = fits[jobs.index((name, best, None))]
        model = grid.fitted_model(table, whole, found[whole.slot][0])
        candidates.append(Candidate(name, own[best], PipelineModel([encoders[is_linear(name), None], model]), scores[best]))
    return candidates


def _recall(counts: Sequence[int]) -> float:
    """Of tn, fp, fn, tp; without positives 0."""
    *_, fn, tp = counts
    return round(tp / (fn + tp), 6) if fn + tp else 0.0


def fold_frame(spark: SparkSession, candidates: Sequence[Candidate]) -> DataFrame:
    rows = [(c.name, json.dumps(c.params, sort_keys=True), k, float(s)) for c in candidates for k, s in c.fold_scores]
    return spark.createDataFrame(rows, "model string, params string, fold int, score double")


def scored_by_all(candidates: Sequence[Candidate], df: DataFrame, label: str) -> DataFrame:
    """``(model, label, p)`` of every candidate from one scan: the models run one after another
    on the same row."""
    out = df
    for i, c in enumerate(candidates):
        out = c.model.transform(out).select(*out.columns, vector_to_array("probability")[1].alias(f"_p{i}"))
    cells = [F.struct(F.lit(c.name).alias("model"), F.col(f"_p{i}").alias("p")) for i, c in enumerate(candidates)]
    return out.select(F.col(label).alias("label"), F.inline(F.array(*cells)))


def evaluate(candidates: Sequence[Candidate], test: DataFrame, label: str) -> DataFrame:
    """Metrics of every candidate on the same rows, in one job."""
    return metrics.class_metrics(scored_by_all(candidates, test, label), ["model"])


METRICS_SCHEMA = "n_samples bigint, recall double, precision double, f1 double, roc_auc double, pr_auc double, log_loss double"


def champion_metrics(model: PipelineModel | Callable[[], PipelineModel] | None, test: DataFrame, label: str) -> DataFrame:
    """Metrics of the champion on the same rows; no rows if it is absent, or fails in any way.

    A champion may come as a function that loads it, so that one that cannot be loaded is no champion.
    """
    names = [part.split()[0] for part in METRICS_SCHEMA.split(", ")]
    none = test.sparkSession.createDataFrame([], METRICS_SCHEMA)
    if model is None:
        return none
    try:
        model = model() if callable(model) else model
        rows = scored(model, test, [F.col(label).alias("label")])
        found = metrics.class_metrics(rows.withColumn("model", F.lit("champion")), ["model"]).select(*names).collect()  # one row
    except Exception:  # noqa: BLE001  a champion that cannot be scored is no champion
        return none
    return test.sparkSession.createDataFrame(found, METRICS_SCHEMA)


IMPORTANCE_SCHEMA = "feature string, importance double, message string"


def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Importances, or coefficients of a linear model, by output name, largest first; a message for other models."""
    names = model.stages[0].output_names()
    last = model.stages[-1]
    if hasattr(last, "importances"):
        values = last.importances()
    elif hasattr(last, "featureImportances"):
        values = last.featureImportances.toArray()
    elif hasattr(last, "coefficients"):
        values = last.coefficients.toArray()
    else:
        return spark.createDataFrame([(None, None, fixed.NO_IMPORTANCE)], IMPORTANCE_SCHEMA)
    out = spark.createDataFrame([(n, float(v), None) for n, v in zip(names, values)], IMPORTANCE_SCHEMA)
    return out.withColumn("importance", F.round("importance", 5)).orderBy(F.desc("importance"), "feature")
