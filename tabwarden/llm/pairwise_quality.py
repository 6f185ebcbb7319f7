"""Document quality by pairwise ranking (Bradley-Terry).

A document's score is linear in style features: frequencies of pairs of character classes, word
shape and repetition. Weights are learned from pairs of a good and a bad document, by logistic loss
on the difference of their features (Newton steps). The threshold is a quantile of the scores: the
share of bad labels. A logistic curve around it gives a score from 0 to 1.

Features are computed in Arrow tasks over whole texts. Every labelled row that is not held out is learned
from, and every pair of a good and a bad one. A pair's loss hangs on the difference of two scores, so rows of
a label with nearly one score (``STEPS`` bins a unit around 0, wider ones further out) meet those of the other
label together, at the mean score of their bin: sums per bin give loss and gradient over all pairs, a second
pass the curvature, in time linear in the rows. Centre, scale and threshold are those of all rows.

Only where Newton's steps begin comes from a sample (``fit``, ``SAMPLE_DOCS`` rows a label, by a hash): it saves
passes over all rows. The loss has one least point, where the steps end. Sums are rounded, so that the order of
adding does not show.

Defined cases: null and empty texts have zero features and are scored; repeated rows give repeated
scores, and are learned from once; a document at the threshold has score 0.5 and counts as good; texts of any length are
read whole; an empty table gives no rows; without labelled rows of both kinds every score is 0.5; further columns are ignored;
labels of ids without a document count for nothing, a null label neither.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwarden.functions import sizing
from tabwarden.llm import words
from tabwarden.llm.language import held_out

#: Sample of the first weights: rows a label, pairs; penalty; steps on the sample.
SAMPLE_DOCS, PAIRS, RIDGE, ROUNDS = 3000, 20_000, 1e-3, 12
#: Steps on all rows at most, the gain of the loss and the step that end them; bins of scores; rows of a matrix added up together.
LONGEST, LEAST_GAIN, LEAST_STEP, STEPS, MATRIX_ROWS = 60, 1e-7, 1e-7, 64, 16
_GROUPS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r", ".", ",", "!?", "|", "#*$%&", "()[]{}\"'`", "-_/\\+=~^@:;<>")
N_CLASSES = 16
_CLASS = np.full(256, 12, np.uint8)
for _nr, _chars in enumerate(_GROUPS):
    _CLASS[[ord(c) for c in _chars]] = _nr
_CLASS[0x80:0xC0], _CLASS[0xC0:] = 13, 14
N_FEATURES = N_CLASSES * N_CLASSES + 5


def features(texts: pa.Array) -> np.ndarray:
    """One row of style features per text, null as empty."""
    raw = [(t or "").encode() for t in texts.to_pylist()]
    out = np.zeros((len(raw), N_FEATURES), np.float64)
    flat, counts = words.split_words(texts)
    at, distinct = words.coded(flat)
    doc = np.repeat(np.arange(len(raw)), counts)
    kinds = np.bincount(np.unique(doc * (len(distinct) + 1) + at) // (len(distinct) + 1), minlength=len(raw)) if len(at) else np.zeros(len(raw))
    for i, text in enumerate(raw):
        if not text:
            continue
        c = _CLASS[np.frombuffer(text, np.uint8)]
        pairs = np.bincount(c[:-1].astype(np.intp) * N_CLASSES + c[1:], minlength=N_CLASSES * N_CLASSES)
        out[i, : N_CLASSES * N_CLASSES] = np.sqrt(pairs / len(text))
        lines = text.split(b"\n")
        out[i, -5:] = np.log1p(len(text)) / 10, np.log1p(counts[i]) / 10, kinds[i] / max(1, counts[i]), min(4.0, len(text) / max(1, counts[i]) / 10), len(set(lines)) / len(lines)
    return out.astype(np.float32).astype(np.float64)  # as they are stored


class Ranker:
    """Centre and scale of the features, weights, threshold and spread of the scores."""

    def __init__(self):
        self.centre, self.scale, self.weights = np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES)
        self.threshold, self.spread = 0.0, 1.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.round(((x - self.centre) / self.scale) @ self.weights, 9)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip((self.raw(x) - self.threshold) / self.spread, -60, 60)))


def fit(x: np.ndarray, good: np.ndarray, share_bad: float, seed: int = 7) -> Ranker:
    """Learn from rows at hand; ``share_bad`` of all labels places the threshold."""
    model = Ranker()
    up, down = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(up) or not len(down):
        return model
    model.centre, model.scale = x.mean(0), x.std(0) + 1e-3
    z = (x - model.centre) / model.scale
    rng = np.random.default_rng(seed)
    d = z[rng.choice(up, PAIRS)] - z[rng.choice(down, PAIRS)]
    w = np.zeros(N_FEATURES)
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))  # chance of the wrong order
        grad = d.T @ p / PAIRS - RIDGE * w
        hess = (d * (p * (1 - p))[:, None]).T @ d / PAIRS + RIDGE * np.eye(N_FEATURES)
        w = w + np.linalg.solve(hess, grad)
    model.weights = w
    s = z @ w
    weight = np.where(good, (1 - share_bad) / len(up), share_bad / len(down))
    order = np.argsort(s)
    upto = np.cumsum(weight[order])
    cut = int(np.searchsorted(upto, share_bad - 1e-9))
    ahead = min(cut + 1, len(s) - 1)
    model.threshold = float((s[order[cut]] + s[order[ahead]]) / 2)
    model.spread = float(s.std()) + 1e-9
    return model


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in words.steps(batches, "text"):
        x = features(piece.column("text")).astype("<f4")
        yield pa.record_batch([piece.column("quality"), piece.column("g"), pa.array([r.tobytes() for r in x], pa.binary())], ["quality", "g", "x"])


def _matrix(cells: Iterable[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(cells), "<f4").reshape(-1, N_FEATURES).astype(np.float64)


def _summed(rows: DataFrame, sums: Callable[[np.ndarray, np.ndarray], Iterable[tuple[int, np.ndarray]]]) -> dict[int, np.ndarray]:
    """``sums(x, good)``, pairs of a key and an array, added up by key over all rows: in tasks, then per key."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows:
                x, good = _matrix(batch.column("x").to_pylist()), batch.column("quality").to_numpy(zero_copy_only=False) == 1
                for key, value in sums(x, good):
                    found[key] = found[key] + value if key in found else value
        if found:
            yield pa.record_batch([pa.array(list(found), pa.int64()), pa.array([v.tobytes() for v in found.values()], pa.binary())], ["key", "v"])

    def whole(piece: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v) for v in sorted(piece.column("v").to_pylist()))
        return pa.table({"key": piece.column("key").slice(0, 1), "v": pa.array([total.tobytes()], pa.binary())})

    found = rows.mapInArrow(part, "key bigint, v binary").groupBy("key").applyInArrow(whole, "key bigint, v binary").collect()  # a row a key
    return {r["key"]: np.frombuffer(r["v"]) for r in found}


def _bins(model: Ranker, x: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scaled features, and the bin of each row: by score, then by label."""
    return (x - model.centre) / model.scale, 2 * np.rint(STEPS * np.arcsinh(model.raw(x))).astype(np.int64) + good


def _bin_sums(model: Ranker):
    """Number of rows and sums of the scaled features of each bin."""

    def sums(x: np.ndarray, good: np.ndarray):
        z, bins = _bins(model, x, good)
        order = np.argsort(bins, kind="stable")
        keys, first, n = np.unique(bins[order], return_index=True, return_counts=True)
        return zip(keys.tolist(), np.column_stack([n, np.add.reduceat(z[order], first)]))

    return sums


def _curve_sums(model: Ranker, weights: dict[int, float]):
    """Sums of products of the scaled features, weighed by bin, in pieces of ``MATRIX_ROWS`` rows of the matrix."""
    known = np.array(sorted(weights))
    weight = np.array([weights[k] for k in sorted(weights)])

    def sums(x: np.ndarray, good: np.ndarray):
        z, bins = _bins(model, x, good)
        whole = (z * weight[np.searchsorted(known, bins)][:, None]).T @ z
        return [(k, whole[k : k + MATRIX_ROWS].ravel()) for k in range(0, N_FEATURES, MATRIX_ROWS)]

    return sums


def _ranked(rows: DataFrame, model: Ranker) -> None:
    """Newton steps on the loss of all pairs of a good and a bad row, from the weights of ``model``."""
    best, old = np.inf, model.weights
    for _ in range(LONGEST):
        found = _summed(rows, _bin_sums(model))
        keys = [sorted(k for k in found if k % 2 == good) for good in (0, 1)]
        down, up = (np.array([found[k] for k in own]) for own in keys)
        n_up, n_down = up[:, 0].sum(), down[:, 0].sum()
        share_up, share_down, z_up, z_down = up[:, 0] / n_up, down[:, 0] / n_down, up[:, 1:] / n_up, down[:, 1:] / n_down
        ahead = np.subtract.outer(z_up @ model.weights / share_up, z_down @ model.weights / share_down)
        loss = float(share_up @ np.logaddexp(0, -ahead) @ share_down + RIDGE / 2 * (model.weights**2).sum())
        if loss > best + LEAST_GAIN:
            model.weights = (model.weights + old) / 2
            if np.abs(model.weights - old).max() < LEAST_STEP:
                return
            continue
        if loss > best - LEAST_GAIN:
            return
        best, old = loss, model.weights
        wrong = 1 / (1 + np.exp(np.clip(ahead, -30, 30)))  # chance of the wrong order
        bend = wrong * (1 - wrong)
        grad = (wrong @ share_down) @ z_up - (share_up @ wrong) @ z_down - RIDGE * model.weights
        weights = dict(zip(keys[1], (bend @ share_down / n_up).tolist())) | dict(zip(keys[0], (share_up @ bend / n_down).tolist()))
        pieces = _summed(rows, _curve_sums(model, weights))
        cross = z_up.T @ bend @ z_down
        curve = np.concatenate([pieces[k] for k in sorted(pieces)]).reshape(N_FEATURES, N_FEATURES) - cross - cross.T + RIDGE * np.eye(N_FEATURES)
        model.weights = np.round(old + np.linalg.solve(curve, grad), 9)
        if np.abs(model.weights - old).max() < LEAST_STEP:
            return


def _at_rank(scores: DataFrame, rank: int, n: int) -> tuple[float, float]:
    """The score of ``rank``, from 0, among ``n`` in order, and the next one: exact, from the scores near it."""
    margin = 3e-5
    while True:
        ends = [max(0.0, rank / n - margin), min(1.0, (rank + 2) / n + margin)]
        low, high = scores.agg(F.percentile_approx("s", ends, 100_000)).first()[0]
        below = scores.where(F.col("s") < low).count()
        near = sorted(scores.where(F.col("s").between(low, high)).groupBy("s").count().collect())  # about a hundred in a million
        upto = below + np.cumsum([r["count"] for r in near])
        last = min(rank + 1, n - 1)
        if below <= rank and last < upto[-1]:
            return tuple(near[int(np.searchsorted(upto, k, side="right"))]["s"] for k in (rank, last))
        margin *= 10


def learn(docs: DataFrame, labels: DataFrame) -> Ranker:
    words.small_batches(docs.sparkSession)
    usable = labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").cast("int").alias("quality")).distinct()
    # A merge join at any size; what is equal lies together after it, so that ``distinct`` moves nothing.
    met = docs.select("doc_id", "text").where(~held_out(F.col("doc_id"))).join(usable.hint("merge"), "doc_id").distinct()
    g = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 1) / float(1 << 63)
    rows = sizing.cut_lineage(met.withColumn("g", g).mapInArrow(_feature_rows, "quality int, g double, x binary"), "features")
    n = {r["quality"]: r["count"] for r in rows.groupBy("quality").count().collect()}
    model, count = Ranker(), sum(n.values())
    if not n.get(0) or not n.get(1):
        return model

    def mean(of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        return np.round(_summed(rows, lambda x, _: [(0, of(x).sum(0))])[0] / count, 12)

    model.centre = centre = mean(lambda x: x)
    model.scale = np.sqrt(mean(lambda x: (x - centre) ** 2)) + 1e-3
    kept = " OR ".join(f"(quality = {q} AND g < {min(1.0, 2 * SAMPLE_DOCS / c)})" for q, c in n.items())
    sample = sorted(rows.where(kept).select("x", "quality").collect())  # about 4 * SAMPLE_DOCS rows at any size
    first = fit(_matrix(r["x"] for r in sample), np.array([r["quality"] == 1 for r in sample]), n[0] / count) if sample else None
    if first:
        model.weights = np.round(first.weights / first.scale * model.scale, 9)
    _ranked(rows, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([pa.array(model.raw(_matrix(batch.column("x").to_pylist())), pa.float64())], ["s"])

    scores = sizing.cut_lineage(rows.select("x").mapInArrow(run, "s double"), "scores")
    model.threshold = sum(_at_rank(scores, n[0] - 1, count)) / 2
    model.spread = round(scores.agg(F.stddev_pop("s")).first()[0], 9) + 1e-9
    return model


def score(docs: DataFrame, model: Ranker) -> DataFrame:
    """``doc_id``, ``score``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in words.steps(batches, "text"):
            yield pa.record_batch([piece.column("doc_id"), pa.array(model.score(features(piece.column("text"))))], ["doc_id", "score"])

    words.small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    scored = score(docs, learn(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
