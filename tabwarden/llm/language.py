"""Language of documents by a bidirectional gated recurrent network over bytes.

Two recurrences read a text's bytes forwards and backwards; every position gets a probability per
language from the two states that meet there, and a document the mean over its positions. The whole
text is read, in stretches of ``STRETCH`` bytes that start from a zero state, many side by side.

Training is numpy on the driver, by backpropagation through time with Adam, on a bounded sample:
``SAMPLE_DOCS`` documents a language, one passage of ``SAMPLE_CHARS`` characters of each, picked by a
hash of the id from the rows that may be learned from. Gates use x / (1 + |x|), which is cheap.

Both halves are one state of twice the width with block-diagonal recurrent weights, so each step is
one set of numpy calls.

Defined cases: null texts and texts without a letter get ``und`` with score 0; repeated rows give
repeated results; without any labelled row everything is ``und``; with one language that one is
predicted; of languages with equal probability the first by name; texts of any length are read whole; an empty table
gives no rows; columns other than ``doc_id``, ``text`` (and ``lang`` for learning) are passed over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwarden.llm import words

HIDDEN, STRETCH, LANES = 8, 64, 2048
SAMPLE_DOCS, SAMPLE_CHARS = 400, 512
#: Updates of the weights, whatever the size of the sample; stretches in each; first step size.
UPDATES, BATCH, RATE = 500, 256, 0.02
UNKNOWN = "und"
#: A document is accepted with at least this mean probability.
MIN_SCORE = 0.5
_LETTER = regex.compile(r"\p{L}")
_GATES = 3


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept for judging: its label is never read."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _bend(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


class Network:
    """Weights: a table of inputs per gate and direction, recurrent blocks, and the output layer."""

    def __init__(self, classes: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        h, k = HIDDEN, max(1, len(classes))
        self.classes = classes
        self.mask = np.zeros((2 * h, 2 * h), np.float32)
        self.mask[:h, :h] = self.mask[h:, h:] = 1
        draw = lambda *s, scale: rng.normal(0, scale, s).astype(np.float32)
        self.w = {
            "ahead": draw(_GATES, 256, 2 * h, scale=0.3) * (np.arange(2 * h) < h),
            "back": draw(_GATES, 256, 2 * h, scale=0.3) * (np.arange(2 * h) >= h),
            "rec": draw(_GATES, 2 * h, 2 * h, scale=0.3) * self.mask,
            "out_f": draw(2 * h, k, scale=0.3) * (np.arange(2 * h) < h)[:, None],
            "out_b": draw(2 * h, k, scale=0.3) * (np.arange(2 * h) >= h)[:, None],
            "bias": np.zeros(k, np.float32),
        }
        self.w = {n: v.astype(np.float32) for n, v in self.w.items()}

    def states(self, x: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States after every step; step t reads byte t forwards and byte -1-t backwards."""
        w, n = self.w, x.shape[1]
        (az, ar, an), (bz, br, bn), (uz, ur, un) = w["ahead"], w["back"], w["rec"]
        h = np.zeros((x.shape[0], 2 * HIDDEN), np.float32)
        out = np.empty((n, *h.shape), np.float32)
        for t in range(n):
            f, b = x[:, t], x[:, n - 1 - t]
            z = h @ uz
            z += az.take(f, 0)
            z += bz.take(b, 0)
            z /= 1 + np.abs(z)
            r = h @ ur
            r += ar.take(f, 0)
            r += br.take(b, 0)
            r /= 1 + np.abs(r)
            g = h @ un
            r *= 0.5
            r += 0.5
            c = r * g
            c += an.take(f, 0)
            c += bn.take(b, 0)
            c /= 1 + np.abs(c)
            z *= 0.5
            z += 0.5
            if keep is not None:
                keep.append((h, z, r, g, c))
            h = h - c
            h *= z
            h += c
            out[t] = h
        return out

    def probabilities(self, states: np.ndarray) -> np.ndarray:
        """Per position and stretch, the probability of each class."""
        logit = states @ self.w["out_f"]
        logit += states[::-1] @ self.w["out_b"]
        logit += self.w["bias"]
        np.exp(np.clip(logit, -30, 30, out=logit), out=logit)
        logit /= logit.sum(-1, keepdims=True)
        return logit

    def gradient(self, x: np.ndarray, valid: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        w, kept = self.w, []
        s = self.states(x, kept)
        p = self.probabilities(s)
        n, lanes, _ = s.shape
        weight = valid.T / valid.sum()
        loss = -float((np.log(p[:, np.arange(lanes), y] + 1e-9) * weight).sum())
        d = p
        d[:, np.arange(lanes), y] -= 1
        d *= weight[..., None]
        grad = {k: np.zeros_like(v) for k, v in w.items()}
        grad["bias"] = d.sum((0, 1))
        flat = lambda a: a.reshape(-1, a.shape[-1])
        grad["out_f"], grad["out_b"] = flat(s).T @ flat(d), flat(s[::-1]).T @ flat(d)
        ds = d @ w["out_f"].T + (d @ w["out_b"].T)[::-1]
        uz, ur, un = w["rec"]
        dh = np.zeros_like(s[0])
        for t in range(n - 1, -1, -1):
            h, z, r, g, c = kept[t]
            dh = dh + ds[t]
            dz = dh * (h - c) * 0.5 * np.square(1 - np.abs(2 * z - 1))
            dc = dh * (1 - z) * np.square(1 - np.abs(c))
            dg = dc * r
            dr = dc * g * 0.5 * np.square(1 - np.abs(2 * r - 1))
            for gate, delta in enumerate((dz, dr, dc)):
                np.add.at(grad["ahead"][gate], x[:, t], delta)
                np.add.at(grad["back"][gate], x[:, n - 1 - t], delta)
            for gate, delta in enumerate((dz, dr, dg)):
                grad["rec"][gate] += h.T @ delta
            dh = dh * z + dz @ uz.T + dr @ ur.T + dg @ un.T
        half = np.arange(2 * HIDDEN) < HIDDEN
        grad["ahead"] *= half
        grad["back"] *= ~half
        grad["rec"] *= self.mask
        grad["out_f"] *= half[:, None]
        grad["out_b"] *= ~half[:, None]
        return loss, grad


def stretches(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes in rows of ``STRETCH`` (zeros behind), the length of each row, and its text."""
    sizes = np.array([len(x) for x in raw], np.int64)
    rows = -(-sizes // STRETCH)
    x = np.zeros(int(rows.sum()) * STRETCH, np.uint8)
    x[words.ragged((np.cumsum(rows) - rows) * STRETCH, sizes)] = np.frombuffer(b"".join(raw), np.uint8)
    text = np.repeat(np.arange(len(raw)), rows)
    nth = words.ragged(np.zeros(len(raw), np.int64), rows)
    return x.reshape(-1, STRETCH), np.minimum(STRETCH, sizes[text] - nth * STRETCH), text


def fit(passages: list[tuple[str, str]], seed: int = 7, updates: int = UPDATES) -> Network:
    """Train on (language, passage) pairs."""
    classes = sorted({c for c, _ in passages})
    net = Network(classes, seed)
    if len(classes) < 2:
        return net
    x, size, text = stretches([p.encode() for _, p in passages])
    y = np.array([classes.index(c) for c, _ in passages])[text]
    valid = (np.arange(STRETCH) < size[:, None]).astype(np.float32)
    rng, step = np.random.default_rng(seed), 0
    m, v = ({k: np.zeros_like(a) for k, a in net.w.items()} for _ in range(2))
    while step < updates:
        order = rng.permutation(len(x))
        for begin in range(0, len(x), BATCH):
            pick = order[begin : begin + BATCH]
            _, grad = net.gradient(x[pick], valid[pick], y[pick])
            step += 1
            rate = RATE * max(0.0, 1 - step / (updates + 1))
            for k, g in grad.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                net.w[k] = (net.w[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def learn(docs: DataFrame) -> Network:
    """Network of the labelled rows that are not held out, from a bounded sample.

    Rows are picked by the hash of their id and text, and equal rows are one, so the sample is bounded
    whichever id or text is repeated how often.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("doc_id")))
    rows = rows.select("lang", "doc_id", "text", F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit("sample")), 1).alias("h"))
    counts = dict(rows.groupBy("lang").count().collect())  # one row per language
    if not counts:
        return Network([])
    share = F.element_at(F.create_map(*[F.lit(x) for c, n in counts.items() for x in (c, min(1.0, 1.5 * SAMPLE_DOCS / n + 50 / n))]), F.col("lang"))
    at = (F.pmod("h", F.greatest(F.length("text") - SAMPLE_CHARS + 1, F.lit(1))) + 1).cast("int")
    picked = rows.where(F.col("h") / float(1 << 63) < share).select("lang", "h", F.col("text").substr(at, F.lit(SAMPLE_CHARS)).alias("passage")).distinct().collect()
    found: dict[str, list] = {}
    for r in sorted(picked, key=lambda r: (r["lang"], r["h"], r["passage"])):
        found.setdefault(r["lang"], []).append((r["lang"], r["passage"]))
    return fit([p for rows_ in found.values() for p in rows_[:SAMPLE_DOCS]])


def judge(net: Network, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Predicted language and score of each text."""
    out, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
    known = [i for i, t in enumerate(texts) if t and _LETTER.search(t)] if net.classes else []
    if not known:
        return out, score
    x, size, text = stretches([texts[i].encode() for i in known])
    pooled = np.zeros((len(known), len(net.classes)))
    for a in range(0, len(x), LANES):
        p = net.probabilities(net.states(x[a : a + LANES]))
        inside = np.arange(STRETCH)[:, None] < size[a : a + LANES]
        sums = np.einsum("tlk,tl->lk", p, inside.astype(np.float32))
        for k in range(len(net.classes)):
            pooled[:, k] += np.bincount(text[a : a + LANES], sums[:, k], len(known))
    pooled /= pooled.sum(1, keepdims=True)
    best = pooled.argmax(1)
    for i, b in zip(known, best):
        out[i] = net.classes[b]
    score[known] = np.minimum(1.0, pooled[np.arange(len(known)), best])
    return out, score


def predict(docs: DataFrame, net: Network) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in words.steps(batches, "text"):
            lang, score = judge(net, piece.column("text").to_pylist())
            yield pa.record_batch([piece.column("doc_id"), pa.array(lang, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    words.small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def accepted(docs: DataFrame, net: Network) -> DataFrame:
    """The rows whose language is known with ``MIN_SCORE``; all columns as they were."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in words.steps(batches, "text"):
            lang, score = judge(net, piece.column("text").to_pylist())
            yield piece.filter(pc.and_(pa.array([x != UNKNOWN for x in lang]), pa.array(score >= MIN_SCORE)))
        words.trim()

    words.small_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = predict(docs, learn(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
