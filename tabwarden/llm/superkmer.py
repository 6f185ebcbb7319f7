"""Substring dedup: words covered by a window that an earlier document starts too are removed.

A window is ``WINDOW`` consecutive words. Its minimiser is the smallest hash among its runs of
``MINIMISER`` words; consecutive windows with one minimiser travel as one packed string, a
super-k-mer, to the bucket of that minimiser. So equal windows meet in one bucket, and a word is
sent about three times instead of thirteen.

1. Documents are written as blocks of a few MB (ids and compressed words).
2. Each block sends its distinct super-k-mers, with the smallest and largest id of the documents that
   hold them, as one compressed row per bucket. A passage that a third of all documents share is
   one string per block here, however often it occurs.
3. A bucket sorts its windows by hash, compares the words of equal ones (so counts are exact), and
   takes the first document of each. Where that is earlier than some document of the sender, it
   answers the block: which super-k-mer, and the first document of each of its windows.
4. A block and its answers meet; words of windows whose first document is earlier are dropped.

Buckets grow in number with the bytes of the input, blocks are of bounded size (a longer single text
is a block of its own), and no group is keyed by a text or a document.

Defined cases: a null text has no words; texts under ``WINDOW`` words lose none; rows with equal ids
do not shadow each other; a null id counts as later than every other; words are compared as bytes,
unchanged; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwarden.functions import sizing
from tabwarden.llm import words

WINDOW, MINIMISER = 13, 3
#: Text in a block, and packed text in a bucket (about three times the input travels).
BLOCK_BYTES, BUCKET_BYTES = 8 << 20, 10 << 20
_SPREAD = 3
_LAST = np.iinfo(np.int64).max
_SPACE, _LINE = " ", "\n"


def blocks(docs: DataFrame) -> DataFrame:
    """``block``, ``doc_ids``, ``n_words``, ``body`` (words by blanks, documents by line feeds, compressed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, press = TaskContext.get().partitionId(), zstandard.ZstdCompressor(level=3)
        for nr, piece in enumerate(words.gathered(batches, "text", BLOCK_BYTES)):
            flat, counts = words.split_words(piece.column("text"))
            body = press.compress(_LINE.join(_joined(flat, counts).to_pylist()).encode())
            ids = words.one_array(piece.column("doc_id"))
            yield pa.record_batch(
                [pa.array([part << 32 | nr]), pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([counts.tolist()], pa.list_(pa.int64())), pa.array([body], pa.binary())],
                ["block", "doc_ids", "n_words", "body"],
            )

    words.small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, "block bigint, doc_ids array<bigint>, n_words array<bigint>, body binary")


def _joined(flat: pa.Array, counts: np.ndarray) -> pa.Array:
    """One string per row of the ragged words."""
    ends = np.concatenate([[0], np.cumsum(counts)])
    if ends[-1] >= 1 << 31:
        raise ValueError("a block of 2**31 words or more")
    if len(flat):
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat), _SPACE)
    return pa.array([""] * len(counts))


def _unpack(body: bytes) -> pa.Array:
    """All words of a block in order."""
    text = pa.array([zstandard.ZstdDecompressor().decompress(body, max_output_size=1 << 31).decode()])
    return words.split_words(text)[0]


class Runs:
    """The super-k-mers of a block: always the same for the same words."""

    def __init__(self, flat: pa.Array, n_words: np.ndarray, doc_ids: np.ndarray):
        at, distinct = words.coded(flat)
        h = words.hashes(distinct)[at]
        valid = words.window_starts(n_words, WINDOW)
        if not len(valid):
            self.n = 0
            return
        n = len(h) - MINIMISER + 1
        smallest = words.mix(h[:n] * np.uint64(3) + h[1 : n + 1] * np.uint64(5) + h[2 : n + 2] * np.uint64(7))
        span, have = WINDOW - MINIMISER + 1, 1
        while have < span:
            step = min(have, span - have)
            smallest = np.minimum(smallest[:-step], smallest[step:])
            have += step
        mins = smallest[valid]
        first = np.flatnonzero(np.concatenate([[True], (np.diff(valid) != 1) | (mins[1:] != mins[:-1])]))
        start, size = valid[first], np.diff(np.append(first, len(valid)))
        doc = np.repeat(np.arange(len(n_words)), n_words)[start]
        key = words.Spans(h).of(start, size + WINDOW - 1)
        order = np.lexsort((size, key))
        key_o, size_o = key[order], size[order]
        same = (key_o[1:] == key_o[:-1]) & (size_o[1:] == size_o[:-1])
        lead = np.concatenate([[0], np.where(same, 0, np.arange(1, len(order)))])
        lead = np.maximum.accumulate(lead)
        twins = np.flatnonzero(np.concatenate([[False], same]))
        if len(twins):  # equal hashes: compare the words, keep apart what differs
            length = size_o[twins] + WINDOW - 1
            wrong = at[words.ragged(start[order[twins]], length)] != at[words.ragged(start[order[lead[twins]]], length)]
            bad = twins[np.unique(np.repeat(np.arange(len(twins)), length)[wrong])]
            lead[bad] = bad
        order = order[np.argsort(lead, kind="stable")]
        lead = np.sort(lead, kind="stable")
        begin = np.flatnonzero(np.concatenate([[True], lead[1:] != lead[:-1]]))
        owner = doc_ids[doc[order]]
        #: Occurrences in order of their string: first word, document id; and where each string's ones begin.
        self.n, self.start, self.owner, self.begin = len(begin), start[order], owner, begin
        self.size = size[order][begin]
        self.bucket_hash = mins[first][order][begin]
        self.low, self.high = np.minimum.reduceat(owner, begin), np.maximum.reduceat(owner, begin)
        self.count = np.diff(np.append(begin, len(order)))


def _ids(column) -> np.ndarray:
    return pc.fill_null(words.one_array(column), _LAST).to_numpy(zero_copy_only=False)


def _block_runs(row_ids, row_counts, body) -> tuple[pa.Array, np.ndarray, np.ndarray, Runs]:
    flat, counts = _unpack(body), np.array(row_counts, np.int64)
    ids = np.array([_LAST if i is None else i for i in row_ids], np.int64)
    return flat, counts, ids, Runs(flat, counts, ids)


def send(stored: DataFrame, n_buckets: int) -> DataFrame:
    """``bucket``, ``block``, ``low``, ``high``, ``place`` (arrays per super-k-mer) and the packed ``strings``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for row in range(batch.num_rows):
                flat, _, _, runs = _block_runs(*(batch.column(c)[row].as_py() for c in ("doc_ids", "n_words", "body")))
                if not runs.n:
                    continue
                bucket = (runs.bucket_hash % np.uint64(n_buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                cut = np.append(np.flatnonzero(np.concatenate([[True], np.diff(bucket[order]) != 0])), len(order))
                out: list[list] = [[], [], []]
                for b, e in zip(cut[:-1], cut[1:]):
                    part = order[b:e]
                    length = runs.size[part] + WINDOW - 1
                    text = _joined(flat.take(pa.array(words.ragged(runs.start[runs.begin[part]], length))), length)
                    head = np.concatenate([[len(part)], part, runs.low[part], runs.high[part]]).astype("<i8").tobytes()
                    out[0].append(int(bucket[part[0]]))
                    out[1].append(batch.column("block")[row].as_py())
                    out[2].append(press.compress(head + _LINE.join(text.to_pylist()).encode()))
                yield pa.record_batch([pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())], ["bucket", "block", "strings"])

    return stored.mapInArrow(run, "bucket int, block bigint, strings binary")


def _same_windows(at: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows sorted so that equal ones stand together, and where each set begins. Exact."""
    h = words.mix(at.astype(np.uint64) + np.uint64(1))
    key = words.Spans(h).of(starts, WINDOW)
    order = np.argsort(key, kind="stable")
    equal = np.flatnonzero(key[order][1:] == key[order][:-1])
    a, b = starts[order[equal]], starts[order[equal + 1]]
    if all(np.array_equal(at[a + k], at[b + k]) for k in range(WINDOW)):
        fresh = np.ones(len(order), bool)
        fresh[equal + 1] = False
        return order, np.flatnonzero(fresh)
    order = np.lexsort([at[starts + k] for k in range(WINDOW)])  # a hash met twice: sort the words themselves
    s = starts[order]
    fresh = np.zeros(len(order), bool)
    for k in range(WINDOW):
        fresh[1:] |= at[s[1:] + k] != at[s[:-1] + k]
    fresh[0] = True
    return order, np.flatnonzero(fresh)


def answer(sent: DataFrame) -> DataFrame:
    """``block``, ``reply``: places of super-k-mers and the first document of each of their windows."""

    def work(table: pa.Table) -> pa.Table:
        press, unpress = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()
        senders, places, lows, highs, texts = [], [], [], [], []
        for block, strings in zip(table.column("block").to_pylist(), table.column("strings").to_pylist()):
            raw = unpress.decompress(strings, max_output_size=1 << 31)
            n = int(np.frombuffer(raw, "<i8", 1)[0])
            head = np.frombuffer(raw, "<i8", 3 * n, 8).reshape(3, n)
            senders.append(np.full(n, block))
            for into, part in zip((places, lows, highs), head):
                into.append(part)
            texts += raw[8 + 24 * n :].decode().split(_LINE)
        sender, place, low, high = (np.concatenate(x) for x in (senders, places, lows, highs))
        flat, counts = words.split_words(pa.array(texts))
        del texts
        at, _ = words.coded(flat)
        size = counts - WINDOW + 1
        starts = words.ragged(np.cumsum(counts) - counts, size)
        of = np.repeat(np.arange(len(size)), size)
        order, begin = _same_windows(at, starts)
        first = np.empty(len(starts), np.int64)
        first[order] = np.repeat(np.minimum.reduceat(low[of[order]], begin), np.diff(np.append(begin, len(order))))
        ahead = np.cumsum(size) - size
        hit = np.flatnonzero(np.minimum.reduceat(first, ahead) < high)
        hit = hit[np.argsort(sender[hit], kind="stable")]
        cut = np.append(np.flatnonzero(np.concatenate([[True], np.diff(sender[hit]) != 0])), len(hit)) if len(hit) else np.zeros(1, np.int64)
        blocks_, replies = [], []
        for b, e in zip(cut[:-1], cut[1:]):
            part = hit[b:e]
            values = first[words.ragged(ahead[part], size[part])]
            replies.append(press.compress(np.concatenate([[len(part)], place[part], size[part], values]).astype("<i8").tobytes()))
            blocks_.append(int(sender[part[0]]))
        return pa.table({"block": pa.array(blocks_, pa.int64()), "reply": pa.array(replies, pa.binary())})

    return sent.groupBy("bucket").applyInArrow(work, "block bigint, reply binary")


def settle(stored: DataFrame, answers: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_text`` (kept words by one blank)."""

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in range(left.num_rows):
            flat, counts, ids, runs = _block_runs(*(left.column(c)[row].as_py() for c in ("doc_ids", "n_words", "body")))
            mark = np.zeros(len(flat) + 1, np.int64)
            for reply in right.column("reply").to_pylist():
                raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(reply, max_output_size=1 << 31), "<i8")
                n = int(raw[0])
                place, size, values = raw[1 : n + 1], raw[n + 1 : 2 * n + 1], raw[2 * n + 1 :]
                ahead, times = np.cumsum(size) - size, runs.count[place]
                spot = words.ragged(runs.begin[place], times)  # occurrences of the strings answered
                string = np.repeat(np.arange(n), times)
                window = words.ragged(runs.start[spot], size[string])
                earlier = values[words.ragged(ahead[string], size[string])] < np.repeat(runs.owner[spot], size[string])
                mark[: len(flat)] += np.bincount(window[earlier], minlength=len(flat))
            starts = np.flatnonzero(mark)
            cover = np.zeros(len(flat) + WINDOW + 1, np.int64)
            cover[starts] += 1
            cover[starts + WINDOW] -= 1
            gone = np.cumsum(cover)[: len(flat)] > 0
            doc = np.repeat(np.arange(len(counts)), counts)
            removed = np.bincount(doc[gone], minlength=len(counts))
            kept = _joined(flat.filter(pa.array(~gone)), counts - removed)
            out.append(pa.table({
                "doc_id": left.column("doc_ids")[row].values, "n_words": pa.array(counts), "n_removed": pa.array(removed.astype(np.int64)), "kept_text": pc.fill_null(kept, "").cast(pa.string()),
            }))
        return pa.concat_tables(out) if out else pa.table({"doc_id": pa.array([], pa.int64()), "n_words": pa.array([], pa.int64()), "n_removed": pa.array([], pa.int64()), "kept_text": pa.array([], pa.string())})

    return stored.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(work, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string")


def dedup(docs: DataFrame) -> DataFrame:
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(1, -(-_SPREAD * size // BUCKET_BYTES))
    stored = sizing.cut_lineage(blocks(docs), "word_blocks")
    answers = sizing.cut_lineage(answer(send(stored, n_buckets)), "window_answers")
    return settle(stored, answers)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
w AS (SELECT rid, doc_id, p, md5(array_to_string(words[p : p + {WINDOW - 1}], ' ')) AS win FROM d, unnest(generate_series(1, len(words) - {WINDOW - 1})) AS u(p)),
f AS (SELECT win, min(doc_id) AS first_id FROM w GROUP BY win HAVING count(DISTINCT doc_id) > 1),
g AS (SELECT rid, list(p) AS starts FROM w JOIN f USING (win) WHERE doc_id > first_id GROUP BY rid),
c AS (SELECT DISTINCT rid, p + k AS p FROM g, unnest(starts) AS s(p), generate_series(0, {WINDOW - 1}) AS t(k)),
r AS (SELECT rid, count(*) AS n, list(p) AS gone FROM c GROUP BY rid),
k AS (SELECT d.rid, string_agg(u.x, ' ' ORDER BY u.p) AS kept
  FROM (SELECT rid, unnest(words) AS x, generate_subscripts(words, 1) AS p FROM d) AS u JOIN d ON d.rid = u.rid
  ANTI JOIN c ON c.rid = u.rid AND c.p = u.p GROUP BY d.rid)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(r.n, 0)::BIGINT AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN r ON r.rid = d.rid LEFT JOIN k ON k.rid = d.rid
"""
