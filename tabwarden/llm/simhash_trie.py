"""Near duplicates by SimHash, joined with itself as a binary trie.

A fingerprint has 64 bits; bit b is 1 if it is set in over half the XXH64 hashes of the text's
4-word shingles. Two texts are linked if their fingerprints differ in at most ``BUDGET`` bits.

Equal fingerprints are one row before any join. The distinct ones form a binary trie. Node pairs
are traversed together from the top: bits in which two nodes differ add up, and a pair whose sum
passes the error budget is dropped with everything below. Four errors put at most two into one half
of the bits, so the traversal runs twice: with two errors allowed in the first half, and, over the
fingerprints turned by 32 bits, with one. That finds every link and prunes near the top.

The upper trie is cut where a node holds few enough fingerprints; only counts of prefixes reach the
driver. Surviving pairs of these nodes are the units of work: a fingerprint travels once to each
pair of its node, and a group is two nodes at most. Below, a node is a range of a sorted array. A
pair that lies in one known component already is skipped, and only links that join two components
of the unit are emitted: a group of n near copies gives n - 1 links, not all pairs.

Defined cases: null and empty texts have fingerprint zero and are linked like any other; fewer than
four words make one shingle; repeated rows are repeated results; a null ``doc_id`` counts for no
smallest id (a component of such rows alone has a null id); further columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwarden.functions import sizing
from tabwarden.llm import graph, words

SHINGLE, SEED, BUDGET = 4, 42, 4
#: Turn of the bits, errors allowed in the first 32 of them.
PASSES = ((0, 2), (32, 1))
#: Fingerprints in a node of the upper trie, and how many such nodes there are at most.
NODE_ROWS, MAX_NODES = 16_384, 8_192
#: Node pairs looked at in one step.
STEP_PAIRS = 1 << 17
_ALL = (1 << 64) - 1


def fingerprint(text: str | None) -> int:
    tokens = (text or "").encode().lower().split()  # bytes: A-Z only, ASCII white space only
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens])
    begins = [0, *ends[:-1].tolist()]
    last = max(1, len(tokens) - SHINGLE + 1)
    stops = (ends - 1).tolist()[min(SHINGLE, len(tokens)) - 1 :]
    digest = xxhash.xxh64_digest
    raw = b"".join([digest(joined[b:e], SEED) for b, e in zip(begins[:last], stops)])
    bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(last, 8), axis=1)
    return int.from_bytes(np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > last).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``t`` (hash of the text), ``fp`` (the 64 bits as a signed integer)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in words.steps(batches, "text"):
            fps = np.fromiter((fingerprint(t) for t in piece.column("text").to_pylist()), np.uint64, piece.num_rows)
            yield pa.record_batch([piece.column("doc_id"), piece.column("t"), pa.array(fps.view(np.int64))], ["doc_id", "t", "fp"])

    words.small_batches(docs.sparkSession)
    return docs.select("doc_id", "text", F.xxhash64("text").alias("t")).mapInArrow(run, "doc_id bigint, t bigint, fp bigint")


def _turned(fp: np.ndarray, turn: int) -> np.ndarray:
    x = fp.view(np.uint64)
    return (x << np.uint64(turn)) | (x >> np.uint64(64 - turn)) if turn else x


def upper_nodes(fps: DataFrame, turn: int, total: int) -> list[tuple[int, int]]:
    """Cut of the trie: (depth, prefix) of nodes with few enough fingerprints, in order of prefix."""
    limit = max(NODE_ROWS, total // (MAX_NODES // 4))
    key = F.shiftleft("fp", turn).bitwiseOR(F.shiftrightunsigned("fp", 64 - turn)) if turn else F.col("fp")
    keyed = fps.select(key.alias("key"))
    depth = 1
    while total >> depth > limit // 2 and depth < 12:
        depth += 1
    done: list[tuple[int, int]] = []
    counts = keyed.groupBy(F.shiftrightunsigned("key", 64 - depth).alias("p")).count().collect()  # at most 2**12 prefixes
    while counts:
        done += [(depth, r["p"]) for r in counts if r["count"] <= limit or depth >= 62]
        hot = [r["p"] for r in counts if r["count"] > limit and depth < 62]
        if not hot:
            break
        wide = keyed.where(F.shiftrightunsigned("key", 64 - depth).isin(hot))
        depth += 2
        counts = wide.groupBy(F.shiftrightunsigned("key", 64 - depth).alias("p")).count().collect()
    return sorted(done, key=lambda x: x[1] << (64 - x[0]))


def upper_pairs(nodes: list[tuple[int, int]], errors: int) -> list[tuple[int, int]]:
    """Pairs of places in ``nodes`` whose prefixes keep within the errors of the first half."""
    children: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for d, p in nodes:
        while d:
            up = (d - 1, p >> 1)
            kids = children.setdefault(up, [])
            if (d, p) in kids:
                break
            kids.append((d, p))
            d, p = up
    place = {n: i for i, n in enumerate(nodes)}
    found, stack = [], [((0, 0), (0, 0))] if nodes else []
    while stack:
        a, b = stack.pop()
        common = min(a[0], b[0])
        differ = (a[1] >> (a[0] - common)) ^ (b[1] >> (b[0] - common))
        if (differ >> max(0, common - 32)).bit_count() > errors or differ.bit_count() > BUDGET:
            continue
        if a in place and b in place:
            found.append((min(place[a], place[b]), max(place[a], place[b])))
        elif a == b:
            kids = children.get(a, [])
            stack += [(x, y) for i, x in enumerate(kids) for y in kids[i:]]
        elif a in place or (b not in place and b[0] < a[0]):
            stack += [(a, y) for y in children.get(b, [])]
        else:
            stack += [(x, b) for x in children.get(a, [])]
    return sorted(set(found))


def _depth(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Leading bits that all of a sorted range share."""
    x = first ^ last
    for s in (1, 2, 4, 8, 16, 32):
        x = x | (x >> np.uint64(s))
    return 64 - np.bitwise_count(x).astype(np.int64)


class _Groups:
    """Components of the fingerprints of one unit, for pruning and for thinning out links."""

    def __init__(self, n: int):
        self.parent = list(range(n))
        self.refresh()

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
        kept = []
        for x, y in zip(a.tolist(), b.tolist()):
            p, q = self.find(x), self.find(y)
            if p != q:
                self.parent[max(p, q)] = min(p, q)
                kept.append((x, y))
        if kept:
            self.refresh()
        return kept

    def refresh(self) -> None:
        label = np.array(self.parent)
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up
        self.label = label
        self.changes = np.concatenate([[0], np.cumsum(label[1:] != label[:-1])]) if len(label) else label

    def one(self, alo, ahi, blo, bhi) -> np.ndarray:
        c = self.changes
        return (c[ahi - 1] == c[alo]) & (c[bhi - 1] == c[blo]) & (self.label[alo] == self.label[blo])


def unit_links(a: np.ndarray, b: np.ndarray | None, errors: int) -> np.ndarray:
    """Links (rows of two fingerprints) between two sorted nodes, or within one if ``b`` is None."""
    x = a if b is None else np.concatenate([a, b])
    n, empty = len(a), np.zeros((0, 2), np.uint64)
    if not n or not len(x) - n and b is not None:
        return empty
    groups, links = _Groups(len(x)), []
    near = np.flatnonzero(np.bitwise_count(x[1:] ^ x[:-1]) <= BUDGET)
    if b is not None:
        near = near[near != n - 1]
    groups.join(near, near + 1)  # neighbours in order: mostly found by the units of one node, so not emitted there
    if b is None:
        links += [(int(x[i]), int(x[i + 1])) for i in near]
    one = np.array([0]), np.array([n]), (np.array([0]) if b is None else np.array([n])), np.array([len(x)])
    stack = [one]
    while stack:
        alo, ahi, blo, bhi = stack.pop()
        if len(alo) > STEP_PAIRS:
            stack.append(tuple(v[STEP_PAIRS:] for v in (alo, ahi, blo, bhi)))
            alo, ahi, blo, bhi = (v[:STEP_PAIRS] for v in (alo, ahi, blo, bhi))
        da, db = _depth(x[alo], x[ahi - 1]), _depth(x[blo], x[bhi - 1])
        common = np.minimum(da, db)
        differ = x[alo] ^ x[blo]
        shared = np.where(common > 0, differ >> np.minimum(64 - common, 63).astype(np.uint64), 0).astype(np.uint64)
        high = np.where(common > 0, differ >> np.minimum(64 - np.minimum(common, 32), 63).astype(np.uint64), 0).astype(np.uint64)
        keep = (np.bitwise_count(shared) <= BUDGET) & (np.bitwise_count(high) <= errors) & ~groups.one(alo, ahi, blo, bhi)
        if not keep.any():
            continue
        alo, ahi, blo, bhi, da, db = (v[keep] for v in (alo, ahi, blo, bhi, da, db))
        leaf = (da == 64) & (db == 64)
        if leaf.any():
            links += [(int(x[p]), int(x[q])) for p, q in groups.join(alo[leaf], blo[leaf])]
            alo, ahi, blo, bhi, da, db = (v[~leaf] for v in (alo, ahi, blo, bhi, da, db))
        if not len(alo):
            continue
        same = alo == blo
        on_a = same | (da <= db)
        lo, hi, d = np.where(on_a, alo, blo), np.where(on_a, ahi, bhi), np.where(on_a, da, db)
        shift = (63 - d).astype(np.uint64)
        bound = (x[hi - 1] >> shift) << shift
        # both halves of x are sorted on their own, so a search per half
        inside = lo < n
        cut = np.empty(len(lo), np.int64)
        cut[inside] = np.searchsorted(x[:n], bound[inside])
        if not inside.all():
            cut[~inside] = n + np.searchsorted(x[n:], bound[~inside])
        pa_, pb_ = on_a & ~same, ~on_a
        stack.append((
            np.concatenate([lo[same], cut[same], lo[same], lo[pa_], cut[pa_], alo[pb_], alo[pb_]]),
            np.concatenate([cut[same], hi[same], cut[same], cut[pa_], hi[pa_], ahi[pb_], ahi[pb_]]),
            np.concatenate([lo[same], cut[same], cut[same], blo[pa_], blo[pa_], lo[pb_], cut[pb_]]),
            np.concatenate([cut[same], hi[same], hi[same], bhi[pa_], bhi[pa_], cut[pb_], hi[pb_]]),
        ))
    return np.array(links, np.uint64).reshape(-1, 2) if links else empty


def links(fps: DataFrame, turn: int, errors: int, total: int) -> DataFrame:
    """Links ``a``, ``b`` of one traversal over distinct ``fp``."""
    nodes = upper_nodes(fps, turn, total)
    pairs = upper_pairs(nodes, errors)
    starts = np.array([p << (64 - d) for d, p in nodes], np.uint64)
    of = [[] for _ in nodes]
    for k, (i, j) in enumerate(pairs):
        of[i].append((k, 0))
        if i != j:
            of[j].append((k, 1))
    sizes = np.array([len(x) for x in of], np.int64)
    table = np.array([y for x in of for y in x], np.int64).reshape(-1, 2)
    begins = np.cumsum(sizes) - sizes
    alone = {k for k, (i, j) in enumerate(pairs) if i == j}

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy()
            node = np.searchsorted(starts, _turned(fp, turn), side="right") - 1
            to = table[words.ragged(begins[node], sizes[node])]
            yield pa.record_batch([pa.array(to[:, 0].astype(np.int32)), pa.array(to[:, 1].astype(np.int8)), pa.array(np.repeat(fp, sizes[node]))], ["unit", "side", "fp"])

    def work(table: pa.Table) -> pa.Table:
        unit = table.column("unit")[0].as_py()
        fp, side = _turned(table.column("fp").to_numpy(), turn), table.column("side").to_numpy()
        a, b = np.sort(fp[side == 0]), None if unit in alone else np.sort(fp[side == 1])
        found = _turned(unit_links(a, b, errors).reshape(-1), (64 - turn) % 64).view(np.int64).reshape(-1, 2)
        return pa.table({"a": found[:, 0], "b": found[:, 1]})

    if not nodes:
        return fps.sparkSession.createDataFrame([], "a bigint, b bigint")
    return fps.select("fp").mapInArrow(send, "unit int, side tinyint, fp bigint").groupBy("unit").applyInArrow(work, "a bigint, b bigint")


def near_rows(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``t`` (hash of the text), ``fp``, ``root`` (a fingerprint that names the component), ``component_id`` (its smallest id)."""
    marked = sizing.cut_lineage(fingerprints(docs), "fingerprints")
    classes = sizing.cut_lineage(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    total = classes.count()
    found = None
    for turn, errors in PASSES:
        part = links(classes, turn, errors, total)
        found = part if found is None else found.unionByName(part)
    roots = graph.components(found, "simhash_links")
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "root").select("fp", "root", "component_id")
    return marked.join(named, "fp").select("doc_id", "t", "fp", "root", "component_id")


def near_groups(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fp``, ``component_id`` (smallest id reachable over links)."""
    return near_rows(docs).select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each component stays, the one with the smallest id; columns as they were.

    Rows are judged one by one: rows of one id whose texts are in different components all can stay.
    Among texts of the smallest id the one with the smallest hash stays, and of equal rows one; a row
    without an id stays if no row of its component has one.
    """
    rows = near_rows(docs).groupBy("doc_id", "t", "root").agg(F.count(F.lit(1)).alias("n"))
    best = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "t", "n")).alias("best"))
    best = sizing.cut_lineage(best.select(F.col("best.doc_id").alias("best_id"), F.col("best.t").alias("best_text"), F.col("best.n").alias("best_n")), "best")
    mine = docs["doc_id"].eqNullSafe(best["best_id"]) & (F.xxhash64(docs["text"]) == best["best_text"])
    once, twice = best.where("best_n = 1"), best.where("best_n > 1")
    kept = docs.join(once, mine, "left_semi")
    if twice.isEmpty():
        return kept
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    repeated = docs.join(twice, mine, "left_semi").groupBy("doc_id", F.xxhash64("text").alias("same")).agg(F.min_by(whole, F.xxhash64(F.to_json(whole))).alias("row"))
    return kept.unionByName(repeated.select("row.*"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
