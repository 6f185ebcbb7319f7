"""Spelling variants of the words of a corpus: near words, the common form of each, and its root.

Two words are near if one inserted, deleted or replaced code point turns one into the other. They are
found by pivotal grams. Bigrams have one global order, rare ones first. The gram prefix of a word is
its three first bigrams in that order (with all that tie with the third). Two disjoint bigrams of the
prefix, chosen by dynamic programming for least total frequency, are the word's pivots.

One edit cannot touch both pivots. If it lies before the right pivot, the word from there to its end
is also the end of the near word; otherwise the word up to the end of the left pivot is also its
beginning. In either case the untouched pivot is a bigram of the near word, at the same place from the
start or from the end, and in its gram prefix if that prefix reaches at least as far in the global
order. So pivots of the word with the lesser (last gram, word) meet gram prefixes of the other, under
a key of direction, length of the other word, and the untouched piece, which fixes gram and position.
Candidates are verified: the word is parted between its pivots, the part that the edit leaves alone must
be equal, and the edit distance one. No pair is found twice and none is missed.

Words are counted inside tasks before the shuffle. A popular key is a few bigrams at a word's very
edge; it grows with the vocabulary, not with the corpus, and large partitions of the join are split.

Defined cases: a null text has no words; a null ``doc_id`` is spelled as an empty text in the hash;
repeated rows count again; texts of any length are read whole; ties for the form go to the smallest
word in code-point order; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwarden.functions import sizing
from tabwarden.llm import words

#: Shortest word in code points, fewest occurrences, how many times more often a form occurs.
SHORTEST, LEAST, TIMES = 7, 2, 10
#: A run whose hash this number divides loses one code point.
DAMAGED = 31
#: Distinct words counted in a task before they are handed on, and characters matched at once.
_HELD, _LONG = 500_000, 1 << 20
_RUN = re.compile(f"[a-zÀ-ÿ]{{{SHORTEST},}}")


def _runs(text: str):
    """Lower-cased maximal runs that can become words; only A-Z change."""
    low = text.encode().lower().decode()
    return _RUN.findall(low) if len(low) < _LONG else (m.group() for m in _RUN.finditer(low))


def document_words(doc_id, text: str) -> Counter:
    """Words of one document and how often they occur."""
    begin = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    found = Counter()
    for run, n in Counter(_runs(text)).items():
        h = zlib.crc32(run.encode(), begin)
        if h % DAMAGED == 0:
            cut = h % len(run)
            run = run[:cut] + run[cut + 1 :]
            if len(run) < SHORTEST:
                continue
        found[run] += n
    return found


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word``, ``n`` of the words that occur often enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def counted():
            return pa.record_batch([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for piece in words.steps(batches, "text"):
            for doc_id, text in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist()):
                if text:
                    held.update(document_words(doc_id, text))
            if len(held) > _HELD:
                yield counted()
                held.clear()
        yield counted()

    partial = docs.select("doc_id", "text").mapInArrow(run, "word string, n bigint")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)


def gram_ranks(vocab: DataFrame) -> dict[str, tuple[int, int]]:
    """Place of each bigram in the global order, and its frequency. At most the square of the alphabet's 90 letters."""
    grams = vocab.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring("word", i, 2))).alias("gram"))
    found = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).collect()
    return {r["gram"]: (k, r["n"]) for k, r in enumerate(sorted(found, key=lambda r: (r["n"], r["gram"])))}


def prefix_grams(word: str, ranks: dict[str, tuple[int, int]]) -> tuple[list[int], int]:
    """Positions of the gram prefix, and the place of its last gram in the global order."""
    at = [ranks[word[p : p + 2]][0] for p in range(len(word) - 1)]
    last = sorted(at)[2]
    return [p for p, rank in enumerate(at) if rank <= last], last


def pivots(word: str, prefix: list[int], ranks: dict[str, tuple[int, int]]) -> tuple[int, int]:
    """Two disjoint grams of the prefix with the least total frequency.

    ``one`` is the best choice of a single gram that ends before the gram at hand, ``two`` the best
    choice of a pair so far. Ties go to the earlier pair.
    """
    cost = [ranks[word[p : p + 2]][1] for p in prefix]
    one, two, behind = None, None, 0
    for p, c in zip(prefix, cost):
        while prefix[behind] + 2 <= p:
            if one is None or cost[behind] < one[0]:
                one = (cost[behind], prefix[behind])
            behind += 1
        if one is not None and (two is None or one[0] + c < two[0]):
            two = (one[0] + c, one[1], p)
    return two[1], two[2]


PIVOT = "key string, word string, n bigint, last int, head string, tail string, ahead boolean"
PREFIX = "key string, word string, n bigint, last int"


def near_pairs(vocab: DataFrame) -> DataFrame:
    """``word``, ``n``, ``near``, ``near_n``: each unordered pair of near words once."""
    ranks = gram_ranks(vocab)
    key = lambda side, length, piece: f"{side}{length}:{piece}"

    def pivot_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                prefix, last = prefix_grams(word, ranks)
                left, right = pivots(word, prefix, ranks)
                middle = min(max(len(word) // 2, left + 2), right)
                head, tail = word[:middle], word[middle:]
                for length in (len(word) - 1, len(word), len(word) + 1):
                    rows.append((key("<", length, word[: left + 2]), word, n, last, head, tail, True))
                    rows.append((key(">", length, word[right:]), word, n, last, head, tail, False))
            yield _batch(rows, PIVOT)

    def prefix_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                prefix, last = prefix_grams(word, ranks)
                for p in prefix:
                    rows.append((key("<", len(word), word[: p + 2]), word, n, last))
                    rows.append((key(">", len(word), word[p:]), word, n, last))
            yield _batch(rows, PREFIX)

    a, b = vocab.mapInArrow(pivot_rows, PIVOT).alias("a"), vocab.mapInArrow(prefix_rows, PREFIX).alias("b")
    c = F.col
    same_tail = F.endswith(c("b.word"), c("a.tail"))
    untouched = (c("a.ahead") & F.startswith(c("b.word"), c("a.head")) & ~same_tail) | (~c("a.ahead") & same_tail)
    first = (c("a.last") < c("b.last")) | ((c("a.last") == c("b.last")) & (c("a.word") < c("b.word")))
    close = F.levenshtein(c("a.word"), c("b.word"), 1) == 1
    return a.join(b, (c("a.key") == c("b.key")) & untouched & first & close).select(
        c("a.word").alias("word"), c("a.n").alias("n"), c("b.word").alias("near"), c("b.n").alias("near_n")
    )


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    names, types = zip(*(x.split() for x in schema.split(", ")))
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.record_batch([pa.array(c, kinds[t]) for c, t in zip(columns, types)], list(names))


def _roots(forms: DataFrame, most: int) -> DataFrame:
    """``word``, ``root``. A form occurs ``TIMES`` times as often as its word, so chains are short; each round doubles the reach."""
    longest = max(1, int(math.log(max(most, LEAST) / LEAST, TIMES)) + 1)
    roots = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(longest))):
        a, b = roots.alias("a"), roots.alias("b")
        roots = sizing.cut_lineage(
            a.join(b, F.col("a.root") == F.col("b.word"), "left").select("a.word", F.coalesce("b.root", "a.root").alias("root")), "spelling_roots"
        )
    return roots


def variants(docs: DataFrame) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``, one row per word."""
    words.small_batches(docs.sparkSession)
    vocab = sizing.cut_lineage(vocabulary(docs), "spelling_words")
    pairs = sizing.cut_lineage(near_pairs(vocab), "spelling_pairs")
    both = pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best"))
    found = vocab.join(best, "word", "left")
    enough = -F.col("best.less") >= TIMES * F.col("n")
    found = sizing.cut_lineage(found.select(
        "word", F.when(enough, F.col("best.near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, -F.col("best.less")).alias("form_n"),
    ), "spelling_forms")
    most = vocab.agg(F.max("n")).first()[0] or LEAST
    roots = _roots(found.where("form IS NOT NULL"), most)
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(spark, sf_dir: str) -> DataFrame:
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))
