"""Benchmark decontamination by templates, which also catches re-parameterised questions.

Texts become tokens of letters or of digits; scripts written without spaces give a token per
character. A number, a unit or a name is replaced by a placeholder
of its type; other tokens are lower-cased. Names are words with a capital first letter, and since
case may be lost in a copy, every window has two templates: with names as placeholders and without.
A window is ``WINDOW`` tokens; a shorter item is one window of its own length. Templates need at least
``SHORTEST`` tokens of which half are words. All other windows are literal: no placeholders, tokens as
they are but for case. (A window that may be a template is one without names too, and an exact copy
agrees with that; so every exact copy is found, and no window counts a third time.) Under ``SHORTEST``
tokens the signs between the tokens must agree as well.

Windows of a document that a Bloom filter of the benchmark's template hashes lets through are
joined with the benchmark's windows by hash. Then the template itself must agree and the slots must
be consistent: equal values fill the same slots on both sides, and different ones different slots.
A place in a document counts as one hit, however many of its forms match.

The filter has a fixed size whatever the benchmark's; a large benchmark lets more windows through
to the join and loses none. The document side is not shuffled but for those windows. Benchmark
windows with one template and one slot pattern are one class and one row, so a window matches one row
a form at most. Documents name the smallest item of each class they meet; the items of a class are
listed once, at the smallest document that meets it, so that no item is left out and none multiplied.

Defined cases: null and empty texts hold no window, nor do items without letters and digits; items
under ``SHORTEST`` tokens match as a whole wherever they stand, by chance as well (an item of one word
meets every document with that word); ``hits`` counts the places in the different texts of an id, so
equal rows count once; null ids are one id, the last in order; null items are left out of lists;
further columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwarden.functions import sizing
from tabwarden.llm import words

WINDOW, SHORTEST = 13, 8
#: Units of measure that become a placeholder.
UNITS = frozenset(
    "mm cm dm m km in inch inches ft foot feet yd yard yards mi mile miles mg g gram grams kg kilogram kilograms t ton tons oz ounce ounces "
    "lb lbs pound pounds ml l liter liters litre litres gallon gallons ms s sec second seconds min minute minutes h hr hour hours day days "
    "week weeks month months year years usd eur gbp dollar dollars euro euros cent cents percent kmh mph kb mb gb tb w kw v hz khz mhz ghz".split()
)
#: Bits of the filter in front of the join (1 MB).
FILTER_BITS = 1 << 23
#: Text looked at in one step; each distinct word of a step is cut into tokens once.
STEP_BYTES = 3 << 20
#: Letters of scripts that put no space between words.
_UNSPACED = r"[[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tibetan}]&&[\p{L}\p{Nl}]]"
_SPACED = rf"[\p{{L}}--{_UNSPACED}]"
_WORD = rf"{_SPACED}(?:{_SPACED}|\p{{M}})*"
_TOKEN = regex.compile(rf"(?V1){_WORD}(?:['’-]{_WORD})*|{_UNSPACED}\p{{M}}*|\d+(?:[.,]\d+)*")
_NAMES, _PLAIN, _LITERAL = 0, 1, 2
_SLOTS = ("<number>", "<unit>", "<name>")


def _kind(token: str) -> int:
    """0 number, 1 unit, 2 name, 3 word."""
    if token[0].isdigit():
        return 0
    if token.lower() in UNITS:
        return 1
    return 2 if token[0].isupper() else 3


class _Tokens:
    """Token arrays of a step of texts."""

    def __init__(self, texts):
        flat, counts = words.split_words(texts)
        self.at, distinct = words.coded(flat)
        self.words, at = distinct.to_pylist(), self.at
        found = [_TOKEN.findall(w) for w in self.words]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        tokens = [t for x in found for t in x]
        kinds = np.fromiter(map(_kind, tokens), np.int64, len(tokens))
        lower = [t.lower() for t in tokens]
        values = np.fromiter((xxhash.xxh64_intdigest(t) for t in lower), np.uint64, len(lower))
        marks = np.array([xxhash.xxh64_intdigest(s) for s in _SLOTS], np.uint64)
        named = np.where(kinds == 3, values, marks[np.minimum(kinds, 2)])
        plain = np.where(kinds >= 2, values, marks[np.minimum(kinds, 2)])
        place = words.ragged((np.cumsum(sizes) - sizes)[at], sizes[at])
        upto = np.concatenate([[0], np.cumsum(sizes[at])])[np.concatenate([[0], np.cumsum(counts)])]
        self.counts = np.diff(upto)
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)
        self.place, self.lower, self.kinds = place, lower, kinds
        self.word_ends = np.cumsum(sizes[at])
        self.spans = [words.Spans(named[place]), words.Spans(plain[place]), words.Spans(values[place])]
        slot = kinds[place]
        self.slots = [np.concatenate([[0], np.cumsum(slot < 3)]), np.concatenate([[0], np.cumsum(slot < 2)])]

    def windows(self, width: int, form: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the windows that have enough words; literal ones: of those that have not."""
        starts = words.window_starts(self.counts, width)
        if width >= SHORTEST:
            slots = self.slots[min(form, _PLAIN)]
            filled = slots[starts + width] - slots[starts]
            starts = starts[(2 * filled <= width) != (form == _LITERAL)]
        return starts, self.spans[form].of(starts, width)

    def describe(self, start: int, width: int, form: int) -> tuple[str, str]:
        """The template, and for each slot the first slot with the same value."""
        text, values = [], []
        for p in self.place[start : start + width]:
            kind = int(self.kinds[p])
            if form != _LITERAL and (kind < 2 or (kind == 2 and form == _NAMES)):
                text.append(_SLOTS[kind])
                values.append(self.lower[p])
            else:
                text.append(self.lower[p])
        return " ".join(text), ",".join(str(values.index(v)) for v in values) if width >= SHORTEST else self.raw(start, width)

    def raw(self, start: int, width: int) -> str:
        """Text from the first to the last token, without white space."""
        first, last = (int(np.searchsorted(self.word_ends, p, side="right")) for p in (start, start + width - 1))
        spans = [[m.span() for m in _TOKEN.finditer(self.words[self.at[w]])] for w in (first, last)]
        begin = spans[0][start - int(self.word_ends[first]) + len(spans[0])][0]
        end = spans[1][start + width - 1 - int(self.word_ends[last]) + len(spans[1])][1]
        pieces = [self.words[self.at[w]] for w in range(first, last + 1)]
        pieces[-1] = pieces[-1][:end]
        pieces[0] = pieces[0][begin:]
        return "".join(pieces).lower()


def _forms(width: int) -> tuple[int, ...]:
    return (_NAMES, _PLAIN, _LITERAL) if width >= SHORTEST else (_LITERAL,)


def _rows(tokens: _Tokens, chosen: list[tuple[int, int, np.ndarray, np.ndarray]], **keys: list) -> pa.RecordBatch:
    """The chosen windows, with the cells of their rows in ``keys``."""
    names = [x.split()[0] for x in _SCHEMA.split(", ")]
    out: list[list] = [[] for _ in [*keys, *names]]
    firsts = np.cumsum(tokens.counts) - tokens.counts
    for width, form, starts, found in chosen:
        for s, h in zip(starts.tolist(), found.view(np.int64).tolist()):
            row = tokens.doc[s]
            cells = (*(k[row] for k in keys.values()), h, form, width, s - int(firsts[row]), *tokens.describe(s, width, form))
            for into, value in zip(out, cells):
                into.append(value)
    kinds = [*[pa.int64()] * len(keys), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.string()]
    return pa.record_batch([pa.array(v, t) for v, t in zip(out, kinds)], [*keys, *names])


_SCHEMA = "h bigint, form int, width int, start bigint, template string, pattern string"
_CLASS = ["h", "form", "width", "template", "pattern"]


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """One row per class of windows: ``class``, its template and pattern, the smallest ``item_id``, all its ``items``.

    A class lists as many items as the benchmark has at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in words.steps(batches, "text"):
            for row in range(piece.num_rows):
                tokens = _Tokens(piece.column("text").slice(row, 1))
                width = min(WINDOW, int(tokens.counts[0]))
                if width:
                    yield _rows(tokens, [(width, f, *tokens.windows(width, f)) for f in _forms(width)], item_id=[piece.column("item_id")[row].as_py()])

    found = benchmark.select("item_id", "text").mapInArrow(run, f"item_id bigint, {_SCHEMA}")
    classes = found.groupBy(*_CLASS).agg(F.min("item_id").alias("item_id"), F.sort_array(F.collect_set("item_id")).alias("items"))
    return sizing.cut_lineage(classes.withColumn("class", F.monotonically_increasing_id()), "benchmark_windows")


def _bits(index: DataFrame) -> np.ndarray:
    """The filter: at most ``FILTER_BITS`` / 64 words reach the driver, whatever the benchmark's size."""
    spot = F.pmod("h", F.lit(FILTER_BITS))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), spot.bitwiseAND(63).cast("int"))
    rows = index.groupBy(F.shiftright(spot, 6).alias("w")).agg(F.bit_or(mask).alias("m")).collect()
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    for w, m in rows:
        bits[w] = m
    return np.unpackbits(bits.view(np.uint8), bitorder="little").view(bool)


def hits(docs: DataFrame, index: DataFrame) -> DataFrame:
    """``doc_id``, ``t`` (hash of the text), ``width``, ``start`` (token), ``class`` of each window and form that the index holds.

    ``index``: from ``benchmark_windows``.
    """
    words.small_batches(docs.sparkSession)
    widths = sorted(r["width"] for r in index.select("width").distinct().collect())  # WINDOW at most
    bits = _bits(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in words.steps(batches, "text", STEP_BYTES):
            tokens, chosen = _Tokens(piece.column("text")), []
            for width in widths:
                for form in _forms(width):
                    starts, h = tokens.windows(width, form)
                    maybe = bits[(h.view(np.int64) % FILTER_BITS)]
                    chosen.append((width, form, starts[maybe], h[maybe]))
            yield _rows(tokens, chosen, doc_id=piece.column("doc_id").to_pylist(), t=piece.column("t").to_pylist())
        words.trim()

    if not widths:
        return docs.sparkSession.createDataFrame([], "doc_id bigint, t bigint, width int, start bigint, class bigint")
    found = docs.select("doc_id", "text", F.xxhash64("text").alias("t")).mapInArrow(run, f"doc_id bigint, t bigint, {_SCHEMA}")
    return found.join(index.select(*_CLASS, "class"), _CLASS).select("doc_id", "t", "width", "start", "class")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id``, ``hits`` (matching places), ``item_ids`` (smallest item of each class met, sorted), ``members``.

    ``members`` has the items of each class of several items that no document with a smaller id meets.
    """
    index = benchmark_windows(benchmark)
    found = sizing.cut_lineage(hits(docs, index), "leak_windows")
    places = found.select("doc_id", "t", "width", "start").distinct().groupBy("doc_id").agg(F.count(F.lit(1)).alias("hits"))
    met = sizing.cut_lineage(found.select("doc_id", "class").distinct().join(index.select("class", "item_id"), "class"), "leak_classes")
    items = met.select("doc_id", "item_id").distinct().groupBy("doc_id").agg(F.sort_array(F.collect_list("item_id")).alias("item_ids"))
    first = met.groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id")).alias("first"))
    listed = index.where(F.size("items") > 1).select("class", "items").join(first, "class").select(F.col("first.doc_id").alias("doc_id"), "items").distinct()
    members = listed.groupBy("doc_id").agg(F.sort_array(F.collect_list("items")).alias("members"))
    a, b, c = places.alias("a"), items.alias("b"), members.alias("c")
    same = lambda x: F.col("a.doc_id").eqNullSafe(F.col(f"{x}.doc_id"))
    none = F.array().cast("array<array<bigint>>")
    return a.join(b, same("b")).join(c, same("c"), "left").select("a.doc_id", "hits", "item_ids", F.coalesce("members", none).alias("members"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows whose text has no hit, columns as they were; rows of one id, or of none, are judged one by one."""
    found = hits(docs, benchmark_windows(benchmark)).select(F.col("doc_id").alias("bad_id"), F.col("t").alias("bad_text")).distinct()
    bad = sizing.cut_lineage(found, "leaks")
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad_id"]) & (F.xxhash64(docs["text"]) == bad["bad_text"]), "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return contaminated(docs, benchmark)
