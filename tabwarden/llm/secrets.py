"""Secrets in documents: spans that look like one, and strings too novel for their surroundings.

Base spans are found by pattern. The method adds strings by dictionary-primed zstandard novelty. A
candidate is a run of key characters in a sensitive context. Its novelty is the number of bytes that
it adds to its compressed surroundings, for each of its characters; the compressor is primed with a
dictionary of identifiers. What occurs nearby, or is made of known words, costs few bytes; what costs
``NOVELTY`` bytes a character or more is reported. A long candidate is measured in equal pieces.

The dictionary holds words of code and the corpus words found in most documents, ``DICTIONARY_WORDS``
at most; all words of all documents are counted for it. It goes with the task, as at most that many
words. Documents are judged alone, so nothing else is shuffled and no key can be hot.

Defined cases: a null text counts as empty and has no spans; repeated rows give repeated results;
texts of any length are read whole; equal starts are ordered by kind; words tied for the last place
of the dictionary enter in code-point order; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwarden.llm import words

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 8, 16, 32
#: Words that make a context sensitive, and how many code points behind one a candidate may begin.
SENSITIVE = "pass(?:word|wd|phrase|code)|pwd|secret|token|credential|auth|bearer|private|signature|session|cookie|jwt|login|key"
REACH = 64
#: A candidate: this many key characters at least, with a digit among letters or letters of both cases.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=~-]{16,}")
_MIXED = re.compile(r"(?=.*[A-Za-z])(?=.*[0-9])|(?=.*[a-z])(?=.*[A-Z])")
#: Code points of surroundings on either side, longest piece, compressed bytes a character that count as novel.
AROUND, PIECE, NOVELTY = 128, 32, 0.8
LEVEL = 19
DICTIONARY_WORDS, WORD_DOCS = 4096, 3
_SLICES = 32
#: Words of program text and settings.
CODE_WORDS = (
    "abstract access account address array async authorization await backend base64 basic bearer boolean bucket build byte cache callback "
    "certificate char class client cluster column config connect connection console const content context continue cookie copy count create "
    "credential current data database debug decode default define delete deploy digest directory disable docker domain double download "
    "email enable encode encrypt endpoint engine environment error event example except exception execute expire export extends false file "
    "filter final float folder format from function generate global group handler hash header host http https identifier image implements "
    "import include index insert instance int integer interface internal json key kubernetes lambda length level library license list load "
    "local localhost location login long manager master memory message metadata method middleware model module name namespace network node "
    "none null number object option output package page parameter parse passphrase passwd password path payload permission plugin pointer "
    "policy port prefix private process production profile project property protected protocol provider proxy public query queue random "
    "read redirect region register release remote replace repository request require resource response result return role route safe schema "
    "scope secret select self send server service session setting signature signing size socket source staging start state static status "
    "storage stream string struct suffix system table target template test thread throw time timeout timestamp token trace transaction true "
    "type undefined update upload uri url user username utils value variable vector version view void volume webhook worker workspace write xml yaml"
)
_MAYBE = "(?i:" + SENSITIVE + "|api_?key)|AKIA[A-Z0-9]|[0-9a-f]{32}"


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text) if m.end() - m.start() >= MIN_HEX]
    return found


class Novelty:
    """Bytes that a string adds to its compressed surroundings, given a dictionary of identifiers."""

    def __init__(self, identifiers: list[str]):
        """``identifiers``: rarest first, as the compressor reaches the end of its dictionary cheapest."""
        known = " ".join([*identifiers, CODE_WORDS]).encode()
        primed = zstandard.ZstdCompressionDict(known, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        primed.precompute_compress(level=LEVEL)
        self.compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=primed).compress
        self.sensitive = re.compile(SENSITIVE, re.IGNORECASE | re.ASCII)

    def marginal(self, before: str, piece: str, after: str) -> int:
        return len(self.compress((before + piece + after).encode())) - len(self.compress((before + after).encode()))

    def of(self, text: str, begin: int, end: int) -> float:
        """Added bytes a character, over equal pieces of the candidate."""
        before, after = text[max(0, begin - AROUND) : begin], text[end : end + AROUND]
        n = -(-(end - begin) // PIECE)
        cuts = [begin + (end - begin) * k // n for k in range(n + 1)]
        return sum(self.marginal(before, text[a:b], after) for a, b in zip(cuts, cuts[1:])) / (end - begin)

    def spans(self, text: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
        """Novel candidates in a sensitive context, apart from the spans already taken."""
        alarms = [m.end() for m in self.sensitive.finditer(text)]
        taken = sorted(taken)
        found, at, near, reach = [], 0, 0, 0
        for m in CANDIDATE.finditer(text) if alarms else ():
            begin, end = m.span()
            while near < len(alarms) and alarms[near] <= begin:
                near += 1
            while at < len(taken) and taken[at][0] < end:
                reach = max(reach, taken[at][1])
                at += 1
            sensitive = near and begin - alarms[near - 1] <= REACH
            if sensitive and reach <= begin and _MIXED.match(m[0]) and self.of(text, begin, end) >= NOVELTY:
                found.append((begin, end, "novel"))
        return found


def identifiers(docs: DataFrame, most: int = DICTIONARY_WORDS) -> list[str]:
    """The words of most documents, rarest first; never a word of fewer than ``WORD_DOCS`` documents."""
    each = docs.where("text IS NOT NULL").select(F.explode(F.array_distinct(F.split("text", "[^A-Za-z_]+", -1))).alias("word"))
    counted = each.where(F.length("word") >= 4).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= WORD_DOCS)
    # The first of each of a few slices, then the first of these: what is gathered does not grow with the tasks.
    rank = F.row_number().over(Window.partitionBy(F.pmod(F.xxhash64("word"), F.lit(_SLICES))).orderBy(F.desc("n"), "word"))
    first = counted.withColumn("rank", rank).where(F.col("rank") <= most)
    return [r["word"] for r in reversed(first.orderBy(F.desc("n"), "word").limit(most).collect())]


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]))))


OUT = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_novel bigint, base_sha256 string, spans string"


def scan(docs: DataFrame, known: list[str] | None = None) -> DataFrame:
    """Spans of every document. ``known``: the identifiers of the dictionary, by default those of the documents."""
    words.small_batches(docs.sparkSession)
    known = identifiers(docs) if known is None else known

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(known)
        for piece in words.steps(batches, "text"):
            texts = pc.fill_null(piece.column("text"), "")
            maybe = pc.match_substring_regex(texts, _MAYBE).to_pylist()
            rows = []
            for doc_id, text, look in zip(piece.column("doc_id").to_pylist(), texts, maybe):
                base, novel = [], []
                if look:
                    text = text.as_py()
                    base = base_spans(text)
                    novel = novelty.spans(text, base)
                kinds = [x[2] for x in base]
                digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                rows.append((doc_id, *(kinds.count(k) for k in KINDS[:3]), len(novel), digest, _joined(base + novel)))
            columns = list(zip(*rows))
            types = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], [x.split()[0] for x in OUT.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(run, OUT)


def query(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
