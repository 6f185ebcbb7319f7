"""Token ids of documents in a compact block file, and back.

Ids come from a public tokenizer. They are coded with one canonical Huffman code, limited in
length, built from the counts of all ids of the corpus. The file format is a Parquet table of
blocks. A block holds whole documents and is decoded on its own: ``payload`` has the code bits,
``checkpoints`` the bit offset of every ``STRIDE``-th id, so decoding starts at any of them and a
block's stretches are decoded side by side by table. ``codebook`` (id, length) rebuilds the code.

Where a tokenizer drops white space and never joins across it, texts are split at ASCII white space
first and each distinct piece of a word is encoded once, with a bounded memory of pieces per Python worker; the
ids are those of whole texts. Any other tokenizer gets the whole texts.

Documents are written in ascending ``doc_id`` order (nulls first; equal ids by checksum of their
ids, so one hot id is spread over partitions as well). Sums per partition, one row each, pass
through the driver; token ids never do. The code book has at most one row per vocabulary entry.

Defined cases: a null or empty text is one end id; repeated rows are separate documents; an empty
table writes no block and reads back empty; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import json
import re
import string
import struct
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwarden.functions import sizing
from tabwarden.llm import words

END_ID = 1
#: Ids in a block at least (the last document is never cut), ids between checkpoints, longest code.
BLOCK_IDS, STRIDE, LIMIT = 1 << 16, 256, 18
_READ_BLOCKS = 16
#: Text tokenized in one step, and words whose ids are laid out at once.
TOKENIZE_BYTES, EXPAND_WORDS = 8 << 20, 1 << 18

BLOCK_SCHEMA = "part int, seq int, local_start bigint, n_ids bigint, doc_ids array<bigint>, n_tokens array<bigint>, checkpoints array<bigint>, payload binary"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordCoder:
    """Ids of pieces of words, as little-endian 32-bit integers, remembered in two generations of ``KEEP`` pieces.

    A word is a piece, or a piece and the ASCII marks behind its last letter or digit, which the
    tokenizer always cuts off. A new piece goes to the library's model; its normalizer and
    pre-tokenizer are spared for ASCII and Latin letters. What may hold an added token stays whole.
    """

    KEEP = 120_000
    _LATIN = "".join(map(chr, [*range(0xDF, 0xF7), *range(0xF8, 0x100)]))

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model, self.young, self.old = self.whole.model, {}, {}
        spec = json.loads(Path(path).read_text())
        kinds = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        split = [c for c in cuts if c["type"] == "Split" and c.get("behavior") == "Removed" and c.get("invert")]
        #: White space never survives such a split: words can be encoded one by one.
        self.by_word = bool(split) and "Lowercase" in kinds and split[0]["pattern"].get("Regex", "").endswith(r"[^\s\p{L}\p{N}]+")
        self.find = regex.compile(split[0]["pattern"]["Regex"]).findall if self.by_word else None
        self.added = tuple(x["content"] for x in spec.get("added_tokens", []))
        self.latin = re.compile(f"[a-z{self._LATIN}]+").fullmatch
        self.spelled = {ord(c): self.whole.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in self._LATIN} if self.by_word else {}

    def _model(self, piece: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(piece)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _new(self, piece: str) -> bytes:
        """Ids of a piece whose ASCII letters are lower-cased if it is ASCII throughout."""
        if any(x in piece for x in self.added):
            ids = self.whole.encode(piece, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        low = piece.lower()
        if piece.isascii() and piece.isprintable():
            cut = self.find(low)
            return self._model(low) if len(cut) == 1 else b"".join(map(self.ids, cut))
        if self.latin(low):
            return self._model(low.translate(self.spelled))
        return b"".join(self._model(x) for x, _ in self.whole.pre_tokenizer.pre_tokenize_str(self.whole.normalizer.normalize_str(piece)))

    def ids(self, piece: str) -> bytes:
        found = self.young.get(piece)
        if found is None:
            found = self.old.get(piece)
            self.young[piece] = found = self._new(piece) if found is None else found
        return found

    def lower(self, flat: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """ASCII words in lower case, but for those that hold, or would become, an added token; and which hold none."""
        lower = pc.ascii_lower(flat)
        held = pc.match_substring(lower, self.added[0].lower()) if self.added else pc.is_null(flat)
        for x in self.added[1:]:
            held = pc.or_(held, pc.match_substring(lower, x.lower()))
        return pc.if_else(pc.and_not(pc.string_is_ascii(flat), held), lower, flat), pc.invert(held).to_numpy(zero_copy_only=False)

    @staticmethod
    def cut(flat: pa.Array, may: np.ndarray) -> pa.Array:
        """Two pieces of each word that may be cut: up to its last ASCII or Latin letter or digit, and the ASCII marks behind it."""
        offsets = np.frombuffer(flat.buffers()[1], np.int32)[flat.offset : flat.offset + len(flat) + 1]
        raw = np.frombuffer(flat.buffers()[2] or b"", np.uint8)
        ends = offsets[:-1] + pc.binary_length(pc.utf8_rtrim(flat, string.punctuation)).to_numpy(zero_copy_only=False)
        last, before = raw[np.maximum(ends, 1) - 1], raw[np.maximum(ends, 2) - 2]
        letter = _ALNUM[last] | ((before == 0xC3) & (last >= 0x80) & (last != 0x97) & (last != 0xB7) & (ends - offsets[:-1] > 1))
        ends = np.where(may & letter & (ends > offsets[:-1]), ends, offsets[1:])
        both = np.concatenate([np.stack([offsets[:-1], ends], axis=1).reshape(-1), offsets[-1:]]).astype(np.int32)
        return pa.StringArray.from_buffers(2 * len(flat), pa.py_buffer(both), flat.buffers()[2])

    def many(self, pieces: list[str]) -> list[bytes]:
        if len(self.young) > self.KEEP:
            self.old, self.young = self.young, {}
        known = self.young
        return [known.get(x) or self.ids(x) for x in pieces]


_ALNUM = np.array([chr(c).isalnum() and c < 128 for c in range(256)])
_CODERS: dict[str, WordCoder] = {}


def _coder(path: str) -> WordCoder:
    """One per Python worker, so that words stay known from task to task."""
    if path not in _CODERS:
        _CODERS[path] = WordCoder(path)
    return _CODERS[path]


def _document_ids(texts, coder: WordCoder) -> list[bytes]:
    end = END_ID.to_bytes(4, "little")
    if not coder.by_word:
        whole = coder.whole.encode_batch([t or "" for t in texts.to_pylist()], add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() + end for x in whole]
    flat, counts = words.split_words(texts)
    if not len(flat):
        return [end] * len(counts)
    at, distinct = words.coded(flat)
    lower, may = coder.lower(distinct)
    piece_at, pieces = words.coded(coder.cut(lower, may))
    known = coder.many(pieces.to_pylist())
    sizes = np.fromiter((len(x) // 4 for x in known), np.int64, len(known))
    begins, sizes = (np.cumsum(sizes) - sizes)[piece_at], sizes[piece_at]
    table = np.frombuffer(b"".join(known), "<u4")[words.ragged(begins, sizes)]  # the ids of each distinct word
    sizes = sizes.reshape(-1, 2).sum(axis=1)
    begins, ends = np.cumsum(sizes) - sizes, np.concatenate([[0], np.cumsum(counts)])
    out, first = [], 0
    while first < len(counts):  # the ids of a few documents at a time
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + EXPAND_WORDS, side="right")) - 1)
        word = at[ends[first] : ends[last]]
        per_word = sizes[word]
        ids = table[words.ragged(begins[word], per_word)]
        upto = np.concatenate([[0], np.cumsum(per_word)])[ends[first : last + 1] - ends[first]]
        out += [ids[a:b].tobytes() + end for a, b in zip(upto[:-1], upto[1:])]
        first = last
    return out


def id_type(tokenizer: str) -> str:
    """The narrowest integers that hold every id on the way to the blocks."""
    from tokenizers import Tokenizer

    return "<u2" if max(Tokenizer.from_file(tokenizer).get_vocab().values(), default=0) < 1 << 16 else "<u4"


def tokenize(docs: DataFrame, tokenizer: str, kind: str) -> DataFrame:
    """``doc_id``, ``crc`` of the ids as little-endian 32-bit integers, ``ids`` as bytes of ``kind``, the end id included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in words.gathered(batches, "text", TOKENIZE_BYTES):
            out = _document_ids(piece.column("text"), _coder(tokenizer))
            yield pa.record_batch([words.one_array(piece.column("doc_id")), pa.array([zlib.crc32(x) for x in out], pa.int64()), pa.array([np.frombuffer(x, "<u4").astype(kind).tobytes() for x in out], pa.binary())], ["doc_id", "crc", "ids"])
        words.trim()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, crc bigint, ids binary")


def id_counts(tokens: DataFrame, kind: str) -> DataFrame:
    """``id``, ``n`` over all documents, summed inside tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for piece in words.steps(batches, "ids"):
            seen = np.bincount(np.frombuffer(b"".join(piece.column("ids").to_pylist()), kind))
            if len(seen) > len(total):
                total = np.pad(total, (0, len(seen) - len(total)))
            total[: len(seen)] += seen
        ids = np.flatnonzero(total)
        yield pa.record_batch([pa.array(ids), pa.array(total[ids])], ["id", "n"])

    return tokens.select("ids").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Best code lengths of at most ``limit`` bits, by package-merge; 0 for symbols that never occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.int64)
    n = len(used)
    if n <= 1:
        lengths[used] = 1
        return lengths
    if n > 1 << limit:
        raise ValueError(f"{n} symbols do not fit codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    merged, is_leaf = leaves, [np.ones(n, bool)]
    for _ in range(limit - 1):
        packages = merged[0 : len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, packages])
        rank = np.argsort(both, kind="stable")
        merged = both[rank]
        is_leaf.append(rank < n)
    take = 2 * n - 2
    for flags in reversed(is_leaf):
        chosen = int(flags[:take].sum())
        lengths[order[:chosen]] += 1
        take = 2 * (take - chosen)
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes by length, then by id."""
    codes = np.zeros(len(lengths), np.uint64)
    code, before = 0, 0
    for symbol in np.lexsort((np.arange(len(lengths)), lengths)):
        size = int(lengths[symbol])
        if size:
            code <<= size - before
            codes[symbol], before = code, size
            code += 1
    return codes


def pack(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Code bits of the ids, first bit first, and the bit offset of every ``STRIDE``-th id."""
    sizes = lengths[ids]
    ends = np.cumsum(sizes)
    begins = ends - sizes
    word, shift = begins >> 5, (64 - (begins & 31) - sizes).astype(np.uint64)
    bits = codes[ids] << shift
    out = np.zeros(int(ends[-1] >> 5) + 2, np.uint64)
    first = np.flatnonzero(np.diff(word, prepend=-1))
    at = word[first]
    out[at] |= np.bitwise_or.reduceat(bits >> np.uint64(32), first)
    out[at + 1] |= np.bitwise_or.reduceat(bits & np.uint64(0xFFFFFFFF), first)
    return out.astype(">u4").tobytes()[: int(ends[-1] + 7) // 8], begins[::STRIDE]


def decode_table(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """For each pattern of ``limit`` bits the id it starts with and the bits that id takes."""
    codes = canonical(lengths)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    ids, sizes = np.zeros(1 << limit, np.uint32), np.ones(1 << limit, np.int64)
    span = 1 << (limit - lengths[order])
    filled = int(span.sum())
    assert not len(order) or int(codes[order[0]]) == 0
    ids[:filled], sizes[:filled] = np.repeat(order, span), np.repeat(lengths[order], span)
    return ids, sizes


def unpack(payloads: list[bytes], checkpoints: list[np.ndarray], n_ids: list[int], table, limit: int) -> list[np.ndarray]:
    """Ids of several blocks; all stretches between checkpoints go forward together."""
    ids, sizes = table
    base = np.cumsum([0] + [len(p) for p in payloads])
    raw = np.frombuffer(b"".join(payloads) + bytes(8), np.uint8).astype(np.uint32)
    quad = (raw[:-3] << np.uint32(24)) | (raw[1:-2] << np.uint32(16)) | (raw[2:-1] << np.uint32(8)) | raw[3:]
    at = np.concatenate([np.asarray(c) + 8 * b for c, b in zip(checkpoints, base)])
    last = 8 * int(base[-1])
    out = np.empty((len(at), STRIDE), np.uint32)
    for step in range(STRIDE):
        window = (quad[at >> 3] << (at & 7).astype(np.uint32)) >> np.uint32(32 - limit)
        out[:, step] = ids[window]
        at = np.minimum(at + sizes[window], last)
    result, row = [], 0
    for c, n in zip(checkpoints, n_ids):
        result.append(out[row : row + len(c)].reshape(-1)[:n])
        row += len(c)
    return result


def write(docs: DataFrame, tokenizer: str, path: str, limit: int = LIMIT) -> None:
    """Write ``path/blocks`` and ``path/codebook``."""
    spark = docs.sparkSession
    words.small_batches(spark)
    kind = id_type(tokenizer)
    tokens = sizing.cut_lineage(tokenize(docs, tokenizer, kind), "tokens")
    counted = id_counts(tokens, kind).toPandas()  # one row per vocabulary entry at most
    counts = np.zeros(int(counted["id"].max()) + 1 if len(counted) else 1, np.int64)
    counts[counted["id"].to_numpy(np.int64)] = counted["n"].to_numpy(np.int64)
    lengths = code_lengths(counts, limit)
    codes = canonical(lengths)
    book = spark.createDataFrame([(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)], "id bigint, length int")
    book.coalesce(1).write.parquet(f"{path}/codebook")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq, begin = TaskContext.get().partitionId(), 0, 0
        doc_ids: list = []
        held: list[np.ndarray] = []
        size = 0

        def block():
            payload, marks = pack(np.concatenate(held), lengths, codes)
            row = {"part": part, "seq": seq, "local_start": begin, "n_ids": size, "doc_ids": doc_ids, "n_tokens": [len(x) for x in held], "checkpoints": marks, "payload": payload}
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.record_batch([pa.array([v], t) for v, t in zip(row.values(), kinds)], list(row))

        for batch in batches:
            for doc, piece in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                doc_ids.append(doc)
                held.append(np.frombuffer(piece, kind))
                size += len(held[-1])
                if size >= BLOCK_IDS:
                    yield block()
                    seq, begin, size, doc_ids, held = seq + 1, begin + size, 0, [], []
        if held:
            yield block()

    ordered = tokens.repartitionByRange("doc_id", "crc").sortWithinPartitions("doc_id", "crc")
    ordered.select("doc_id", "ids").mapInArrow(run, BLOCK_SCHEMA).write.parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids`` of every written document."""
    words.small_batches(spark)
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    book = spark.read.parquet(f"{path}/codebook").collect()
    lengths = np.zeros(max((r["id"] for r in book), default=0) + 1, np.int64)
    for r in book:
        lengths[r["id"]] = r["length"]
    before, total = {}, 0
    for part, n in sorted((r["part"], r["n"]) for r in blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()):
        before[part], total = total, total + n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decode_table(lengths, limit)
        for batch in batches:
            for k in range(0, batch.num_rows, _READ_BLOCKS):
                rows = batch.slice(k, _READ_BLOCKS).to_pylist()
                found = unpack([r["payload"] for r in rows], [np.array(r["checkpoints"], np.int64) for r in rows], [r["n_ids"] for r in rows], table, limit)
                for r, ids in zip(rows, found):
                    n = np.array(r["n_tokens"], np.int64)
                    ends = np.cumsum(n)
                    cells = [ids[e - c : e].astype("<u4").tobytes() for e, c in zip(ends, n)]
                    starts = before[r["part"]] + r["local_start"] + ends - n
                    yield pa.record_batch([pa.array(r["doc_ids"], pa.int64()), pa.array(starts), pa.array(n), pa.array(cells, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    return blocks.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def digest(decoded: DataFrame) -> DataFrame:
    return decoded.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write the documents to the shared folder, read the file back, return one row per document."""
    path = sizing.run_dir(docs.sparkSession, "token_blocks")
    write(docs, tokenizer or default_tokenizer(), path)
    return digest(read(docs.sparkSession, path))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"))
