"""The registered corpus queries against SQL, brute force, round trips and held-out labels."""

import re
import zlib

import numpy as np
import oracle
import pandas as pd
import pytest
import xxhash

import corpus_pipeline
from tabwarden.llm import catalog, huffman


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


@pytest.fixture(scope="module")
def docs(sf):
    return pd.read_parquet(f"{sf}/documents.parquet").sort_values("doc_id").reset_index(drop=True)


def rows_of(spark, sf, name):
    return catalog.QUERIES[name](spark, sf).toPandas()


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_equal_to_sql(spark, con, sf, name):
    assert oracle.compare(spark, con, catalog.QUERIES[name], catalog.ORACLES[name], sf) is None


def plain_ids(texts):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(huffman.default_tokenizer())
    return [x.ids + [huffman.END_ID] for x in model.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_token_blocks(spark, sf, docs):
    got = rows_of(spark, sf, "op3_token_blocks").sort_values("doc_id")
    ids = plain_ids(docs.text)
    sizes = np.array([len(x) for x in ids])
    assert got.n_tokens.tolist() == sizes.tolist()
    assert got.start.tolist() == (np.cumsum(sizes) - sizes).tolist()
    assert got.ids_crc32.tolist() == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids]


def simple_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def test_near_copies(spark, sf, docs):
    got = rows_of(spark, sf, "op6_simhash_trie").sort_values("doc_id")
    fps = [simple_fingerprint(t) for t in docs.text]
    assert got.fingerprint.tolist() == [f"{x:016x}" for x in fps]
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i, x in enumerate(fps):
            for j in range(i):
                if (x ^ fps[j]).bit_count() <= 4 and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    assert got.component_id.tolist() == docs.doc_id.iloc[label].tolist()


def test_language_of_held_out_documents(spark, sf, docs):
    got = rows_of(spark, sf, "op5_language_network").merge(docs, on="doc_id")
    assert got.held_out.tolist() == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]
    judged = got[got.held_out]
    assert len(got) == len(docs) and (judged.lang == judged.lang_pred).mean() > 0.95
    assert got.score.between(0, 1).all()


def test_quality_of_held_out_documents(spark, sf):
    got = rows_of(spark, sf, "op7_pairwise_quality").merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    judged = got[got.held_out]
    assert (judged.predicted == judged.quality).mean() > 0.9
    assert ((got.score >= 0.5) == (got.predicted == 1)).all()


def test_leaks(spark, sf, docs):
    items = pd.read_parquet(f"{sf}/benchmark.parquet").text
    want = {d for d, t in zip(docs.doc_id, docs.text) if any(x in (t or "") for x in items)}
    split = lambda t: re.findall(r"\w+", t.lower())
    windows = {tuple(w[i : i + 13]) for x in items for w in [split(x)] for i in range(max(1, len(w) - 12))}
    shared = {d for d, t in zip(docs.doc_id, docs.text) for w in [split(t or "")] if any(tuple(w[i : i + 13]) in windows for i in range(len(w) - 12))}
    got = set(rows_of(spark, sf, "op9_template_leaks").doc_id)
    assert want <= got <= want | shared


def test_pipeline(spark, sf, docs):
    """The stages take effect one after the other; the last one's rows are a round trip."""
    now, sizes = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        before, now = now.toPandas(), stage(spark, now, sf)
        found = now.toPandas()
        sizes.append(len(found))
        if name == "tokens":
            ids = plain_ids(before.text)
            assert sorted(found.ids_crc32) == sorted(zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids)
            assert found.n_tokens.sum() == sum(map(len, ids))
            break
        assert list(found.columns) == list(docs.columns)
        assert set(found.doc_id) <= set(before.doc_id)
        if name == "near_copies":
            kept = [simple_fingerprint(t) for t in found.text]
            assert all((x ^ y).bit_count() > 4 for i, x in enumerate(kept) for y in kept[:i])
        if name == "benchmark_leaks":
            items = pd.read_parquet(f"{sf}/benchmark.parquet").text
            assert not any(x in t for t in found.text for x in items) and len(found) > 0.8 * len(before)
        if name == "mixture":
            assert found.doc_id.value_counts().max() <= 3
        now = spark.createDataFrame(found)
    assert sizes[0] > 0.95 * len(docs) and sizes[1] < sizes[0]
