"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tabwarden.llm import chat_trees, graph, huffman, language, mixing, pairwise_quality, quality_rules, simhash_trie, superkmer, templates, url_cascade, words

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, size string, kept string, carry int, fp string"
LONG = " ".join(f"word{i % 997}" for i in range(60_000))
TEXTS = [None, "", " \t\n", "one", LONG, LONG, "A b c d e f g.", "A b c d e f g."]


def table(spark, texts=TEXTS, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", None if k % 3 == 0 else "s", 1, 0.5, "x", "y", 7, "z") for k, (i, t) in enumerate(zip(ids, texts))], SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_quality_rules(spark):
    rows = by_id(quality_rules.clean_lines(table(spark)))
    assert [rows[i]["n_words"] for i in range(5)] == [0, 0, 0, 1, 60_000]
    assert rows[4]["n_repeat_words"] == 60_000 and rows[4]["base_failed"] and not rows[0]["kept"]
    assert quality_rules.clean_lines(table(spark, [])).count() == 0


def test_quality_rules_remove_lines(spark):
    good = "\n".join(f"Sentence number {i} tells of thing {i * 7}." for i in range(12))
    row = by_id(quality_rules.clean_lines(table(spark, [good + "\nHome | About | Help\nAccept cookie settings.", "x!! y!! z!! w!!\n" * 20])))
    assert row[0]["kept"] and "Home" not in row[0]["clean_text"] and "cookie" not in row[0]["clean_text"] and row[0]["n_kept_lines"] == 12
    assert not row[1]["kept"] and row[1]["n_dup_lines"] == 19


def test_cascade_is_exact(spark):
    universe = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 50 == 0).alias("listed")).cache()
    levels = url_cascade.build(universe)
    assert universe.where(url_cascade.member(levels, F.col("key")) != F.col("listed")).count() == 0
    assert url_cascade.build(universe.where("NOT listed")) == []


def test_urls(spark):
    urls = [None, "", "no scheme", "http://A.COM", "http://a.com/x", "https://example.com/en/a?b", "http://www.EXAMPLE.com/en/", "x://b.net/es/#", "x://casino.org/", "x://org"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id bigint, url string, host string")
    rows = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_cascade.judge(pages).collect()}
    assert rows[0] == ("", "", None, "allow") == rows[2] and rows[3] == ("a.com", "", None, "allow")
    assert rows[4][2:] == ("com/", "allow") and rows[5][2:] == ("example.com/en/", "block") and rows[6][2:] == ("www.example.com/en/", "allow")
    assert rows[7] == ("b.net", "/es/", "net/es/", "block") and rows[8][2:] == (None, "block")
    assert url_cascade.judge(pages.limit(0)).count() == 0


def test_mixing(spark):
    plan = mixing.plan(table(spark)).collect()
    assert len(plan) == len(TEXTS) and all(r["taken"] <= 3 * r["size"] for r in plan)
    assert sorted(map(tuple, plan)) == sorted(map(tuple, mixing.plan(table(spark).repartition(3)).collect()))
    out = mixing.emit(table(spark))
    assert out.columns == table(spark).columns
    assert mixing.emit(table(spark, [])).count() == 0


def test_tokens(spark, tmp_path):
    texts = [*TEXTS, "Don't <|endoftext|> 5kg ｘ école É. a.,b <|ENDOFTEXT|>"]
    ids = [None, *range(1, len(texts) - 2), 1, 1]
    huffman.write(table(spark, texts, ids), huffman.default_tokenizer(), str(tmp_path / "out"))
    got = huffman.read(spark, str(tmp_path / "out")).orderBy("start").collect()
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(huffman.default_tokenizer())
    want = sorted(np.array([*model.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes() for t in texts)
    assert sorted(bytes(r["ids"]) for r in got) == want and got[0]["doc_id"] is None
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1].tolist()]
    assert huffman.round_trip(table(spark, [])).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 400), min_size=1, max_size=900), st.integers(9, 16))
def test_huffman_round_trip(ids, limit):
    ids = np.array(ids, np.int64)
    lengths = huffman.code_lengths(np.bincount(ids), limit)
    assert lengths.max() <= limit and sum(2.0 ** -lengths[lengths > 0]) <= 1
    payload, marks = huffman.pack(ids, lengths, huffman.canonical(lengths))
    assert huffman.unpack([payload, payload], [marks, marks], [len(ids)] * 2, huffman.decode_table(lengths, limit), limit)[1].tolist() == ids.tolist()


CONTROL = st.text(st.sampled_from(list("<>|[]/\\sINSTYimend_ \nab")), max_size=30) | st.sampled_from(["</s>", "<\\/s>", "<|im_end|>\n", "[INST]", "<<SYS>>", "<\\\\|im_start|>"])


def test_chat_escapes(spark):
    rng = random.Random(3)
    parts = ["</s>", "[INST]", "[/INST]", "<|im_end|>", "\n", "\\", "<", "|", "<<SYS>>", "a", "<s>", "im_start|>", ">"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = df.select("t", chat_trees.escape(F.col("t")).alias("e")).select("*", chat_trees.unescape(F.col("e")).alias("u"), chat_trees.unescape_role(chat_trees.escape_role(F.col("t"))).alias("r"))
    for r in out.collect():
        assert r["u"] == r["t"] == r["r"]
        assert not any(x in r["e"] for x in ("</s>", "<s>", "[INST]", "[/INST]", "<|im_end|>", "<|im_start|>", "<<SYS>>"))


def test_reply_trees(spark):
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "bad", 0.1), (1, 3, 1, "assistant", None, 0.9), (1, 4, 3, None, "t", 0.9), (1, 9, 8, "user", "orphan", 0.0), (2, 5, 6, "user", "x", 1.0), (2, 6, 5, "user", "y", 1.0)]
    rows += [(3, k, k - 1 if k else None, "user" if k % 2 else "assistant", f"m{k}", 0.0) for k in range(37)]
    df = spark.createDataFrame(rows, "tree bigint, msg bigint, parent bigint, role string, text string, score double").withColumn("pos", F.lit(1))
    got = {(r["tree"], r["rank"]): r for r in chat_trees.parse(chat_trees.format_paths(*chat_trees.branches(df, top=2))).collect()}
    assert set(got) == {(1, 1), (1, 2), (3, 1)}
    assert [t["text"] for t in got[1, 1]["turns"]] == ["q", "", "t"] and got[1, 1]["leaf"] == 4
    assert [t["text"] for t in got[3, 1]["turns"]] == [f"m{k}" for k in range(37)]
    assert got[3, 1]["learned"] == "".join(f"m{k}" for k in range(0, 37, 2))
    assert chat_trees.format_paths(*chat_trees.branches(df.limit(0))).count() == 0


def test_reply_trees_without_keys(spark):
    """A null tree is a tree, a null message a message, and a conversation without an id keeps its rows."""
    rows = [(None, 1, None, "user", "q", 0.0), (None, 2, 1, "assistant", "a", 1.0), (None, 3, 2, "user", "t", 0.0), (4, None, None, "user", "alone", 0.0), (5, 1, None, "user", "root", 0.0), (5, None, 1, "assistant", "leaf", 1.0)]
    df = spark.createDataFrame(rows, "tree bigint, msg bigint, parent bigint, role string, text string, score double")
    got = {r["tree"]: r for r in chat_trees.parse(chat_trees.format_paths(*chat_trees.branches(df))).collect()}
    assert {k: [t["text"] for t in r["turns"]] for k, r in got.items()} == {None: ["q", "a", "t"], 4: ["alone"], 5: ["root", "leaf"]}
    assert got[None]["leaf"] == 3 and got[5]["leaf"] is None


def test_conversations_without_keys(spark, tmp_path):
    rows = [(None, k if k < 30 else None, "assistant" if k % 2 else "user", f"m{k}") for k in range(33)] + [(1, None, "user", "last"), (1, 0, "user", "first")]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    got = [tuple(r) for r in chat_trees.query(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(con.execute(chat_trees.ORACLE).fetchall(), key=str) and len(got) == 3


def test_language(spark):
    net = language.learn(table(spark))
    rows = by_id(language.predict(table(spark), net))
    assert rows[0]["lang_pred"] == rows[1]["lang_pred"] == "und" and rows[3]["lang_pred"] == "en" and rows[0]["score"] == 0
    assert language.learn(table(spark, [])).classes == [] and language.predict(table(spark, []), net).count() == 0
    assert by_id(language.predict(table(spark), language.Network([])))[3]["lang_pred"] == "und"


def test_backpropagation_matches_differences():
    net, rng = language.Network(["a", "b"]), np.random.default_rng(1)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    net.mask = net.mask.astype(np.float64)
    x, y = rng.integers(97, 100, (3, 5)).astype(np.uint8), np.array([0, 1, 1])
    valid = np.ones(x.shape)
    _, grad = net.gradient(x, valid, y)
    for name, spot in (("ahead", (2, 97, 1)), ("back", (0, 98, 9)), ("rec", (1, 2, 3)), ("rec", (2, 9, 10)), ("out_b", (9, 1)), ("bias", (0,))):
        old, losses = net.w[name][spot], []
        for step in (1e-2, -1e-2):
            net.w[name][spot] = old + step
            losses.append(net.gradient(x, valid, y)[0])
        net.w[name][spot] = old
        assert grad[name][spot] == pytest.approx((losses[0] - losses[1]) / 2e-2, abs=2e-3)


def test_quality_classifier(spark):
    model = pairwise_quality.learn(table(spark, []), spark.createDataFrame([], "doc_id bigint, quality int"))
    rows = by_id(pairwise_quality.score(table(spark), model))
    assert len(rows) == len(TEXTS) and rows[0]["score"] == 0.5
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id bigint, quality int")
    docs = table(spark, ["NO!! " * 30 if i % 2 == 0 else "A calm text. " * 20 for i in range(200)])
    rows = by_id(pairwise_quality.score(docs, pairwise_quality.learn(docs, labels)))
    assert all((r["score"] >= 0.5) == bool(i % 2) for i, r in rows.items())


def test_near_groups(spark):
    rows = simhash_trie.near_groups(table(spark, ids=[5, 4, 3, None, 8, 7, 1, 1])).collect()
    assert sorted((r["component_id"] for r in rows if r["fp"] == 0)) == [3, 3, 3]
    assert {r["component_id"] for r in rows if r["doc_id"] in (7, 8)} == {7}
    kept = simhash_trie.one_of_each(table(spark, ids=[5, 4, 3, None, 8, 7, 1, 1]))
    assert kept.columns == table(spark).columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "3", "7", "None"]
    assert simhash_trie.near_groups(table(spark, [])).count() == 0


def test_one_of_each_row(spark):
    """Rows of one id, or of none, with different texts are judged one by one; of equal rows one stays."""
    rng = random.Random(8)
    a, b, c, d = (" ".join(rng.choices([f"w{k}" for k in range(900)], k=80)) for _ in range(4))
    rows = [(1, a), (1, b), (1, b), (2, b), (None, a), (None, c), (None, c), (None, d), (4, d), (5, ""), (None, None), (6, "")]
    kept = simhash_trie.one_of_each(table(spark, [t for _, t in rows], [i for i, _ in rows]))
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept.collect()) == sorted([("1", a), ("1", b), ("None", c), ("4", d), ("5", "")])
    assert simhash_trie.one_of_each(table(spark, [])).count() == 0 and kept.columns == table(spark).columns


@pytest.mark.parametrize("rows", [16_384, 40])
def test_trie_finds_every_component(spark, monkeypatch, rows):
    """Clusters around random centres and uniform noise, with large and with small upper nodes."""
    monkeypatch.setattr(simhash_trie, "NODE_ROWS", rows)
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(300)} | {0, (1 << 64) - 1}
    for centre in [rng.getrandbits(64) for _ in range(3)]:
        for _ in range(150):
            x = centre
            for b in rng.sample(range(64), rng.randint(0, 3)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    table_ = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    found = [tuple(r) for turn, errors in simhash_trie.PASSES for r in simhash_trie.links(table_, turn, errors, len(fps)).collect()]
    parent = {x: x for x in signed}

    def find(p, x):
        while p[x] != x:
            x = p[x]
        return x

    for a, b in found:
        assert ((a ^ b) & simhash_trie._ALL).bit_count() <= 4
        parent[max(find(parent, a), find(parent, b))] = min(find(parent, a), find(parent, b))
    want = {x: x for x in signed}
    for i, a in enumerate(signed):
        for b in signed[:i]:
            if ((a ^ b) & simhash_trie._ALL).bit_count() <= 4:
                want[max(find(want, a), find(want, b))] = min(find(want, a), find(want, b))
    assert [find(parent, x) for x in signed] == [find(want, x) for x in signed]


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 160)}


def test_templates(spark):
    item = "Alice gives 3 pears to Bob and Alice keeps 5 pears for Bob"
    docs = {
        1: "Intro. " + item, 2: item.replace("Alice", "Karla").replace("Bob", "Otto").replace("5", "70").replace("3", "8"), 3: item.lower(),
        4: item.replace("Alice keeps", "Karla keeps"), 5: "nothing of the kind", 6: None, 7: "",
    }
    bench = spark.createDataFrame([(1, item, 3), (2, "short item here", 3), (3, None, 3), (9, item, 3)], "item_id bigint, text string, width int")
    rows = by_id(templates.contaminated(table(spark, list(docs.values()), list(docs)), bench))
    assert set(rows) == {1, 2, 3} and rows[1]["item_ids"] == [1] and rows[1]["members"] == [[1, 9]]
    kept = templates.clean(table(spark, list(docs.values()), list(docs)), bench)
    assert sorted(r["doc_id"] for r in kept.collect()) == [4, 5, 6, 7] and kept.columns == table(spark).columns
    assert templates.contaminated(table(spark), bench.limit(0)).count() == 0 and templates.contaminated(table(spark, []), bench).count() == 0


def plain_leaks(docs, items):
    """Hits, smallest items and items of several by comparing every window of a document with every window of an item."""
    def windows(text, widths):
        tokens = [(m.group(), m.start(), m.end()) for m in templates._TOKEN.finditer(text or "")]
        for width in widths or {min(13, len(tokens))} - {0}:
            for s in range(len(tokens) - width + 1):
                part = tokens[s : s + width]
                kinds = [templates._kind(t) for t, *_ in part]
                if width < 8:
                    raw = "".join((text or "")[part[0][1] : part[-1][2]].split()).lower()
                    yield (width, s), (width, 2, tuple(t.lower() for t, *_ in part), raw)
                    continue
                for form, limit in ((0, 3), (1, 2), (2, 0)):
                    few = 2 * sum(k < max(limit, 2) for k in kinds) <= width
                    if few != (form == 2):
                        values = [t.lower() for (t, *_), k in zip(part, kinds) if k < limit]
                        yield (width, s), (width, form, tuple(t.lower() if k >= limit else k for (t, *_), k in zip(part, kinds)), tuple(map(values.index, values)))

    classes = {}
    for i, text in items:
        for _, key in windows(text, None):
            classes.setdefault(key, set()).add(i)
    widths = {k[0] for k in classes}
    hits, met = {}, {}
    for d, text in docs:
        for place, key in windows(text, widths) if widths else ():
            if key in classes:
                hits.setdefault(d, set()).add((text, place))
                met.setdefault(d, set()).add(key)
    order = sorted(met, key=lambda d: (d is None, d or 0))
    first = {key: d for d in reversed(order) for key in met[d]}
    known = lambda x: sorted(i for i in x if i is not None)
    return {
        d: (len(hits[d]), sorted({min(known(classes[k])) for k in met[d] if known(classes[k])}), sorted({tuple(known(classes[k])) for k, x in first.items() if x == d and len(known(classes[k])) > 1}))
        for d in met
    }


def test_leaks_against_all_pairs(spark):
    rng = random.Random(4)
    word = lambda: rng.choice(["the", "sum", "of", "is", "pears", "Alice", "Bob", "kg", "3", "14", "Über", "day", "x-ray", "why?"])
    items = [(i, " ".join(word() for _ in range(rng.choice([0, 2, 5, 9, 14, 20])))) for i in range(25)]
    items += [(i + 30, t.replace("3", "8").replace("Alice", "Carla")) for i, t in items[:12]] + [(None, items[3][1]), (70, items[4][1]), (71, None), (72, "")]
    docs = []
    for i in range(60):
        body = [word() for _ in range(rng.randint(0, 60))]
        copied = rng.choice(items)[1] or ""
        body[rng.randint(0, len(body)) : 0] = [copied.replace("Bob", "Otto").replace("14", "15") if i % 3 else copied.lower() if i % 2 else copied]
        docs.append((i % 40 if i % 7 else None, " ".join(body)))
    docs += [(80, None), (81, ""), (82, " ".join(["filler"] * 70_000 + [max((t or "" for _, t in items), key=len)])), docs[5], docs[5]]
    ids, texts = [i for i, _ in docs], [t for _, t in docs]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, start int")
    got = templates.contaminated(table(spark, texts, ids), bench).collect()
    want = plain_leaks(docs, items)
    assert {r["doc_id"]: (r["hits"], r["item_ids"], [tuple(m) for m in r["members"]]) for r in got} == want and len(got) == len(want)
    assert any(len(x[2]) for x in want.values()) and 82 in want
    bad = {(d, t) for d, t in docs if plain_leaks([(d, t)], items)}
    kept = templates.clean(table(spark, texts, ids), bench).collect()
    assert sorted(str((r["doc_id"], r["text"])) for r in kept) == sorted(str(x) for x in docs if x not in bad)
    assert any(d is None for d, _ in bad) and any(r["doc_id"] is None for r in kept)


def test_literal_leaks(spark):
    """Exact copies of items that are mostly numbers, short, or in a script without spaces; and no others."""
    items = [
        "3 + 4 + 12 + 9 + 7 + 22 + 31 + 8 + 5 + 41 + 6 + 17 + 2 + 90 = 257", "Row 1: 10 kg 20 kg 30 kg 40 kg", "What is 12 x 7?", "2 + 2 =",
        "北京是哪个国家的首都城市呢请回答我", "日本の首都は？", "ประเทศไทยมีกี่จังหวัด", "?!", "",
    ]
    copies = [f"Before it. {x} And after" for x in items[:7]]
    others = [
        copies[0].replace("22", "23"), copies[1].replace("10", "11"), "what is 12 by 7", "2, 2", "2 - 2 = 0", "北京是哪个国家的城市", "日本の首相", "Before it. And after", "?!",
    ]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    split = [copies[3].replace("2 + 2 =", "2\n+2="), copies[2].upper()]
    rows = by_id(templates.contaminated(table(spark, [*copies, *split, *others]), bench))
    assert {i: r["item_ids"] for i, r in rows.items()} == {**{i: [i] for i in range(7)}, 7: [3], 8: [2]}
    assert templates.clean(table(spark, [*copies, *others]), bench).count() == len(others)


def brute_dedup(rows):
    first = {}
    for i, text in rows:
        w = (text or "").split()
        for p in range(len(w) - 12):
            first[tuple(w[p : p + 13])] = min(first.get(tuple(w[p : p + 13]), i), i)
    out = []
    for i, text in rows:
        w = (text or "").split()
        gone = {q for p in range(len(w) - 12) if first[tuple(w[p : p + 13])] < i for q in range(p, p + 13)}
        out.append((i, len(w), len(gone), " ".join(x for q, x in enumerate(w) if q not in gone)))
    return sorted(out)


@pytest.mark.parametrize("block", [8 << 20, 2000])
def test_superkmers(spark, monkeypatch, block):
    monkeypatch.setattr(superkmer, "BLOCK_BYTES", block)
    monkeypatch.setattr(superkmer, "BUCKET_BYTES", 5 * block)
    rng = random.Random(2)
    shared = [" ".join(rng.choices("abcdefgh", k=60)) for _ in range(3)]
    rows = [(i % 45, " ".join([*rng.choices("abcdefgh", k=rng.randint(0, 40)), rng.choice(shared) if i % 3 else "a " * 50, *rng.choices("xyz", k=9)])) for i in range(60)]
    rows += [(70, None), (71, ""), (72, "a  b\tc")]
    got = superkmer.dedup(table(spark, [t for _, t in rows], [i for i, _ in rows])).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got) == brute_dedup(rows)
    assert superkmer.dedup(table(spark, [])).count() == 0


def test_equal_hashes_are_told_apart(monkeypatch):
    at = np.array([*range(13), *range(20, 33), *range(13)], np.int64)
    starts = np.array([0, 13, 26])
    monkeypatch.setattr(words.Spans, "of", lambda self, starts, lengths: np.zeros(len(starts), np.uint64))
    order, begin = superkmer._same_windows(at, starts)
    groups = np.split(starts[order], begin[1:])
    assert sorted(map(sorted, (g.tolist() for g in groups))) == [[0, 26], [13]]


def test_digest_of_nothing(spark):
    row = superkmer.dedup(table(spark, [None])).select(F.sha2("kept_text", 256).alias("s")).first()
    assert row["s"] == hashlib.sha256(b"").hexdigest()


def test_samples_are_bounded_when_ids_repeat(spark, monkeypatch):
    """One id, or none, behind most rows: the training samples stay bounded, and every language is learned."""
    monkeypatch.setattr(language, "SAMPLE_DOCS", 20)
    monkeypatch.setattr(pairwise_quality, "SAMPLE_DOCS", 20)
    hot = next(i for i in range(9) if not spark.sql(f"SELECT crc32('{i}') % 3 = 1").first()[0])
    rows = [(hot if i % 3 else None, f"the words of text {i} number {i * i}" if i % 2 else f"la palabra {i} del texto {i * i}", "en" if i % 2 else "es") for i in range(900)]
    rows += [(hot, "one and the same", "en")] * 600
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    seen = []
    monkeypatch.setattr(language, "fit", lambda passages: seen.append(passages))
    language.learn(docs)
    assert {lang for lang, _ in seen[0]} == {"en", "es"} and all(sum(x[0] == lang for x in seen[0]) <= 20 for lang in ("en", "es"))
    monkeypatch.setattr(pairwise_quality, "fit", lambda x, good, share: seen.append(x))
    pairwise_quality.learn(docs, spark.createDataFrame([(hot, 1), (hot, 0), (hot, 1)], "doc_id bigint, quality int"))
    assert 10 < len(seen[1]) < 200


def test_numbered_control_strings_are_broken(spark):
    text = "<|reserved_special_token_0|> [INST] <|im_end|>"
    made = spark.range(1).select(chat_trees.escape(F.lit(text)).alias("e")).select("e", chat_trees.unescape(F.col("e")).alias("u")).first()
    assert "<|reserved" not in made["e"] and made["u"] == text


def test_long_and_repeated_urls(spark):
    long = "http://" + "a." * 2_000 + "example.com/en/" + "x/" * 20_000 + "?q#f"
    pages = spark.createDataFrame([(1, long), (1, long), (2, long.replace("/en/", "/de/"))], "page_id bigint, url string")
    rows = [tuple(r) for r in url_cascade.judge(pages).select("page_id", "rule", "verdict").collect()]
    assert sorted(rows) == [(1, "example.com/en/", "block")] * 2 + [(2, "com/", "allow")]


def test_ranks_of_equal_and_odd_scores(spark):
    rows = [(1, 1, None, 0.0), (1, 5, 1, 1.0), (1, 4, 1, 1.0), (1, 4, 1, 1.0), (2, 1, None, 0.0), (2, 2, 1, 9.0), (2, 3, 1, float("nan")), (2, 4, 1, None)]
    df = spark.createDataFrame([(t, m, p, "assistant", "long " * 60_000 if m == 4 else str(m), s) for t, m, p, s in rows], "tree bigint, msg bigint, parent bigint, role string, text string, score double")
    got = {(r["tree"], r["rank"]): r for r in chat_trees.parse(chat_trees.format_paths(*chat_trees.branches(df, top=3))).collect()}
    assert [got[1, k]["leaf"] for k in (1, 2)] == [4, 5] and [got[2, k]["leaf"] for k in (1, 2, 3)] == [3, 2, 4] and len(got) == 5
    assert got[1, 1]["learned"] == "1" + "long " * 60_000


def test_stages_on_odd_tables(spark, tmp_path):
    """Nulls, empty texts and empty tables through the stages of the pipeline."""
    net = language.learn(table(spark))
    kept = language.accepted(table(spark, [None, "", "12 34", "one two three"], [None, 1, 2, None]), net)
    assert kept.columns == table(spark).columns and [r["text"] for r in kept.collect()] == ["one two three"]
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine")], "item_id bigint, text string")
    assert templates.clean(table(spark, []), bench).count() == 0 and templates.clean(table(spark), bench.limit(0)).count() == len(TEXTS)
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_quality_is_learned_from_every_labelled_row(spark, monkeypatch):
    """All rows and all their pairs count: weights, threshold and spread are those of brute force, whatever the sample."""
    rng = random.Random(4)
    texts, labels = [], []
    for i in range(400):
        good = rng.random() < 0.7
        marks = rng.choices(["calm", "text", "of", "words.", "NO!!", "|x|", "9"], [9, 9, 9, 4, 1, 1, 1] if good else [5, 5, 5, 1, 4, 4, 4], k=rng.randint(3, 60))
        texts.append(" ".join(marks))
        labels.append((i, int(good)))
    docs, marked = table(spark, texts).union(table(spark, texts)), spark.createDataFrame([*labels, (9_999, 0), (3, None)], "doc_id bigint, quality int")
    made = []
    for size in (5, 3000):
        monkeypatch.setattr(pairwise_quality, "SAMPLE_DOCS", size)
        made.append(pairwise_quality.learn(docs, marked))
    out = {r["doc_id"] for r in docs.where(language.held_out(F.col("doc_id"))).collect()}
    used = [i for i in range(400) if i not in out]
    x, good = pairwise_quality.features(pa.array([texts[i] for i in used])), np.array([labels[i][1] == 1 for i in used])
    z = (x - x.mean(0)) / (x.std(0) + 1e-3)
    d = (z[good][:, None] - z[~good][None]).reshape(-1, z.shape[1])
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(d @ w))
        curve = (d * (p * (1 - p))[:, None]).T @ d / len(d) + pairwise_quality.RIDGE * np.eye(len(w))
        w = w + np.linalg.solve(curve, d.T @ p / len(d) - pairwise_quality.RIDGE * w)
    s = z @ w
    for model in made:
        assert np.allclose(model.centre, x.mean(0)) and np.abs((x - model.centre) / model.scale @ model.weights - s).max() < 0.02
        own = np.sort(model.raw(x))
        assert model.threshold == pytest.approx(own[(~good).sum() - 1 : (~good).sum() + 1].mean(), abs=1e-9)
        assert model.spread == pytest.approx(own.std(), abs=1e-6)


def test_ranks_are_exact_among_equal_scores(spark):
    values = [0.25] * 700 + [float(i) for i in range(1, 200)] + [-1.0]
    scores = spark.createDataFrame([(v,) for v in values], "s double").repartition(3)
    values.sort()
    for rank in (0, 1, 699, 700, 701, 898, 899):
        assert pairwise_quality._at_rank(scores, rank, len(values)) == (values[rank], values[min(rank + 1, 899)])
